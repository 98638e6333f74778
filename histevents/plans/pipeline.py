"""Collection runs: sources -> dedupe -> validate -> store, plus summaries.

There is no batch loop.  One plan covers the whole year range; the year
batch of each event is a derived column used only for the roll-up.  Sources
are written to the run's own scratch table one by one, in fixed priority
order: a source that fails, when its plan is built or while it runs, is
reported in its summary row and does not stop the others, and everything that
follows (append, quarantine, raw files, summary) reads the same staged rows.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histevents import lexicons as L
from histevents.functions.scalars import year_batch_start
from histevents.operators import dedupe, validate
from histevents.operators.filters import select_sources
from histevents.plans.store import save_raw_json, to_store_rows
from histevents.session import scratch_path
from histevents.sources import economic, news, wiki


@dataclass
class Landed:
    """Landed payload tables a run reads (any may be None)."""
    pages: DataFrame | None = None
    hits: DataFrame | None = None
    indicators: DataFrame | None = None
    market_points: DataFrame | None = None
    articles: DataFrame | None = None
    economies: tuple | None = L.MAJOR_ECONOMIES
    symbols: tuple | None = L.MARKET_INDICES
    market_enabled: bool = True
    news_enabled: bool = True


EVENT_COLUMNS = ("year", "title", "description", "category", "source", "date", "subcategory", "severity",
                 "source_url", "location", "participants", "tags", "impact_score", "metadata", "verified")


def _shape(df: DataFrame, name: str, priority: int) -> DataFrame:
    cols = [F.col(c) if c in df.columns else F.lit(None).alias(c) for c in EVENT_COLUMNS]
    out = df.select(*cols, F.col("order_key"))
    return (out.withColumn("collector", F.lit(name)).withColumn("source_priority", F.lit(priority))
            .withColumn("metadata", F.col("metadata").cast("map<string,string>"))
            .withColumn("tags", F.col("tags").cast("array<string>"))
            .withColumn("date", F.col("date").cast("timestamp"))
            .withColumn("severity", F.col("severity").cast("int"))
            .withColumn("impact_score", F.col("impact_score").cast("double"))
            .withColumn("verified", F.col("verified").cast("boolean")))


# Collector registry (E1 callables)
def _wiki(spark, landed: Landed, lo, hi, as_of):
    if landed.pages is None:
        return None
    return wiki.collect_wiki_events(spark, landed.pages, landed.hits, lo, hi)


def _economic(spark, landed: Landed, lo, hi, as_of):
    if landed.indicators is None:
        return None
    return economic.collect_economic_events(spark, landed.indicators, landed.market_points, lo, hi,
                                            economies=landed.economies, market_enabled=landed.market_enabled,
                                            symbols=landed.symbols)


def _news(spark, landed: Landed, lo, hi, as_of):
    if landed.articles is None:
        return None
    return news.collect_news_events(spark, landed.articles, lo, hi, as_of, enabled=landed.news_enabled)


COLLECTORS = {"wikipedia": _wiki, "economic": _economic, "news": _news}


def _stage(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared scratch folder and read back."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def collect_events(spark: SparkSession, landed: Landed, lo: int, hi: int, sources=None,
                   as_of_date: _dt.date | None = None) -> DataFrame:
    """Union of the requested sources (priority order) with a global
    ordering key (source priority, source-local order)."""
    out, _ = collect_events_with_status(spark, landed, lo, hi, sources, as_of_date)
    return out


def collect_events_with_status(spark: SparkSession, landed: Landed, lo: int, hi: int, sources=None,
                               as_of_date: _dt.date | None = None) -> tuple[DataFrame, list[tuple]]:
    """As ``collect_events``, isolating sources: each is staged on its own, so
    one that fails (missing or malformed input, or a fault while it runs) is
    reported and the others still run.  Returns (events, [(source, ok, message)])."""
    as_of_date = as_of_date or _dt.date.today()

    def collect(prio: int, name: str):
        """(staged events or None, message)"""
        try:
            df = COLLECTORS[name](spark, landed, lo, hi, as_of_date)
            if df is None:
                return None, "no landed input"
            return _stage(_shape(df, name, prio), f"collected-{name}"), None
        except Exception as exc:  # noqa: BLE001 - per-source isolation (D21)
            return None, f"{type(exc).__name__}: {exc}"

    names = select_sources(sources)
    with ThreadPoolExecutor(max(1, len(names))) as pool:  # the sources' jobs run side by side
        done = list(pool.map(collect, range(len(names)), names))
    parts = [df for df, _ in done if df is not None]
    status = [(name, df is not None, message) for name, (df, message) in zip(names, done)]
    if not parts:
        raise ValueError(f"no source gave events: {status}")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out, status


def dedupe_events(events: DataFrame) -> DataFrame:
    """W3 over the run: first row per event hash in (source priority, source
    order) order; every source emits the same typed ``order_key`` shape."""
    h = dedupe.with_event_hash(events)
    h = h.withColumn("_seq", F.struct("source_priority", "order_key")).drop("order_key")
    return dedupe.first_wins_dedupe(h, "event_hash", ["_seq"])


def run_collection(spark: SparkSession, landed: Landed, lo: int, hi: int, sources=None,
                   batch_size: int = L.BATCH_SIZE_FULL, as_of_date: _dt.date | None = None,
                   store=None, raw_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """L1/L3: returns (deduplicated events with ``valid``, ``saved`` and
    ``batch_start``, per-source summary).

    The sources' rows are staged; with a store, the deduplicated rows too, and
    ``saved`` marks the valid rows whose hash the store doesn't hold yet; these
    are appended and invalid rows quarantined (K4).  Without one, it marks the valid rows.  With
    ``raw_path`` the collected events go there as JSON files per source (K1)."""
    events, status = collect_events_with_status(spark, landed, lo, hi, sources, as_of_date)
    if raw_path is not None:
        save_raw_json(events.drop("order_key", "collector", "source_priority"), raw_path)
    ev = dedupe_events(events).drop("_seq")
    ev = (ev.withColumn("valid", validate.collector_valid(ev))
          .withColumn("batch_start", year_batch_start("year", lo, batch_size)))
    if store is None:
        ev = ev.withColumn("saved", F.col("valid"))
    else:
        ev = _stage(ev, "run")
        saved = F.col("valid")
        if store.exists():
            # events of the run can fall outside [lo, hi] (resolved page years,
            # news dates), so all stored hashes are compared: one scan, whose
            # result (hashes of the run at most) is staged before the append
            held = _stage(store.held_hashes(ev), "run-held").withColumn("_held", F.lit(True))
            ev, saved = ev.join(held, "event_hash", "left"), saved & F.col("_held").isNull()
        ev = ev.withColumn("saved", saved).drop("_held")
        rows = ev.drop("valid", "batch_start", "event_hash", "collector", "source_priority")
        store.append_checked(to_store_rows(rows.filter("saved").drop("saved")))
        store.quarantine(ev.filter(~F.col("valid")).select(*rows.drop("saved").columns))
    summary = collection_summary(ev).withColumn("error_message", F.lit(None).cast("string"))
    failed = [(n, m) for n, ok, m in status if not ok]
    if failed:  # failed sources: one row each, errors = 1 (the run itself succeeds)
        rows = spark.createDataFrame(failed, "collector string, error_message string") \
            .select("collector", F.lit(None).cast("int").alias("batch_start"),
                    F.lit(0).cast("long").alias("events_collected"), F.lit(0).cast("long").alias("events_saved"),
                    F.lit(1).cast("long").alias("errors"), F.lit("source").alias("level"), "error_message")
        summary = summary.unionByName(rows)
    return ev, summary


def collection_summary(ev: DataFrame) -> DataFrame:
    """Per (collector, batch) collected/saved/errors with per-source
    and grand totals (``rollup``)."""
    return (ev.rollup("collector", "batch_start")
            .agg(F.count(F.lit(1)).alias("events_collected"),
                 F.count_if("saved").alias("events_saved"),
                 F.count_if(~F.col("valid")).alias("errors"))
            .withColumn("level", F.when(F.col("collector").isNull(), "total")
                        .when(F.col("batch_start").isNull(), "source").otherwise("batch")))


# L4 presets
def collect_historical(spark, landed: Landed, **kw):
    return run_collection(spark, landed, 1, L.YEAR_RANGE[1], **kw)


def collect_sample(spark, landed: Landed, sample_years: int = 100, as_of_date: _dt.date | None = None, **kw):
    now = as_of_date or _dt.date.today()
    return run_collection(spark, landed, now.year - sample_years, now.year, batch_size=L.BATCH_SIZE_SAMPLE,
                          as_of_date=now, **kw)


def collect_recent(spark, landed: Landed, as_of_date: _dt.date | None = None, **kw):
    """Last and current year, news and economic only, batch size 1."""
    now = as_of_date or _dt.date.today()
    return run_collection(spark, landed, now.year - 1, now.year, sources=["news", "economic"],
                          batch_size=L.BATCH_SIZE_RECENT, as_of_date=now, **kw)
