"""Economic source: indicator series, market series and the curated list.

Landed inputs
-------------
indicator records  (country, indicator, year, value) or raw API pages read
                   with ``read_indicator_pages`` (``[meta, [records]]``).
market payloads    (symbol, payload) where payload is the monthly JSON map
                   ``{date: {"4. close": "..."}}``, read with
                   ``explode_market_payload``; or (symbol, date, close) rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from histevents import lexicons as L
from histevents.schema import order_key
from histevents.operators.detect import detect_indicator_events, detect_market_crashes, monthly_points


def read_indicator_pages(spark: SparkSession, path: str) -> DataFrame:
    """Raw indicator responses, one JSON document per line: the records are
    the second element; a document of another shape gives no rows."""
    raw = spark.read.text(path)
    v = F.try_parse_json(F.col("value"))
    recs = F.try_variant_get(v, "$[1]", "array<variant>")
    rows = raw.select(F.explode(recs).alias("r"))
    return rows.select(
        F.try_variant_get("r", "$.country.id", "string").alias("country"),
        F.try_variant_get("r", "$.indicator.id", "string").alias("indicator"),
        F.try_variant_get("r", "$.date", "string").try_cast("int").alias("year"),
        F.try_variant_get("r", "$.value", "double").alias("value"),
    )


def select_series(records: DataFrame, economies=L.MAJOR_ECONOMIES, indicators=L.WORLD_BANK_INDICATORS,
                  max_rows: int | None = None) -> DataFrame:
    """Keep the tracked (country, indicator) pairs -- a literal ``isin``
    predicate, no loop.  ``economies=None`` keeps every country.
    ``max_rows`` (None = no cap) mirrors a per-request page size: the newest
    ``max_rows`` records per series."""
    out = records
    if economies is not None:
        out = out.filter(F.col("country").isin(list(economies)))
    if indicators is not None:
        out = out.filter(F.col("indicator").isin(list(indicators)))
    if max_rows is not None:
        w = Window.partitionBy("country", "indicator").orderBy(F.desc("year"))
        out = out.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= max_rows).drop("_rn")
    return out


def explode_market_payload(payloads: DataFrame) -> DataFrame:
    """S7 scan half: (symbol, payload JSON map) -> (symbol, date, close)."""
    m = F.from_json(F.col("payload"), "map<string, map<string, string>>")
    return (payloads.select("symbol", F.explode(m).alias("date", "v"))
            .select("symbol", "date", F.col("v").getItem("4. close").try_cast("double").alias("close")))


def market_events(points: DataFrame, lo: int, hi: int, symbols=L.MARKET_INDICES,
                  enabled: bool = True) -> DataFrame:
    """Crash events for the tracked indices; nothing unless the range
    reaches 1999 and the source is enabled (a literal predicate, so the plan
    collapses to an empty relation)."""
    p = points
    if symbols is not None:
        p = p.filter(F.col("symbol").isin(list(symbols)))
    p = p.filter(F.lit(enabled and hi >= L.MARKET_MIN_END_YEAR))
    return detect_market_crashes(monthly_points(p, lo, hi))


def curated_events(spark: SparkSession, lo: int, hi: int) -> DataFrame:
    """The curated list, inclusive year filter, verified rows."""
    rows = [(i, y, t, d, s, float(imp)) for i, (y, t, d, s, imp) in enumerate(L.CURATED_ECONOMIC_EVENTS)]
    df = spark.createDataFrame(rows, "curated_idx int, year int, title string, description string, "
                                     "subcategory string, impact_score double")
    meta = F.create_map(F.lit("event_type"), F.lit("historical_major_event"), F.lit("confidence"), F.lit("high"))
    from histevents.functions.text import estimate_severity
    return (df.filter(F.col("year").between(lo, hi))
            .select("curated_idx", "year", "title", "description", F.lit("economic").alias("category"),
                    "subcategory", F.lit("historical_database").alias("source"), "impact_score",
                    meta.alias("metadata"), F.lit(True).alias("verified"))
            .withColumn("severity", estimate_severity("title", "description")))


def collect_economic_events(spark: SparkSession, indicators: DataFrame, points: DataFrame | None,
                            lo: int, hi: int, economies=L.MAJOR_ECONOMIES, market_enabled: bool = True,
                            symbols=L.MARKET_INDICES) -> DataFrame:
    """L10 (economic): indicator events, then market crashes, then curated
    rows, with an ordering key (part, series, year/date, position)."""
    ind = detect_indicator_events(select_series(indicators, economies), lo, hi)
    econ_order = F.array(*[F.lit(c) for c in (economies or ("",))])
    ind_order = F.array(*[F.lit(c) for c in L.WORLD_BANK_INDICATORS])
    ind = ind.withColumn("order_key", order_key(
        F.lit(0), F.array_position(econ_order, F.col("country")), F.array_position(ind_order, F.col("indicator")),
        F.col("year"), s1=F.col("country"), s2=F.col("indicator")))
    parts = [ind.drop("country", "indicator", "value", "prev", "change_pct")]
    if points is not None:
        mk = market_events(points, lo, hi, symbols=symbols, enabled=market_enabled)
        idx = F.array(*[F.lit(s) for s in L.MARKET_INDICES])
        mk = mk.withColumn("order_key", order_key(
            F.lit(1), F.array_position(idx, F.col("symbol")), s1=F.col("symbol"), s2=F.col("date")))
        parts.append(mk.drop("symbol", "date", "close", "prev_close", "change_pct"))
    cur = curated_events(spark, lo, hi).withColumn("order_key", order_key(
        F.lit(2), F.col("curated_idx"))).drop("curated_idx")
    parts.append(cur)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
