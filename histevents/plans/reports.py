"""Report jobs: nested one-row DataFrames assembled from small aggregates.

Every part is an aggregate over the event table (partial aggregation on the
executors); the parts are merged with ``combine_rows`` (union + ``first``),
so nothing is collected to the driver and no cross join is used.  Lists in
a report are bounded by construction (<= 20 recent years, a handful of
sources/categories, <= 10 root errors); the near-duplicate list itself is
kept as a separate DataFrame and only its count enters the summary.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histevents.operators import dedupe, stats, validate
from histevents.plans import store as K


def collection_statistics(spark: SparkSession, events: DataFrame, as_of_year: int | None = None) -> DataFrame:
    """Overall stats (A16) + source breakdown (A7) + recent years (A8) +
    category breakdown (A9) as one nested row."""
    as_of_year = as_of_year or _dt.date.today().year
    overall = stats.collection_stats(events).select(F.struct("*").alias("overall_stats"))
    src = stats.source_breakdown(events).agg(
        F.sort_array(F.collect_list(F.struct(F.col("count"), F.col("source"), F.col("min_year"),
                                             F.col("max_year"), F.col("year_range"))), asc=False)
        .alias("source_breakdown"))
    recent = stats.recent_years(events, as_of_year).agg(
        F.sort_array(F.collect_list(F.struct("year", "count")), asc=False).alias("recent_years"))
    cats = stats.category_breakdown(events).agg(
        F.sort_array(F.collect_list(F.struct("count", "category", "avg_severity")), asc=False)
        .alias("category_breakdown"))
    return stats.combine_rows(overall, src, recent, cats)


def validation_report(spark: SparkSession, events: DataFrame, root_col: str = "digital_root") -> dict[str, DataFrame]:
    """Completeness (A13), root validation (A15), duplicates (J1) and the
    summary (A20).  Returns the parts as DataFrames; ``summary`` is one row."""
    ev = events if root_col in events.columns else events.withColumn(root_col, F.lit(None).cast("int"))
    comp = stats.completeness(spark, ev)
    acc = stats.root_accuracy(ev, root_col)
    errors = stats.root_errors(ev, root_col, 10)
    duplicates, dup_count = dedupe.duplicate_detection(ev)
    summary = stats.report_summary(comp, acc, dup_count)
    return {"data_completeness": comp, "digital_root_validation": acc, "incorrect_events": errors,
            "duplicate_detection": duplicates, "summary": summary}


def validation_report_row(spark: SparkSession, events: DataFrame) -> DataFrame:
    """The report as one nested row (duplicates as a count, errors <= 10)."""
    parts = validation_report(spark, events)
    errs = parts["incorrect_events"].agg(F.collect_list(F.struct("*")).alias("incorrect_events"))
    return stats.combine_rows(
        parts["data_completeness"].select(F.struct("*").alias("data_completeness")),
        parts["digital_root_validation"].select(F.struct("*").alias("digital_root_validation")),
        errs,
        parts["summary"].select(F.struct("*").alias("summary")),
    ).withColumn("timestamp", F.current_timestamp())


def export_collection_report(spark: SparkSession, events: DataFrame, path: str,
                             as_of_year: int | None = None) -> DataFrame:
    """Statistics + validation summary -> one JSON document (K6)."""
    rep = stats.combine_rows(
        collection_statistics(spark, events, as_of_year).select(F.struct("*").alias("statistics")),
        validation_report_row(spark, events).select(F.struct("*").alias("validation")),
    ).withColumn("timestamp", F.current_timestamp())
    K.write_report(rep, path)
    return rep


def clean_invalid_events(store: K.EventStore, dry_run: bool = True) -> tuple[DataFrame, int]:
    """L8 (+K9): validator over the stored columns; (summary row, deleted).
    The invalid ids stay a DataFrame (never a driver-side list)."""
    ev = store.events()
    summary = validate.clean_summary(ev, dry_run)
    deleted = 0
    if not dry_run:
        deleted = store.delete_ids(validate.invalid_ids(ev))
    return summary, deleted
