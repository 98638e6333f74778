"""Statistics, coverage and quality scoring over an event table.

Each function takes the store (or any event-shaped frame) and returns a small
DataFrame.  The per-row work is a single scan with partial (map-side)
aggregation; only the tiny per-group results are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from histevents import lexicons as L
from histevents.functions.scalars import (
    avg_round2_exact, bround2_exact, digital_root, digital_root_meaning,
)


def _with_root(events: DataFrame) -> DataFrame:
    if "digital_root" in events.columns:
        return events
    return events.withColumn("digital_root", digital_root("year"))


def verification_stats(events: DataFrame) -> DataFrame:
    """total, verified, fraction (0 when empty) and percent."""
    n = F.count(F.lit(1))
    v = F.count_if(F.coalesce(F.col("verified"), F.lit(False)))
    return events.agg(n.alias("total_events"), v.alias("verified_events")).select(
        "total_events", "verified_events",
        F.coalesce(F.try_divide(F.col("verified_events").cast("double"), F.col("total_events").cast("double")),
                   F.lit(0.0)).alias("verification_rate"),
        F.coalesce(F.try_divide(F.col("verified_events").cast("double"), F.col("total_events").cast("double"))
                   * F.lit(100.0), F.lit(0.0)).alias("verification_pct"),
    )


def category_distribution(events: DataFrame) -> DataFrame:
    return events.groupBy("category").agg(F.count(F.lit(1)).alias("count"))


def digital_root_distribution(events: DataFrame) -> DataFrame:
    return _with_root(events).groupBy("digital_root").agg(F.count(F.lit(1)).alias("count"))


def expected_root_counts(spark: SparkSession, events: DataFrame) -> DataFrame:
    """Counts for roots 1..9 from the fixed 9-row domain (missing -> 0),
    with each root's meaning.  The domain side is 9 rows: broadcast."""
    domain = spark.range(1, 10).select(F.col("id").cast("int").alias("digital_root"))
    counts = digital_root_distribution(events)
    return (F.broadcast(domain).join(counts, "digital_root", "left")
            .select("digital_root", digital_root_meaning("digital_root").alias("meaning"),
                    F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("n_events")))


def category_breakdown(events: DataFrame) -> DataFrame:
    """Per category: count, mean severity rounded half-even to 2 (0 if none);
    count descending, name as tie-break."""
    g = events.groupBy("category").agg(
        F.count(F.lit(1)).alias("count"),
        F.sum(F.col("severity").cast("long")).alias("_s"),
        F.count("severity").alias("_n"),
    )
    avg = avg_round2_exact("_s", "_n")
    return (g.select("category", "count",
                     F.when(avg.isNull() | (avg == 0), F.lit(0.0)).otherwise(avg).alias("avg_severity"))
            .orderBy(F.desc("count"), F.asc("category")))


def source_breakdown(events: DataFrame) -> DataFrame:
    """Per source: count, min/max year, year_range (0 when min or max is 0/null)."""
    g = events.groupBy("source").agg(
        F.count(F.lit(1)).alias("count"), F.min("year").alias("min_year"), F.max("year").alias("max_year"))
    truthy = F.coalesce(F.col("min_year") != 0, F.lit(False)) & F.coalesce(F.col("max_year") != 0, F.lit(False))
    return (g.withColumn("year_range", F.when(truthy, F.col("max_year") - F.col("min_year") + 1).otherwise(0))
            .orderBy(F.desc("count"), F.asc("source")))


def recent_years(events: DataFrame, as_of_year: int, span: int = 20) -> DataFrame:
    """Events per year for year >= as_of_year - span, newest first."""
    return (events.filter(F.col("year") >= F.lit(as_of_year - span))
            .groupBy("year").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("year")))


def year_coverage(events: DataFrame) -> DataFrame:
    """min/max (0 reads as missing), distinct years, expected 2025, percent."""
    g = events.agg(F.min("year").alias("_min"), F.max("year").alias("_max"),
                   F.countDistinct("year").alias("unique_years"))
    return g.select(
        F.nullif(F.col("_min"), F.lit(0)).alias("min_year"),
        F.nullif(F.col("_max"), F.lit(0)).alias("max_year"),
        "unique_years",
        F.lit(L.EXPECTED_YEARS).alias("expected_years"),
        (F.col("unique_years") / F.lit(float(L.EXPECTED_YEARS)) * F.lit(100.0)).alias("coverage_percentage"),
    )


def combine_rows(*frames: DataFrame) -> DataFrame:
    """Merge one-row frames with distinct columns into one row (union by
    name, then ``first`` non-null per column) -- no cross join."""
    u = frames[0]
    for f in frames[1:]:
        u = u.unionByName(f, allowMissingColumns=True)
    cols = []
    for f in frames:
        cols.extend(c for c in f.columns if c not in cols)
    return u.agg(*[F.first(c, ignorenulls=True).alias(c) for c in cols])


PARTIAL_KEYS = ("category", "year", "digital_root")


def partials(events: DataFrame, *keys: str) -> DataFrame:
    """Counts per (``keys``, category, year, root) that add up: events, verified
    ones, severities and their sum."""
    return _with_root(events).groupBy(*keys, *PARTIAL_KEYS).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.coalesce(F.col("verified"), F.lit(False))).alias("_v"),
        F.count("severity").alias("_with_severity"),
        F.coalesce(F.sum(F.col("severity").cast("long")), F.lit(0)).alias("_severity"))


def merged(parts: DataFrame) -> DataFrame:
    """Partial counts of several tables or deltas, added up."""
    sums = ("_n", "_v", "_with_severity", "_severity")
    return parts.groupBy(*PARTIAL_KEYS).agg(*[F.sum(c).alias(c) for c in sums]).filter(F.col("_n") > 0)


def year_coverage_of(parts: DataFrame) -> DataFrame:
    """``year_coverage`` from merged partial counts."""
    return year_coverage(parts)  # each year that has events has a row


def category_breakdown_of(parts: DataFrame) -> DataFrame:
    """``category_breakdown`` from merged partial counts."""
    g = parts.groupBy("category").agg(F.sum("_n").alias("count"), F.sum("_severity").alias("_s"),
                                      F.sum("_with_severity").alias("_n"))
    avg = avg_round2_exact("_s", "_n")
    return (g.select("category", "count", F.when(avg.isNull() | (avg == 0), F.lit(0.0)).otherwise(avg).alias("avg_severity"))
            .orderBy(F.desc("count"), F.asc("category")))


def completeness(spark: SparkSession, events: DataFrame) -> DataFrame:
    """One row: verification, coverage, root deviation, category balance and
    the 0..100 quality score (40/30/15/15 weights, rounded to 2).

    Two-level aggregate: (category, year) partial counts, then one global
    row; per-category totals come from a window over the small first level.
    """
    ev = _with_root(events).select("year", "category", "verified", "digital_root")
    return completeness_of(ev.groupBy(*PARTIAL_KEYS).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.coalesce(F.col("verified"), F.lit(False))).alias("_v")))


def completeness_of(parts: DataFrame) -> DataFrame:
    """``completeness`` from merged partial counts."""
    lvl1 = parts.select(*PARTIAL_KEYS, "_n", "_v")
    lvl1 = lvl1.withColumn("_cat_n", F.sum("_n").over(Window.partitionBy("category")))
    root = F.col("digital_root")  # the stored root, as the distribution reads it
    row = lvl1.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("total_events"),
        F.coalesce(F.sum("_v"), F.lit(0)).cast("long").alias("verified_events"),
        F.count_distinct("year").alias("unique_years"),
        F.count_distinct("_cat_n").alias("_distinct_counts"),
        F.count_distinct(F.coalesce(F.col("category"), F.lit("\u0000"))).alias("_n_categories"),
        *[F.coalesce(F.sum(F.when(root == i, F.col("_n"))), F.lit(0)).alias(f"_r{i}") for i in range(1, 10)],
    )
    total = F.col("total_events").cast("double")
    # sum_i |n_i - N/9| / N computed as sum_i |9 n_i - N| / (9 N): an exact
    # integer numerator, one division (the same double on any engine).
    dev_num = F.lit(0)
    for i in range(1, 10):
        dev_num = dev_num + F.abs(F.col(f"_r{i}") * 9 - F.col("total_events"))
    deviation = F.when(F.col("total_events") > 0, dev_num.cast("double") / (total * F.lit(9.0))).otherwise(F.lit(0.0))
    balance = F.when(F.col("_n_categories") > 0,
                     F.lit(1.0) - (F.col("_distinct_counts") - F.lit(1)).cast("double")
                     / F.col("_n_categories").cast("double")).otherwise(F.lit(0.0))
    vpct = F.when(F.col("total_events") > 0, F.col("verified_events") / total * F.lit(100.0)).otherwise(F.lit(0.0))
    cov = F.col("unique_years") / F.lit(float(L.EXPECTED_YEARS)) * F.lit(100.0)
    out = row.select(
        "total_events", "verified_events",
        vpct.alias("verification_rate"),
        "unique_years",
        cov.alias("coverage_percentage"),
        deviation.alias("digital_root_variance"),
        balance.alias("category_balance"),
    )
    raw = (F.col("verification_rate") / F.lit(100.0) * F.lit(40.0)
           + F.least(F.col("coverage_percentage") / F.lit(100.0), F.lit(1.0)) * F.lit(30.0)
           + F.col("category_balance") * F.lit(15.0)
           + F.greatest(F.lit(0.0), F.lit(1.0) - F.col("digital_root_variance")) * F.lit(15.0))
    return out.withColumn("quality_score_raw", raw).withColumn("data_quality_score", bround2_exact(raw))


def root_accuracy(events: DataFrame, stored_col: str = "digital_root") -> DataFrame:
    """Rows whose stored root differs from the recomputed one; accuracy %
    (100 when empty) and pass mark 99."""
    bad = F.coalesce(F.col(stored_col) != digital_root("year"), F.col(stored_col).isNull() != digital_root("year").isNull())
    g = events.agg(F.count(F.lit(1)).alias("total_events"), F.count_if(bad).alias("incorrect_digital_roots"))
    acc = F.when(F.col("total_events") > 0,
                 (F.col("total_events") - F.col("incorrect_digital_roots")).cast("double")
                 / F.col("total_events").cast("double") * F.lit(100.0)).otherwise(F.lit(100.0))
    return g.select("total_events", "incorrect_digital_roots", acc.alias("accuracy_rate")).withColumn(
        "status", F.when(F.col("accuracy_rate") >= L.ROOT_ACCURACY_PASS, "pass").otherwise("fail"))


def root_errors(events: DataFrame, stored_col: str = "digital_root", first: int = 10) -> DataFrame:
    """The first ``first`` rows (by id) whose stored root is wrong (TakeOrdered)."""
    calc = digital_root("year")
    return (events.filter(F.coalesce(F.col(stored_col) != calc, F.lit(True)))
            .select(F.col("id").alias("event_id"), "year", F.col(stored_col).alias("stored_root"),
                    calc.alias("calculated_root"))
            .orderBy("event_id").limit(first))


def report_summary(completeness_row: DataFrame, accuracy_row: DataFrame, duplicate_count: DataFrame) -> DataFrame:
    """score, total, rate, accuracy, duplicate count, pass iff score >= 80 and
    accuracy >= 99 and duplicates < 50.  Inputs are one-row frames."""
    row = combine_rows(
        completeness_row.select("data_quality_score", "total_events", "verification_rate"),
        accuracy_row.select(F.col("accuracy_rate").alias("digital_root_accuracy")),
        duplicate_count.select("duplicate_count"))
    ok = ((F.col("data_quality_score") >= L.REPORT_SCORE_PASS)
          & (F.col("digital_root_accuracy") >= L.ROOT_ACCURACY_PASS)
          & (F.col("duplicate_count") < L.REPORT_MAX_DUPLICATES))
    return row.select(F.col("data_quality_score").alias("overall_score"), "total_events", "verification_rate",
                      "digital_root_accuracy", "duplicate_count",
                      F.when(ok, "pass").otherwise("fail").alias("status"))


def collection_stats(events: DataFrame) -> DataFrame:
    """One row: totals plus category and root distributions, arrays of
    (category, count) and (digital_root, count); a null category is one too."""
    ev = _with_root(events)
    v = verification_stats(ev).select("total_events", "verified_events", "verification_rate")
    cats = category_distribution(ev).agg(
        F.sort_array(F.collect_list(F.struct("category", "count"))).alias("category_distribution"))
    roots = digital_root_distribution(ev).agg(
        F.sort_array(F.collect_list(F.struct("digital_root", "count"))).alias("digital_root_distribution"))
    return combine_rows(v, cats, roots)
