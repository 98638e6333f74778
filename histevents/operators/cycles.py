"""9-year cycle patterns (the declared-but-unbuilt ``cycle_patterns``
producer).  The definitions are ours:

* event_count      events of (category, digital root), valid years only;
* pattern_strength event_count * 9 / events of the category (1 = uniform);
* statistical_significance  probability that nine root counts of a uniform
  split (roots with no events count 0) differ as much as the category's: the
  chi-square statistic 9 * sum(n^2) / N - N, its tail with 8 degrees of freedom,
  times the number of categories tested (Bonferroni), 1 at most;
* start_year / end_year     first and last year of the (category, root).

Two small aggregates and a window over at most 9 rows per category; roots
absent from a category need no rows (they add nothing to sum(n^2)), so no
domain cross product is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histevents import lexicons as L
from histevents.functions.scalars import digital_root


def chi_square_tail_8(x: Column) -> Column:
    """P(chi-square with 8 degrees of freedom >= x): exp(-h) * (1 + h + h^2/2 +
    h^3/6) with h = x / 2."""
    h = x / F.lit(2.0)
    return F.exp(-h) * (F.lit(1.0) + h * (F.lit(1.0) + h / F.lit(2.0) * (F.lit(1.0) + h / F.lit(3.0))))


def cycle_patterns(events: DataFrame) -> DataFrame:
    ev = events.filter(F.col("year").between(*L.YEAR_RANGE) & F.col("category").isin(list(L.CATEGORY_NAMES)))
    ev = ev.withColumn("_root", digital_root("year"))
    g = ev.groupBy("category", F.col("_root").alias("digital_root")).agg(
        F.count(F.lit(1)).alias("event_count"), F.min("year").alias("start_year"), F.max("year").alias("end_year"))
    w = Window.partitionBy("category")
    n_cat = F.sum("event_count").over(w).cast("double")
    # sum over the nine roots of (n - E)^2 / E with E = N/9 equals
    # 9 * sum(n^2) / N - N; the integer sum of squares keeps it exact
    # (absent roots add nothing to sum(n^2)).
    sq = F.sum(F.col("event_count") * F.col("event_count")).over(w).cast("double")
    chi = F.lit(9.0) * sq / n_cat - n_cat
    # all rows: nine a category, and the categories are the names of a fixed list
    tested = F.size(F.collect_set("category").over(Window.partitionBy(F.lit(1)))).cast("double")
    return g.select(
        F.xxhash64("category", "digital_root").alias("id"),
        F.lit("9-year").alias("cycle_type"),
        F.col("digital_root").cast("int").alias("digital_root"),
        "category",
        (F.col("event_count") * F.lit(9.0) / n_cat).alias("pattern_strength"),
        F.least(F.lit(1.0), chi_square_tail_8(chi) * tested).alias("statistical_significance"),
        F.col("event_count").cast("long").alias("event_count"),
        F.col("start_year").cast("int").alias("start_year"),
        F.col("end_year").cast("int").alias("end_year"),
        F.concat(F.lit("Digital root "), F.col("digital_root").cast("string"), F.lit(" events in "),
                 F.col("category")).alias("description"),
        F.lit("pending").alias("validation_status"),
    )
