"""Event detection in time series with window functions.

* indicator series (country, indicator, year, value): year-on-year change
  against the immediately preceding record (``lag``), then per-indicator
  rules (GDP fall <= -2 %, inflation >= 10, unemployment >= 8);
* monthly market series (symbol, date, close): month-on-month change,
  crash when <= -15 %.

The change runs over each whole series and output years are filtered after,
so the first year of a requested range still sees its predecessor.  A series
may be long: records are dealt by ranges of (series, time), and the last record
of a range is handed to the next (``lag_along``), so no task holds a series.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histevents import lexicons as L
from histevents.functions.scalars import format_1f, pct_change, year_from_date_string
from histevents.functions.text import estimate_severity
from histevents.session import staged


def filled(template: str, **values) -> Column:
    """A fixed text with columns in its {places}."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*[values[x] if i % 2 else F.lit(x) for i, x in enumerate(parts) if x])


def _ties(df: DataFrame, value: str) -> list:
    """What orders records of one date: ``seq`` if there is one, then the value."""
    return [*(["seq"] if "seq" in df.columns else []), value]


def lag_along(df: DataFrame, keys, order, value: str, out: str) -> DataFrame:
    """``df`` with ``out``, the ``value`` of the record before in its series.

    Equal to ``lag`` over (keys, order).  The records are written once, sorted
    into as many ranges as there are shuffle partitions; the window runs inside
    a range, and a series' first record in a range takes its value from the last
    record of the range before, if that is of the same series.  These last
    records, one per range, are broadcast."""
    keys, order = list(keys), list(order)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = staged(df.repartitionByRange(n, *keys, *order).withColumn("_part", F.spark_partition_id()), "series")
    w = Window.partitionBy("_part", *keys).orderBy(*order)
    own = dealt.withColumn("_first", F.row_number().over(w) == 1).withColumn(out, F.lag(value).over(w))
    # nulls come first in a range's order as they do in a struct's
    last = dealt.groupBy("_part").agg(
        F.max_by(F.struct(*keys, F.col(value).alias("_value")), F.struct(*keys, *order)).alias("_last"))
    handed = last.select("_part", F.lag("_last").over(Window.orderBy("_part")).alias("_last"))
    own = own.join(F.broadcast(handed), "_part")
    same = F.col("_first")
    for k in keys:
        same = same & F.col(f"_last.{k}").eqNullSafe(F.col(k))
    value_before = F.when(F.col("_last").isNotNull() & same, F.col("_last._value")).otherwise(F.col(out))
    return own.withColumn(out, value_before).drop("_part", "_first", "_last")


def yoy_changes(series: DataFrame, keys=("country", "indicator"), order="year", value="value") -> DataFrame:
    """Adds ``prev`` (previous record's value, even if null/0) and ``change_pct``.
    Records of the same year go by ``seq``, if there is one, and value."""
    return lag_along(series, keys, [order, *_ties(series, value)], value, "prev").withColumn(
        "change_pct", pct_change(value, "prev"))


def usable(value="value", prev="prev", year="year"):
    """Record is analysed only if value and prev are non-null and non-zero."""
    v, p = F.col(value), F.col(prev)
    return F.coalesce((v != 0) & (p != 0) & (F.col(year) >= 1), F.lit(False))


def detect_indicator_events(series: DataFrame, lo: int | None = None, hi: int | None = None) -> DataFrame:
    """Indicator series -> economic events (one per firing record)."""
    s = yoy_changes(series)
    if lo is not None:
        s = s.filter(F.col("year") >= lo)
    if hi is not None:
        s = s.filter(F.col("year") <= hi)
    s = s.filter(usable())
    ind, v, chg, c = F.col("indicator"), F.col("value"), F.col("change_pct"), F.col("country")
    gdp = (ind == L.GDP_INDICATOR) & (chg <= L.GDP_DECLINE_THRESHOLD)
    infl = (ind == L.INFLATION_INDICATOR) & (v >= L.INFLATION_SPIKE_THRESHOLD)
    unemp = (ind == L.UNEMPLOYMENT_INDICATOR) & (v >= L.UNEMPLOYMENT_RISE_THRESHOLD)
    s = s.filter(gdp | infl | unemp)
    sub = F.when(gdp, "recession").when(infl, "inflation").otherwise("unemployment")
    texts = {k: filled(t, country=c) for k, t in L.INDICATOR_TITLES.items()}
    title = F.when(gdp, texts["recession"]).when(infl, texts["inflation"]).otherwise(texts["unemployment"])
    number = format_1f(F.when(gdp, F.abs(chg)).otherwise(v))  # one formatter for all three texts
    texts = {k: filled(t, country=c, number=F.col("_number")) for k, t in L.INDICATOR_DESCRIPTIONS.items()}
    desc = F.when(gdp, texts["recession"]).when(infl, texts["inflation"]).otherwise(texts["unemployment"])
    impact = (F.when(gdp, F.abs(chg) / F.lit(10.0)).when(infl, v / F.lit(20.0)).otherwise(v / F.lit(15.0)))
    threshold = (F.when(gdp, F.lit(L.GDP_DECLINE_THRESHOLD)).when(infl, F.lit(L.INFLATION_SPIKE_THRESHOLD))
                 .otherwise(F.lit(L.UNEMPLOYMENT_RISE_THRESHOLD)))
    meta = F.create_map(
        F.lit("indicator"), ind, F.lit("value"), v.cast("string"),
        F.lit("change_percent"), F.when(gdp, chg.cast("string")),
        F.lit("threshold"), threshold.cast("string"))
    out = s.withColumn("_number", number).select(
        F.col("year").cast("int").alias("year"), title.alias("title"), desc.alias("description"),
        F.lit("economic").alias("category"), sub.alias("subcategory"), F.lit("world_bank").alias("source"),
        c.alias("location"), impact.alias("impact_score"), meta.alias("metadata"),
        "country", "indicator", "value", "prev", "change_pct")
    return out.withColumn("severity", estimate_severity("title", "description"))


def monthly_points(raw: DataFrame, lo: int | None = None, hi: int | None = None) -> DataFrame:
    """(symbol, date 'YYYY-MM-DD', close) -> adds year; range filter applied
    before differencing, as the series is requested for the range."""
    p = raw.withColumn("year", year_from_date_string("date"))
    if lo is not None:
        p = p.filter(F.col("year") >= lo)
    if hi is not None:
        p = p.filter(F.col("year") <= hi)
    return p


def detect_market_crashes(points: DataFrame, threshold: float = L.MARKET_CRASH_THRESHOLD) -> DataFrame:
    """Month-on-month fall <= threshold -> 'Stock market crash - {symbol}'."""
    s = (lag_along(points, ["symbol"], ["date", *_ties(points, "close")], "close", "prev_close")
         .withColumn("change_pct", pct_change("close", "prev_close"))
         .filter(F.col("change_pct") <= threshold))
    sym, chg = F.col("symbol"), F.col("change_pct")
    return s.select(
        F.col("year").cast("int").alias("year"),
        filled(L.CRASH_TITLE, symbol=sym).alias("title"),
        filled(L.CRASH_DESCRIPTION, symbol=sym, number=format_1f(F.abs(chg)),
               month=F.substring("date", 1, 7)).alias("description"),
        F.lit("economic").alias("category"), F.lit("market_crash").alias("subcategory"),
        F.lit("alpha_vantage").alias("source"),
        (F.abs(chg) / F.lit(20.0)).alias("impact_score"),
        F.create_map(F.lit("symbol"), sym, F.lit("decline_percent"), chg.cast("string"),
                     F.lit("date"), F.col("date"), F.lit("close_price"), F.col("close").cast("string"))
        .alias("metadata"),
        "symbol", "date", "close", "prev_close", "change_pct",
    ).withColumn("severity", estimate_severity("title", "description"))
