"""Validation: collector rule, ordered error arrays, batch summary, cleaning.

The error list is one ``array`` of ``when(rule_fails, message)`` in rule
order with nulls compacted away, so the order of messages is kept and the
whole check is a single narrow projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histevents import lexicons as L
from histevents.functions.scalars import is_valid_date_string, is_valid_url


def collector_valid(df: DataFrame) -> Column:
    """Collector rule: year/title/category truthy, year 1..2025, known
    category, title length 3..500.  Never null."""
    y, t, c = F.col("year"), F.col("title"), F.col("category")
    ok = ((y != 0) & (t != "") & (c != "")
          & y.between(*L.YEAR_RANGE)
          & c.isin(list(L.CATEGORY_NAMES))
          & F.length(t).between(*L.TITLE_LENGTH))
    return F.coalesce(ok, F.lit(False))


def _has(df: DataFrame, name: str) -> bool:
    return name in df.columns


def validation_errors(df: DataFrame, type_flags: dict[str, str] | None = None,
                      present: dict[str, str] | None = None) -> Column:
    """Ordered list of rule messages for each row (empty when valid).

    Rules are applied to the columns the frame has: required fields, year
    type and range, title length (if non-empty), description length,
    category, severity type and level, digital root range, URL, date.
    For untyped JSON input, ``type_flags`` maps 'year'/'severity' to a
    boolean column that is true when the raw value was an integer (the typed
    column is then null for non-integers) and ``present`` maps a field to a
    boolean column telling whether the key held a non-null value.
    """
    type_flags = type_flags or {}
    present = present or {}

    def is_present(f: str) -> Column:
        return F.col(present[f]) if f in present else F.col(f).isNotNull()

    msgs: list[Column] = []
    for f in L.REQUIRED_FIELDS:
        if _has(df, f) or f in present:
            msgs.append(F.when(~is_present(f), F.lit(f"Missing required field: {f}")))
        else:
            msgs.append(F.lit(f"Missing required field: {f}"))
    if _has(df, "year"):
        y = F.col("year")
        in_range = y.between(*L.YEAR_RANGE)
        range_msg = F.concat(F.lit("Year "), y.cast("string"), F.lit(f" outside valid range {L.YEAR_RANGE}"))
        if "year" in type_flags:
            is_int = F.col(type_flags["year"])
            msgs.append(F.when(is_present("year") & ~is_int, F.lit("Year must be an integer"))
                        .when(is_int & ~in_range, range_msg))
        else:
            msgs.append(F.when(y.isNotNull() & ~in_range, range_msg))
    if _has(df, "title"):
        t = F.col("title").cast("string")
        n = F.length(t)
        lo, hi = L.TITLE_LENGTH
        msgs.append(F.when((t != "") & ~n.between(lo, hi),
                           F.concat(F.lit("Title length "), n.cast("string"),
                                    F.lit(f" outside valid range {lo}-{hi}"))))
    if _has(df, "description"):
        d = F.col("description").cast("string")
        n = F.length(d)
        msgs.append(F.when((d != "") & (n > L.DESCRIPTION_MAX),
                           F.concat(F.lit("Description length "), n.cast("string"),
                                    F.lit(f" exceeds maximum {L.DESCRIPTION_MAX}"))))
    if _has(df, "category"):
        c = F.col("category")
        msgs.append(F.when((c != "") & ~c.isin(list(L.CATEGORY_NAMES)),
                           F.concat(F.lit("Invalid category: "), c)))
    if _has(df, "severity"):
        s = F.col("severity")
        bad_level = F.when(s.isNotNull() & ~s.isin(list(L.VALID_SEVERITY_LEVELS)),
                           F.concat(F.lit("Invalid severity level: "), s.cast("string")))
        if "severity" in type_flags:
            is_int = F.col(type_flags["severity"])
            msgs.append(F.when(is_present("severity") & ~is_int, F.lit("Severity must be an integer"))
                        .otherwise(bad_level))
        else:
            msgs.append(bad_level)
    if _has(df, "digital_root"):
        r = F.col("digital_root")
        lo, hi = L.DIGITAL_ROOT_RANGE
        shown = r.cast("string")
        if dict(df.dtypes)["digital_root"] == "double":  # of JSON: a whole number shows as one
            shown = F.when(r == F.floor(r), r.try_cast("bigint").cast("string")).otherwise(shown)
        msgs.append(F.when(r.isNotNull() & ~r.between(lo, hi),
                           F.concat(F.lit("Digital root "), shown,
                                    F.lit(f" outside valid range {lo}-{hi}"))))
    if _has(df, "source_url"):
        u = F.col("source_url")
        msgs.append(F.when((u != "") & ~F.coalesce(is_valid_url(u), F.lit(False)), F.lit("Invalid URL format")))
    if _has(df, "date"):
        d = F.col("date")
        if dict(df.dtypes)["date"] in ("timestamp", "timestamp_ntz", "date"):
            pass  # a datetime value is always valid
        else:
            msgs.append(F.when((d != "") & ~is_valid_date_string(d), F.lit("Invalid date format")))
    return F.array_compact(F.array(*msgs))


def with_validation(df: DataFrame, type_flags: dict[str, str] | None = None,
                    present: dict[str, str] | None = None) -> DataFrame:
    errs = validation_errors(df, type_flags, present)
    return df.withColumn("errors", errs).withColumn("is_valid", F.size("errors") == 0)


def batch_summary(validated: DataFrame) -> DataFrame:
    """total, valid, invalid, rate % (0 when empty) and pass iff rate >= 95."""
    g = validated.agg(F.count(F.lit(1)).alias("total_events"),
                      F.count_if(F.col("is_valid")).alias("valid_events"))
    rate = F.when(F.col("total_events") > 0,
                  F.col("valid_events") / F.col("total_events").cast("double") * F.lit(100.0)).otherwise(F.lit(0.0))
    return g.select("total_events", "valid_events",
                    (F.col("total_events") - F.col("valid_events")).alias("invalid_events"),
                    rate.alias("validation_rate")).withColumn(
        "status", F.when(F.col("validation_rate") >= L.BATCH_PASS_RATE, "pass").otherwise("fail"))


def batch_errors(validated: DataFrame, index_col: str = "seq") -> DataFrame:
    """The error list as rows: (event_index, event_title, errors)."""
    title = F.col("title").cast("string") if "title" in validated.columns else F.lit("Unknown")
    return (validated.filter(~F.col("is_valid"))
            .select(F.col(index_col).alias("event_index"), title.alias("event_title"), "errors"))


CLEAN_COLUMNS = ("id", "year", "title", "description", "category", "source", "severity", "digital_root")


def invalid_ids(store: DataFrame) -> DataFrame:
    """Ids failing the validator on the stored columns (no URL/date rules)."""
    cols = [c for c in CLEAN_COLUMNS if c in store.columns]
    proj = store.select(*cols)
    return with_validation(proj).filter(~F.col("is_valid")).select("id")


def clean_summary(store: DataFrame, dry_run: bool = True) -> DataFrame:
    """total_events, invalid_events, dry_run (ids come from ``invalid_ids``)."""
    cols = [c for c in CLEAN_COLUMNS if c in store.columns]
    v = with_validation(store.select(*cols))
    return v.agg(F.count(F.lit(1)).alias("total_events"),
                 F.count_if(~F.col("is_valid")).alias("invalid_events")).withColumn("dry_run", F.lit(dry_run))
