"""Registered queries: a Spark builder and (where SQL can say it) the
DuckDB oracle text for each.

Every query reads whole driver tables (through the fixture views) and
returns a DataFrame; the driver compares it with the oracle at sf0.01.
Output columns are named and typed the same on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histevents import lexicons as L
from histevents.functions import scalars as S
from histevents.operators import dedupe, detect, stats, validate
from histevents.plans import duck as D
from histevents.sources.fixtures import fixture, fixture_cte, table

AS_OF_YEAR = 2025


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None
    doc: str


QUERIES: dict[str, Query] = {}


def register(name: str, oracle: str | None):
    def deco(fn):
        QUERIES[name] = Query(name, fn, oracle.strip() if oracle else None, (fn.__doc__ or "").strip())
        return fn
    return deco


def raw_events(spark, sf):
    return fixture(spark, sf, "raw_events")


def store_view(spark, sf):
    """raw_events as stored: with the recomputed digital root."""
    return raw_events(spark, sf).withColumn("digital_root", S.digital_root("year"))


RE = fixture_cte("raw_events")
RE_ROOT = RE + f", store AS (SELECT *, {D.droot('year')} AS digital_root FROM raw_events)\n"


# ---------------------------------------------------------------- statistics

@register("digital_root_distribution", RE + f"""
SELECT CAST(r.range AS INT) AS digital_root, {D.root_meaning('r.range')} AS meaning,
       CAST(coalesce(c.n, 0) AS BIGINT) AS n_events
FROM range(1, 10) r
LEFT JOIN (SELECT {D.droot('year')} AS digital_root, COUNT(*) AS n FROM raw_events GROUP BY 1) c
  ON c.digital_root = r.range
""")
def q_digital_root_distribution(spark, sf):
    """X1 + A5 + J6 + J8: events per root 1..9 (missing -> 0) with meaning."""
    return stats.expected_root_counts(spark, raw_events(spark, sf))


@register("root_histogram", RE + f"""
SELECT {D.droot('year')} AS digital_root, COUNT(*) AS count FROM raw_events GROUP BY 1
""")
def q_root_histogram(spark, sf):
    """A5: count per stored root (including 0 for year 0)."""
    return stats.digital_root_distribution(raw_events(spark, sf))


@register("category_breakdown", RE + """
SELECT category, COUNT(*) AS count,
  CAST(coalesce(nullif(round_even(SUM(severity)::DOUBLE / nullif(COUNT(severity), 0), 2), 0), 0) AS DOUBLE)
    AS avg_severity
FROM raw_events GROUP BY category
""")
def q_category_breakdown(spark, sf):
    """A4 + A9 + X27 + O3: count and mean severity per category."""
    return stats.category_breakdown(raw_events(spark, sf))


@register("source_breakdown", RE + """
SELECT source, COUNT(*) AS count, MIN(year) AS min_year, MAX(year) AS max_year,
  CAST(CASE WHEN coalesce(MIN(year), 0) <> 0 AND coalesce(MAX(year), 0) <> 0
       THEN MAX(year) - MIN(year) + 1 ELSE 0 END AS INT) AS year_range
FROM raw_events GROUP BY source
""")
def q_source_breakdown(spark, sf):
    """A7 + O3: per source count, year span."""
    return stats.source_breakdown(raw_events(spark, sf))


@register("recent_years", RE + f"""
SELECT year, COUNT(*) AS count FROM raw_events WHERE year >= {AS_OF_YEAR - 20} GROUP BY year
""")
def q_recent_years(spark, sf):
    """F6 + A8 + O4: events per year over the last 20 years (as of 2025)."""
    return stats.recent_years(raw_events(spark, sf), AS_OF_YEAR)


@register("year_coverage", RE + f"""
SELECT nullif(MIN(year), 0) AS min_year, nullif(MAX(year), 0) AS max_year,
  COUNT(DISTINCT year) AS unique_years, {L.EXPECTED_YEARS} AS expected_years,
  COUNT(DISTINCT year) / {float(L.EXPECTED_YEARS)} * 100.0 AS coverage_percentage
FROM raw_events
""")
def q_year_coverage(spark, sf):
    """A6 + U3: min/max/distinct years and coverage percent."""
    return stats.year_coverage(raw_events(spark, sf))


@register("verification_stats", RE + """
SELECT COUNT(*) AS total_events, COUNT(*) FILTER (WHERE verified) AS verified_events,
  coalesce(COUNT(*) FILTER (WHERE verified)::DOUBLE / nullif(COUNT(*), 0), 0.0) AS verification_rate,
  coalesce(COUNT(*) FILTER (WHERE verified)::DOUBLE / nullif(COUNT(*), 0) * 100.0, 0.0) AS verification_pct
FROM raw_events
""")
def q_verification_stats(spark, sf):
    """A1 + A2 + A3 + F4: totals and verification rate."""
    return stats.verification_stats(raw_events(spark, sf))


_COMPLETENESS_SQL = RE + f""",
cat AS (SELECT category, COUNT(*) AS n FROM raw_events GROUP BY category),
roots AS (SELECT r.range AS digital_root, coalesce(c.n, 0) AS n FROM range(1, 10) r
          LEFT JOIN (SELECT {D.droot('year')} AS rt, COUNT(*) AS n FROM raw_events GROUP BY 1) c ON c.rt = r.range),
base AS (SELECT COUNT(*) AS total_events, COUNT(*) FILTER (WHERE verified) AS verified_events,
                COUNT(DISTINCT year) AS unique_years FROM raw_events),
m AS (SELECT b.*,
  CASE WHEN total_events > 0 THEN verified_events::DOUBLE / total_events * 100.0 ELSE 0.0 END AS verification_rate,
  unique_years / {float(L.EXPECTED_YEARS)} * 100.0 AS coverage_percentage,
  CASE WHEN total_events > 0 THEN CAST((SELECT SUM(abs(9 * n - total_events)) FROM roots) AS DOUBLE) / (total_events * 9.0)
       ELSE 0.0 END AS digital_root_variance,
  CASE WHEN (SELECT COUNT(*) FROM cat) > 0
       THEN 1.0 - ((SELECT COUNT(DISTINCT n) FROM cat) - 1)::DOUBLE / (SELECT COUNT(*) FROM cat)
       ELSE 0.0 END AS category_balance
  FROM base b),
s AS (SELECT *, verification_rate / 100.0 * 40.0 + least(coverage_percentage / 100.0, 1.0) * 30.0
       + category_balance * 15.0 + greatest(0.0, 1.0 - digital_root_variance) * 15.0 AS quality_score_raw FROM m)
"""


@register("quality_score", _COMPLETENESS_SQL + """
SELECT total_events, verified_events, round(verification_rate, 6) AS verification_rate, unique_years,
  round(coverage_percentage, 6) AS coverage_percentage, round(digital_root_variance, 6) AS digital_root_variance,
  round(category_balance, 6) AS category_balance, round(quality_score_raw, 6) AS quality_score_raw,
  CAST(round_even(quality_score_raw, 2) AS DOUBLE) AS data_quality_score
FROM s
""")
def q_quality_score(spark, sf):
    """A10 + A11 + A12 + A13: completeness row and 0..100 quality score."""
    c = stats.completeness(spark, raw_events(spark, sf))
    r6 = ["verification_rate", "coverage_percentage", "digital_root_variance", "category_balance",
          "quality_score_raw"]
    return c.select(*[F.round(x, 6).alias(x) if x in r6 else F.col(x) for x in c.columns])


_ONE_PASS_SUM = "CAST(year % 10 + (year // 10) % 10 + (year // 100) % 10 + (year // 1000) % 10 AS INT)"


def _one_pass_digit_sum():
    y = F.col("year")
    return (y % 10 + F.floor(y / 10) % 10 + F.floor(y / 100) % 10 + F.floor(y / 1000) % 10).cast("int")


@register("root_accuracy", RE + f"""
SELECT COUNT(*) AS total_events,
  COUNT(*) FILTER (WHERE {_ONE_PASS_SUM} <> {D.droot('year')}) AS incorrect_digital_roots,
  CASE WHEN COUNT(*) > 0 THEN (COUNT(*) - COUNT(*) FILTER (WHERE {_ONE_PASS_SUM} <> {D.droot('year')}))::DOUBLE
       / COUNT(*) * 100.0 ELSE 100.0 END AS accuracy_rate,
  CASE WHEN (CASE WHEN COUNT(*) > 0 THEN (COUNT(*) - COUNT(*) FILTER (WHERE {_ONE_PASS_SUM} <> {D.droot('year')}))::DOUBLE
       / COUNT(*) * 100.0 ELSE 100.0 END) >= 99 THEN 'pass' ELSE 'fail' END AS status
FROM raw_events
""")
def q_root_accuracy(spark, sf):
    """Stored roots (written by a single digit-sum pass) against the
    recomputed repeated digit sum."""
    ev = raw_events(spark, sf).withColumn("stored_root", _one_pass_digit_sum())
    return stats.root_accuracy(ev, "stored_root")


@register("root_errors_first10", RE + f"""
SELECT id AS event_id, year, {_ONE_PASS_SUM} AS stored_root, {D.droot('year')} AS calculated_root
FROM raw_events WHERE {_ONE_PASS_SUM} <> {D.droot('year')} ORDER BY id LIMIT 10
""")
def q_root_errors_first10(spark, sf):
    """A15 + O6: the first 10 wrong roots by id (the limit is the feature)."""
    ev = raw_events(spark, sf).withColumn("stored_root", _one_pass_digit_sum())
    return stats.root_errors(ev, "stored_root", 10)


# ---------------------------------------------------------------- filters

_EXPORT_COLS = ("id", "year", "date", "title", "description", "category", "severity", "digital_root",
                "source", "verified")


@register("events_by_year_range", RE_ROOT + """
SELECT id, year, title, category, source FROM store WHERE year BETWEEN 1900 AND 2000
""")
def q_events_by_year_range(spark, sf):
    """inclusive year range."""
    from histevents.operators.filters import by_year_range
    return by_year_range(store_view(spark, sf), 1900, 2000).select("id", "year", "title", "category", "source")


@register("events_by_digital_root", RE_ROOT + """
SELECT id, year, digital_root, title FROM store WHERE digital_root = 4
""")
def q_events_by_digital_root(spark, sf):
    """equality on the digital root."""
    from histevents.operators.filters import by_digital_root
    return by_digital_root(store_view(spark, sf), 4).select("id", "year", "digital_root", "title")


@register("events_by_category", RE_ROOT + """
SELECT id, year, category, title FROM store WHERE category = 'economic'
""")
def q_events_by_category(spark, sf):
    """equality on the category."""
    from histevents.operators.filters import by_category
    return by_category(store_view(spark, sf), "economic").select("id", "year", "category", "title")


@register("export_filtered", RE_ROOT + f"""
SELECT {', '.join(_EXPORT_COLS)} FROM store
WHERE year >= 1500 AND year <= 2025 AND category = 'political' AND verified
""")
def q_export_filtered(spark, sf):
    """F5 + P4 + K7: optional conjunctive filters and the export projection."""
    from histevents.operators.filters import export_events
    out = export_events(store_view(spark, sf), start_year=1500, end_year=2025, category="political",
                        verified_only=True)
    return out.select(*_EXPORT_COLS)


# ---------------------------------------------------------------- dedupe

_DEDUPE_SQL = RE + """,
h AS (SELECT *, md5(concat_ws('_', coalesce(CAST(year AS VARCHAR), 'None'), coalesce(title, 'None'),
                coalesce(source, 'None'))) AS event_hash FROM raw_events),
dedup AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_hash ORDER BY id) AS rn FROM h) WHERE rn = 1)
"""


@register("event_hash_dedupe", _DEDUPE_SQL + """
SELECT id, event_hash, year, title, source FROM dedup
""")
def q_event_hash_dedupe(spark, sf):
    """X4 + W3: first row per md5(year_title_source), list order = id."""
    ev = dedupe.with_event_hash(raw_events(spark, sf)).withColumn("seq", F.col("id"))
    return dedupe.first_wins_dedupe(ev, "event_hash", ["seq"]).select("id", "event_hash", "year", "title", "source")


def _dedup_events(spark, sf):
    ev = dedupe.with_event_hash(raw_events(spark, sf)).withColumn("seq", F.col("id"))
    return dedupe.first_wins_dedupe(ev, "event_hash", ["seq"])


_TRI_SQL = f""",
tri AS (SELECT id, year, title, source, {D.trigrams('title')} AS t FROM dedup)
"""


@register("near_duplicate_titles", _DEDUPE_SQL + _TRI_SQL + """
SELECT e1.id, e1.title, e1.year, e1.source, e2.id AS duplicate_id, e2.title AS duplicate_title,
       e2.source AS duplicate_source
FROM tri e1 JOIN tri e2 ON e1.year = e2.year AND e1.id < e2.id
WHERE 5 * len(list_intersect(e1.t, e2.t)) > 4 * (len(e1.t) + len(e2.t) - len(list_intersect(e1.t, e2.t)))
""")
def q_near_duplicate_titles(spark, sf):
    """J1 + X26 + O5: same-year title pairs with trigram similarity > 0.8
    (prefix-filtered set-similarity join) among the deduplicated events."""
    return dedupe.near_duplicates(_dedup_events(spark, sf))


@register("near_duplicate_count", RE + f""",
tri AS (SELECT id, year, {D.trigrams('title')} AS t FROM raw_events)
SELECT COUNT(*) AS duplicate_count
FROM tri e1 JOIN tri e2 ON e1.year = e2.year AND e1.id < e2.id
WHERE 5 * len(list_intersect(e1.t, e2.t)) > 4 * (len(e1.t) + len(e2.t) - len(list_intersect(e1.t, e2.t)))
""")
def q_near_duplicate_count(spark, sf):
    """J1 count over the whole raw table from signature-group sizes."""
    return dedupe.near_duplicate_count(raw_events(spark, sf))


# ---------------------------------------------------------------- validation

def _d_errors(with_root: bool = False, with_url_date: bool = True) -> str:
    cats = ", ".join(D.q(c) for c in L.CATEGORY_NAMES)
    parts = [f"CASE WHEN {f} IS NULL THEN 'Missing required field: {f}' END" for f in L.REQUIRED_FIELDS]
    parts += [
        f"CASE WHEN year IS NOT NULL AND NOT (year BETWEEN 1 AND 2025) "
        f"THEN 'Year ' || CAST(year AS VARCHAR) || ' outside valid range (1, 2025)' END",
        "CASE WHEN title <> '' AND NOT (length(title) BETWEEN 3 AND 500) "
        "THEN 'Title length ' || CAST(length(title) AS VARCHAR) || ' outside valid range 3-500' END",
        "CASE WHEN description <> '' AND length(description) > 5000 "
        "THEN 'Description length ' || CAST(length(description) AS VARCHAR) || ' exceeds maximum 5000' END",
        f"CASE WHEN category <> '' AND category NOT IN ({cats}) THEN 'Invalid category: ' || category END",
        "CASE WHEN severity IS NOT NULL AND severity NOT IN (5, 4, 3, 2, 1) "
        "THEN 'Invalid severity level: ' || CAST(severity AS VARCHAR) END",
    ]
    if with_root:
        parts.append("CASE WHEN digital_root IS NOT NULL AND NOT (digital_root BETWEEN 1 AND 9) "
                     "THEN 'Digital root ' || CAST(digital_root AS VARCHAR) || ' outside valid range 1-9' END")
    if with_url_date:
        parts.append(f"CASE WHEN source_url <> '' AND NOT coalesce({D.is_valid_url('source_url')}, false) "
                     f"THEN 'Invalid URL format' END")
        parts.append(f"CASE WHEN date <> '' AND NOT {D.is_valid_date('date')} THEN 'Invalid date format' END")
    return "list_filter([" + ", ".join(parts) + "], lambda x: x IS NOT NULL)"


@register("collector_valid", RE + f"""
SELECT id, coalesce(year <> 0 AND title <> '' AND category <> '' AND year BETWEEN 1 AND 2025
  AND category IN ({', '.join(D.q(c) for c in L.CATEGORY_NAMES)}) AND length(title) BETWEEN 3 AND 500, false) AS valid
FROM raw_events
""")
def q_collector_valid(spark, sf):
    """the collector's boolean validity rule."""
    ev = raw_events(spark, sf)
    return ev.select("id", validate.collector_valid(ev).alias("valid"))


@register("validator_errors", RE + f"""
SELECT id, CAST(len(e) AS INT) AS n_errors, array_to_string(e, ' | ') AS errors
FROM (SELECT id, {_d_errors()} AS e FROM raw_events)
""")
def q_validator_errors(spark, sf):
    """F11 + X20 + X21: ordered error messages per event."""
    v = validate.with_validation(raw_events(spark, sf))
    return v.select("id", F.size("errors").alias("n_errors"), F.array_join("errors", " | ").alias("errors"))


@register("batch_summary", RE + f"""
SELECT COUNT(*) AS total_events, COUNT(*) FILTER (WHERE len(e) = 0) AS valid_events,
  COUNT(*) FILTER (WHERE len(e) > 0) AS invalid_events,
  CASE WHEN COUNT(*) > 0 THEN (COUNT(*) FILTER (WHERE len(e) = 0))::DOUBLE / COUNT(*) * 100.0 ELSE 0.0 END
    AS validation_rate,
  CASE WHEN (CASE WHEN COUNT(*) > 0 THEN (COUNT(*) FILTER (WHERE len(e) = 0))::DOUBLE / COUNT(*) * 100.0
       ELSE 0.0 END) >= 95 THEN 'pass' ELSE 'fail' END AS status
FROM (SELECT id, {_d_errors()} AS e FROM raw_events)
""")
def q_batch_summary(spark, sf):
    """Totals, rate and pass/fail of a validated batch."""
    return validate.batch_summary(validate.with_validation(raw_events(spark, sf)))


@register("clean_invalid_ids", RE_ROOT + f"""
SELECT id FROM (SELECT id, {_d_errors(with_root=True, with_url_date=False)} AS e FROM store) WHERE len(e) > 0
""")
def q_clean_invalid_ids(spark, sf):
    """Ids failing the validator on the stored columns (dry run)."""
    return validate.invalid_ids(store_view(spark, sf))


@register("url_date_checks", RE + f"""
SELECT id, coalesce({D.is_valid_url('source_url')}, false) AS url_ok,
  coalesce({D.is_valid_date('date')}, false) AS date_ok FROM raw_events
""")
def q_url_date_checks(spark, sf):
    """X20 + X21: URL and date-string validity."""
    ev = raw_events(spark, sf)
    return ev.select("id", F.coalesce(S.is_valid_url("source_url"), F.lit(False)).alias("url_ok"),
                     F.coalesce(S.is_valid_date_string("date"), F.lit(False)).alias("date_ok"))


# ---------------------------------------------------------------- detectors

@register("gdp_recessions", fixture_cte("yearly_series") + f"""
SELECT CAST(year AS INT) AS year, country, value, prev, change_pct,
  'Economic recession in ' || country AS title,
  'GDP declined by ' || {D.format_1f('abs(change_pct)')} || '% in ' || country || ', indicating economic recession.'
    AS description,
  abs(change_pct) / 10.0 AS impact_score
FROM (SELECT *, (value - prev) / nullif(prev, 0) * 100.0 AS change_pct
      FROM (SELECT *, lag(value) OVER (PARTITION BY country ORDER BY year) AS prev FROM yearly_series))
WHERE value <> 0 AND prev <> 0 AND year >= 1 AND change_pct <= -2.0
""")
def q_gdp_recessions(spark, sf):
    """W1 + X23 + X24 + X25 + F10 + O1: year-on-year GDP falls of 2 % or more."""
    ys = fixture(spark, sf, "yearly_series").withColumn("indicator", F.lit(L.GDP_INDICATOR))
    ev = detect.detect_indicator_events(ys)
    return ev.select("year", "country", "value", "prev", "change_pct", "title", "description", "impact_score")


@register("indicator_events", fixture_cte("indicator_series") + f"""
SELECT CAST(year AS INT) AS year, country, indicator,
  CASE WHEN indicator = 'NY.GDP.MKTP.CD' THEN 'recession' WHEN indicator = 'FP.CPI.TOTL.ZG' THEN 'inflation'
       ELSE 'unemployment' END AS subcategory,
  CASE WHEN indicator = 'NY.GDP.MKTP.CD' THEN 'Economic recession in ' || country
       WHEN indicator = 'FP.CPI.TOTL.ZG' THEN 'High inflation in ' || country
       ELSE 'High unemployment in ' || country END AS title,
  CASE WHEN indicator = 'NY.GDP.MKTP.CD'
         THEN 'GDP declined by ' || {D.format_1f('abs(change_pct)')} || '% in ' || country || ', indicating economic recession.'
       WHEN indicator = 'FP.CPI.TOTL.ZG'
         THEN 'Inflation reached ' || {D.format_1f('value')} || '% in ' || country || ', indicating economic instability.'
       ELSE 'Unemployment reached ' || {D.format_1f('value')} || '% in ' || country || ', indicating economic distress.'
  END AS description,
  CASE WHEN indicator = 'NY.GDP.MKTP.CD' THEN abs(change_pct) / 10.0
       WHEN indicator = 'FP.CPI.TOTL.ZG' THEN value / 20.0 ELSE value / 15.0 END AS impact_score
FROM (SELECT *, (value - prev) / nullif(prev, 0) * 100.0 AS change_pct
      FROM (SELECT *, lag(value) OVER (PARTITION BY country, indicator ORDER BY year) AS prev
            FROM indicator_series))
WHERE value <> 0 AND prev <> 0 AND year >= 1
  AND ((indicator = 'NY.GDP.MKTP.CD' AND change_pct <= -2.0) OR (indicator = 'FP.CPI.TOTL.ZG' AND value >= 10.0)
       OR (indicator = 'SL.UEM.TOTL.ZS' AND value >= 8.0))
""")
def q_indicator_events(spark, sf):
    """S5 + S6 + W1 + X24: the three indicator rules over whole series."""
    ev = detect.detect_indicator_events(fixture(spark, sf, "indicator_series"))
    return ev.select("year", "country", "indicator", "subcategory", "title", "description", "impact_score")


def _month_date_spark():
    return F.concat((F.col("ym") / 100).cast("int").cast("string"), F.lit("-"),
                    F.lpad((F.col("ym") % 100).cast("string"), 2, "0"), F.lit("-01"))
_MONTH_DATE_DUCK = "CAST(ym // 100 AS VARCHAR) || '-' || lpad(CAST(ym % 100 AS VARCHAR), 2, '0') || '-01'"


@register("market_crashes", fixture_cte("monthly_series") + f""",
p AS (SELECT symbol, {_MONTH_DATE_DUCK} AS date, close FROM monthly_series),
c AS (SELECT *, (close - prev_close) / nullif(prev_close, 0) * 100.0 AS change_pct
      FROM (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY date) AS prev_close FROM p))
SELECT CAST(substr(date, 1, 4) AS INT) AS year, symbol, date, close, prev_close, change_pct,
  'Stock market crash - ' || symbol AS title,
  'Stock index ' || symbol || ' declined by ' || {D.format_1f('abs(change_pct)')} || '% in ' || substr(date, 1, 7) || '.'
    AS description,
  abs(change_pct) / 20.0 AS impact_score
FROM c WHERE change_pct <= -15.0
""")
def q_market_crashes(spark, sf):
    """S7 + W2 + X30 + O2: month-on-month falls of 15 % or more per symbol."""
    ms = fixture(spark, sf, "monthly_series").select("symbol", _month_date_spark().alias("date"), "close")
    ev = detect.detect_market_crashes(detect.monthly_points(ms))
    return ev.select("year", "symbol", "date", "close", "prev_close", "change_pct", "title", "description",
                     "impact_score")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v.build for k, v in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v.oracle for k, v in QUERIES.items() if v.oracle}


__all__ = ["QUERIES", "queries", "oracle_sql", "table"]
