"""Registered source, pipeline, report, store and streaming queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from histevents import lexicons as L
from histevents.functions import scalars as S
from histevents.functions import text as T
from histevents.operators import cycles, dedupe, stats, validate
from histevents.plans import duck as D
from histevents.plans import pipeline, store
from histevents.plans.catalog import _DEDUPE_SQL, _d_errors, raw_events, register, store_view
from histevents.sources import economic, files, news, wiki
from histevents.sources.fixtures import fixture, fixture_cte, table

RE = fixture_cte("raw_events")
EP = fixture_cte("encyclopaedia_pages")

WIKI_LO, WIKI_HI = 1000, 2025
RUN_DATE = dt.date(2001, 12, 31)
_FIRST_PAGE = """firstp AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY title ORDER BY page_id) AS rn
           FROM encyclopaedia_pages) WHERE rn = 1)"""


def _pages(spark, sf):
    return fixture(spark, sf, "encyclopaedia_pages")


@register("year_page_lookup", EP + f""", {_FIRST_PAGE},
keys AS (SELECT CAST(y.range AS INT) AS year, p.idx AS pattern_idx,
                replace(p.pat, '{{}}', CAST(y.range AS VARCHAR)) AS title
         FROM range({WIKI_LO}, {WIKI_HI + 1}) y,
              (VALUES {', '.join(f"({i}, {D.q(p)})" for i, p in enumerate(L.YEAR_PAGE_PATTERNS))}) p(idx, pat))
SELECT k.year, CAST(k.pattern_idx AS INT) AS pattern_idx, k.title, f.page_id
FROM keys k JOIN firstp f ON f.title = k.title
""")
def q_year_page_lookup(spark, sf):
    """S1 + S2 + J2: every (year, title pattern) of the range matched to the
    first landed page with that title (keys side broadcast, bound 4 x years)."""
    return wiki.year_page_hits(spark, _pages(spark, sf), WIKI_LO, WIKI_HI)


_PAIRS_VALUES = ", ".join(
    f"({D.q(cat)}, {ci}, {D.q(s)}, {k})"
    for k, (cat, ci, s) in enumerate(
        (cat, ci, s) for ci, (cat, subs) in enumerate(L.WIKI_SEARCH_CATEGORIES.items()) for s in subs))
_NUM_TOKENS = ("list_distinct(list_transform(list_filter(regexp_split_to_array(concat_ws(' ', title, extract), "
               "'[^\\p{L}\\p{N}_]+'), lambda s: regexp_full_match(s, '[0-9]{1,4}')), lambda s: CAST(s AS INT)))")


@register("category_search_hits", EP + fixture_cte("category_hits").replace("WITH ", ", ", 1) + f""",
{_FIRST_PAGE},
pairs AS (SELECT * FROM (VALUES {_PAIRS_VALUES}) v(category, category_idx, subcategory, subcategory_idx)),
nums AS (SELECT title, unnest({_NUM_TOKENS}) AS year FROM firstp),
cand AS (SELECT h.subcategory_idx, h.title, h.search_rank, n.year FROM category_hits h JOIN nums n ON n.title = h.title
         WHERE n.year BETWEEN {WIKI_LO} AND {WIKI_HI})
SELECT p.category, p.subcategory, CAST(t.year AS INT) AS around_year, t.title, t.search_rank,
  {D.nearest_year('f.title', 'f.extract', 't.year')} AS resolved_year
FROM cand t JOIN pairs p ON p.subcategory_idx = t.subcategory_idx JOIN firstp f ON f.title = t.title
""")
def q_category_search_hits(spark, sf):
    """S3 + S4 + J3 + J4 + X7: per (subcategory, year) the hits whose page
    mentions the year, with the page's resolved year."""
    hits = fixture(spark, sf, "category_hits")
    pages1 = wiki.first_page_per_title(_pages(spark, sf).join(hits.select("title").distinct(), "title", "left_semi"))
    found = wiki.category_search(pages1, hits, wiki.category_pairs(spark), WIKI_LO, WIKI_HI)
    out = found.join(pages1.select("title", "extract"), "title")
    return out.select("category", "subcategory", F.col("year").cast("int").alias("around_year"), "title",
                      "search_rank",
                      T.nearest_year(F.col("title"), F.col("extract"), F.col("year")).alias("resolved_year"))


def _landed(spark, sf):
    ms = fixture(spark, sf, "monthly_series").select(
        "symbol", F.concat((F.col("ym") / 100).cast("int").cast("string"), F.lit("-"),
                           F.lpad((F.col("ym") % 100).cast("string"), 2, "0"), F.lit("-01")).alias("date"), "close")
    return pipeline.Landed(
        pages=_pages(spark, sf), hits=fixture(spark, sf, "category_hits"),
        indicators=fixture(spark, sf, "indicator_series"), market_points=ms,
        articles=fixture(spark, sf, "news_articles"), economies=None, symbols=None)


def _wiki_sql() -> str:
    pats = ", ".join(f"({i}, {D.q(p)})" for i, p in enumerate(L.YEAR_PAGE_PATTERNS))
    ny = D.nearest_year("f.title", "f.extract", "t.year")
    return EP + fixture_cte("category_hits").replace("WITH ", ", ", 1) + f""",
{_FIRST_PAGE},
keys AS (SELECT CAST(y.range AS INT) AS year, p.idx AS pattern_idx,
                replace(p.pat, '{{}}', CAST(y.range AS VARCHAR)) AS title
         FROM range({WIKI_LO}, {WIKI_HI + 1}) y, (VALUES {pats}) p(idx, pat)),
pairs AS (SELECT * FROM (VALUES {_PAIRS_VALUES}) v(category, category_idx, subcategory, subcategory_idx)),
nums AS (SELECT title, unnest({_NUM_TOKENS}) AS year FROM firstp),
cand AS (SELECT h.subcategory_idx, h.title, h.search_rank, n.year FROM category_hits h JOIN nums n ON n.title = h.title
         WHERE n.year BETWEEN {WIKI_LO} AND {WIKI_HI}),
src AS (
  SELECT f.page_id, f.title AS page_title, f.extract, k.year, CAST(NULL AS VARCHAR) AS given, 'year_page' AS path
  FROM keys k JOIN firstp f ON f.title = k.title
  UNION ALL
  SELECT f.page_id, f.title, f.extract, {ny}, p.category, 'category'
  FROM cand t JOIN pairs p ON p.subcategory_idx = t.subcategory_idx JOIN firstp f ON f.title = t.title
  WHERE {ny} IS NOT NULL),
p AS (SELECT *, {D.section_titles('extract')} AS t, {D.section_pieces('extract')} AS b FROM src WHERE extract <> ''),
h AS (SELECT *, unnest(range(1, len(t) + 1)) AS i FROM p WHERE len(t) > 0),
sections AS (
  SELECT page_id, path, year, given, CAST(i AS INT) AS section_idx, {D.strip_ws('t[i]')} AS section_title,
         {D.strip_ws('b[i + 1]')} AS section_body FROM h
  UNION ALL
  SELECT page_id, path, year, given, 0, 'Main content', extract FROM p WHERE len(t) = 0),
kept AS (SELECT *, coalesce(given, {D.categorize(D.lower_text('section_title', 'section_body'))}) AS category
         FROM sections WHERE section_idx = 0 OR section_body <> ''),
sl AS (SELECT *, {D.split_sentences('section_body')} AS s FROM kept),
sentences AS (SELECT page_id, path, year, category, section_idx,
              CAST(unnest(range(0, len(s))) AS INT) AS sentence_idx, unnest(s) AS sentence FROM sl),
c AS (SELECT *, {D.clean_text('sentence')} AS cs FROM sentences)
SELECT page_id, path, CAST(year AS INT) AS year, {D.event_title('cs')} AS title, category,
  {D.extract_location('cs')} AS location, {D.extract_participants('cs')} AS participants,
  {D.extract_tags('cs', 'category')} AS tags, {D.estimate_severity(D.event_title('cs'), 'cs')} AS severity,
  section_idx, sentence_idx
FROM c WHERE cs <> ''
"""


@register("wiki_collection", _wiki_sql())
def q_wiki_collection(spark, sf):
    """L10 + L11 (encyclopaedia): year pages and category pages -> events."""
    ev = wiki.collect_wiki_events(spark, _pages(spark, sf), fixture(spark, sf, "category_hits"), WIKI_LO, WIKI_HI)
    return ev.select("page_id", "path", "year", "title", "category", "location", "participants",
                     F.array_join("tags", ", ").alias("tags"), "severity", "section_idx", "sentence_idx")


ECON_LO, ECON_HI = 1996, 2001


def _econ_sql() -> str:
    ind = fixture_cte("indicator_series", "monthly_series")
    month = "CAST(ym // 100 AS VARCHAR) || '-' || lpad(CAST(ym % 100 AS VARCHAR), 2, '0') || '-01'"
    curated = ", ".join(f"({i}, {y}, {D.q(t)}, {D.q(d)}, {D.q(s)}, {float(imp)})"
                        for i, (y, t, d, s, imp) in enumerate(L.CURATED_ECONOMIC_EVENTS))
    ind_pos = "CASE indicator " + " ".join(f"WHEN {D.q(x)} THEN {i + 1}" for i, x in enumerate(L.WORLD_BANK_INDICATORS)) + " ELSE 0 END"
    cats = ", ".join(D.q(c) for c in L.CATEGORY_NAMES)
    return ind + f""",
ic AS (SELECT *, (value - prev) / nullif(prev, 0) * 100.0 AS change_pct
       FROM (SELECT *, lag(value) OVER (PARTITION BY country, indicator ORDER BY year) AS prev FROM indicator_series)),
iev AS (SELECT CAST(year AS INT) AS year,
  CASE WHEN indicator = 'NY.GDP.MKTP.CD' THEN 'Economic recession in ' || country
       WHEN indicator = 'FP.CPI.TOTL.ZG' THEN 'High inflation in ' || country
       ELSE 'High unemployment in ' || country END AS title,
  CASE WHEN indicator = 'NY.GDP.MKTP.CD'
         THEN 'GDP declined by ' || {D.format_1f('abs(change_pct)')} || '% in ' || country || ', indicating economic recession.'
       WHEN indicator = 'FP.CPI.TOTL.ZG'
         THEN 'Inflation reached ' || {D.format_1f('value')} || '% in ' || country || ', indicating economic instability.'
       ELSE 'Unemployment reached ' || {D.format_1f('value')} || '% in ' || country || ', indicating economic distress.'
  END AS description,
  CASE WHEN indicator = 'NY.GDP.MKTP.CD' THEN 'recession' WHEN indicator = 'FP.CPI.TOTL.ZG' THEN 'inflation'
       ELSE 'unemployment' END AS subcategory, 'world_bank' AS source,
  CASE WHEN indicator = 'NY.GDP.MKTP.CD' THEN abs(change_pct) / 10.0
       WHEN indicator = 'FP.CPI.TOTL.ZG' THEN value / 20.0 ELSE value / 15.0 END AS impact_score,
  0 AS k1, 0 AS k2, {ind_pos} AS k3, CAST(year AS BIGINT) AS k4, country AS s1, indicator AS s2
  FROM ic WHERE year BETWEEN {ECON_LO} AND {ECON_HI} AND value <> 0 AND prev <> 0 AND year >= 1
   AND ((indicator = 'NY.GDP.MKTP.CD' AND change_pct <= -2.0) OR (indicator = 'FP.CPI.TOTL.ZG' AND value >= 10.0)
        OR (indicator = 'SL.UEM.TOTL.ZS' AND value >= 8.0))),
mp AS (SELECT symbol, {month} AS date, close FROM monthly_series
       WHERE CAST(ym // 100 AS INT) BETWEEN {ECON_LO} AND {ECON_HI}),
mc AS (SELECT *, (close - prev_close) / nullif(prev_close, 0) * 100.0 AS change_pct
       FROM (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY date) AS prev_close FROM mp)),
mev AS (SELECT CAST(substr(date, 1, 4) AS INT) AS year, 'Stock market crash - ' || symbol AS title,
  'Stock index ' || symbol || ' declined by ' || {D.format_1f('abs(change_pct)')} || '% in ' || substr(date, 1, 7) || '.'
    AS description, 'market_crash' AS subcategory, 'alpha_vantage' AS source, abs(change_pct) / 20.0 AS impact_score,
  1 AS k1, 0 AS k2, 0 AS k3, CAST(0 AS BIGINT) AS k4, symbol AS s1, date AS s2
  FROM mc WHERE change_pct <= -15.0),
cur AS (SELECT year, title, description, subcategory, 'historical_database' AS source, impact_score,
  2 AS k1, idx AS k2, 0 AS k3, CAST(0 AS BIGINT) AS k4, '' AS s1, '' AS s2
  FROM (VALUES {curated}) v(idx, year, title, description, subcategory, impact_score)
  WHERE year BETWEEN {ECON_LO} AND {ECON_HI}),
u AS (SELECT * FROM iev UNION ALL SELECT * FROM mev UNION ALL SELECT * FROM cur),
h AS (SELECT *, md5(concat_ws('_', CAST(year AS VARCHAR), title, source)) AS event_hash FROM u),
d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_hash ORDER BY k1, k2, k3, k4, s1, s2) AS rn
      FROM h) WHERE rn = 1)
SELECT year, title, source, 'economic' AS category, subcategory, {D.estimate_severity('title', 'description')} AS severity,
  impact_score, {D.droot('year')} AS digital_root,
  coalesce(year <> 0 AND title <> '' AND year BETWEEN 1 AND 2025 AND 'economic' IN ({cats})
    AND length(title) BETWEEN 3 AND 500, false) AS valid
FROM d
"""


@register("economic_collection", _econ_sql())
def q_economic_collection(spark, sf):
    """L10 + L11 (economic): indicator rules, market crashes and curated rows
    for 1996..2001, first row per event hash, collector validity."""
    landed = _landed(spark, sf)
    ev = economic.collect_economic_events(spark, landed.indicators, landed.market_points, ECON_LO, ECON_HI,
                                          economies=None, symbols=None)
    ev = dedupe.with_event_hash(ev).withColumn("_seq", F.col("order_key")).drop("order_key")
    ev = dedupe.first_wins_dedupe(ev, "event_hash", ["_seq"])
    return ev.select("year", "title", "source", "category", "subcategory", "severity", "impact_score",
                     S.digital_root("year").alias("digital_root"), validate.collector_valid(ev).alias("valid"))


def _collection_sql(lo=WIKI_LO, hi=WIKI_HI, as_of=RUN_DATE, batch=50, sources=("wiki", "economic", "news")) -> str:
    """Oracle for a run of the sources over lo..hi: by default all three over
    1000..2025 (as of 2001)."""
    events = " UNION ALL ".join(f"SELECT * FROM {t}" for n, t in (
        ("wiki", "wiki_ev"), ("economic", "econ_ev"), ("news", "news_ev")) if n in sources)
    pats = ", ".join(f"({i}, {D.q(p)})" for i, p in enumerate(L.YEAR_PAGE_PATTERNS))
    ny = D.nearest_year("f.title", "f.extract", "t.year")
    month = "CAST(ym // 100 AS VARCHAR) || '-' || lpad(CAST(ym % 100 AS VARCHAR), 2, '0') || '-01'"
    curated = ", ".join(f"({i}, {y}, {D.q(t)}, {D.q(d)})" for i, (y, t, d, _s, _i) in enumerate(L.CURATED_ECONOMIC_EVENTS))
    ind_pos = "CASE indicator " + " ".join(f"WHEN {D.q(x)} THEN {i + 1}" for i, x in enumerate(L.WORLD_BANK_INDICATORS)) + " ELSE 0 END"
    cats = ", ".join(D.q(c) for c in L.CATEGORY_NAMES)
    _, d_from, d_to = news.search_window(lo, hi, as_of)
    low = D.lower_text("title", "description", "content")
    items = ", ".join(
        f"CASE WHEN contains(_text, {D.q(w)}) THEN {{'category': {D.q(cat)}, 'category_idx': {ci}, "
        f"'keyword': {D.q(w)}, 'keyword_idx': {k}}} END" for cat, ci, w, k in news.keyword_table())
    return fixture_cte("encyclopaedia_pages", "category_hits", "indicator_series", "monthly_series",
                       "news_articles") + f""",
{_FIRST_PAGE},
keys AS (SELECT CAST(y.range AS INT) AS year, p.idx AS pattern_idx,
                replace(p.pat, '{{}}', CAST(y.range AS VARCHAR)) AS title
         FROM range({lo}, {hi + 1}) y, (VALUES {pats}) p(idx, pat)),
pairs AS (SELECT * FROM (VALUES {_PAIRS_VALUES}) v(category, category_idx, subcategory, subcategory_idx)),
nums AS (SELECT title, unnest({_NUM_TOKENS}) AS year FROM firstp),
cand AS (SELECT h.subcategory_idx, h.title, h.search_rank, n.year FROM category_hits h JOIN nums n ON n.title = h.title
         WHERE n.year BETWEEN {lo} AND {hi}),
src AS (
  SELECT f.extract, k.year, CAST(NULL AS VARCHAR) AS given, k.year AS k1, 0 AS k2, k.pattern_idx AS k3, 0 AS k4
  FROM keys k JOIN firstp f ON f.title = k.title
  UNION ALL
  SELECT f.extract, {ny}, p.category, t.year, 1, t.subcategory_idx, t.search_rank
  FROM cand t JOIN pairs p ON p.subcategory_idx = t.subcategory_idx JOIN firstp f ON f.title = t.title
  WHERE {ny} IS NOT NULL),
p AS (SELECT *, {D.section_titles('extract')} AS t, {D.section_pieces('extract')} AS b FROM src WHERE extract <> ''),
h AS (SELECT *, unnest(range(1, len(t) + 1)) AS i FROM p WHERE len(t) > 0),
sections AS (
  SELECT year, given, k1, k2, k3, k4, CAST(i AS INT) AS section_idx, {D.strip_ws('t[i]')} AS section_title,
         {D.strip_ws('b[i + 1]')} AS section_body FROM h
  UNION ALL
  SELECT year, given, k1, k2, k3, k4, 0, 'Main content', extract FROM p WHERE len(t) = 0),
kept AS (SELECT *, coalesce(given, {D.categorize(D.lower_text('section_title', 'section_body'))}) AS category
         FROM sections WHERE section_idx = 0 OR section_body <> ''),
sl AS (SELECT *, {D.split_sentences('section_body')} AS s FROM kept),
sentences AS (SELECT *, CAST(unnest(range(0, len(s))) AS INT) AS sentence_idx, unnest(s) AS sentence FROM sl),
c AS (SELECT *, {D.clean_text('sentence')} AS cs FROM sentences),
wiki_ev AS (SELECT 'wikipedia' AS collector, 0 AS prio, CAST(year AS INT) AS year, {D.event_title('cs')} AS title,
  'wikipedia' AS source, category, CAST(k1 AS BIGINT) AS k1, CAST(k2 AS BIGINT) AS k2, CAST(k3 AS BIGINT) AS k3,
  CAST(k4 AS BIGINT) AS k4, CAST(section_idx AS BIGINT) AS k5, CAST(sentence_idx AS BIGINT) AS k6,
  '' AS s1, '' AS s2 FROM c WHERE cs <> ''),
ic AS (SELECT *, (value - prev) / nullif(prev, 0) * 100.0 AS change_pct
       FROM (SELECT *, lag(value) OVER (PARTITION BY country, indicator ORDER BY year) AS prev FROM indicator_series)),
iev AS (SELECT CAST(year AS INT) AS year,
  CASE WHEN indicator = 'NY.GDP.MKTP.CD' THEN 'Economic recession in ' || country
       WHEN indicator = 'FP.CPI.TOTL.ZG' THEN 'High inflation in ' || country
       ELSE 'High unemployment in ' || country END AS title, 'world_bank' AS source,
  0 AS k1, 0 AS k2, {ind_pos} AS k3, CAST(year AS BIGINT) AS k4, country AS s1, indicator AS s2
  FROM ic WHERE year BETWEEN {lo} AND {hi} AND value <> 0 AND prev <> 0 AND year >= 1
   AND ((indicator = 'NY.GDP.MKTP.CD' AND change_pct <= -2.0) OR (indicator = 'FP.CPI.TOTL.ZG' AND value >= 10.0)
        OR (indicator = 'SL.UEM.TOTL.ZS' AND value >= 8.0))),
mp AS (SELECT symbol, {month} AS date, close FROM monthly_series
  WHERE CAST(ym // 100 AS INT) BETWEEN {lo} AND {hi} AND {hi} >= {L.MARKET_MIN_END_YEAR}),
mc AS (SELECT *, (close - prev_close) / nullif(prev_close, 0) * 100.0 AS change_pct
       FROM (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY date) AS prev_close FROM mp)),
mev AS (SELECT CAST(substr(date, 1, 4) AS INT) AS year, 'Stock market crash - ' || symbol AS title,
  'alpha_vantage' AS source, 1 AS k1, 0 AS k2, 0 AS k3, CAST(0 AS BIGINT) AS k4, symbol AS s1, date AS s2
  FROM mc WHERE change_pct <= -15.0),
cur AS (SELECT year, title, 'historical_database' AS source, 2 AS k1, idx AS k2, 0 AS k3, CAST(0 AS BIGINT) AS k4,
  '' AS s1, '' AS s2 FROM (VALUES {curated}) v(idx, year, title, description) WHERE year BETWEEN {lo} AND {hi}),
econ_ev AS (SELECT 'economic' AS collector, 1 AS prio, year, title, source, 'economic' AS category,
  CAST(k1 AS BIGINT) AS k1, CAST(k2 AS BIGINT) AS k2, CAST(k3 AS BIGINT) AS k3, k4, CAST(0 AS BIGINT) AS k5,
  CAST(0 AS BIGINT) AS k6, s1, s2 FROM (SELECT * FROM iev UNION ALL SELECT * FROM mev UNION ALL SELECT * FROM cur)),
na AS (SELECT *, {low} AS _text FROM news_articles
      WHERE substr(published_at, 1, 10) >= '{d_from}' AND substr(published_at, 1, 10) <= '{d_to}'),
nh AS (SELECT *, unnest(list_filter([{items}], lambda x: x IS NOT NULL), recursive := true) FROM na),
nr AS (SELECT *, CAST(floor((length(_text) - length(replace(_text, keyword, ''))) / length(keyword)) AS INT)
        AS relevance FROM nh),
nok AS (SELECT * FROM nr WHERE coalesce(title, '') <> '' AND coalesce(published_at, '') <> ''
         AND TRY_CAST(regexp_replace(published_at, 'Z$', '+00:00') AS TIMESTAMPTZ) IS NOT NULL),
news_ev AS (SELECT 'news' AS collector, 2 AS prio, CAST(substr(published_at, 1, 4) AS INT) AS year,
  {D.clean_text('title')} AS title, 'news_api' AS source, category, CAST(category_idx AS BIGINT) AS k1,
  CAST(keyword_idx AS BIGINT) AS k2, CAST(-relevance AS BIGINT) AS k3, CAST(article_id AS BIGINT) AS k4,
  CAST(0 AS BIGINT) AS k5, CAST(0 AS BIGINT) AS k6, '' AS s1, '' AS s2 FROM nok),
u AS ({events}),
hs AS (SELECT *, md5(concat_ws('_', coalesce(CAST(year AS VARCHAR), 'None'), coalesce(title, 'None'),
       coalesce(source, 'None'))) AS event_hash FROM u),
d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_hash
       ORDER BY prio, k1, k2, k3, k4, k5, k6, s1, s2) AS rn FROM hs) WHERE rn = 1),
v AS (SELECT collector, CAST({lo} + floor((year - {lo}) / {batch}) * {batch} AS INT) AS batch_start,
  coalesce(year <> 0 AND title <> '' AND category <> '' AND year BETWEEN 1 AND 2025 AND category IN ({cats})
    AND length(title) BETWEEN 3 AND 500, false) AS valid FROM d)
SELECT collector, batch_start, COUNT(*) AS events_collected, COUNT(*) FILTER (WHERE valid) AS events_saved,
  COUNT(*) FILTER (WHERE NOT valid) AS errors,
  CASE WHEN collector IS NULL THEN 'total' WHEN batch_start IS NULL THEN 'source' ELSE 'batch' END AS level,
  CAST(NULL AS VARCHAR) AS error_message
FROM v GROUP BY ROLLUP (collector, batch_start)
"""


@register("collection_run_summary", _collection_sql())
def q_collection_run_summary(spark, sf):
    """L1 + L2 + L3 + A17 + A18 + U1: all three sources over 1000..2025, each
    staged once, global first-wins dedupe, validity, roll-up by source/batch."""
    _, summary = pipeline.run_collection(spark, _landed(spark, sf), WIKI_LO, WIKI_HI, as_of_date=RUN_DATE)
    return summary


PRESET_DATE = dt.date(1997, 6, 1)


@register("preset_historical", _collection_sql(1, L.YEAR_RANGE[1], PRESET_DATE, L.BATCH_SIZE_FULL))
def q_preset_historical(spark, sf):
    """L4: the run over all years, by source and batch of years."""
    return pipeline.collect_historical(spark, _landed(spark, sf), as_of_date=PRESET_DATE)[1]


@register("preset_sample", _collection_sql(PRESET_DATE.year - 100, PRESET_DATE.year, PRESET_DATE, L.BATCH_SIZE_SAMPLE))
def q_preset_sample(spark, sf):
    """L4: the run over the last hundred years."""
    return pipeline.collect_sample(spark, _landed(spark, sf), as_of_date=PRESET_DATE)[1]


@register("preset_recent", _collection_sql(PRESET_DATE.year - 1, PRESET_DATE.year, PRESET_DATE, L.BATCH_SIZE_RECENT, ("economic", "news")))
def q_preset_recent(spark, sf):
    """L4: news and economic events of the last and current year, year by year."""
    return pipeline.collect_recent(spark, _landed(spark, sf), as_of_date=PRESET_DATE)[1]


@register("source_rollup", _DEDUPE_SQL + f""",
v AS (SELECT source, CAST(1 + floor((year - 1) / 50) * 50 AS INT) AS batch_start,
        coalesce(year <> 0 AND title <> '' AND category <> '' AND year BETWEEN 1 AND 2025
          AND category IN ({', '.join(D.q(c) for c in L.CATEGORY_NAMES)}) AND length(title) BETWEEN 3 AND 500, false)
          AS valid FROM dedup)
SELECT source, batch_start, COUNT(*) AS events_collected, COUNT(*) FILTER (WHERE valid) AS events_saved,
  COUNT(*) FILTER (WHERE NOT valid) AS errors
FROM v GROUP BY ROLLUP (source, batch_start)
""")
def q_source_rollup(spark, sf):
    """A17 + X29 + K4 counts: deduplicated rows per source and 50-year batch
    (saved = collector-valid), with source and grand totals."""
    ev = dedupe.first_wins_dedupe(dedupe.with_event_hash(raw_events(spark, sf)).withColumn("seq", F.col("id")),
                                  "event_hash", ["seq"])
    ev = ev.withColumn("valid", validate.collector_valid(ev)).withColumn("batch_start", S.year_batch_start("year", 1, 50))
    return (ev.rollup("source", "batch_start")
            .agg(F.count(F.lit(1)).alias("events_collected"), F.count_if("valid").alias("events_saved"),
                 F.count_if(~F.col("valid")).alias("errors")))


_ONE_PASS = "CAST(year % 10 + (year // 10) % 10 + (year // 100) % 10 + (year // 1000) % 10 AS INT)"


def _stored(spark, sf):
    """The store as an older writer left it: roots from one digit-sum pass."""
    y = F.col("year")
    one_pass = (y % 10 + F.floor(y / 10) % 10 + F.floor(y / 100) % 10 + F.floor(y / 1000) % 10).cast("int")
    return raw_events(spark, sf).withColumn("digital_root", one_pass)


def _report_sql() -> str:
    return RE + f""",
store AS (SELECT *, {_ONE_PASS} AS digital_root FROM raw_events),
cat AS (SELECT category, COUNT(*) AS n FROM store GROUP BY category),
roots AS (SELECT r.range AS digital_root, coalesce(c.n, 0) AS n FROM range(1, 10) r
          LEFT JOIN (SELECT digital_root AS rt, COUNT(*) AS n FROM store GROUP BY 1) c ON c.rt = r.range),
base AS (SELECT COUNT(*) AS total_events, COUNT(*) FILTER (WHERE verified) AS verified_events,
                COUNT(DISTINCT year) AS unique_years,
                COUNT(*) FILTER (WHERE digital_root <> {D.droot('year')}) AS bad_roots FROM store),
m AS (SELECT b.*,
  CASE WHEN total_events > 0 THEN verified_events::DOUBLE / total_events * 100.0 ELSE 0.0 END AS verification_rate,
  unique_years / {float(L.EXPECTED_YEARS)} * 100.0 AS coverage_percentage,
  CASE WHEN total_events > 0 THEN CAST((SELECT SUM(abs(9 * n - total_events)) FROM roots) AS DOUBLE) / (total_events * 9.0)
       ELSE 0.0 END AS digital_root_variance,
  CASE WHEN (SELECT COUNT(*) FROM cat) > 0
       THEN 1.0 - ((SELECT COUNT(DISTINCT n) FROM cat) - 1)::DOUBLE / (SELECT COUNT(*) FROM cat)
       ELSE 0.0 END AS category_balance,
  CASE WHEN total_events > 0 THEN (total_events - bad_roots)::DOUBLE / total_events * 100.0 ELSE 100.0 END
    AS digital_root_accuracy
  FROM base b),
s AS (SELECT *, round_even(verification_rate / 100.0 * 40.0 + least(coverage_percentage / 100.0, 1.0) * 30.0
       + category_balance * 15.0 + greatest(0.0, 1.0 - digital_root_variance) * 15.0, 2) AS overall_score FROM m),
tri AS (SELECT id, year, {D.trigrams('title')} AS t FROM store),
dup AS (SELECT COUNT(*) AS duplicate_count FROM tri e1 JOIN tri e2 ON e1.year = e2.year AND e1.id < e2.id
        WHERE 5 * len(list_intersect(e1.t, e2.t)) > 4 * (len(e1.t) + len(e2.t) - len(list_intersect(e1.t, e2.t))))
SELECT CAST(overall_score AS DOUBLE) AS overall_score, total_events, round(verification_rate, 6) AS verification_rate,
  round(digital_root_accuracy, 6) AS digital_root_accuracy, duplicate_count,
  CASE WHEN overall_score >= 80 AND digital_root_accuracy >= 99 AND duplicate_count < 50 THEN 'pass' ELSE 'fail' END
    AS status
FROM s, dup
"""


@register("validation_report", _report_sql())
def q_validation_report(spark, sf):
    """L7 + A20 (with A10-A13, A15, J1): completeness score, stored-root
    accuracy and near-duplicate count over the whole store -> pass/fail."""
    st = _stored(spark, sf)
    rep = stats.report_summary(stats.completeness(spark, st), stats.root_accuracy(st, "digital_root"),
                               dedupe.near_duplicate_count(st))
    return rep.select("overall_score", "total_events", F.round("verification_rate", 6).alias("verification_rate"),
                      F.round("digital_root_accuracy", 6).alias("digital_root_accuracy"), "duplicate_count", "status")


@register("json_props", """
SELECT event_type, COUNT(*) AS n_events, COUNT(CAST(json_extract(props, '$.k') AS INTEGER)) AS n_with_k,
  CAST(SUM(CAST(json_extract(props, '$.k') AS INTEGER)) AS BIGINT) AS sum_k, MIN(CAST(json_extract(props, '$.k') AS INTEGER)) AS min_k,
  MAX(CAST(json_extract(props, '$.k') AS INTEGER)) AS max_k
FROM events GROUP BY event_type
""")
def q_json_props(spark, sf):
    """JSON payload parsing via VARIANT: per event type, the integer ``k``."""
    ev = table(spark, sf, "events")
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "int")
    return ev.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_events"), F.count(k).alias("n_with_k"),
                                        F.sum(k).alias("sum_k"), F.min(k).alias("min_k"), F.max(k).alias("max_k"))


@register("json_event_validation", RE + f"""
SELECT id, CAST(len(e) AS INT) AS n_errors, array_to_string(e, ' | ') AS errors
FROM (SELECT id, {_d_errors()} AS e FROM raw_events)
""")
def q_json_event_validation(spark, sf):
    """S12 + L9: events landed as JSON text, parsed as VARIANT with type
    flags, validated with the type-aware rules."""
    ev = raw_events(spark, sf)
    as_json = ev.select("id", F.to_json(F.struct(*[c for c in ev.columns if c != "verified"])).alias("json"))
    typed = files.typed_events(as_json.select("id", F.try_parse_json("json").alias("v")))
    v = files.validate_typed(typed)
    return v.select("id", F.size("errors").alias("n_errors"), F.array_join("errors", " | ").alias("errors"))


@register("verify_update", RE + """
SELECT source, COUNT(*) AS n_events,
  COUNT(*) FILTER (WHERE CASE WHEN source = 'historical_database' AND year BETWEEN 1900 AND 2000 THEN true
                         ELSE verified END) AS n_verified
FROM raw_events GROUP BY source
""")
def q_verify_update(spark, sf):
    """K8 + J7: set ``verified`` for an id set (curated rows of 1900..2000)
    with a left join; per-source verified counts after the update."""
    ev = raw_events(spark, sf)
    ids = ev.filter((F.col("source") == "historical_database") & F.col("year").between(1900, 2000)) \
        .select("id", F.lit(True).alias("verified"))
    out = store.apply_verification(ev, ids)
    return out.groupBy("source").agg(F.count(F.lit(1)).alias("n_events"), F.count_if("verified").alias("n_verified"))


@register("delete_invalid", fixture_cte("raw_events") + f""",
store AS (SELECT *, {D.droot('year')} AS digital_root FROM raw_events),
bad AS (SELECT id FROM (SELECT id, {_d_errors(with_root=True, with_url_date=False)} AS e FROM store) WHERE len(e) > 0)
SELECT category, COUNT(*) AS n_remaining FROM store WHERE id NOT IN (SELECT id FROM bad) GROUP BY category
""")
def q_delete_invalid(spark, sf):
    """L8 + K9 + J7: remove the invalid ids (left anti join); remaining rows
    per category."""
    st = store_view(spark, sf)
    kept = store.remove_ids(st, validate.invalid_ids(st))
    return kept.groupBy("category").agg(F.count(F.lit(1)).alias("n_remaining"))


@register("cycle_patterns", RE + f""",
ev AS (SELECT category, year, {D.droot('year')} AS digital_root FROM raw_events
       WHERE year BETWEEN 1 AND 2025 AND category IN ({', '.join(D.q(c) for c in L.CATEGORY_NAMES)})),
g AS (SELECT category, digital_root, COUNT(*) AS event_count, MIN(year) AS start_year, MAX(year) AS end_year
      FROM ev GROUP BY category, digital_root),
w AS (SELECT *, SUM(event_count) OVER (PARTITION BY category)::DOUBLE AS n_cat,
             (9.0 * SUM(event_count * event_count) OVER (PARTITION BY category)::DOUBLE
               / SUM(event_count) OVER (PARTITION BY category)::DOUBLE
               - SUM(event_count) OVER (PARTITION BY category)::DOUBLE) / 2 AS h FROM g)
SELECT '9-year' AS cycle_type, digital_root, category, round(event_count * 9.0 / n_cat, 9) AS pattern_strength,
  round(least(1.0, exp(-h) * (1 + h + h * h / 2 + h * h * h / 6) * (SELECT COUNT(DISTINCT category) FROM g)), 9)
    AS statistical_significance,
  event_count, start_year, end_year, 'Digital root ' || CAST(digital_root AS VARCHAR) || ' events in ' || category
    AS description, 'pending' AS validation_status
FROM w
""")
def q_cycle_patterns(spark, sf):
    """Z1 (our definition): per (category, root) count, strength and the
    category's chi-square significance against a uniform split of the nine
    roots, corrected for the number of categories."""
    c = cycles.cycle_patterns(raw_events(spark, sf)).drop("id")
    return c.withColumn("pattern_strength", F.round("pattern_strength", 9)) \
        .withColumn("statistical_significance", F.round("statistical_significance", 9))


@register("collection_stats", RE + f"""
SELECT 'total' AS kind, NULL AS key, COUNT(*) AS count FROM raw_events
UNION ALL SELECT 'verified', NULL, COUNT(*) FILTER (WHERE verified) FROM raw_events
UNION ALL SELECT 'category', category, COUNT(*) FROM raw_events GROUP BY category
UNION ALL SELECT 'digital_root', CAST({D.droot('year')} AS VARCHAR), COUNT(*) FROM raw_events GROUP BY 2
""")
def q_collection_stats(spark, sf):
    """A16 + D3: totals and true per-group counts (category, root) as rows."""
    s = stats.collection_stats(raw_events(spark, sf))
    tot = s.select(F.lit("total").alias("kind"), F.lit(None).cast("string").alias("key"),
                   F.col("total_events").alias("count"))
    ver = s.select(F.lit("verified").alias("kind"), F.lit(None).cast("string").alias("key"),
                   F.col("verified_events").alias("count"))
    cat = s.select(F.lit("category").alias("kind"), F.inline("category_distribution").alias("key", "count"))
    rt = s.select(F.lit("digital_root").alias("kind"), F.inline("digital_root_distribution").alias("key", "count"))
    rt = rt.withColumn("key", F.col("key").cast("string"))
    return tot.unionByName(ver).unionByName(cat).unionByName(rt)


