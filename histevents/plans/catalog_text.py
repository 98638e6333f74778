"""Registered text-extraction queries (severity, categories, cleaning,
years, sections, sentences, field extraction, news events, keyword search)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from histevents import lexicons as L
from histevents.functions import text as T
from histevents.operators import extract
from histevents.plans import duck as D
from histevents.plans.catalog import raw_events, register
from histevents.sources import news
from histevents.sources.fixtures import fixture, fixture_cte, table

RE = fixture_cte("raw_events")
WP = fixture_cte("wiki_pages")


@register("severity_estimate", RE + f"""
SELECT id, {D.estimate_severity('title', 'description')} AS estimated_severity,
  CAST(coalesce(severity, {D.estimate_severity('title', 'description')}) AS INT) AS severity_filled
FROM raw_events
""")
def q_severity_estimate(spark, sf):
    """Keyword-tier severity, used only where severity is missing."""
    ev = raw_events(spark, sf)
    est = T.estimate_severity("title", "description")
    return ev.select("id", est.alias("estimated_severity"),
                     F.coalesce(F.col("severity"), est).cast("int").alias("severity_filled"))


@register("news_severity", RE + f"""
SELECT id, {D.news_severity('title', 'description')} AS news_severity FROM raw_events
""")
def q_news_severity(spark, sf):
    """high/medium word severity of title + text."""
    ev = raw_events(spark, sf)
    return ev.select("id", T.news_severity("title", "description").alias("news_severity"))


_LOW = D.lower_text("title", "description")


@register("categorize", RE + f"""
SELECT id, {D.categorize(_LOW)} AS wiki_category,
  {D.categorize(_LOW, L.NEWS_KEYWORDS, 'social')} AS news_category,
  CAST({' + '.join(D.count_contains(_LOW, ws) for ws in L.HISTORICAL_CATEGORIES.values())} AS INT) AS keyword_hits,
  'economic' AS economic_category
FROM raw_events
""")
def q_categorize(spark, sf):
    """X14 + X15 + X16 + A19: arg-max keyword category (earlier wins ties),
    with the encyclopaedia, news and economic rules."""
    ev = raw_events(spark, sf)
    low = T.lower_text("title", "description")
    hits = None
    for ws in L.HISTORICAL_CATEGORIES.values():
        c = T.count_contains(low, ws)
        hits = c if hits is None else hits + c
    return ev.select("id", T.categorize(low).alias("wiki_category"),
                     T.categorize(low, L.NEWS_KEYWORDS, "social").alias("news_category"),
                     hits.cast("int").alias("keyword_hits"), F.lit("economic").alias("economic_category"))


@register("clean_text_documents", f"""
SELECT doc_id, {D.clean_text('text')} AS cleaned, CAST(length({D.clean_text('text')}) AS INT) AS n_clean
FROM documents
""")
def q_clean_text_documents(spark, sf):
    """Whitespace collapse and character filter over whole documents."""
    d = table(spark, sf, "documents")
    c = T.clean_text("text")
    return d.select("doc_id", c.alias("cleaned"), F.length(c).cast("int").alias("n_clean"))


@register("first_year_documents", f"""
SELECT doc_id, {D.first_year('text')} AS first_year FROM documents
""")
def q_first_year_documents(spark, sf):
    """First standalone year number in each whole document."""
    d = table(spark, sf, "documents")
    return d.select("doc_id", T.first_year("text").alias("first_year"))


@register("nearest_year_pages", WP + f"""
SELECT page_id, CAST(1800 + (page_id % 25) * 10 AS INT) AS around_year,
  {D.nearest_year('title', 'content', '1800 + (page_id % 25) * 10')} AS year
FROM wiki_pages
""")
def q_nearest_year_pages(spark, sf):
    """Page year near a search year (title first, then nearest in text)."""
    p = fixture(spark, sf, "wiki_pages")
    around = (F.lit(1800) + (F.col("page_id") % 25) * 10).cast("int")
    return p.select("page_id", around.alias("around_year"), T.nearest_year("title", "content", around).alias("year"))


_SECTIONS_DUCK = WP + f""",
p AS (SELECT page_id, title, content, {D.section_titles('content')} AS t, {D.section_pieces('content')} AS b
      FROM wiki_pages WHERE content <> ''),
h AS (SELECT page_id, title, t, b, unnest(range(1, len(t) + 1)) AS i FROM p WHERE len(t) > 0),
sections AS (
  SELECT page_id, title AS page_title, CAST(i AS INT) AS section_idx, {D.strip_ws('t[i]')} AS section_title,
         {D.strip_ws('b[i + 1]')} AS section_body FROM h
  UNION ALL
  SELECT page_id, title, 0, 'Main content', content FROM p WHERE len(t) = 0)
"""


@register("page_sections", _SECTIONS_DUCK + """
SELECT page_id, section_idx, section_title, section_body FROM sections
WHERE section_idx = 0 OR section_body <> ''
""")
def q_page_sections(spark, sf):
    """X8: '== Header ==' sections (preamble and empty sections dropped)."""
    p = fixture(spark, sf, "wiki_pages")
    s = extract.page_sections(p, "content")
    return s.select("page_id", "section_idx", "section_title", "section_body")


_SENTENCES_DUCK = _SECTIONS_DUCK + f""",
kept AS (SELECT * FROM sections WHERE section_idx = 0 OR section_body <> ''),
sl AS (SELECT *, {D.split_sentences('section_body')} AS s FROM kept),
sentences AS (SELECT page_id, page_title, section_idx, section_title, section_body,
              CAST(unnest(range(0, len(s))) AS INT) AS sentence_idx, unnest(s) AS sentence FROM sl)
"""


@register("page_sentences", _SENTENCES_DUCK + """
SELECT page_id, section_idx, sentence_idx, sentence FROM sentences
""")
def q_page_sentences(spark, sf):
    """X9 + F8: bullet/line/sentence split of each section, length > 20."""
    p = fixture(spark, sf, "wiki_pages")
    s = extract.section_sentences(extract.page_sections(p, "content"))
    return s.select("page_id", "section_idx", "sentence_idx", "sentence")


_DOC_SENT_DUCK = f"""
WITH sl AS (SELECT doc_id, {D.split_sentences('text')} AS s FROM documents),
sentences AS (SELECT doc_id, CAST(unnest(range(0, len(s))) AS INT) AS sentence_idx, unnest(s) AS sentence FROM sl)
"""


def _doc_sentences(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", F.posexplode(T.split_sentences(F.col("text"))).alias("sentence_idx", "sentence"))


@register("document_sentences", _DOC_SENT_DUCK + """
SELECT doc_id, sentence_idx, sentence FROM sentences
""")
def q_document_sentences(spark, sf):
    """X9 over whole documents: every line and sentence of every text."""
    return _doc_sentences(spark, sf)


@register("sentence_fields", _DOC_SENT_DUCK + f""",
c AS (SELECT doc_id, sentence_idx, {D.clean_text('sentence')} AS s FROM sentences)
SELECT doc_id, sentence_idx, {D.event_title('s')} AS title, {D.extract_location('s')} AS location,
  {D.extract_participants('s')} AS participants
FROM c WHERE s <> ''
""")
def q_sentence_fields(spark, sf):
    """P6 + X10 + X11 + X12: title, location and participants of every
    cleaned document sentence."""
    s = _doc_sentences(spark, sf).withColumn("s", T.clean_text("sentence")).filter(F.col("s") != "")
    return s.select("doc_id", "sentence_idx", T.event_title("s").alias("title"),
                    T.extract_location("s").alias("location"),
                    T.extract_participants("s").alias("participants"))


@register("page_events", _SENTENCES_DUCK + f""",
cat AS (SELECT *, {D.categorize(D.lower_text('section_title', 'section_body'))} AS category FROM sentences),
c AS (SELECT *, {D.clean_text('sentence')} AS s FROM cat)
SELECT page_id, section_idx, sentence_idx, CAST(1000 + page_id % 1100 AS INT) AS year,
  {D.event_title('s')} AS title, s AS description, category, 'wikipedia' AS source,
  {D.extract_location('s')} AS location, {D.extract_participants('s')} AS participants,
  {D.extract_tags('s', 'category')} AS tags,
  {D.estimate_severity(D.event_title('s'), 's')} AS severity
FROM c WHERE s <> ''
""")
def q_page_events(spark, sf):
    """P2 + P5 + P6 + X13 + X14: page -> sections -> inferred category ->
    sentences -> event fields."""
    p = fixture(spark, sf, "wiki_pages").withColumnRenamed("content", "extract") \
        .withColumn("fullurl", F.lit(None).cast("string")) \
        .withColumn("year", (F.lit(1000) + F.col("page_id") % 1100).cast("int"))
    ev = extract.page_events(p, year_col="year")
    return ev.select("page_id", "section_idx", "sentence_idx", "year", "title", "description", "category",
                     "source", "location", "participants", F.array_join("tags", ", ").alias("tags"), "severity")


_NEWS_LO, _NEWS_HI, _NEWS_AS_OF = 1995, 2001, dt.date(2001, 12, 31)


def _keyword_hits_duck(src: str, text: str, keywords=L.NEWS_KEYWORDS) -> str:
    items = ", ".join(
        f"CASE WHEN contains({text}, {D.q(w)}) THEN {{'category': {D.q(cat)}, 'category_idx': {ci}, "
        f"'keyword': {D.q(w)}, 'keyword_idx': {k}}} END"
        for cat, ci, w, k in news.keyword_table(keywords))
    return f"SELECT *, unnest(list_filter([{items}], lambda x: x IS NOT NULL), recursive := true) FROM {src}"


def _news_sql() -> str:
    _, d_from, d_to = news.search_window(_NEWS_LO, _NEWS_HI, _NEWS_AS_OF)
    low = D.lower_text("title", "description", "content")
    return fixture_cte("news_articles") + f""",
a AS (SELECT *, {low} AS _text FROM news_articles
      WHERE substr(published_at, 1, 10) >= '{d_from}' AND substr(published_at, 1, 10) <= '{d_to}'),
h AS ({_keyword_hits_duck('a', '_text')}),
r AS (SELECT *, CAST(floor((length(_text) - length(replace(_text, keyword, ''))) / length(keyword)) AS INT)
        AS relevance FROM h),
ok AS (SELECT *, {D.description_fallback('description', 'content', 'title')} AS _full FROM r
       WHERE coalesce(title, '') <> '' AND coalesce(published_at, '') <> ''
         AND TRY_CAST(regexp_replace(published_at, 'Z$', '+00:00') AS TIMESTAMPTZ) IS NOT NULL)
SELECT article_id, keyword, category, relevance,
  CAST(substr(published_at, 1, 4) AS INT) AS year,
  {D.clean_text('title')} AS title, {D.clean_text('_full')} AS description,
  {D.news_location('title', '_full')} AS location, {D.news_participants('title', '_full')} AS participants,
  {D.news_severity('title', '_full')} AS severity
FROM ok
"""


@register("news_events", _news_sql())
def q_news_events(spark, sf):
    """S10 + S11 + P1 + X17 + X18 + X19 + X28 + J5: keyword search over the
    articles up to 30 days before the run date -> article events."""
    arts = fixture(spark, sf, "news_articles")
    ev = news.collect_news_events(spark, arts, _NEWS_LO, _NEWS_HI, _NEWS_AS_OF)
    return ev.select("article_id", "keyword", "category", "relevance", "year", "title", "description", "location", "participants", "severity")


# Search terms for the document corpus (four languages); the operator takes
# any category -> words mapping.
DOCUMENT_TERMS = {"en": ("the", "and"), "de": ("und", "der"), "fr": ("les", "des"), "es": ("los", "con")}


@register("keyword_documents_top50", f"""
WITH d AS (SELECT doc_id, {D.lower_text('text')} AS _text FROM documents),
h AS ({_keyword_hits_duck('d', '_text', DOCUMENT_TERMS)}),
r AS (SELECT *, CAST(floor((length(_text) - length(replace(_text, keyword, ''))) / length(keyword)) AS INT)
        AS relevance FROM h)
SELECT keyword, category, doc_id, relevance, CAST(hit_rank AS INT) AS hit_rank
FROM (SELECT *, row_number() OVER (PARTITION BY keyword_idx ORDER BY relevance DESC, doc_id) AS hit_rank FROM r)
WHERE hit_rank <= {L.NEWS_TOP_N}
""")
def q_keyword_documents_top50(spark, sf):
    """S10 + W4 + J5 over whole documents: per search term the 50 most
    relevant texts (term occurrence count)."""
    d = table(spark, sf, "documents").select("doc_id", F.col("text").alias("title"),
                                             F.lit(None).cast("string").alias("description"),
                                             F.lit(None).cast("string").alias("content"))
    top = news.top_hits(news.keyword_hits(d, DOCUMENT_TERMS), "doc_id", L.NEWS_TOP_N)
    return top.select("keyword", "category", "doc_id", "relevance", F.col("hit_rank").cast("int").alias("hit_rank"))
