"""News source: landed articles -> keyword hits -> events.

Keyword search is a projection, not a join: each article gets the array of
(category, keyword) pairs whose keyword occurs in its text (37 unrolled
``contains`` tests), which is exploded.  A limit per keyword (``top_n``) and
the five years that a web service looks back (``window_years``) are parameters,
off by default.  With a limit, (keyword, relevance, id) alone is ranked, first
in slices of each keyword and then among the slices' best, and the articles'
texts are joined to what is left.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from histevents import lexicons as L
from histevents.functions.text import lower_text
from histevents.operators.extract import article_events
from histevents.schema import ARTICLE_SCHEMA, order_key


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """Landed article payloads: JSON lines of ``{"articles": [...]}`` pages.
    The article id is a hash of url, timestamp and title (stable across
    re-reads and repartitioning)."""
    schema = T_.StructType([T_.StructField("articles", T_.ArrayType(ARTICLE_SCHEMA))])
    a = spark.read.schema(schema).json(path).select(F.explode("articles").alias("a"))
    return a.select(
        F.xxhash64("a.url", "a.publishedAt", "a.title").alias("article_id"),
        F.col("a.title").alias("title"), F.col("a.description").alias("description"),
        F.col("a.content").alias("content"), F.col("a.url").alias("url"),
        F.col("a.publishedAt").alias("published_at"),
        F.col("a.source.name").alias("source_name"))


def keyword_table(keywords=L.NEWS_KEYWORDS) -> list[tuple[str, int, str, int]]:
    out, k = [], 0
    for ci, (cat, words) in enumerate(keywords.items()):
        for w in words:
            out.append((cat, ci, w, k))
            k += 1
    return out


def _hits_of(articles: DataFrame, keywords) -> DataFrame:
    """``articles`` with ``_text`` (lower-cased) and ``_hits``, its keywords."""
    text = F.col("_text")
    entries = [F.when(text.contains(w), F.struct(F.lit(cat).alias("category"), F.lit(ci).alias("category_idx"),
                                                 F.lit(w).alias("keyword"), F.lit(k).alias("keyword_idx")))
               for cat, ci, w, k in keyword_table(keywords)]
    return (articles.withColumn("_text", lower_text("title", "description", "content"))
            .withColumn("_hits", F.array_compact(F.array(*entries))))


def _relevance():
    """How often the hit's keyword occurs in the text."""
    kw = F.col("_hit.keyword")
    left = F.length(F.replace(F.col("_text"), kw, F.lit("")))
    return F.floor((F.length("_text") - left) / F.length(kw)).cast("int").alias("relevance")


def keyword_hits(articles: DataFrame, keywords=L.NEWS_KEYWORDS) -> DataFrame:
    """(article..., category, keyword, keyword_idx, relevance): one row per
    keyword contained in lower(title + description + content)."""
    hits = _hits_of(articles, keywords).withColumn("_hit", F.explode("_hits"))
    return hits.select(*articles.columns, "_hit.*", _relevance())


def search_window(lo: int, hi: int, as_of_date: _dt.date, window_years: int | None = None,
                  delay_days: int = L.NEWS_DELAY_DAYS):
    """(start_year, from_date, to_date) or None when empty: up to ``delay_days``
    before the run date, and no further back than ``window_years``, if given."""
    start = lo if window_years is None else max(lo, as_of_date.year - window_years)
    if start > hi:
        return None
    latest = (as_of_date - _dt.timedelta(days=delay_days)).isoformat()
    return start, f"{start:04d}-01-01", min(f"{hi:04d}-12-31", latest)


SLICES = 64


def top_hits(hits: DataFrame, id_col: str, top_n: int, slices: int = SLICES) -> DataFrame:
    """The keyword, relevance and id of the ``hits`` of rank (``hit_rank``) up to
    ``top_n`` in their keyword, by relevance and id.

    Two levels, so that a keyword with a third of all hits isn't ranked in one
    task: the best of each slice, then the best of these.  Texts take no part;
    a caller that wants them joins them to what is left, by id."""
    best = [F.desc("relevance"), F.asc(id_col)]
    of_keyword = [c for c in ("category", "category_idx", "keyword", "keyword_idx") if c in hits.columns]
    narrow = hits.select(*of_keyword, "relevance", id_col).withColumn(
        "_slice", F.pmod(F.xxhash64(id_col), F.lit(slices)))
    inner = Window.partitionBy("keyword_idx", "_slice").orderBy(*best)
    narrow = narrow.withColumn("_r", F.row_number().over(inner)).filter(F.col("_r") <= top_n)
    rank = F.row_number().over(Window.partitionBy("keyword_idx").orderBy(*best))
    return narrow.withColumn("hit_rank", rank).filter(F.col("hit_rank") <= top_n).drop("_slice", "_r")


def in_window(articles: DataFrame, lo: int, hi: int, as_of_date: _dt.date, window_years: int | None = None) -> DataFrame:
    """The articles of the search window."""
    win = search_window(lo, hi, as_of_date, window_years)
    if win is None:
        return articles.filter(F.lit(False))
    _, d_from, d_to = win
    day = F.substring("published_at", 1, 10)
    return articles.filter((day >= d_from) & (day <= d_to))


def search_articles(articles: DataFrame, lo: int, hi: int, as_of_date: _dt.date, keywords=L.NEWS_KEYWORDS,
                    top_n: int | None = None, window_years: int | None = None) -> DataFrame:
    """Per keyword the articles of the date window that hold it."""
    found = in_window(articles, lo, hi, as_of_date, window_years)
    hits = keyword_hits(found, keywords)
    return hits if top_n is None else found.join(top_hits(hits, "article_id", top_n), "article_id")


def collect_news_events(spark: SparkSession, articles: DataFrame, lo: int, hi: int, as_of_date: _dt.date,
                        enabled: bool = True, top_n: int | None = None, window_years: int | None = None) -> DataFrame:
    """S11 + P1: keyword hits -> events in (category, keyword, relevance, article) order.

    An article's fields are parsed once, whatever number of keywords it holds."""
    arts = in_window(articles, lo, hi, as_of_date, window_years)
    if not enabled:
        arts = arts.filter(F.lit(False))
    if top_n is not None:
        ev = article_events(arts.join(top_hits(keyword_hits(arts), "article_id", top_n), "article_id"), "category")
    else:
        found = _hits_of(arts, L.NEWS_KEYWORDS).filter(F.size("_hits") > 0)
        parsed = article_events(found.withColumn("_none", F.lit(None).cast("string")), "_none").drop("category")
        ev = parsed.withColumn("_hit", F.explode("_hits")).select(
            *[c for c in parsed.columns if c not in ("_text", "_hits")], "_hit.*", _relevance())
    return ev.withColumn("order_key", order_key(F.col("category_idx"), F.col("keyword_idx"), -F.col("relevance"),
                                                F.col("article_id")))
