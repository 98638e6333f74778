"""Encyclopaedia source: landed page payloads -> events.

Landed inputs
-------------
pages   (title, extract, fullurl[, page_id]) -- one row per fetched page, or
        the raw API responses read with ``read_page_responses``.
hits    (subcategory, title, search_rank) -- category search results.

Year pages: every year of the range is paired with the four title patterns
(at most 4 x years rows, a fixed bound, so broadcast) and pages are filtered
by these titles before anything is grouped.  Category pages: a page qualifies
for a year when the year number occurs in its title or text, and its event
year is resolved from the page (nearest year within 50).  ``every`` and
``top_n`` repeat the request limits of a web service (each tenth year, 20 hits
per search); by default no year is skipped and no hit is cut.  Texts stay where
they are until it is known which pages are wanted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from histevents import lexicons as L
from histevents.functions import text as T
from histevents.operators.extract import page_events
from histevents.schema import WIKI_QUERY_RESPONSE_SCHEMA, order_key

NUMBER_TOKEN = r"(?<![\p{L}\p{N}_])([0-9]{1,4})(?![\p{L}\p{N}_])"


def read_page_responses(spark: SparkSession, path: str) -> DataFrame:
    """API responses (JSON lines, ``query.pages`` map keyed by page id):
    missing pages (id '-1') and broken lines (``broken_responses``) dropped."""
    schema = StructType([*WIKI_QUERY_RESPONSE_SCHEMA.fields, StructField("_broken", StringType())])
    raw = spark.read.schema(schema).option("columnNameOfCorruptRecord", "_broken").json(path)
    return (raw.filter(F.col("_broken").isNull())
            .select(F.explode("query.pages").alias("page_id", "p"))
            .filter(F.col("page_id") != "-1")
            .select(F.col("page_id"), "p.title", "p.extract", "p.fullurl"))


def broken_responses(spark: SparkSession, path: str) -> DataFrame:
    """(value): the lines that are no whole JSON document, such as cut-off ones."""
    return spark.read.text(path).filter((F.trim("value") != "") & F.try_parse_json("value").isNull())


def first_page_per_title(pages: DataFrame) -> DataFrame:
    """One page per title (the lookup returns the first existing page).

    Only (title, page_id) is grouped; the texts come with a join on both, of
    the pages that were found.  Without a page_id the rows themselves decide."""
    if "page_id" not in pages.columns:
        rest = [c for c in pages.columns if c != "title"]
        best = pages.groupBy("title").agg(F.min(F.struct(*rest)).alias("_p"))
        return best.select("title", "_p.*").select(*pages.columns)
    found = pages.join(first_page_ids(pages), ["title", "page_id"], "left_semi")
    rest = [c for c in pages.columns if c not in ("title", "page_id")]
    best = found.groupBy("title", "page_id").agg(F.min(F.struct(*rest)).alias("_p"))
    return best.select("title", "page_id", "_p.*").select(*pages.columns)


def first_page_ids(pages: DataFrame) -> DataFrame:
    """(title, page_id): the first page of each title, without its text."""
    return pages.groupBy("title").agg(F.min("page_id").alias("page_id"))


def year_page_hits(spark: SparkSession, pages: DataFrame, lo: int, hi: int) -> DataFrame:
    """(year, pattern_idx, title, page_id) of the year pages that exist: the
    scan is filtered by the broadcast titles, and what is grouped is the ids
    of the pages left."""
    keys = F.broadcast(year_page_keys(spark, lo, hi))
    ids = first_page_ids(pages.select("title", "page_id").join(keys, "title", "left_semi"))
    return ids.join(keys, "title").select("year", "pattern_idx", "title", "page_id")


def year_page_keys(spark: SparkSession, lo: int, hi: int, patterns=L.YEAR_PAGE_PATTERNS) -> DataFrame:
    """(year, pattern_idx, title) for every year in [lo, hi] and pattern."""
    years = spark.range(lo, hi + 1).select(F.col("id").cast("int").alias("year"))
    pats = F.array(*[F.lit(p) for p in patterns])
    return (years.select("year", F.posexplode(pats).alias("pattern_idx", "pattern"))
            .select("year", "pattern_idx",
                    F.replace(F.col("pattern"), F.lit("{}"), F.col("year").cast("string")).alias("title")))


def year_page_events(spark: SparkSession, pages: DataFrame, lo: int, hi: int) -> DataFrame:
    """Events from year pages; year = the requested year."""
    keys = F.broadcast(year_page_keys(spark, lo, hi))
    wanted = first_page_per_title(pages.join(keys, "title", "left_semi"))
    matched = wanted.join(keys, "title")
    return page_events(matched, year_col="year").withColumn("path", F.lit("year_page"))


def category_pairs(spark: SparkSession, search=L.WIKI_SEARCH_CATEGORIES) -> DataFrame:
    """(category, category_idx, subcategory, subcategory_idx) in declared order."""
    rows, k = [], 0
    for ci, (cat, subs) in enumerate(search.items()):
        for s in subs:
            rows.append((cat, ci, s, k))
            k += 1
    schema = "category string, category_idx int, subcategory string, subcategory_idx int"
    return spark.createDataFrame(rows, schema)


def mentioned_years(pages: DataFrame) -> DataFrame:
    """(title, year) for every distinct standalone number in title or text."""
    nums = F.array_distinct(F.transform(
        F.regexp_extract_all(F.concat_ws(" ", F.col("title"), F.col("extract")), F.lit(NUMBER_TOKEN), 1),
        lambda s: s.cast("int")))
    return pages.select("title", F.explode(nums).alias("year"))


def category_search(pages: DataFrame, hits: DataFrame, pairs: DataFrame, lo: int, hi: int,
                    every: int = 1, top_n: int | None = None) -> DataFrame:
    """S3: per (subcategory, year) the hits whose page (one per title) mentions
    the year; every ``every``-th year, and the first ``top_n`` by rank if given."""
    years = mentioned_years(pages).filter((F.col("year") % every == 0) & F.col("year").between(lo, hi))
    cand = hits.join(years, "title").join(F.broadcast(pairs), "subcategory_idx")
    if top_n is None:
        return cand
    w = Window.partitionBy("subcategory_idx", "year").orderBy("search_rank", "title")
    return cand.withColumn("hit_rank", F.row_number().over(w)).filter(F.col("hit_rank") <= top_n).drop("hit_rank")


def category_page_events(spark: SparkSession, pages: DataFrame, hits: DataFrame, lo: int, hi: int,
                         every: int = 1, top_n: int | None = None) -> DataFrame:
    """Category hits -> page -> resolved year (within 50) -> events with
    the searched category.

    A page is hit by many searches and years: its sentences are parsed once,
    and the hits, without texts, are joined to them."""
    wanted = pages.join(hits.select("title").distinct(), "title", "left_semi")
    pages1 = first_page_per_title(wanted)
    found = category_search(pages1, hits, category_pairs(spark), lo, hi, every, top_n).withColumnRenamed("year", "around_year")
    resolved = found.select("title", "around_year").distinct().join(pages1, "title").select(
        "title", "around_year", T.nearest_year(F.col("title"), F.col("extract"), F.col("around_year")).alias("year")
    ).filter(F.col("year").isNotNull())
    found = found.join(resolved, ["title", "around_year"]).withColumnRenamed("title", "_page")
    parsed = page_events(pages1.withColumn("_page", F.col("title")).withColumn("year", F.lit(0)), year_col="year")
    ev = parsed.drop("year", "category", "tags").join(found, "_page").drop("_page")
    return (ev.withColumn("tags", T.extract_tags(F.col("description"), F.col("category")))
            .withColumn("year", F.col("year").cast("int")).withColumn("path", F.lit("category")))


def collect_wiki_events(spark: SparkSession, pages: DataFrame, hits: DataFrame | None, lo: int, hi: int) -> DataFrame:
    """L10 (encyclopaedia): year-page events then category events, with an
    ordering key (year, path, pattern/subcategory, hit, section, sentence)."""
    yp = year_page_events(spark, pages, lo, hi)
    yp = yp.withColumn("_k1", F.col("year")).withColumn("_k2", F.lit(0)) \
        .withColumn("_k3", F.col("pattern_idx")).withColumn("_k4", F.lit(0))
    out = yp
    if hits is not None:
        cp = category_page_events(spark, pages, hits, lo, hi)
        cp = cp.withColumn("_k1", F.col("around_year")).withColumn("_k2", F.lit(1)) \
            .withColumn("_k3", F.col("subcategory_idx")).withColumn("_k4", F.col("search_rank"))
        out = yp.unionByName(cp, allowMissingColumns=True)
    order = order_key(F.col("_k1"), F.col("_k2"), F.col("_k3"), F.col("_k4"), F.col("section_idx"),
                      F.col("sentence_idx"))
    return out.withColumn("order_key", order).drop("_k1", "_k2", "_k3", "_k4")
