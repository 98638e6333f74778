"""Turn text payloads into event rows.

* pages: sections (``posexplode``) -> sentences (``posexplode``) -> parsed
  fields; one row per event, all native expressions;
* articles: one event per (article, category), fields computed on the raw
  text, title/description cleaned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histevents.functions import scalars as S
from histevents.functions import text as T


def page_sections(pages: DataFrame, content_col: str = "extract") -> DataFrame:
    """One row per kept section: adds section_idx, section_title, section_body."""
    return (pages.select("*", F.explode(T.split_sections(F.col(content_col))).alias("_s"))
            .select(*[F.col(c) for c in pages.columns],
                    F.col("_s.idx").alias("section_idx"), F.col("_s.title").alias("section_title"),
                    F.col("_s.body").alias("section_body")))


def section_sentences(sections: DataFrame) -> DataFrame:
    """One row per candidate sentence: adds sentence_idx (0-based), sentence."""
    return (sections.select("*", F.posexplode(T.split_sentences(F.col("section_body")))
                            .alias("sentence_idx", "sentence")))


def parse_sentence_fields(df: DataFrame, sentence_col: str = "sentence", category_col: str = "category") -> DataFrame:
    """Clean the sentence, drop empty ones, add title/description/location/
    participants/tags computed on the cleaned sentence."""
    clean = T.clean_text(F.col(sentence_col))
    out = df.withColumn("_clean", clean).filter(F.col("_clean") != "")
    return (out.withColumn("title", T.event_title(F.col("_clean")))
            .withColumn("description", F.col("_clean"))
            .withColumn("location", T.extract_location(F.col("_clean")))
            .withColumn("participants", T.extract_participants(F.col("_clean")))
            .withColumn("tags", T.extract_tags(F.col("_clean"), F.col(category_col)))
            .drop("_clean"))


def page_events(pages: DataFrame, year_col: str = "year", category_col: str | None = None,
                content_col: str = "extract", title_col: str = "title", url_col: str = "fullurl") -> DataFrame:
    """Encyclopaedia page rows (+ requested year, optional given category) ->
    event rows.  A missing category is inferred per section from its title
    and body."""
    secs = page_sections(pages, content_col)
    # the key is materialised first so the category lookup reads a column
    secs = secs.withColumn("_cat_key", T.categorize_key(T.lower_text(F.col("section_title"), F.col("section_body"))))
    inferred = T.category_from_key(F.col("_cat_key"))
    cat = F.coalesce(F.col(category_col), inferred) if category_col else inferred
    secs = secs.withColumn("_category", cat).drop("_cat_key")
    sents = section_sentences(secs)
    ev = parse_sentence_fields(sents, "sentence", "_category")
    meta = F.create_map(F.lit("wikipedia_page"), F.col(title_col), F.lit("section"), F.col("section_title"),
                        F.lit("extraction_method"), F.lit("page_parsing"))
    return ev.select(
        *[F.col(c) for c in pages.columns if c not in ("title", "description", "category", "year", year_col)],
        F.col(year_col).cast("int").alias("year"),
        F.col("title"), F.col("description"), F.col("_category").alias("category"),
        F.lit("wikipedia").alias("source"), F.col(url_col).alias("source_url"),
        "location", "participants", "tags", meta.alias("metadata"),
        "section_idx", "section_title", "sentence_idx",
    ).withColumn("severity", T.estimate_severity("title", "description"))


def article_events(articles: DataFrame, category_col: str = "category") -> DataFrame:
    """News article rows (title, description, content, url, published_at,
    source_name, category) -> event rows.  Articles without title or
    timestamp, or with an unparsable timestamp, give no event."""
    a = articles.filter((F.coalesce(F.col("title"), F.lit("")) != "")
                        & (F.coalesce(F.col("published_at"), F.lit("")) != ""))
    a = a.withColumn("year", S.published_year("published_at")).filter(F.col("year").isNotNull())
    full = T.description_fallback(F.col("description"), F.col("content"), F.col("title"))
    a = a.withColumn("_full", full)
    meta = F.create_map(F.lit("news_source"), F.coalesce(F.col("source_name"), F.lit("unknown")),
                        F.lit("published_at"), F.col("published_at"),
                        F.lit("collection_method"), F.lit("news_api_search"))
    keep = [c for c in articles.columns
            if c not in ("title", "description", "content", "url", "published_at", "source_name", category_col)]
    return a.select(
        *keep,
        F.col("year").cast("int").alias("year"),
        S.published_ts("published_at").alias("date"),
        T.clean_text(F.col("title")).alias("title"),
        T.clean_text(F.col("_full")).alias("description"),
        F.col(category_col).alias("category"),
        F.lit("news_api").alias("source"),
        F.col("url").alias("source_url"),
        T.news_location(F.col("title"), F.col("_full")).alias("location"),
        T.news_participants(F.col("title"), F.col("_full")).alias("participants"),
        T.news_severity(F.col("title"), F.col("_full")).alias("severity"),
        meta.alias("metadata"),
    )
