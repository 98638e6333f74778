"""Fixed schemas of the event store and its companion tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENT_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("year", T.IntegerType(), False),
    T.StructField("date", T.TimestampType(), True),
    T.StructField("title", T.StringType(), False),
    T.StructField("description", T.StringType(), True),
    T.StructField("category", T.StringType(), False),
    T.StructField("subcategory", T.StringType(), True),
    T.StructField("severity", T.IntegerType(), True),
    T.StructField("digital_root", T.IntegerType(), False),
    T.StructField("source", T.StringType(), False),
    T.StructField("source_url", T.StringType(), True),
    T.StructField("location", T.StringType(), True),
    T.StructField("participants", T.StringType(), True),
    T.StructField("tags", T.StringType(), True),
    T.StructField("impact_score", T.DoubleType(), True),
    T.StructField("verified", T.BooleanType(), True),
    T.StructField("created_at", T.TimestampType(), True),
    T.StructField("updated_at", T.TimestampType(), True),
    T.StructField("collection_metadata", T.StringType(), True),
    T.StructField("event_hash", T.StringType(), False),
])

CYCLE_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("cycle_type", T.StringType(), False),
    T.StructField("digital_root", T.IntegerType(), False),
    T.StructField("category", T.StringType(), False),
    T.StructField("pattern_strength", T.DoubleType(), False),
    T.StructField("statistical_significance", T.DoubleType(), True),
    T.StructField("event_count", T.LongType(), False),
    T.StructField("start_year", T.IntegerType(), False),
    T.StructField("end_year", T.IntegerType(), False),
    T.StructField("description", T.StringType(), True),
    T.StructField("validation_status", T.StringType(), True),
    T.StructField("created_at", T.TimestampType(), True),
])

LOG_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("source", T.StringType(), False),
    T.StructField("collection_type", T.StringType(), False),
    T.StructField("start_time", T.TimestampType(), False),
    T.StructField("end_time", T.TimestampType(), True),
    T.StructField("status", T.StringType(), False),
    T.StructField("records_collected", T.LongType(), True),
    T.StructField("errors_encountered", T.LongType(), True),
    T.StructField("error_details", T.StringType(), True),
    T.StructField("collection_metadata", T.StringType(), True),
])

# Landed payload shapes (explicit schemas; no inference).
ARTICLE_SCHEMA = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("publishedAt", T.StringType()),
    T.StructField("source", T.StructType([T.StructField("name", T.StringType())])),
])
WIKI_PAGE_SCHEMA = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("extract", T.StringType()),
    T.StructField("fullurl", T.StringType()),
])
WIKI_QUERY_RESPONSE_SCHEMA = T.StructType([
    T.StructField("query", T.StructType([
        T.StructField("pages", T.MapType(T.StringType(), WIKI_PAGE_SCHEMA)),
    ])),
])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select ``schema``'s columns in order, casting (``try_cast``: a value
    that does not fit, e.g. a malformed date string, becomes null); missing
    columns become null."""
    cols = []
    have = set(df.columns)
    for f in schema.fields:
        if f.name in have:
            cols.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def order_key(*longs, s1=None, s2=None):
    """Common ordering key of collected events: up to six integers and two
    strings, compared field by field (list order inside a source)."""
    ks = list(longs) + [F.lit(0)] * (6 - len(longs))
    fields = [(k if not isinstance(k, (int, str)) else (F.col(k) if isinstance(k, str) else F.lit(k)))
              .cast("long").alias(f"k{i + 1}") for i, k in enumerate(ks)]
    fields.append((s1 if s1 is not None else F.lit("")).cast("string").alias("s1"))
    fields.append((s2 if s2 is not None else F.lit("")).cast("string").alias("s2"))
    return F.struct(*fields)
