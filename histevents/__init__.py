"""histevents: a Spark-native events lakehouse job set.

Landed semi-structured sources (encyclopaedia pages, indicator and market
series, news articles, a curated list) become one uniform event table that is
enriched with native column expressions, deduplicated, validated and reported
on.  Everything is expressed with the DataFrame / SQL / Structured Streaming
API so Catalyst plans it and executors run it.

Sub-packages
------------
functions   Column -> Column expressions (digital root, hashing, text kit, ...)
sources     readers and fixture views that turn tables into event-shaped frames
operators   detectors, dedupe, near-duplicate join, validation, statistics
plans       composed jobs: the store, reports, collection runs, query catalog
streaming   incremental refresh with Structured Streaming
"""

from histevents.session import get_spark, ensure_checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "ensure_checkpoint_dir"]
