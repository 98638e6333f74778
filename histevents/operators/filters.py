"""Store filters and projections.

Plain ``filter``/``select`` so Catalyst pushes predicates into the parquet
scan (and prunes ``century`` partitions for year ranges) and reads only the
projected columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histevents import lexicons as L
from histevents.functions.scalars import century

EXPORT_COLUMNS = ("id", "year", "date", "title", "description", "category", "subcategory", "severity",
                  "digital_root", "source", "location", "impact_score", "verified", "created_at")


def by_year_range(events: DataFrame, start_year: int, end_year: int) -> DataFrame:
    cond = F.col("year").between(start_year, end_year)
    if "century" in events.columns:  # lets the scan skip whole partitions
        cond = (cond & (F.col("century") >= century(F.lit(start_year)))
                & (F.col("century") <= century(F.lit(end_year))))
    return events.filter(cond)


def by_digital_root(events: DataFrame, root: int) -> DataFrame:
    return events.filter(F.col("digital_root") == root)


def by_category(events: DataFrame, category: str) -> DataFrame:
    return events.filter(F.col("category") == category)


def verified_only(events: DataFrame) -> DataFrame:
    return events.filter(F.col("verified"))


def apply_filters(events: DataFrame, start_year=None, end_year=None, category=None,
                  verified_only_flag=False) -> DataFrame:
    """Optional conjunctive filters; each applies only when given/truthy."""
    out = events
    if start_year is not None:
        out = out.filter(F.col("year") >= start_year)
    if end_year is not None:
        out = out.filter(F.col("year") <= end_year)
    if category is not None:
        out = out.filter(F.col("category") == category)
    if verified_only_flag:
        out = out.filter(F.col("verified"))
    return out


def export_events(events: DataFrame, start_year=None, end_year=None, category=None,
                  verified_only: bool = False) -> DataFrame:
    """Filtered export projection (14 store columns; absent ones are null)."""
    out = apply_filters(events, start_year, end_year, category, verified_only)
    cols = [F.col(c) if c in out.columns else F.lit(None).alias(c) for c in EXPORT_COLUMNS]
    return out.select(*cols)


def select_sources(requested, priority=L.SOURCE_PRIORITY) -> list[str]:
    """Requested source names in fixed priority order; unknown names dropped."""
    if requested is None:
        return list(priority)
    req = set(requested)
    return [s for s in priority if s in req]
