"""All registered queries (imports every catalog module once)."""

from __future__ import annotations

from histevents.plans import catalog
from histevents.plans import catalog_text  # noqa: F401  (registers)
from histevents.plans import catalog_pipelines  # noqa: F401  (registers)
from histevents.plans import catalog_store  # noqa: F401  (registers)

QUERIES = catalog.QUERIES


def queries():
    return catalog.queries()


def oracle_sql():
    return catalog.oracle_sql()
