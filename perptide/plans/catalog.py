"""All registered queries and their SQL twins."""

from __future__ import annotations

from perptide.plans import (
    catalog_merge,
    catalog_metrics,
    catalog_normalize,
    catalog_ops,
    catalog_reports,
)

REGISTRIES = (
    catalog_merge.query,
    catalog_normalize.query,
    catalog_metrics.query,
    catalog_ops.query,
    catalog_reports.query,
)


def queries():
    return {name: fn for registry in REGISTRIES for name, fn in registry.queries.items()}


def oracle_sql():
    return {name: text for registry in REGISTRIES for name, text in registry.sql.items()}
