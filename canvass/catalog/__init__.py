"""Queries over the given tables, each with the SQL that must give the same rows."""

from canvass.catalog import (  # noqa: F401
    alerts,
    audit,
    cases,
    corrections,
    geo,
    quality,
    reports,
    shapes,
    summaries,
    texts,
    visits,
)
from canvass.catalog.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
