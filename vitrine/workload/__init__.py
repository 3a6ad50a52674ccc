"""Queries over the given tables, each beside the SQL that checks it."""

from vitrine.workload import inspection, listings, card_pages, tables, values, worklists
from vitrine.workload.registry import ORACLES, QUERIES

__all__ = [
    "ORACLES",
    "QUERIES",
    "card_pages",
    "inspection",
    "listings",
    "tables",
    "values",
    "worklists",
]
