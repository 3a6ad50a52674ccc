"""Run counts and previews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_per(rows: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def count_all(rows: DataFrame, name: str) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias(name))


def preview(rows: DataFrame, order: Sequence[Column | str], n: int = 5) -> DataFrame:
    """First rows in a given order: a top-k, not a full sort."""
    return rows.orderBy(*order).limit(n)
