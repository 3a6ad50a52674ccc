"""Accepting rows, reporting rejects, and checking keys, references and required fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from vitrine.functions.text import blank_to_null

REASON = "reject_reason"

# The fields a product must have, in the order they are tested.
REQUIRED_TEXTS = ("product_id", "url", "name", "name_full", "model_number")


def with_url_fallback(records: DataFrame) -> DataFrame:
    """``url`` is the product address, else a plain ``url`` column when there is one."""
    fallback = [blank_to_null(F.col("url"))] if "url" in records.columns else []
    return records.withColumn(
        "url", F.coalesce(blank_to_null(F.col("product_url")), *fallback)
    )


def require_products(records: DataFrame) -> DataFrame:
    """Add the name of the first missing field, null for an acceptable record.

    Texts must be present and not empty; the price must be present, and zero is a price.
    """
    reason = F.when(blank_to_null(F.col(REQUIRED_TEXTS[0])).isNull(), REQUIRED_TEXTS[0])
    for name in REQUIRED_TEXTS[1:]:
        reason = reason.when(blank_to_null(F.col(name)).isNull(), name)
    return records.withColumn(REASON, reason.when(F.col("price_yen").isNull(), "price_yen"))


def require_group(records: DataFrame, strict: bool = False) -> DataFrame:
    """A record needs a product group: strict runs fail, others reject the record."""
    group = blank_to_null(F.col("product_group"))
    if strict:
        checked = F.when(
            group.isNull(), F.raise_error(F.lit("product group is missing"))
        ).otherwise(group)
        return records.withColumn("product_group", checked)
    missing = F.when(group.isNull(), "product_group")
    return records.withColumn(REASON, F.coalesce(F.col(REASON), missing))


def accepted(records: DataFrame) -> DataFrame:
    return records.where(F.col(REASON).isNull()).drop(REASON)


def rejected(records: DataFrame) -> DataFrame:
    return records.where(F.col(REASON).isNotNull())


def is_fetched() -> Column:
    return (F.col("status") == 200) & F.col("html").isNotNull()


def fetched(pages: DataFrame) -> DataFrame:
    """Landed pages that can be read."""
    return pages.where(is_fetched())


def failed(pages: DataFrame) -> DataFrame:
    """Landed pages to skip, without their HTML."""
    return pages.where(~F.coalesce(is_fetched(), F.lit(False))).drop("html")


def require_integer_id(records: DataFrame, column: str = "card_id") -> DataFrame:
    """Cast an id read as text; a missing or non-numeric one rejects the row."""
    number = F.col(column).try_cast("bigint")
    return records.withColumn(REASON, F.when(number.isNull(), column)).withColumn(
        column, F.when(number.isNotNull(), number)
    )


def duplicate_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their row counts; null keys do not clash."""
    present = rows.where(" and ".join(f"`{k}` is not null" for k in keys))
    return present.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def null_counts(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column with its number of nulls, from a single pass."""
    counted = rows.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    return counted.unpivot([], list(columns), "column_name", "n_nulls")


def orphan_keys(child: DataFrame, foreign_key: str, parent: DataFrame, key: str) -> DataFrame:
    """Foreign key values without a parent row, with their row counts.

    The child is counted per value before the join, so a value shared by a large part of the
    rows reaches the join as one row.
    """
    values = (
        child.where(F.col(foreign_key).isNotNull())
        .groupBy(foreign_key)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    parents = parent.select(F.col(key).alias("_parent"))
    return values.join(parents, values[foreign_key] == parents["_parent"], "left_anti")


class Observed:
    """Row and null counts of a table, taken while it is written: no pass of its own."""

    def __init__(self, table: str, required: Sequence[str]):
        self.table, self.required = table, tuple(required)
        self.metrics = Observation()

    def watch(self, rows: DataFrame) -> DataFrame:
        nulls = (F.count_if(F.col(c).isNull()).alias(f"null {c}") for c in self.required)
        return rows.observe(self.metrics, F.count(F.lit(1)).alias("rows"), *nulls)

    def report(self) -> list[tuple[str, str, str | None, int]]:
        """Rows (table, check, column, n); to be asked for after the write."""
        found = self.metrics.get
        return [(self.table, "rows", None, found["rows"])] + [
            (self.table, "null", c, found[f"null {c}"]) for c in self.required
        ]


REPORT = "table_name string, check_name string, column_name string, n_rows bigint"


def key_clashes(rows: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """One report row: how many rows share their key with another, from one aggregate."""
    clashes = duplicate_keys(rows, keys).agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"))
    return clashes.select(
        F.lit(table).alias("table_name"),
        F.lit("key").alias("check_name"),
        F.lit(",".join(keys)).alias("column_name"),
        F.col("n_rows").cast("bigint").alias("n_rows"),
    )


def orphan_count(child: DataFrame, foreign_key: str, parent: DataFrame, key: str, table: str) -> DataFrame:
    """One report row: how many rows refer to a parent that is not there."""
    found = orphan_keys(child, foreign_key, parent, key).agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"))
    return found.select(
        F.lit(table).alias("table_name"),
        F.lit("reference").alias("check_name"),
        F.lit(foreign_key).alias("column_name"),
        F.col("n_rows").cast("bigint").alias("n_rows"),
    )


def split_fetched(pages: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Pages that can be read and those that failed; rows without a status all count as read."""
    if "status" not in pages.columns:
        return pages, None
    return fetched(pages), failed(pages)
