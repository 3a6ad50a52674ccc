"""Card pages to the card index and, for English pages, the card prices."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine import schemas
from vitrine.operators import cards, dom, quality
from vitrine.operators import upsert as U
from vitrine.sources import tables

_TABLES = {
    "card_index": (schemas.CARD_INDEX, U.CARD_INDEX),
    "card_prices": (schemas.CARD_PRICES, U.CARD_PRICES),
}
# Fixed value: only pages in this language carry prices to store.
PRICED_LANG = "en"


def arrival() -> tuple[Column | str, ...]:
    """Arrival order: a crawl walks the numbers of a set upwards; text settles what has none."""
    number = F.col("card_code").try_cast("bigint").alias("card_number")
    return ("observed_at", "set_code", "lang", number, "card_code")


def card_records(pages: DataFrame, tolerant: bool = False) -> DataFrame:
    """Landed card pages to checked records; keys come from the page's own row.

    An id that is missing or no number rejects the record; a ``data_id`` that is no integer
    becomes null.  ``tolerant`` reads pages through
    the tree of ``operators.dom``.
    """
    reader = dom if tolerant else cards
    keep = ("lang", "set_code", "card_code", "fetched_at")
    read = reader.card_fields(pages, keep).withColumnRenamed("fetched_at", "observed_at")
    typed = read.withColumn("data_id", F.col("data_id").try_cast("bigint"))
    return quality.require_integer_id(typed)


def index_rows(records: DataFrame) -> DataFrame:
    return quality.accepted(records)


def price_rows(records: DataFrame) -> DataFrame:
    return quality.accepted(records).where(F.col("lang") == PRICED_LANG)


def card_index(records: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """The card index after these records."""
    rows = index_rows(records)
    if stored is None:
        return U.fold(rows, U.CARD_INDEX, arrival())
    return U.upsert(stored, rows, U.CARD_INDEX, arrival())


def card_prices(records: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """The card prices after these records."""
    rows = price_rows(records)
    if stored is None:
        return U.fold(rows, U.CARD_PRICES, arrival())
    return U.upsert(stored, rows, U.CARD_PRICES, arrival())


@dataclass(frozen=True)
class Written:
    """What a run wrote: rejected records, and the checks of its outputs (``quality.REPORT``)."""

    rejects: DataFrame
    checks: DataFrame


def current_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """``card_index`` or ``card_prices`` below ``root`` after all runs, in whatever order they came."""
    schema, policy = _TABLES[name]
    return tables.read_current(spark, f"{root}/{name}", schema, policy)


def write_cards(
    spark: SparkSession, pages: DataFrame, root: str, run_id: int | str, tolerant: bool = False
) -> Written:
    """Read one run's pages once and update both tables below ``root``.

    Failed pages (where there is a ``status``) go to ``failed`` without HTML.  A repeated run leaves
    the same result, and a run that is late or reuses an id adds what it read."""
    readable, failures = quality.split_fetched(pages)
    read = tables.staged(card_records(readable, tolerant), root, "cards")
    load = tables.content_id(read)
    if failures is not None:
        tables.append_load(failures, f"{root}/failed", run_id, load)
    tables.append_load(read, f"{root}/records", run_id, load)
    records = tables.read_load(spark, f"{root}/records", run_id, load)
    report = []
    for name, rows in (("card_index", index_rows(records)), ("card_prices", price_rows(records))):
        schema, policy = _TABLES[name]
        watched = quality.Observed(name, [f.name for f in schema if not f.nullable])
        tables.append_states(U.state_of(watched.watch(rows), policy, arrival()), f"{root}/{name}")
        report += watched.report()
    index = current_table(spark, root, "card_index")
    prices = current_table(spark, root, "card_prices")
    checks = (
        spark.createDataFrame(report, quality.REPORT)
        .unionByName(quality.key_clashes(index, "card_index", ("card_id",)))
        .unionByName(quality.key_clashes(index, "card_index", ("lang", "set_code", "card_code")))
        .unionByName(quality.orphan_count(prices, "card_id", index, "card_id", "card_prices"))
    )
    return Written(quality.rejected(records), checks)
