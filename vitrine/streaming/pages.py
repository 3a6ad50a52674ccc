"""Landed pages as a stream, folded into the tables one micro-batch at a time.

Every write carries the micro-batch id and a name of its content, so a batch replayed after a failure
replaces its own output and changes nothing else, and a stream that starts anew overwrites nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from vitrine import schemas
from vitrine.operators import paging, quality
from vitrine.plans import cards, listings
from vitrine.sources import tables

#: A series is paged within its crawl.
CRAWL = ("crawl_id",)


def landed_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Stream of landed page rows from Parquet files dropped into a folder."""
    reader = spark.readStream.schema(schemas.LANDED_PAGES)
    return reader.option("maxFilesPerTrigger", files_per_batch).parquet(path)


def of_source(batch: DataFrame, source: str | None) -> DataFrame:
    """The rows of one source, or all of them."""
    return batch if source is None else batch.where(F.col("source") == source)


def fold_listings(
    spark: SparkSession,
    batch: DataFrame,
    batch_id: int,
    root: str,
    base_url: str,
    source: str | None = None,
    tolerant: bool = False,
    max_pages: int | None = None,
    strict: bool = False,
) -> listings.Written:
    """Fold one micro-batch of listing pages.

    A crawl reads a series page by page, so a page lands no earlier than the pages before it; a page
    that failed is passed over, as in a batch.  Whether a page lies past the end of its series is
    decided from the ledger of all pages of its crawl and series landed so far: one short row per
    page, cut down to the series this batch touches.
    """
    readable, failures = quality.split_fetched(of_source(batch, source))
    crawl = F.col("crawl_id") if "crawl_id" in readable.columns else F.lit(None)
    readable = readable.withColumn("crawl_id", F.coalesce(crawl.cast("string"), F.lit("")))
    items = tables.staged(listings.page_items(readable, base_url, CRAWL, tolerant), root, "items")
    load = tables.content_id(items, ("_landing",))
    tables.append_load(failures, f"{root}/failed", batch_id, load)
    tables.append_load(listings.page_ledger(items, CRAWL), f"{root}/ledger", batch_id, load)
    landed = tables.read_load(spark, f"{root}/ledger", batch_id, load)
    tables.append_load(paging.out_of_range(landed, max_pages=max_pages), f"{root}/unpaged", batch_id, load)
    ledger = spark.read.parquet(f"{root}/ledger")
    series = (*CRAWL, "series_code")
    touched = landed.select(*(F.col(c).alias(f"_{c}") for c in series)).distinct()
    same = F.lit(True)
    for c in series:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    known = ledger.join(touched, same, "left_semi")
    newest = [F.desc("fetched_at"), F.desc("run_id"), F.desc("load")]
    current = paging.latest_copies(known, (*series, "page_index"), newest)
    mine = (F.col("run_id") == batch_id) & (F.col("load") == load)
    inside = paging.cut_off(current, series, max_pages=max_pages).where(mine)
    kept = listings.check_items(listings.staged_items(items, inside), strict)
    return listings.store_records(spark, kept, root, batch_id, load, CRAWL)


def _writer(stream: DataFrame, root: str, fold) -> DataStreamWriter:
    return (
        stream.writeStream.foreachBatch(fold)
        .option("checkpointLocation", f"{root}/stream_checkpoint")
        .trigger(availableNow=True)
    )


def stream_listings(stream: DataFrame, root: str, base_url: str, **options) -> DataStreamWriter:
    """Listing pages into products, price snapshots and the daily prices below ``root``; options as
    those of ``fold_listings``."""

    def fold(batch: DataFrame, batch_id: int) -> None:
        fold_listings(batch.sparkSession, batch, batch_id, root, base_url, **options)

    return _writer(stream, root, fold)


def stream_cards(
    stream: DataFrame, root: str, source: str | None = None, tolerant: bool = False
) -> DataStreamWriter:
    """Card pages into the card index and prices below ``root``."""

    def fold(batch: DataFrame, batch_id: int) -> None:
        cards.write_cards(batch.sparkSession, of_source(batch, source), root, batch_id, tolerant)

    return _writer(stream, root, fold)
