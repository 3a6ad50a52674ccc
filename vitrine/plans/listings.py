"""Listing pages of a shop to products, price snapshots and rejects."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine import schemas
from vitrine.functions.urls import product_group
from vitrine.operators import counts, dom, listing, paging, quality
from vitrine.operators import upsert as U
from vitrine.sources import tables

# Arrival order of records: by time, then as a crawl visits series, pages and items.
ARRIVAL = ("observed_at", "series_code", "page_index", "item_pos")


def page_items(
    pages: DataFrame, base_url: str, run: Sequence[str] = (), tolerant: bool = False
) -> DataFrame:
    """Record rows of every landed page, before paging; an empty page is one null row.

    All reading of HTML happens here, in one pass over the pages and without a shuffle.
    ``tolerant`` reads pages through the tree of ``operators.dom``.
    """
    reader = dom if tolerant else listing
    keep = (*run, "series_code", "page_index", "url", "fetched_at", "_landing")
    landed = pages.withColumn("_landing", F.monotonically_increasing_id())
    blocks = reader.explode_blocks(landed, keep, base_url)
    return listing.with_price(reader.read_fields(blocks, base_url))


def kept_items(
    items: DataFrame, run: Sequence[str] = (), max_pages: int | None = None
) -> DataFrame:
    """Items of the newest copy of each page, up to the end of each series.

    This lazy form sorts the item rows of a series in one window; ``write_listings`` and the
    stream page through the ledger instead, and are the way for very long series."""
    series = (*run, "series_code")
    newest = [F.desc("fetched_at"), F.col("_landing")]
    current = paging.latest_copies(items, (*series, "page_index"), newest)
    return paging.cut_off(current, series, max_pages=max_pages)


def page_ledger(items: DataFrame, run: Sequence[str] = ()) -> DataFrame:
    """One short row per page: newest landing, item count and fingerprint.

    The rows of a page come from one task, so almost all of the reduction is map-side.
    """
    keys = (*run, "series_code", "page_index")
    landing = F.struct("fetched_at", "_landing", "n_items", "fingerprint")
    newest = F.struct(F.col("fetched_at"), -F.col("_landing"))
    return items.groupBy(*keys).agg(F.max_by(landing, newest).alias("_l")).select(*keys, "_l.*")


def staged_items(items: DataFrame, inside: DataFrame) -> DataFrame:
    """As ``kept_items`` for the written item rows of one load: only ledger rows took part in paging.

    Items meet their ledger row on the landing, so no series and no page with many copies gathers in
    one task; a short ledger is broadcast by size.
    """
    return items.where(F.col("item_pos").isNotNull()).join(inside.select("_landing"), "_landing", "left_semi")


def check_items(items: DataFrame, strict: bool = False) -> DataFrame:
    """Stored columns of every item with the reason to reject it, null for none."""
    grouped = items.withColumn("product_group", product_group(F.col("url"))).drop("url")
    checked = quality.require_group(
        quality.require_products(quality.with_url_fallback(grouped)), strict
    )
    return checked.withColumnRenamed("fetched_at", "observed_at").drop(
        "_landing", "n_items", "fingerprint", "product_url"
    )


def listing_records(
    pages: DataFrame,
    base_url: str,
    run: Sequence[str] = (),
    max_pages: int | None = None,
    strict: bool = False,
    tolerant: bool = False,
) -> DataFrame:
    """Landed pages to checked records, one row per item of a kept page."""
    kept = kept_items(page_items(pages, base_url, run, tolerant), run, max_pages)
    return check_items(kept, strict)


def product_rows(records: DataFrame) -> DataFrame:
    """Accepted records in the shape of the product table, with their arrival columns."""
    return (
        quality.accepted(records)
        .withColumn("created_at", F.col("observed_at"))
        .withColumn("updated_at", F.col("observed_at"))
    )


def products(records: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """The product table after these records."""
    rows = product_rows(records)
    if stored is None:
        return U.fold(rows, U.PRODUCTS, ARRIVAL)
    return U.upsert(stored, rows, U.PRODUCTS, ARRIVAL)


def written_counts(records: DataFrame, run: Sequence[str] = ()) -> DataFrame:
    """Accepted records per series and page, as a crawl reports them."""
    return counts.count_per(
        quality.accepted(records), (*run, "series_code", "page_index"), "n_written"
    )


@dataclass(frozen=True)
class Written:
    """What a run wrote: accepted records per page, rejected records, and the checks of its outputs
    (``quality.REPORT``; checks of whole tables are worked out when they are asked for)."""

    counts: DataFrame
    rejects: DataFrame
    checks: DataFrame


def current_products(spark: SparkSession, root: str) -> DataFrame:
    """The product table below ``root`` after all runs, in whatever order they came."""
    return tables.read_current(spark, f"{root}/products", schemas.SHOP_PRODUCTS, U.PRODUCTS)


def read_prices(spark: SparkSession, root: str) -> DataFrame:
    """All price observations below ``root``, once each, also where a run was repeated with more pages."""
    seen = spark.read.parquet(f"{root}/prices")
    identity = [c for c in seen.columns if c not in ("load", "observed_date")]
    return seen.dropDuplicates(identity).select("product_id", "observed_at", "price_yen", "observed_date", "run_id")


def store_records(
    spark: SparkSession, records: DataFrame, root: str, run_id: int | str, load: str, run: Sequence[str] = ()
) -> Written:
    """Write checked records, then update products, prices and the daily price history from them."""
    tables.append_load(records, f"{root}/records", run_id, load)
    checked = tables.read_load(spark, f"{root}/records", run_id, load)
    accepted = quality.accepted(checked)

    states = quality.Observed("products", ("product_id", "created_at", "updated_at"))
    rows = states.watch(product_rows(checked))
    tables.append_states(U.state_of(rows, U.PRODUCTS, ARRIVAL), f"{root}/products")

    identity = [c for c in (*run, "series_code", "page_index", "item_pos") if c not in ("product_id", "price_yen")]
    seen = quality.Observed("prices", ("product_id", "observed_at", "price_yen"))
    prices = seen.watch(U.snapshots(accepted, identity))
    tables.append_load(prices, f"{root}/prices", run_id, load, ("observed_date",))

    captures = accepted.select(
        "product_id",
        F.col("observed_at").alias("captured_at"),
        F.col("price_yen").alias("price"),
        F.lit(None).cast("string").alias("currency"),
        F.lit(None).cast("string").alias("stock_status"),
    )
    history = f"{root}/price_history"
    tables.fold_days(captures, history, schemas.PRICE_HISTORY, root, ("price",))

    products = current_products(spark, root)
    daily = spark.read.schema(schemas.PRICE_HISTORY).parquet(history)
    checks = (
        spark.createDataFrame([*states.report(), *seen.report()], quality.REPORT)
        .unionByName(quality.key_clashes(products, "products", ("product_id",)))
        .unionByName(quality.key_clashes(daily, "price_history", ("product_id", "captured_date")))
        .unionByName(quality.orphan_count(daily, "product_id", products, "product_id", "price_history"))
    )
    return Written(written_counts(checked, run), quality.rejected(checked), checks)


def write_listings(
    spark: SparkSession,
    pages: DataFrame,
    root: str,
    base_url: str,
    run_id: int | str,
    tolerant: bool = False,
    max_pages: int | None = None,
    strict: bool = False,
) -> Written:
    """Read one crawl's pages once and update all outputs below ``root``.

    Pages without a number, or over an explicit ``max_pages``, go to ``unpaged`` with a reason; pages
    that were not fetched (where there is a ``status``) go to ``failed`` without HTML.

    Item rows are written first, without any shuffle; paging works on their ledger, and records,
    products, prices and the daily history are read from written tables.  A lost executor costs at
    most a re-read of those.  A repeated run leaves the same result, and a run that is late or reuses
    an id adds what it read."""
    readable, failures = quality.split_fetched(pages)
    items = tables.staged(page_items(readable, base_url, tolerant=tolerant), root, "items")
    load = tables.content_id(items, ("_landing",))
    if failures is not None:
        tables.append_load(failures, f"{root}/failed", run_id, load)
    ledger = page_ledger(items)
    unpaged = paging.out_of_range(ledger, max_pages=max_pages)
    tables.append_load(unpaged, f"{root}/unpaged", run_id, load)
    inside = paging.cut_off(ledger, max_pages=max_pages)
    return store_records(spark, check_items(staged_items(items, inside), strict), root, run_id, load)


def saved_listing(files: DataFrame, base_url: str) -> DataFrame:
    """Re-read saved page files (``path, html``) without paging or storing."""
    return listing.parse_products(files, base_url, ("path",))


def preview_order() -> tuple[Column, Column]:
    return F.col("path"), F.col("item_pos")
