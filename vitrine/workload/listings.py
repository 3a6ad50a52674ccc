"""Listing pages built from ``part``, read back and taken through to the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.functions.times import iso_utc
from vitrine.operators import counts, dom, frontier, listing, paging, quality
from vitrine.operators import upsert as U
from vitrine.plans import listings
from vitrine.workload import inputs as I
from vitrine.workload.registry import query

_RECORDS = f"""
    select concat('page_', cast(p_partkey as string)) as path, cast(i as bigint) as item_pos,
           {I.KEY} as product_id, {I.NAME_FULL} as name_full, {I.BARE_NAME} as name,
           {I.CONDITION} as condition, {I.MODEL_NUMBER} as model_number,
           {I.SET_SIZE} as set_size, p_type as model_code, {I.PRICE_TEXT} as price,
           {I.PRODUCT_URL} as product_url, {I.PRICE_YEN} as price_yen
    from {I.ITEMS}
"""


def _records(rows: DataFrame) -> DataFrame:
    return listing.with_price(rows).withColumn("item_pos", F.col("item_pos").cast("bigint"))


@query("product_blocks", _RECORDS)
def product_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(listings.saved_listing(I.listing_pages(spark, sf_dir), I.SHOP))


@query("product_blocks_tolerant", _RECORDS)
def product_blocks_tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(dom.parse_products(I.listing_pages(spark, sf_dir), I.SHOP, ["path"]))


@query("item_counts", f"select path, count(*) as n_items from ({_RECORDS}) group by path")
def item_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = listings.saved_listing(I.listing_pages(spark, sf_dir), I.SHOP)
    return counts.count_per(records, ["path"], "n_items")


@query(
    "top5",
    f"""
    select path, item_pos, product_id, name from ({_RECORDS}) order by path, item_pos limit 5
    """,
)
def top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _records(listings.saved_listing(I.listing_pages(spark, sf_dir), I.SHOP))
    shown = records.select("path", "item_pos", "product_id", "name")
    return counts.preview(shown, listings.preview_order())


@query(
    "listing_fingerprints",
    f"""
    select {I.SERIES} as series_code, cast({I.PAGE_INDEX} as int) as page_index,
           4 as n_items, {I.KEY} as first_id, {I.PRODUCT_URL} as first_url
    from {I.ITEMS} where i = 0
    union all
    select distinct {I.SERIES}, 14, 0, null, null from part
    """,
)
def listing_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First item per page from item rows; each series also has an empty last page."""
    pages = I.listing_pages(spark, sf_dir)
    keys = ("series_code", "page_index")
    empty = pages.select("series_code").distinct().select(
        "series_code", F.lit(frontier.MAX_PAGES).alias("page_index")
    )
    items = listing.parse_products(pages, I.SHOP, keys)
    every_page = pages.select(*keys).unionByName(empty)
    identity = ("product_id", "product_url")
    prints = paging.page_fingerprints(every_page, items, keys, identity, ["item_pos"])
    return prints.select(
        *keys,
        F.col("n_items").cast("int").alias("n_items"),
        F.col("fingerprint.product_id").alias("first_id"),
        F.col("fingerprint.product_url").alias("first_url"),
    )


# What both crawls accept and reject, straight from part.
_CRAWLED = f"""
    select run_id, {I.SERIES} as series_code, cast({I.PAGE_INDEX} as int) as page_index,
           cast(i as bigint) as item_pos, {I.KEY} as product_id,
           cast({I.SERIES_NUMBER} as string) as product_group, {I.MODEL_NUMBER} as model_number,
           {I.SET_SIZE} as set_size, {I.BARE_NAME} as name, {I.NAME_FULL} as name_full,
           {I.CONDITION} as condition, p_type as model_code,
           case run_id when 1 then {I.PRICE_YEN} else {I.SECOND_PRICE_YEN} end as price_yen,
           {I.PRODUCT_URL} as url,
           case run_id when 1 then timestamp '2024-03-01 06:00:00'
                else timestamp '2024-03-02 06:00:00' end
               + to_seconds(cast({I.PAGE_INDEX} * 10 + 1 as int)) as observed_at
    from {I.ITEMS}, (values (1), (2)) runs(run_id)
    where {I.KEPT_PARTS}
"""
_REASON = """
    case when url is null then 'url' when coalesce(name, '') = '' then 'name'
         when model_number is null then 'model_number' when price_yen is null then 'price_yen' end
"""
_ISO = "strftime({}, '%Y-%m-%dT%H:%M:%S') || '+00:00'"
_ACCEPTED = f"select * from ({_CRAWLED}) where {_REASON} is null"


def _crawl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listings.listing_records(I.crawled_pages(spark, sf_dir), I.SHOP, run=["run_id"])


@query(
    "listing_products",
    f"""
    select product_id, product_group, model_number, set_size, name, name_full, condition,
           model_code, last_price as price_yen, url, {_ISO.format("first_seen")} as created_at,
           {_ISO.format("observed_at")} as updated_at
    from (select *, arg_max(price_yen, observed_at) over by_product as last_price,
                 min(observed_at) over by_product as first_seen,
                 row_number() over (partition by product_id order by observed_at desc) as n
          from ({_ACCEPTED}) window by_product as (partition by product_id))
    where n = 1
    """,
)
def listing_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two crawls, from HTML to the product table."""
    table = listings.products(_crawl(spark, sf_dir))
    return table.withColumns({c: iso_utc(F.col(c)) for c in ("created_at", "updated_at")})


@query(
    "listing_snapshots",
    f"""
    select product_id, {_ISO.format("observed_at")} as observed_at, price_yen,
           strftime(observed_at, '%Y-%m-%d') as observed_date
    from ({_ACCEPTED})
    """,
)
def listing_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = U.snapshots(quality.accepted(_crawl(spark, sf_dir)))
    return prices.withColumns(
        {
            "observed_at": iso_utc(F.col("observed_at")),
            "observed_date": F.col("observed_date").cast("string"),
        }
    )


@query(
    "listing_rejects",
    f"""
    select run_id, series_code, page_index, item_pos, product_id, {_REASON} as reject_reason
    from ({_CRAWLED}) where {_REASON} is not null
    """,
)
def listing_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rejected(_crawl(spark, sf_dir)).select(
        "run_id",
        "series_code",
        "page_index",
        F.col("item_pos").cast("bigint").alias("item_pos"),
        "product_id",
        quality.REASON,
    )


@query(
    "write_counts",
    f"""
    select run_id, series_code, page_index, count(*) as n_written
    from ({_ACCEPTED}) group by all
    """,
)
def write_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listings.written_counts(_crawl(spark, sf_dir), ["run_id"])
