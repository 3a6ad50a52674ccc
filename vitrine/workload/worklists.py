"""Series lists and the work lists made from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.operators import counts, frontier
from vitrine.sources import series
from vitrine.workload import inputs as I
from vitrine.workload.registry import query, table

# Suppliers as series of three sources in mixed case, some without an address.
_SOURCE = "case s_nationkey % 3 when 0 then 'Shop' when 1 then 'SHOP' else 'other' end"
_LIST_URL = (
    "case when s_nationkey % 5 = 0 then null when s_nationkey % 5 = 1 then '  ' "
    "else concat('https://shop.example/product-list/', cast(s_suppkey as string), '/') end"
)


def _series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.expr(_SOURCE).alias("source"),
        F.col("s_name").alias("series_code"),
        F.expr(_LIST_URL).alias("list_url"),
    )


_SERIES_SQL = f"""
    select s_name as series_code, {_LIST_URL} as list_url, s_suppkey
    from supplier where s_nationkey % 3 <> 2 and s_nationkey % 5 > 1
"""


@query(
    "series_scan",
    f"select series_code, list_url from ({_SERIES_SQL}) order by series_code nulls first",
)
def series_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.series_urls(_series(spark, sf_dir), "shop")


@query("series_counts", f"select count(*) as n_series from ({_SERIES_SQL})")
def series_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.count_all(
        series.series_urls(_series(spark, sf_dir), "sHoP", ordered=False), "n_series"
    )


@query(
    "page_frontier",
    f"""
    select series_code, cast(i as int) as page_index,
           concat('https://shop.example/product-list/', cast(s_suppkey as string),
                  '/0/photo?num=100&page=', cast(i as string)) as url,
           concat('Supplier_', right(series_code, 9), '_', cast(i as string)) as name
    from ({_SERIES_SQL}), generate_series(1, 14) t(i)
    """,
)
def page_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frontier.page_frontier(series.series_urls(_series(spark, sf_dir), "shop", ordered=False))


_SIZES = (
    "case when p_size % 10 = 0 then null when p_size % 10 = 1 then 0 "
    "when p_size % 10 = 2 then -p_size else p_size end"
)


def _sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("S"), F.col("p_partkey").cast("string")).alias("series_code"),
        F.expr(I.CARD_LANG).alias("lang"),
        F.expr(_SIZES).alias("size"),
    )


_SIZES_SQL = f"""
    select concat('S', cast(p_partkey as string)) as series_code, {I.CARD_LANG} as lang,
           p_size as size
    from part where p_size % 10 > 2
"""


@query("series_sizes", f"select * from ({_SIZES_SQL}) order by series_code, lang")
def series_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.series_sizes(_sizes(spark, sf_dir))


@query(
    "card_frontier",
    f"""
    select series_code, lang, cast(i as string) as card_code,
           concat('{I.CARDS}/', lang, '/', series_code, '/', cast(i as string),
                  case when lang = 'jp' then '?translate=en' else '' end) as url,
           concat(series_code, '_', cast(i as string), '_', lang) as name
    from (select *, unnest(generate_series(1, size)) as i from ({_SIZES_SQL}))
    """,
)
def card_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frontier.card_frontier(
        series.series_sizes(_sizes(spark, sf_dir), ordered=False), I.CARDS
    )
