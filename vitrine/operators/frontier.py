"""Work lists: which pages and cards a series consists of."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions import urls
from vitrine.functions.text import safe_name

# Size limits of a listing.
MAX_PAGES = 14
PAGE_SIZE = 100

# A series is expanded in runs of this many numbers, so that no single row, however large its
# size, becomes one task's whole output.
RUN_LENGTH = 10_000


def listing_file_name(series_code: Column, page_index: Column) -> Column:
    return F.concat_ws("_", safe_name(series_code), page_index.cast("string"))


def card_file_name(series_code: Column, card_code: Column, lang: Column) -> Column:
    return F.concat_ws("_", series_code, card_code.cast("string"), lang)


def page_frontier(
    series: DataFrame, max_pages: int = MAX_PAGES, page_size: int = PAGE_SIZE
) -> DataFrame:
    """``series_code, list_url`` to one row per page with its address and file name."""
    index = F.explode(F.sequence(F.lit(1), F.lit(max_pages))).alias("page_index")
    return series.select("series_code", "list_url", index).select(
        "series_code",
        "page_index",
        urls.page_url(F.col("list_url"), F.col("page_index"), page_size).alias("url"),
        listing_file_name(F.col("series_code"), F.col("page_index")).alias("name"),
    )


def card_frontier(series: DataFrame, root_url: str, run_length: int = RUN_LENGTH) -> DataFrame:
    """``series_code, lang, size`` to one row per card number, as text.

    Sizes are expanded in two steps with the short list of runs spread over the cluster in
    between.  Rows without a positive size give nothing.
    """
    size, step = F.col("size").cast("long"), F.lit(run_length).cast("long")
    runs = series.where(F.col("size") > 0).select(
        "series_code",
        "lang",
        size.alias("_size"),
        F.explode(F.sequence(F.lit(1).cast("long"), size, step)).alias("_start"),
    )
    spread = runs.repartition("series_code", "lang", "_start")
    last = F.least(F.col("_start") + step - 1, F.col("_size"))
    numbers = spread.select(
        "series_code", "lang", F.explode(F.sequence("_start", last)).alias("_number")
    ).withColumn("card_code", F.col("_number").cast("string"))
    lang, code, card = F.col("lang"), F.col("series_code"), F.col("card_code")
    return numbers.select(
        "series_code",
        "lang",
        "card_code",
        urls.card_url(root_url, lang, code, card).alias("url"),
        card_file_name(code, card, lang).alias("name"),
    )
