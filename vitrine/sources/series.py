"""Series lists: what there is to read, as filtered and sorted scans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.functions.text import not_blank, same_folded


def series_urls(series: DataFrame, source: str, ordered: bool = True) -> DataFrame:
    """``series_code, list_url`` of one source (any case) with a non-blank address.

    The order is for reading the list; work lists are made from the unordered form, which
    needs no shuffle.
    """
    of_source = same_folded(F.col("source"), F.lit(source))
    found = series.where(of_source & not_blank(F.col("list_url")))
    found = found.select("series_code", "list_url")
    return found.orderBy("series_code") if ordered else found


def series_sizes(series: DataFrame, ordered: bool = True) -> DataFrame:
    """``series_code, lang, size`` with a positive size; ordered as ``series_urls``."""
    found = series.where(F.col("size").isNotNull() & (F.col("size") > 0)).select(
        "series_code", "lang", F.col("size").cast("int").alias("size")
    )
    return found.orderBy("series_code", "lang") if ordered else found
