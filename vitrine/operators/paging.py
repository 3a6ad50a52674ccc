"""Where a paginated series really ends.

A shop answers a page number past the end with an empty page or with page 1 again.  The stop
page and everything after it are dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def page_fingerprints(
    pages: DataFrame,
    items: DataFrame,
    keys: Sequence[str],
    identity: Sequence[str],
    order: Sequence[Column | str],
) -> DataFrame:
    """Pages with ``n_items`` and ``fingerprint``: the identity columns of the first item.

    Items are reduced map-side to one row per page, so a page holding a large share of all
    items costs no more than the others; pages without items stay, with a null fingerprint.
    """
    firsts = items.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_items"),
        F.min_by(F.struct(*identity), F.struct(*order)).alias("fingerprint"),
    )
    return pages.join(firsts, list(keys), "left").withColumn(
        "n_items", F.coalesce("n_items", F.lit(0).cast("long"))
    )


def latest_copies(
    rows: DataFrame, keys: Sequence[str], newest: Sequence[Column]
) -> DataFrame:
    """Rows of the newest copy per key; rows of one copy share the values in ``newest``.

    The rank filter is also applied before the shuffle, so each map task forwards one copy
    per key, however often a page was landed.
    """
    copies = Window.partitionBy(*keys).orderBy(*newest)
    return rows.withColumn("_copy", F.rank().over(copies)).where("_copy <= 1").drop("_copy")


def _outside(index: Column, max_pages: int | None) -> Column:
    beyond = F.lit(False) if max_pages is None else index > max_pages
    return F.coalesce((index < 1) | beyond, F.lit(True))


def out_of_range(
    pages: DataFrame, page_index: str = "page_index", max_pages: int | None = None
) -> DataFrame:
    """Pages that take no part in paging, each with its ``reject_reason``."""
    index = F.col(page_index)
    reason = F.when(index.isNull(), "page_index").when(index < 1, "page_index").otherwise("page_cap")
    return pages.where(_outside(index, max_pages)).withColumn("reject_reason", reason)


def cut_off(
    pages: DataFrame,
    series: Sequence[str] = ("series_code",),
    page_index: str = "page_index",
    n_items: str = "n_items",
    fingerprint: str = "fingerprint",
    max_pages: int | None = None,
) -> DataFrame:
    """Keep each series up to its first empty page or first repeat of page 1.

    Rows may be pages or the items of pages (rows of a page carry the same values); a window
    holds those of one series, so pages scale further.  A repeat of any page but page 1 does not stop the series, and without a page 1 only an empty page
    does.  ``max_pages`` is for work lists; what it or a missing number keeps out of a series
    is what ``out_of_range`` returns.
    """
    index, fp = F.col(page_index), F.col(fingerprint)
    order = Window.partitionBy(*series).orderBy(page_index)
    so_far = order.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    first_page = F.first(F.struct(index.alias("page"), fp.alias("fp"))).over(so_far)
    marked = pages.where(~_outside(index, max_pages)).withColumn("_first", first_page)
    repeats = (index > 1) & (F.col("_first.page") == 1) & fp.eqNullSafe(F.col("_first.fp"))
    stops = marked.withColumn("_stop", (F.col(n_items) == 0) | repeats)
    return (
        stops.withColumn("_stopped", F.max("_stop").over(so_far))
        .where(~F.col("_stopped"))
        .drop("_first", "_stop", "_stopped")
    )
