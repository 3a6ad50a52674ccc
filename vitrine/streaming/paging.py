"""Paging of a stream by keyed state: a page counts once all pages before it have landed.

The state of a crawl's series is short: which page comes next, the first page's fingerprint, when the
pages so far were read, and the ledger rows of pages that landed before an earlier one.  So pages may
land in any order, over any number of micro-batches, and what is kept is what ``paging.cut_off`` keeps
of all pages together.  A page that failed counts as landed without items.  A page that never lands is
passed over when the watermark says that its crawl is over.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from vitrine.operators import paging, quality
from vitrine.plans import listings
from vitrine.sources import tables
from vitrine.streaming.pages import CRAWL, of_source

LEDGER = (
    "crawl_id string, series_code string, page_index int, fetched_at timestamp, _landing bigint, n_items int, "
    "first_item string, load string"
)
KEPT = "crawl_id string, series_code string, page_index int, _landing bigint, load string"
STATE = "series string"


class SeriesState:
    """The pages of one series of one crawl, as far as they have landed."""

    def __init__(self, text: str | None = None):
        found = json.loads(text) if text else {}
        #: The next page to decide, the page that ended the series, and page 1's first item.
        self.next: int = found.get("next", 1)
        self.end: int | None = found.get("end")
        self.first: str | None = found.get("first")
        self.has_first: bool = found.get("has_first", False)
        #: Newest reading of each decided page, and rows of pages that wait for an earlier one.
        self.read: dict[int, int] = {int(k): v for k, v in found.get("read", {}).items()}
        self.waiting: dict[int, list] = {int(k): v for k, v in found.get("waiting", {}).items()}

    def text(self) -> str:
        return json.dumps(vars(self))

    def land(self, page: int, at: int, n_items: int, first_item: str | None, landing: int, load: str) -> list[tuple]:
        """Takes a ledger row (``n_items`` -1: failed); the landings that are kept from now on."""
        if page in self.read:
            # a newer copy of a kept page is folded as well; a repeat of the same one is not
            newer = at > self.read[page] and n_items > 0
            self.read[page] = max(at, self.read[page])
            return [(page, landing, load)] if newer else []
        known = self.waiting.get(page)
        if self.end is None and page >= self.next and (known is None or at > known[0] and n_items >= 0 or known[1] < 0):
            self.waiting[page] = [at, n_items, first_item, landing, load]
        return self.release()

    def release(self, gaps: bool = False) -> list[tuple]:
        """Decides waiting pages in order; ``gaps`` passes over pages that have not landed."""
        out = []
        while self.waiting and self.end is None and (gaps or self.next in self.waiting):
            page = min(self.waiting)
            at, n_items, first_item, landing, load = self.waiting.pop(page)
            self.next = page + 1
            if n_items < 0:
                continue
            repeats = page > 1 and self.has_first and first_item == self.first
            if n_items == 0 or repeats:
                self.end = page
                self.waiting.clear()
                break
            if page == 1:
                self.first, self.has_first = first_item, True
            self.read[page] = at
            out.append((page, landing, load))
        return out


def kept_landings(ledger: DataFrame, delay: str = "1 day") -> DataFrame:
    """A stream of ledger rows (``LEDGER``) to the stream of landings whose items count (``KEPT``).

    A crawl of a series is over when the watermark, ``delay`` behind the newest page, passes the
    newest page of it."""

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        series = SeriesState(state.get[0] if state.exists else None)
        out: list[tuple] = []
        if state.hasTimedOut:
            out = series.release(gaps=True)
            state.remove()
        else:
            rows = pd.concat(parts)
            at = rows["fetched_at"].astype("datetime64[us]").astype("int64")
            rows = rows.assign(at=at).sort_values(["page_index", "at"])
            for r in rows.itertuples():
                first_item = r.first_item if isinstance(r.first_item, str) else None
                # itertuples renames columns that start with an underscore
                out += series.land(int(r.page_index), int(r.at), int(r.n_items), first_item, int(r.landing), r.load)
            state.update((series.text(),))
            state.setTimeoutTimestamp(max(int(at.max()) // 1000, state.getCurrentWatermarkMs()) + 1)
        names = ["crawl_id", "series_code", "page_index", "_landing", "load"]
        yield pd.DataFrame([(*key, page, landing, load) for page, landing, load in out], columns=names)

    timed = ledger.withColumnRenamed("_landing", "landing").withWatermark("fetched_at", delay)
    return timed.groupBy(*CRAWL, "series_code").applyInPandasWithState(
        step, KEPT, STATE, "append", GroupStateTimeout.EventTimeTimeout
    )


def _land(batch: DataFrame, root: str, base_url: str, source: str | None, tolerant: bool) -> None:
    """Items of a micro-batch of pages, written once, and a ledger row for each page."""
    spark = batch.sparkSession
    named = of_source(batch, source).withColumn("crawl_id", F.coalesce(F.col("crawl_id"), F.lit("")))
    readable, failures = quality.split_fetched(named)
    items = listings.page_items(readable, base_url, CRAWL, tolerant)
    written = tables.staged(items, root, "items")
    load = tables.content_id(written, ("_landing",))
    tables.append_load(written, f"{root}/items", 0, load)
    tables.append_load(failures, f"{root}/failed", 0, load)
    ledger = listings.page_ledger(spark.read.parquet(f"{root}/items/run_id=0/load={load}"), CRAWL)
    tables.append_load(paging.out_of_range(ledger), f"{root}/unpaged", 0, load)
    keys = (*CRAWL, "series_code", "page_index", "fetched_at")
    read = ledger.select(
        *keys, "_landing", F.col("n_items").cast("int").alias("n_items"), F.to_json("fingerprint").alias("first_item")
    )
    failed = failures.select(
        *keys, F.lit(0).cast("bigint").alias("_landing"), F.lit(-1).alias("n_items"), F.lit(None).cast("string").alias("first_item")
    )
    rows = read.unionByName(failed).where("page_index >= 1").withColumn("load", F.lit(load))
    rows.write.mode("append").parquet(f"{root}/paging_ledger")


def run_ordered_listings(
    spark: SparkSession,
    pages: DataFrame,
    root: str,
    base_url: str,
    source: str | None = None,
    tolerant: bool = False,
    delay: str = "1 day",
    timeout: int | None = None,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Work off a stream of landed pages, then its paging, into the tables of ``plans.listings``.

    The first query writes items and ledger rows; the second keeps the state of every series and folds
    what is decided.  Both go on where they stopped when called again."""

    def land(batch: DataFrame, _: int) -> None:
        _land(batch, root, base_url, source, tolerant)

    def fold(batch: DataFrame, batch_id: int) -> None:
        kept = tables.staged(batch, root, "kept")
        items = spark.read.parquet(f"{root}/items").drop("run_id")
        mine = items.where(F.col("item_pos").isNotNull()).join(
            kept.select("_landing", "load"), ["_landing", "load"], "left_semi"
        )
        records = listings.check_items(mine.drop("load"))
        load = tables.content_id(kept)
        listings.store_records(spark, records, root, f"paged-{batch_id}", load, CRAWL)

    def finished(writer, name: str) -> StreamingQuery:
        query = writer.option("checkpointLocation", f"{root}/{name}_checkpoint").trigger(availableNow=True).start()
        query.awaitTermination(timeout)
        return query

    first = finished(pages.writeStream.foreachBatch(land), "landing")
    ledger = spark.readStream.schema(LEDGER).parquet(f"{root}/paging_ledger")
    second = finished(kept_landings(ledger, delay).writeStream.foreachBatch(fold), "paging")
    return first, second
