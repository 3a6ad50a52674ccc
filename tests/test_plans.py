"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from vitrine.functions import urls
from vitrine.operators import listing, paging
from vitrine.operators import upsert as U
from vitrine.plans import listings
from vitrine.workload import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def exchanges(frame):
    return re.findall(r"Exchange (\w+)", plan(frame))


def stored_pages(spark, tmp_path):
    path = str(tmp_path / "pages")
    ddl = "series_code string, page_index int, url string, fetched_at timestamp, html string, extra string"
    spark.createDataFrame([], ddl).write.parquet(path)
    return spark.read.parquet(path)


def test_html_is_dropped_before_any_shuffle(spark, tmp_path):
    frame = listings.products(listings.listing_records(stored_pages(spark, tmp_path), "https://s.example"))
    text = plan(frame)
    assert text.count("FileScan") == 1
    shuffled = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    assert [re.sub(r"#\d+L?", "", keys).split(", ")[:-1] for keys in shuffled] == [
        ["product_id"],
        ["series_code"],
        ["series_code", "page_index"],
    ]
    last_generate = text.rindex("Generate posexplode")
    assert "Exchange" not in text[last_generate:]


def test_reading_pages_needs_no_shuffle(spark, tmp_path):
    pages = stored_pages(spark, tmp_path)
    frame = listing.parse_products(pages, "https://s.example", ["series_code"])
    assert exchanges(frame) == []
    assert "extra#" not in plan(frame)


def test_copies_are_reduced_before_the_shuffle(spark, tmp_path):
    pages = stored_pages(spark, tmp_path).drop("html")
    text = plan(paging.latest_copies(pages, ["series_code", "page_index"], [F.desc("fetched_at")]))
    assert "WindowGroupLimit" in text[text.index("Exchange") :]


def test_folds_are_partial(spark):
    ddl = "card_id bigint, lang string, set_code string, card_code string, data_id bigint, rarity string"
    rows = spark.createDataFrame([(1, "en", "S", "1", 1, "R")], ddl)
    text = plan(U.fold(rows, U.CARD_INDEX, ["data_id"]))
    assert text.count("partial_max_by") > 0
    assert exchanges(U.fold(rows, U.CARD_INDEX, ["data_id"])) == ["hashpartitioning"]


def test_small_batches_leave_the_stored_table_unshuffled(spark, tmp_path):
    stored, folded = str(tmp_path / "stored"), str(tmp_path / "folded")
    ddl = "card_id bigint, lang string, set_code string, card_code string, data_id bigint, rarity string"
    for path in (stored, folded):
        spark.createDataFrame([(1, "en", "S", "1", 1, "R")], ddl).write.parquet(path)
    merged = U.merge(spark.read.parquet(stored), spark.read.parquet(folded), U.CARD_INDEX)
    assert "hashpartitioning" not in plan(merged)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = U.merge(spark.read.parquet(stored), spark.read.parquet(folded), U.CARD_INDEX)
        assert "SortMergeJoin" in plan(shuffled) and shuffled.count() == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_query_uses_cross_joins_or_single_tasks(spark):
    for name, query in QUERIES.items():
        text = plan(query(spark, SF_DIR))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
        singles = re.findall(r"Exchange SinglePartition", text)
        assert len(singles) <= (1 if name in {"null_counts", "series_counts"} else 0), name


def test_filters_reach_the_scan(spark):
    text = plan(entry_points.queries()["snapshot_append"](spark, SF_DIR))
    assert "EqualTo(event_type,purchase)" in text


def test_work_lists_are_not_sorted_first(spark):
    for name, shuffles in (("page_frontier", 0), ("card_frontier", 1)):
        frame = entry_points.queries()[name](spark, SF_DIR)
        assert len(exchanges(frame)) == shuffles and "rangepartitioning" not in plan(frame)


def test_steps_of_resolving_are_not_repeated(spark):
    frame = spark.range(1).select(urls.resolve_url("https://s.example/a", F.col("id").cast("string")))
    assert len(re.findall("regexp_", plan(frame))) < 40


def test_patterns_of_first_items_are_not_repeated(spark, tmp_path):
    pages = stored_pages(spark, tmp_path)
    keep = ("series_code", "page_index")
    without = plan(listing.explode_blocks(pages, keep))
    text = plan(listing.explode_blocks(pages, keep, "https://s.example"))
    tags = [piece for piece in (listing.LINK, "data\\-product\\-id", "(?i:href)") if piece in text]
    assert len(tags) == 3 and all(text.count(piece) - without.count(piece) <= 1 for piece in tags)
