"""Files, versioned tables, run appends, whole plans and their streaming form."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from test_extraction import BASE, CARD, block

from vitrine import schemas
from vitrine.operators import quality
from vitrine.operators import upsert as U
from vitrine.plans import cards, listings
from vitrine.sources import pages, series, tables
from vitrine.streaming import pages as streaming
from vitrine.streaming import paging as ordered


def landed(spark, rows, source="shop", crawl=None):
    """Rows of (page_index, html, minute[, status]) as listing pages of one series."""
    shaped = [
        (
            source,
            f"S1_{index}",
            f"https://shop.example/product-group/268/0/photo?num=100&page={index}",
            "S1",
            index,
            None,
            None,
            None,
            (status or [200])[0],
            f"2024-03-01T06:{minute:02d}:00+00:00",
            html,
            crawl,
        )
        for index, html, minute, *status in rows
    ]
    names = [f.name for f in schemas.LANDED_PAGES]
    ddl = ", ".join(
        f"{f.name} {'string' if f.name == 'fetched_at' else f.dataType.simpleString()}" for f in schemas.LANDED_PAGES
    )
    frame = spark.createDataFrame(shaped, ddl)
    return frame.withColumn("fetched_at", F.col("fetched_at").cast("timestamp")).select(*names)


def page(*ids, price="1,000円"):
    return "".join(block(i, f"/product/{i}", f"n{i}{{001/002}}", "m", price) for i in ids)


def table(spark, root, name):
    return listings.current_products(spark, root) if name == "products" else cards.current_table(spark, root, name)


def checks(written):
    return {(r.table_name, r.check_name, r.column_name): r.n_rows for r in written.checks.collect()}


def test_page_files_are_read_whole(spark, tmp_path):
    for name in ("S1_1", "S1 2"):
        (tmp_path / f"{name}.html").write_text(page(1, 2) + "\nミュウ\n", encoding="utf-8")
    files = pages.read_page_files(spark, str(tmp_path / "*.html"))
    assert sorted(r.name for r in files.collect()) == ["S1 2", "S1_1"]
    items = listings.saved_listing(files, BASE)
    assert items.groupBy("path").count().select("count").distinct().collect()[0][0] == 2
    assert "ミュウ" in files.first().html


def test_series_lists(spark):
    urls = spark.createDataFrame(
        [("Shop", "B", "u"), ("SHOP", "A", " "), ("other", "C", "u"), ("shop", "A2", "\t"), ("shop", None, "u")],
        schemas.SERIES_URLS,
    )
    assert [r.series_code for r in series.series_urls(urls, "sHop").collect()] == [None, "A2", "B"]
    sizes = spark.createDataFrame([("B", "jp", 2), ("B", "en", 1), ("A", "en", 0), ("C", "en", None)], schemas.SERIES_SIZES)
    assert [tuple(r) for r in series.series_sizes(sizes).collect()] == [("B", "en", 1), ("B", "jp", 2)]


def test_ensure_table(spark):
    spark.sql("create database if not exists shelf")
    for _ in range(2):
        tables.ensure_table(spark, "shelf.price_history", schemas.PRICE_HISTORY, ("captured_date",))
    spark.sql(
        "insert into shelf.price_history (product_id, captured_at, captured_date) "
        "values ('1', timestamp '2024-01-01 00:00:00', date '2024-01-01')"
    )
    tables.ensure_table(spark, "shelf.price_history", schemas.PRICE_HISTORY)
    assert [(r.product_id, r.currency) for r in spark.table("shelf.price_history").collect()] == [("1", "JPY")]


def test_listing_run_is_repeatable(spark, tmp_path):
    root = str(tmp_path / "out")
    first = [(1, page(1, 2, 2), 1), (2, page(3, 4), 2), (3, page(1, 9), 3), (4, page(5), 4)]
    written = listings.write_listings(spark, landed(spark, first), root, BASE, 1)
    assert {(r.page_index, r.n_written) for r in written.counts.collect()} == {(1, 3), (2, 2)}
    second = [(1, page(2, 6, price="2,000円"), 10), (2, page(7, price="SOLD OUT"), 11), (3, "<p></p>", 12)]
    for _ in range(2):
        listings.write_listings(spark, landed(spark, second), root, BASE, 2)
    products = {r.product_id: r for r in table(spark, root, "products").collect()}
    assert sorted(products) == ["1", "2", "3", "4", "6"]
    assert products["2"].price_yen == 2000.0 and products["2"].product_group == "268"
    assert products["2"].created_at < products["2"].updated_at
    assert listings.read_prices(spark, root).count() == spark.read.parquet(f"{root}/prices").count() == 5 + 2
    rejected = quality.rejected(spark.read.parquet(f"{root}/records"))
    assert [(r.product_id, r.reject_reason) for r in rejected.collect()] == [("7", "price_yen")]


def history(spark, root):
    rows = spark.read.schema(schemas.PRICE_HISTORY).parquet(f"{root}/price_history").collect()
    return {(r.product_id, str(r.captured_date)): (r.price, r.currency, r.captured_at.minute) for r in rows}


def test_late_and_reused_runs_lose_nothing(spark, tmp_path):
    visits = {
        "7": (7, [(1, page(1, 70, price="700円"), 20)]),
        "5": (5, [(1, page(1, 50, price="500円"), 10)]),
        "7'": (7, [(1, page(1, 71, price="710円"), 30)]),
    }
    seen = []
    for order in (("7", "5", "7'"), ("7'", "7", "5"), ("5", "7", "7", "7'", "5")):
        root = str(tmp_path / "-".join(order).replace("'", "x"))
        for name in order:
            run_id, rows = visits[name]
            written = listings.write_listings(spark, landed(spark, rows), root, BASE, run_id)
        found = {r.product_id: (r.price_yen, r.created_at.minute, r.updated_at.minute) for r in table(spark, root, "products").collect()}
        assert found == {"1": (710.0, 10, 30), "70": (700.0, 20, 20), "50": (500.0, 10, 10), "71": (710.0, 30, 30)}
        assert history(spark, root)["1", "2024-03-01"] == (710.0, "JPY", 30)
        assert listings.read_prices(spark, root).count() == 6
        seen.append(sorted(map(str, history(spark, root).items())))
        assert set(checks(written).values()) <= {0, 2, 4}
        assert checks(written)["price_history", "reference", "product_id"] == 0
    assert seen[0] == seen[1] == seen[2]


def test_compaction_changes_no_row(spark, tmp_path):
    root = str(tmp_path / "out")
    path = f"{root}/products"
    tables.compact(spark, path, U.PRODUCTS)
    assert table(spark, root, "products").count() == 0
    for run_id, rows in ((1, [(1, page(1, 2), 1)]), (2, [(1, page(2, 3, price="9円"), 2)])):
        listings.write_listings(spark, landed(spark, rows), root, BASE, run_id)
    before = sorted(map(str, table(spark, root, "products").collect()))
    tables.compact(spark, path, U.PRODUCTS)
    assert tables.generation(spark, path) == 1
    assert tables.read_states(spark, path).count() == 3
    assert sorted(map(str, table(spark, root, "products").collect())) == before
    listings.write_listings(spark, landed(spark, [(1, page(4), 3)]), root, BASE, 3)
    listings.write_listings(spark, landed(spark, [(1, page(2, price="1円"), 0)]), root, BASE, 0)
    assert {r.product_id: r.price_yen for r in table(spark, root, "products").collect()} == {"1": 1000.0, "2": 9.0, "3": 9.0, "4": 1000.0}


def test_a_late_capture_rewrites_its_day_only(spark, tmp_path):
    root = str(tmp_path / "out")
    rows = [("1", "2024-03-01 10:00", 5.0), ("2", "2024-03-01 10:00", 6.0), ("1", "2024-03-02 09:00", 7.0)]
    ddl = "product_id string, at string, price double"

    def captures(some):
        return spark.createDataFrame(some, ddl).selectExpr(
            "product_id", "cast(at as timestamp) as captured_at", "price", "cast(null as string) as currency", "cast(null as string) as stock_status"
        )

    path = f"{root}/price_history"
    tables.fold_days(captures(rows), path, schemas.PRICE_HISTORY, root, ("price",))
    untouched = sorted(str(f) for f in (tmp_path / "out/price_history/captured_date=2024-03-02").glob("*.parquet"))
    late = [("1", "2024-03-01 08:00", 1.0), ("2", "2024-03-01 11:00", 2.0), ("3", "2024-03-01 00:00", 3.0)]
    for _ in range(2):
        tables.fold_days(captures(late), path, schemas.PRICE_HISTORY, root, ("price",))
    found = {k: v[0] for k, v in history(spark, root).items()}
    assert found == {("1", "2024-03-01"): 5.0, ("2", "2024-03-01"): 2.0, ("3", "2024-03-01"): 3.0, ("1", "2024-03-02"): 7.0}
    assert sorted(str(f) for f in (tmp_path / "out/price_history/captured_date=2024-03-02").glob("*.parquet")) == untouched


def test_two_runs_publish_one_table(spark, tmp_path):
    root = str(tmp_path / "out")
    listings.write_listings(spark, landed(spark, [(1, page(1, 2), 1)]), root, BASE, 1)
    listings.write_listings(spark, landed(spark, [(1, page(2, 3, price="5円"), 2)]), root, BASE, 2)
    rows = table(spark, root, "products").collect()
    assert {(r.product_id, r.price_yen) for r in rows} == {("1", 1000.0), ("2", 5.0), ("3", 5.0)}


def test_all_landed_pages_are_kept(spark, tmp_path):
    root = str(tmp_path / "out")
    rows = [(i, page(i), i) for i in range(1, 21)] + [(None, page(99), 30)]
    listings.write_listings(spark, landed(spark, rows), root, BASE, 1)
    assert spark.read.parquet(f"{root}/records").count() == 20
    unpaged = spark.read.parquet(f"{root}/unpaged").collect()
    assert [(r.page_index, r.reject_reason) for r in unpaged] == [(None, "page_index")]
    listings.write_listings(spark, landed(spark, rows), root, BASE, 2, max_pages=14)
    cut = spark.read.parquet(f"{root}/unpaged").where("run_id = 2").collect()
    assert sorted(r.page_index or 0 for r in cut) == [0, 15, 16, 17, 18, 19, 20]


def card_rows(spark, rows):
    frame = spark.createDataFrame(rows, "lang string, set_code string, card_code string, minute int, html string")
    at = F.timestamp_add("MINUTE", F.col("minute"), F.expr("timestamp '2024-03-01 06:00:00+00:00'"))
    return frame.withColumn("fetched_at", at)


def test_card_run(spark, tmp_path):
    root = str(tmp_path / "out")
    bare = "<!-- CARD ID 12 --><span class='card-price usd'>$0.20</span>"
    jp = CARD.replace("CARD ID 12", "CARD ID 30")
    written = cards.write_cards(
        spark, card_rows(spark, [("en", "B", "2", 0, CARD), ("jp", "B", "2", 0, jp), ("en", "B", "9", 0, "<p>")]), root, 1
    )
    assert [(r.card_code, r.reject_reason) for r in written.rejects.collect()] == [("9", "card_id")]
    assert checks(written)["card_index", "rows", None] == 2 and checks(written)["card_prices", "rows", None] == 1
    clash = CARD.replace("CARD ID 12", "CARD ID 13")
    late = cards.write_cards(spark, card_rows(spark, [("en", "B", "2", -5, clash), (None, "C", "1", 0, CARD.replace("ID 12", "ID 14"))]), f"{root}/c", 0)
    late = cards.write_cards(spark, card_rows(spark, [("en", "B", "2", 0, CARD)]), f"{root}/c", 1)
    assert checks(late)["card_index", "key", "lang,set_code,card_code"] == 2
    assert checks(late)["card_index", "key", "card_id"] == checks(late)["card_prices", "reference", "card_id"] == 0
    cards.write_cards(spark, card_rows(spark, [("en", "B", "3", 5, bare)]), root, 2)
    index = table(spark, root, "card_index")
    assert {tuple(r) for r in index.collect()} == {
        (12, 7, "en", "B", "3", "Uncommon"),
        (30, 7, "jp", "B", "2", "Uncommon"),
    }
    prices = table(spark, root, "card_prices")
    assert [tuple(r) for r in prices.collect()] == [(12, 7, "en", "B", "3", "Uncommon", 0.2, 0.1)]
    assert quality.duplicate_keys(index, ["lang", "set_code", "card_code"]).count() == 0


def test_archive_keeps_every_run_and_shows_the_latest(spark):
    spark.sql("create database if not exists attic")
    for run, html in ((1, "old"), (2, "newer"), (2, "new")):
        rows = landed(spark, [(1, html, run), (2, f"x{html}", 9 - run)]).withColumn(
            "path", pages.archive_path(F.lit(None), F.lit("raw"), F.col("name"), F.col("fetched_at"))
        )
        pages.ensure_archive(spark, "attic.raw", rows.schema, buckets=4)
        pages.append_archive(rows, "attic.raw", f"run '{run}'")
    stored = spark.table("attic.raw")
    assert stored.count() == 4 and {r.run_id for r in stored.collect()} == {"run '1'", "run '2'"}
    latest = {r.path: r.html for r in pages.latest_per_name(stored).collect()}
    assert latest == {"raw/S1_1.html": "new", "raw/S1_2.html": "xold"}


def test_an_archive_table_shows_the_latest_without_moving_html(spark):
    spark.sql("create database if not exists attic")
    rows = landed(spark, [(i, "p" * i, i) for i in range(1, 30)]).withColumn("path", F.col("name"))
    pages.ensure_archive(spark, "attic.still", rows.schema, buckets=4)
    for run in ("a", "b"):
        pages.append_archive(rows, "attic.still", run)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        latest = pages.latest_per_name(spark.table("attic.still"))
        assert "Exchange" not in latest._jdf.queryExecution().executedPlan().toString()
        assert latest.count() == 29
        unsorted = pages.latest_per_name(rows.repartition(3))
        plan = unsorted._jdf.queryExecution().executedPlan().toString()
        assert "WindowGroupLimit" in plan[plan.index("Exchange") :]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_listing_stream_equals_batch(spark, tmp_path):
    incoming, root = str(tmp_path / "in"), str(tmp_path / "out")
    visits = [
        [(1, page(1, 2), 1), (2, page(3), 2)],
        [(3, page(4), 3), (9, page(8), 4, 500)],
        [(4, page(1), 5), (5, page(5), 6)],
        [(6, page(6), 7)],
    ]
    for rows in visits:
        landed(spark, rows).coalesce(1).write.mode("append").parquet(incoming)
        stream = streaming.landed_stream(spark, incoming, files_per_batch=1)
        streaming.stream_listings(stream, root, BASE).start().awaitTermination(120)
    products = table(spark, root, "products")
    whole = pages.fetched(landed(spark, [row for rows in visits for row in rows]))
    expected = listings.products(listings.listing_records(whole, BASE))
    failures = spark.read.parquet(f"{root}/failed")
    assert [(r.page_index, r.status) for r in failures.collect()] == [(9, 500)] and "html" not in failures.columns
    assert {r.product_id for r in products.collect()} == {r.product_id for r in expected.collect()} == {"1", "2", "3", "4"}
    before = sorted(map(str, products.collect()))
    replay = landed(spark, visits[1])
    streaming.fold_listings(spark, replay, 1, root, BASE)
    assert sorted(map(str, table(spark, root, "products").collect())) == before
    assert listings.read_prices(spark, root).count() == spark.read.parquet(f"{root}/prices").count() == 4


def test_crawls_of_a_stream_are_paged_apart(spark, tmp_path):
    incoming, root = str(tmp_path / "in"), str(tmp_path / "out")
    first = [(1, page(1, 2), 1), (2, page(3), 2), (3, page(99), 3, 500), (4, page(4), 4), (5, page(1), 5), (6, page(98), 6)]
    second = [(1, page(1, 5), 11), (2, page(6), 12), (3, page(1), 13), (4, page(97), 14)]
    landed(spark, [(1, page(96), 1)], source="other").coalesce(1).write.mode("append").parquet(incoming)
    for low in (0, 3):
        for rows, crawl in ((first, "a"), (second, "b")):
            landed(spark, rows[low : low + 3], crawl=crawl).coalesce(1).write.mode("append").parquet(incoming)
            stream = streaming.landed_stream(spark, incoming, files_per_batch=1)
            streaming.stream_listings(stream, root, BASE, source="shop").start().awaitTermination(120)
    whole = landed(spark, first, crawl="a").unionByName(landed(spark, second, crawl="b"))
    expected = listings.products(listings.listing_records(pages.fetched(whole), BASE, run=["crawl_id"]))
    names = sorted(expected.columns)
    assert sorted(map(str, table(spark, root, "products").select(names).collect())) == sorted(map(str, expected.select(names).collect()))
    assert {r.product_id for r in expected.collect()} == {"1", "2", "3", "4", "5", "6"}
    assert spark.read.parquet(f"{root}/failed").count() == 1


def test_a_stream_that_starts_anew_overwrites_nothing(spark, tmp_path):
    root = str(tmp_path)
    streaming.fold_listings(spark, landed(spark, [(1, page(1), 1)], crawl="a"), 0, root, BASE)
    streaming.fold_listings(spark, landed(spark, [(1, page(2), 2)], crawl="b"), 0, root, BASE)
    assert {r.product_id for r in table(spark, root, "products").collect()} == {"1", "2"}
    assert spark.read.parquet(f"{root}/records").count() == 2


def test_card_stream(spark, tmp_path):
    incoming, root = str(tmp_path / "in"), str(tmp_path / "out")
    rows = card_rows(spark, [("en", "B", "2", 0, CARD)])
    names = [f.name for f in schemas.LANDED_PAGES]
    full = rows.withColumn("status", F.lit(200)).withColumn("page_index", F.lit(1))
    for name in ("source", "name", "url", "series_code", "crawl_id"):
        full = full.withColumn(name, F.lit("x"))
    full.select(*names).write.parquet(incoming)
    streaming.stream_cards(streaming.landed_stream(spark, incoming), root).start().awaitTermination(120)
    assert table(spark, root, "card_prices").first().usd_price == 0.15


def test_stream_keeps_pages_without_a_number(spark, tmp_path):
    root = str(tmp_path)
    streaming.fold_listings(spark, landed(spark, [(1, page(1), 1), (None, page(2), 2), (0, page(3), 3)]), 0, root, BASE)
    found = spark.read.parquet(f"{root}/unpaged").collect()
    assert {(r.page_index, r.reject_reason) for r in found} == {(None, "page_index"), (0, "page_index")}


def test_series_state_keeps_what_the_batch_keeps():
    rng = random.Random(6)
    for _ in range(300):
        pages_ = [(i, rng.choice([3, 3, 3, 3, 0, -1]), rng.choice("abcdefg")) for i in range(1, 9) if rng.random() < 0.9]
        wanted, first = [], {1: f for i, n, f in pages_ if i == 1 and n > 0}.get(1)
        for i, n, f in pages_:
            if n == 0 or (n > 0 and i > 1 and f == first and first is not None):
                break
            wanted += [i] if n > 0 else []
        state, kept = ordered.SeriesState(), []
        rng.shuffle(pages_)
        for i, n, f in pages_:
            for _ in range(rng.choice([1, 1, 2])):
                kept += [p for p, _, _ in state.land(i, 100 + i, n, f, i, "l")]
                state = ordered.SeriesState(state.text())
        kept += [p for p, _, _ in state.release(gaps=True)]
        assert sorted(kept) == wanted


def test_pages_of_a_stream_may_land_in_any_order(spark, tmp_path):
    incoming, root = str(tmp_path / "in"), str(tmp_path / "out")
    first = [(1, page(1, 2), 1), (2, page(3), 2), (3, page(99), 3, 500), (4, page(4), 4), (5, page(1), 5), (6, page(98), 6)]
    second = [(1, page(1, 5, price="7円"), 11), (2, page(6), 12), (3, "<p></p>", 13), (4, page(97), 14)]
    batches = [(first[3:5], "a"), (second[2:], "b"), (first[5:] + first[1:2], "a"), (second[:1], "b"), (first[:1] + first[2:3], "a"), (second[1:2], "b")]
    for rows, crawl in batches:
        landed(spark, rows, crawl=crawl).coalesce(1).write.mode("append").parquet(incoming)
        stream = streaming.landed_stream(spark, incoming, files_per_batch=1)
        ordered.run_ordered_listings(spark, stream, root, BASE, "shop", timeout=120)
    whole = landed(spark, first, crawl="a").unionByName(landed(spark, second, crawl="b"))
    expected = listings.products(listings.listing_records(pages.fetched(whole), BASE, run=["crawl_id"]))
    names = sorted(expected.columns)
    assert sorted(map(str, table(spark, root, "products").select(names).collect())) == sorted(map(str, expected.select(names).collect()))
    assert {r.product_id for r in expected.collect()} == {"1", "2", "3", "4", "5", "6"}
    assert listings.read_prices(spark, root).count() == 7
    assert [r.page_index for r in spark.read.parquet(f"{root}/failed").collect()] == [3]
