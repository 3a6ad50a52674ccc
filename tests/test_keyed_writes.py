"""Folds, merges, paging and checks against row-by-row brute force."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from vitrine.operators import frontier, paging, quality
from vitrine.operators import upsert as U

POLICY = U.Policy(key="k", last=("a",), last_non_null=("b", "c"), first=("t0",))
SCHEMA = "n int, k string, a int, b int, c string, t0 int"
STATE = "k string, a int, b int, c string, t0 int"


def apply_rows(state, rows):
    """Row-by-row application, the way a database upsert works."""
    for n, k, a, b, c, t0 in sorted(rows):
        if k in state:
            old = state[k]
            state[k] = (a, b if b is not None else old[1], c if c is not None else old[2], old[3])
        else:
            state[k] = (a, b, c, t0)
    return state


def random_rows(seed, start, count):
    rng = random.Random(seed)
    maybe = lambda value: None if rng.random() < 0.4 else value
    keys = ["hot"] * 6 + [f"k{i}" for i in range(12)]
    return [
        (n, rng.choice(keys), maybe(rng.randrange(9)), maybe(rng.randrange(9)), maybe(rng.choice("xyz")), n)
        for n in range(start, start + count)
    ]


def as_state(frame):
    return {r.k: (r.a, r.b, r.c, r.t0) for r in frame.collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_batches_equal_row_by_row_upserts(spark, seed):
    rows = random_rows(seed, 0, 120)
    expected = {}
    state = spark.createDataFrame([], STATE)
    for low, high in ((0, 15), (15, 16), (16, 90), (90, 120)):
        batch = rows[low:high]
        expected = apply_rows(expected, batch)
        folded = U.fold(spark.createDataFrame(batch, SCHEMA).repartition(5), POLICY, ["n"])
        state = spark.createDataFrame(U.merge(state, folded, POLICY).collect(), STATE)
        assert as_state(state) == expected


def test_one_fold_equals_many_batches(spark):
    rows = random_rows(7, 0, 200)
    whole = U.fold(spark.createDataFrame(rows, SCHEMA), POLICY, ["n"])
    assert as_state(whole) == apply_rows({}, rows)


def test_reapplying_a_batch_changes_nothing(spark):
    rows = random_rows(9, 0, 60)
    batch = spark.createDataFrame(rows, SCHEMA)
    once = U.upsert(spark.createDataFrame([], STATE), batch, POLICY, ["n"])
    twice = U.upsert(once, batch, POLICY, ["n"])
    assert as_state(once) == as_state(twice)


@pytest.mark.parametrize("seed", [1, 2])
def test_states_do_not_depend_on_order_or_repeats(spark, seed):
    rows = random_rows(seed, 0, 150)
    expected = apply_rows({}, rows)
    parts = [rows[0:40], rows[40:41], rows[41:110], rows[110:150]]
    for order in ((0, 1, 2, 3), (3, 1, 0, 2), (2, 2, 3, 0, 1, 3)):
        states = None
        for i in order:
            fresh = U.state_of(spark.createDataFrame(parts[i], SCHEMA), POLICY, ["n"])
            states = fresh if states is None else U.merge_states(states.unionByName(fresh), POLICY)
        assert as_state(U.values_of(states, POLICY)) == expected


def test_ties_of_arrival_are_settled_by_value(spark):
    rows = [(1, "k", 3, None, "x", 5), (1, "k", 4, 2, None, 6), (1, None, 9, 9, "z", 9)]
    for some in (rows, rows[::-1]):
        found = U.values_of(U.state_of(spark.createDataFrame(some, SCHEMA).repartition(3), POLICY, ["n"]), POLICY)
        assert as_state(found) == {"k": (4, 2, "x", 5)}


def test_card_policies(spark):
    ddl = "n int, card_id bigint, data_id bigint, lang string, set_code string, card_code string, rarity string"
    rows = [(1, 12, 7, "en", "BLK", "2", "Rare"), (2, 12, None, "en", "BLK", "3", None)]
    got = U.fold(spark.createDataFrame(rows, ddl), U.CARD_INDEX, ["n"]).collect()
    assert [r.asDict() for r in got] == [
        {"card_id": 12, "lang": "en", "set_code": "BLK", "card_code": "3", "data_id": 7, "rarity": "Rare"}
    ]


def page_rows():
    series = {
        "A": [(1, 5, "x"), (2, 5, "y"), (3, 5, "x"), (4, 5, "z")],
        "B": [(1, 5, "x"), (2, 0, None), (3, 5, "q")],
        "C": [(1, 5, None), (2, 5, None)],
        "D": [(1, 0, None), (2, 0, None)],
        "E": [(1, 5, "a"), (2, 5, "b"), (3, 5, "b"), (15, 5, "c")],
        "F": [(2, 5, "m"), (3, 5, "m")],
        "G": [(0, 5, "g"), (1, 5, "g"), (2, 5, "h")],
    }
    return [(s, *page) for s, found in series.items() for page in found]


def test_cut_off(spark):
    frame = spark.createDataFrame(page_rows(), "series_code string, page_index int, n_items int, fp string")
    shaped = frame.withColumn("fingerprint", F.when(F.col("n_items") > 0, F.struct("fp")))
    landed = paging.cut_off(shaped.repartition(3)).collect()
    assert ("E", 15) in {(r.series_code, r.page_index) for r in landed}
    cut = {(r.series_code, r.page_index, r.reject_reason) for r in paging.out_of_range(shaped, max_pages=14).collect()}
    assert cut == {("E", 15, "page_cap"), ("G", 0, "page_index")}
    kept = paging.cut_off(shaped.repartition(3), max_pages=14)
    assert sorted((r.series_code, r.page_index) for r in kept.collect()) == [
        ("A", 1),
        ("A", 2),
        ("B", 1),
        ("C", 1),
        ("E", 1),
        ("E", 2),
        ("E", 3),
        ("F", 2),
        ("F", 3),
        ("G", 1),
        ("G", 2),
    ]


def test_cut_off_is_a_prefix_of_each_series(spark):
    rng = random.Random(5)
    rows = [
        (f"s{s}", p, rng.choice([0, 3, 3, 3, 3, 3]), rng.choice("abcdefg"))
        for s in range(40)
        for p in range(1, 18)
    ]
    frame = spark.createDataFrame(rows, "series_code string, page_index int, n_items int, fingerprint string")
    kept = {}
    for r in paging.cut_off(frame).collect():
        kept.setdefault(r.series_code, []).append(r.page_index)
    assert kept
    for pages in kept.values():
        assert sorted(pages) == list(range(1, len(pages) + 1)) and len(pages) <= 14


def test_latest_copies_keeps_whole_copies(spark):
    rows = [("p", 1, 0), ("p", 1, 1), ("p", 1, 2), ("p", 2, 0), ("p", 2, 1), ("q", 1, 0)]
    frame = spark.createDataFrame(rows, "page string, seen int, item int")
    kept = paging.latest_copies(frame, ["page"], [F.desc("seen")])
    assert sorted(tuple(r) for r in kept.collect()) == [("p", 2, 0), ("p", 2, 1), ("q", 1, 0)]


def test_card_frontier_expands_in_runs(spark):
    series = spark.createDataFrame([("A", "en", 25), ("B", "jp", 0), ("C", "jp", None), ("D", "jp", -3)], "series_code string, lang string, size int")
    rows = frontier.card_frontier(series, "https://c.example", run_length=10)
    assert sorted(int(r.card_code) for r in rows.collect()) == list(range(1, 26))
    assert rows.where("name = 'A_7_en'").first().url == "https://c.example/en/A/7"


def test_daily_prices_take_the_latest_of_a_utc_day(spark):
    rows = [
        ("p", "2024-01-01T00:10:00+00:00", 1.0, None),
        ("p", "2024-01-01T23:50:00+00:00", None, None),
        ("p", "2024-01-02T00:00:00+00:00", 3.0, "USD"),
    ]
    frame = spark.createDataFrame(rows, "product_id string, at string, price double, currency string")
    captures = frame.select("product_id", F.col("at").cast("timestamp").alias("captured_at"), "price", "currency", F.lit("in").alias("stock_status"))
    got = U.daily_prices(captures).orderBy("captured_date").collect()
    assert [(str(r.captured_date), r.price, r.currency) for r in got] == [
        ("2024-01-01", None, "JPY"),
        ("2024-01-02", 3.0, "USD"),
    ]


def test_strict_group_check_fails_the_run(spark):
    rows = spark.createDataFrame([("1", None)], "product_id string, product_group string")
    with pytest.raises(Exception, match="product group is missing"):
        quality.require_group(rows, strict=True).collect()


def test_checks(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "c"), (None, "d")], "k int, v string")
    assert [tuple(r) for r in quality.duplicate_keys(rows, ["k"]).collect()] == [(1, 2)]
    nulls = {r.column_name: r.n_nulls for r in quality.null_counts(rows, ["k", "v"]).collect()}
    assert nulls == {"k": 2, "v": 1}
    parent = spark.createDataFrame([(2,), (2,)], "id int")
    assert [tuple(r) for r in quality.orphan_keys(rows, "k", parent, "id").collect()] == [(1, 2)]
