"""Both extraction routes on small pages, regular and broken ones."""

from __future__ import annotations

import random
import time
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vitrine.functions import html as H
from vitrine.operators import cards, dom, inspect, listing
from vitrine.plans import cards as card_plan
from vitrine.plans import listings
from vitrine.workload import inputs

BASE = "https://shop.example"


def block(pid, href, name, model, price, css="item_data"):
    link = "" if href is None else f' href="{href}"'
    return (
        f'<div class="{css}" data-product-id="{pid}"><a class="item_data_link"{link}>\n'
        f'<p class="item_name"><span class="goods_name"> {name} </span>\n'
        f'<span class="model_number_value">{model}</span></p>\n'
        f'<p class="selling_price"><span class="figure">{price}</span></p></a></div>'
    )


LISTING = (
    "<html><body>"
    + block(101, "/product/101", "〔状態A-〕かがやくゲッコウガ(K仕様)【-】{003/019}", "[SV] SVJP", "79,800円")
    + block(102, "https://x.example/p/102", "ピカチュウ【RR】{025/165}", "SV2a", "1,280円", "list item_data")
    + block(103, "/product/103", "プロモ{SVP-001}", "SVP", "500円")
    + block(104, "/product/104", "ミュウ{151/165}", "SV2a", "SOLD OUT")
    + block(105, "/product/105", "【SR】{001/078}", "S1", "10円")
    + block(106, None, "A &amp; B{1/2}", "", "１,０００円", "item_data wide")
    + "<!-- " + block(999, "/x", "x", "x", "1") + " --><div class='item_data_other'></div></body></html>"
)

CARD = """<!-- CARD ID 12 --><!-- DATA ID 7 --><a href="/cards/jp/SV11B/2?translate=en">x</a>
<a data-href="/cards/jp/A/1" href='/cards/jp'>y</a><a href=" /cards/en//2 ">z</a><a>none</a>
<div class="card-prints-current"><div class="prints-current-details"><span class="text-lg">Set</span>
<span>#63 · Uncommon</span></div></div>
<span class="card-price usd">$0.15</span><span class="card-price eur">0.10€</span>"""

ROUTES = pytest.mark.parametrize("route", [(listing, cards, inspect), (dom, dom, dom)], ids=["native", "tolerant"])


def pages(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "page int, html string")


@ROUTES
def test_listing_page(spark, route):
    rows = listing.with_price(route[0].parse_products(pages(spark, LISTING, "", "<p>x</p>"), BASE, ["page"]))
    got = [
        (r.page, r.item_pos, r.product_id, r.name, r.model_number, r.model_code, r.price_yen, r.product_url)
        for r in rows.orderBy("page", "item_pos").collect()
    ]
    assert got == [
        (0, 0, "101", "かがやくゲッコウガ", "003", "SVJP", 79800.0, f"{BASE}/product/101"),
        (0, 1, "102", "ピカチュウ", "025", "SV2a", 1280.0, "https://x.example/p/102"),
        (0, 2, "103", "プロモ", None, "SVP", 500.0, f"{BASE}/product/103"),
        (0, 3, "104", "ミュウ", "151", "SV2a", None, f"{BASE}/product/104"),
        (0, 4, "105", "", "001", "S1", 10.0, f"{BASE}/product/105"),
        (0, 5, "106", "A & B", "1", None, 1000.0, None),
    ]


@ROUTES
def test_page_that_starts_with_a_block(spark, route):
    page = block(1, "/1", "n{1/2}", "m", "1").replace('"', "'")
    assert route[0].parse_products(pages(spark, page), BASE, ["page"]).count() == 1


def test_empty_pages_stay_for_paging(spark):
    rows = listing.explode_blocks(pages(spark, LISTING, "<p>x</p>"), ["page"], BASE)
    got = {(r.page, r.n_items, r.fingerprint) for r in rows.collect()}
    assert got == {(0, 6, ("101", f"{BASE}/product/101")), (1, 0, None)}


@ROUTES
def test_card_page(spark, route):
    later = CARD.replace("<span>#63 · Uncommon</span>", "<span>#63</span>") + "<!-- CARD ID 13 CARD ID -->"
    bare = "<span class='card-price'>9</span><!-- other -->"
    outside = '<div class="prints-current-details"><span>#1 · No</span></div>'
    rows = route[1].card_fields(pages(spark, CARD, later, bare, outside), ["page"])
    assert [tuple(r) for r in rows.orderBy("page").collect()] == [
        (0, "12", "7", "Uncommon", 0.15, 0.10),
        (1, "13", "7", None, 0.15, 0.10),
        (2, None, None, None, None, None),
        (3, None, None, None, None, None),
    ]


@ROUTES
def test_links(spark, route):
    rows = route[1].extract_links(pages(spark, CARD), ["page"])
    got = [(r.lang, r.set_code, r.card_code) for r in rows.orderBy("link_pos").collect()]
    assert got == [("jp", "SV11B", "2"), ("en", "", "2")]
    assert route[1].extract_links(pages(spark, CARD), ["page"], "/cards/en").count() == 1


@ROUTES
def test_inspection(spark, route):
    page = (
        "<html><head><!-- <title>no</title> --><TITLE> a &amp; b </TITLE>"
        '<meta charset="utf-8"><meta name="d" content="1"><meta property=\'og:x\'>'
        "<script src='x'></script><script> var t = '<title>';\n</script></head></html>"
    )
    frame = pages(spark, page, "<p>none</p>")
    assert [tuple(r) for r in route[2].page_titles(frame, ["page"]).orderBy("page").collect()] == [
        (0, " a & b "),
        (1, None),
    ]
    meta = route[2].meta_tags(frame, ["page"]).orderBy("meta_pos")
    assert [tuple(r) for r in meta.collect()] == [(0, 1, "d", None, "1"), (0, 2, None, "og:x", None)]
    scripts = route[2].inline_scripts(frame, ["page"], preview=5).collect()
    assert [tuple(r) for r in scripts] == [(0, 1, "var t", 18)]


def test_tolerant_route_reads_broken_pages(spark):
    inner = block(2, "/2", "in{2/2}", "m2", "2円")
    nested = f"<div class='item_data' data-product-id=1><b title='a > b'>{inner}</b></div>"
    unclosed = block(3, "/3", "<b><span>o</span>ut</b>{3/3}", "m3", "3円").replace("</p>", "")
    rows = dom.parse_products(pages(spark, nested + unclosed), BASE, ["page"]).orderBy("item_pos")
    got = [(r.product_id, r.name, r.model_number, r.price) for r in rows.collect()]
    assert got == [("1", "in", "2", "2円"), ("2", "in", "2", "2円"), ("3", "out", "3", "3円")]


def test_card_ids_that_are_no_numbers_are_rejected(spark):
    frame = pages(spark, CARD, CARD.replace("CARD ID 12", "CARD ID x"), "<p></p>").select(
        F.lit("en").alias("lang"),
        F.lit("S").alias("set_code"),
        F.col("page").cast("string").alias("card_code"),
        F.current_timestamp().alias("fetched_at"),
        "html",
    )
    records = card_plan.card_records(frame)
    assert {(r.card_code, r.card_id, r.reject_reason) for r in records.collect()} == {
        ("0", 12, None),
        ("1", None, "card_id"),
        ("2", None, "card_id"),
    }


def test_both_routes_give_the_same_records(spark):
    crawled = inputs.crawled_pages(spark, "/root/testdata/sf0.001")
    native, tolerant = (
        listings.listing_records(crawled, inputs.SHOP, ["run_id"], tolerant=tolerant)
        for tolerant in (False, True)
    )
    assert sorted(map(str, native.collect())) == sorted(map(str, tolerant.collect()))
    card_frame = inputs.card_pages(spark, "/root/testdata/sf0.001")
    native, tolerant = (card_plan.card_records(card_frame, t) for t in (False, True))
    assert sorted(map(str, native.collect())) == sorted(map(str, tolerant.collect()))


@ROUTES
def test_very_long_pages(spark, route):
    """Megabytes between, around and inside the wanted elements; nothing is cut."""
    filler = "x > ' y " * 150_000
    name = "<b></b>" * 20_000 + "n" + " " * 50_000 + "&amp;{1/2}" + "<i> </i>" * 5_000
    wide = block(1, "/1", name, "m" * 200_000, "5円").replace(
        '<p class="item_name">', f'<p class="item_name"><em>{"z " * 200_000}</em>'
    )
    page = (
        f"<html><!-- {filler} --><script>{filler.replace('>', '&')}</script>"
        + "<p>" * 3_000
        + "</p>" * 3_000
        + wide
        + f"<p>{'t ' * 300_000}</p>"
        + CARD
        + f"<!-- {'-' * 100_000} -->"
    )
    row = route[0].parse_products(pages(spark, page), BASE, ["page"]).first()
    assert (row.model_number, len(row.model_code), row.price) == ("1", 200_000, "5円")
    assert row.name == "n" + " " * 50_000 + "&"
    card = route[1].card_fields(pages(spark, page), ["page"]).first()
    assert (card.card_id, card.rarity, card.usd_price) == ("12", "Uncommon", 0.15)
    assert route[1].extract_links(pages(spark, page), ["page"]).count() == 2
    script = route[2].inline_scripts(pages(spark, page), ["page"]).first()
    assert script.script_length == len(script.script_text) == len(filler.strip())


RANKING = '<div class="ranking"><p class="selling_price"><span class="figure">9,999円</span></p></div>'


@ROUTES
def test_blocks_end_where_they_close(spark, route):
    bare = block(1, "/1", "a{1/2}", "m", "5円").replace('<p class="selling_price"><span class="figure">5円</span></p>', "")
    nested = block(2, "/2", "b{2/2}", "m", "6円").replace("<p class=\"selling_price\">", "<div><section><div></div></section></div><p class=\"selling_price\">")
    closed = block(3, "/3", "c{3/3}", "m", "x").replace("<p class=\"selling_price\">", "<div class='x'/><p class=\"selling_price\">")
    page = f"<html><body><div class='list'>{nested}{RANKING}{closed}<hr>{bare}</div>{RANKING}</body></html>"
    rows = route[0].parse_products(pages(spark, page), BASE, ["page"]).orderBy("item_pos").collect()
    assert [(r.product_id, r.name, r.price) for r in rows] == [("2", "b", "6円"), ("3", "c", "x"), ("1", "a", None)]


@ROUTES
def test_attributes_are_read_whole(spark, route):
    links = (
        "<a title=\"see href='/cards/jp/A/1'\" href='/cards/en/B/2'>x</a><a data-x='1 > 0' href=/cards/en/C/3>y</a>"
        "<a\nHREF = \"/cards/en/D/4\" href='/cards/en/E/5'>z</a><a title='href=\"/cards/jp/F/6\"'>n</a><a href>v</a>"
    )
    rows = route[1].extract_links(pages(spark, links), ["page"]).orderBy("link_pos").collect()
    assert [(r.lang, r.set_code, r.card_code) for r in rows] == [("en", "B", "2"), ("en", "C", "3"), ("en", "E", "5")]
    metas = "<meta content=\"name='no' > x\" name=d><meta title=' name=\"q\"' charset=u><meta property='a\"b' content=1/>"
    found = route[2].meta_tags(pages(spark, metas), ["page"]).orderBy("meta_pos").collect()
    assert [(r.meta_pos, r.meta_name, r.meta_property, r.meta_content) for r in found] == [
        (0, "d", None, "name='no' > x"), (2, None, 'a"b', "1/"),
    ]
    prices = (
        "<span title=\" class='card-price usd' \">$9</span><span id=1 class=\"usd x card-price\" title='a>b'>$0.5</span>"
        "<span data-class='card-price eur'>8</span><span class=card-price-eur>7</span><span class='card-price eur'>6</span>"
    )
    row = route[1].card_fields(pages(spark, prices), ["page"]).first()
    assert (row.usd_price, row.eur_price) == (0.5, 6.0)
    trap = block(1, "/right", "n{1/2}", "m", "1円").replace("data-product-id", "title=\" data-product-id='9' class='x' > \" data-product-id")
    row = route[0].parse_products(pages(spark, trap.replace("<a class", "<a title=' href=\"/wrong\" ' class")), BASE, ["page"]).first()
    assert (row.product_id, row.product_url) == ("1", f"{BASE}/right")


@ROUTES
def test_rarity_is_found_in_nested_boxes_only(spark, route):
    def box(inner, before=""):
        return f"<div class='x card-prints-current'>{before}<div class='prints-current-details'>{inner}</div></div>"

    plain = "<span>#1 · Rare</span>"
    cases = [
        box(f"<div><div>a</div></div><section>{plain}</section>"),
        box("<span class='a text-lg'>S · 1</span>", plain) + plain,
        f"<div class='prints-current-details'>{plain}</div>" + box("") + f"<div class='prints-current-details'>{plain}</div>",
        box("") + box("<div></div><span>#2 · Two<b>!</b></span>") + box(plain),
        "<section class=card-prints-current><article class=prints-current-details><span>· S</span></article></section>",
        "<div class='card-prints-current prints-current-details'>" + plain + "</div>",
        box("<span class='text-lg'>no</span>" + "<i>x</i>" * 3 + "<span title='text-lg'>#3 · Three</span>"),
    ]
    rows = route[1].card_fields(pages(spark, *cases), ["page"]).orderBy("page").collect()
    assert [r.rarity for r in rows] == ["Rare", None, None, "Two!", "S", None, "Three"]


@ROUTES
def test_titles_that_are_no_single_text_are_null(spark, route):
    titles = ["<title></title>", "<title>a <b>c</b></title>", "<title> a < b &amp; c </title><title>d</title>"]
    rows = route[2].page_titles(pages(spark, *titles), ["page"]).orderBy("page").collect()
    assert [r.title for r in rows] == [None, None, " a < b & c "]


def test_native_readers_are_linear_in_boxes(spark):
    def seconds(n):
        page = "<div class='card-prints-current'><div class='prints-current-details'><div></div></div></div>" * n
        frame = pages(spark, page + CARD).cache()
        frame.count()
        best = 1e9
        for _ in range(2):
            start = time.perf_counter()
            assert cards.card_fields(frame, ["page"]).first().rarity == "Uncommon"
            best = min(best, time.perf_counter() - start)
        return best

    seconds(100)
    assert seconds(20_000) < 20 * seconds(2_000) + 2


def test_flattening_is_linear_in_unclosed_tags(spark):
    def seconds(n):
        start = time.perf_counter()
        nodes = dom._flatten("<b><i></u></b>" * n + "<p>" * n + "</x>" * n + "</div>" * n)
        assert len(nodes) == 3 * n
        return time.perf_counter() - start

    seconds(1000)
    assert seconds(50_000) < 30 * seconds(5_000) + 1
    page = "<div><p>" * 25_000 + CARD + block(1, "/1", "n{1/2}", "m", "1円")
    assert dom.card_fields(pages(spark, page), ["page"]).first().rarity == "Uncommon"
    assert dom.parse_products(pages(spark, page), BASE, ["page"]).first().price == "1円"


def test_a_worker_holds_the_nodes_of_few_pages():
    page = "<ul>" + "<li class='a b' title='t'>x</li>" * 50 + "</ul>"
    pages_in = pa.array([page, None, ""] * 4000)

    def peak(count):
        tracemalloc.start()
        lengths = [len(nodes) for nodes in dom.page_nodes.func(iter([pages_in[:count]]))]
        found = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert sum(lengths) == count
        return found

    assert peak(12_000) < 1.5 * peak(3_000)


@pytest.mark.parametrize("n", [1, 700])
def test_nodes_stay_with_their_page(spark, n):
    """Pages of one task leave Python in several batches, among them pages without nodes."""
    rows = [
        (i, None if i % 7 == 3 else f"<!--{'x' * 2000}--><a href='/cards/en/S/{i}'>&amp;</a><script>s{i}</script>")
        for i in range(n)
    ]
    frame = spark.createDataFrame(rows, "page int, html string").coalesce(1)
    shown = [i for i, html in rows if html is not None]
    links = dom.extract_links(frame, ["page"]).collect()
    assert sorted((r.page, r.card_code) for r in links) == [(i, str(i)) for i in shown]
    scripts = dom.inline_scripts(frame, ["page"]).collect()
    assert sorted((r.page, r.script_text) for r in scripts) == [(i, f"s{i}") for i in shown]


def test_blocks_of_one_pass_are_the_blocks_of_a_sweep(spark):
    parts = [
        "<div class='item_data'>", "<div class=item_data id=a>", "</div>", "</DIV >", "<div>", "</section>", "text",
        "<section x='a>b'>", "<div/>", "<div class='item_data'/>", "<p title='</div>'>", "</div <b>", "</div", "<",
        "<div title='<div class=item_data>'>", "<div title='<' class='item_data'>", "<b x=<div>", "<!--</div>-->",
    ]
    make = random.Random(5)
    odd = ["".join(make.choices(parts, k=make.randint(0, 14))) for _ in range(3000)]
    even = ["<div class='item_data'><p>a</p><div>b<div>c</div></div></div>x" * n for n in range(4)]
    frame = pages(spark, *odd, *even, None)
    shown = H.without_hidden(F.col("html"))
    plain = frame.select("page", shown.alias("shown"), listing.split_blocks(F.col("html")).alias("blocks"))
    swept = plain.select("page", "blocks", listing.any_blocks(F.col("shown")).alias("expected")).cache()
    assert swept.where("not (blocks <=> expected)").collect() == []
    once = frame.select(H.closed_boxes(shown, listing.BLOCK).alias("found")).where("size(found) > 0")
    assert once.where("not array_contains(found, '<')").count() > 100
