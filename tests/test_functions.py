"""Golden rows for the column functions."""

from __future__ import annotations

import html as stdlib_html
import random
from html.entities import html5
import re
from urllib.parse import urljoin, urlparse

import pytest
from pyspark.sql import functions as F

from vitrine.functions import html, prices, text, times, urls


def apply(spark, function, values):
    rows = [(i, value) for i, value in enumerate(values)]
    frame = spark.createDataFrame(rows, "i int, v string")
    return [r.out for r in frame.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()]


NAMES = [
    ("〔状態A-〕かがやくゲッコウガ(K仕様)【-】{003/019}", "かがやくゲッコウガ", "状態A-", "003", "019"),
    ("ピカチュウ【RR】{025/165}", "ピカチュウ", None, "025", "165"),
    ("リザードン{006 / 165}", "リザードン", None, "006", "165"),
    ("リザードン{ 006/165}", "リザードン", None, None, None),
    ("プロモ{SVP-001}", "プロモ", None, None, None),
    ("【SR】{001/078}", "", None, "001", "078"),
    ("〔〕ミュウ{151/165}", "ミュウ", "", "151", "165"),
    ("A(B(C)D)E{1/2}", "AD)E", None, "1", "2"),
    ("ミュウ（特別）{205/165}", "ミュウ（特別）", None, "205", "165"),
    ("〔状態Aミュウ{151/165}", "〔状態Aミュウ", None, "151", "165"),
    ("ミュウ{１/２}", "ミュウ", None, "１", "２"),
    ("〔状態B〕〔鑑定〕ミュウ{1/2}{3/4}", "ミュウ", "状態B", "1", "2"),
    ("　ミュウ　【a b】 ", "ミュウ", None, None, None),
    (None, None, None, None, None),
    ("", None, None, None, None),
]


@pytest.mark.parametrize(
    "function, column",
    [(text.clean_name, 1), (text.condition_of, 2), (text.card_number, 3), (text.set_size, 4)],
)
def test_name_parts(spark, function, column):
    assert apply(spark, function, [row[0] for row in NAMES]) == [row[column] for row in NAMES]


def test_yen_price(spark):
    cases = {
        "79,800円": 79800.0,
        "999": 999.0,
        "¥1,234.50": 1234.0,
        "1,2,3円": 123.0,
        "SOLD OUT": None,
        "": None,
        ",": None,
        "０円": 0.0,
        "１２,３４5円": 12345.0,
        "٣٤": 34.0,
    }
    assert apply(spark, prices.yen_price, list(cases)) == list(cases.values())
    assert apply(spark, prices.yen_price, [None]) == [None]


def test_decimal_price(spark):
    cases = {"$0.15": 0.15, "1,234.56€": 1.0, "12.": 12.0, "- .5": 5.0, "$": None, "１.５": 1.5}
    assert apply(spark, prices.decimal_price, list(cases)) == list(cases.values())


def test_model_code(spark):
    cases = {
        "[SV] SVJP": "SVJP",
        "SVJP": "SVJP",
        "[a][b]X": "[b]X",
        "[S]": "[S]",
        "": None,
        "[a]　X　": "X",
    }
    assert apply(spark, text.model_code, list(cases)) == list(cases.values())


def test_strip_matches_python(spark):
    samples = [" a ", "　a b　", "\x1ca\x1f\x85", "​a", "\t\n", "", "a", "\xa0é "]
    assert apply(spark, text.strip, samples) == [s.strip() for s in samples]


def test_safe_name(spark):
    samples = ["SV1", " a/b c ", "SV２a", "..x-_", "é"]
    expected = [re.sub("[^a-zA-Z0-9._-]+", "_", s.strip()) for s in samples]
    assert apply(spark, text.safe_name, samples) == expected


def test_entities_match_standard_library(spark):
    samples = [
        "a &amp; b",
        "&amp;lt; &lt;",
        "&#12354;&#x3042;&#X41;",
        "&#146;&#x80;",
        "&#0;&#xD800;&#99999999;",
        "&nosuch; &",
        "&amp",
        "x&;y&#;z&#x;",
        "&eacute;&copy;&apos;&quot;&nbsp;.",
        "&#128512;",
        "plain",
        "",
    ]
    rng = random.Random(3)
    names = list(html5)
    scraps = ["&", ";", "#", "x", "1", "amp", "not", "it", "&#", "&#x", "0", "9", "F", " ", "=", "é", "<", "&amp", "&copy=2"]
    samples += [f"&{name}" for name in names] + [f"&{name.rstrip(';')}q" for name in names]
    samples += [f"&#{n}{end}" for n in (*range(0, 300), 338, 8364, 55295, 55296, 57344, 64975, 64976, 65007, 65008, 65533, 65534, 65535, 65536, 131070, 1114109, 1114111, 1114112, 10**20) for end in (";", "", "z")]
    samples += [f"&#x{n:x};" for n in (0, 1, 127, 128, 159, 160, 233, 0x1F600, 0xD800, 0x110000, 16**30)]
    samples += ["".join(rng.choice([*scraps, rng.choice(names)]) for _ in range(rng.randint(1, 12))) for _ in range(3000)]
    assert apply(spark, text.decode_entities, samples) == [stdlib_html.unescape(s) for s in samples]
    assert apply(spark, text.decode_entities, [None]) == [None]


def test_visible_text(spark):
    cases = {
        " a ": "a",
        "a <b> b </b> c": "abc",
        "#63 · <i>Un</i>common": "#63 ·Uncommon",
        "<b>x</b>&nbsp;<b>y</b>": "xy",
        "a&lt;b&gt; c": "a<b> c",
        "a <!-- > --> b": "ab",
        "x&amp;nbsp;y": "x&nbsp;y",
        "": "",
    }
    visible = lambda fragment: text.strip(text.decode_entities(html.without_tags(fragment)))
    assert apply(spark, visible, list(cases)) == list(cases.values())


BASES = ["https://shop.example", "https://shop.example/", "https://shop.example/a/b/c?x=1#f"]
REFS = [
    "/product/1",
    "product/1",
    "./p",
    "../p",
    "../../p",
    "../../../../p",
    "/a/../b/./c",
    "/a/b/..",
    "/a/b/.",
    ".",
    "..",
    "//cdn.example/x",
    "https://o.example/x",
    "http://o.example",
    "mailto:a@b",
    "?page=2",
    "#top",
    "x?y=../z",
    "a//b",
    "/p;v=1?q#f",
    "x:y/z",
    "商品/1",
    " /product/1",
    "\n/product/2",
    "/pro\nduct/3",
    " https://x.example/p",
    "https:foo",
    "https:/foo",
    "HTTPS:?q",
]


@pytest.mark.parametrize("base", BASES)
def test_resolve_url_matches_standard_library(spark, base):
    got = apply(spark, lambda ref: urls.resolve_url(base, ref), REFS)
    assert dict(zip(REFS, got)) == {ref: urljoin(base, ref) for ref in REFS}
    assert apply(spark, lambda ref: urls.resolve_url(base, ref), [None, ""]) == [None, None]


def test_page_url(spark):
    bases = [
        "https://s.example/product-list/5",
        "https://s.example/product-list/5//",
        "https://s.example",
        "https://s.example/list?keyword=a",
        "https://s.example/a/list?k=a/b",
        "https://s.example//a//list/",
    ]
    got = apply(spark, lambda base: urls.page_url(base, F.lit(3), 50), bases)
    leaf = "0/photo?num=50&page=3"
    assert dict(zip(bases, got)) == {b: urljoin(b.rstrip("/") + "/", leaf) for b in bases}


def test_card_url(spark):
    languages = apply(
        spark, lambda lang: urls.card_url("https://c.example/cards/", lang, F.lit("S"), F.lit("7")), ["jp", "en"]
    )
    assert languages == [
        "https://c.example/cards/jp/S/7?translate=en",
        "https://c.example/cards/en/S/7",
    ]


def test_url_path_matches_standard_library(spark):
    samples = REFS + ["https://x.example/a b/c?d#e", "/cards/en//2", "/a;b/c;d?e", "//h", ""]
    samples.remove("x:y/z")
    assert apply(spark, urls.url_path, samples) == [urlparse(s).path for s in samples]


def test_groups_and_paths(spark):
    assert apply(spark, urls.product_group, ["/product-group/268/0?x", "/product-group/x", None]) == [
        "268",
        None,
        None,
    ]
    assert apply(spark, urls.card_path, ["https://x/cards/en/A/2?translate=en", "https://x/c"]) == [
        "/cards/en/A/2",
        None,
    ]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/New_York"])
def test_times_are_utc_in_any_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        iso = ["2024-03-10T02:30:00.000001+00:00", "2024-03-01T23:59:59+00:00"]
        assert apply(spark, lambda v: times.iso_utc(times.from_iso(v)), iso) == iso
        assert apply(spark, lambda v: times.compact_stamp(times.from_iso(v)), iso) == [
            "20240310T023000Z",
            "20240301T235959Z",
        ]
        days = apply(spark, lambda v: times.utc_date(times.from_iso(v)).cast("string"), iso)
        assert days == ["2024-03-10", "2024-03-01"]
        assert apply(spark, times.from_iso, ["soon"]) == [None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
