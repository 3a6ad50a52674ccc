"""Inputs derived from the given tables.

The given tables hold no shop or card pages, so Spark builds such pages from ``part``.  The
expressions in capitals are valid in Spark SQL and in the checking engine alike, and are used
by both: pages are built from them on one side, expected values on the other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.workload.registry import table

SHOP = "https://shop.example"
CARDS = "https://cards.example/cards"

# One listing page per part, showing it in four conditions (``i`` is 0 to 3); ten pages per
# series.  A page comes from one row, so building pages groups nothing.
ITEMS = "(select *, unnest([0, 1, 2, 3]) as i from part)"
SERIES_NUMBER = "cast(floor(p_partkey / 10) as bigint)"
SERIES = f"concat('S', cast({SERIES_NUMBER} as string))"
PAGE_INDEX = "(p_partkey % 10 + 1)"

# Item fields as a shop shows them, with the usual gaps.
KEY = "cast(p_partkey * 4 + i as string)"
SIZE = "((p_size + i * 13) % 50 + 1)"
CONDITION = f"case when {SIZE} % 2 = 0 then '状態A-' end"
MODEL_NUMBER = f"case when {SIZE} % 7 <> 0 then lpad(cast({SIZE} as string), 3, '0') end"
SET_SIZE = f"case when {SIZE} % 7 <> 0 then '050' end"
BARE_NAME = f"case when {SIZE} = 13 then '' else p_name end"
NAME_FULL = (
    f"concat(case when {SIZE} % 2 = 0 then '〔状態A-〕' else '' end, {BARE_NAME}, '(', p_type, "
    f"' & co)【-】', case when {SIZE} % 7 <> 0 then concat('{{', lpad(cast({SIZE} as string), "
    "3, '0'), '/050}') else '{SVP-001}' end)"
)
YEN = "(cast(round(p_retailprice * 10) as bigint) + i * 100)"
PRICE_TEXT = (
    f"case when {SIZE} = 50 then 'SOLD OUT' else concat("
    f"cast(cast(floor({YEN} / 1000) as bigint) as string), ',', "
    f"lpad(cast({YEN} % 1000 as string), 3, '0'), '円') end"
)
PRICE_YEN = f"case when {SIZE} <> 50 then cast({YEN} as double) end"
PRODUCT_URL = f"case when {SIZE} <> 17 then concat('{SHOP}/product/', {KEY}) end"


def spread(scan: DataFrame, key: str) -> DataFrame:
    """Narrow rows dealt by key before any page is built from them.

    The given tables are single small files, which would leave page reading to one core.  The
    number is given, as adaptive execution would join so small a shuffle into one partition.
    """
    parts = int(scan.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return scan.repartition(parts, key)


def _items_html(price_text: str) -> Column:
    """HTML of the four items of one part."""
    href = f"case when {SIZE} <> 17 then concat(' href=\"/product/', {KEY}, '\"') else '' end"
    name = f"replace({NAME_FULL}, '&', '&amp;')"
    return F.expr(
        f"""array_join(transform(array(0, 1, 2, 3), i -> concat(
            '<div title="a > b data-product-id=0" class="list item_data" data-product-id="', {KEY},
            '"><a title="see href=/wrong class=x >"', {href}, ' class="item_data_link">\n<p class="item_name"><span class="goods_name"> ', {name},
            '　</span>\n<span class="model_number_value">[', p_brand, '] ', p_type,
            '</span></p>\n<div class="tags"><div>new</div></div>', if({price_text} = '', '', concat(
            '<p class="selling_price"><span class="figure">', {price_text}, '</span></p>')),
            '</a></div>\n')), '')"""
    )


def _page(items: Column) -> Column:
    top = (
        '<!DOCTYPE html><html><head><title>list</title></head><body>'
        '<!-- <div class="item_data" data-product-id="none"></div> -->\n'
    )
    ranking = '<div class="ranking"><p class="selling_price"><span class="figure">9,999円</span></p></div>'
    return F.concat(F.lit(top), items, F.lit(f"{ranking}</body></html>"))


def listing_pages(spark: SparkSession, sf_dir: str, price_text: str = PRICE_TEXT) -> DataFrame:
    """One listing page per part: ``path, series_code, series_number, page_index, html``."""
    part = spread(table(spark, sf_dir, "part"), "p_partkey")
    return part.select(
        F.concat(F.lit("page_"), F.col("p_partkey").cast("string")).alias("path"),
        F.expr(SERIES).alias("series_code"),
        F.expr(SERIES_NUMBER).alias("series_number"),
        F.expr(PAGE_INDEX).cast("int").alias("page_index"),
        _page(_items_html(price_text)).alias("html"),
    )


# Two crawls a day apart; prices end in 5 instead of 0 in the second one.
FIRST_RUN = "timestamp '2024-03-01 06:00:00+00:00'"
SECOND_RUN = "timestamp '2024-03-02 06:00:00+00:00'"
SECOND_PRICE_TEXT = (
    f"case when {SIZE} = 50 then 'SOLD OUT' when {SIZE} = 40 then '' else "
    f"concat('¥', cast({YEN} + 5 as string)) end"
)
SECOND_PRICE_YEN = f"case when {SIZE} not in (40, 50) then cast({YEN} + 5 as double) end"


def _crawl(pages: DataFrame, run_id: int, observed: str) -> DataFrame:
    """Pages of one crawl, with what a shop answers past the end of a series.

    Odd series answer page 6 with an empty page.  Every series answers page 11 with page 1
    again and page 12 with page 2, and page 3 was landed twice, first without items.
    """
    odd = F.col("series_number") % 2 == 1
    index = F.col("page_index")
    kept = F.when(odd & (index == 6), _page(F.lit(""))).otherwise(F.col("html"))
    answers = F.array(
        F.struct(index.alias("page_index"), kept.alias("html"), F.lit(1).alias("landing")),
        F.when(index <= 2, F.struct((index + 10).alias("page_index"), "html", F.lit(1).alias("landing"))),
        F.when(
            index == 3,
            F.struct(index.alias("page_index"), _page(F.lit("")).alias("html"), F.lit(0).alias("landing")),
        ),
    )
    answered = pages.select(
        "series_code", F.inline(F.filter(answers, lambda a: a.isNotNull()))
    )
    seconds = F.col("page_index") * 10 + F.col("landing")
    return answered.select(
        F.lit(run_id).alias("run_id"),
        "series_code",
        "page_index",
        F.concat(
            F.lit(f"{SHOP}/product-group/"),
            F.substring("series_code", 2, 20),
            F.lit("/0/photo?num=100&page="),
            F.col("page_index").cast("string"),
        ).alias("url"),
        F.timestamp_add("SECOND", seconds, F.expr(observed)).alias("fetched_at"),
        "html",
    )


def crawled_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed listing pages of two crawls."""
    first = _crawl(listing_pages(spark, sf_dir), 1, FIRST_RUN)
    second = _crawl(listing_pages(spark, sf_dir, SECOND_PRICE_TEXT), 2, SECOND_RUN)
    return first.unionByName(second)


# Parts a crawl keeps: everything before the empty page of an odd series.
KEPT_PARTS = f"({SERIES_NUMBER} % 2 = 0 or {PAGE_INDEX} <= 5)"

# Card fields as a card site shows them, with the usual gaps.
CARD_ID = (
    "case when p_size = 13 then concat('x', cast(p_partkey as string)) "
    "when p_size <> 17 then cast(p_partkey + 1 as string) end"
)
CARD_KEY = "case when p_size not in (13, 17) then p_partkey + 1 end"
DATA_ID = "case when p_size % 3 <> 0 then p_partkey + 5000 end"
CARD_LANG = "case when p_size % 2 = 0 then 'en' else 'jp' end"
RARITY = "case when p_size % 5 <> 0 then p_type end"
USD = "case when p_size % 4 <> 0 then round(p_retailprice * 10) / 1000 end"
EUR = "case when p_size % 6 <> 0 then floor(p_retailprice / 100) end"


def card_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One card page per part and visit; the second visit shows no rarity and no EUR price."""

    def shown(value: Column, before: str, after: str) -> Column:
        return F.coalesce(F.concat(F.lit(before), value.cast("string"), F.lit(after)), F.lit(""))

    def page(first_visit: bool) -> Column:
        rarity = F.expr(RARITY) if first_visit else F.lit(None)
        eur = F.expr(EUR) if first_visit else F.lit(None)
        return F.concat(
            F.lit("<html><head><title>"),
            F.col("p_name"),
            F.lit("</title></head><body><!-- CARD ID 0 -->"),
            shown(F.expr(CARD_ID), "<!-- CARD ID ", " -->"),
            F.when(F.expr(CARD_ID).isNull(), "<!-- CARD ID -->").otherwise(""),
            shown(F.expr(DATA_ID), "<!--DATA ID ", "-->"),
            F.lit('<script>var s = "<!-- CARD ID 99 -->";</script>'),
            F.lit('<a href="/cards/jp/'),
            F.replace(F.col("p_brand"), F.lit("#"), F.lit("")),
            F.lit("/"),
            F.col("p_size").cast("string"),
            F.lit("?translate=en\">x</a><a class='t' title='href=\"/cards/jp/A/1\"' href=' /cards/en/T;p#top '>y</a>"),
            F.lit('<div class="prints-current-details"><span>#0 · None</span></div>'),
            F.lit('<div class="card-prints-current"><img src="i.png"><span title="a > b">No · No</span>'),
            F.lit('<div class="prints-current-details"><div><i>x</i></div><span class="text-lg">Set · 1</span>\n'),
            F.lit("<span>#"),
            F.col("p_partkey").cast("string"),
            shown(rarity, " · <b>", "</b>"),
            F.lit("</span></div></div><span title=\"class='card-price usd eur'\">$77</span>"),
            shown(F.expr(USD), '<span class="card-price usd">$', "</span>"),
            shown(eur, '<span class="eur card-price">', " €</span>"),
            F.lit("</body></html>"),
        )

    part = spread(table(spark, sf_dir, "part"), "p_partkey")
    visits = part.select(
        F.expr(CARD_LANG).alias("lang"),
        F.col("p_brand").alias("set_code"),
        F.col("p_partkey").cast("string").alias("card_code"),
        F.inline(
            F.array(
                F.struct(page(True).alias("html"), F.expr(FIRST_RUN).alias("fetched_at")),
                F.struct(page(False).alias("html"), F.expr(SECOND_RUN).alias("fetched_at")),
            )
        ),
    )
    return visits


def linked_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given pages with every site-relative link turned into a card link."""
    pages = table(spark, sf_dir, "pages")
    html = F.replace(F.col("html"), F.lit('href="/'), F.lit('href="/cards/jp/SV1/'))
    return pages.select("page_id", html.alias("html"))


def landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given pages as fetch results of two sources, some of them failed."""
    pages = table(spark, sf_dir, "pages")
    page_id = F.col("page_id")
    status = F.when(page_id % 11 == 0, 404).when(page_id % 13 == 0, 500).otherwise(200)
    return pages.select(
        F.when(page_id % 3 == 0, "cards").otherwise("shop").alias("source"),
        F.concat(F.lit("n"), page_id.cast("string")).alias("name"),
        "url",
        F.concat(F.lit("S"), (page_id % 7).cast("string")).alias("series_code"),
        (page_id % 14 + 1).cast("int").alias("page_index"),
        F.lit("en").alias("lang"),
        F.concat(F.lit("S"), (page_id % 7).cast("string")).alias("set_code"),
        page_id.cast("string").alias("card_code"),
        status.cast("int").alias("status"),
        F.timestamp_add("SECOND", page_id.cast("int"), F.expr(FIRST_RUN)).alias("fetched_at"),
        F.when(page_id % 17 != 0, F.col("html")).alias("html"),
    )
