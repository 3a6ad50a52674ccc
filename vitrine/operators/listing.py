"""Shop listing pages to product rows, with native expressions only.

Extraction is staged over several projections on purpose: a match over a whole block is one
column, and the columns read from it are the next stage.  The optimizer keeps such stages
apart when a match is read more than once, so every pattern scans a block once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions import html as H
from vitrine.functions import text as T
from vitrine.functions.prices import yen_price
from vitrine.functions.urls import resolve_url

# Class and attribute names of the listing markup.
BLOCK_CLASS = "item_data"
ID_ATTRIBUTE = "data-product-id"
LINK_CLASS = "item_data_link"
NAME_BOX, NAME_CLASS, MODEL_CLASS = "item_name", "goods_name", "model_number_value"
PRICE_BOX, PRICE_CLASS = "selling_price", "figure"

BLOCK = H.opening("div", BLOCK_CLASS)
# A block's opening tag and what follows up to the next one, as one match.
_TO_NEXT_BLOCK = rf"<(?={BLOCK[1:]})(?:[^<]++|<(?!{BLOCK[1:]}))*+"
LINK = H.opening("a", LINK_CLASS)

RECORD_FIELDS = (
    "product_id",
    "name_full",
    "name",
    "condition",
    "model_number",
    "set_size",
    "model_code",
    "price",
    "product_url",
)


def _in_box(box: str, span: str) -> str:
    wanted = H.opening("span", span)
    return H.opening("p", box) + H.within("p", wanted) + wanted + H.content("span")


def split_blocks(html: Column) -> Column:
    """Array of product blocks in page order; a block ends where its element closes, or where the
    next one opens."""

    def cut(shown: Column) -> Column:
        closed = F.array(H.closed_boxes(shown, BLOCK))
        return F.transform(closed, lambda found: F.when(~F.array_contains(found, "<"), found))[0]

    # each step is bound once; a page with blocks of another form is read again
    read = F.transform(
        F.array(H.without_hidden(html)), lambda shown: F.coalesce(cut(shown), any_blocks(shown))
    )
    return read[0]


def any_blocks(shown: Column) -> Column:
    """Blocks of any form in a page without comments and scripts."""
    opened = F.regexp_extract_all(shown, F.lit(_TO_NEXT_BLOCK), F.lit(0))
    return F.transform(opened, H.first_box)


def explode_blocks(
    pages: DataFrame, keep: Sequence[str], base_url: str | None = None, html: str = "html"
) -> DataFrame:
    """One row per block with ``item_pos``; a page without blocks stays as one null row.

    Page HTML is dropped here, before any shuffle.  With ``base_url`` the page's fingerprint
    (id and address of its first block) and block count ride along for ``paging.cut_off``.
    """
    out = pages.select(*keep, split_blocks(F.col(html)).alias("_blocks"))
    page_columns = list(keep)
    if base_url is not None:
        first, texts = F.try_element_at("_blocks", F.lit(1)), F.col("_texts")
        found = T.decode_each(H.unquote(F.col("_id")), H.unquote(F.col("_href")))
        identity = F.struct(
            T.blank_to_null(texts[0]).alias("product_id"),
            resolve_url(base_url, texts[1]).alias("product_url"),
        )
        n_items = F.size("_blocks")
        linked = out.select(
            *keep,
            "_blocks",
            H.raw_attribute(first, ID_ATTRIBUTE).alias("_id"),
            F.regexp_extract(first, LINK, 0).alias("_link"),
        )
        written = linked.withColumn("_href", H.raw_attribute(F.col("_link"), "href"))
        out = written.withColumn("_texts", found).select(
            *keep,
            "_blocks",
            n_items.alias("n_items"),
            F.when(n_items > 0, identity).alias("fingerprint"),
        )
        page_columns += ["n_items", "fingerprint"]
    return out.select(*page_columns, F.posexplode_outer("_blocks").alias("item_pos", "_block"))


def read_fields(blocks: DataFrame, base_url: str) -> DataFrame:
    """Turn ``_block`` fragments into the product record columns."""
    others = [c for c in blocks.columns if c != "_block"]
    block = F.col("_block")
    matched = blocks.select(
        *others,
        # a block starts with its whole opening tag
        H.raw_attribute(block, ID_ATTRIBUTE).alias("_id"),
        F.regexp_extract(block, LINK, 0).alias("_link"),
        F.regexp_extract(block, _in_box(NAME_BOX, NAME_CLASS), 1).alias("_name"),
        F.regexp_extract(block, _in_box(NAME_BOX, MODEL_CLASS), 1).alias("_model"),
        F.regexp_extract(block, _in_box(PRICE_BOX, PRICE_CLASS), 1).alias("_price"),
    )
    fragments = matched.select(
        *others,
        "_id",
        H.raw_attribute(F.col("_link"), "href").alias("_href"),
        *(H.inner(F.col(c)).alias(c) for c in ("_name", "_model", "_price")),
    )
    decoded = fragments.select(
        *others,
        T.decode_each(
            H.unquote(F.col("_id")),
            H.unquote(F.col("_href")),
            *(H.without_tags(F.col(c)) for c in ("_name", "_model", "_price")),
        ).alias("_texts"),
    )
    text = F.col("_texts")
    texts = decoded.select(
        *others,
        T.blank_to_null(text[0]).alias("product_id"),
        text[1].alias("href"),
        T.strip(text[2]).alias("name_full"),
        T.strip(text[3]).alias("model_text"),
        T.strip(text[4]).alias("price"),
    )
    return finish_record(texts, base_url)


def finish_record(texts: DataFrame, base_url: str) -> DataFrame:
    """Typed record columns from ``product_id, href, name_full, model_text, price``."""
    raw = ("product_id", "href", "name_full", "model_text", "price")
    others = [c for c in texts.columns if c not in raw]
    name_full = F.col("name_full")
    return texts.select(
        *others,
        "product_id",
        "name_full",
        T.clean_name(name_full).alias("name"),
        T.condition_of(name_full).alias("condition"),
        T.card_number(name_full).alias("model_number"),
        T.set_size(name_full).alias("set_size"),
        T.model_code(F.col("model_text")).alias("model_code"),
        "price",
        resolve_url(base_url, F.col("href")).alias("product_url"),
    )


def parse_products(
    pages: DataFrame, base_url: str, keep: Sequence[str], html: str = "html"
) -> DataFrame:
    """Pages to product records: ``keep`` columns, ``item_pos`` and the record fields."""
    blocks = explode_blocks(pages, keep, html=html).where(F.col("_block").isNotNull())
    return read_fields(blocks, base_url)


def with_price(records: DataFrame) -> DataFrame:
    """Add ``price_yen``, the displayed price as a number."""
    return records.withColumn("price_yen", yen_price(F.col("price")))
