"""Card pages to links, ids, rarity and prices, with native expressions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions import html as H
from vitrine.functions import text as T
from vitrine.functions.prices import decimal_price
from vitrine.functions.urls import path_parts

# Labels and class names of the card markup.
CARD_LABEL, DATA_LABEL = "CARD ID", "DATA ID"
PRINT_BOX, PRINT_DETAILS, PRINT_TITLE = "card-prints-current", "prints-current-details", "text-lg"
PRICE_CLASS, USD_CLASS, EUR_CLASS = "card-price", "usd", "eur"
RARITY_MARK = "·"
LINK_ROOT, LINK_FIELDS = "cards", ("lang", "set_code", "card_code")

_BOX = rf"^{H.opening('*', PRINT_BOX)}"
_DETAILS = rf"^{H.opening('*', PRINT_DETAILS)}"
_PLAIN_SPAN = H.opening("span", without=PRINT_TITLE) + r"((?s:.*?)(?:</|\z))(?:(?<!</)|(?i:span)\s*>)"
_LINK_TAG = H.any_tag("a")
_LINK_START = r"<(?i:a)[\s/]"


def _price_tag(currency: str) -> str:
    return H.opening("span", PRICE_CLASS, currency)


def _price_span(currency: str) -> str:
    return _price_tag(currency) + r"(?s:.*?)</(?i:span)\s*>"


def hrefs(html: Column) -> Column:
    """Array of the page's link targets in page order, decoded and stripped."""
    tags = H.of_kind(H.pieces(html, _LINK_TAG), _LINK_START)
    written = F.transform(tags, lambda tag: H.raw_attribute(tag, "href"))
    targets = F.transform(F.filter(written, lambda raw: raw != ""), H.unquote)
    return F.transform(targets, lambda target: T.strip(T.decode_entities(target)))


def extract_links(
    pages: DataFrame,
    keep: Sequence[str],
    prefix: str = "/cards/",
    root: str = LINK_ROOT,
    fields: Sequence[str] = LINK_FIELDS,
    html: str = "html",
) -> DataFrame:
    """One row per link under ``prefix`` whose path is ``root`` plus one part per field.

    Duplicates and empty parts stay, as does page order (``link_pos`` counts all links).
    """
    links = pages.select(*keep, F.posexplode(hrefs(F.col(html))).alias("link_pos", "_href"))
    return links_from_hrefs(links, keep, prefix, root, fields)


def links_from_hrefs(
    links: DataFrame, keep: Sequence[str], prefix: str, root: str, fields: Sequence[str]
) -> DataFrame:
    split = links.where(F.col("_href").startswith(prefix)).select(
        *keep, "link_pos", path_parts(F.col("_href")).alias("_parts")
    )
    parts = F.col("_parts")
    return split.where((F.size(parts) == len(fields) + 1) & (parts[0] == root)).select(
        *keep, "link_pos", *(parts[i + 1].alias(name) for i, name in enumerate(fields))
    )


def comments(html: Column) -> Column:
    """Array of comment texts, stripped; text inside scripts is no comment."""
    return H.comment_texts(H.pieces(html))


def labelled_comment(comment_texts: Column, label: str) -> Column:
    """Rest of the last comment that starts with the label, without any further label."""
    mine = F.filter(comment_texts, lambda text: text.startswith(label))
    last = F.try_element_at(mine, F.lit(-1))
    return T.strip(F.replace(last, F.lit(label), F.lit("")))


def rarity_of(detail_text: Column) -> Column:
    """``Uncommon`` out of ``#63 · Uncommon``; null without the mark."""
    rest = F.regexp_extract(detail_text, f"(?s){RARITY_MARK}(.*)$", 1)
    return F.when(detail_text.contains(RARITY_MARK), T.strip(rest))


def print_detail(html: Column) -> Column:
    """Content of the first untitled span in a details box inside a print box, '' without one.

    One sweep over the page's boxes: the depth at which a print box and a details box inside it were
    opened says where each ends, so every piece is looked at once, however many boxes there are."""
    none = F.lit(None).cast("int")
    start = F.struct(
        F.lit(0).alias("depth"), none.alias("box"), none.alias("details"), F.lit("").alias("found")
    )

    def step(state: Column, piece: Column) -> Column:
        change = H.box_step(piece)
        depth = state["depth"] + change
        box = F.when(state["box"] <= depth, state["box"])
        details = F.when(state["details"] <= depth, state["details"])
        opens = change == 1
        # a details box lies inside the print box, not at it
        details = F.coalesce(details, F.when(opens & box.isNotNull() & piece.rlike(_DETAILS), depth))
        box = F.coalesce(box, F.when(opens & piece.rlike(_BOX), depth))
        found = F.when(
            (state["found"] == "") & details.isNotNull(), F.regexp_extract(piece, _PLAIN_SPAN, 1)
        ).otherwise(state["found"])
        return F.struct(depth.alias("depth"), box.alias("box"), details.alias("details"), found.alias("found"))

    # what stands before the first mention of the print box holds none
    rest = F.regexp_extract(H.without_hidden(html), rf"(?s)<[^<]*{PRINT_BOX}.*", 0)
    swept = F.aggregate(H.boxes(rest), start, step, lambda state: state["found"])
    return F.when(html.contains(PRINT_BOX), F.regexp_replace(swept, r"</\z", "")).otherwise("")


def card_fields(pages: DataFrame, keep: Sequence[str], html: str = "html") -> DataFrame:
    """Add ``card_id, data_id, rarity, usd_price, eur_price``; HTML is dropped.

    Two passes read a page: one for comments and prices, one for the print box.
    """
    page = F.col(html)
    found = pages.select(
        *keep,
        H.pieces(page, _price_span(USD_CLASS), _price_span(EUR_CLASS)).alias("_found"),
        print_detail(page).alias("_detail"),
    )

    def first_of(column: str, start: str) -> Column:
        return F.try_element_at(H.of_kind(F.col(column), start), F.lit(1))

    matched = found.select(
        *keep,
        H.comment_texts(F.col("_found")).alias("_comments"),
        "_detail",
        H.element_content(first_of("_found", _price_tag(USD_CLASS))).alias("_usd"),
        H.element_content(first_of("_found", _price_tag(EUR_CLASS))).alias("_eur"),
    )
    fragment_texts = (H.without_tags(F.col(c)) for c in ("_detail", "_usd", "_eur"))
    texts = matched.select(*keep, "_comments", T.decode_each(*fragment_texts).alias("_texts"))
    text = F.col("_texts")
    return texts.select(
        *keep,
        labelled_comment(F.col("_comments"), CARD_LABEL).alias("card_id"),
        labelled_comment(F.col("_comments"), DATA_LABEL).alias("data_id"),
        rarity_of(T.strip(text[0])).alias("rarity"),
        decimal_price(text[1]).alias("usd_price"),
        decimal_price(text[2]).alias("eur_price"),
    )
