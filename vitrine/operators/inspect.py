"""Page inspection: title, meta tags and inline scripts, with native expressions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions import html as H
from vitrine.functions import text as T

_TITLE = H.opening("title") + r"(?s:.*?)</(?i:title)\s*>"
_META = H.any_tag("meta")


def page_titles(pages: DataFrame, keep: Sequence[str], html: str = "html") -> DataFrame:
    """X11: the page title; null when the page has none, or an empty one, or one with markup."""
    titles = H.of_kind(H.pieces(F.col(html), _TITLE), H.opening("title"))
    found = pages.select(*keep, F.try_element_at(titles, F.lit(1)).alias("_title"))
    content = T.blank_to_null(H.element_content(F.col("_title")))
    plain = F.when(~content.rlike(H.TAG_OR_COMMENT), content)
    return found.select(*keep, T.decode_entities(plain).alias("title"))


def meta_tags(pages: DataFrame, keep: Sequence[str], html: str = "html") -> DataFrame:
    """One row per meta tag with a non-empty name or property, in page order."""
    tags = H.of_kind(H.pieces(F.col(html), _META), _META)
    rows = pages.select(*keep, F.posexplode(tags).alias("meta_pos", "_tag"))
    names = ("name", "property", "content")
    values = T.decode_each(*(H.attribute(F.col("_tag"), name) for name in names))
    read = rows.select(*keep, "meta_pos", values.alias("_values")).select(
        *keep,
        "meta_pos",
        *(F.col("_values")[i].alias(f"meta_{name}") for i, name in enumerate(names)),
    )
    return read.where(is_named())


def is_named() -> Column:
    """Meta tag rows that carry a name or a property."""
    name, prop = T.blank_to_null(F.col("meta_name")), T.blank_to_null(F.col("meta_property"))
    return F.coalesce(name, prop).isNotNull()


def inline_scripts(
    pages: DataFrame, keep: Sequence[str], html: str = "html", preview: int | None = None
) -> DataFrame:
    """Non-empty scripts, numbered over all scripts of the page, and their length.

    The text is whole unless ``preview`` asks for its first characters only.
    """
    scripts = H.of_kind(H.pieces(F.col(html)), r"<(?i:script)\b")
    rows = pages.select(*keep, F.posexplode(scripts).alias("script_pos", "_script"))
    code = T.strip(H.element_content(F.col("_script")))
    return preview_scripts(rows.select(*keep, "script_pos", code.alias("_code")), keep, preview)


def preview_scripts(rows: DataFrame, keep: Sequence[str], preview: int | None) -> DataFrame:
    """Drop empty scripts; show the text, or its start, and the full length of the others."""
    code = F.col("_code") if preview is None else F.substring("_code", 1, preview)
    return rows.where(F.col("_code") != "").select(
        *keep,
        "script_pos",
        code.alias("script_text"),
        F.length("_code").alias("script_length"),
    )
