"""Patterns and expressions for the well-formed HTML of landed pages.

These run inside the JVM and cover tags with either quote style, any attribute order, any extra
classes, and values that hold ``>`` or look like attributes.  Boxes are closed by running depth.
Pages that need a real tree (blocks inside blocks, unclosed tags, tags written inside an attribute's
value) go through ``operators.dom``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine.functions.text import SPACE_CODES, strip

# A tag is read as the HTML standard reads it: blanks, slashes and whole attributes up to ``>``, so a
# quoted value hides whatever it holds.  All loops are possessive: nothing is tried twice.
_NAME = r"[^\s/>][^\s/>=]*+"
_VALUE = r"\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]++)"
_ATTRIBUTES = rf"(?:[\s/]++|{_NAME}(?:{_VALUE})?+)*+"
COMMENT = r"<!--(?s:.*?)-->"


def any_tag(name: str) -> str:
    """Pattern of a whole opening tag of this name."""
    return rf"<(?i:{name})(?=[\s/>]){_ATTRIBUTES}>"


SCRIPT = any_tag("script") + r"(?s:.*?)</(?i:script)\s*>"
# Elements that hold others and are closed by their own end tag.
BOX_TAGS = "div|section|article|main|aside"
# Names of references to white space.
_SPACE_REFERENCES = "|".join(
    ["nbsp", "ensp", "emsp", "thinsp"] + [rf"#0*{c}|#[xX]0*(?i:{c:x})" for c in SPACE_CODES]
)
_SPACES = rf"(?:[\s\x1c-\x1f]++|&(?:{_SPACE_REFERENCES});)*+"


def any_of(*patterns: str) -> str:
    """Alternatives that all start with ``<``, tried only where one stands."""
    return f"<(?:{'|'.join(pattern[1:] for pattern in patterns)})"


OPENING_TAG = rf"<[A-Za-z][^\s/>]*+{_ATTRIBUTES}>"
TAG_OR_COMMENT = any_of(COMMENT, OPENING_TAG, r"</[A-Za-z][^>]*>", r"<[!?][^>]*>")


def _before(name: str) -> str:
    """Pattern of what stands between a tag's name and its first attribute of this name."""
    named = rf"(?i:{re.escape(name)})\s*+="
    return rf"(?:[\s/]++|(?!{named}){_NAME}(?:{_VALUE})?+)*+{named}\s*+"


def has_class(name: str) -> str:
    """Look-ahead, valid just after a tag name: the class list holds this name."""
    word = re.escape(name)
    return (
        rf"(?={_before('class')}(?:\"(?:[^\"]*\s)?{word}[\s\"]|'(?:[^']*\s)?{word}[\s']|{word}[\s>]))"
    )


def opening(tag: str, *classes: str, without: str | None = None) -> str:
    """Pattern of an opening tag carrying all the classes (and not the excluded one)."""
    name = r"<\w++" if tag == "*" else rf"<(?i:{tag})"
    unwanted = "" if without is None else "(?!" + has_class(without)[3:]
    return rf"{name}(?=[\s/>]){''.join(map(has_class, classes))}{unwanted}{_ATTRIBUTES}>"


def content(tag: str) -> str:
    """Pattern of an element's content up to its first closing tag.

    The group also takes the ``</`` behind the content, so that '' means "no match" and an
    empty element is told apart; ``inner`` removes it again.
    """
    return rf"((?:[^<]++|<(?!/(?i:{tag})\s*>))*+</)(?i:{tag})\s*>"


def inner(found: Column) -> Column:
    """Content from a ``content`` group, null when there was no match."""
    return F.when(found != "", F.substring(found, F.lit(1), F.length(found) - 2))


def within(tag: str, wanted: str) -> str:
    """Pattern of anything short of a closing tag and of the first match of what is wanted next."""
    return rf"(?:[^<]++|<(?!/(?i:{tag})\b|{wanted[1:]}))*+"


def pieces(html: Column, *patterns: str) -> Column:
    """Array of comments, scripts and matches of the patterns, in page order, in one pass.

    Comments and scripts are taken as wholes, so nothing inside them can match.
    """
    return F.regexp_extract_all(html, F.lit(any_of(COMMENT, SCRIPT, *patterns)), F.lit(0))


def of_kind(found: Column, pattern: str) -> Column:
    """The pieces that start with a pattern."""
    return F.filter(found, lambda piece: piece.rlike(f"^{pattern}"))


def comment_texts(found: Column) -> Column:
    """Stripped texts of the comments among the pieces."""
    comments = F.filter(found, lambda piece: piece.startswith("<!--"))
    return F.transform(
        comments, lambda piece: strip(F.substring(piece, F.lit(5), F.length(piece) - 7))
    )


def element_content(element: Column) -> Column:
    """What stands between an element's opening tag and its closing tag."""
    return F.regexp_replace(element, rf"^{OPENING_TAG}|</[^>]*>\z", "")


def without_hidden(html: Column) -> Column:
    """HTML without comments and scripts, whose content must not be read as elements."""
    return F.regexp_replace(html, any_of(COMMENT, SCRIPT), "")


def raw_attribute(tag: Column, name: str) -> Column:
    """The attribute as written, quotes included; '' when absent.  Of several, the last counts."""
    value = r"\"[^\"]*+\"|'[^']*+'|[^\s>]++"
    mine = rf"(?i:{re.escape(name)})\s*+=\s*+({value})"
    return F.regexp_extract(tag, rf"^<[^\s/>]++(?:[\s/]++|{mine}|{_NAME}(?:{_VALUE})?+)*+", 1)


def unquote(raw: Column) -> Column:
    """Attribute value from its written form, not decoded yet; null when absent."""
    quoted = raw.startswith('"') | raw.startswith("'")
    return (
        F.when(raw == "", None)
        .when(quoted, F.substring(raw, F.lit(2), F.length(raw) - 2))
        .otherwise(raw)
    )


def boxes(html: Column) -> Column:
    """The page cut in front of every opening and closing tag of a box (``BOX_TAGS``)."""
    return F.split(html, rf"(?=</?(?i:{BOX_TAGS})(?=[\s/>]))")


_BOX_NAME = rf"(?i:{BOX_TAGS})(?=[\s/>])"
_BOX_OPEN = rf"<{_BOX_NAME}{_ATTRIBUTES}(?<!/)>"
_BOX_CLOSE = rf"</{_BOX_NAME}"


def _closing_box(levels: int) -> str:
    """Pattern of a box whose inner boxes are nested up to ``levels`` deep, without its end tag."""
    plain = rf"(?:[^<]++|<(?!/?{_BOX_NAME})|<{_BOX_NAME}{_ATTRIBUTES}(?<=/)>)*+"
    inside = plain
    for _ in range(levels):
        inside = rf"{plain}(?:{_BOX_OPEN}{inside}{_BOX_CLOSE}[^>]*+>{plain})*+"
    return rf"^{_BOX_OPEN}{inside}(?={_BOX_CLOSE})"


def closed_boxes(html: Column, opening_tag: str) -> Column:
    """The boxes that start with this tag, as ``first_box`` cuts them, in one pass; a lone ``<`` stands for a
    box that needs more: unclosed, deep or around another one, or with ``<`` in an attribute of a box."""
    start = opening_tag[1:]
    value = r"\s*+=\s*+(?:\"[^\"<]*+\"|'[^'<]*+'|[^\s<>]++)"
    attributes = rf"(?:[\s/]++|[^\s/<>][^\s/<>=]*+(?:{value})?+)*+(?<!/)>"
    plain = rf"(?:[^<]++|<(?!/?{_BOX_NAME}))*+"
    inside = plain
    for _ in range(2):
        inside = rf"{plain}(?:<(?!{start}){_BOX_NAME}{attributes}{inside}{_BOX_CLOSE}[^<>]*+>{plain})*+"
    whole = rf"<(?={start}){_BOX_NAME}{attributes}{inside}(?={_BOX_CLOSE})"
    return F.regexp_extract_all(html, F.lit(rf"{whole}|<(?={start})"), F.lit(0))


def box_step(piece: Column) -> Column:
    """How a piece of ``boxes`` changes the depth of open boxes."""
    return F.when(piece.startswith("</"), F.when(piece.rlike(f"^{_BOX_CLOSE}"), -1).otherwise(0)).otherwise(
        F.when(piece.rlike(f"^{_BOX_OPEN}"), 1).otherwise(0)
    )


def first_box(html: Column) -> Column:
    """A fragment that starts with a box, up to where that box closes, or whole if it never does.

    The closing tag and what follows it go.  Boxes of some levels are one match; deeper or unclosed
    ones take a running depth over the pieces."""
    flat = F.nullif(F.regexp_extract(html, _closing_box(2), 0), F.lit(""))
    pieces = boxes(html)
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("n"), F.lit(False).alias("closed"))

    def step(state: Column, piece: Column) -> Column:
        depth = state["depth"] + box_step(piece)
        closed = state["closed"] | (depth <= 0)
        return F.struct(
            depth.alias("depth"),
            F.when(closed, state["n"]).otherwise(state["n"] + 1).alias("n"),
            closed.alias("closed"),
        )

    kept = F.aggregate(pieces, start, step, lambda state: state["n"])
    deep = F.array_join(F.slice(pieces, F.lit(1), F.greatest(kept, F.lit(1))), "")
    return F.coalesce(flat, deep)


def attribute(tag: Column, name: str) -> Column:
    """Attribute value, not decoded yet; null when absent."""
    return unquote(raw_attribute(tag, name))


def without_tags(fragment: Column) -> Column:
    """Text pieces of a fragment joined without spaces, not decoded yet.

    White space next to a tag goes with the tag, also where it is written as a reference.
    """
    # A run of spaces is tried from its first space only.
    tags = rf"(?U)(?<![\s\x1c-\x1f]){_SPACES}(?:{TAG_OR_COMMENT}{_SPACES})++"
    return F.when(fragment.contains("<"), F.regexp_replace(fragment, tags, "")).otherwise(fragment)
