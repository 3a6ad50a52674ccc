"""Text normalisation as native column expressions.

Scraped Japanese text mixes ASCII with full-width forms, so every class below is Unicode-aware
(``(?U)``), and ``.`` stops at ``\\n`` only (``(?d)``).
"""

from __future__ import annotations

from functools import lru_cache
from html.entities import html5
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space at the ends of a text.
SPACE_CODES = (
    *range(0x09, 0x0E),
    *range(0x1C, 0x21),
    0x85,
    0xA0,
    0x1680,
    *range(0x2000, 0x200B),
    0x2028,
    0x2029,
    0x202F,
    0x205F,
    0x3000,
)
_SPACES = "".join(map(chr, SPACE_CODES))

# The bracket styles of listing names and the shape of a card number.
CONDITION = "(?d)〔.*?〕"
DECORATION = r"(?d)〔.*?〕|\(.*?\)|【.*?】|\{.*?\}"
NUMBER_OF_SET = r"(?U)\{(\d+)\s*/\s*(\d+)\}"
AFTER_BRACKET = r"(?d)\](.+)$"
UNSAFE_IN_NAME = "[^a-zA-Z0-9._-]+"


def strip(text: Column) -> Column:
    """Remove Unicode white space (U+3000 included) from both ends."""
    return F.btrim(text, F.lit(_SPACES))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def first_match(text: Column, pattern: str) -> Column:
    """The whole first match, or null; the pattern must not match the empty string."""
    return blank_to_null(F.regexp_extract(text, pattern, 0))


def condition_of(name_full: Column) -> Column:
    """Text of the first 〔…〕: '' when it is empty, null when there is none."""
    group = first_match(name_full, CONDITION)
    return F.substring(group, F.lit(2), F.length(group) - 2)


def clean_name(name_full: Column) -> Column:
    """The name without bracketed decorations; an empty or missing name gives null."""
    return strip(F.regexp_replace(blank_to_null(name_full), DECORATION, ""))


def card_number(name_full: Column) -> Column:
    """``003`` out of ``{003/019}``, kept as text."""
    return blank_to_null(F.regexp_extract(name_full, NUMBER_OF_SET, 1))


def set_size(name_full: Column) -> Column:
    """``019`` out of ``{003/019}``, kept as text."""
    return blank_to_null(F.regexp_extract(name_full, NUMBER_OF_SET, 2))


def model_code(model_text: Column) -> Column:
    """What follows the first closing bracket, or the whole text when nothing does."""
    tail = F.regexp_extract(model_text, AFTER_BRACKET, 1)
    return strip(F.coalesce(blank_to_null(tail), blank_to_null(model_text)))


def safe_name(text: Column) -> Column:
    """A file-name-safe form: stripped, every run of other characters becomes ``_``."""
    return F.regexp_replace(strip(text), UNSAFE_IN_NAME, "_")


def same_folded(left: Column, right: Column) -> Column:
    """Equal up to the case of ASCII letters; other letters must match as they are."""

    def folded(text: Column) -> Column:
        return F.translate(text, ascii_uppercase, ascii_lowercase)

    return folded(left) == folded(right)


def not_blank(text: Column) -> Column:
    """Present and not made of plain spaces only (other white space counts as content)."""
    return text.isNotNull() & (F.trim(text) != "")


def keep_old(new: Column, old: Column) -> Column:
    """A new value when there is one, else the stored one."""
    return F.coalesce(new, old)


def _sql_text(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _sql_map(pairs: dict[str, str]) -> str:
    """SQL for a constant map; the planner folds it once."""
    entries = "\x1e".join(f"{key}\x1f{value}" for key, value in sorted(pairs.items()))
    return f"str_to_map({_sql_text(entries)}, '\x1e', '\x1f')"


def _number_characters() -> dict[str, str]:
    """Numbers that stand for another character than their own, or for none."""
    found = {str(code): bytes([code]).decode("cp1252", "ignore") or chr(code) for code in range(0x80, 0xA0)}
    for code in (*range(0x01, 0x09), 0x0B, *range(0x0E, 0x20), 0x7F):
        found[str(code)] = ""
    return found


def _character(code: str) -> str:
    """SQL for the character of a number; numbers of no character give U+FFFD or ''."""
    return f"""
        case when {code} is null or {code} = 0 or {code} between 55296 and 57343 or {code} > 1114111 then '�'
             when {code} < 160 then coalesce(try_element_at({_sql_map(_number_characters())}, cast({code} as string)), chr({code}))
             when {code} between 64976 and 65007 or {code} & 65534 = 65534 then ''
             when {code} < 256 then chr({code})
             else decode(unhex(lpad(hex({code}), 8, '0')), 'UTF-32') end"""


# The references that pages use most, decoded without a lookup.
_FREQUENT = {"&amp;": "&", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&nbsp;": "\xa0", "&apos;": "'"}


@lru_cache(maxsize=1)
def _decoder() -> str:
    """SQL lambda that decodes one text.

    A text is cut in front of each ``&``, and what a piece starts with is decoded, so a decoded
    character never starts a second decoding.  A name that ends with ``;`` is looked up among those
    of its first letter; without, the longest of the old names counts that it starts with."""
    closed: dict[str, dict[str, str]] = {}
    for name, value in html5.items():
        if name.endswith(";"):
            closed.setdefault(name[0], {})[f"&{name}"] = value
    named = " ".join(f"when '{letter}' then try_element_at({_sql_map(names)}, x.r)" for letter, names in sorted(closed.items()))
    old = {name: value for name, value in html5.items() if not name.endswith(";")}
    prefix = "|".join(sorted(old, key=lambda name: (-len(name), name)))
    start = f"regexp_extract(x.r, '^&({prefix})', 1)"
    frequent = " ".join(
        f"when x.r = '{r}' then concat({_sql_text(c)}, substring(x.p, {len(r) + 1}))" for r, c in _FREQUENT.items()
    )
    hexadecimal = "try_cast(conv(regexp_extract(x.r, '^&#[xX]0*([0-9a-fA-F]{1,12});?$', 1), 16, 10) as bigint)"
    decimal = "try_cast(regexp_extract(x.r, '^&#0*([0-9]{1,15});?$', 1) as bigint)"
    rest = "substring(x.p, length(x.r) + 1)"
    piece = f"""
        case when x.r = '' then x.p {frequent}
             when x.r rlike '^&#[xX]' then concat({_character(hexadecimal)}, {rest})
             when startswith(x.r, '&#') then concat({_character(decimal)}, {rest})
             else coalesce(
                 concat(case substring(x.r, 2, 1) {named} end, {rest}),
                 concat(try_element_at({_sql_map(old)}, {start}), substring(x.p, length({start}) + 2)),
                 x.p) end"""
    reference = "'^&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]{0,31};?)'"
    cut = f"transform(split(t, '(?=&)'), p -> named_struct('p', p, 'r', regexp_extract(p, {reference}, 0)))"
    return f"t -> if(contains(t, '&'), array_join(transform({cut}, x -> {piece}), ''), t)"


def decode_each(*texts: Column) -> Column:
    """Array of the texts with all character references decoded, as the standard library decodes
    them: every name, numbers, and old names and numbers without a semicolon.  Nulls stay null.

    Decoding several texts together keeps the plan small.
    """
    return F.call_function("transform", F.array(*texts), F.expr(_decoder()))


def decode_entities(text: Column) -> Column:
    """One text with its character references decoded."""
    return decode_each(text)[0]
