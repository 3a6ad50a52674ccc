"""Price texts to doubles.  Nothing here raises: an unreadable price is null."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

YEN_DIGITS = "[0-9,]+"
DECIMAL = r"[0-9]+\.?[0-9]*"


@lru_cache(maxsize=1)
def _digits() -> tuple[str, str]:
    """Every non-ASCII decimal digit and, aligned with it, its ASCII value."""
    spans = (range(0x660, 0xFF1A), range(0x104A0, 0x1FC00))
    wide = [chr(c) for span in spans for c in span if unicodedata.category(chr(c)) == "Nd"]
    return "".join(wide), "".join(str(unicodedata.decimal(c)) for c in wide)


def _ascii_digits(text: Column) -> Column:
    wide, plain = _digits()
    return F.translate(text, wide, plain)


def yen_price(text: Column) -> Column:
    """First run of digits and commas without its commas: ``79,800円`` is 79800.0.

    A decimal part is cut off, and a run of commas alone is null.
    """
    run = F.regexp_extract(_ascii_digits(text), YEN_DIGITS, 0)
    return F.replace(run, F.lit(","), F.lit("")).try_cast("double")


def decimal_price(text: Column) -> Column:
    """First decimal number: ``$0.15`` is 0.15.  It ends at a comma: ``1,234.56`` is 1.0."""
    return F.regexp_extract(_ascii_digits(text), DECIMAL, 0).try_cast("double")
