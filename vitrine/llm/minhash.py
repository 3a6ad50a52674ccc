"""Document fingerprints: one-permutation MinHash with optimal densification and packed bits.

Every word shingle is hashed once.  The hash picks a bin and a value; each bin keeps its least
value.  An empty bin copies a filled one that a sequence of hashes of (bin, attempt) finds, the same
sequence for every document, so two documents fill a bin alike as often as they are alike.  Of each
bin the low ``bits`` bits are kept and packed.  Unequal values agree there with chance
``2 ** -bits``, which the likeness estimate corrects for.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.llm.common import bounds_of, bucket_of, map_rows, partitions

#: Words of a shingle, bins, and bits kept of each.
WORDS, BINS, BITS = 5, 512, 4
_EMPTY = np.uint64(np.iinfo(np.uint64).max)
#: Word hashes a worker remembers, and (document, bin) places filled at once.
REMEMBERED = 500_000
_word_hash: dict[str, int] = {}


def _mixed(value: np.ndarray) -> np.ndarray:
    value = (value ^ value >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    value = (value ^ value >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return value ^ value >> np.uint64(31)


def _hashes(words: list[str]) -> np.ndarray:
    """A 64-bit hash of each word; repeated words are hashed once per worker and refill."""
    if len(_word_hash) > REMEMBERED:
        _word_hash.clear()
    digest, known = xxhash.xxh64_intdigest, _word_hash
    out = []
    for word in words:
        value = known.get(word)
        if value is None:
            value = known[word] = digest(word.encode("utf-8", "surrogatepass"))
        out.append(value)
    return np.array(out, dtype=np.uint64)


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """A hash of each run of ``words`` words (white space apart); fewer words give one run."""
    value = _hashes((text or "").split())
    if not len(value):
        return value
    width = min(words, len(value))
    total = np.zeros(len(value) - width + 1, dtype=np.uint64)
    for i in range(width):
        total = total * np.uint64(0x9E3779B97F4A7C15) + value[i : i + len(total)]
    return _mixed(total + np.uint64(width))


def one_permutation(hashes: list[np.ndarray], bins: int) -> np.ndarray:
    """Least value of each bin of each document; empty bins of non-empty documents are filled."""
    least = np.full((len(hashes), bins), _EMPTY, dtype=np.uint64)
    for row, values in enumerate(hashes):
        # the high bits pick the bin, so that it says nothing of the low bits that are kept
        np.minimum.at(least[row], (values >> np.uint64(40)) % np.uint64(bins), values & np.uint64((1 << 40) - 1))
    filled = least != _EMPTY
    rows, cols = np.nonzero(~filled & filled.any(axis=1)[:, None])
    attempt = np.uint64(1)
    while len(rows):
        probe = _mixed(cols.astype(np.uint64) * np.uint64(0x100000001B3) + (attempt << np.uint64(32)))
        donor = (probe % np.uint64(bins)).astype(np.int64)
        hit = filled[rows, donor]
        least[rows[hit], cols[hit]] = least[rows[hit], donor[hit]]
        rows, cols = rows[~hit], cols[~hit]
        attempt += np.uint64(1)
    return least


def packed(texts: list[str | None], words: int = WORDS, bins: int = BINS, bits: int = BITS) -> list[bytes]:
    """Fingerprints of ``bins * bits / 8`` bytes; a text without a word has an empty one."""
    hashes = [shingle_hashes(t, words) for t in texts]
    # a copied value is mixed with its bin: else two one-shingle texts would agree in all bins at once
    own = np.arange(bins, dtype=np.uint64) << np.uint64(40)
    low = _mixed(one_permutation(hashes, bins) + own) & np.uint64((1 << bits) - 1)
    flags = (low[:, :, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
    rows = np.packbits(flags.astype(np.uint8).reshape(len(texts), -1), axis=1, bitorder="little")
    return [r.tobytes() if len(h) else b"" for r, h in zip(rows, hashes)]


def likeness(a: list[bytes], b: list[bytes], bits: int = BITS) -> np.ndarray:
    """Estimated Jaccard likeness of the shingle sets: share of equal bins, corrected for chance
    agreement and held to 0 to 1.  Two empty fingerprints are alike, one empty is not; null counts
    as empty."""
    out = np.zeros(len(a))
    for i, (x, y) in enumerate(zip(a, b)):
        x, y = x or b"", y or b""
        if x == y:
            out[i] = 1.0
        elif len(x) == len(y):
            differ = np.unpackbits(np.frombuffer(x, np.uint8) ^ np.frombuffer(y, np.uint8), bitorder="little")
            same = 1.0 - differ.reshape(-1, bits).any(axis=1).mean()
            out[i] = max(0.0, (same - 2.0**-bits) / (1.0 - 2.0**-bits))
    return out


def fingerprint_udf(words: int = WORDS, bins: int = BINS, bits: int = BITS) -> Callable[[Column], Column]:
    @F.pandas_udf("binary")
    def run(texts: pd.Series) -> pd.Series:
        parts = [packed(texts.iloc[i : i + 512].tolist(), words, bins, bits) for i in range(0, len(texts), 512)]
        return pd.Series([p for part in parts for p in part], index=texts.index, dtype=object)

    return run


def with_next(df: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    """``df`` with ``next_<column>``: the row after it by descending id (ties by text order of the
    columns; null ids last), and for the last row the first.

    Rows are dealt to ranges of ids; the first row of each range goes to the range before it as
    well, so that every window holds the successors it needs and no task sees all rows."""
    spark = df.sparkSession
    bounds = bounds_of(df, id_col, 4 * partitions(spark))
    ranged = df.withColumn("range", bucket_of(F.col(id_col), bounds))
    firsts = {r["range"]: r["top"] for r in df.select(id_col).withColumn("range", bucket_of(F.col(id_col), bounds))
              .groupBy("range").agg(F.max(id_col).alias("top")).collect()}
    ordered = sorted(firsts, reverse=True)
    goes_to = {r: ordered[i - 1] for i, r in enumerate(ordered)}
    tops = sorted((firsts[r], goes_to[r]) for r in ordered if firsts[r] is not None)
    ids = [t for t, _ in tops]
    targets = np.array([g for _, g in tops], dtype=np.int64)
    lookup = np.array(ids, dtype=np.int64)
    void = [goes_to[r] for r in ordered if firsts[r] is None]

    @F.pandas_udf("int")
    def target(values: pd.Series) -> pd.Series:
        known = values.notna().to_numpy()
        value = values.fillna(0).to_numpy().astype(np.int64)
        out = np.full(len(values), -1, dtype=np.int64)
        if len(lookup):
            at = np.minimum(np.searchsorted(lookup, value), len(lookup) - 1)
            out = np.where(known & (lookup[at] == value), targets[at], out)
        if void:
            out = np.where(known, out, void[0])
        return pd.Series(out.astype(np.int32))

    also = ranged.withColumn("also", target(F.col(id_col)))
    copies = F.when(
        F.col("also") >= 0,
        F.array(F.struct(F.col("range").alias("range"), F.lit(0).alias("guest")), F.struct(F.col("also").alias("range"), F.lit(1).alias("guest"))),
    ).otherwise(F.array(F.struct(F.col("range").alias("range"), F.lit(0).alias("guest"))))
    spread = also.withColumn("copy", F.explode(copies)).select(id_col, *columns, "copy.range", "copy.guest")
    order = Window.partitionBy("range").orderBy("guest", F.col(id_col).desc_nulls_last(), *columns)
    follow = spread.select("*", *(F.lead(c).over(order).alias(f"next_{c}") for c in columns))
    return follow.where("guest = 0").drop("range", "guest")


def edited(text: Column, other: Column) -> Column:
    """``text`` with its last third (rounded down) replaced by the start of ``other``."""
    third = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - third), F.substring(other, F.lit(1), third))


def compared(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, bins: int = BINS, bits: int = BITS
) -> DataFrame:
    """``id_col``, ``n_chars``, ``edited`` (the edited text), ``fingerprint`` and
    ``edited_fingerprint`` (packed bytes), ``near_edited``, ``near_next``.

    Null and empty texts have the empty fingerprint; a very long one is fingerprinted whole; a table of
    one row is its own successor; rows that repeat stay repeated; an empty table gives no rows; other
    columns, whatever their names, are ignored."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    base = df.select(F.col(f"`{id_col}`"), text.alias("text"))
    printed = base.withColumn("fingerprint", fingerprint_udf(words, bins, bits)("text"))
    rows = with_next(printed, id_col, ["text", "fingerprint"])
    rows = rows.select(
        id_col,
        F.length("text").cast("long").alias("n_chars"),
        edited(F.col("text"), F.col("next_text")).alias("edited"),
        "fingerprint",
        "next_fingerprint",
    )
    kind = df.schema[id_col].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own, following = batch.column("fingerprint").to_pylist(), batch.column("next_fingerprint").to_pylist()
        texts = batch.column("edited").to_pylist()
        other = [p for i in range(0, len(texts), 512) for p in packed(texts[i : i + 512], words, bins, bits)]
        return pa.RecordBatch.from_arrays(
            [
                batch.column(id_col),
                batch.column("n_chars"),
                batch.column("edited"),
                batch.column("fingerprint"),
                pa.array(other, pa.binary()),
                pa.array(likeness(own, other, bits)),
                pa.array(likeness(own, following, bits)),
            ],
            names=[id_col, "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    schema = (
        f"`{id_col}` {kind}, n_chars bigint, edited string, fingerprint binary, edited_fingerprint binary, "
        "near_edited double, near_next double"
    )
    return map_rows(rows, run, schema, "edited")
