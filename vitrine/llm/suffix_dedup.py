"""Removal of long repeated byte strings by sharded suffix sorting.

Equal strings of ``length`` bytes must meet in one shard without moving the whole text:

1. Of the hashes of all ``GRAM``-byte grams inside a window of ``length`` bytes the least one
   names the window; equal windows have equal names.  A run of windows with one name is a
   segment.  A window can only repeat if its name occurs in two segments, or if one text has
   that least gram at two places, so all others stop here (counts over all documents).
2. Segments of equal bytes are counted and one of each goes, with its bytes, to the shard of its
   name.
3. Each shard is suffix-sorted by external induced sorting (``induced``); neighbours with a common
   prefix of ``length`` are repeats, as are all windows of a segment that occurs twice.
   The segments of a name that are too many bytes for one task are cut once more by the least
   gram under another hash, which equal windows share as well, and so on until a name is small.
4. The repeated runs return to every place of their segment and are cut from the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm.common import map_rows, partitions, stored
from vitrine.llm.induced import repeated

#: Bytes of a gram; the rest of a window is room for the least gram to lie in.
GRAM = 32
#: Aimed bytes of a shard, and bytes that each queue of its sort keeps in memory.
SHARD_BYTES = 2 << 20
QUEUE_BYTES = 8 << 20
#: Bytes of distinct segments of one name from which on they are cut by another hash; a sort takes
#: some tens of bytes of memory for each.
NAME_BYTES = 4 << 20
#: Hashes tried after the first one.
LEVELS = 8
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _gram_hashes(data: np.ndarray, level: int = 0) -> np.ndarray:
    """A mixed hash of the ``GRAM`` bytes from each place on, another one for each ``level``."""
    value, width, factor = data.astype(np.uint64) + np.uint64(1), 1, _FACTOR
    while width < GRAM:
        value = value[:-width] * np.uint64(factor) + value[width:]
        factor, width = factor * factor % (1 << 64), 2 * width
    value ^= np.uint64(level * _INVERSE % (1 << 64))
    value ^= value >> np.uint64(31)
    value *= np.uint64(0xBF58476D1CE4E5B9)
    value ^= value >> np.uint64(29)
    value *= np.uint64(0x94D049BB133111EB)
    return value ^ value >> np.uint64(32)


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours: suffix minima of one block, prefix minima of the next."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def text_segments(data: np.ndarray, length: int, level: int = 0) -> tuple[np.ndarray, ...]:
    """(name, digest, start, windows, twice) of the segments of one text, given as bytes.

    ``twice`` is 1 where the gram of the name is the least of a window at two places of the text."""
    grams, room = _gram_hashes(data, level), length - GRAM + 1
    least = _sliding_least(grams, room)
    start = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
    windows = np.diff(np.append(start, len(least)))
    # a gram is the least of some window if it equals the largest least of the windows around it
    padded = np.full(len(least) + 2 * room - 2, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[room - 1 : room - 1 + len(least)] = ~least
    tops = np.sort(grams[grams == ~_sliding_least(padded, room)])
    again = tops[1:][tops[1:] == tops[:-1]]
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_FACTOR, len(data)), out=sums[1:])
    end = start + windows + length - 1
    digest = (sums[end] - sums[start]) * _powers(_INVERSE, len(data))[start] + windows.astype(np.uint64)
    name = least[start]
    return name.view(np.int64), digest.view(np.int64), start, windows, np.isin(name, again)


def segments(keyed: DataFrame, length: int) -> DataFrame:
    """``(name, digest, row_key, start, windows, twice)``; texts shorter than a window have none."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[list] = [[], [], [], [], [], []]
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
            if len(data) < length:
                continue
            name, digest, start, windows, twice = text_segments(data, length)
            for column, part in zip(out, (name, digest, np.full(len(name), key), start, windows, twice)):
                column.append(part)
        whole = [np.concatenate(c) if c else np.empty(0, np.int64) for c in out]
        kinds = [pa.int64()] * 3 + [pa.int32()] * 3
        return pa.RecordBatch.from_arrays(
            [pa.array(w.astype(np.int64)).cast(k) for w, k in zip(whole, kinds)],
            names=["name", "digest", "row_key", "start", "windows", "twice"],
        )

    return map_rows(
        keyed.select("row_key", "text"),
        run,
        "name bigint, digest bigint, row_key bigint, start int, windows int, twice int",
        "text",
    )


def _sort_shard(length: int):
    """Repeated byte ranges ``[a, b)`` of each segment of one shard."""

    def run(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(b, dtype=np.uint8) for b in table.column("bytes").to_pylist()]
        sizes = np.array([len(p) for p in parts])
        begin = np.concatenate([[0], np.cumsum(sizes + 1)])
        text = np.zeros(begin[-1], dtype=np.uint8)
        for place, part in zip(begin, parts):
            # valid UTF-8 has no byte 255, so adding one leaves 0 for the ends
            text[place : place + len(part)] = part + 1
        mark = repeated(text, length, QUEUE_BYTES)
        for place, size, copies in zip(begin, sizes, table.column("copies").to_numpy()):
            if copies > 1:
                mark[place : place + size - length + 1] = True
        edge = np.flatnonzero(np.diff(np.concatenate([[False], mark, [False]]).astype(np.int8)))
        first, last = edge[::2], edge[1::2]
        owner = np.searchsorted(begin, first, side="right") - 1
        picked = table.select(["name", "digest"]).take(pa.array(owner))
        return picked.append_column("a", pa.array((first - begin[owner]).astype(np.int32))).append_column(
            "b", pa.array((last - begin[owner] + length - 1).astype(np.int32))
        )

    return run


def _cut_again(length: int, level: int):
    """The segments of each segment under the hash of ``level``: equal windows of one name get one
    name again."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        owner, out = [], [[], [], [], [], []]
        parts: list[bytes] = []
        for row, (name, held) in enumerate(zip(batch.column("name").to_pylist(), batch.column("bytes").to_pylist())):
            again, digest, start, windows, twice = text_segments(np.frombuffer(held, dtype=np.uint8), length, level)
            # the name before is part of the name: an injective mix
            again = ((again.view(np.uint64) ^ np.uint64(name % (1 << 64))) * np.uint64(_FACTOR)).view(np.int64)
            owner.append(np.full(len(again), row))
            for column, part in zip(out, (again, digest, start, windows, twice)):
                column.append(part.astype(np.int64))
            parts.extend(held[a : a + n + length - 1] for a, n in zip(start.tolist(), windows.tolist()))
        whole = [np.concatenate(c) if c else np.empty(0, np.int64) for c in out]
        at = pa.array(np.concatenate(owner) if owner else np.empty(0, np.int64))
        kept = batch.select(["name", "digest", "copies"]).take(at)
        return pa.RecordBatch.from_arrays(
            [*kept.columns, *(pa.array(w) for w in whole), pa.array(parts, pa.binary())],
            names=["old_name", "old_digest", "copies", "name", "digest", "start", "windows", "twice", "bytes"],
        )

    return run


def _runs(sent: DataFrame, sizes: DataFrame, length: int, level: int) -> DataFrame:
    """``(name, digest, a, b)``: repeated byte ranges of the distinct segments ``sent``, with the
    bytes of each in ``sizes``."""
    by_name = stored(sizes.groupBy("name").agg(F.sum("size").alias("size")), "sizes")
    total = by_name.agg(F.sum("size"), F.max("size")).first()
    shards = max(int((total[0] or 0) // SHARD_BYTES) + 1, partitions(sent.sparkSession))
    large = by_name.where(F.col("size") > NAME_BYTES).select("name")
    again = None
    # a window alone has the same names as its equals only, so some level cuts any name down
    if (total[1] or 0) > NAME_BYTES and level <= LEVELS:
        schema = (
            "old_name bigint, old_digest bigint, copies bigint, name bigint, digest bigint, start bigint, "
            "windows bigint, twice bigint, bytes binary"
        )
        part = sent.join(large, "name", "left_semi")
        cut = stored(map_rows(part, _cut_again(length, level), schema, "bytes"), "cut")
        names = cut.groupBy("name").agg(F.sum("copies").alias("n"), F.max("twice").alias("twice"))
        cut = cut.join(names.where("n > 1 or twice > 0").select("name"), "name", "left_semi")
        kinds = cut.groupBy("name", "digest").agg(F.sum("copies").alias("copies"), F.first("bytes").alias("bytes"))
        kinds = stored(kinds, "cut-segments")
        found = _runs(kinds, kinds.select("name", F.length("bytes").alias("size")), length, level + 1)
        again = cut.drop("bytes").join(found, ["name", "digest"]).select(
            F.col("old_name").alias("name"),
            F.col("old_digest").alias("digest"),
            (F.col("start") + F.col("a")).cast("int").alias("a"),
            (F.col("start") + F.col("b")).cast("int").alias("b"),
        )
        sent = sent.join(large, "name", "left_anti")
    dealt = sent.withColumn("shard", F.pmod(F.xxhash64("name"), F.lit(shards)))
    runs = stored(
        dealt.groupBy("shard").applyInArrow(_sort_shard(length), "name bigint, digest bigint, a int, b int"),
        "runs",
    )
    return runs if again is None else stored(runs.union(again), "runs")


def repeated_ranges(keyed: DataFrame, length: int) -> DataFrame:
    """``(row_key, ranges)``: byte ranges of each text that strings of ``length`` bytes cover which
    also start anywhere else; texts without any have no row.  ``keyed`` has row_key and text."""
    found = segments(keyed, length)
    names = stored(
        found.groupBy("name")
        .agg(F.count(F.lit(1)).alias("n"), F.max("twice").alias("twice"))
        .where("n > 1 or twice > 0")
        .select("name"),
        "names",
    )
    places = stored(found.join(names, "name"), "places")
    kinds = places.groupBy("name", "digest").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("row_key", "start", "windows")).alias("at")
    )
    kinds = stored(kinds.select("name", "digest", "copies", "at.*"), "segments")
    data = F.col("text").cast("binary")
    # rows that repeat whole share a key: one of them gives the bytes
    twins = keyed.groupBy("row_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("row_key")
    twins = stored(twins, "twins")
    paired = keyed.join(twins, "row_key", "left_semi").dropDuplicates(["row_key"])
    once = keyed.join(twins, "row_key", "left_anti").unionByName(paired)
    sent = kinds.join(once, "row_key").select(
        "name",
        "digest",
        "copies",
        F.substring(data, F.col("start") + 1, F.col("windows") + (length - 1)).alias("bytes"),
    )
    sizes = kinds.select("name", (F.col("windows") + length).alias("size"))
    runs = _runs(sent, sizes, length, 1)
    return (
        places.join(runs, ["name", "digest"])
        .select("row_key", F.expr("struct(start + a as a, start + b as b)").alias("r"))
        .groupBy("row_key")
        .agg(F.collect_set("r").alias("ranges"))
    )


def _merged(ranges: list[dict]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted((r["a"], r["b"]) for r in ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _whole_characters(data: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans shrunk to whole UTF-8 characters."""
    out = []
    for a, b in spans:
        while a < b and data[a] & 0xC0 == 0x80:
            a += 1
        while a < b and b < len(data) and data[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def remove_repeats(
    df: DataFrame, text_col: str = "text", length: int = 200, whole_characters: bool = False
) -> DataFrame:
    """The columns of ``df`` but its text, with ``kept`` (the remaining bytes), ``n_bytes``,
    ``n_removed`` and ``spans`` (the removed byte ranges, maximal, in order).

    A byte goes if a string of ``length`` bytes that covers it also starts anywhere else, in this
    text or another; strings are judged on the input.  Null texts count as empty; texts shorter
    than ``length`` are kept whole.  Rows that repeat are separate texts and lose what they share.
    ``whole_characters`` leaves bytes of a character that is not removed entirely.  Columns of
    the four result names in ``df`` are replaced.  Matches never cross texts."""
    if length <= GRAM:
        raise ValueError(f"length must exceed {GRAM}")
    names = [c for c in df.columns if c not in (text_col, "kept", "n_bytes", "n_removed", "spans")]
    row = F.struct(*(F.col(f"`{c}`") for c in names), F.lit(1).alias("__one"))
    rows = df.select(row.alias("row"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    rows = rows.withColumn("row_key", F.xxhash64("row", "text"))
    ranges = repeated_ranges(rows.select("row_key", "text"), length)
    # a type in words would not hold every column name
    span = T.StructType().add("a", T.IntegerType()).add("b", T.IntegerType())
    schema = T.StructType().add("row", rows.schema["row"].dataType).add("kept", T.BinaryType())
    schema = schema.add("n_bytes", T.LongType()).add("n_removed", T.LongType()).add("spans", T.ArrayType(span))

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept, sizes, removed, spans = [], [], [], []
        for text, found in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist()):
            data = text.encode("utf-8", "surrogatepass")
            gone = _merged(found or [])
            if whole_characters:
                gone = _whole_characters(data, gone)
            parts, done = [], 0
            for a, b in gone:
                parts.append(data[done:a])
                done = b
            parts.append(data[done:])
            kept.append(b"".join(parts))
            sizes.append(len(data))
            removed.append(len(data) - len(kept[-1]))
            spans.append([{"a": a, "b": b} for a, b in gone])
        pair = pa.struct([("a", pa.int32()), ("b", pa.int32())])
        return pa.RecordBatch.from_arrays(
            [
                batch.column("row"),
                pa.array(kept, pa.binary()),
                pa.array(sizes, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(spans, pa.list_(pair)),
            ],
            names=["row", "kept", "n_bytes", "n_removed", "spans"],
        )

    joined = rows.join(ranges, "row_key", "left").select("row", "text", "ranges")
    found = map_rows(joined, cut, schema, "text")
    return found.select(*(F.col(f"row.`{c}`") for c in names), "kept", "n_bytes", "n_removed", "spans")
