"""Line dedup by a sharded minimal perfect hash.

Every line long enough is known by a 128-bit hash of its key.  Hashes are counted over all
documents, and those of enough documents are dealt into shards.  A shard is a minimal perfect hash
(levels of bits: a key takes the bit of its hash where no other key of the level wants it, the others
go to the next level; a key's number is the count of bits before its own) over arrays of 64-bit
fingerprints, document counts and largest holders, some 21 bytes a line whatever its length.

Documents then probe the arrays; their lines meet in no join.  Arrays up to a checked size go to every
task.  Beyond it the hashes of a document travel to the shard instead, dealt over several copies of a
shard that many documents ask, and what they hit travels back.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import HASH_KEYS, map_rows, slices, stored

#: Keys in a shard on average, and bits for each key of a level.
SHARD_KEYS, ROOM = 1 << 15, 2
#: Bytes of arrays that are sent to every task; more are probed where they lie.
SENT_BYTES = 48 << 20
#: Probes that one copy of a shard answers.
COPY_PROBES = 1 << 20
#: Bytes of text whose lines are hashed together.
BATCH_BYTES = 2 << 20
# The characters cut from both ends of a line.
EDGES = " \t\n\v\f\r"
_POPULATION = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def _mixed(key: np.ndarray, check: np.ndarray, level: int) -> np.ndarray:
    """Another hash of the same keys for every level."""
    x = key + check * np.uint64(2 * level + 1)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Numbers 0 to n - 1 for n keys; any other key gets some number or -1."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(_POPULATION[bits], dtype=np.int64)])

    @classmethod
    def of(cls, key: np.ndarray, check: np.ndarray) -> PerfectHash:
        sizes, levels = [], []
        while len(key):
            size = -(-max(64, ROOM * len(key)) // 8) * 8
            place = (_mixed(key, check, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size) == 1
            sizes.append(size)
            levels.append(np.packbits(alone, bitorder="little"))
            left = ~alone[place]
            key, check = key[left], check[left]
        return cls(np.array(sizes, np.int64), np.concatenate([np.zeros(0, np.uint8), *levels]))

    def numbers(self, key: np.ndarray, check: np.ndarray) -> np.ndarray:
        out, open_ = np.full(len(key), -1, np.int64), np.arange(len(key))
        for level, size in enumerate(self.sizes.tolist()):
            k, c = key[open_], check[open_]
            place = self.starts[level] + (_mixed(k, c, level) % np.uint64(size)).astype(np.int64)
            byte, bit = self.bits[place >> 3], (place & 7).astype(np.uint8)
            hit = (byte >> bit) & 1 == 1
            low = _POPULATION[byte & ((1 << bit.astype(np.int64)) - 1).astype(np.uint8)]
            out[open_[hit]] = (self.before[place >> 3] + low)[hit]
            open_ = open_[~hit]
            if not len(open_):
                break
        return out


class Shard:
    """The arrays behind one perfect hash."""

    def __init__(self, row: dict):
        self.hash = PerfectHash(np.frombuffer(row["sizes"], np.int64), np.frombuffer(row["bits"], np.uint8))
        self.prints = np.frombuffer(row["prints"], np.uint64)
        self.counts = np.frombuffer(row["counts"], np.uint32)
        self.holders = np.frombuffer(row["holders"], np.int64)

    @staticmethod
    def row(shard: int, key: np.ndarray, check: np.ndarray, counts: np.ndarray, holders: np.ndarray) -> dict:
        hash_ = PerfectHash.of(key, check)
        order = np.argsort(hash_.numbers(key, check))
        return {
            "shard": shard,
            "sizes": hash_.sizes.tobytes(),
            "bits": hash_.bits.tobytes(),
            "prints": check[order].tobytes(),
            "counts": np.minimum(counts[order], (1 << 32) - 1).astype(np.uint32).tobytes(),
            "holders": holders[order].tobytes(),
        }

    def goes(self, key: np.ndarray, check: np.ndarray, ids: np.ndarray, least: int) -> np.ndarray:
        """Whether lines of these hashes leave the documents of these ids."""
        at = self.hash.numbers(key, check)
        known = at >= 0
        at = np.where(known, at, 0)
        if not len(self.prints):
            return known
        return known & (self.prints[at] == check) & (self.counts[at] >= least) & (self.holders[at] != ids)


_SHARD = "shard bigint, sizes binary, bits binary, prints binary, counts binary, holders binary"


class _Lines:
    """The lines of a batch of texts, the hashes of those long enough, and their texts."""

    def __init__(self, texts: pa.Array, shortest: int):
        texts = pa.array([t or "" for t in texts.to_pylist()], pa.large_string())
        split = pc.split_pattern(texts, "\n")
        edges = split.offsets.to_numpy()
        self.edges = (edges - edges[0]).astype(np.int64)
        self.texts = split.flatten()
        keys = pc.ascii_lower(pc.ascii_trim(self.texts, EDGES))
        self.places = np.flatnonzero(pc.greater_equal(pc.utf8_length(keys), shortest).to_numpy(zero_copy_only=False))
        coded = keys.take(pa.array(self.places)).dictionary_encode()
        distinct = np.array(coded.dictionary.to_pylist(), dtype=object)
        code = coded.indices.to_numpy()
        self.key, self.check = (pd.util.hash_array(distinct, hash_key=k, categorize=False)[code] for k in HASH_KEYS)
        self.rows = np.searchsorted(self.edges, self.places, side="right") - 1

    def kept(self, goes: np.ndarray) -> tuple[np.ndarray, pa.Array]:
        """How many lines go of each text, and the others joined again."""
        stay = np.ones(len(self.texts), bool)
        stay[self.places[goes]] = False
        left = np.concatenate([[0], np.cumsum(stay)])[self.edges]
        lists = pa.ListArray.from_arrays(pa.array(left.astype(np.int32)), self.texts.filter(pa.array(stay)))
        return np.diff(self.edges) - np.diff(left), pc.binary_join(lists, pa.scalar("\n", pa.large_string())).cast(pa.string())


def _ids(column: pa.Array) -> np.ndarray:
    """Ids as numbers; null is below all others."""
    return pc.fill_null(column.cast(pa.int64()), np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


@dataclass(frozen=True)
class LineIndex:
    """The shards, how many there are, and which lines count."""

    shards: DataFrame
    number: int
    shortest: int
    least: int


def line_index(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = 20, least: int = 3
) -> LineIndex:
    """The shards over all lines of at least ``shortest`` characters that ``least`` rows hold or more."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col, BATCH_BYTES):
            lines = _Lines(batch.column(1), shortest)
            ids = _ids(batch.column(0))
            # a row counts once for each key, and a batch sends each key once
            order = np.lexsort((lines.rows, lines.check, lines.key))
            key, check, rows = lines.key[order], lines.check[order], lines.rows[order]
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (check[1:] != check[:-1])
            once = new.copy()
            once[1:] |= rows[1:] != rows[:-1]
            begins = np.flatnonzero(new)
            if len(begins):
                yield pa.RecordBatch.from_arrays(
                    [
                        _signed(key[begins]),
                        _signed(check[begins]),
                        pa.array(np.add.reduceat(once.astype(np.int64), begins)),
                        pa.array(np.maximum.reduceat(ids[rows], begins)),
                    ],
                    names=["key", "check", "n_rows", "holder"],
                )
            pa.default_memory_pool().release_unused()

    seen = df.select(F.col(f"`{id_col}`").cast("bigint"), F.col(f"`{text_col}`").alias(text_col)).mapInArrow(
        found, "key bigint, check bigint, n_rows bigint, holder bigint"
    )
    counted = seen.groupBy("key", "check").agg(F.sum("n_rows").alias("n_rows"), F.max("holder").alias("holder"))
    keys = stored(counted.where(F.col("n_rows") >= least), "line-keys")
    number = max(1, -(-keys.count() // SHARD_KEYS))

    def built(table: pa.Table) -> pa.Table:
        part = {c: table.column(c).to_numpy() for c in table.column_names}
        key, check = (np.ascontiguousarray(part[c]).view(np.uint64) for c in ("key", "check"))
        row = Shard.row(int(part["shard"][0]), key, check, part["n_rows"], part["holder"])
        return pa.table({c: pa.array([v], pa.int64() if c == "shard" else pa.binary()) for c, v in row.items()})

    dealt = keys.withColumn("shard", F.pmod("key", F.lit(number)))
    return LineIndex(stored(dealt.groupBy("shard").applyInArrow(built, _SHARD), "line-shards"), number, shortest, least)


def _every_task(docs: DataFrame, index: LineIndex, id_at: int, text_at: int):
    """A function from a batch of ``docs`` to its lines and those that go; all tasks hold all shards,
    whose size was checked."""
    sent = docs.sparkSession.sparkContext.broadcast([row.asDict() for row in index.shards.collect()])
    number, shortest, least = index.number, index.shortest, index.least
    opened: dict[int, Shard] = {}

    def probe(batch: pa.RecordBatch) -> tuple[_Lines, np.ndarray]:
        if not opened:
            opened.update({row["shard"]: Shard(row) for row in sent.value})
        lines = _Lines(batch.column(text_at), shortest)
        ids = _ids(batch.column(id_at))[lines.rows]
        goes = np.zeros(len(ids), bool)
        shard = lines.key.view(np.int64) % number
        order = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[order], np.arange(number + 1))
        for s in np.flatnonzero(np.diff(cuts)).tolist():
            if s in opened:
                part = order[cuts[s] : cuts[s + 1]]
                goes[part] = opened[s].goes(lines.key[part], lines.check[part], ids[part], least)
        return lines, goes

    return probe


def _where_they_lie(docs: DataFrame, index: LineIndex, id_col: str, text_col: str, copy_probes: int) -> DataFrame:
    """``docs`` (with its row marks) and ``_gone``, the hashes of the lines that go: hashes travel to
    the shards and hits travel back."""
    number, shortest, least = index.number, index.shortest, index.least

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            lines = _Lines(batch.column(3), shortest)
            marks = [batch.column(i).take(pa.array(lines.rows)) for i in range(3)]
            yield pa.RecordBatch.from_arrays(
                [*marks, _signed(lines.key), _signed(lines.check)], names=["_id", "_mark", "_seal", "key", "check"]
            )

    probe = "_id bigint, _mark bigint, _seal bigint, key bigint, check bigint"
    texts = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("_id"), "_mark", "_seal", F.col(f"`{text_col}`").alias("text"))
    shard = F.pmod("key", F.lit(number))
    probes = stored(texts.mapInArrow(asked, probe).withColumn("shard", shard), "line-probes")
    loads = probes.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / copy_probes).cast("int").alias("copies"))
    places = F.explode(F.sequence(F.lit(0), F.col("copies") - 1))
    copied = index.shards.join(loads, "shard").withColumn("copy", places).drop("copies")
    dealt = probes.join(loads, "shard").withColumn("copy", F.pmod(F.hash("_mark", "_id"), "copies")).drop("copies")
    # both sides read the loads: new names keep them apart
    copied = copied.select(*(F.col(c).alias(c if c in ("shard", "copy") else f"held_{c}") for c in copied.columns))

    def answered(part: pa.Table, arrays: pa.Table) -> pa.Table:
        names = ["_id", "_mark", "_seal", "key", "check"]
        if not arrays.num_rows:
            return part.select(names).slice(0, 0)
        held = Shard({c.removeprefix("held_"): v for c, v in arrays.to_pylist()[0].items()})
        key, check = (np.ascontiguousarray(part.column(c).to_numpy()).view(np.uint64) for c in ("key", "check"))
        return part.select(names).filter(pa.array(held.goes(key, check, _ids(part.column("_id").combine_chunks()), least)))

    hits = dealt.groupBy("shard", "copy").cogroup(copied.groupBy("shard", "copy")).applyInArrow(answered, probe)
    gone = hits.groupBy("_id", "_mark", "_seal").agg(F.collect_set(F.struct("key", "check")).alias("_gone")).select(
        F.col("_id").alias("_of"), F.col("_mark").alias("_of_mark"), F.col("_seal").alias("_of_seal"), "_gone"
    )
    same = (
        F.col(f"`{id_col}`").cast("bigint").eqNullSafe(F.col("_of"))
        & F.col("_mark").eqNullSafe(F.col("_of_mark"))
        & F.col("_seal").eqNullSafe(F.col("_of_seal"))
    )
    return docs.join(gone, same, "left").drop("_of", "_of_mark", "_of_seal")


def remove_lines(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shortest: int = 20,
    least: int = 3,
    lines_col: str = "n_lines",
    dropped_col: str = "n_dropped",
    kept_col: str = "kept",
    sent_bytes: int = SENT_BYTES,
    copy_probes: int = COPY_PROBES,
) -> DataFrame:
    """``df`` without ``text_col``, with the number of lines of each whole text, how many go, and the
    others joined by a line feed.

    A line's key is the line without the characters U+0020 and U+0009 to U+000D at its ends, A-Z in
    lower case.  Keys of at least ``shortest`` characters that at least ``least`` rows hold lose all
    their lines but those of the rows with the largest id that holds the key.  ``id_col`` is a whole
    number; null is below all others.

    Null and empty texts are one empty line, which stays; a very long text or line is read whole;
    rows that repeat count as often and, as their ids tie, share their fate; an empty table gives an
    empty one.  Other columns stay, whatever their names; those named as the new ones are replaced.
    Arrays of more than ``sent_bytes`` are probed where they lie."""
    targets = {lines_col: "bigint", dropped_col: "bigint", kept_col: "string"}
    names = [c for c in df.columns if c not in targets or c in (id_col, text_col)]
    docs = df.select(*(F.col(f"`{c}`") for c in names))
    index = line_index(docs, id_col, text_col, shortest, least)
    size = index.shards.agg(sum(F.sum(F.length(c)) for c in ("bits", "prints", "counts", "holders")).alias("b")).first()["b"] or 0
    held = [i for i, c in enumerate(names) if c != text_col]
    kinds = [f"`{names[i]}` {docs.schema[names[i]].dataType.simpleString()}" for i in held]
    schema = ", ".join([*kinds, *(f"`{c}` {kind}" for c, kind in targets.items())])
    text_at = names.index(text_col)

    def result(batch: pa.RecordBatch, lines: _Lines, goes: np.ndarray) -> pa.RecordBatch:
        gone, kept = lines.kept(goes)
        made = [pa.array(np.diff(lines.edges)), pa.array(gone), kept]
        return pa.RecordBatch.from_arrays(
            [*(batch.column(i) for i in held), *made], names=[*(names[i] for i in held), *targets]
        )

    if size <= sent_bytes:
        probe = _every_task(docs, index, names.index(id_col), text_at)
        return map_rows(docs, lambda batch: result(batch, *probe(batch)), schema, text_col, BATCH_BYTES)

    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    marked = docs.withColumn("_mark", F.xxhash64(text)).withColumn("_seal", F.xxhash64(F.lit("seal"), text))
    told = _where_they_lie(marked, index, id_col, text_col, copy_probes)

    def removed(batch: pa.RecordBatch) -> pa.RecordBatch:
        lines = _Lines(batch.column(text_at), shortest)
        gone = batch.column(batch.num_columns - 1)
        size = pc.fill_null(pc.list_value_length(gone), 0).to_numpy(zero_copy_only=False)
        flat = gone.flatten()
        hits = pd.MultiIndex.from_arrays(
            [np.repeat(np.arange(batch.num_rows), size), flat.field("key").to_numpy(), flat.field("check").to_numpy()]
        )
        probes = pd.MultiIndex.from_arrays([lines.rows, lines.key.view(np.int64), lines.check.view(np.int64)])
        return result(batch, lines, probes.isin(hits) if len(hits) else np.zeros(len(probes), bool))

    return map_rows(told, removed, schema, text_col, BATCH_BYTES)
