"""Helpers shared by the operators: stored tables, ordered id buckets, Arrow loops."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of an Arrow batch that hold at most this much text are turned into Python objects at once.
SLICE_BYTES = 2 << 20
#: The same where larger batches share more words, and bytes of words that such a worker remembers
#: in each of two generations.
WORD_BYTES = 4 << 20
MEMORY_BYTES = 16 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.  Where that is unset, a session in one machine (as in
    tests) gets a temporary one; a cluster is refused, as its executors would not see each other's."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="vitrine-llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` as written Parquet in the shared folder: lineage ends here and lost executors
    cost no earlier work.  The folder name is unique; its removal belongs to whoever owns the
    shared folder."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(
    batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about ``most`` bytes of ``column``, one row at least."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        step = max(1, int(n * most / max(1, batch.column(column).nbytes)))
        for start in range(0, n, step):
            yield batch.slice(start, step)


def map_rows(
    df: DataFrame,
    function: Callable[[pa.RecordBatch], pa.RecordBatch],
    schema: str | T.StructType,
    text: str,
    most: int = SLICE_BYTES,
) -> DataFrame:
    """One output batch per slice of input rows; ``function`` sees bounded text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, most):
            yield function(batch)
            # a worker lives on: what Arrow holds for later would count against its executor
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def bounds_of(df: DataFrame, column: str, buckets: int) -> list:
    """At most ``buckets - 1`` ascending cut values that split ``column`` about evenly.

    The driver receives these values alone."""
    if buckets < 2:
        return []
    shares = [i / buckets for i in range(1, buckets)]
    row = df.agg(F.percentile_approx(column, shares, max(10_000, 20 * buckets)).alias("b")).first()
    return sorted(set(row["b"] or []))


def bucket_of(column: Column, bounds: list) -> Column:
    """Number of the bucket: how many bounds lie below ``column`` (null: bucket 0)."""
    if not bounds:
        return F.lit(0)
    cuts = np.asarray(bounds, dtype=np.int64)

    @F.pandas_udf("int")
    def rank(values: pd.Series) -> pd.Series:
        known = values.notna().to_numpy()
        low = np.searchsorted(cuts, values.fillna(0).to_numpy().astype(np.int64), side="left")
        return pd.Series(np.where(known, low, 0).astype(np.int32))

    return rank(column)


def spread_out(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Places begin, begin + 1, ... of every range, one after another."""
    ends = np.cumsum(size, dtype=np.int64)
    out = np.repeat(begin - (ends - size), size)
    out += np.arange(len(out))
    return out


# Two keys of the hash, so that a word is known by 128 bits.
HASH_KEYS = ("0123456789abcdef", "fedcba9876543210")


class _Known:
    """Sorted word hashes with their numbers, one after another in a flat array."""

    def __init__(self, kind: np.dtype):
        self.key = np.zeros(0, np.uint64)
        self.check = np.zeros(0, np.uint64)
        self.begin, self.size, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, kind)

    def places(self, key: np.ndarray, check: np.ndarray) -> np.ndarray:
        """Place of each word, -1 where it is not known."""
        if not len(self.key):
            return np.full(len(key), -1)
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where((self.key[at] == key) & (self.check[at] == check), at, -1)

    def add(self, key, check, size, flat) -> None:
        begin = len(self.flat) + np.cumsum(size) - size
        whole = np.concatenate([self.key, key])
        order = np.argsort(whole, kind="stable")
        self.key = whole[order]
        for name, more in (("check", check), ("begin", begin), ("size", size)):
            setattr(self, name, np.concatenate([getattr(self, name), more])[order])
        self.flat = np.concatenate([self.flat, flat])

    def bytes(self) -> int:
        return sum(a.nbytes for a in (self.key, self.check, self.begin, self.size, self.flat))


class WordMemory:
    """Numbers by word in two generations: when the newer holds ``size`` bytes it becomes the older,
    and what is found in the older moves to the newer.  So at most about twice ``size`` bytes are
    held whatever the words are, and words in use stay."""

    def __init__(self, kind: np.dtype, size: int = MEMORY_BYTES):
        self.kind, self.size = np.dtype(kind), size
        self.newer, self.older = _Known(self.kind), _Known(self.kind)

    def numbers(
        self, words: list[str], work_out: Callable[[list[str]], list[bytes]]
    ) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of distinct words, one after another, and how many each has; ``work_out`` gives
        the bytes of those of words that are not known."""
        if self.newer.bytes() > self.size:
            self.older, self.newer = self.newer, _Known(self.kind)
        texts = np.array(words, dtype=object)
        key, check = (pd.util.hash_array(texts, hash_key=k, categorize=False) for k in HASH_KEYS)
        new, old = self.newer.places(key, check), self.older.places(key, check)
        old[new >= 0] = -1
        gaps = np.flatnonzero((new < 0) & (old < 0))
        fresh = work_out(texts[gaps].tolist())
        begin, size = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        shift = 0
        for known, at in ((self.newer, new), (self.older, old)):
            here = at >= 0
            begin[here], size[here] = known.begin[at[here]] + shift, known.size[at[here]]
            shift += len(known.flat)
        size[gaps] = np.fromiter(map(len, fresh), np.int64, len(fresh)) // self.kind.itemsize
        begin[gaps] = shift + np.cumsum(size[gaps]) - size[gaps]
        source = np.concatenate([self.newer.flat, self.older.flat, np.frombuffer(b"".join(fresh), self.kind)])
        flat = source[spread_out(begin, size)]
        more = np.flatnonzero(new < 0)
        if len(more):
            self.newer.add(key[more], check[more], size[more], source[spread_out(begin[more], size[more])])
        return flat, size
