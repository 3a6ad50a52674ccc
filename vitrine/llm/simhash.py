"""SimHash near duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments of 23, 23 and 18 bits (the last padded with zeros).
Two fingerprints with at most three differing bits have at least two segments with at most one
error each (four errors would be needed otherwise), and two 23-bit words that differ in at most
one bit share a codeword: the one to which either word decodes under the perfect [23, 12, 7]
Golay code is also a codeword to which a neighbour of the other decodes.  So each fingerprint is
filed under the codeword indices of its radius-one ball (one or six per segment), paired over two
segments, and asked for under the pair to which it decodes itself.  Equal keys meet, pairs are
verified by their differing bits, and only a spanning forest of what a task finds leaves it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import map_rows, partitions, stored
from vitrine.llm.components import connected_components

SEED = 42
#: Bits of the three segments of a fingerprint.
SEGMENTS = (23, 23, 18)
#: Generator polynomial of the binary Golay code: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101
#: The largest number of differing bits for which the two-segment keys find every pair.
MAX_BITS = 3
#: Shingle hashes counted at once, and pairs compared at once.
CHUNK = 200_000
PAIRS = 2_000_000
#: Rows of a key from which on they are reached one from another instead of all compared.
LARGE = 100


def _syndrome(word: int) -> int:
    for bit in range(22, 10, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - 11)
    return word


def _decoder() -> tuple[np.ndarray, np.ndarray]:
    """Syndromes of single bits, and the error pattern of each syndrome."""
    single = np.array([_syndrome(1 << bit) for bit in range(23)], dtype=np.int64)
    errors = np.zeros(2048, dtype=np.int64)
    for weight in (1, 2, 3):
        for bits in combinations(range(23), weight):
            place = 0
            for bit in bits:
                place ^= int(single[bit])
            errors[place] = sum(1 << bit for bit in bits)
    return single, errors


_SINGLE, _ERRORS = _decoder()


def codeword_index(words: np.ndarray) -> np.ndarray:
    """The 12 data bits of the codeword nearest to each 23-bit word."""
    syndrome = np.zeros(words.shape, dtype=np.int64)
    for bit in range(23):
        syndrome ^= np.where(words >> bit & 1, _SINGLE[bit], 0)
    return (words ^ _ERRORS[syndrome]) >> 11


def segment_keys(words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Own codeword index of each word, and the distinct indices of its radius-one ball.

    The second array has six columns; places that repeat an index hold -1."""
    own = codeword_index(words)
    ball = np.stack([own, *(codeword_index(words ^ (1 << bit)) for bit in range(width))], axis=1)
    ball.sort(axis=1)
    ball[:, 1:][ball[:, 1:] == ball[:, :-1]] = -1
    ball.sort(axis=1)
    return own, ball[:, -6:]


def fingerprint_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, row, asks): every key of every fingerprint, and whether the row asks under it."""
    words, shift = [], 0
    for width in SEGMENTS:
        words.append((prints >> np.uint64(shift) & np.uint64((1 << width) - 1)).astype(np.int64))
        shift += width
    parts = [segment_keys(word, width) for word, width in zip(words, SEGMENTS)]
    keys, rows, asks = [], [], []
    for number, (a, b) in enumerate(combinations(range(3), 2)):
        (own_a, ball_a), (own_b, ball_b) = parts[a], parts[b]
        both = (ball_a[:, :, None] << 12 | ball_b[:, None, :]) + (number << 24)
        valid = (ball_a[:, :, None] >= 0) & (ball_b[:, None, :] >= 0)
        row = np.broadcast_to(np.arange(len(prints))[:, None, None], both.shape)[valid]
        key = both[valid]
        keys.append(key)
        rows.append(row)
        asks.append(key == ((own_a << 12 | own_b) + (number << 24))[row])
    return np.concatenate(keys), np.concatenate(rows), np.concatenate(asks)


def simhash(text: str | None, words: int) -> int:
    """Majority fingerprint of the hashes of word shingles, as an unsigned 64-bit number.

    A-Z are lower-cased; words are runs without ASCII white space; a text with fewer words gives
    one shingle; without any word the fingerprint is zero."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    digest = partial(xxhash.xxh64_intdigest, seed=SEED)
    total = max(1, len(tokens) - words + 1)
    counts = np.zeros(64, dtype=np.int64)
    for start in range(0, total, CHUNK):
        size = min(CHUNK, total - start)
        part = tokens[start : start + size + words - 1]
        shingles = zip(*(part[i:] for i in range(words))) if len(part) >= words else [part]
        hashes = np.fromiter(map(digest, map(b" ".join, shingles)), dtype="<u8", count=size)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > total, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str, text_col: str, words: int = 3) -> DataFrame:
    """``(id_col, fingerprint bigint)`` of each row; whole texts, in one pass without a shuffle."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = np.array([simhash(t, words) for t in batch.column(1).to_pylist()], dtype=np.uint64)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(prints.view(np.int64))], names=[id_col, "fingerprint"]
        )

    return map_rows(df.select(id_col, text_col), run, f"`{id_col}` {kind}, fingerprint bigint", text_col)


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each node to the least node of its component, for edges given as arrays."""
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = places[: len(a)], places[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, root[left], low)
        np.minimum.at(root, root[right], low)
        while not np.array_equal(root, root[root]):
            root = root[root]
        if np.array_equal(root, before):
            break
    away = root != np.arange(len(nodes))
    return nodes[away], nodes[root[away]]


def _differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


def _spread(prints: np.ndarray, bits: int, far=_differing) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the components of one large group, each row being met from one other.

    A row is compared with the rows not reached yet, so a dense group costs little more than one
    pass, not its square."""
    left, a, b = np.arange(len(prints)), [], []
    while len(left):
        open_, left = [int(left[0])], left[1:]
        while open_ and len(left):
            at = open_.pop()
            near = far(prints[left], prints[at]) <= bits
            hit = left[near]
            a.append(hit)
            b.append(np.full(len(hit), at))
            open_.extend(hit.tolist())
            left = left[~near]
    none = [np.empty(0, np.int64)]
    return np.concatenate(a or none), np.concatenate(b or none)


def _verified(keys: np.ndarray, prints: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of linked rows within equal keys (rows sorted by key); the low bit of a key says that
    the row asks.  Each asking row is compared with every row of its key, in blocks of pairs.
    ``prints`` has a column for each 64 bits of a fingerprint."""
    group = keys >> 1
    edge = np.flatnonzero(np.diff(group)) + 1
    starts, ends = np.concatenate([[0], edge]), np.concatenate([edge, [len(group)]])
    number = np.repeat(np.arange(len(starts)), ends - starts)
    asks, size_of = keys & 1 == 1, ends - starts
    for place in np.flatnonzero((size_of > LARGE) & (np.bincount(number, asks, len(starts)) > 0)):
        a, b = _spread(prints[starts[place] : ends[place]], bits)
        if len(a):
            yield a + starts[place], b + starts[place]
    asking = np.flatnonzero(asks & ((size_of > 1) & (size_of <= LARGE))[number])
    sizes = size_of[number[asking]]
    done = 0
    while done < len(asking):
        upto = max(done + 1, int(np.searchsorted(np.cumsum(sizes[done:]), PAIRS)) + done)
        part, size = asking[done:upto], sizes[done:upto]
        ask = np.repeat(part, size)
        met = np.arange(len(ask)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(starts[number[part]], size)
        near = (_differing(prints[ask], prints[met]) <= bits) & (ask != met)
        if near.any():
            yield ask[near], met[near]
        done = upto


def _links(prints: DataFrame, columns: list[str], bits: int) -> DataFrame:
    """Spanning forests of linked rows: ``a_<column>`` and ``b_<column>`` for each fingerprint column.

    Rows are filed under the keys of the first column and ask under the one to which they decode."""
    width = len(columns)
    names = [f"{side}_{c}" for side in "ab" for c in columns]

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            for start in range(0, batch.num_rows, 20_000):
                part = [c[start : start + 20_000] for c in every]
                keys, rows, asks = fingerprint_keys(part[0].view(np.uint64))
                keys = keys << 1 | asks
                yield pa.RecordBatch.from_arrays([pa.array(keys), *(pa.array(c[rows]) for c in part)], names=["key", *columns])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest_k, rest_p = np.empty(0, np.int64), np.empty((0, width), np.uint64)
        held: list[np.ndarray] = []

        def forest(pairs: np.ndarray) -> np.ndarray:
            """Star edges of the components of pairs of fingerprints, (pairs, 2 * width)."""
            nodes, place = np.unique(
                np.concatenate([pairs[:, :width], pairs[:, width:]]), axis=0, return_inverse=True
            )
            place = place.ravel()
            node, root = _forest(place[: len(pairs)], place[len(pairs) :])
            return np.concatenate([nodes[node], nodes[root]], axis=1)

        def emit() -> pa.RecordBatch:
            pairs = forest(np.concatenate(held)) if held else np.empty((0, 2 * width), np.uint64)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.ascontiguousarray(c).view(np.int64)) for c in pairs.T], names=names
            )

        def take(keys: np.ndarray, prints_: np.ndarray) -> None:
            for a, b in _verified(keys, prints_, bits):
                node, root = _forest(a, b)
                pairs = np.concatenate([prints_[node], prints_[root]], axis=1)
                held.append(pairs[(pairs[:, :width] != pairs[:, width:]).any(axis=1)])

        for batch in batches:
            fresh = np.stack([c.to_numpy().view(np.uint64) for c in batch.columns[1:]], axis=1)
            keys = np.concatenate([rest_k, batch.column(0).to_numpy()])
            prints_ = np.concatenate([rest_p, fresh])
            last = int(np.searchsorted(keys >> 1, keys[-1] >> 1)) if len(keys) else 0
            rest_k, rest_p = keys[last:], prints_[last:]
            if last:
                take(keys[:last], prints_[:last])
            if sum(map(len, held)) > 1_000_000:
                yield emit()
                held.clear()
        if len(rest_k):
            take(rest_k, rest_p)
        yield emit()

    listed = ", ".join(f"{c} bigint" for c in columns)
    # a fingerprint becomes some eighty rows: few tasks of small rows would file them all
    dealt = prints.select(*columns).repartition(partitions(prints.sparkSession))
    filed = dealt.mapInArrow(file, f"key bigint, {listed}")
    met = filed.repartition(F.shiftright("key", 1)).sortWithinPartitions("key")
    return met.mapInArrow(meet, ", ".join(f"{n} bigint" for n in names))


def links(prints: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """``(a, b)``: edges that connect exactly those distinct fingerprints which chains of at most
    ``bits`` differing bits connect.  ``prints`` has one row per distinct ``fingerprint``."""
    if not 0 <= bits <= MAX_BITS:
        raise ValueError(f"two-segment Golay keys are exact up to {MAX_BITS} differing bits, not {bits}")
    return _links(prints, ["fingerprint"], bits).toDF("a", "b")


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, bits: int = MAX_BITS
) -> DataFrame:
    """``(id_col, fingerprint bigint, component_id)``: the least id reachable by links of at most
    ``bits`` differing bits.

    Null and empty texts have fingerprint zero and link like any other.  Equal fingerprints meet
    once: links are searched between distinct fingerprints, so a group of copies costs one row.
    Repeated rows stay repeated.  Null ids are never a ``component_id`` unless the component has
    no other.  An empty table gives an empty result; other columns are ignored."""
    printed = stored(fingerprints(df, id_col, text_col, words), "fingerprints")
    distinct = printed.groupBy("fingerprint").agg(F.min(id_col).alias("least"))
    roots = connected_components(links(distinct, bits), "a", "b")
    named = distinct.join(roots, distinct.fingerprint == roots.node, "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
    )
    tops = named.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = named.join(tops, "root").select("fingerprint", "component_id")
    return printed.join(classes, "fingerprint").select(id_col, "fingerprint", "component_id")
