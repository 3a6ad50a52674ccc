"""Periodic runs of words, found by block convolution at dyadic scales.

A run is a stretch of words with smallest period q and at least ``max(least, 4 * q)`` words that
no neighbouring word extends.  At the scale B = 1, 2, 4, ... all periods from B to 2 B - 1 are
looked for: a run of such a period holds a block of 2 B words, starting at a multiple of B, that
occurs again q words later.  For every block the sums of squared differences to the text at all
distances from B to 2 B - 1 come from one product of number-theoretic transforms, which is exact
integer arithmetic modulo a prime; a distance without mismatch seeds an extension to both sides,
which compares the words themselves.

Two facts keep the work in proportion to the text.  A block can only occur again at such a distance
if each of its words does, so blocks with a word that does not come again within 2 B - 1 words are
passed over.  And a block that occurs again at two distances lies in a run of a period that divides
both (Fine and Wilf), which a smaller scale has found; so a block seeds one extension at most.

The texts of a batch are laid end to end with a separator that equals nothing; a block and its
shifted copy leave no gap, so neither can reach across a separator.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import map_rows

# A prime of the form 15 * 2**27 + 1 and a generator of its units.
PRIME, GENERATOR = 2013265921, 31
#: Numbers that one transform works on at a time, unless a single block needs more.
TRANSFORM = 1 << 18
#: Bytes of text that are searched together.
BATCH_BYTES = 2 << 20
NEVER = np.iinfo(np.int64).max


@lru_cache(maxsize=64)
def _roots(half: int, inverse: bool) -> np.ndarray:
    """The first ``half`` powers of a root of unity of order ``2 * half`` modulo the prime."""
    root = pow(GENERATOR, (PRIME - 1) // (2 * half), PRIME)
    if inverse:
        root = pow(root, PRIME - 2, PRIME)
    powers = np.ones(half, np.uint64)
    done, step = 1, root
    while done < half:
        powers[done : 2 * done] = powers[:done] * np.uint64(step) % np.uint64(PRIME)
        done, step = 2 * done, step * step % PRIME
    return powers


def _less(x: np.ndarray) -> np.ndarray:
    """Numbers below twice the prime, reduced."""
    return np.minimum(x, x - np.uint64(PRIME))


def transform(x: np.ndarray) -> np.ndarray:
    """Number-theoretic transform of each row (a power of two long), in bit-reversed order."""
    rows, size = x.shape
    x, half, prime = x.copy(), size // 2, np.uint64(PRIME)
    while half:
        pairs = x.reshape(rows, -1, 2, half)
        low, high = pairs[:, :, 0], pairs[:, :, 1]
        x = np.stack([_less(low + high), (low + prime - high) * _roots(half, False) % prime], axis=2)
        half //= 2
    return x.reshape(rows, size)


def restored(x: np.ndarray) -> np.ndarray:
    """The inverse of ``transform``."""
    rows, size = x.shape
    half, prime = 1, np.uint64(PRIME)
    while half < size:
        pairs = x.reshape(rows, -1, 2, half)
        low, high = pairs[:, :, 0], pairs[:, :, 1] * _roots(half, True) % prime
        x = np.stack([_less(low + high), _less(low + prime - high)], axis=2)
        half *= 2
    return x.reshape(rows, size) * np.uint64(pow(size, PRIME - 2, PRIME)) % prime


def matching_distances(
    codes: np.ndarray, squares: np.ndarray, starts: np.ndarray, scale: int
) -> tuple[np.ndarray, np.ndarray]:
    """Blocks of ``2 * scale`` codes (starts) and distances from ``scale`` to ``2 * scale - 1`` at
    which the sum of squared differences is 0 modulo the prime, without blocks that occur again at
    two distances; a multiple of the prime may be among them, so the words are to be compared.

    ``codes`` are below the prime and go on for ``4 * scale`` zeros; ``squares`` are running sums."""
    size, prime = 4 * scale, np.uint64(PRIME)
    inside, across = np.arange(2 * scale), np.arange(3 * scale - 1)
    step = max(1, TRANSFORM // size)
    blocks, distances = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for first in range(0, len(starts), step):
        begin = starts[first : first + step, None]
        block, window = np.zeros((2, len(begin), size), np.uint64)
        # correlation: the block runs backwards through the window that starts ``scale`` words on
        block[:, -inside] = codes[begin + inside]
        window[:, : 3 * scale - 1] = codes[begin + scale + across]
        products = restored(transform(block) * transform(window) % prime)[:, :scale]
        own = squares[begin + 2 * scale] - squares[begin]
        at = begin + scale + np.arange(scale)
        theirs = squares[at + 2 * scale] - squares[at]
        equal = (own + theirs) % prime == 2 * products % prime
        several = np.flatnonzero(equal.sum(axis=1) > 1)
        if len(several):
            twice = np.ones(len(several), bool)
            here = begin[several]
            for edge in (equal[several].argmax(axis=1), scale - 1 - equal[several, ::-1].argmax(axis=1)):
                twice &= (codes[here + inside] == codes[here + scale + edge[:, None] + inside]).all(axis=1)
            equal[several[twice]] = False
        row, shift = np.nonzero(equal)
        blocks.append(begin[row, 0])
        distances.append(scale + shift)
    return np.concatenate(blocks), np.concatenate(distances)


def _stretch(words: np.ndarray, start: int, distance: int) -> tuple[int, int]:
    """The longest ``(low, high)`` around ``start`` such that words from low on equal those a
    distance further, up to before high; empty where the word at ``start`` does not."""
    high, step = start, 64
    while True:
        far = words[high + distance : high + distance + step]
        same = words[high : high + len(far)] == far
        if not same.all():
            high += int(np.argmin(same))
            break
        high += len(far)
        if len(far) < step:
            break
        step *= 2
    low, step = start, 64
    while low > 0:
        begin = max(0, low - step)
        same = words[begin:low] == words[begin + distance : low + distance]
        if not same.all():
            low -= int(np.argmin(same[::-1]))
            break
        low, step = begin, 2 * step
    return low, high


def runs_of(words: np.ndarray, longest: int, least: int = 6, powers: int = 4) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start and period.

    ``words`` are codes from 1 on, or below 1 for separators, each of which occurs once; ``longest``
    is the most words between two separators."""
    n = len(words)
    if powers < 4:
        raise ValueError("runs shorter than four periods need not hold a block of this length")
    order = np.argsort(words, kind="stable")
    ahead = np.full(n, NEVER)
    again = words[order[1:]] == words[order[:-1]]
    ahead[order[:-1][again]] = (order[1:] - order[:-1])[again]
    scales = 1
    while powers * 2 * scales <= longest:
        scales *= 2
    codes = np.zeros(n + 4 * scales, np.uint64)
    codes[:n] = np.maximum(words, 0)
    squares = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * codes, out=squares[1:])
    found: dict[tuple[int, int], int] = {}
    scale, chunk = 1, ahead
    while powers * scale <= longest:
        live = np.flatnonzero(np.maximum(chunk[:-1], chunk[1:]) < 2 * scale) * scale
        blocks, distances = matching_distances(codes, squares, live, scale)
        known: dict[int, int] = {}
        for start, distance in zip(blocks.tolist(), distances.tolist()):
            if start < known.get(distance, 0):
                continue
            low, high = _stretch(words, start, distance)
            known[distance] = high
            if high + distance - low >= max(least, powers * distance):
                found.setdefault((low, high + distance), distance)
        scale *= 2
        # an odd chunk at the end is too short for a block
        chunk = np.maximum(chunk[0 : len(chunk) // 2 * 2 : 2], chunk[1::2])
    rows = sorted((low, high - low, period) for (low, high), period in found.items())
    rows.sort(key=lambda r: (r[0], r[2]))
    return np.array(rows, np.int64).reshape(-1, 3)


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, and where each text's words begin and end among them."""
    texts = pa.array([t or "" for t in texts.to_pylist()], pa.large_string())
    for space in "\t\n\v\f\r":
        texts = pc.replace_substring(texts, space, " ")
    split = pc.split_pattern(texts, " ")
    edges = split.offsets.to_numpy()
    flat = split.flatten()
    some = pc.not_equal(flat, "")
    kept = np.concatenate([[0], np.cumsum(some.to_numpy(zero_copy_only=False))])
    return flat.filter(some), kept[edges - edges[0]]


def _searched(texts: pa.Array, least: int, powers: int) -> list[pa.Array]:
    words, edges = _words(texts)
    count, rows = np.diff(edges), len(edges) - 1
    codes = words.dictionary_encode().indices.to_numpy().astype(np.int64) + 1
    # one separator behind each text
    row = np.repeat(np.arange(rows), count)
    laid = np.empty(len(codes) + rows, np.int64)
    laid[np.arange(len(codes)) + row] = codes
    laid[edges[1:] + np.arange(rows)] = -np.arange(rows)
    runs = runs_of(laid, int(count.max(initial=0)), least, powers)
    firsts = edges[:-1] + np.arange(rows)
    owner = np.searchsorted(firsts, runs[:, 0], side="right") - 1
    marks = np.zeros(len(laid) + 1, np.int64)
    np.add.at(marks, runs[:, 0] + runs[:, 2], 1)
    np.add.at(marks, runs[:, 0] + runs[:, 1], -1)
    stay = np.cumsum(marks)[np.arange(len(codes)) + row] == 0
    left = np.concatenate([[0], np.cumsum(stay)])[edges]
    lists = pa.LargeListArray.from_arrays(pa.array(left, pa.int64()), words.filter(pa.array(stay)))
    each = pa.StructArray.from_arrays(
        [pa.array(runs[:, 0] - firsts[owner]), pa.array(runs[:, 1]), pa.array(runs[:, 2])],
        names=["start", "length", "period"],
    )
    begins = np.searchsorted(owner, np.arange(rows + 1)).astype(np.int32)
    return [
        pa.array(count),
        pa.ListArray.from_arrays(pa.array(begins), each),
        pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string()),
    ]


def periodic_runs(
    df: DataFrame,
    text_col: str = "text",
    least: int = 6,
    powers: int = 4,
    words_col: str = "n_words",
    runs_col: str = "runs",
    collapsed_col: str = "collapsed",
) -> DataFrame:
    """``df`` without ``text_col``, with the number of words of each whole text, its runs (array of
    start, length, period; by start, then period) and the text without the repeats.

    Words are what stands between the characters U+0020 and U+0009 to U+000D.  A run is a stretch
    of words with smallest period q and length at least ``max(least, powers * q)`` that no
    neighbouring word extends; ``powers`` is 4 or more.  A word that a run holds behind its first q
    words is left out of ``collapsed_col``, where the others are joined by one space.

    Null, empty and blank texts have no word, no run and ''; a very long text is searched whole, one
    word repeated any number of times is one run; rows that repeat get equal results; an empty table
    gives an empty one.  Other columns stay, whatever their names; those named as the new ones are
    replaced."""
    targets = {
        words_col: "bigint",
        runs_col: "array<struct<start: bigint, length: bigint, period: bigint>>",
        collapsed_col: "string",
    }
    names = [c for c in df.columns if c not in targets or c == text_col]
    rows = df.select(*(F.col(f"`{c}`") for c in names))
    place = names.index(text_col)
    held = [i for i in range(len(names)) if i != place]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = _searched(batch.column(place), least, powers)
        return pa.RecordBatch.from_arrays(
            [*(batch.column(i) for i in held), *made], names=[*(names[i] for i in held), *targets]
        )

    kinds = [f"`{names[i]}` {rows.schema[names[i]].dataType.simpleString()}" for i in held]
    schema = ", ".join([*kinds, *(f"`{c}` {kind}" for c, kind in targets.items())])
    return map_rows(rows, run, schema, text_col, BATCH_BYTES)
