"""Document quality from a linear-chain conditional random field over lines.

Every line gets the features of itself and of its neighbours; the field labels each line good or
bad, its forward-backward marginals are averaged with the lines' lengths as weights, and that is the
document's score.  Weights come from a bounded sample of labelled documents (a document's label
stands for its lines), fitted by gradient ascent on the conditional likelihood; everything else
runs on whole texts in Arrow batches.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import map_rows

#: Labelled documents per class that are fitted at most, lines of each (one stretch), and steps of the fit.
SAMPLE = 1500
SAMPLE_LINES = 1000
STEPS = 200
_LOWER, _UPPER, _DIGIT, _SPACE, _STOP, _MARK = range(6)


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """Kind of each code point: letters of either case, digits, space, sentence marks, the rest."""
    kind = np.full(0x110000, _MARK, dtype=np.uint8)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            kind[point] = _UPPER if char.isupper() else _LOWER
        elif char.isdigit():
            kind[point] = _DIGIT
        elif char.isspace():
            kind[point] = _SPACE
        elif char in ".,;:'\"-()?’“”":
            kind[point] = _STOP
    return kind


def _sums(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return total[end] - total[begin]


def _repeats(owner: np.ndarray, value: np.ndarray, owners: int) -> np.ndarray:
    """For each owner, how many of its values occurred before in it."""
    order = np.lexsort((value, owner))
    same = (owner[order][1:] == owner[order][:-1]) & (value[order][1:] == value[order][:-1])
    return np.bincount(owner[order][1:][same], minlength=owners).astype(float)


def line_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, lengths, edges): a row per line of all texts, the lines' lengths in characters,
    and the first line of each text (and the end).  An empty text is one empty line."""
    joined = "\n".join((t or "") for t in texts) + "\n"
    data = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    ends = np.flatnonzero(data == 10)
    begins = np.concatenate([[0], ends[:-1] + 1])
    last = np.cumsum([len(t or "") + 1 for t in texts]) - 1
    edges = np.concatenate([[0], np.searchsorted(ends, last) + 1])
    lines, size = len(ends), (ends - begins).astype(float)
    kind = _kinds()[np.minimum(data, 0x10FFFF)]
    share = [_sums(kind == k, begins, ends) / np.maximum(size, 1) for k in range(6)]
    # words: runs of anything but white space
    inner = kind != _SPACE
    flips = np.flatnonzero(np.diff(np.concatenate([[False], inner, [False]]).astype(np.int8)))
    start, stop = flips[::2], flips[1::2]
    line = np.searchsorted(ends, start)
    words = np.bincount(line, minlength=lines).astype(float)
    some = np.maximum(words, 1)
    mixed = data.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019)
    mixed ^= mixed >> np.uint64(29)
    place = np.arange(len(data), dtype=np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
    turned = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed * place, dtype=np.uint64)])
    # the first character counts once, the second twice, and so on
    one = np.uint64(1)
    word = turned[stop] - turned[start] - (sums[stop] - sums[start]) * (start.astype(np.uint64) - one)
    whole = turned[ends] - turned[begins] - (sums[ends] - sums[begins]) * (begins.astype(np.uint64) - one)
    next_same = np.zeros(len(word), dtype=bool)
    next_same[1:] = (word[1:] == word[:-1]) & (line[1:] == line[:-1])
    loud = _sums(kind == _UPPER, start, stop) >= np.maximum(2, 0.6 * (stop - start))
    odd_end = kind[np.maximum(stop - 1, 0)] == _MARK
    document = np.repeat(np.arange(len(texts)), np.diff(edges))
    fresh = _repeats(document, whole, len(texts)) / np.maximum(1, np.diff(edges))
    word_document = document[line]
    in_document = np.bincount(word_document, minlength=len(texts))
    again = _repeats(word_document, word, len(texts)) / np.maximum(1, in_document)
    empty = size == 0
    own = np.stack(
        [
            np.log1p(size),
            np.log1p(words),
            *share,
            np.log1p(size / some),
            _repeats(line, word, lines) / some,
            np.bincount(line[next_same], minlength=lines) / some,
            np.bincount(line[loud], minlength=lines) / some,
            np.bincount(line[odd_end], minlength=lines) / some,
            (kind[np.maximum(ends - 1, 0)] == _STOP) & ~empty,
            (kind[begins] == _UPPER) & ~empty,
            empty,
            fresh[document],
            again[document],
            np.log1p(in_document)[document],
            again[document] * np.log1p(in_document)[document],
        ],
        axis=1,
    ).astype(np.float64)
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    first, final = np.zeros(lines, bool), np.zeros(lines, bool)
    first[edges[:-1]], final[edges[1:] - 1] = True, True
    before[first], after[final] = own[first], own[final]
    both = np.concatenate([own, before, after, first[:, None], final[:, None]], axis=1)
    return both, size, edges


@dataclass
class LineField:
    """Emission weights of the label "good" against "bad", and log transition weights."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    steps: np.ndarray
    #: Log odds added to the document's score: undoes the balanced sample.
    shift: float

    def emissions(self, features: np.ndarray) -> np.ndarray:
        good = ((features - self.mean) / self.scale) @ self.weights[:-1] + self.weights[-1]
        return np.stack([np.zeros_like(good), good], axis=1)


def marginals(emit: np.ndarray, edges: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over all sequences at once: (P(good) of each line, expected transitions,
    log partition function of each sequence)."""
    begin, count = edges[:-1], np.diff(edges)
    order = np.argsort(-count, kind="stable")
    begin, count = begin[order], count[order]
    ahead, back = np.empty_like(emit), np.zeros_like(emit)
    ahead[begin] = emit[begin]
    alive = [int(np.searchsorted(-count, -t, side="left")) for t in range(int(count.max(initial=0)) + 1)]
    for t in range(1, len(alive) - 1):
        at = begin[: alive[t]] + t
        near = ahead[at - 1][:, :, None] + steps
        ahead[at] = np.logaddexp(near[:, 0], near[:, 1]) + emit[at]
    for t in range(len(alive) - 2, 0, -1):
        at = begin[: alive[t]] + t
        near = (back[at] + emit[at])[:, None, :] + steps
        back[at - 1] = np.logaddexp(near[:, :, 0], near[:, :, 1])
    last = edges[1:] - 1
    z = np.logaddexp(ahead[last, 0], ahead[last, 1])
    line_z = np.repeat(z, np.diff(edges))
    good = np.exp(ahead[:, 1] + back[:, 1] - line_z)
    inner = np.ones(len(emit), bool)
    inner[edges[:-1]] = False
    at = np.flatnonzero(inner)
    pair = ahead[at - 1][:, :, None] + steps + (back[at] + emit[at])[:, None, :] - line_z[at][:, None, None]
    return good, np.exp(pair), z


def fit(raw: np.ndarray, edges: np.ndarray, labels: np.ndarray, share_good: float, steps: int = STEPS) -> LineField:
    """Maximum conditional likelihood with a quadratic penalty, by Adam; fixed order, no randomness.

    ``raw`` and ``edges`` are the line features of the documents that ``labels`` label.  Every
    document weighs one, however many lines it has.  A single class gives a constant."""
    mean, scale = raw.mean(axis=0), raw.std(axis=0)
    scale[scale < 1e-9] = 1.0
    x = np.concatenate([(raw - mean) / scale, np.ones((len(raw), 1))], axis=1)
    count = np.diff(edges)
    gold = np.repeat(labels, count).astype(float)
    weight = np.repeat(1.0 / count, count) / len(labels)
    pair_weight = weight[np.setdiff1d(np.arange(len(raw)), edges[:-1])]
    pair_gold = np.zeros((2, 2))
    inner = np.setdiff1d(np.arange(len(raw)), edges[:-1])
    for label in (0, 1):
        pair_gold[label, label] = pair_weight[gold[inner] == label].sum()
    state = np.zeros(x.shape[1] + 4)
    first, second = np.zeros_like(state), np.zeros_like(state)
    for step in range(1, steps + 1):
        good_emit = x @ state[:-4]
        emit = np.stack([np.zeros_like(good_emit), good_emit], axis=1)
        good, pairs, _ = marginals(emit, edges, state[-4:].reshape(2, 2))
        slope = np.concatenate(
            [
                x.T @ (weight * (gold - good)),
                (pair_gold - np.einsum("n,nij->ij", pair_weight, pairs)).ravel(),
            ]
        ) - 1e-4 * state
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope * slope
        state = state + 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    sampled = np.clip(labels.mean() if len(labels) else 0.5, 1e-3, 1 - 1e-3)
    wanted = np.clip(share_good, 1e-3, 1 - 1e-3)
    shift = np.log(wanted / (1 - wanted)) - np.log(sampled / (1 - sampled))
    return LineField(mean, scale, state[:-4], state[-4:].reshape(2, 2), float(shift))


def score(texts: list[str | None], field: LineField) -> np.ndarray:
    """Length-weighted mean of the lines' P(good), moved by the field's shift in log odds."""
    raw, size, edges = line_features(texts)
    good, _, _ = marginals(field.emissions(raw), edges, field.steps)
    weight = np.maximum(size, 1.0)
    mean = np.add.reduceat(weight * good, edges[:-1]) / np.add.reduceat(weight, edges[:-1])
    mean = np.clip(mean, 1e-6, 1 - 1e-6)
    return 1.0 / (1.0 + np.exp(-(np.log(mean / (1 - mean)) + field.shift)))


def train(
    documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", sample: int = SAMPLE, sample_lines: int = SAMPLE_LINES,
) -> LineField:
    """A field fitted to at most ``sample`` documents of each class, those with the least hash of
    their id, and of a longer one to ``sample_lines`` lines from a place that its size picks; class
    shares are counted over all labels.  Null labels and ids are passed over.

    Without labels every score is one half before the shift."""
    known = labels.select(id_col, label_col).dropna().groupBy(id_col).agg(F.min(label_col).alias("label"))
    shares = {r["label"]: r["count"] for r in known.groupBy("label").count().collect() if r["label"] in (0, 1)}
    picked = None
    for value in (0, 1):
        some = known.where(F.col("label") == value).orderBy(F.xxhash64(id_col), id_col).limit(sample)
        picked = some if picked is None else picked.union(some)
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(
        F.broadcast(picked.withColumnRenamed(id_col, "id")), "id"
    )

    def features(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw, _, edges = line_features(batch.column("text").to_pylist())
        parts = []
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            begin = a + (b - a) * 7919 % max(1, b - a - sample_lines + 1) if b - a > sample_lines else a
            parts.append(raw[begin : min(b, begin + sample_lines)].astype(np.float32).tobytes())
        return pa.RecordBatch.from_arrays(
            [batch.column("id").cast(pa.string()), batch.column("label").cast(pa.int32()), pa.array(parts, pa.binary())],
            names=["id", "label", "lines"],
        )

    found = map_rows(rows.select("id", "label", "text"), features, "id string, label int, lines binary", "text")
    kept = {r["id"]: r for r in sorted(found.collect(), key=lambda r: (r["id"], bytes(r["lines"])))}
    width = line_features([""])[0].shape[1]
    if not kept:
        return LineField(np.zeros(width), np.ones(width), np.zeros(width + 1), np.zeros((2, 2)), 0.0)
    lines = [np.frombuffer(r["lines"], np.float32).reshape(-1, width) for r in kept.values()]
    edges = np.concatenate([[0], np.cumsum([len(part) for part in lines])])
    labels = np.array([r["label"] for r in kept.values()])
    return fit(np.concatenate(lines).astype(float), edges, labels, shares.get(1, 0) / sum(shares.values()))


def predict(df: DataFrame, field: LineField, text_col: str = "text") -> DataFrame:
    """``df`` with ``quality_score`` (0 to 1, higher is better); such a column in ``df`` is replaced, and
    the others stay, whatever their names.

    Null and empty texts are one empty line and score like it; a very long text is scored whole; rows
    that repeat score alike; an empty table gives an empty one."""
    shared = df.sparkSession.sparkContext.broadcast(field)
    names = [c for c in df.columns if c != "quality_score"]
    rows = df.select(*(F.col(f"`{c}`") for c in names))
    place = names.index(text_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = score(batch.column(place).to_pylist(), shared.value)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=[*names, "quality_score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return map_rows(rows, run, f"{schema}, quality_score double", text_col)
