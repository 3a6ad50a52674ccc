"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased, everything but letters becomes a space, and runs of one to three characters
are hashed into ``BUCKETS`` counters.  Training adds counters per language inside every task and
sums them across tasks; the driver holds languages x buckets numbers, whatever the corpus.  The
matrix of log probabilities is broadcast; a batch of texts is scored as a sparse matrix (hashes per
text) times that matrix, in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import map_rows, slices

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
UNKNOWN = "und"
#: Languages whose counters one task holds before it hands them on.
HELD = 64
_FACTORS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Each code point itself if it is a letter, else a space."""
    points = np.arange(0x110000, dtype=np.uint32)
    letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
    return np.where(letter, points, 32).astype(np.uint32)


def hashed(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(grams, edges, letters): hashed n-grams of all texts as one row per order, the first place
    of each text (and the end), and the number of letters of each text.

    Bucket ``BUCKETS`` stands for grams that would reach into the next text or hold no letter."""
    lowered = [(t or "").lower() + " " for t in texts]
    data = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    edges = np.concatenate([[0], np.cumsum([len(t) for t in lowered])]).astype(np.int64)
    chars = _letters()[np.minimum(data, 0x10FFFF)]
    word = chars != 32
    grams = np.full((len(ORDERS), len(chars)), BUCKETS, dtype=np.int32)
    for row, order in enumerate(ORDERS):
        n = len(chars) - order + 1
        if n <= 0:
            continue
        value = np.full(n, order * 0x27D4EB2F % (1 << 32), dtype=np.uint32)
        any_letter = np.zeros(n, dtype=bool)
        for i in range(order):
            value = (value ^ chars[i : i + n]) * np.uint32(_FACTORS[i])
            value ^= value >> np.uint32(15)
            any_letter |= word[i : i + n]
        grams[row, :n] = np.where(any_letter, (value >> np.uint32(7)) % BUCKETS, BUCKETS)
        for back in range(1, order):
            grams[row, edges[1:] - back] = BUCKETS
    letters = np.add.reduceat(word, edges[:-1]).astype(np.int64) if len(texts) else np.empty(0, np.int64)
    return grams, edges, letters


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, np.ndarray] = {}

    def emit() -> pa.RecordBatch:
        names, buckets, counts = [], [], []
        for name, counter in held.items():
            full = np.flatnonzero(counter)
            names += [name] * len(full)
            buckets.append(full)
            counts.append(counter[full])
        held.clear()
        empty = [np.empty(0, np.int64)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(names, pa.string()),
                pa.array(np.concatenate(buckets or empty).astype(np.int32)),
                pa.array(np.concatenate(counts or empty)),
            ],
            names=["lang", "bucket", "n"],
        )

    for batch in slices(batches, "text"):
        grams, edges, _ = hashed(batch.column("text").to_pylist())
        langs = np.array(batch.column("lang").to_pylist(), dtype=object)
        for name in sorted(set(langs)):
            mine = np.repeat(langs == name, np.diff(edges))
            counter = held.setdefault(name, np.zeros(BUCKETS, np.int64))
            counter += np.bincount(grams[:, mine].ravel(), minlength=BUCKETS + 1)[:BUCKETS]
            if len(held) >= HELD:
                yield emit()
    yield emit()


@dataclass
class LanguageModel:
    languages: list[str]
    #: Log probabilities, buckets x languages, with a last row of zeros for void grams.
    weights: np.ndarray
    prior: np.ndarray
    #: Mean and deviation of the log probability of one gram of a language's own texts.
    usual: np.ndarray
    spread: np.ndarray


def train(df: DataFrame, text_col: str = "text", lang_col: str = "lang", smoothing: float = 0.5) -> LanguageModel:
    """A model of all rows with a text and a language; rows with a null in either are passed over.

    Without any row the model knows no language and answers ``und``."""
    rows = df.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang")).dropna()
    sums = rows.mapInArrow(_count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(
        F.sum("n").alias("n")
    )
    cells = sums.toPandas()
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    counts = np.zeros((BUCKETS, len(languages)))
    at = {name: i for i, name in enumerate(languages)}
    counts[cells["bucket"].to_numpy(dtype=np.int64), [at[name] for name in cells["lang"]]] = cells["n"]
    weights = np.zeros((BUCKETS + 1, len(languages)), dtype=np.float32)
    total = counts.sum(axis=0) + smoothing * BUCKETS
    weights[:BUCKETS] = np.log((counts + smoothing) / total)
    prior = np.log(np.array([sizes[name] for name in languages], dtype=float) / max(1, sum(sizes.values())))
    shares = counts / np.maximum(counts.sum(axis=0), 1)
    usual = (shares * weights[:BUCKETS]).sum(axis=0)
    spread = np.sqrt(np.maximum((shares * weights[:BUCKETS] ** 2).sum(axis=0) - usual**2, 1e-12))
    return LanguageModel(languages, weights, prior, usual, spread)


def score(texts: list[str | None], model: LanguageModel) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Likeliest language of each text, its posterior, and how its grams fit that language; ties go to
    the first name.

    The posterior only weighs the known languages against each other.  The fit does not: it is the mean
    log probability of the text's grams, in deviations of one gram from the language's own mean, so it
    does not depend on length and is low for what is in none of the languages."""
    grams, edges, letters = hashed(texts)
    if not model.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
    logs = np.zeros((len(texts), len(model.languages)))
    held = np.zeros(len(texts), np.int64)
    for row in grams:
        logs += np.add.reduceat(model.weights[row], edges[:-1], axis=0, dtype=np.float64)
        held += np.add.reduceat(row < BUCKETS, edges[:-1], dtype=np.int64)
    known = letters > 0
    best = (logs + model.prior).argmax(axis=1)
    mean = logs[np.arange(len(texts)), best] / np.maximum(held, 1)
    logs += model.prior
    share = 1.0 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
    fit = (mean - model.usual[best]) / model.spread[best]
    names = [model.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
    return names, np.where(known, share, 0.0), np.where(known, fit, 0.0)


def predict(df: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``df`` with ``lang_pred``, ``lang_score`` (0 to 1) and ``lang_fit`` (0: as the language's own
    texts, below: less so); columns of these names are replaced, others stay.

    A text that is null or has no letter is ``und`` with score and fit 0; a very long text is scored
    whole; rows that repeat are scored alike; an empty table gives an empty one."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    found = {"lang_pred": "string", "lang_score": "double", "lang_fit": "double"}
    names = [c for c in df.columns if c not in found]
    rows = df.select(*(F.col(f"`{c}`") for c in names))
    place = names.index(text_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lang, share, fit = score(batch.column(place).to_pylist(), shared.value)
        made = [pa.array(lang, pa.string()), pa.array(share), pa.array(fit)]
        return pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*names, *found])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema] + [f"{c} {k}" for c, k in found.items()])
    return map_rows(rows, run, schema, text_col)
