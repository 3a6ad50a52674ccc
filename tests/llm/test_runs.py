"""Periodic runs against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np

from vitrine.llm import runs
from vitrine.llm.queries import op12_runs_ntt


def plain_runs(words, least=6, powers=4):
    """Every run by trying all periods and all starts."""
    n, found = len(words), {}
    for q in range(1, n // powers + 1):
        start = 0
        while start + q < n:
            end = start
            while end + q < n and words[end] == words[end + q]:
                end += 1
            if end + q - start >= max(least, powers * q):
                found.setdefault((start, end + q), q)
            start = max(end, start) + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def plain_collapse(words, found):
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_transform_is_exact_convolution():
    rng = np.random.default_rng(3)
    for size in (4, 8, 64, 1024):
        x, y = rng.integers(0, runs.PRIME, (2, 3, size)).astype(np.uint64)
        product = runs.restored(runs.transform(x) * runs.transform(y) % np.uint64(runs.PRIME))
        for row in range(3):
            a, b = x[row].tolist(), y[row].tolist()
            at = size // 3
            assert int(product[row, at]) == sum(a[i] * b[(at - i) % size] for i in range(size)) % runs.PRIME
        assert (runs.restored(runs.transform(x)) == x).all()


def test_matching_distances_are_those_of_the_words():
    rng = random.Random(1)
    for scale in (1, 2, 4, 8):
        words = np.array([rng.randint(1, 2) for _ in range(40)] + [5, 6, 7] * 20, np.int64)
        codes = np.zeros(len(words) + 4 * scale, np.uint64)
        codes[: len(words)] = words
        squares = np.concatenate([[0], np.cumsum(codes * codes)]).astype(np.uint64)
        starts = np.arange(0, len(words) - 2 * scale + 1, scale)
        wanted = []
        for s in starts:
            same = [d for d in range(scale, 2 * scale) if (codes[s : s + 2 * scale] == codes[s + d : s + d + 2 * scale]).all()]
            wanted += [(s, d) for d in same if len(same) == 1]
        blocks, distances = runs.matching_distances(codes, squares, starts, scale)
        assert list(zip(blocks.tolist(), distances.tolist())) == wanted


def _texts():
    rng = random.Random(8)
    texts = [None, "", " \t\n", "a", "a " * 5, "a " * 6, "x" + " a" * 3000, "ab ab cd " * 40, "a b a b a b a b", "a b a b a b a"]
    for _ in range(250):
        words = [rng.choice("abc"[: rng.randint(1, 3)]) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            unit = [rng.choice("abcd") for _ in range(rng.randint(1, 20))]
            words += (unit * 9)[: rng.randint(0, 9 * len(unit))] + [rng.choice("abe")]
        texts.append(rng.choice([" ", "  ", "\t", "\x0b\r"]).join(words))
    unit = [str(rng.random()) for _ in range(257)]
    texts.append(" ".join(unit * 5 + ["end"] + unit[:40] * 4))
    return texts


def test_runs_match_brute_force(spark, no_documents):
    texts = _texts()
    frame = spark.createDataFrame([(i, t, "x", i) for i, t in enumerate(texts)], "doc_id int, text string, runs string, `a b` int")
    rows = runs.periodic_runs(frame.repartition(3)).collect()
    assert len(rows) == len(texts) and rows[0].asDict().keys() == {"doc_id", "a b", "n_words", "runs", "collapsed"}
    for row in rows:
        words = re.findall("[^\x20\x09-\x0d]+", texts[row["doc_id"]] or "")
        wanted = plain_runs(words)
        assert [tuple(r) for r in row["runs"]] == wanted
        assert (row["n_words"], row["collapsed"]) == (len(words), plain_collapse(words, wanted))
    assert sum(len(r["runs"]) for r in rows) > 300
    assert runs.periodic_runs(no_documents).count() == 0


def test_very_long_runs_take_linear_work():
    words = np.array([1] * 200_000 + [0] + list(range(2, 1002)) * 60 + [-1], np.int64)
    assert runs.runs_of(words, 200_000).tolist() == [[0, 200_000, 1], [200_001, 60_000, 1000]]


def test_query_plants_periods_and_digests_runs(spark, tmp_path):
    texts = _texts()[:120] + [" ".join(f"w{i * 7 % 31}" for i in range(90))] * 40
    spark.createDataFrame(
        [(i, t) for i, t in enumerate(texts)] + [(None, "b " * 9)], "doc_id bigint, text string"
    ).write.parquet(str(tmp_path / "documents.parquet"))
    rows = op12_runs_ntt(spark, str(tmp_path)).collect()
    assert len(rows) == len(texts) + 1
    planted = 0
    for row in rows:
        doc_id = row["doc_id"]
        words = re.findall("[^\x20\x09-\x0d]+", ("b " * 9 if doc_id is None else texts[doc_id]) or "")
        h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            planted += 1
        found = plain_runs(words)
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        milli = best[1] * 1000 // best[2] if found else None
        assert (row["n_runs"], row["start"], row["length"], row["period"], row["exponent_milli"]) == (len(found), *best, milli)
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
        assert row["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(plain_collapse(words, found).encode()).hexdigest()
    assert planted > 3
