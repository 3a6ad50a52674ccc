"""Line dedup against brute force, on both ways to probe."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest

from tests.llm.conftest import DOCUMENT
from vitrine.llm import lines


def plain(rows, shortest=20, least=3):
    """(id, n_lines, n_dropped, kept) of every row."""
    edges, fold = " \t\n\v\f\r", str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = [(i, (t or "").split("\n")) for i, t in rows]
    keys = [[line.strip(edges).translate(fold) for line in part] for _, part in split]
    holders = defaultdict(list)
    for (i, _), mine in zip(split, keys):
        for key in {k for k in mine if len(k) >= shortest}:
            holders[key].append(-1 if i is None else i)
    out = []
    for (i, part), mine in zip(split, keys):
        number = -1 if i is None else i
        goes = [len(k) >= shortest and len(holders[k]) >= least and max(holders[k]) != number for k in mine]
        out.append((i, len(part), sum(goes), "\n".join(line for line, g in zip(part, goes) if not g)))
    return out


def _rows():
    rng = random.Random(4)
    pool = [f"common line number {n} of the pool {'É' * (n % 5)}" for n in range(40)] + ["short", "", "x" * 19, "y" * 20, "é" * 20, "É" * 20]
    edges = ["", " ", "\t", "\r", "\x0b\x0c", "\xa0"]
    rows = [(None, pool[0]), (None, None), (5, pool[0].upper()), (5, pool[0]), (5, pool[0]), (0, ""), (1, "\n\n")]
    for i in range(10, 260):
        part = [rng.choice(edges) + rng.choice([str.upper, str, str.title])(rng.choice(pool)) + rng.choice(edges) for _ in range(rng.randint(0, 8))]
        rows.append((i, "\n".join([*part, f"a line that only document {i} holds"][: rng.randint(0, 9)])))
    rows.append((300, "\n".join([pool[3]] * 5 + ["z" * 100_000] + [f"line {n} of one very long text" for n in range(5000)])))
    rows += [(301, "z" * 100_000), (302, "Z" * 100_000)]
    return rows


def test_perfect_hash_numbers_each_key_once():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 63, 1000, 40_000):
        key, check = (rng.integers(0, 1 << 63, n).astype(np.uint64) for _ in range(2))
        key[: n // 3] = key[0] if n else 0
        hash_ = lines.PerfectHash.of(key, check)
        assert sorted(hash_.numbers(key, check).tolist()) == list(range(n))
        other = hash_.numbers(key + np.uint64(1), check)
        assert ((other >= -1) & (other < max(n, 1))).all()


@pytest.mark.parametrize("sent", [lines.SENT_BYTES, -1])
def test_lines_go_as_by_brute_force(spark, sent, monkeypatch):
    monkeypatch.setattr(lines, "SHARD_KEYS", 7)
    rows = _rows()
    frame = spark.createDataFrame(rows, "doc_id int, text string").repartition(5)
    found = lines.remove_lines(frame, sent_bytes=sent, copy_probes=50).collect()
    key = lambda r: tuple((v is not None, v) for v in r)
    assert sorted((tuple(r) for r in found), key=key) == sorted(plain(rows), key=key)
    assert sum(r["n_dropped"] for r in found) > 300


@pytest.mark.parametrize("sent", [lines.SENT_BYTES, -1])
def test_edge_tables(spark, edge_rows, no_documents, sent):
    names = DOCUMENT.replace("lang", "kept").replace("source", "key").replace("n_chars", "shard")
    found = lines.remove_lines(spark.createDataFrame(edge_rows, names), least=2, sent_bytes=sent)
    assert found.columns == ["doc_id", "key", "shard", "n_lines", "n_dropped", "kept"]
    wanted = plain([(r[0], r[1]) for r in edge_rows], least=2)
    assert sorted((r["kept"], r["n_dropped"]) for r in found.collect()) == sorted((w[3], w[2]) for w in wanted)
    assert lines.remove_lines(no_documents, sent_bytes=sent).count() == 0
