"""Source divergence against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from tests.llm.conftest import DOCUMENT
from vitrine.llm import divergence

WORD = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least_docs, top):
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        words = [w.translate(FOLD) for w in WORD.findall(text or "")]
        counts[lang or "", source or ""].update(words)
        docs[lang or ""].update(set(words))
    out = []

    def rates(found, kept):
        total = sum(found[w] for w in kept) + 5 * len(kept)
        return {w: 1 + 10**9 * (found[w] + 5) // total for w in kept}

    for lang in {g[0] for g in counts}:
        kept = [w for w, n in docs[lang].items() if n >= least_docs]
        whole = rates(sum((c for g, c in counts.items() if g[0] == lang), Counter()), kept)
        mine = {g[1]: rates(c, kept) for g, c in counts.items() if g[0] == lang}
        for source, p in mine.items():
            pairs = [(sum(abs(p[w] - q[w]) for w in kept), item) for item, q in mine.items() if item != source]
            terms = [(p[w] - whole[w], w) for w in kept if counts[lang, source][w] and p[w] > whole[w]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda f: (-f[0], f[1].encode()))
                out += [(lang, source, part, item, value, rank + 1) for rank, (value, item) in enumerate(found[:most])]
    return out


def _rows(seed, n):
    rng = random.Random(seed)
    pool = ["a", "ab", "abcdefgh", "abcdefghi", "ABCDEFGHI", "abcdefghabcdefgh", "abcdefghabcdefghz", "abcdefghabcdefghabcdefghq",
            "éa", "É", "é", "日本語", "日本", "zebra", "Zebra", "x" * 40, "x" * 41, "x" * 48]
    marks = [" ", "-", "1", "_", "\n", "@", "[", "`", "{", "\x7f", "\x00"]
    rows = [("".join(rng.choice(pool) + rng.choice(marks) for _ in range(rng.randint(0, 30))) + rng.choice(pool),
             rng.choice(["en", "de"]), rng.choice(["s", "t", "ü", "u", None])) for _ in range(n)]
    return rows + [(None, "en", "empty"), ("", None, "x"), ("one", None, "y"), ("", "en", "s"), ("a " * 20_000 + "q" * 70_000, "de", "s")]


def test_pointers_in_order_of_their_words():
    rows = [r[0] or "" for r in _rows(1, 60)]
    data = np.frombuffer("".join(rows).encode(), np.uint8)
    edges = np.concatenate([[0], np.cumsum([len(r.encode()) for r in rows])])
    starts, sizes = divergence.word_starts(data, edges)
    found = [bytes(data[s : s + n]) for s, n in zip(starts, sizes)]
    assert found == [w.encode() for r in rows for w in WORD.findall(r)]
    order, new = divergence.sorted_words(data, starts, sizes)
    words = [found[i] for i in order]
    assert sorted(order.tolist()) == list(range(len(found)))
    assert [bool(b) for b in new] == [i == 0 or words[i] != words[i - 1] for i in range(len(words))]
    assert new.sum() == len(set(found))
    # stable: equal words stand in text order
    assert all(new[i] or order[i] > order[i - 1] for i in range(1, len(order)))


def test_divergences_match_brute_force(spark):
    rows = _rows(2, 400)
    frame = spark.createDataFrame([(*r, 1) for r in rows], "text string, lang string, source string, term int").repartition(4)
    for least, top in ((1, 5), (30, 50)):
        found = divergence.divergences(frame, least_docs=least, top=top).collect()
        assert sorted(map(tuple, found)) == sorted(plain(rows, least, top))


def test_slices_and_blocks_do_not_show(spark, monkeypatch):
    monkeypatch.setattr(divergence, "SLICE_BYTES", 300)
    monkeypatch.setattr(divergence, "BLOCK_RATES", 9)
    rows = _rows(3, 120)
    frame = spark.createDataFrame(rows, "text string, lang string, source string")
    found = divergence.divergences(frame, least_docs=2, top=4).collect()
    assert sorted(map(tuple, found)) == sorted(plain(rows, 2, 4))


def test_rates_are_exact_beyond_64_bits(spark):
    rows = [(9_223_372_036_854_775, 9_223_372_036_854_775_000, 7), (0, 10**17 + 1, 3), (0, 0, 0)]
    frame = spark.createDataFrame(rows, "n bigint, total bigint, kept bigint")
    found = [r[0] for r in frame.select(divergence._rate("n", "total", "kept")).collect()]
    assert found == [1 + 10**9 * (n + 5) // (t + 5 * k) if t + 5 * k else None for n, t, k in rows]


def test_edge_tables(spark, edge_rows, no_documents):
    names = DOCUMENT.replace("doc_id", "n").replace("n_chars", "term")
    found = divergence.divergences(spark.createDataFrame(edge_rows, names), least_docs=2).collect()
    assert sorted(map(tuple, found)) == sorted(plain([(r[1], r[2], r[3]) for r in edge_rows], 2, 50))
    assert divergence.divergences(no_documents).count() == 0
    assert divergence.counted_slice(pa.array([], pa.large_string()), np.zeros(0, np.int64))[1].to_pylist() == []
