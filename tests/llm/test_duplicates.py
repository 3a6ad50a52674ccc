"""SimHash groups, suffix-sorted repeats and fingerprints against brute force."""

from __future__ import annotations

import random
import time
from collections import Counter

import numpy as np
import pytest

from vitrine.llm import induced, minhash, simhash, suffix_dedup
from vitrine.llm.components import connected_components

from .conftest import PROSE, numbered


def _components(prints, bits):
    prints = list(prints)
    root = {p: p for p in prints}

    def top(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if bin(a ^ b).count("1") <= bits:
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {p: top(p) for p in prints}


def test_golay_code_decodes_three_errors():
    rng = random.Random(3)
    for _ in range(300):
        data = rng.randrange(1 << 12)
        word = data << 11
        word ^= simhash._syndrome(word)
        assert simhash._syndrome(word) == 0
        for bit in rng.sample(range(23), 3):
            word ^= 1 << bit
        assert simhash.codeword_index(np.array([word]))[0] == data


def test_keys_meet_up_to_three_bits():
    rng = random.Random(4)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 3):
            b ^= 1 << bit
        keys, rows, asks = simhash.fingerprint_keys(np.array([a, b], dtype=np.uint64))
        filed = set(keys[rows == 0].tolist())
        assert filed & set(keys[(rows == 1) & asks].tolist())


@pytest.mark.parametrize("seed", [1, 2])
def test_links_connect_what_brute_force_connects(spark, seed):
    rng = random.Random(seed)
    prints = {rng.getrandbits(64) for _ in range(60)}
    for base in list(prints)[:20]:
        for _ in range(rng.randint(1, 12)):
            other = base
            for bit in rng.sample(range(64), rng.randint(1, 4)):
                other ^= 1 << bit
            prints.add(other)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fingerprint bigint")
    found = connected_components(simhash.links(frame, 3), "a", "b").collect()
    got = {frozenset(m) for m in _grouped((r["root"], r["node"]) for r in found)}
    want = _components([p & (1 << 64) - 1 for p in signed], 3)
    groups = _grouped((t, p - (1 << 64) if p >> 63 else p) for p, t in want.items())
    assert got == {frozenset(g) for g in groups if len(g) > 1}


def _grouped(pairs):
    out: dict = {}
    for key, member in pairs:
        out.setdefault(key, set()).add(member)
    return list(out.values())


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(40)] + [(1000, 1000 + i) for i in range(1, 200)] + [(7, 7)]
    found = connected_components(spark.createDataFrame(chain, "a bigint, b bigint"), "a", "b").collect()
    assert {r["node"]: r["root"] for r in found} == {i: 0 for i in range(41)} | {1000 + i: 1000 for i in range(200)}


def test_near_duplicates_on_edge_rows(spark, edge_documents, no_documents):
    rows = simhash.near_duplicates(edge_documents).collect()
    assert len(rows) == edge_documents.count()
    found = {r["doc_id"]: r["component_id"] for r in rows}
    assert found[1] == found[2] == 1
    assert found[3] == found[4] == found[5] == 3  # no words: fingerprint zero, linked like any other
    assert {r["fingerprint"] for r in rows if r["doc_id"] in (3, 4, 5)} == {0}
    assert simhash.near_duplicates(no_documents).count() == 0


def _brute_places(text, depth):
    data, count = text.tobytes(), Counter()
    windows = [data[i : i + depth] for i in range(len(data))]
    count.update(w for w in windows if len(w) == depth and 0 not in w)
    return [count[w] > 1 and len(w) == depth and 0 not in w for w in windows]


@pytest.mark.parametrize("seed", range(60))
def test_induced_sorting_finds_all_repeats(seed, monkeypatch):
    rng = random.Random(seed)
    parts: list[int] = []
    for _ in range(rng.randint(1, 5)):
        parts += [rng.randint(1, rng.choice([1, 2, 4])) for _ in range(rng.randint(0, 60))]
        if parts and rng.random() < 0.5:
            start = rng.randrange(len(parts))
            parts += parts[start : start + 30]
        parts.append(0)
    text = np.array(parts, dtype=np.uint8)
    depth = rng.choice([2, 3, 9, 20])
    # small blocks, queues on disk and recursion instead of the base case
    monkeypatch.setattr(induced, "BLOCK", rng.choice([3, 1 << 21]))
    found = induced.repeated(text, depth, limit=rng.choice([64, 1 << 20]), base=rng.choice([1, 3, 1 << 24]))
    assert found.tolist() == _brute_places(text, depth)


def _brute_cut(texts, length):
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        cover = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if count[d[i : i + length]] > 1:
                cover[i : i + length] = b"\1" * length
        out.append((bytes(b for b, c in zip(d, cover) if not c), sum(cover)))
    return out


def test_repeats_are_cut_like_brute_force(spark):
    rng = random.Random(8)
    passage, periodic = numbered(1, 60), "abc d" * 120
    texts = [numbered(i, 80) for i in range(10)]
    texts += [numbered(20 + i, rng.randint(0, 40)) + passage + "é" * i + numbered(40 + i, 30) for i in range(6)]
    texts += [periodic, "x" * 500, None, "", "short", texts[0], texts[0], numbered(3, 80)[:250] + "ü" + passage[:210]]
    texts += [numbered(60, 30) + passage[5:190] + numbered(61, 30) + passage[100:]]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(frame).collect()}
    assert len(rows) == len(texts)
    for i, (kept, removed) in enumerate(_brute_cut(texts, 200)):
        assert (bytes(rows[i]["kept"]), rows[i]["n_removed"]) == (kept, removed), i
        assert sum(s["b"] - s["a"] for s in rows[i]["spans"]) == removed


def test_repeats_on_edge_rows(spark, edge_documents, no_documents):
    rows = suffix_dedup.remove_repeats(edge_documents, length=64, whole_characters=True).collect()
    assert len(rows) == edge_documents.count()
    assert all(bytes(r["kept"]).decode("utf-8") is not None for r in rows)
    assert [r["n_bytes"] for r in rows if r["doc_id"] in (3, 4)] == [0, 0]
    assert suffix_dedup.remove_repeats(no_documents).count() == 0


def _jaccard(a, b):
    def shingles(t):
        w = t.split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y) if x | y else 1.0


def test_fingerprints_estimate_likeness():
    words = numbered(9, 600).split()
    errors = []
    for cut in (0, 50, 200, 400, 600):
        other = " ".join(words[:cut] + numbered(10 + cut, 600 - cut).split())
        a, b = minhash.packed([" ".join(words), other])
        errors.append(minhash.likeness([a], [b])[0] - _jaccard(" ".join(words), other))
    assert max(map(abs, errors)) < 0.1
    single = minhash.packed([numbered(i, 1) for i in range(40)])
    assert len(set(single)) == 40
    assert max(minhash.likeness([single[0]] * 39, single[1:])) < 0.2


def test_comparison_with_next_document(spark, edge_documents, no_documents):
    rows = minhash.compared(edge_documents).collect()
    assert len(rows) == edge_documents.count()
    texts = [(i, f"{i} {PROSE} {numbered(i, i)}") for i in range(1, 40)]
    frame = spark.createDataFrame(texts, "doc_id bigint, text string")
    for row in minhash.compared(frame).collect():
        text = texts[row["doc_id"] - 1][1]
        after = texts[row["doc_id"] - 2][1] if row["doc_id"] > 1 else texts[-1][1]
        third = len(text) // 3
        assert row["edited"] == text[: len(text) - third] + after[:third]
        assert row["n_chars"] == len(text)
    assert minhash.compared(no_documents).count() == 0


def test_a_phrase_with_many_surroundings_is_dealt_to_several_shards(spark, monkeypatch, tmp_path):
    """One gram that is the least of all windows around it, between texts of which some repeat."""
    rng = random.Random(12)
    letters = lambda n: "".join(rng.choices("abcdefghijklmnop", k=n))
    phrase = min((letters(32) for _ in range(3000)), key=lambda p: suffix_dedup._gram_hashes(np.frombuffer(p.encode(), np.uint8))[0])
    texts = [letters(150) + phrase + letters(150) for _ in range(120)]
    texts += [letters(20) + texts[i][40:280] + letters(20) for i in range(0, 120, 6)]
    monkeypatch.setattr(suffix_dedup, "NAME_BYTES", 6000)
    taken = str(tmp_path / "taken")
    sort_shard = suffix_dedup._sort_shard

    def watched(length):
        inner = sort_shard(length)

        def run(table):
            with open(taken, "a") as file:
                file.write(f"{sum(map(len, table.column('bytes').to_pylist()))}\n")
            return inner(table)

        return run

    monkeypatch.setattr(suffix_dedup, "_sort_shard", watched)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: (bytes(r["kept"]), r["n_removed"]) for r in suffix_dedup.remove_repeats(frame, "text", 100).collect()}
    assert [got[i] for i in range(len(texts))] == _brute_cut(texts, 100)
    # the phrase's segments alone are some 20,000 bytes
    assert max(map(int, open(taken).read().split())) < 12_000


def test_long_runs_of_one_character_take_blocks_not_steps():
    rng = random.Random(5)
    for _ in range(40):
        parts = [rng.choice("ab") * rng.choice([1, 2, 5, 9, 10, 11, 12, 30, 31]) + rng.choice(["", "x", "\0", "b\0"]) for _ in range(rng.randint(1, 8))]
        text = np.frombuffer(("".join(parts) + "\0").encode(), np.uint8)
        assert induced.repeated(text, 4).tolist() == _brute_places(text, 4)
    start = time.perf_counter()
    text = np.frombuffer(b"q" + b"a" * (4 << 20) + b"z\0" + b"a" * 250 + b"\0", np.uint8)
    mark = induced.repeated(text, 200)
    assert time.perf_counter() - start < 10
    assert mark.sum() == (4 << 20) - 199 + 51 and not mark[0]


def test_rows_that_repeat_whole_send_their_bytes_once(spark):
    rows = [(1, PROSE * 2, "x")] * 30 + [(2, "a" * 5000, "x"), (3, "b" + "a" * 700, "x"), (3, "b" + "a" * 700, "x"), (4, None, None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, row_key string").repartition(4)
    found = suffix_dedup.remove_repeats(frame, length=64).collect()
    assert sorted((r["doc_id"], r["n_bytes"], r["n_removed"]) for r in found) == sorted(
        [(1, 2 * len(PROSE), 2 * len(PROSE))] * 30 + [(2, 5000, 5000), (3, 701, 701), (3, 701, 701), (4, 0, 0)]
    )
