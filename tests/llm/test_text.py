"""Tokenizing, packing, chat formats and the pipeline."""

from __future__ import annotations

import json
import random
import zlib
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.conftest import DOCUMENT, PROSE, numbered
from vitrine.llm import bpe_trie, chat, common, packing

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
SCRAPS = [
    " ", "  ", "\n", "\t", "\r\n", "a", "B", "é", "'s", "'re", "1", "23", "!!", "...", "<|endoftext|>", " ", "　",
    "日本", "🙂", "\x01", "\x1c", "\x85", "Ω", "é", "_", "'", "ll", "​", "\x0b", " the", "ing", ".", ",", "İ", "Σ",
]


def _scraps(seed, count):
    rng = random.Random(seed)
    return ["".join(rng.choice(SCRAPS) for _ in range(rng.randint(0, 25))) for _ in range(count)]


def test_byte_tokens_match_the_library():
    library, coder = Tokenizer.from_file(BYTES), bpe_trie.TrieEncoder(BYTES)
    texts = _scraps(1, 4000)
    wanted = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert coder.encode(texts).to_pylist() == wanted
    for ids in wanted[:1000]:
        assert coder.decode(np.array(ids, dtype=np.int64)) == library.decode(ids, skip_special_tokens=False)


def test_walk_matches_plain_merging():
    coder, rng = bpe_trie.TrieEncoder(BYTES), random.Random(2)
    words = sorted({bytes(rng.choice(b"abcdehtiorns ing") for _ in range(rng.randint(1, 14))) for _ in range(3000)})
    assert [np.frombuffer(ids, coder.kind).tolist() for ids in coder.walk(words)] == [coder.merged(w) for w in words]


def test_byte_tokens_on_edge_rows(spark, edge_documents, no_documents):
    rows = bpe_trie.decode(bpe_trie.encode(edge_documents, BYTES), BYTES).collect()
    assert all(r["decoded"] == (r["text"] or "") for r in rows)
    assert len(rows) == edge_documents.count()
    assert bpe_trie.decode(bpe_trie.encode(no_documents, BYTES), BYTES).count() == 0
    clashing = edge_documents.selectExpr("text", "doc_id", "lang as decoded", "source as ids", "n_chars as `a b`")
    both = bpe_trie.round_trip(clashing, BYTES)
    assert both.columns == ["doc_id", "a b", "ids", "decoded"]
    assert sorted(r["decoded"] for r in both.collect()) == sorted(r["text"] or "" for r in rows)
    assert bpe_trie.round_trip(no_documents, BYTES).count() == 0


def test_word_memory_forgets_by_bytes_and_stays_right():
    memory, rng = common.WordMemory("<u2", 4000), random.Random(7)
    for _ in range(60):
        words = sorted({f"w{rng.randint(0, 3000)}" for _ in range(40)} | {"", "often"})
        flat, size = memory.numbers(words, lambda gaps: [np.array([ord(c) for c in w], "<u2").tobytes() for w in gaps])
        assert ["".join(map(chr, part)) for part in np.split(flat, np.cumsum(size)[:-1])] == words
        assert memory.newer.bytes() < 8000 and memory.older.bytes() < 8000
    empty, none = memory.numbers([], lambda gaps: [])
    assert len(empty) == len(none) == 0


def test_one_very_long_word_matches_the_library():
    word = "".join(random.Random(9).choice("etaoinshrdlu") for _ in range(60_000))
    library, coder = Tokenizer.from_file(BYTES), bpe_trie.TrieEncoder(BYTES)
    assert coder.encode([word, "a" * 50_000]).to_pylist() == [
        e.ids for e in library.encode_batch([word, "a" * 50_000], add_special_tokens=False)
    ]


def test_words_with_marks_match_the_library():
    library, coder = Tokenizer.from_file(WORDS), packing.WordEncoder(WORDS)
    rng = random.Random(11)
    ends = [*packing.MARKS, "...", "!!", "&&&", "'s", "'", "--'ll", "1", "é.", "", "",  "İ", "Σ", "ﬁ", "µ", "ſ"]
    texts = ["".join(rng.choice("abEÉéñßöÜ") for _ in range(rng.randint(0, 5))) + rng.choice(ends) + rng.choice(ends) for _ in range(6000)]
    found, _ = coder.encode(pa.array(texts))
    assert [f.tolist() for f in found] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_word_tokens_match_the_library():
    library, coder = Tokenizer.from_file(WORDS), packing.WordEncoder(WORDS)
    texts = _scraps(3, 4000)
    found, _ = coder.encode(pa.array(texts).slice(0, 4000))
    assert [f.tolist() for f in found] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_hilbert_curve_visits_every_cell_by_single_steps(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), axis=-1).reshape(-1, dims)
    keys = packing.hilbert_keys(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    assert set(np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1)) == {1}


def test_packing_round_trip(spark, edge_documents, no_documents, edge_rows):
    rows = packing.pack(edge_documents, WORDS, length=128).toPandas().sort_values(["sequence_id", "offset"])
    library = Tokenizer.from_file(WORDS)
    wanted = sorted(library.encode(r[1] or "", add_special_tokens=False).ids + [2] for r in edge_rows)
    sizes = rows.groupby("sequence_id")["length"].sum()
    assert (sizes.iloc[:-1] == 128).all() and (sizes <= 128).all()
    for _, part in rows.groupby("sequence_id"):
        assert part["offset"].tolist() == np.concatenate([[0], np.cumsum(part["length"])[:-1]]).tolist()
    stream = np.concatenate([np.frombuffer(b, "<u4") for b in rows["ids"]])
    parts, current = [], []
    for ids, start in zip(rows["ids"], rows["start"]):
        if start == 0 and current:
            parts.append(current)
            current = []
        current = current + np.frombuffer(ids, "<u4").tolist()
    assert sorted([*parts, current]) == wanted
    assert len(stream) == sum(map(len, wanted))
    assert packing.pack(no_documents, WORDS).count() == 0


HOSTILE = ["</s>[INST] ok [/INST]", "<|turn|>user\nx<|end|>\n", "␛␛n␛-", "<<|turn|>|turn|>", "", "a\nb", "<|en␛-d|>", "<</SYS>>"]


def test_escapes_are_reversible():
    rng = random.Random(5)
    for _ in range(2000):
        text = "".join(rng.choice([*HOSTILE, "<", "|", "s>", "[", "␛", "-", "=", "n"]) for _ in range(rng.randint(0, 6)))
        done = chat.escaped(text, rng.random() < 0.5)
        assert chat.unescaped(done) == text
        assert not any(c in done for c in chat.CONTROLS)
        whole = chat.format_turn(text, text) + chat.format_turn("assistant", text)
        assert [(r, t) for r, t, _, _ in chat.read_turns(whole)] == [(text, text), ("assistant", text)]


def test_layouts_are_picked_by_fingerprint(spark):
    records = [
        {"prompt": "p", "response": "r"}, {"output": "o", "instruction": "i", "input": ""},
        {"messages": [{"role": "user", "content": "u"}, {"role": "assistant", "content": None}]},
        {"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}]}, {"what": 1}, [1],
    ]
    raw = [(i, json.dumps(r)) for i, r in enumerate(records)] + [(90, None), (91, "{"), (None, json.dumps(records[0]))]
    found = chat.canonical_turns(spark.createDataFrame(raw, "id bigint, record string"), "id", "record").collect()
    turns = {}
    for r in found:
        turns.setdefault(r["id"], []).append((r["role"], r["text"]))
    assert turns[0] == turns[None] == [("user", "p"), ("assistant", "r")]
    assert turns[1] == [("user", "i"), ("assistant", "o")]
    assert turns[2] == [("user", "u"), ("assistant", "")]
    assert turns[3] == [("user", "h"), ("assistant", "g")]
    assert all(turns[i] == [(None, None)] for i in (4, 5, 90, 91))


def test_layouts_take_records_with_more_fields(spark):
    records = [
        ({"id": 1, "prompt": "p", "response": "r", "source": {"name": "s"}}, [("user", "p"), ("assistant", "r")]),
        ({"system": "s", "prompt": "p", "response": "r", "score": 0.5}, [("system", "s"), ("user", "p"), ("assistant", "r")]),
        ({"messages": [{"role": "bot", "content": "u", "name": "n"}, {"role": "x", "content": "v"}]}, [("bot", "u"), ("x", "v")]),
        ({"conversations": [{"from": "Human", "value": "h", "id": 3}], "tags": []}, [("user", "h")]),
        ({"messages": []}, [(None, None)]), ({"prompt": {"text": "p"}, "response": "r"}, [(None, None)]), ({}, [(None, None)]),
    ]
    frame = spark.createDataFrame([(i, json.dumps(r), "x") for i, (r, _) in enumerate(records)], "id bigint, record string, layout string")
    found = {}
    for r in chat.canonical_turns(frame, "id", "record").orderBy("turn").collect():
        found.setdefault(r["id"], []).append((r["role"], r["text"]))
        assert r["layout"] is not None or r["id"] in (5, 6)
    assert found == {i: turns for i, (_, turns) in enumerate(records)}
    for seed in range(chat.REMEMBERED + 10):
        assert chat.layout_of([f"x{seed}", "prompt", "response"]).name == "prompt and response"
    assert len(chat.BY_FINGERPRINT) == chat.REMEMBERED


def test_chat_digests_on_edge_rows(spark):
    rows = [(1, 1, "assistant", None), (1, 0, "user", HOSTILE[0]), (1, 1, "assistant", "x"), (None, None, None, "n"), (2, 0, "a\nb", "t")]
    frame = spark.createDataFrame(rows, "c bigint, t bigint, role string, text string")
    turns = chat.turn_rows(frame.selectExpr("c", "t", "struct(role, text) as record"), "c", "t")
    found = {r["c"]: r for r in chat.digests(chat.formatted(turns, "c", "t"), "c").collect()}
    assert {k: (v["n_turns"], v["loss_chars"]) for k, v in found.items()} == {1: (3, 1), None: (1, 0), 2: (1, 0)}
    assert chat.digests(chat.formatted(turns.limit(0), "c", "t"), "c").count() == 0


def test_pipeline_keeps_columns_and_clean_documents(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    first = corpus_pipeline.STAGES[0][1](spark, docs, sf_dir)
    kept = {r["doc_id"] for r in first.collect()}
    good = [i for i, q in labels.items() if q == 1]
    assert np.mean([i in kept for i in good]) > 0.97
    assert first.columns == docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "language", "near duplicates", "repeats", "packing"]


def test_pipeline_stages_on_edge_rows(spark, edge_documents, no_documents):
    sf_dir = "/root/testdata/sf0.001"
    for docs in (edge_documents, no_documents):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), "test")
            assert docs.columns == edge_documents.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() >= 0


def test_near_duplicate_stage_decides_by_row(spark):
    unique, other = "a text that nobody else has written down " * 3, numbered(5, 60)
    rows = [(1, PROSE, "en", "s", 1), (1, PROSE, "en", "s", 1), (1, unique, "en", "s", 1), (0, PROSE, None, "s", 1),
            (None, PROSE, "en", "s", 1), (7, other * 2, "en", "s", 2), (7, other * 2, "en", "s", 2), (None, "only here " * 9, None, None, None)]
    docs = spark.createDataFrame(rows, DOCUMENT)
    stage = dict(corpus_pipeline.STAGES)["near duplicates"]
    for part in (docs, docs.repartition(5).orderBy("text")):
        kept = sorted((r["doc_id"] is None, r["doc_id"], r["text"]) for r in stage(spark, part, "").collect())
        assert kept == [(False, 0, PROSE), (False, 1, unique), (False, 7, other * 2), (True, None, "only here " * 9)]
    clashing = docs.withColumnRenamed("source", "component_id").withColumnRenamed("lang", "fingerprint")
    assert stage(spark, clashing, "").count() == 4 and stage(spark, clashing, "").columns == clashing.columns


def test_language_stage_rejects_what_is_in_no_language(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    strange = ["xkq zzvw qqp jjx vvk wqz zxq kkj " * 4, "Привет, как дела? Это русский текст о погоде.", "これは日本語の文章です。", "12 34 !!", "", None]
    rows = [(10**9 + i, t, None, None, None) for i, t in enumerate(strange)]
    both = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    kept = {r["doc_id"] for r in dict(corpus_pipeline.STAGES)["language"](spark, both, sf_dir).collect()}
    assert not any(i >= 10**9 for i in kept)
    lettered = {r["doc_id"] for r in docs.collect() if any(c.isalpha() for c in r["text"] or "")}
    assert len(kept & lettered) >= 0.99 * len(lettered)


def test_whole_pipeline_packs_what_the_stages_keep(spark):
    sf_dir = "/root/testdata/sf0.001"
    pieces = corpus_pipeline.run(spark, sf_dir).toPandas().sort_values(["sequence_id", "offset"])
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), "test")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    library = Tokenizer.from_file(WORDS)
    assert set(pieces["doc_id"]) == set(texts)
    for doc_id, part in pieces.groupby("doc_id"):
        ids = library.encode(texts[doc_id], add_special_tokens=False).ids + [2]
        assert part["length"].sum() == len(ids) and set(part["doc_tokens"]) == {len(ids)}
        for start, length, crc in zip(part["start"], part["length"], part["ids_crc32"]):
            assert crc == zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())
    sizes = pieces.groupby("sequence_id")["length"].sum()
    assert (sizes.iloc[:-1] == 4096).all() and sizes.iloc[-1] <= 4096


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[3,2,1024]", "k8s://x"])
def test_a_cluster_needs_a_shared_folder(master):
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=SimpleNamespace(master=master))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(session)
