"""Packing of documents into sequences along a Hilbert curve.

Every document is tokenized and gets a vector, the sum of fixed pseudo-random vectors of its
tokens, normalised; the grid cell of that vector on a Hilbert curve is its key.  Documents are
range-sorted by key, so neighbours in a sequence are neighbours in that space, and lie end to end
in one stream that is cut every ``length`` tokens: only the very last sequence has padding.
Positions in the stream are sums per key range plus running sums within it.
"""

from __future__ import annotations

import os
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrine.llm.bpe_trie import byte_letters
from vitrine.llm.common import WORD_BYTES, WordMemory, bounds_of, bucket_of, map_rows, partitions, spread_out, stored

#: Dimensions of the curve and bits of each, then bits that spread documents of one cell.
DIMENSIONS, BITS, SPREAD_BITS = 4, 12, 15
#: Tokens that weigh as one document where the ranges are cut.
WEIGHED_TOKENS = 512
#: Bytes of token ids in one range of the curve, which one task sorts.
RANGE_BYTES = 16 << 20
#: Words that are asked from the library in one call: its results are large.
ASKED = 2_000
# ASCII marks that can stand behind letters and start no other piece of the pattern.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def _letters(word: str) -> bool:
    """Whether a word is letters alone that the tokenizer's normalisation leaves as they are."""
    return word.isalpha() and word.lower() == word and (word.isascii() or unicodedata.is_normalized("NFC", word))


class WordEncoder:
    """Token ids of texts by a word-level, lower-casing tokenizer file, remembered by word.

    Nothing that the tokenizer matches crosses ASCII white space, so a text's ids are those of its
    words; special token strings hold no white space and stay whole.  A batch is split and its
    distinct words numbered inside Arrow.  Lower-case letters with or without marks behind them are
    two pieces at most, which go to the library's model at once; other words go through the whole
    library.  A worker's memory of words is bounded in bytes."""

    def __init__(self, path: str):
        # tasks are the parallel unit; the library's own threads would only compete with them
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        size = self.library.get_vocab_size(with_added_tokens=True)
        self.kind = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        self.plane = np.random.default_rng(9).standard_normal((size, DIMENSIONS)).astype(np.float32)
        self.model = self.library.model
        self.letter = {byte: letter for letter, byte in byte_letters().items()}
        self.marks: dict[str, bytes] = {}
        self.known = WordMemory(self.kind)

    def _packed(self, ids: list[int]) -> bytes:
        return array(self.kind.char, ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        """Ids of one piece of the tokenizer's pattern, as its byte letters."""
        if not piece.isascii():
            piece = piece.encode().decode("latin-1").translate(self.letter)
        return self._packed([token.id for token in self.model.tokenize(piece)])

    def _simple(self, word: str) -> bytes | None:
        """Ids of letters with marks behind them; None for any other word."""
        if _letters(word):
            return self._piece(word)
        stem = word.rstrip(MARKS)
        if len(stem) < len(word) and _letters(stem):
            mark = word[len(stem) :]
            ids = self.marks.get(mark)
            if ids is None:
                if len(self.marks) > ASKED:
                    self.marks.clear()
                ids = self.marks[mark] = self._piece(mark)
            return self._piece(stem) + ids
        return None

    def words(self, words: list[str]) -> list[bytes]:
        """The ids of distinct words, as the bytes of little-endian numbers."""
        found = list(map(self._simple, words))
        rest = [place for place, ids in enumerate(found) if ids is None]
        for start in range(0, len(rest), ASKED):
            part = rest[start : start + ASKED]
            coded = self.library.encode_batch_fast([words[place] for place in part], add_special_tokens=False)
            for place, code in zip(part, coded):
                found[place] = self._packed(code.ids)
        return found

    def encode(self, texts: pa.Array) -> tuple[list[np.ndarray], np.ndarray]:
        """Ids of each text, and the sums of their tokens' vectors."""
        # a fresh array: case folding of a slice reads wrong offsets
        texts = pa.array([t or "" for t in texts.to_pylist()], pa.large_string())
        # the tokenizer lower-cases too, but not the strings of its special tokens
        lowered = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        for space in "\t\n\v\f\r":
            lowered = pc.replace_substring(lowered, space, " ")
        split = pc.split_pattern(lowered, " ")
        del texts, lowered
        edges = split.offsets.to_numpy()
        edges = edges - edges[0]
        coded = split.flatten().dictionary_encode()
        del split
        flat, size = self.known.numbers(coded.dictionary.to_pylist(), self.words)
        places = coded.indices.to_numpy()
        begin = np.cumsum(size) - size
        vectors = np.zeros((len(size), DIMENSIONS), np.float32)
        some = size > 0
        if some.any():
            vectors[some] = np.add.reduceat(self.plane[flat], begin[some], axis=0)
        # an empty text is one empty word, so no text is without
        sums = np.add.reduceat(vectors[places], edges[:-1], axis=0, dtype=np.float64) if len(places) else np.zeros((0, DIMENSIONS))
        size = size[places]
        tokens = np.concatenate([[0], np.cumsum(size)])[edges]
        return np.split(flat[spread_out(begin[places], size)], tokens[1:-1]), sums


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Index along the Hilbert curve of points on a grid of ``2 ** bits`` cells a side.

    ``cells`` is (points, dimensions).  Gray-code transforms bit by bit, then interleaves."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    top = 1 << (bits - 1)
    bit = top
    while bit > 1:
        below = bit - 1
        for i in range(dims):
            inverted = x[i] & bit != 0
            swapped = np.where(inverted, 0, (x[0] ^ x[i]) & below)
            x[0] ^= np.where(inverted, below, swapped)
            x[i] ^= swapped
        bit >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    bit = top
    while bit > 1:
        turn ^= np.where(x[-1] & bit != 0, bit - 1, 0)
        bit >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for place in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << 1 | (x[i] >> place & 1)
    return key


def tokenized(df: DataFrame, id_col: str, text_col: str, path: str, end_id: int) -> DataFrame:
    """``(id_col, key, n_tokens, ids)``: ids of each text and its end id as little-endian numbers
    of two bytes (four for a vocabulary over 65,536), with its place along the curve."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = encoder(path)
        ids, space = coder.encode(batch.column(1))
        end = coder.kind.type(end_id).tobytes()
        sizes = [len(i) + 1 for i in ids]
        packed = [i.tobytes() + end for i in ids]
        norm = np.linalg.norm(space, axis=1, keepdims=True)
        space = np.divide(space, norm, out=np.zeros_like(space), where=norm > 0)
        cells = np.clip(((space + 1) * (1 << (BITS - 1))).astype(np.int64), 0, (1 << BITS) - 1)
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(hilbert_keys(cells, BITS)),
                pa.array(sizes, pa.int64()),
                pa.array(packed, pa.binary()),
            ],
            names=[id_col, "key", "n_tokens", "ids"],
        )

    schema = f"`{id_col}` {kind}, key bigint, n_tokens bigint, ids binary"
    coded = map_rows(df.select(id_col, text_col), run, schema, text_col, WORD_BYTES)
    # copies share a cell; these bits let ranges divide them
    spread = F.pmod(F.xxhash64(id_col, "n_tokens"), F.lit(1 << SPREAD_BITS))
    return coded.withColumn("key", F.shiftleft("key", SPREAD_BITS) + spread)


def pack(
    df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, length: int = 4096
) -> DataFrame:
    """One row per piece: ``id_col``, ``start`` (ids of the document before it), ``length``,
    ``ids`` (little-endian unsigned 32-bit), ``doc_tokens``, ``sequence_id``, ``offset``.

    Null and empty texts are one end id.  Every id lies in exactly one piece; rows that repeat are
    packed as often.  All sequences are full but the last.  Other columns are ignored; an empty
    table has no pieces."""
    small = stored(tokenized(df, id_col, text_col, path, end_id), "tokens")
    held = small.agg(F.sum(F.length("ids")).alias("bytes")).first()["bytes"] or 0
    count = max(4 * partitions(df.sparkSession), -(-held // RANGE_BYTES))
    # a document counts once for each part of a sequence, so that ranges hold like numbers of tokens
    weight = F.ceil(F.col("n_tokens") / WEIGHED_TOKENS).cast("int")
    bounds = bounds_of(small.select(F.explode(F.array_repeat("key", weight)).alias("key")), "key", count)
    ranged = small.withColumn("range", bucket_of(F.col("key"), bounds))
    sums = {r["range"]: r["n"] for r in ranged.groupBy("range").agg(F.sum("n_tokens").alias("n")).collect()}
    totals = np.array([sums.get(i, 0) for i in range(len(bounds) + 1)], dtype=np.int64)
    begins = np.cumsum(totals) - totals

    order = Window.partitionBy("range").orderBy("key", id_col, "ids")
    before = F.coalesce(F.sum("n_tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = ranged.withColumn("before", before)
    kind = df.schema[id_col].dataType.simpleString()

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, start, size, ids, total, place = [], [], [], [], [], []
        places = begins[batch.column("range").to_numpy()] + batch.column("before").to_numpy()
        tokens = batch.column("n_tokens").to_numpy()
        for row, (packed, at, n) in enumerate(zip(batch.column("ids").to_pylist(), places.tolist(), tokens.tolist())):
            whole = np.frombuffer(packed, dtype=f"<u{len(packed) // n}").astype("<u4")
            done = 0
            while done < n:
                part = min(n - done, length - (at + done) % length)
                rows.append(row)
                start.append(done)
                size.append(part)
                ids.append(whole[done : done + part].tobytes())
                total.append(n)
                place.append(at + done)
                done += part
        place = np.array(place, dtype=np.int64)
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(rows, pa.int64())),
                pa.array(start, pa.int64()),
                pa.array(size, pa.int64()),
                pa.array(ids, pa.binary()),
                pa.array(total, pa.int64()),
                pa.array(place // length),
                pa.array(place % length),
            ],
            names=[id_col, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
        )

    schema = (
        f"`{id_col}` {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, "
        "sequence_id bigint, offset bigint"
    )
    return map_rows(placed.select(id_col, "n_tokens", "ids", "range", "before"), cut, schema, "ids")
