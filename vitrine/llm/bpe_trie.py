"""Byte-level BPE encoding by a depth-first walk over the trie of distinct words, and decoding.

The encoding of a prefix is its last token after the encoding of a shorter prefix, and of all
tokens that end a prefix exactly one keeps that pair intact under the merge rules.  So a node of
the trie of words needs one state, the last token of its prefix and that token's length; a child's
state follows from the states above it, and a prefix that words share is worked out once.  Words
are walked in sorted order with the current path as a stack, which visits the trie depth first
without building it.

Texts are split and their distinct pieces numbered inside Arrow; only pieces that a worker does
not remember reach the trie.
"""

from __future__ import annotations

import json
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import WORD_BYTES, WordMemory, map_rows, spread_out

#: Token pairs whose outcome a worker remembers in each of two generations.
PAIRS = 200_000
# The byte-level word pattern, and the characters of the Unicode White_Space property.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
SPACES = r"[\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
#: Last bytes by which the longest possible token is looked up.
TAIL = 4
#: Put before each space, so that a split there keeps the space; texts that hold it go word by word.
CUT = "\x01"


def byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class TrieEncoder:
    """Encoder and decoder of one byte-level BPE file (a tokenizers JSON file)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        raw = {name: bytes(letters[c] for c in name) for name in spec["model"]["vocab"]
               if all(c in letters for c in name)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ids = {name: number for name, number in spec["model"]["vocab"].items() if name not in self.special}
        self.token = {raw[name]: number for name, number in ids.items()}
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.merge = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(pairs)}
        size = max([*ids.values(), *self.special.values()]) + 1
        table = [b""] * size
        for data, number in self.token.items():
            table[number] = data
        for name, number in self.special.items():
            table[number] = name.encode()
        self.table = table
        self.sizes = np.array([len(t) for t in table], dtype=np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(table), dtype=np.uint8)
        # how long a token can be, by its last bytes: shorter tokens need no entry
        self.reach: dict[bytes, int] = {}
        for data in self.token:
            tail = data[-TAIL:]
            self.reach[tail] = max(self.reach.get(tail, 0), len(data))
        self.words = regex.compile(PATTERN).findall
        self.marks = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.width = size
        self.intact: dict[int, bool] = {}
        self.older: dict[int, bool] = {}
        self.kind = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        self.known = WordMemory(self.kind)

    def merged(self, data: bytes) -> list[int]:
        """Plain merging, lowest rank first: the rule that the walk has to agree with."""
        parts = [self.token[data[i : i + 1]] for i in range(len(data))]
        while len(parts) > 1:
            options = [(self.merge[p][0], i) for i, p in enumerate(zip(parts, parts[1:])) if p in self.merge]
            if not options:
                break
            _, i = min(options)
            parts[i : i + 2] = [self.merge[parts[i], parts[i + 1]][1]]
        return parts

    def _stands(self, last: int, token: int) -> bool:
        """Whether ``token`` may follow ``last`` (-1: nothing) without a merge between them."""
        pair = last * self.width + token
        found = self.older.get(pair)
        if found is None:
            if last < 0:
                found = self.merged(self.table[token]) == [token]
            else:
                found = self.merged(self.table[last] + self.table[token]) == [last, token]
        if len(self.intact) >= PAIRS:
            self.older = dict(self.intact)
            self.intact.clear()
        self.intact[pair] = found
        return found

    def walk(self, words: list[bytes]) -> list[bytes]:
        """Encodings (as the bytes of numbers) of distinct words, given sorted; the states of the
        path are shared by prefixes."""
        token_of, known, reach, width, kind = self.token.get, self.intact.get, self.reach.get, self.width, self.kind.char
        last, length = [-1], [0]
        before, out = b"", []
        for word in words:
            shared, most = 0, min(len(before), len(word))
            while shared < most and before[shared] == word[shared]:
                shared += 1
            del last[shared + 1 :], length[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                if end < TAIL:
                    first = 0
                else:
                    # tokens shorter than a tail have no entry
                    first = end - reach(word[end - TAIL : end], TAIL - 1)
                    if first < 0:
                        first = 0
                for begin in range(first, end):
                    token = token_of(word[begin:end])
                    if token is not None:
                        intact = known(last[begin] * width + token)
                        if intact is None:
                            intact = self._stands(last[begin], token)
                        if intact:
                            last.append(token)
                            length.append(end - begin)
                            break
            before = word
            ids, place = [], len(word)
            while place:
                ids.append(last[place])
                place -= length[place]
            ids.reverse()
            out.append(array(kind, ids).tobytes())
        return out

    def encode_words(self, words: set[str]) -> dict[str, bytes]:
        fresh = sorted(w.encode("utf-8") for w in words)
        return dict(zip((w.decode("utf-8") for w in fresh), self.walk(fresh)))

    def _split(self, piece: str) -> tuple[str, ...] | list[str]:
        """The words of a piece; letters after one space, with or without a final mark, need no
        pattern."""
        if piece[:1] == " ":
            if piece[1:].isalpha():
                return (piece,)
            if piece[-1:] in (",", ".") and piece[1:-1].isalpha():
                return (piece[:-1], piece[-1])
        return self.words(piece)

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces of text between which no word reaches, as the bytes of numbers."""
        split = [self._split(p) for p in pieces]
        coded = self.encode_words({w for words in split for w in words})
        return [coded[w[0]] if len(w) == 1 else b"".join([coded[word] for word in w]) for w in split]

    def encode_plainly(self, text: str) -> np.ndarray:
        """One text, special strings apart."""
        ids: list[int] = []
        for part in self.marks.split(text) if self.marks else [text]:
            if part in self.special:
                ids.append(self.special[part])
            elif part:
                ids += np.frombuffer(self.encode_pieces([part])[0], self.kind).tolist()
        return np.array(ids, dtype=np.int32)

    def encode(self, texts: list[str]) -> pa.ListArray:
        rows = pa.array(texts, pa.large_string())
        # a cut before a space is safe unless white space stands on both its sides
        odd = pc.match_substring_regex(rows, f"{SPACES} (?:{SPACES}|$)|{CUT}")
        for name in self.special:
            odd = pc.or_(odd, pc.match_substring(rows, name))
        odd = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        plain = pa.array(["" if i in set(odd) else t for i, t in enumerate(texts)], pa.large_string()) if len(odd) else rows
        split = pc.split_pattern(pc.replace_substring(plain, " ", f"{CUT} "), CUT)
        edges = split.offsets.to_numpy()
        edges = edges - edges[0]
        coded = split.flatten().dictionary_encode()
        del rows, plain, split
        flat, size = self.known.numbers(coded.dictionary.to_pylist(), self.encode_pieces)
        places = coded.indices.to_numpy()
        begin = np.cumsum(size) - size
        size = size[places]
        whole = flat[spread_out(begin[places], size)].astype(np.int32)
        tokens = np.concatenate([[0], np.cumsum(size)])[edges]
        if len(odd):
            parts = np.split(whole, tokens[1:-1])
            for i in odd:
                parts[i] = self.encode_plainly(texts[i])
            whole = np.concatenate(parts)
            tokens = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        return pa.ListArray.from_arrays(pa.array(tokens.astype(np.int32)), pa.array(whole, pa.int32()))

    def decode(self, ids: np.ndarray) -> str:
        """Bytes of all ids, joined and read as UTF-8; what is not UTF-8 becomes U+FFFD."""
        return self.flat[spread_out(self.begins[ids], self.sizes[ids])].tobytes().decode("utf-8", "replace")


_ENCODERS: dict[str, TrieEncoder] = {}


def encoder(path: str) -> TrieEncoder:
    """One encoder per worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TrieEncoder(path)
    return _ENCODERS[path]


def _with(df: DataFrame, source: str, targets: dict[str, str], function, keep: bool = True) -> DataFrame:
    """``df`` with the target columns (name: kind) that ``function`` makes of ``source``, which goes
    unless ``keep``."""
    names = [c for c in df.columns if c not in targets]
    rows = df.select(*(F.col(f"`{c}`") for c in names))
    place = names.index(source)
    held = [i for i in range(len(names)) if keep or i != place]
    out = [names[i] for i in held]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = function(batch.column(place))
        return pa.RecordBatch.from_arrays([*(batch.column(i) for i in held), *made], names=[*out, *targets])

    kinds = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in out]
    schema = ", ".join([*kinds, *(f"`{c}` {kind}" for c, kind in targets.items())])
    return map_rows(rows, run, schema, source, WORD_BYTES)


def _encoded(texts: pa.Array, path: str) -> pa.Array:
    return encoder(path).encode([t or "" for t in texts.to_pylist()])


def _decoded(ids: pa.Array, path: str) -> pa.Array:
    coder = encoder(path)
    values = ids.flatten().to_numpy(zero_copy_only=False)
    sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
    edges = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return pa.array([coder.decode(values[a:b]) for a, b in zip(edges[:-1], edges[1:])], pa.string())


def encode(df: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``df`` with ``ids_col`` (array of int): the whole text's token ids, as the tokenizers library
    gives them without added special tokens; special strings inside a text are their ids.

    A null or empty text has an empty array; a very long one is encoded whole, and a word of any
    length in time that grows with it; rows that repeat are encoded alike; an empty table gives an
    empty one.  Other columns stay, whatever their names; one named ``ids_col`` is replaced."""
    return _with(df, text_col, {ids_col: "array<int>"}, lambda texts: [_encoded(texts, path)])


def decode(df: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``df`` with ``text_col``: the text of the ids, special tokens included.

    Null and empty ids give ''; bytes that are not UTF-8 become U+FFFD; rows that repeat are decoded
    alike and an empty table gives an empty one.  Other columns stay; one named ``text_col`` is
    replaced."""
    return _with(df, ids_col, {text_col: "string"}, lambda ids: [_decoded(ids, path)])


def round_trip(
    df: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str = "decoded"
) -> DataFrame:
    """``encode`` and ``decode`` in one pass over the texts: ``df`` without ``text_col``, with the ids
    and the text decoded from them.  Nulls, empty, long and repeated texts, empty tables and other
    columns as there."""

    def run(texts: pa.Array) -> list[pa.Array]:
        ids = _encoded(texts, path)
        return [ids, _decoded(ids, path)]

    return _with(df, text_col, {ids_col: "array<int>", decoded_col: "string"}, run, keep=False)
