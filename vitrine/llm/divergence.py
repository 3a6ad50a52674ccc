"""How the sources of a language differ in their words.

Words are counted by sorting pointers: in every slice of texts, pointers to the word starts in the
Arrow buffer are put in order by multikey quicksort, eight bytes of the words at a time, where only
pointers that are still equal and whose words go on are sorted by their next bytes.  Equal runs are
the distinct words, and as the sort is stable and texts are laid out by group, a run's pointers lie by
group and document: their changes count occurrences and documents.

What the slices send is summed by Spark.  Words in enough documents of a language are kept, and rates
are exact whole numbers.  The distance of two sources is a sum over words: blocks of words become
matrices of words by sources, and the sums of the blocks are added.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.llm.common import slices, spread_out, stored

#: Bytes of text whose word starts are sorted together; words of one block of rates, and rates of it
#: (words by sources) at most.
SLICE_BYTES, BLOCK_WORDS, BLOCK_RATES = 6 << 20, 4096, 1 << 22
#: What is added to every count, and the whole that rates are parts of.
PRIOR, WHOLE = 5, 1_000_000_000
# Bytes that belong to words, with A-Z in lower case.
_WORD = np.array([b >= 0x80 or chr(b).isalpha() for b in range(256)])
_LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)


def word_starts(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pointers to the words of texts that lie end to end in ``data``, and the lengths of the words."""
    inside = _WORD[data]
    first = np.zeros(len(data) + 1, bool)
    first[edges] = True
    starts = np.flatnonzero(inside & (first[:-1] | ~np.concatenate([[False], inside[:-1]])))
    ends = np.flatnonzero(inside & (first[1:] | ~np.concatenate([inside[1:], [False]]))) + 1
    return starts, ends - starts


def sorted_words(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the pointers by their words, stable, and marks where a new word begins."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray(len(data) + 1, ">u8", padded.tobytes(), strides=(1,))

    def digits(which: np.ndarray, depth: int) -> np.ndarray:
        """Eight bytes of each word from ``depth`` on, zero behind its end."""
        rest = np.clip(sizes[which] - depth, 0, 8).astype(np.uint64)
        found = eights[starts[which] + depth].astype(np.uint64)
        cut = (np.uint64(8) - rest) * np.uint64(8)
        return np.where(rest == 0, np.uint64(0), found >> cut << cut)

    # in a run, words that end within these bytes stand before those that go on
    order = np.argsort(sizes > 8, kind="stable")
    keys = digits(order, 0)
    again = np.argsort(keys, kind="stable")
    order, keys = order[again], keys[again]
    goes = sizes[order] > 8
    new = np.ones(len(order), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (goes[1:] != goes[:-1])
    depth = 8
    while True:
        alone = new & np.append(new[1:], True)
        # places, in the order, of words that go on and share their run
        open_ = np.flatnonzero((sizes[order] > depth) & ~alone)
        if not len(open_):
            return order, new
        run, which = np.cumsum(new)[open_], order[open_]
        keys, goes = digits(which, depth), sizes[which] > depth + 8
        again = np.lexsort((goes, keys, run))
        run, keys, goes = run[again], keys[again], goes[again]
        order[open_] = which[again]
        fresh = (run[1:] != run[:-1]) | (keys[1:] != keys[:-1]) | (goes[1:] != goes[:-1])
        new[open_[1:]] |= fresh
        depth += 8


def counted_slice(texts: pa.Array, groups: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Of every word of every group: group, word, occurrences, rows.  ``texts`` are laid out by group."""
    buffers = texts.buffers()
    edges = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = _LOWER[np.frombuffer(buffers[2] or b"", np.uint8)[edges[0] : edges[-1]]]
    edges = edges - edges[0]
    starts, sizes = word_starts(data, edges)
    order, new = sorted_words(data, starts, sizes)
    row = np.searchsorted(edges, starts[order], side="right") - 1
    group = groups[row]
    change = new.copy()
    change[1:] |= group[1:] != group[:-1]
    once = change.copy()
    once[1:] |= row[1:] != row[:-1]
    begins = np.flatnonzero(change)
    if not len(begins):
        return group, pa.array([], pa.string()), group, group
    which = order[begins]
    size = sizes[which]
    ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    words = pa.StringArray.from_buffers(
        len(which), pa.py_buffer(ends.tobytes()), pa.py_buffer(data[spread_out(starts[which], size)].tobytes())
    )
    occurs = np.diff(np.append(begins, len(order)))
    return group[begins], words, occurs, np.add.reduceat(once.astype(np.int64), begins)


def word_counts(df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``lang, source, term, n, n_docs``: how often and in how many rows of each group a word occurs;
    each group also has a row with the term ''."""
    rows = df.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(a) for c, a in (
        (text_col, "text"), (lang_col, "lang"), (source_col, "source"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            codes = [batch.column(i).dictionary_encode() for i in (1, 2)]
            lang, source = (c.indices.to_numpy().astype(np.int64) for c in codes)
            number = lang * len(codes[1].dictionary) + source
            order = np.argsort(number, kind="stable")
            texts = batch.column(0).cast(pa.large_string()).take(pa.array(order))
            known = np.unique(number)
            group, words, occurs, docs = counted_slice(texts, number[order])
            group = np.concatenate([known, group])
            zeros = np.zeros(len(known), np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    codes[0].dictionary.take(pa.array(group // len(codes[1].dictionary))),
                    codes[1].dictionary.take(pa.array(group % len(codes[1].dictionary))),
                    pa.concat_arrays([pa.array([""] * len(known), pa.string()), words]),
                    pa.array(np.concatenate([zeros, occurs])),
                    pa.array(np.concatenate([zeros, docs])),
                ],
                names=["lang", "source", "term", "n", "n_docs"],
            )
            pa.default_memory_pool().release_unused()

    found = rows.mapInArrow(run, "lang string, source string, term string, n bigint, n_docs bigint")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def _rate(count: Column | str, total: str, kept: str) -> Column:
    """1 + floor(whole * (count + prior) / (total + prior * kept)), exact beyond 64 bits; null for no word."""
    number = F.col(count) if isinstance(count, str) else count
    above = (number + PRIOR).cast("decimal(20,0)") * F.lit(WHOLE).cast("decimal(10,0)")
    below = (F.col(total) + PRIOR * F.col(kept)).cast("decimal(21,0)")
    return 1 + F.call_function("div", above, F.nullif(below, F.lit(0).cast("decimal(21,0)")))


def _distances(rates: pa.Table, groups: pa.Table) -> pa.Table:
    """Sums over one block of words of the differences between the rates of all sources."""
    order = np.argsort(np.array(groups.column("source").to_pylist(), dtype=object), kind="stable")
    groups = groups.take(pa.array(order))
    sources = groups.column("source").combine_chunks()
    terms = rates.column("term").combine_chunks().dictionary_encode()
    table = np.zeros((len(terms.dictionary), len(sources)), np.int64)
    table[:] = groups.column("least").fill_null(0).to_numpy()
    at = pc.index_in(rates.column("source").combine_chunks(), sources).to_numpy()
    table[terms.indices.to_numpy(), at] = rates.column("rate").to_numpy()
    sums = np.stack([np.abs(table - table[:, i : i + 1]).sum(axis=0) for i in range(len(sources))])
    mine, other = np.nonzero(~np.eye(len(sources), dtype=bool))
    lang = groups.column("lang").combine_chunks()
    return pa.table({
        "lang": lang.take(pa.array(mine)), "source": sources.take(pa.array(mine)),
        "item": sources.take(pa.array(other)), "value": pa.array(sums[mine, other]),
    })


def divergences(
    df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
    least_docs: int = 30, top: int = 50,
) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every group of language and source.

    A word is a run of ASCII letters and characters beyond ASCII, A-Z in lower case.  Each language
    keeps the V words that at least ``least_docs`` of its rows hold.  A group gives each kept word that
    occurs ``count`` times in it the rate ``1 + floor(10^9 (count + 5) / (N + 5 V))``, N the sum of its
    counts; a language does as well.  Part ``pair``: each other source of the language, with the sum of
    the differences of the rates of all kept words.  Part ``term``: the ``top`` kept words that occur in
    the group and whose rate is above the language's, with the difference.  Ranks go by value, largest
    first, then by the item's bytes.

    Null texts, languages and sources count as ''; a group without a word takes part in pairs; a
    language that keeps no word has pairs of value 0; rows that repeat count as often; a very long
    text or word is read whole; an empty table gives no rows.  Other columns are ignored."""
    counts = stored(word_counts(df, text_col, lang_col, source_col), "word-counts")
    words = counts.where(F.col("term") != "")
    kept = words.groupBy("lang", "term").agg(F.sum("n_docs").alias("docs"), F.sum("n").alias("all"))
    kept = stored(kept.where(F.col("docs") >= least_docs).drop("docs"), "kept-words")
    inside = stored(words.drop("n_docs").join(kept, ["lang", "term"]), "kept-counts")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("all").alias("lang_total"))
    totals = inside.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    every = counts.where(F.col("term") == "").select("lang", "source")
    width = every.groupBy("lang").agg(F.count(F.lit(1)).alias("n_sources"))
    groups = every.join(width, "lang").join(langs, "lang", "left").join(totals, ["lang", "source"], "left")
    groups = stored(groups.fillna(0, ["kept", "lang_total", "total"]), "word-groups")
    rated = inside.join(groups, ["lang", "source"]).withColumn("rate", _rate("n", "total", "kept"))

    above = rated.withColumn("value", F.col("rate") - _rate("all", "lang_total", "kept")).where(F.col("value") > 0)
    ranks = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = above.select("lang", "source", F.col("term").alias("item"), "value").withColumn(
        "rank", F.row_number().over(ranks)
    ).where(F.col("rank") <= top)

    # a block holds fewer words where a language has many sources
    words_of = F.greatest(F.least(F.lit(BLOCK_WORDS), F.floor(F.lit(BLOCK_RATES) / F.col("n_sources"))), F.lit(1))
    blocks = F.greatest(F.ceil(F.col("kept") / words_of), F.lit(1)).cast("int")
    dealt = rated.withColumn("block", F.pmod(F.hash("term"), blocks)).select("lang", "block", "source", "term", "rate")
    asked = groups.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))).select(
        F.col("lang").alias("lang"), F.col("block").alias("block"), F.col("source").alias("source"),
        _rate(F.lit(0).cast("bigint"), "total", "kept").alias("least"),
    )
    sums = dealt.groupBy("lang", "block").cogroup(asked.groupBy("lang", "block")).applyInArrow(
        _distances, "lang string, source string, item string, value bigint"
    )
    pairs = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).withColumn(
        "rank", F.row_number().over(ranks)
    )
    columns = ("lang", "source", "part", "item", "value", "rank")
    return pairs.withColumn("part", F.lit("pair")).select(*columns).unionByName(
        terms.withColumn("part", F.lit("term")).select(*columns)
    )
