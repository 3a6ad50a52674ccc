"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns what it keeps, with the columns of ``documents``;
the last returns the pieces of the packed sequences.  A stage's result is written as Parquet in the
shared folder and read again as the next one's input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm import langid, packing, quality, simhash, suffix_dedup
from vitrine.llm.common import stored

#: A document goes if its quality is below this, or its fit to the likeliest language is (deviations).
QUALITY, LANGUAGE = 0.3, -2.5
#: Words of a shingle and most differing bits of near duplicates.
SHINGLE, BITS = 3, 3
#: Bytes of a repeated string, tokens of a sequence, the id that ends a document.
REPEAT, SEQUENCE, END_ID = 200, 4096, 2


def _columns(df: DataFrame, docs: DataFrame) -> DataFrame:
    return df.select(*(F.col(f"`{c}`") for c in docs.columns))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the line field, fitted on the labels of ``sf_dir``, finds to be of poor quality.

    Every row is scored on its whole text, null as empty, rows that repeat alike; nulls in other columns
    do not matter, an empty table stays empty, and all columns stay as they are."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality.predict(docs, quality.train(docs, labels))
    return _columns(scored.where(F.col("quality_score") >= QUALITY), docs)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter (null and empty ones too) and those whose grams fit none of the
    languages that the labelled rows of ``docs`` show; the fit does not depend on length.

    Rows that repeat share their fate, an empty table stays empty, a table that names no language keeps
    no row, and all columns stay as they are."""
    found = langid.predict(docs, langid.train(docs))
    return _columns(found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("lang_fit") >= LANGUAGE)), docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near duplicates: that of the least id (null last), then of the
    least hashes of its columns.

    Rows are told apart by id and content, not by id alone; of rows that are equal in all columns one
    stays.  Null and empty texts have one fingerprint and are one group; an empty table stays empty."""
    row, key = "_row_of_stage", ("_no_id", "_id", "_hash", "_seal")
    content = [F.col(f"`{c}`") for c in docs.columns]
    marks = (F.col("doc_id").isNull(), F.col("doc_id"), F.xxhash64(*content), F.xxhash64(F.lit("seal"), *content))
    marked = docs.withColumn(row, F.struct(*(m.alias(k) for m, k in zip(marks, key))))
    found = stored(simhash.near_duplicates(marked, row, "text", words=SHINGLE, bits=BITS), "near-duplicates")
    away = found.where(F.col("component_id") != F.col(row)).select(row)
    twins = found.where(F.col("component_id") == F.col(row)).groupBy(row).count().where("count > 1").select(row)
    single = marked.join(away.union(twins), row, "left_anti")
    paired = marked.join(twins, row, "left_semi").dropDuplicates([row])
    return _columns(single, docs).unionByName(_columns(paired, docs))


def repeat_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated passages out of the texts, whole characters only; counts characters again.

    Every row stays: null texts become empty, as do texts that repeat whole; an empty table stays empty
    and the other columns stay as they are."""
    cut = suffix_dedup.remove_repeats(docs, "text", REPEAT, whole_characters=True)
    return _columns(cut.withColumn("text", F.col("kept").cast("string")).withColumn("n_chars", F.length("text").cast("long")), docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every row is packed, null and empty texts as one end id, rows that repeat as often; other columns
    are ignored and an empty table has no piece."""
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=END_ID, length=SEQUENCE)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


STAGES = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("near duplicates", near_duplicate_stage),
    ("repeats", repeat_stage),
    ("packing", packing_stage),
]

#: No stage can be put in SQL; ``tests/llm`` holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
