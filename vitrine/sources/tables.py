"""Output tables: create-if-missing, tables as folds over appended states, and repeatable loads.

A keyed table is the fold over all states written for it (``upsert.merge_states``), in plain Parquet:
every run appends the states of its own batch and reads nothing.  As the fold does not depend on order
or repetition, late runs, runs that reuse an id and retried runs lose nothing and add nothing twice.
``compact`` writes the folded states as the next generation, from which readers then start.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.operators import upsert as U

# Fixed value: default of the price history's currency column.
DEFAULTS = {"currency": "'JPY'"}


def ensure_table(
    spark: SparkSession, name: str, schema: T.StructType, partition_by: tuple[str, ...] = ()
) -> None:
    """Create a Parquet table unless it exists, with its not-null columns and defaults."""
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}"
        + ("" if f.nullable else " NOT NULL")
        + (f" DEFAULT {DEFAULTS[f.name]}" if f.name in DEFAULTS else "")
        for f in schema
    )
    layout = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{layout}")


def read_if_any(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The Parquet rows below a path, or None where nothing was written yet."""
    try:
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def staged(rows: DataFrame, root: str, name: str) -> DataFrame:
    """``rows`` as a written table of its own below ``root``; a lost executor costs a re-read of it."""
    path = f"{root}/staged/{name}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def content_id(rows: DataFrame, leave_out: Sequence[str] = ()) -> str:
    """A name for a set of rows: the same rows in any order have the same one."""
    hashes = F.xxhash64(*(c for c in rows.columns if c not in leave_out)).cast("decimal(38,0)")
    found = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(hashes).alias("h")).first()
    return f"{found['n']}-{int(found['h'] or 0) % (1 << 64):016x}"


def append_load(
    rows: DataFrame, path: str, run_id: int | str, load: str, partition_by: tuple[str, ...] = ()
) -> None:
    """Append what one run read, under the run's id and the name of its content: a retried run
    replaces itself, and another input under a used id stands beside the first."""
    rows.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/run_id={run_id}/load={load}")


def read_load(spark: SparkSession, path: str, run_id: int | str, load: str) -> DataFrame:
    return spark.read.parquet(f"{path}/run_id={run_id}/load={load}")


def generation(spark: SparkSession, path: str) -> int:
    """Number of the newest compacted generation of a keyed table, 0 before the first."""
    marks = read_if_any(spark, f"{path}/compacted", T.StructType([T.StructField("generation", T.LongType())]))
    return 0 if marks is None else marks.agg(F.max("generation")).first()[0] or 0


def append_states(states: DataFrame, path: str) -> None:
    """Add a batch's states to a keyed table; nothing stored is read or rewritten."""
    spark = states.sparkSession
    states.write.mode("append").parquet(f"{path}/states/generation={generation(spark, path)}")


def read_states(spark: SparkSession, path: str) -> DataFrame | None:
    """All states that count: those of the newest compacted generation and since."""
    states = read_if_any(spark, f"{path}/states")
    if states is None:
        return None
    return states.where(F.col("generation") >= generation(spark, path)).drop("generation")


def read_current(spark: SparkSession, path: str, schema: T.StructType, policy: U.Policy) -> DataFrame:
    """A keyed table as it stands after all runs, whatever their order; empty before the first."""
    states = read_states(spark, path)
    if states is None:
        return spark.createDataFrame([], schema)
    return U.values_of(U.merge_states(states, policy), policy).select(*schema.fieldNames())


def compact(spark: SparkSession, path: str, policy: U.Policy) -> None:
    """Fold a keyed table's states into its next generation.

    The generation counts once it is written whole and marked; until then, and if this fails, readers
    fold the older states, which gives the same table.  Not to be run while a run appends."""
    states = read_states(spark, path)
    if states is None:
        return
    following = generation(spark, path) + 1
    U.merge_states(states, policy).write.mode("overwrite").parquet(f"{path}/states/generation={following}")
    mark = spark.range(following, following + 1).select(F.col("id").alias("generation"))
    mark.coalesce(1).write.mode("append").parquet(f"{path}/compacted")


def fold_days(
    captures: DataFrame, path: str, schema: T.StructType, root: str, tie_break: Sequence[str] = ()
) -> None:
    """Fold price captures into the daily price table, a partition per day.

    Only days with a capture are read and written again, so a late capture costs its day.  The folded
    days are a written table before any day is replaced."""
    spark = captures.sparkSession
    fresh = staged(U.daily_prices(captures, tie_break), root, "days")
    stored = read_if_any(spark, path, schema)
    if stored is not None:
        days = fresh.select("captured_date").distinct()
        known = stored.join(days, "captured_date", "left_semi").select(*fresh.columns)
        fresh = staged(U.daily_prices(known.unionByName(fresh), tie_break), root, "days")
    # few files per day, and a large day in several
    writer = fresh.select(*schema.fieldNames()).hint("rebalance", "captured_date").write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy("captured_date").parquet(path)
