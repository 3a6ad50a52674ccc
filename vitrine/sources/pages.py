"""Landed pages: files, page tables and the raw archive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.functions.times import compact_stamp
from vitrine.operators.quality import fetched


def read_page_files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Saved page files, one row per file (UTF-8), with path and a name without suffix."""
    paths = [path] if isinstance(path, str) else list(path)
    files = spark.read.text(paths, wholetext=True)
    file_path = F.col("_metadata.file_path")
    file_name = F.element_at(F.split(file_path, "/"), -1)
    return files.select(
        file_path.alias("path"),
        F.regexp_replace(F.url_decode(file_name), r"\.html?$", "").alias("name"),
        F.col("_metadata.file_modification_time").alias("fetched_at"),
        F.col("value").alias("html"),
    )


def listing_pages(landed: DataFrame, source: str) -> DataFrame:
    """Readable landed listing pages of one source."""
    return fetched(landed.where(F.col("source") == source)).select(
        "name", "url", "series_code", "page_index", "fetched_at", "html"
    )


def card_pages(landed: DataFrame, source: str) -> DataFrame:
    """Readable landed card pages of one source, keyed by language, set and number."""
    return fetched(landed.where(F.col("source") == source)).select(
        "name", "url", "lang", "set_code", "card_code", "fetched_at", "html"
    )


def archive_path(
    save_to: Column, folder: Column, name: Column, fetched_at: Column, suffix: str = ".html"
) -> Column:
    """Where a raw page belongs: the explicit path, else a name in the folder, else a stamp.

    ``suffix`` is that of stamped names.  Without path and folder a page is not kept (null).
    """
    leaf = F.coalesce(
        F.concat(F.nullif(name, F.lit("")), F.lit(".html")),
        F.concat(F.lit("page_"), compact_stamp(fetched_at), F.lit(suffix)),
    )
    return F.coalesce(
        F.nullif(save_to, F.lit("")),
        F.concat(F.regexp_replace(F.nullif(folder, F.lit("")), "/+$", ""), F.lit("/"), leaf),
    )


def latest_per_name(
    archive: DataFrame,
    name: str = "path",
    newest: Sequence[str] = ("fetched_at",),
    content: str = "html",
) -> DataFrame:
    """Current page per archive name, one row, as if each later write had replaced the file.

    Among captures of one time the largest hash of the content wins, and a time that is null comes
    before all others.  The rank is also cut before any shuffle, so a task sends one page per name
    however many captures it holds; an archive table (``ensure_archive``) is stored by name and sends
    none."""
    order = [*(F.col(c).desc_nulls_last() for c in newest), F.xxhash64(content).desc()]
    captures = Window.partitionBy(name).orderBy(*order)
    return archive.withColumn("_capture", F.row_number().over(captures)).where("_capture <= 1").drop("_capture")


def ensure_archive(spark: SparkSession, table: str, pages: T.StructType, name: str = "path", buckets: int = 64) -> None:
    """Create an archive table unless it exists: Parquet, a partition per run, dealt and sorted by
    name into buckets, so that the captures of a name lie together.  A bucket should hold what one
    task can sort."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages if f.name != "run_id")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}, run_id string) USING parquet PARTITIONED BY (run_id) "
        f"CLUSTERED BY (`{name}`) SORTED BY (`{name}`) INTO {buckets} BUCKETS"
    )


def append_archive(pages: DataFrame, table: str, run_id: str, name: str = "path") -> None:
    """Write one run's raw pages as the run's partition; a retried run replaces itself."""
    spark = pages.sparkSession
    columns = [c for c in spark.table(table).columns if c != "run_id"]
    buckets = next(r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect() if r.col_name == "Num Buckets")
    dealt = pages.select(*columns).repartition(int(buckets), name)
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION (run_id = :run) SELECT * FROM {{dealt}}", args={"run": run_id}, dealt=dealt
    )
