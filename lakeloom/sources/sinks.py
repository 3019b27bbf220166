"""Writers and DDL.

Writes go to parquet directories (Delta is not assumed). Overwrites of partitioned
tables use dynamic partition overwrite, so a rerun replaces the partitions it
touches instead of the whole table.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .files import path_exists


def write_table(df: DataFrame, path: str, mode: str = "append", partition_by: list[str] | None = None,
                max_records_per_file: int | None = None) -> None:
    """Append or overwrite by path, optionally Hive-partitioned."""
    w = df.write.mode(mode).format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.save(path)


@contextmanager
def open_writers(spark: SparkSession, most: int):
    """Partitioned writes inside keep up to ``most`` files a task open instead of sorting its rows by
    partition; where a task meets more partitions, Spark sorts what is left. For tasks that meet few."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def save_as_table(df: DataFrame, name: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None, path: str | None = None,
                  bucket_by: tuple[int, list[str]] | None = None) -> None:
    """Catalog table (managed, or external at ``path``).

    ``bucket_by=(n, keys)`` writes a bucketed table: two tables bucketed alike on
    their join key are joined without a shuffle (co-located join).
    """
    w = df.write.mode(mode).format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        w = w.bucketBy(bucket_by[0], *bucket_by[1]).sortBy(*bucket_by[1])
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def register_external(spark: SparkSession, name: str, path: str) -> None:
    """Catalog entry over an existing parquet directory (no-op when present);
    Hive-style partition folders are registered too."""
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source="parquet")
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)


def ensure_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table at ``path``, or an empty one with ``schema`` where there is no such path.
    A table that is there but cannot be read raises: as a control table it must not look empty."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def append_rows(spark: SparkSession, path: str, rows: list[tuple], schema: StructType) -> None:
    """Append a few control rows (a one-row DataFrame, no SQL text built by hand)."""
    spark.createDataFrame(rows, schema).write.mode("append").parquet(path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Read a table whose files carry different column sets."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def create_view(df: DataFrame, name: str) -> DataFrame:
    """(re)register a view; the DataFrame is the view's definition."""
    df.createOrReplaceTempView(name)
    return df


def rename_table(spark: SparkSession, old: str, new: str) -> None:
    """B13."""
    spark.sql(f"ALTER TABLE {old} RENAME TO {new}")
