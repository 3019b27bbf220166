"""Skew and file-layout advice.

Every advice is a one-row DataFrame computed by Spark (an aggregate over group
counts, or the byte size of a written sample), so a job can join or log it; only
the single advice row ever reaches the driver when a caller needs the number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import hash_bucket
from ..session import scratch_path

# Fixed values that must equal the source pipeline's for equal results.
# (upper bound of max/median ratio, salt buckets); at or above the last bound -> 16.
SALT_STEPS = [(1.5, 1), (2.5, 4), (4.0, 8)]
SALT_MAX = 16
DEFAULT_SAMPLE_ROWS = 200_000
FILE_MB_INCREMENTAL = 128
FILE_MB_OVERWRITE = 256
# End of fixed values.


def group_count_stats(df: DataFrame, key: str | Column) -> DataFrame:
    """H4: max and approximate median of the per-key row counts (one row).

    The per-key counts are a partial/final hash aggregate; a hot key is folded on
    the map side, so its size does not matter.
    """
    counts = df.groupBy(key).count()
    return counts.agg(F.max("count").alias("max_count"),
                      F.percentile_approx("count", 0.5).alias("median_count"))


def salt_advice(df: DataFrame, key: str | Column) -> DataFrame:
    """``max/median`` of group sizes -> 1, 4, 8 or 16 salt buckets (median 0 -> 1)."""
    stats = group_count_stats(df, key)
    ratio = F.col("max_count") / F.col("median_count")
    salt = F.lit(SALT_MAX)
    for bound, n in reversed(SALT_STEPS):
        salt = F.when(ratio < F.lit(bound), F.lit(n)).otherwise(salt)
    salt = F.when(F.coalesce(F.col("median_count"), F.lit(0)) == 0, F.lit(1)).otherwise(salt)
    return stats.select("max_count", "median_count",
                        F.when(F.col("median_count") > 0, ratio).alias("ratio"),
                        salt.cast("int").alias("salt"))


def add_salt(df: DataFrame, key: str | Column, n: int, name: str = "salt") -> DataFrame:
    """Salt column in [0, n); 0 everywhere when n == 1."""
    return df.withColumn(name, hash_bucket(key, n))


def repartition_by_salt(df: DataFrame, key: str, n: int, partitions: int | None = None,
                        spread: list[str] | None = None) -> DataFrame:
    """Hash-partition on (key, salt), where the salt comes from the ``spread`` columns (by
    default all but the key): a function of the key itself would leave a hot key whole."""
    columns = spread or [c for c in df.columns if c != key]
    salt = F.lit(0) if n <= 1 else F.pmod(F.xxhash64(*columns), F.lit(n)).cast("int")
    salted = df.withColumn("salt", salt)
    return salted.repartition(partitions, key, "salt") if partitions else salted.repartition(key, "salt")


def estimate_row_bytes(df: DataFrame, sample_rows: int = DEFAULT_SAMPLE_ROWS,
                       spark: SparkSession | None = None) -> DataFrame:
    """Write a ``sample_rows`` head as snappy parquet to a fresh shared
    folder; average bytes per row from the written files' sizes (binaryFile ``length``).

    The sample is the feature (the source sizes files from a 200k-row head).
    """
    spark = spark or df.sparkSession
    path = scratch_path(spark, "rowsize")
    sample = df.limit(sample_rows)
    sample.coalesce(1).write.mode("overwrite").option("compression", "snappy").parquet(path)
    # Bytes of the written files and rows of the sample, folded in one aggregate.
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
             .select(F.col("length").alias("b"), F.lit(0).cast("long").alias("r")))
    rows = spark.read.parquet(path).select(F.lit(0).cast("long").alias("b"), F.lit(1).cast("long").alias("r"))
    both = files.unionByName(rows).agg(F.coalesce(F.sum("b"), F.lit(0)).alias("sample_bytes"),
                                       F.coalesce(F.sum("r"), F.lit(0)).alias("sample_rows"))
    return both.select(
        "sample_bytes", "sample_rows",
        F.when(F.col("sample_rows") > 0, F.col("sample_bytes") / F.col("sample_rows"))
         .otherwise(F.lit(0.0)).alias("avg_row_bytes"))


def partition_advice(df: DataFrame, desired_file_mb: int = FILE_MB_INCREMENTAL,
                     sample_rows: int = DEFAULT_SAMPLE_ROWS) -> DataFrame:
    """``max(1, floor(rows * avg_row_bytes / target))`` partitions, one row.

    The one-row size estimate and the row count are folded in one aggregate over
    their union (no join needed).
    """
    est = estimate_row_bytes(df, sample_rows).select(
        F.col("avg_row_bytes").alias("a"), F.lit(0).cast("long").alias("n"))
    ones = df.select(F.lit(None).cast("double").alias("a"), F.lit(1).cast("long").alias("n"))
    agg = ones.unionByName(est).agg(F.max("a").alias("avg_row_bytes"),
                                    F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"))
    target = float(desired_file_mb) * 1024 * 1024
    total_bytes = F.col("total_rows") * F.col("avg_row_bytes")
    return agg.select(
        "avg_row_bytes", "total_rows",
        (total_bytes / (1024 * 1024)).alias("total_mb_estimated"),
        F.lit(desired_file_mb).alias("desired_file_mb"),
        F.greatest(F.lit(1), F.floor(total_bytes / F.lit(target))).cast("int")
         .alias("recommended_partitions"))


def salted_layout(df: DataFrame, group_col: str, key_col: str) -> DataFrame:
    """J1 + J4 + J5 for a write: salt buckets advised from the skew of ``group_col``
    (one advice row reaches the driver), a ``salt`` column from ``key_col``, and an AQE
    rebalance on (group, salt) so output files are cut to the advisory size instead of
    one file per hot group."""
    n = salt_advice(df, group_col).first()["salt"]
    return add_salt(df, key_col, int(n or 1)).hint("rebalance", group_col, "salt")
