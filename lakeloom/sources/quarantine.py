"""Rejected rows: one schema for every reader, one folder per table, one partition per load.

A rejected row keeps the file it came from, its raw text, a reason and how many delimiters
were found in it. A load replaces its own ``batch_id`` partition, so a retried load never
doubles its rejects, and one without rejects writes nothing but the folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from .files import delete_path

BROKEN_RECORD = "broken_record"
PACKED_ROWS = 1_000_000

REJECT_SCHEMA = StructType([
    StructField("arquivo", StringType()), StructField("linha", StringType()),
    StructField("motivo", StringType()), StructField("qt_delim", IntegerType()),
])


def reject(file: Column, raw: Column, reason: Column, delimiters: Column) -> list[Column]:
    """The columns of a rejected row."""
    return [file.alias("arquivo"), raw.alias("linha"), reason.alias("motivo"), delimiters.cast("int").alias("qt_delim")]


def fields_set(columns: list[str]) -> Column:
    """How many of the columns of a parsed row are not NULL."""
    return F.size(F.filter(F.array(*[F.col(f"`{c}`").cast("string") for c in columns]), lambda x: x.isNotNull()))


def store_rejects(rejected: DataFrame, path: str, batch: str = "single", compression: str = "none") -> DataFrame:
    """Write the rejects of one load as JSON lines, replacing that load's partition;
    returns what is stored for the load. A compressed file is read by one task, so none holds
    more than ``PACKED_ROWS`` rows."""
    delete_path(rejected.sparkSession, f"{path.rstrip('/')}/batch_id={batch}")  # a repeat may reject nothing
    w = (rejected.select(*REJECT_SCHEMA.fieldNames(), F.lit(batch).alias("batch_id"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", compression))
    w = w if compression == "none" else w.option("maxRecordsPerFile", PACKED_ROWS)
    w.partitionBy("batch_id").json(path)
    return stored_rejects(rejected.sparkSession, path).where(F.col("batch_id") == batch)


def stored_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Every stored reject with the load that brought it, dead and replaced loads included (see
    ``incremental.committed_rejects``)."""
    return spark.read.schema(StructType([*REJECT_SCHEMA.fields, StructField("batch_id", StringType())])).json(path)
