"""Incremental file loading as Structured Streaming (the stream form of C1-C10).

The source tracks which files it has already read in its checkpoint, which
replaces the name-keyed manifest; ``trigger(availableNow=True)`` processes every
new file and stops, so the job is a scheduled batch with exactly-once bookkeeping.
``foreachBatch`` writes each micro-batch idempotently (a ``batch_id`` partition with
dynamic overwrite), so a retried batch after a lost executor replaces its own output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.keys import base_name
from ..sources.csv import CORRUPT_COL, string_schema
from ..sources.quarantine import BROKEN_RECORD, fields_set, reject, store_rejects


def csv_file_stream(spark: SparkSession, landing: str, columns: list[str], delimiter: str = ";",
                    encoding: str = "iso-8859-1", glob: str = "*.csv",
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming DataFrame over new delimited files: all-string columns, corrupt
    column (Q1), provenance (C3). Partition folders such as ``dia=...`` become columns."""
    schema: StructType = string_schema(columns, CORRUPT_COL)
    r = (spark.readStream.format("csv").schema(schema)
         .option("sep", delimiter).option("encoding", encoding).option("header", "true")
         .option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE")
         .option("columnNameOfCorruptRecord", CORRUPT_COL).option("pathGlobFilter", glob))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.load(landing)
    return df.select("*", F.col("_metadata.file_path").alias("origin_path_name"),
                     base_name(F.col("_metadata.file_path")).alias("file_name_only"))


def _batch_writer(bronze_path: str, quarantine_path: str, columns: list[str], partition_by: list[str]):
    def write(batch: DataFrame, batch_id: int) -> None:
        # parsed once: both outputs read the batch from here
        stamped = batch.withColumn("ingestion_dt", F.current_timestamp()).withColumn(
            "batch_id", F.lit(int(batch_id))).persist()
        good = stamped.filter(F.col(CORRUPT_COL).isNull()).drop(CORRUPT_COL)
        (good.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("batch_id", *partition_by).parquet(bronze_path))
        broken = stamped.filter(F.col(CORRUPT_COL).isNotNull()).select(*reject(
            F.col("origin_path_name"), F.col(CORRUPT_COL), F.lit(BROKEN_RECORD), fields_set(columns) - 1))
        store_rejects(broken, quarantine_path, f"s{int(batch_id):09d}")
        stamped.unpersist()
    return write


def load_available(spark: SparkSession, landing: str, columns: list[str], bronze_path: str,
                   checkpoint: str, partition_by: list[str] | None = None,
                   quarantine_path: str | None = None, **reader_options) -> None:
    """Run one ``availableNow`` pass: every file not yet seen by this checkpoint is
    loaded once; a second call with no new files writes nothing. Rejected rows go to
    ``quarantine_path`` (by default beside the table), one partition a micro-batch."""
    quarantine = quarantine_path or f"{bronze_path.rstrip('/')}_rejects"
    data = [c for c in columns if c not in (partition_by or [])]
    stream = csv_file_stream(spark, landing, columns, **reader_options)
    q = (stream.writeStream.foreachBatch(_batch_writer(bronze_path, quarantine, data, partition_by or []))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()

