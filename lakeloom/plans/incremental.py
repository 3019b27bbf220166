"""Incremental loading: file manifest and row high-watermarks.

Bronze: list the landing folder, keep files whose name is not in the manifest (a
left-anti join, C1), read only those (C2 by pruning), add provenance and load
columns (C3/C4), write the data as the load's own ``batch_id`` partition (B1/B3),
its rejected rows to the quarantine (B9), then append one manifest row per file (C5),
files without a good row included. The manifest is the commit log: a batch without
manifest rows does not exist for readers, and its files are loaded again.

A full refresh (C12) is one more batch whose manifest rows are marked ``full``: from the
moment they are there, readers see the last full batch of the operation type and what
came after it. A refresh that dies earlier changes nothing; old batches, and their rejects,
are removed once they can no longer be seen. The manifest also keeps the columns of each load
(B10): a bronze table is read with the columns that its loads brought since the last refresh.

Silver/gold: the high-watermark is the max of the batch's own ``ingestion_dt``
(Q7), looked up and registered under one table name (Q17). The watermark log also keeps the
generation that a table was built from, the time of its source's last full refresh: a step that
meets a newer one rebuilds its table whole. Tables kept by partition log every partition they
replace or remove under a version number; the tables behind them rebuild what was logged after
the version that they saw last, so a removal goes through as an addition does.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cache
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, LongType, StringType, StructField, StructType,
                               TimestampType)

from ..functions.keys import base_name
from ..session import ensure_checkpoint_dir
from ..sources.csv import CORRUPT_COL, ReadResult
from ..sources.files import delete_path, list_files, path_exists
from ..sources.quarantine import BROKEN_RECORD, REJECT_SCHEMA, fields_set, reject, store_rejects, stored_rejects
from ..sources.sinks import append_rows, ensure_table, open_writers, read_merged

MANIFEST_SCHEMA = StructType([
    StructField("caminho_arquivo", StringType(), True),
    StructField("nome_arquivo", StringType(), True),
    StructField("tipo_operacao", StringType(), True),
    StructField("batch_id", StringType(), True),
    StructField("data_processamento", TimestampType(), True),
    StructField("num_registros", LongType(), True),
    StructField("num_rejeitados", LongType(), True),
    StructField("modo", StringType(), True),
    StructField("tamanho", LongType(), True),
    StructField("modificado", TimestampType(), True),
    StructField("colunas", ArrayType(StringType()), True),
])

WATERMARK_SCHEMA = StructType([
    StructField("tabela", StringType(), True),
    StructField("data_ultima_transformacao", TimestampType(), True),
    StructField("total_registros", LongType(), True),
    StructField("data_processamento", TimestampType(), True),
    StructField("geracao", TimestampType(), True),
    StructField("versao_origem", LongType(), True),
])

PARTITION_LOG_SCHEMA = StructType([
    StructField("tabela", StringType(), True),
    StructField("versao", LongType(), True),
    StructField("particao", StringType(), True),
    StructField("data_processamento", TimestampType(), True),
])


FULL, INCREMENTAL = "full", "incremental"


class LoadResult(NamedTuple):
    new_files: int
    rows: int
    rejected: int = 0


def read_manifest(spark: SparkSession, manifest_path: str, tipo: str | None = None) -> DataFrame:
    """The manifest, empty when it does not exist yet, optionally one operation type."""
    m = ensure_table(spark, manifest_path, MANIFEST_SCHEMA)
    return m if tipo is None else m.filter(F.col("tipo_operacao") == F.lit(tipo))


def batch_name(run_ts: dt.datetime, tipo: str) -> str:
    """The batch of one table in one run."""
    return f"b{run_ts:%Y%m%d%H%M%S%f}-{tipo.lower()}"


def since_refresh(manifest: DataFrame) -> DataFrame:
    """The manifest rows of each operation type from its last full refresh on."""
    since = manifest.where(F.col("modo") == FULL).groupBy("tipo_operacao").agg(
        F.max("data_processamento").alias("desde"))
    return manifest.join(since, "tipo_operacao", "left").where(
        F.col("desde").isNull() | (F.col("data_processamento") >= F.col("desde"))).drop("desde")


def live_files(manifest: DataFrame) -> DataFrame:
    """The manifest rows that count: of each operation type those since its last full refresh,
    and of a file that was loaded more than once the last."""
    valid = since_refresh(manifest)
    last = valid.groupBy("tipo_operacao", "caminho_arquivo").agg(
        F.max(F.struct("data_processamento", "batch_id")).alias("ultimo"))
    return valid.join(last, ["tipo_operacao", "caminho_arquivo"]).where(
        F.struct("data_processamento", "batch_id") == F.col("ultimo")).drop("ultimo").select(
        *MANIFEST_SCHEMA.fieldNames())


def new_files(files: DataFrame, manifest: DataFrame, key: str = "name") -> DataFrame:
    """Files not yet in the manifest.

    ``key="name"`` compares bare file names (the source behaviour); ``key="version"``
    compares (name, size, modification time), so a file republished under the same
    name is loaded again and replaces its former rows (Q33). The join strategy is left
    to adaptive execution, which knows the size of the manifest in bytes.
    """
    if key == "version":
        seen = manifest.select(F.col("nome_arquivo").alias("name"), F.col("tamanho").alias("length"),
                               F.col("modificado").alias("modificationTime")).distinct()
        return files.join(seen, ["name", "length", "modificationTime"], "left_anti")
    return files.join(manifest.select(F.col("nome_arquivo").alias(key)).distinct(), key, "left_anti")


def commit_batch(spark: SparkSession, files: DataFrame, good: DataFrame, rejected: DataFrame, manifest_path: str,
                 tipo: str, batch: str, run_ts: dt.datetime, full: bool) -> LoadResult:
    """One manifest row for each file of the load, with its good and rejected rows.

    ``files`` has ``caminho_arquivo, nome_arquivo, tamanho, modificado``; ``good`` and
    ``rejected`` are what was written, with the file in ``origin_path_name`` / ``arquivo``.
    The columns of ``good`` are registered with it (B10).
    """
    columns = F.array(*[F.lit(f"{f.name}:{f.dataType.simpleString()}") for f in good.schema.fields])
    counts = (good.select(F.col("origin_path_name").alias("caminho_arquivo"), F.lit(1).alias("g"), F.lit(0).alias("r"))
              .unionByName(rejected.select(F.col("arquivo").alias("caminho_arquivo"), F.lit(0).alias("g"), F.lit(1).alias("r")))
              .groupBy("caminho_arquivo").agg(F.sum("g").cast("long").alias("g"), F.sum("r").cast("long").alias("r")))
    rows = files.join(counts, "caminho_arquivo", "left").select(
        "caminho_arquivo", "nome_arquivo", F.lit(tipo).alias("tipo_operacao"), F.lit(batch).alias("batch_id"),
        F.lit(run_ts).cast("timestamp").alias("data_processamento"),
        F.coalesce("g", F.lit(0)).cast("long").alias("num_registros"),
        F.coalesce("r", F.lit(0)).cast("long").alias("num_rejeitados"),
        F.lit(FULL if full else INCREMENTAL).alias("modo"), "tamanho", "modificado", columns.alias("colunas"))
    # Q28: the load's totals are observed on the manifest write itself, not recomputed by another job.
    obs = Observation("load")
    (rows.observe(obs, F.count(F.lit(1)).alias("f"), F.sum("num_registros").alias("n"), F.sum("num_rejeitados").alias("r"))
         .coalesce(1).write.mode("append").parquet(manifest_path))
    stats = obs.get
    return LoadResult(int(stats["f"] or 0), int(stats["n"] or 0), int(stats["r"] or 0))


def load_new_files(spark: SparkSession, landing: str, manifest_path: str, bronze_path: str,
                   reader: Callable[[list[str]], ReadResult | DataFrame], tipo: str, run_ts: dt.datetime,
                   partition_by: list[str] | None = None, glob: str | None = None,
                   full: bool = False, key: str = "name", quarantine_path: str | None = None) -> LoadResult:
    """One bronze load (C1 -> read -> C3/C4 -> B1/B3 and B9 -> C5/B8).

    ``reader`` receives the new file paths and returns good and rejected rows (see
    ``read_csv_with_quotes``), or a DataFrame of good rows alone; rejects go to ``quarantine_path``, by default beside the
    table. ``full=True`` reads every file and makes the batch the table's only one (C12).
    """
    files = list_files(spark, landing, path_glob_filter=glob)
    todo = files if full else new_files(files, live_files(read_manifest(spark, manifest_path, tipo)), key)
    listed = todo.select("path", "name", "length", "modificationTime").collect()  # file names only, no data
    paths = [r["path"] for r in listed]
    if not paths:
        return LoadResult(0, 0)
    versions = spark.createDataFrame(
        [tuple(r) for r in listed],
        "caminho_arquivo string, nome_arquivo string, tamanho long, modificado timestamp")
    batch = batch_name(run_ts, tipo)
    got = reader(paths)
    if isinstance(got, DataFrame):  # a reader that rejects nothing
        got = ReadResult(got, spark.createDataFrame([], REJECT_SCHEMA), got.columns)
    if got.mixed is not None and [c for c in got.mixed.columns if c != CORRUPT_COL] != got.ok.columns:
        got = got._replace(mixed=None)  # the reader gave its good rows columns that the scan does not have
    keys = list(partition_by or [])
    ok = got.ok if got.mixed is None else _apart(got.mixed, got.columns, keys, batch)
    if "origin_path_name" not in ok.columns:  # a reader of several layouts names the file itself
        ok = ok.select("*", F.col("_metadata.file_path").alias("origin_path_name"))
    rows = ok.select("*", base_name(F.col("origin_path_name")).alias("file_name_only"),
                     F.lit(run_ts).cast("timestamp").alias("ingestion_dt"),
                     F.lit(batch).alias("batch_id"), F.lit(tipo).alias("tipo_operacao"))
    if got.mixed is not None:
        bad = F.col(CORRUPT_COL).isNotNull()
        rows = rows.withColumns({c: F.when(bad, F.col(x)).otherwise(F.col(c)) for c, x in _REJECT_PLACES.items()}).drop(
            *_REJECT_PLACES.values())
    quarantine = quarantine_path or f"{bronze_path.rstrip('/')}_rejects"
    drop_batch(spark, bronze_path, batch)  # what a former attempt of this run left
    drop_batch(spark, bronze_path, batch + _APART)
    with open_writers(spark, LOAD_WRITERS):
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .option("compression", LOAD_CODEC).partitionBy("batch_id", *keys).parquet(bronze_path))
    stored = spark.read.schema(rows.schema).parquet(bronze_path)
    written = stored.filter(F.col("batch_id") == F.lit(batch))
    if got.mixed is None:
        rejects = store_rejects(got.rejected, quarantine, batch, REJECTS_CODEC)
    else:
        rejects = stored.filter(F.col("batch_id") == F.lit(batch + _APART)).select(*reject(
            F.col("origin_path_name"), F.col("file_name_only"), F.lit(BROKEN_RECORD), F.col("tipo_operacao")))
        store_rejects(rejects, quarantine, batch, REJECTS_CODEC)
    result = commit_batch(spark, versions, written, rejects, manifest_path, tipo, batch, run_ts, full)
    drop_batch(spark, bronze_path, batch + _APART)
    if full:
        drop_batches(spark, bronze_path, keep=batch)
        drop_batches(spark, quarantine, keep=batch)
    return result


#: A split of a yearly file holds its months and the broken lines: some 13 partitions. Sorted by partition, the rows of
#: a split (128 MB of text, ten times that as rows with their provenance) go over the disk.
LOAD_WRITERS = 32
#: Batches that were replaced or never committed stay until a full refresh, and through it.
LOAD_CODEC = "zstd"
#: Every load keeps its rejects until a full refresh, and each names its file and reason in full: a line of a
#: few characters takes some 190 bytes as plain JSON.
REJECTS_CODEC = "gzip"
#: Broken rows of a load on their way to the quarantine: a batch of their own, which no manifest names.
_APART = "-rejeitados"
_REJECT_PLACES = {"file_name_only": CORRUPT_COL, "tipo_operacao": "_delimitadores", "batch_id": "_lote"}


def _apart(mixed: DataFrame, columns: list[str], keys: list[str], batch: str) -> DataFrame:
    """Good and broken rows of one scan, so that a load parses its files once and writes them in one job.

    A broken row goes to its load's ``-rejeitados`` batch, without partition values (what stands in their
    place in a broken line is none), and takes its text and number of delimiters along in provenance columns.
    """
    bad = F.col(CORRUPT_COL).isNotNull()
    rows = mixed.select("*", F.when(bad, fields_set(columns) - 1).cast("string").alias("_delimitadores"),
                        F.lit(batch + _APART).alias("_lote"))
    return rows.withColumns({k: F.when(~bad, F.col(k)) for k in keys}) if keys else rows


def drop_batch(spark: SparkSession, path: str, batch: str) -> None:
    """Remove one batch's folder, if it is there."""
    delete_path(spark, f"{path.rstrip('/')}/batch_id={batch}")


def drop_batches(spark: SparkSession, path: str, keep: str) -> None:
    """Remove the folders of batches that a committed full refresh has replaced."""
    if not path_exists(spark, path):
        return
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if name.startswith("batch_id=") and name != f"batch_id={keep}":
            fs.delete(st.getPath(), True)


# ------------------------------------------------------------------ what readers may see

class Loads(NamedTuple):
    """What the manifest says of one operation type."""
    last: dt.datetime | None        #: the time of its last load
    generation: dt.datetime | None  #: the time of its last full refresh (C12)
    fields: list[StructField]       #: B10: every column that its loads brought since then, in the order in which they came


def loads_of(spark: SparkSession, manifest_path: str, tipo: str) -> Loads:
    """One pass over the manifest; one row a load reaches the driver, none of a file."""
    rows = read_manifest(spark, manifest_path, tipo).groupBy("data_processamento").agg(
        F.max("modo").alias("modo"), F.min("modo").alias("full"), F.first("colunas").alias("colunas")).collect()
    rows = sorted((r for r in rows if r["data_processamento"] is not None), key=lambda r: r["data_processamento"])
    refreshed = max((r["data_processamento"] for r in rows if FULL in (r["modo"], r["full"])), default=None)
    fields: dict[str, StructField] = {}
    for r in rows:
        if refreshed is None or r["data_processamento"] >= refreshed:
            for entry in r["colunas"] or []:
                name, _, kind = entry.rpartition(":")
                fields.setdefault(name.lower(), StructField(name, _data_type(kind)))
    return Loads(rows[-1]["data_processamento"] if rows else None, refreshed, list(fields.values()))


@cache
def _data_type(kind: str):
    return StructType.fromDDL(f"c {kind}")["c"].dataType


def read_bronze(spark: SparkSession, bronze_path: str, manifest_path: str, tipo: str, loads: Loads | None = None) -> DataFrame:
    """A bronze table with its registered columns: NULL where a load did not have one. No footer
    is read to find them; tables older than the registry are read with merged footers."""
    fields = (loads or loads_of(spark, manifest_path, tipo)).fields
    if not fields:
        return read_merged(spark, bronze_path)
    return spark.read.schema(StructType(fields)).parquet(bronze_path)


def committed(spark: SparkSession, bronze: DataFrame, manifest_path: str, tipo: str) -> DataFrame:
    """Bronze rows of one operation type that readers may see: the manifest is the commit log.

    A row counts if its batch is the one that the manifest names for its file. A batch left
    by a crashed run, one that a full refresh replaced and the former rows of a republished
    file have no such entry.
    """
    manifest = read_manifest(spark, manifest_path, tipo)
    live = live_files(manifest)
    named = live.select("batch_id", F.col("caminho_arquivo").alias("origin_path_name"))
    whole, mixed = _batches(manifest, live)
    if not whole:
        return bronze.join(named, ["batch_id", "origin_path_name"], "left_semi").select(*bronze.columns)
    # a batch of which every file counts is taken by its folder, without a look at the file of every row
    rows = bronze.where(F.col("batch_id").isin(whole))
    if mixed:
        rows = rows.union(bronze.where(F.col("batch_id").isin(mixed)).join(
            named, ["batch_id", "origin_path_name"], "left_semi").select(*bronze.columns))
    return rows


def _batches(manifest: DataFrame, live: DataFrame) -> tuple[list[str], list[str]]:
    """The batches whose files all count (a load commits its files together) and those of which some do;
    one row a load reaches the driver."""
    files = manifest.select("batch_id", F.lit(0).alias("live")).unionByName(live.select("batch_id", F.lit(1).alias("live")))
    rows = files.where(F.col("batch_id").isNotNull()).groupBy("batch_id").agg(
        F.count_if(F.col("live") == 0).alias("files"), F.sum("live").alias("live")).where("live > 0").collect()
    return ([r["batch_id"] for r in rows if r["live"] == r["files"]], [r["batch_id"] for r in rows if r["live"] < r["files"]])


def committed_rejects(spark: SparkSession, quarantine_path: str, manifest_path: str, tipo: str) -> DataFrame:
    """The rejects of the files that count, by the same commit log as the good rows: what a dead
    batch, a refreshed or a republished file left is not among them."""
    live = live_files(read_manifest(spark, manifest_path, tipo)).select(
        "batch_id", F.col("caminho_arquivo").alias("arquivo"))
    rejects = (stored_rejects(spark, quarantine_path) if path_exists(spark, quarantine_path)
               else spark.createDataFrame([], StructType([*REJECT_SCHEMA.fields, StructField("batch_id", StringType())])))
    return rejects.join(live, ["batch_id", "arquivo"], "left_semi").select(*REJECT_SCHEMA.fieldNames(), "batch_id")


def superseded(spark: SparkSession, bronze: DataFrame, manifest_path: str, tipo: str, after) -> DataFrame | None:
    """Bronze rows of files that came again after the time ``after``, as their former loads had them;
    None if no file came again (judged by the manifest, without reading the table)."""
    manifest = since_refresh(read_manifest(spark, manifest_path, tipo))
    again = manifest.groupBy("caminho_arquivo").agg(F.count("*").alias("n"), F.max("data_processamento").alias("d")).where(
        (F.col("n") > 1) & (F.lit(after).isNull() | (F.col("d") > F.lit(after))))
    if again.isEmpty():
        return None
    live = live_files(manifest).join(again.select("caminho_arquivo"), "caminho_arquivo", "left_semi").select(
        F.col("caminho_arquivo").alias("origin_path_name"), F.col("batch_id").alias("_live"))
    return bronze.join(live, "origin_path_name").where("batch_id <> _live").select(*bronze.columns)


def _write_observed(df: DataFrame, writer) -> int:
    """Run ``writer(df_observed)`` and return the rows written, observed during the write
    itself (Q28: no second job over the target)."""
    obs = Observation("rows")
    writer(df.observe(obs, F.count(F.lit(1)).alias("n")))
    return int(obs.get["n"] or 0)


def overwrite_touched_partitions(source: DataFrame, batch: DataFrame, keys: list[str],
                                 transform: Callable[[DataFrame], DataFrame], target_path: str) -> int:
    """Recompute and replace only the partitions (``keys`` values) a new batch touches.

    The touched key values are a small distinct set; every source row of those
    partitions is transformed again and written with dynamic partition overwrite, so
    running the step twice (after a failure) gives the same table, never duplicates.
    """
    touched = batch.select(*[F.col(k).alias(f"__t_{k}") for k in keys]).distinct()
    cond = None
    for k in keys:  # NULL-safe: rows with a NULL partition value are rebuilt too
        c = F.col(k).eqNullSafe(F.col(f"__t_{k}"))
        cond = c if cond is None else cond & c
    rows = source.join(touched, cond, "left_semi")
    return _write_observed(transform(rows), lambda d: d.write.mode("overwrite")
                           .option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(target_path))


def run_summary(manifest: DataFrame) -> DataFrame:
    """Files, rows, rejected rows and last load per operation type, ordered."""
    return (live_files(manifest).groupBy("tipo_operacao")
            .agg(F.count(F.lit(1)).alias("arquivos"), F.sum("num_registros").alias("registros"),
                 F.sum("num_rejeitados").alias("rejeitados"), F.max("data_processamento").alias("ultimo_processamento"))
            .orderBy("tipo_operacao"))


# ------------------------------------------------------------------ watermarks

class StepState(NamedTuple):
    """What a table was last built from."""
    watermark: dt.datetime | None
    generation: dt.datetime | None
    source_version: int | None


def read_state(spark: SparkSession, log_path: str, table: str) -> StepState:
    """The last registered state of ``table`` (nothing where it has none)."""
    row = (ensure_table(spark, log_path, WATERMARK_SCHEMA).filter(F.col("tabela") == F.lit(table))
           .agg(F.max("data_ultima_transformacao"), F.max("geracao"), F.max("versao_origem")).first())
    return StepState(*row)


def read_watermark(spark: SparkSession, log_path: str, table: str):
    """The last registered high-watermark of ``table`` (None when none)."""
    return read_state(spark, log_path, table).watermark


def after_watermark(df: DataFrame, wm, col: str = "ingestion_dt") -> DataFrame:
    """Rows strictly after the watermark; everything when there is none."""
    return df if wm is None else df.filter(F.col(col) > F.lit(wm))


def register_watermark(spark: SparkSession, log_path: str, table: str, batch: DataFrame,
                       run_ts: dt.datetime, col: str = "ingestion_dt", generation=None) -> None:
    """Append (table, max of the batch's ``col``, rows, run time) when the batch has rows."""
    row = (batch.agg(F.max(col).alias("wm"), F.count(F.lit(1)).alias("n"))
           .select(F.lit(table).alias("tabela"), F.col("wm").alias("data_ultima_transformacao"),
                   F.col("n").alias("total_registros"),
                   F.lit(run_ts).cast("timestamp").alias("data_processamento"),
                   F.lit(generation).cast("timestamp").alias("geracao"), F.lit(None).cast("long").alias("versao_origem")))
    row.filter(F.col("data_ultima_transformacao").isNotNull()).write.mode("append").parquet(log_path)


def register_step(spark: SparkSession, log_path: str, table: str, run_ts: dt.datetime, rows: int, state: StepState) -> None:
    """C10 where the state is known without another look at the rows."""
    append_rows(spark, log_path, [(table, state.watermark, rows, run_ts, state.generation, state.source_version)], WATERMARK_SCHEMA)


def watermark_summary(log: DataFrame) -> DataFrame:
    """Runs, rows and last transformation per table of the watermark log, ordered."""
    return (log.groupBy("tabela")
            .agg(F.count(F.lit(1)).alias("execucoes"), F.sum("total_registros").alias("registros"),
                 F.max("data_ultima_transformacao").alias("ultima_transformacao"),
                 F.max("data_processamento").alias("ultimo_processamento"))
            .orderBy("tabela"))


def process_incremental(spark: SparkSession, source: DataFrame, log_path: str, table: str,
                        transform: Callable[[DataFrame], DataFrame], target_path: str,
                        run_ts: dt.datetime, partition_by: list[str] | None = None,
                        mode: str = "append", loads: Loads | None = None) -> int:
    """Silver/gold step: C8 -> C9 -> transform -> B1 -> C10. Returns the rows written.

    ``mode="append"`` adds the new rows (event tables) as a partition named by the
    watermark that they start from (column ``desde``): a step that died between its data
    and its watermark starts from the same one again and replaces that partition.
    ``mode="overwrite"`` replaces the target with the transformed new snapshot (code
    tables); ``mode="rebuild"`` replaces it with the transform of the whole source (tables
    deduplicated across batches). The last two replace the whole table, partitions
    that no longer occur included, and only when the source holds rows after the
    watermark, so an idle run never empties a table.

    ``loads`` is what the manifest says of the source: without a load after the watermark the source
    is not read. Where the table was built before the source's last full refresh, it is replaced
    by the transform of the whole source, though nothing may be left of it (a snapshot is kept
    until a new one comes).
    """
    state = read_state(spark, log_path, table)
    wm, generation = state.watermark, loads.generation if loads else None
    if loads and wm is not None and (loads.last is None or loads.last <= wm):
        return 0
    replaced = wm is not None and generation is not None and generation != state.generation and mode != "overwrite"
    batch = after_watermark(source, wm)
    if not replaced and batch.isEmpty():
        return 0
    out = transform(source if mode == "rebuild" or replaced else batch)
    keys = list(partition_by or [])
    overwrite = "static"
    if mode == "append":
        start = f"{generation:%Y%m%d%H%M%S%f}" if replaced else "inicio" if wm is None else f"{wm:%Y%m%d%H%M%S%f}"
        out, keys = out.withColumn("desde", F.lit("w" + start)), ["desde", *keys]
        overwrite = "static" if replaced else "dynamic"

    def write(d: DataFrame) -> None:
        d.write.mode("overwrite").option("partitionOverwriteMode", overwrite).partitionBy(*keys).parquet(target_path)

    n = _write_observed(out, write)
    if replaced:  # also where the refresh left no row
        register_step(spark, log_path, table, run_ts, n, StepState(max(wm, generation), generation, None))
    else:
        register_watermark(spark, log_path, table, batch, run_ts, generation=generation)
    return n


# ------------------------------------------------------------------ tables kept by partition

def log_partitions(spark: SparkSession, log_path: str, table: str, changed: DataFrame, run_ts: dt.datetime) -> int:
    """Append the partitions that a step replaced or removed, under the table's next version; returns it."""
    version = last_version(spark, log_path, table) + 1
    (changed.select(F.lit(table).alias("tabela"), F.lit(version).cast("long").alias("versao"),
                    F.to_json(F.struct(*changed.columns), {"ignoreNullFields": "false"}).alias("particao"),
                    F.lit(run_ts).cast("timestamp").alias("data_processamento"))
     .write.mode("append").parquet(log_path))
    return version


def last_version(spark: SparkSession, log_path: str, table: str) -> int:
    """The last logged version of a table, 0 if there is none."""
    log = ensure_table(spark, log_path, PARTITION_LOG_SCHEMA).where(F.col("tabela") == table)
    return log.agg(F.max("versao")).first()[0] or 0


def partitions_since(spark: SparkSession, log_path: str, table: str, version: int, schema: StructType) -> DataFrame:
    """The partitions of ``table`` logged after ``version``, with the columns of ``schema``."""
    log = ensure_table(spark, log_path, PARTITION_LOG_SCHEMA).where((F.col("tabela") == table) & (F.col("versao") > version))
    return log.select(F.from_json("particao", schema).alias("k")).select("k.*").distinct()


def remove_partitions(spark: SparkSession, target_path: str, gone: DataFrame) -> int:
    """Delete the folders of the partitions named by the rows of ``gone`` (one row a folder: a step's
    own list, never rows of a table); returns how many were there."""
    name = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    removed = 0
    for row in gone.collect():
        folder = "/".join(name(c, None if row[c] is None else str(row[c])) for c in gone.columns)
        removed += delete_path(spark, f"{target_path.rstrip('/')}/{folder}")
    return removed


def _same(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Null-safe semi or anti join on partition columns."""
    marked = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys])
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__r_{k}"))
    return left.join(marked, cond, how)


def replace_partitions(spark: SparkSession, source: DataFrame, changed: DataFrame, keys: list[str],
                       transform: Callable[[DataFrame], DataFrame], target_path: str) -> int:
    """Make the partitions ``changed(keys)`` of the target what the source has for them: rebuilt where it
    has rows, removed where it has none. Repeating the step gives the same table."""
    n = overwrite_touched_partitions(source, changed, keys, transform, target_path)
    remove_partitions(spark, target_path, _same(changed, _same(source.select(*keys), changed, keys, "left_semi").distinct(),
                                                keys, "left_anti"))
    return n


def refresh_by_partition(spark: SparkSession, bronze: DataFrame, loads: Loads, manifest_path: str, tipo: str, log_path: str,
                         changes_path: str, table: str, keys: list[str], transform: Callable[[DataFrame], DataFrame], target_path: str,
                         run_ts: dt.datetime) -> int:
    """C8 -> C12 -> C10 for a table kept by partition; returns the rows written.

    The manifest says whether anything came since the table's watermark. After a full refresh, and
    the first time, the target is rebuilt whole. Otherwise the partitions of new rows and of rows
    whose file was published again are replaced, and those left without a row removed. What
    changed is logged for the tables behind.
    """
    state = read_state(spark, log_path, table)
    upto, now, _ = loads
    if upto is None or (state.watermark is not None and upto <= state.watermark):
        return 0
    ensure_checkpoint_dir(spark)
    live = committed(spark, bronze, manifest_path, tipo)
    if state.watermark is None or now != state.generation:
        staged = transform(live)
        places = [spark.read.schema(staged.schema).parquet(target_path)] if path_exists(spark, target_path) else []
        before = [p.select(*keys).distinct().checkpoint() for p in places]  # the target is about to be replaced
        n = _write_observed(staged, lambda d: d.write.mode("overwrite").option("partitionOverwriteMode", "static")
                            .partitionBy(*keys).parquet(target_path))
        changed = spark.read.schema(staged.schema).parquet(target_path).select(*keys)
        for p in before:
            changed = changed.union(p)
        changed = changed.distinct()
    else:
        changed = transform(after_watermark(live, state.watermark)).select(*keys)
        former = superseded(spark, bronze, manifest_path, tipo, state.watermark)
        if former is not None:
            changed = changed.union(transform(former).select(*keys))
        changed = changed.distinct().checkpoint()  # at most 12 rows a year for months
        n = replace_partitions(spark, transform(live), changed, keys, lambda d: d, target_path)
    log_partitions(spark, changes_path, table, changed, run_ts)
    register_step(spark, log_path, table, run_ts, n, StepState(upto, now, None))
    return n
