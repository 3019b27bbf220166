"""Registered queries that go through files: CSV readers, sanitizer, archives,
file routing and the incremental loads. Each call writes its landing files (from the
driver tables) into a fresh folder under the shared checkpoint folder and returns a
DataFrame over what the readers/loaders produced."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.archives import archive_lines as read_archive_lines
from ..sources.csv import corrupt_records, read_csv_with_quotes, read_positional_csv
from ..sources.files import list_files, route_files
from ..sources.records import read_csv_records
from ..sources.sanitize import sanitize_csv
from . import fixtures as fx
from . import incremental as inc
from . import standins as si
from .catalog import register

RUN_1 = dt.datetime(2024, 1, 31, 6, 0, 0)
RUN_2 = dt.datetime(2024, 2, 1, 6, 0, 0)
RUN_3 = dt.datetime(2024, 2, 2, 6, 0, 0)
RUN_4 = dt.datetime(2024, 2, 3, 6, 0, 0)
FIRST_BATCH_LAST_DAY = "20240115"


# ------------------------------------------------------------------ quote-aware reader

@register("csv_roundtrip", """
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey,
       p_name || '; "' || p_brand || '"' || chr(10) || 'Açúcar São Paulo' AS p_name,
       p_brand, p_type, CAST(p_size AS VARCHAR) AS p_size, CAST(p_retailprice AS VARCHAR) AS p_retailprice
FROM part""")
def csv_roundtrip(spark, sf_dir):
    """Latin-1 quoted CSV (delimiters, doubled quotes and line breaks inside
    fields) read back whole; the short rows are routed away."""
    t = si.Tables(spark, sf_dir)
    folder = fx.write_quoted_part_csv(t)
    return read_csv_with_quotes(spark, folder, path_glob_filter="*.csv").ok


@register("csv_multiline", """
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey,
       p_name || '; "' || p_brand || '"' || chr(10) || 'Açúcar São Paulo' AS p_name,
       p_brand, p_type, CAST(p_size AS VARCHAR) AS p_size, CAST(p_retailprice AS VARCHAR) AS p_retailprice
FROM part
UNION ALL SELECT 'rejected', CAST(n_nationkey AS VARCHAR) || ';' || n_name, NULL, NULL, NULL, NULL FROM nation""")
def csv_multiline(spark, sf_dir):
    """A1/A2: the same files read in splits, quoted line breaks and all, with the rows that do not fit."""
    got = read_csv_records(spark, fx.write_quoted_part_csv(si.Tables(spark, sf_dir)), path_glob_filter="*.csv")
    none = [F.lit(None).cast("string").alias(c) for c in got.columns[2:]]
    return got.ok.drop("origin_path_name").unionByName(got.rejected.select(
        F.lit("rejected").alias(got.columns[0]), F.col("linha").alias(got.columns[1]), *none))


@register("csv_corrupt", """
SELECT CAST(n_nationkey AS VARCHAR) || ';' || n_name AS _corrupt_record FROM nation""")
def csv_corrupt(spark, sf_dir):
    """A2/Q1: rows with too few fields land in the corrupt set with their raw text."""
    t = si.Tables(spark, sf_dir)
    folder = fx.write_quoted_part_csv(t)
    return corrupt_records(read_csv_with_quotes(spark, folder, path_glob_filter="*.csv").rejected)


# ------------------------------------------------------------------ sanitizer

_SAN_LINES = """
WITH lines AS (
  SELECT CAST(c_custkey AS VARCHAR) || ';' || c_name || ';' || c_mktsegment || ';EXTRA' AS linha,
         3 AS qt_delim, 'bad_delimiter_count' AS motivo FROM customer
  UNION ALL
  SELECT CAST(c_custkey AS VARCHAR) || '|' || c_name || '|' || c_mktsegment, 0, 'bad_delimiter_count'
  FROM customer
  UNION ALL SELECT 'C_CUSTKEY;C_NAME;C_MKTSEGMENT', 2, 'duplicate_header' FROM nation
  UNION ALL SELECT ' c_custkey ;C_Name;  c_mktsegment', 2, 'duplicate_header' FROM region
)
SELECT linha, CAST(qt_delim AS INTEGER) AS qt_delim, motivo FROM lines"""


@register("csv_sanitized", """
SELECT CAST(c_custkey AS VARCHAR) AS C_CUSTKEY, c_name AS C_NAME, c_mktsegment AS C_MKTSEGMENT
FROM customer""")
def csv_sanitized(spark, sf_dir):
    """Header detected as the most frequent line, good lines parsed."""
    folder = fx.write_broken_customer_lines(si.Tables(spark, sf_dir))
    return sanitize_csv(spark, folder, encoding="UTF-8", path_glob_filter="part-*").clean


@register("csv_rejects", _SAN_LINES)
def csv_rejects(spark, sf_dir):
    """Rejected lines with their delimiter count and reason."""
    folder = fx.write_broken_customer_lines(si.Tables(spark, sf_dir))
    res = sanitize_csv(spark, folder, encoding="UTF-8", path_glob_filter="part-*")
    return res.rejected.select("linha", "qt_delim", "motivo")


# ------------------------------------------------------------------ archives and file routing

@register("archive_lines", """
SELECT 'Socios' AS grp, 'K3241.SOCIOCSV' AS member, CAST(s_suppkey AS VARCHAR) AS CNPJ_BASICO,
       s_name AS NOME_DO_SOCIO, CAST(s_nationkey AS VARCHAR) AS PAIS
FROM supplier""")
def archive_lines(spark, sf_dir):
    """ZIP archives extracted in parallel; member lines split positionally (A4)."""
    folder = fx.write_supplier_archives(si.Tables(spark, sf_dir))
    lines = read_archive_lines(spark, folder)
    arr = F.split("line", ";", -1)
    return lines.select("grp", "member", F.try_element_at(arr, F.lit(1)).alias("CNPJ_BASICO"),
                        F.try_element_at(arr, F.lit(2)).alias("NOME_DO_SOCIO"),
                        F.try_element_at(arr, F.lit(3)).alias("PAIS"))


@register("file_routing", """
WITH y AS (SELECT DISTINCT CAST(year(l_shipdate) AS VARCHAR) AS y FROM lineitem),
n AS (
  SELECT 'EXP_' || y || '.csv' AS name, 'EXP' AS kind FROM y
  UNION ALL SELECT 'IMP_' || y || '.csv', 'IMP' FROM y
  UNION ALL SELECT upper(r_name) || '.csv', 'AUX' FROM region
  UNION ALL SELECT 'NCM.csv', 'NCM'
  UNION ALL SELECT 'LEIAME.txt', NULL
)
SELECT name, kind, lower(regexp_replace(name, '\\.[^.]*$', '')) AS table_name FROM n""")
def file_routing(spark, sf_dir):
    """Recursive listing (content pruned) and routing by name pattern."""
    folder = fx.write_named_trade_files(si.Tables(spark, sf_dir))
    return route_files(list_files(spark, folder)).select("name", "kind", "table_name")


# ------------------------------------------------------------------ incremental loads

EVENT_COLUMNS = ["event_id", "user_id", "event_type", "value", "props"]


def _incremental_runs(spark, sf_dir, refresh=False, log=False):
    """Three bronze runs over a landing folder that grows between them (C1-C7, C13):
    days up to the 15th, then all days, then nothing new. Then a silver step twice
    (C8-C10): the second sees no rows after the watermark."""
    t = si.Tables(spark, sf_dir)
    root = scratch_path(spark, "incremental")
    landing, bronze = os.path.join(root, "landing"), os.path.join(root, "bronze")
    manifest, wm_log = os.path.join(root, "manifest"), os.path.join(root, "watermarks")
    silver = os.path.join(root, "silver")

    def reader(paths):
        got = read_csv_with_quotes(spark, paths, header=True, multiline=False)
        day = F.regexp_extract(F.col("_metadata.file_path"), r"dia=([0-9]{8})", 1).cast("int")
        return got._replace(ok=got.ok.withColumn("dia", day), mixed=got.mixed.withColumn("dia", day))

    fx.write_event_days(t, landing, None, FIRST_BATCH_LAST_DAY)
    inc.load_new_files(spark, landing, manifest, bronze, reader, "EVT", RUN_1, ["dia"], glob="*.csv")
    fx.write_event_days(t, landing, "20240116", None)
    inc.load_new_files(spark, landing, manifest, bronze, reader, "EVT", RUN_2, ["dia"], glob="*.csv")
    inc.load_new_files(spark, landing, manifest, bronze, reader, "EVT", RUN_3, ["dia"], glob="*.csv")

    def to_silver(df):
        return df.select(F.col("event_id").try_cast("bigint").alias("event_id"),
                         F.col("user_id").try_cast("bigint").alias("user_id"),
                         F.upper("event_type").alias("event_type"),
                         F.col("value").try_cast("double").alias("value"), "dia", "ingestion_dt")

    for run in (RUN_2, RUN_3):
        source = inc.committed(spark, spark.read.parquet(bronze), manifest, "EVT")
        inc.process_incremental(spark, source, wm_log, "silver_events", to_silver, silver, run)
    if refresh:
        inc.load_new_files(spark, landing, manifest, bronze, reader, "EVT", RUN_4, ["dia"], glob="*.csv", full=True)
    return (bronze, manifest, silver, wm_log) if log else (bronze, manifest, silver)


@register("incremental_rows", """
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, event_type,
       CAST(value AS VARCHAR) AS value, props, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS dia
FROM events""")
def incremental_rows(spark, sf_dir):
    """The bronze table after three runs holds every event exactly once."""
    bronze, manifest, _ = _incremental_runs(spark, sf_dir)
    return inc.committed(spark, spark.read.parquet(bronze), manifest, "EVT").select(*EVENT_COLUMNS, "dia")


@register("incremental_files", """
SELECT CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS dia, count(*) AS num_registros FROM events GROUP BY 1""")
def incremental_files(spark, sf_dir):
    """Manifest rows (one per file) summed per day folder."""
    _, manifest, _ = _incremental_runs(spark, sf_dir)
    m = inc.live_files(inc.read_manifest(spark, manifest))
    day = F.regexp_extract("caminho_arquivo", r"dia=([0-9]{8})", 1).cast("int")
    return m.groupBy(day.alias("dia")).agg(F.sum("num_registros").alias("num_registros"))


@register("run_summary", """
SELECT 'EVT' AS tipo_operacao, count(*) AS registros, CAST(0 AS BIGINT) AS rejeitados,
       TIMESTAMP '2024-02-03 06:00:00' AS ultimo_processamento,
       true AS arquivos_unicos FROM events""")
def run_summary(spark, sf_dir):
    """The summary after incremental runs and one full refresh counts every row once."""
    _, manifest, _ = _incremental_runs(spark, sf_dir, refresh=True)
    m = inc.read_manifest(spark, manifest)
    files = inc.live_files(m).agg((F.count(F.lit(1)) == F.countDistinct("caminho_arquivo")).alias("arquivos_unicos"))
    return inc.run_summary(m).select(
        "tipo_operacao", "registros", "rejeitados", F.col("ultimo_processamento").cast("timestamp_ntz")
        .alias("ultimo_processamento"), F.lit(files.first()[0]).alias("arquivos_unicos"))


@register("silver_summary", """
SELECT 'silver_events' AS tabela, CAST(1 AS BIGINT) AS execucoes, count(*) AS registros,
       TIMESTAMP '2024-02-01 06:00:00' AS ultima_transformacao FROM events""")
def silver_summary(spark, sf_dir):
    """The watermark log after two silver steps, the second of which found nothing new."""
    _, _, _, log = _incremental_runs(spark, sf_dir, log=True)
    return inc.watermark_summary(spark.read.schema(inc.WATERMARK_SCHEMA).parquet(log)).select(
        "tabela", "execucoes", "registros", F.col("ultima_transformacao").cast("timestamp_ntz").alias("ultima_transformacao"))


@register("watermark_rows", """
SELECT event_id, user_id, upper(event_type) AS event_type, value,
       CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS dia FROM events""")
def watermark_rows(spark, sf_dir):
    """The silver table after two watermark-driven runs holds each row once."""
    _, _, silver = _incremental_runs(spark, sf_dir)
    return spark.read.parquet(silver).select("event_id", "user_id", "event_type", "value", "dia")


@register("positional_shards", """
SELECT CAST(s_suppkey AS VARCHAR) AS CNPJ_BASICO, s_name AS NOME_DO_SOCIO,
       CAST(s_nationkey AS VARCHAR) AS PAIS FROM supplier""")
def positional_shards(spark, sf_dir):
    """Headerless shards matched by a glob and named by position."""
    t = si.Tables(spark, sf_dir)
    folder = scratch_path(spark, "landing-shards")
    lines = t.supplier.select(F.concat_ws(";", F.col("s_suppkey").cast("string"), "s_name",
                                          F.col("s_nationkey").cast("string")).alias("value"))
    lines.write.mode("overwrite").text(os.path.join(folder, "Socios0"))
    res = read_positional_csv(spark, os.path.join(folder, "Socios*"), ["CNPJ_BASICO", "NOME_DO_SOCIO", "PAIS"],
                              encoding="UTF-8", path_glob_filter="part-*")
    return res.ok


# ------------------------------------------------------------------ streaming form

@register("stream_rows", """
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, event_type,
       CAST(value AS VARCHAR) AS value, props, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS dia
FROM events""")
def stream_rows(spark, sf_dir):
    """C1/C2/C9 as a file stream: three availableNow passes (first half, rest, nothing
    new) load every event exactly once; the stream checkpoint is the file manifest."""
    from ..streaming.file_stream import load_available
    t = si.Tables(spark, sf_dir)
    root = scratch_path(spark, "stream")
    landing, bronze, ckpt = (os.path.join(root, p) for p in ("landing", "bronze", "checkpoint"))
    cols = EVENT_COLUMNS + ["dia"]
    fx.write_event_days(t, landing, None, FIRST_BATCH_LAST_DAY)
    load_available(spark, landing, cols, bronze, ckpt, partition_by=["dia"])
    fx.write_event_days(t, landing, "20240116", None)
    load_available(spark, landing, cols, bronze, ckpt, partition_by=["dia"])
    load_available(spark, landing, cols, bronze, ckpt, partition_by=["dia"])
    return spark.read.parquet(bronze).select(*EVENT_COLUMNS, F.col("dia").cast("int").alias("dia"))
