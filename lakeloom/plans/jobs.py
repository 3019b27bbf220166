"""Medallion jobs: bronze (K1-K10), silver (L1-L22) and gold (M1-M16) as functions.

Each job reads and writes parquet tables under one lake root and returns a small
status DataFrame (one row per table: status, rows, rejected rows, message), so one
failing table does not stop the others (C11). ``run_ts`` stamps every load;
``mode="full"`` is the full-refresh variant (C12). Rejected rows of every bronze load
go to ``quarantine/<table>`` (B9): accepted and rejected rows together are the rows read.
"""

from __future__ import annotations

import datetime as dt
import os
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .. import schemas as S
from ..functions import cleaning as cl
from ..operators import registry_star as rs
from ..operators import trade_star as ts
from ..operators.checks import duplicate_key_report, table_count_report
from ..operators.dedup import dedup_by_key, latest_per_key
from ..operators.layout import salted_layout
from ..session import ensure_checkpoint_dir, scratch_path
from ..sources.archives import archive_files, lines_of_archives
from ..sources.csv import (CORRUPT_COL, ReadResult, align_columns, header_columns, read_csv_with_quotes,
                           string_schema)
from ..sources.files import list_files, path_exists, route_files
from ..sources import sinks
from ..sources.records import read_csv_records
from ..sources.quarantine import BROKEN_RECORD, fields_set, reject, store_rejects
from . import incremental as inc

STATUS_SCHEMA = StructType([StructField("tabela", StringType()), StructField("status", StringType()),
                            StructField("registros", LongType()), StructField("rejeitados", LongType()),
                            StructField("mensagem", StringType())])


@dataclass(frozen=True)
class Lake:
    """Table locations under one root (a shared file system or object-store prefix)."""
    root: str

    def bronze(self, t: str) -> str:
        return os.path.join(self.root, "bronze", t)

    def quarantine(self, t: str) -> str:
        return os.path.join(self.root, "quarantine", t)

    def silver(self, t: str) -> str:
        return os.path.join(self.root, "silver", t)

    def gold(self, t: str) -> str:
        return os.path.join(self.root, "gold", t)

    @property
    def manifest(self) -> str:
        return os.path.join(self.root, "control", "manifest")

    @property
    def watermarks(self) -> str:
        return os.path.join(self.root, "control", "watermarks")

    @property
    def partitions(self) -> str:
        return os.path.join(self.root, "control", "partitions")


def _status(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows (table, status, rows, message) or (table, status, rows, rejected, message)."""
    return spark.createDataFrame([r if len(r) == 5 else (*r[:3], 0, r[3]) for r in rows], STATUS_SCHEMA)


def _guard(name: str, fn, results: list):
    """C11: run one table's step, record the outcome, never raise."""
    try:
        n = fn()
        rows, rejected = (n.rows, n.rejected) if isinstance(n, inc.LoadResult) else (int(n or 0), 0)
        results.append((name, "ok", rows, rejected, None))
    except Exception as e:  # noqa: BLE001
        results.append((name, "error", 0, 0, f"{type(e).__name__}: {e}"))


def _run_steps(steps: list[tuple[str, list[str], object]], there) -> list[tuple]:
    """C11 for tables that build on each other: steps ``(name, needs, fn)`` in order. A step whose needs are
    not there, or failed, is skipped and says which; the others run. ``there(table)`` answers for tables
    that no step makes."""
    results: list = []
    for name, needs, fn in steps:
        done = {r[0]: r[1] for r in results}
        lacking = [n for n in needs if done.get(n, "ok") != "ok" or (n not in done and not there(n))]
        if lacking:
            results.append((name, "skipped", 0, f"needs {', '.join(lacking)}"))
        else:
            _guard(name, fn, results)
    return results


def _drop_provenance(df: DataFrame) -> DataFrame:
    return df.drop(*S.PROVENANCE_COLUMNS)


# ================================================================== trade

TRADE_LOADS = [  # table, operation type, file pattern, columns, partitions
    ("exp", "EXP", "EXP_[0-9][0-9][0-9][0-9].csv", S.EXPORT_COLUMNS, ["ano", "mes"]),
    ("imp", "IMP", "IMP_[0-9][0-9][0-9][0-9].csv", S.IMPORT_COLUMNS, ["ano", "mes"]),
    ("ncm", "NCM", "NCM.csv", S.PRODUCT_COLUMNS, ["dt_ingestao"]),
]


def trade_reader(spark: SparkSession, columns: list[str], run_ts: dt.datetime, multiline: bool = False):
    """Reader of one trade file kind: fixed string columns, partition columns, rejects apart.
    ``multiline`` is for sources whose quoted fields hold line breaks; those are read in splits too."""
    def reader(paths):
        read = read_csv_records if multiline else partial(read_csv_with_quotes, multiline=False)
        got = read(spark, paths, schema=string_schema(columns))
        extra = [F.lit(run_ts.date()).alias("dt_ingestao")]
        if "CO_ANO" in columns:
            extra += [F.col("CO_ANO").try_cast("int").alias("ano"), F.col("CO_MES").try_cast("int").alias("mes")]
        return got._replace(ok=got.ok.select("*", *extra), mixed=got.mixed and got.mixed.select("*", *extra))
    return reader


def header_reader(spark: SparkSession, multiline: bool = False):
    """K4: reader of auxiliary files, each by its own header (A3): files with the same header are read
    together, a column that a file does not have is NULL in its rows."""
    def reader(paths):
        layouts: dict[tuple, list[str]] = {}
        for path in paths:  # a load's auxiliary files, a first line each
            layouts.setdefault(tuple(header_columns(spark, path)), []).append(path)
        parts = [read_csv_with_quotes(spark, group, schema=string_schema(list(names)), multiline=multiline)
                 for names, group in layouts.items()]
        if len(parts) == 1:
            return parts[0]
        names = list({c.lower(): c for part in reversed(parts) for c in reversed(part.columns)}.values())[::-1]
        named = [align_columns(p.ok.select("*", F.col("_metadata.file_path").alias("origin_path_name")),
                               [*names, "origin_path_name"]) for p in parts]
        ok, rejected = named[0], parts[0].rejected
        for more, part in zip(named[1:], parts[1:]):
            ok, rejected = ok.unionByName(more), rejected.unionByName(part.rejected)
        return ReadResult(ok, rejected, names)
    return reader


def aux_type(table: str) -> str:
    """The operation type of an auxiliary table: each is a commit log of its own."""
    return f"AUX_{table.upper()}"


def bronze_trade(spark: SparkSession, landing: str, lake: Lake, run_ts: dt.datetime,
                 mode: str = "incremental", key: str = "name", multiline: bool = False) -> DataFrame:
    """K1-K4 (+K10): exports, imports and product codes by fixed schema, partitioned by
    year/month (product codes by load date, Q14); every other CSV as an auxiliary table
    whose columns come from its header. ``key="version"`` reloads files that were
    republished under their old name (yearly files that grow)."""
    full = mode == "full"
    results: list = []
    for table, tipo, glob, cols, parts in TRADE_LOADS:
        _guard(table, lambda: inc.load_new_files(
            spark, landing, lake.manifest, lake.bronze(table), trade_reader(spark, cols, run_ts, multiline), tipo, run_ts,
            parts, glob=glob, full=full, key=key, quarantine_path=lake.quarantine(table)), results)
    routed = route_files(list_files(spark, landing)).filter(F.col("kind") == "AUX")
    reader = header_reader(spark, multiline)
    for row in routed.select("name", "table_name").distinct().collect():  # a handful of auxiliary file names
        _guard(row["table_name"], lambda row=row: inc.load_new_files(
            spark, landing, lake.manifest, lake.bronze(row["table_name"]), reader, aux_type(row["table_name"]), run_ts,
            glob=row["name"], full=full, key=key, quarantine_path=lake.quarantine(row["table_name"])), results)
    return _status(spark, results)


def silver_trade_rows(bronze: DataFrame, kind: str) -> DataFrame:
    """Typed trade rows. Product code padded to 8 like the dimension (Q35),
    country as int like the dimension (Q36), quantities as bigint (Q9)."""
    cols = [F.col("CO_ANO").try_cast("int").alias("CO_ANO"), F.col("CO_MES").try_cast("int").alias("CO_MES"),
            cl.zero_pad(F.trim("CO_NCM"), 8, truncate=False).alias("CO_NCM"), F.col("CO_UNID").alias("CO_UNID"),
            F.col("CO_PAIS").try_cast("int").alias("CO_PAIS"), F.col("SG_UF_NCM").alias("SG_UF_NCM"),
            F.col("CO_VIA").alias("CO_VIA"), F.col("CO_URF").alias("CO_URF"),
            F.col("QT_ESTAT").try_cast("bigint").alias("QT_ESTAT"),
            F.col("KG_LIQUIDO").try_cast("bigint").alias("KG_LIQUIDO"),
            cl.parse_decimal("VL_FOB").alias("VL_FOB")]
    if kind == ts.IMPORT:
        cols += [cl.parse_decimal("VL_FRETE").cast("decimal(18,4)").alias("VL_FRETE"),
                 cl.parse_decimal("VL_SEGURO").cast("decimal(18,4)").alias("VL_SEGURO")]
    cols += [F.lit(kind).alias("TIPO_OPERACAO"), F.col("ingestion_dt").alias("DATA_TRANSFORMACAO")]
    return bronze.select(*cols)


#: The columns of the two silver trade tables, as ``silver_trade_rows`` makes them.
SILVER_TRADE = {
    kind: f"CO_ANO int, CO_MES int, CO_NCM string, CO_UNID string, CO_PAIS int, SG_UF_NCM string, CO_VIA string, CO_URF string, "
          f"QT_ESTAT bigint, KG_LIQUIDO bigint, VL_FOB decimal(18,2), {more}TIPO_OPERACAO string, DATA_TRANSFORMACAO timestamp"
    for kind, more in ((ts.EXPORT, ""), (ts.IMPORT, "VL_FRETE decimal(18,4), VL_SEGURO decimal(18,4), "))}


def silver_product_codes(bronze: DataFrame) -> DataFrame:
    """L1: blanks to NULL (F5), NCM padded to 8, SH6 to 6, foreign-language names and
    unused codes dropped, provenance dropped (Q30)."""
    df = cl.whitespace_blanks_to_null_df(_drop_provenance(bronze))
    df = cl.zero_pad_df(df, {"CO_NCM": 8, "CO_SH6": 6, "CO_ISIC_CLASSE": 4, "CO_CGCE_N3": 3, "CO_FAT_AGREG": 2},
                        truncate=False)
    return df.drop(*S.PRODUCT_UNUSED)


def silver_lookup(bronze: DataFrame, pads: dict[str, int] | None = None, ints: list[str] = (),
                  drop: list[str] = ()) -> DataFrame:
    """Blanks to NULL, codes padded, integer codes typed, unused columns dropped."""
    df = cl.whitespace_blanks_to_null_df(_drop_provenance(bronze))
    if pads:
        df = cl.zero_pad_df(df, pads, truncate=False)
    for c in ints:
        if c in df.columns:
            df = df.withColumn(c, F.col(c).try_cast("int"))
    return cl.drop_columns(df, *drop)


# Code widths, integer columns and unused columns of the auxiliary source tables.
TRADE_LOOKUPS = {
    "ncm_sh": ({"CO_SH6": 6, "CO_SH4": 4, "CO_SH2": 2}, [],
               ["NO_SH6_ESP", "NO_SH6_ING", "NO_SH4_ESP", "NO_SH4_ING", "NO_SH2_ESP", "NO_SH2_ING",
                "NO_SEC_ESP", "NO_SEC_ING"]),
    "ncm_isic": ({"CO_ISIC_CLASSE": 4, "CO_ISIC_GRUPO": 3, "CO_ISIC_DIVISAO": 2}, [], []),
    "ncm_cgce": ({"CO_CGCE_N3": 3, "CO_CGCE_N2": 2, "CO_CGCE_N1": 1}, [], []),
    "ncm_fat_agreg": ({"CO_FAT_AGREG": 2}, [], ["NO_FAT_AGREG_GP"]),
    "pais": ({}, ["CO_PAIS"], []),
    "pais_bloco": ({}, ["CO_PAIS"], []),
    "uf": ({}, ["CO_UF"], []),
    "uf_mun": ({}, ["CO_MUN_GEO"], ["NO_MUN_MIN"]),
}


def silver_trade(spark: SparkSession, lake: Lake, run_ts: dt.datetime, dedup: bool = False) -> DataFrame:
    """L1-L11 (+L22): each silver table from rows after its watermark.
    ``dedup=True`` removes identical trade rows (the deduplication the source documents
    but does not do, Q27)."""
    results: list = []

    def trade(kind):
        def fn(d):
            out = silver_trade_rows(d, kind)
            if dedup:  # identical business rows, whatever batch brought them: keep the first load
                return dedup_by_key(out, [c for c in out.columns if c != "DATA_TRANSFORMACAO"],
                                    ["DATA_TRANSFORMACAO"])
            return out
        return fn

    steps = [("exp_tratado", "exp", "EXP", trade(ts.EXPORT), ["CO_ANO", "CO_MES"], "append"),
             ("imp_tratado", "imp", "IMP", trade(ts.IMPORT), ["CO_ANO", "CO_MES"], "append"),
             ("ncm_tratado", "ncm", "NCM", silver_product_codes, None, "overwrite")]  # product codes: a snapshot
    steps += [(f"{t}_tratado", t, aux_type(t), (lambda d, r=r: silver_lookup(d, *r)), None, "overwrite")
              for t, r in TRADE_LOOKUPS.items()]
    for target, source, tipo, fn, parts, mode in steps:
        if not path_exists(spark, lake.bronze(source)):
            results.append((target, "skipped", 0, "no bronze table"))
            continue
        def step(source=source, target=target, tipo=tipo, fn=fn, parts=parts, mode=mode):
            loads = inc.loads_of(spark, lake.manifest, tipo)
            bronze = inc.read_bronze(spark, lake.bronze(source), lake.manifest, tipo, loads)
            if parts:  # event tables: replace the year/month partitions that changed, remove those that emptied
                return inc.refresh_by_partition(spark, bronze, loads, lake.manifest, tipo, lake.watermarks, lake.partitions,
                                                target, parts, fn, lake.silver(target), run_ts)
            return inc.process_incremental(
                spark, inc.committed(spark, bronze, lake.manifest, tipo), lake.watermarks, target, fn, lake.silver(target),
                run_ts, None, mode, loads)

        _guard(target, step, results)
    return _status(spark, results)


TRADE_GOLD_INPUTS = ["exp_tratado", "imp_tratado", "ncm_tratado", "ncm_sh_tratado", "ncm_isic_tratado",
                     "ncm_cgce_tratado", "ncm_fat_agreg_tratado", "pais_tratado", "uf_tratado", "uf_mun_tratado"]


def gold_trade(spark: SparkSession, lake: Lake, run_ts: dt.datetime) -> DataFrame:
    """M1-M9: dimensions (overwritten), facts (the year/month partitions that silver changed are
    rebuilt, Q18/Q19), consolidated view registered, validation tables written.

    Returns the row counts of the tables. Where a silver table is missing or a step fails, the
    steps that do not need it run all the same, and a status row for each table comes back instead (C11).
    """
    missing = [t for t in TRADE_GOLD_INPUTS if not path_exists(spark, lake.silver(t))]
    lost = [(t, "skipped", 0, "silver table missing") for t in missing]
    if len(missing) == len(TRADE_GOLD_INPUTS):
        return _status(spark, lost)
    ensure_checkpoint_dir(spark)
    rd = lambda t: spark.read.parquet(lake.silver(t))
    gold = lambda t: spark.read.parquet(lake.gold(t))
    kinds = {"fato_balanca_exp": ("exp_tratado", ts.EXPORT), "fato_balanca_imp": ("imp_tratado", ts.IMPORT)}
    trade = {t: spark.read.schema(SILVER_TRADE[k]).parquet(lake.silver(t)) for t, k in kinds.values() if t not in missing}
    used = ("dim_tempo", "dim_produto", "dim_geografia")

    def build(name, make):
        return lambda: make().write.mode("overwrite").parquet(lake.gold(name))

    def star(rows, kind):
        return ts.trade_fact(rows, *map(gold, used), kind, run_ts)

    def fact(name):
        silver, kind = kinds[name]
        make = partial(star, kind=kind)
        shape = make(trade[silver].limit(0)).schema
        _refresh_fact(spark, lake, name, silver, trade[silver], make, shape, {d: gold(d) for d in used}, run_ts)

    def read_fact(name):
        silver, kind = kinds[name]
        return spark.read.schema(star(trade[silver].limit(0), kind).schema).parquet(lake.gold(name))

    def view():
        sinks.create_view(ts.consolidated(*map(read_fact, kinds)), "vw_balanca_comercial_consolidada")

    def checks():
        keys = {"dim_tempo": ["CO_ANO", "CO_MES"], "dim_produto": ["CO_NCM"], "dim_geografia": ["CO_PAIS"]}
        duplicate_key_report({d: (gold(d), k) for d, k in keys.items()}).write.mode("overwrite").parquet(
            lake.gold("check_duplicate_keys"))

    both, product = ["exp_tratado", "imp_tratado"], TRADE_GOLD_INPUTS[2:7]
    steps = [("dim_tempo", both, build("dim_tempo", lambda: ts.dim_month(*map(trade.get, both), run_ts=run_ts))),
             ("dim_produto", product, build("dim_produto", lambda: ts.dim_product(*map(rd, product), run_ts=run_ts))),
             ("dim_geografia", ["pais_tratado"], build("dim_geografia", lambda: ts.dim_geography(rd("pais_tratado"), run_ts=run_ts))),
             ("dim_localidade_br", ["uf_mun_tratado", "uf_tratado"],
              build("dim_localidade_br", lambda: ts.dim_locality(rd("uf_mun_tratado"), rd("uf_tratado"), run_ts=run_ts))),
             *[(f, [kinds[f][0], *used], partial(fact, f)) for f in kinds],
             ("vw_balanca_comercial_consolidada", list(kinds), view), ("check_duplicate_keys", list(used), checks)]
    results = _run_steps(steps, lambda t: t not in missing)
    if any(r[1] != "ok" for r in results):
        return _status(spark, lost + results)
    return table_count_report({**{d: gold(d) for d in (*used, "dim_localidade_br")}, **{f: read_fact(f) for f in kinds}})


def _refresh_fact(spark: SparkSession, lake: Lake, fact: str, silver: str, src: DataFrame, star, shape: StructType,
                  dims: dict, run_ts: dt.datetime) -> None:
    """M5/M6: a fact's months follow those that its silver table logged since the version that the fact was
    built from (Q18/Q19), and those with rows whose product or country was unknown and is known now.
    Months that silver no longer has are removed. Rebuilding whole months keeps a rerun exact."""
    keys = ["CO_ANO", "CO_MES"]
    state = inc.read_state(spark, lake.watermarks, fact)
    version = inc.last_version(spark, lake.partitions, silver)
    old = spark.read.schema(shape).parquet(lake.gold(fact)) if path_exists(spark, lake.gold(fact)) else None
    if state.source_version is None or old is None:  # never built, or before versions were kept
        touched = src.select(*keys) if old is None else src.select(*keys).union(old.select(*keys))
    else:
        touched = inc.partitions_since(spark, lake.partitions, silver, state.source_version, src.select(*keys).schema)
    if old is not None:
        for key, dim, code in (("fk_produto", "dim_produto", "CO_NCM"), ("fk_geografia", "dim_geografia", "CO_PAIS")):
            late = old.where(F.col(key).isNull()).join(dims[dim].select(code), code, "left_semi")
            touched = touched.union(late.select(*keys))
    touched = touched.distinct().checkpoint()  # the fact is about to be replaced; at most 12 rows a year
    if old is not None and touched.isEmpty():
        return
    n = inc.replace_partitions(spark, src, touched, keys, star, lake.gold(fact))
    watermark = inc.read_watermark(spark, lake.watermarks, silver)
    inc.register_step(spark, lake.watermarks, fact, run_ts, n, inc.StepState(watermark, None, version))


# ================================================================== registry

def bronze_registry(spark: SparkSession, landing: str, lake: Lake, run_ts: dt.datetime,
                    mode: str = "incremental") -> DataFrame:
    """K5-K9: every archive's members parsed quote-aware (``from_csv``) into the table of
    its group, keyed by (archive, member) (Q32), partitioned by load month ``anomes``
    (Q15: ``yyyyMM``). Rows of the wrong width go to the quarantine (Q1). Archives in the
    manifest are skipped before they are opened (C1); ``mode="full"`` reads all (C12)."""
    full = mode == "full"
    results: list = []
    for grp, (table, cols) in S.REGISTRY_GROUPS.items():
        archives = archive_files(spark, landing, group=grp)  # listing only, no archive opened
        if archives.isEmpty():
            results.append((table, "skipped", 0, "no archives for this group"))
            continue
        if not full:
            known = inc.live_files(inc.read_manifest(spark, lake.manifest, grp)).select(
                F.substring_index("caminho_arquivo", "!", 1).alias("path")).distinct()
            archives = archives.join(known, "path", "left_anti")
        _guard(table, lambda: _load_archives(spark, archives, lake, grp, table, cols, run_ts, full), results)
    return _status(spark, results)


def _load_archives(spark: SparkSession, archives: DataFrame, lake: Lake, grp: str, table: str, cols: list[str],
                   run_ts: dt.datetime, full: bool) -> inc.LoadResult:
    if archives.isEmpty():
        return inc.LoadResult(0, 0)
    ddl = ", ".join(f"`{c}` STRING" for c in [*cols, CORRUPT_COL])
    batch = inc.batch_name(run_ts, grp)
    options = {"sep": ";", "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL}
    lines = lines_of_archives(spark, archives.select("path"), quoted=True)
    parsed = lines.select(F.from_csv("line", ddl, options).alias("r"), F.concat_ws("!", "archive", "member").alias("file"),
                          F.col("member").alias("name"))
    # every line lands once, good or not; both outputs are read from there, so archives are opened once
    staged_path = scratch_path(spark, f"archives-{table}")
    parsed.write.mode("overwrite").parquet(staged_path)
    staged = spark.read.schema(parsed.schema).parquet(staged_path)
    good = staged.where(F.col(f"r.{CORRUPT_COL}").isNull()).select(
        *[F.col(f"r.{c}").alias(c) for c in cols], F.col("file").alias("origin_path_name"), F.col("name").alias("file_name_only"),
        F.lit(run_ts).cast("timestamp").alias("ingestion_dt"), F.lit(run_ts.strftime("%Y%m")).alias("anomes"),
        F.lit(batch).alias("batch_id"))
    bad = staged.where(F.col(f"r.{CORRUPT_COL}").isNotNull()).select(F.col("file"), "r.*").select(*reject(
        F.col("file"), F.col(CORRUPT_COL), F.lit(BROKEN_RECORD), fields_set(cols) - 1))
    inc.drop_batch(spark, lake.bronze(table), batch)  # what a former attempt of this run left
    (good.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id", "anomes").parquet(lake.bronze(table)))
    rejects = store_rejects(bad, lake.quarantine(table), batch)
    files = staged.select(F.col("file").alias("caminho_arquivo"), F.col("name").alias("nome_arquivo"),
                          F.lit(None).cast("long").alias("tamanho"), F.lit(None).cast("timestamp").alias("modificado")).distinct()
    written = spark.read.schema(good.schema).parquet(lake.bronze(table)).where(F.col("batch_id") == batch)
    result = inc.commit_batch(spark, files, written, rejects, lake.manifest, grp, batch, run_ts, full)
    if full:
        inc.drop_batches(spark, lake.bronze(table), keep=batch)
        inc.drop_batches(spark, lake.quarantine(table), keep=batch)
    return result


def _tidy_codes(df: DataFrame, columns: list[str]) -> DataFrame:
    """Codes keep their characters: ends stripped, blanks to NULL."""
    return cl.blanks_to_null_df(cl.strip_df(df, columns), columns)


def _newest(df: DataFrame, keys: list[str], *then: str) -> DataFrame:
    """The row of the last load per business key (I1 as intended: load time, then ``then``)."""
    return latest_per_key(df, keys, "ingestion_dt", list(then))


def silver_companies(b: DataFrame) -> DataFrame:
    """Key rules (E1, E2), newest row per company, text cleaning (F1, F2, F4) on text
    columns only (Q16), codes stripped, capital parsed as decimal (F13), keys padded (never
    cut), placeholders for missing size and federative entity (F7)."""
    codes = ["CNPJ_BASICO", "NATUREZA_JURIDICA", "QUALIFICACAO_DO_RESPONSAVEL", "CAPITAL_SOCIAL_DA_EMPRESA",
             "PORTE_DA_EMPRESA", "ENTE_FEDERATIVO_RESPONSAVEL"]
    df = _tidy_codes(b, codes).filter(cl.not_null_or_blank("CNPJ_BASICO") & cl.not_sentinel_key("CNPJ_BASICO"))
    df = cl.zero_pad_df(df, {"CNPJ_BASICO": 8, "NATUREZA_JURIDICA": 4, "QUALIFICACAO_DO_RESPONSAVEL": 2}, truncate=False)
    df = cl.clean_text_df(_drop_provenance(_newest(df, ["CNPJ_BASICO"])), ["RAZAO_SOCIAL_NOME_EMPRESARIAL"])
    df = df.withColumn("CAPITAL_SOCIAL_DA_EMPRESA", cl.parse_decimal("CAPITAL_SOCIAL_DA_EMPRESA"))
    for c in ("PORTE_DA_EMPRESA", "ENTE_FEDERATIVO_RESPONSAVEL"):
        df = df.withColumn(c, cl.null_to(F.col(c), cl.NOT_INFORMED))
    return df


def silver_establishments(b: DataFrame) -> DataFrame:
    """Key rules, newest row per establishment, contact columns dropped (real names,
    Q29), codes stripped and padded (never cut), dates parsed (F3), placeholders (F6), flags
    (F15), secondary activities padded in place (F26, no explode, Q13)."""
    df = b.drop(*S.ESTABLISHMENT_UNUSED)
    df = _tidy_codes(df, ["CNPJ_BASICO", "CNPJ_ORDEM", "CNPJ_DV", "IDENTIFICADOR_MATRIZ_FILIAL", "SITUACAO_CADASTRAL",
                          "MOTIVO_SITUACAO_CADASTRAL", "PAIS", "CNAE_FISCAL_PRINCIPAL", "CNAE_FISCAL_SECUNDARIA", "CEP",
                          "UF", "MUNICIPIO", "DATA_SITUACAO_CADASTRAL", "DT_INICIO_ATIVIDADE"])
    df = df.filter(cl.not_null_or_blank("CNPJ_BASICO") & cl.not_sentinel_key("CNPJ_BASICO"))
    df = cl.zero_pad_df(df, {"CNPJ_BASICO": 8, "CNPJ_ORDEM": 4, "CNPJ_DV": 2, "CNAE_FISCAL_PRINCIPAL": 7,
                             "MUNICIPIO": 4, "MOTIVO_SITUACAO_CADASTRAL": 2, "PAIS": 3}, truncate=False)
    df = _drop_provenance(_newest(df, ["CNPJ_BASICO", "CNPJ_ORDEM", "CNPJ_DV"]))
    df = cl.clean_text_df(df, ["NOME_FANTASIA", "NOME_CIDADE_EXTERIOR"])
    df = cl.parse_dates_df(df, ["DATA_SITUACAO_CADASTRAL", "DT_INICIO_ATIVIDADE"])
    df = df.withColumn("UF", F.upper("UF")).withColumn("NOME_FANTASIA", cl.not_informed(F.col("NOME_FANTASIA")))
    df = df.withColumn("CNAE_FISCAL_SECUNDARIA", cl.pad_list("CNAE_FISCAL_SECUNDARIA", 7))
    df = df.withColumn("CNPJ_PREFIXO", F.substring("CNPJ_BASICO", 1, 2))
    return salted_layout(rs.establishment_flags(df), "CNPJ_PREFIXO", "CNPJ_BASICO")


def silver_partners(b: DataFrame) -> DataFrame:
    """Codes stripped, newest row per (company, partner id) as in the gold dimension
    (I11/Q10: a total order), text cleaning on names, date parsing, default country (F9),
    key rules (E3)."""
    df = _tidy_codes(b, ["CNPJ_BASICO", "IDENTIFICADOR_DO_SOCIO", "CPF_CNPJ_DO_SOCIO", "QUALIFICACAO_DO_SOCIO",
                         "DATA_DE_ENTRADA_NA_SOCIEDADE", "PAIS", "FAIXA_ETARIA"])
    df = df.withColumn("CNPJ_BASICO", cl.zero_pad("CNPJ_BASICO", 8, truncate=False))
    df = df.filter(cl.key_has_length("CNPJ_BASICO", 8))
    df = _drop_provenance(_newest(df, ["CNPJ_BASICO", "IDENTIFICADOR_DO_SOCIO"], "DATA_DE_ENTRADA_NA_SOCIEDADE"))
    df = cl.clean_text_df(df, ["NOME_DO_SOCIO", "NOME_DO_REPRESENTANTE_LEGAL"])
    df = cl.parse_dates_df(df, ["DATA_DE_ENTRADA_NA_SOCIEDADE"])
    df = df.withColumn("PAIS", cl.zero_pad(cl.default_country(F.col("PAIS")), 3, truncate=False))
    return df.withColumn("QUALIFICACAO_DO_SOCIO", cl.zero_pad("QUALIFICACAO_DO_SOCIO", 2, truncate=False))


def silver_simples(b: DataFrame) -> DataFrame:
    """Options checked (E4), newest row per company by load time, then option date
    (I1 as intended), dates parsed."""
    dates = ["DATA_DE_OPCAO_PELO_SIMPLES", "DATA_DE_EXCLUSAO_DO_SIMPLES", "DATA_DE_OPCAO_PELO_MEI", "DATA_DE_EXCLUSAO_DO_MEI"]
    df = _tidy_codes(b, ["CNPJ_BASICO", "OPCAO_PELO_SIMPLES", "OPCAO_PELO_MEI", *dates])
    df = df.withColumn("CNPJ_BASICO", cl.zero_pad("CNPJ_BASICO", 8, truncate=False))
    df = cl.upper_df(df, ["OPCAO_PELO_SIMPLES", "OPCAO_PELO_MEI"])
    df = df.filter(cl.key_has_length("CNPJ_BASICO", 8) & F.col("OPCAO_PELO_SIMPLES").isin("S", "N"))
    return cl.parse_dates_df(_drop_provenance(_newest(df, ["CNPJ_BASICO"], "DATA_DE_OPCAO_PELO_SIMPLES")), dates)


def silver_codes(b: DataFrame, width: int = 4) -> DataFrame:
    """Code tables cleaned, code padded like its references (Q37, never
    cut, so no two codes become one), one row per code."""
    df = _drop_provenance(b).withColumn("CODIGO", cl.zero_pad(F.trim("CODIGO"), width, truncate=False))
    df = cl.clean_text_df(df, ["DESCRICAO"])
    return dedup_by_key(df.filter(F.col("CODIGO").isNotNull()), ["CODIGO"], ["DESCRICAO"])


REGISTRY_SILVER = {
    "empresas_tratado": ("empresas", silver_companies),
    "estabelecimentos_tratado": ("estabelecimentos", silver_establishments),
    "socios_tratado": ("socios", silver_partners),
    "simples_tratado": ("simples", silver_simples),
    "naturezas_tratado": ("naturezas", lambda b: silver_codes(b, 4)),
    "qualificacoes_tratado": ("qualificacoes", lambda b: silver_codes(b, 2)),
    "paises_tratado": ("paises", lambda b: silver_codes(b, 3)),
    "municipios_tratado": ("municipios", lambda b: silver_codes(b, 4)),
    "cnaes_tratado": ("cnaes", lambda b: silver_codes(b, 7)),
    "motivos_tratado": ("motivos", lambda b: silver_codes(b, 2)),
}


GROUP_OF = {table: grp for grp, (table, _cols) in S.REGISTRY_GROUPS.items()}
CODE_TABLES = {"naturezas_tratado", "qualificacoes_tratado", "paises_tratado", "municipios_tratado",
               "cnaes_tratado", "motivos_tratado"}


def silver_registry(spark: SparkSession, lake: Lake, run_ts: dt.datetime) -> DataFrame:
    """Registry silver tables from committed bronze batches.

    When a table's bronze has rows after its watermark, code tables are replaced by the
    new snapshot and entity tables are rebuilt from every committed batch, so their
    deduplication spans batches and a rerun after a failure gives the same table.
    """
    results: list = []
    for target, (source, fn) in REGISTRY_SILVER.items():
        if not path_exists(spark, lake.bronze(source)):
            results.append((target, "skipped", 0, "no bronze table"))
            continue
        mode = "overwrite" if target in CODE_TABLES else "rebuild"
        parts = ["salt"] if target == "estabelecimentos_tratado" else None

        def step(source=source, target=target, fn=fn, mode=mode, parts=parts):
            tipo = GROUP_OF[source]
            loads = inc.loads_of(spark, lake.manifest, tipo)
            bronze = inc.read_bronze(spark, lake.bronze(source), lake.manifest, tipo, loads)
            return inc.process_incremental(
                spark, inc.committed(spark, bronze, lake.manifest, tipo), lake.watermarks, target, fn, lake.silver(target),
                run_ts, parts, mode, loads)

        _guard(target, step, results)
    return _status(spark, results)


REGISTRY_GOLD_INPUTS = ["empresas_tratado", "estabelecimentos_tratado", "naturezas_tratado", "socios_tratado",
                        "qualificacoes_tratado", "paises_tratado"]


def gold_registry(spark: SparkSession, lake: Lake, run_ts: dt.datetime) -> DataFrame:
    """Dimensions and the company fact, partitioned by state (B3), and the analytic views. Every
    table is replaced whole: a state that lost its last company keeps no old rows.

    Returns the row counts of the tables, or a status row for each table where one could not be built (C11).
    """
    missing = [t for t in REGISTRY_GOLD_INPUTS if not path_exists(spark, lake.silver(t))]
    lost = [(t, "skipped", 0, "silver table missing") for t in missing]
    if len(missing) == len(REGISTRY_GOLD_INPUTS):
        return _status(spark, lost)
    rd = lambda t: spark.read.parquet(lake.silver(t))
    g = lambda t: spark.read.parquet(lake.gold(t))

    def build(name, make, state=None):
        def step():
            w = make().write.mode("overwrite").option("partitionOverwriteMode", "static")
            (w.partitionBy(state) if state else w).parquet(lake.gold(name))
        return step

    def est_view():
        return rs.establishment_view(g("dim_estabelecimento"), rd("estabelecimentos_tratado"))

    def view(name, make):  # M17-M19 (B12): the analytic views over the written gold tables
        def step():
            sinks.create_view(make(), name)
        return step

    def checks():
        keys = {"dim_empresa": ["CO_CNPJ_BASICO"], "dim_estabelecimento": ["CO_CNPJ_BASICO", "CO_CNPJ_ORDEM", "CO_CNPJ_DV"],
                "dim_socios_perfil": ["CO_CNPJ_BASICO", "ID_SOCIO"], "fato_estabelecimento": ["CO_CNPJ_BASICO"]}
        duplicate_key_report({t: (g(t), k) for t, k in keys.items()}).write.mode("overwrite").parquet(
            lake.gold("check_duplicate_keys"))

    comps, est, fact = "empresas_tratado", "estabelecimentos_tratado", "fato_estabelecimento"
    tables = ["dim_tempo_abertura", "dim_empresa", "dim_estabelecimento", "dim_socios_perfil", fact]
    steps = [
        ("dim_tempo_abertura", [est], build("dim_tempo_abertura", lambda: rs.dim_opening_date(rd(est), run_ts))),
        ("dim_empresa", [comps, "naturezas_tratado"],
         build("dim_empresa", lambda: rs.dim_company(rd(comps), rd("naturezas_tratado"), run_ts))),
        ("dim_estabelecimento", [est, comps],
         build("dim_estabelecimento", lambda: rs.dim_establishment(rd(est), rd(comps), run_ts), "SG_UF")),
        ("dim_socios_perfil", ["socios_tratado", "qualificacoes_tratado", "paises_tratado"],
         build("dim_socios_perfil", lambda: rs.dim_partner(rd("socios_tratado"), rd("qualificacoes_tratado"),
                                                           rd("paises_tratado"), run_ts))),
        (fact, ["dim_empresa", "dim_estabelecimento"],
         build(fact, lambda: rs.fact_establishment(g("dim_empresa"), g("dim_estabelecimento"), run_ts), "SG_UF_RESPONSAVEL")),
        ("vw_empresa_completa", [fact], view("vw_empresa_completa", lambda: rs.company_complete(g(fact), est_view()))),
        ("vw_empresa_socios_detalhado", [fact, "dim_socios_perfil"],
         view("vw_empresa_socios_detalhado", lambda: rs.company_partner(g("dim_socios_perfil"), g(fact)))),
        ("vw_empresas_por_regiao", [fact], view("vw_empresas_por_regiao", lambda: rs.region_rollup(g(fact), est_view()))),
        ("check_duplicate_keys", tables[1:], checks)]
    results = _run_steps(steps, lambda t: t not in missing)
    if any(r[1] != "ok" for r in results):
        return _status(spark, lost + results)
    return table_count_report({t: g(t) for t in tables})


GOLD_TABLES = ["dim_tempo", "dim_produto", "dim_geografia", "dim_localidade_br", "fato_balanca_exp", "fato_balanca_imp",
               "dim_tempo_abertura", "dim_empresa", "dim_estabelecimento", "dim_socios_perfil", "fato_estabelecimento"]


def register_tables(spark: SparkSession, lake: Lake, silver: str = "silver", gold: str = "gold") -> DataFrame:
    """The silver and gold tables that exist, as external tables of two databases."""
    names = {silver: (lake.silver, ["exp_tratado", "imp_tratado", "ncm_tratado", *(f"{t}_tratado" for t in TRADE_LOOKUPS),
                                    *REGISTRY_SILVER]), gold: (lake.gold, GOLD_TABLES)}
    results: list = []
    for database, (place, tables) in names.items():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        for t in tables:
            if path_exists(spark, place(t)):
                _guard(f"{database}.{t}", lambda: sinks.register_external(spark, f"`{database}`.`{t}`", place(t)), results)
    return _status(spark, results)
