"""Registered queries that run the job code itself: bronze loads with their quarantine, the
silver functions of ``jobs`` over bronze-shaped rows of the driver tables, two loads each
where the newest one must win."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators.regroup import pad_and_regroup
from ..session import scratch_path
from ..sources.quarantine import stored_rejects
from . import incremental as inc
from . import jobs
from . import sqlparts as q
from . import standins as si
from .catalog import register

LOAD_1, LOAD_2 = dt.datetime(2024, 1, 31, 6), dt.datetime(2024, 2, 29, 6)


def text(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def stamped(df: DataFrame, load: dt.datetime) -> DataFrame:
    """A bronze table's provenance columns."""
    return df.select("*", F.lit(load).cast("timestamp").alias("ingestion_dt"), F.lit("f").alias("file_name_only"),
                     F.lit("p").alias("origin_path_name"), F.lit("b").alias("batch_id"), F.lit("202401").alias("anomes"))


def two_loads(first: DataFrame, second: DataFrame) -> DataFrame:
    return stamped(first, LOAD_1).unionByName(stamped(second, LOAD_2))


# ------------------------------------------------------------------ bronze: rows kept and rows rejected

def raw_exports(t: si.Tables) -> DataFrame:
    """Export rows as the text of the source files."""
    return t.lineitem.select(
        text(F.year("l_shipdate")).alias("CO_ANO"), text(F.month("l_shipdate")).alias("CO_MES"),
        text("l_partkey").alias("CO_NCM"), F.lit("10").alias("CO_UNID"), text(F.col("l_suppkey") % 25).alias("CO_PAIS"),
        F.col("l_returnflag").alias("SG_UF_NCM"), text("l_linenumber").alias("CO_VIA"), F.lit("1").alias("CO_URF"),
        text(F.col("l_quantity").cast("int")).alias("QT_ESTAT"), text("l_orderkey").alias("KG_LIQUIDO"),
        F.concat(text(F.col("l_quantity").cast("int")), F.lit(",50")).alias("VL_FOB"))


def _bronze_exports(spark, sf_dir):
    t = si.Tables(spark, sf_dir)
    landing, root = scratch_path(spark, "landing-exports"), scratch_path(spark, "exports")
    rows = raw_exports(t)
    (rows.write.option("sep", ";").option("header", "true").option("encoding", "ISO-8859-1").csv(os.path.join(landing, "good")))
    header = ";".join(S.EXPORT_COLUMNS)
    broken = t.orders.select(F.concat_ws(";", text("o_orderkey"), F.lit("short")).alias(header)).unionByName(
        t.customer.select(F.concat_ws(";", text("c_custkey"), *[F.lit("x")] * 11).alias(header)))
    (broken.write.option("sep", "\t").option("quote", "").option("header", "true").option("encoding", "ISO-8859-1")
           .csv(os.path.join(landing, "broken")))
    lake = jobs.Lake(root)
    for run in (LOAD_1, LOAD_2):  # the second run finds nothing new
        inc.load_new_files(spark, landing, lake.manifest, lake.bronze("exp"), jobs.trade_reader(spark, S.EXPORT_COLUMNS, run),
                           "EXP", run, ["ano", "mes"], glob="part-*", quarantine_path=lake.quarantine("exp"))
    return lake


_RAW_EXPORTS = """
SELECT CAST(year(l_shipdate) AS VARCHAR) AS CO_ANO, CAST(month(l_shipdate) AS VARCHAR) AS CO_MES,
       CAST(l_partkey AS VARCHAR) AS CO_NCM, '10' AS CO_UNID, CAST(l_suppkey % 25 AS VARCHAR) AS CO_PAIS,
       l_returnflag AS SG_UF_NCM, CAST(l_linenumber AS VARCHAR) AS CO_VIA, '1' AS CO_URF,
       CAST(CAST(trunc(l_quantity) AS INTEGER) AS VARCHAR) AS QT_ESTAT, CAST(l_orderkey AS VARCHAR) AS KG_LIQUIDO,
       CAST(CAST(trunc(l_quantity) AS INTEGER) AS VARCHAR) || ',50' AS VL_FOB
FROM lineitem"""


@register("bronze_trade_rows", f"""
SELECT *, CAST(CO_ANO AS INTEGER) AS ano, CAST(CO_MES AS INTEGER) AS mes FROM ({_RAW_EXPORTS})""")
def bronze_trade_rows(spark, sf_dir):
    """Export rows of a landing folder mixed with broken lines, loaded once."""
    lake = _bronze_exports(spark, sf_dir)
    return inc.committed(spark, spark.read.parquet(lake.bronze("exp")), lake.manifest, "EXP").select(
        *S.EXPORT_COLUMNS, "ano", "mes")


@register("bronze_rejects", """
SELECT CAST(o_orderkey AS VARCHAR) || ';short' AS linha, 1 AS qt_delim, 'broken_record' AS motivo FROM orders
UNION ALL
SELECT CAST(c_custkey AS VARCHAR) || repeat(';x', 11), 10, 'broken_record' FROM customer""")
def bronze_rejects(spark, sf_dir):
    """Every broken line of that load, short or long, is in the quarantine."""
    lake = _bronze_exports(spark, sf_dir)
    return stored_rejects(spark, lake.quarantine("exp")).select("linha", "qt_delim", "motivo")


# ------------------------------------------------------------------ trade silver

_SILVER_TRADE = """
SELECT CAST(CO_ANO AS INTEGER) AS CO_ANO, CAST(CO_MES AS INTEGER) AS CO_MES, {ncm} AS CO_NCM, CO_UNID,
       CAST(CO_PAIS AS INTEGER) AS CO_PAIS, SG_UF_NCM, CO_VIA, CO_URF, CAST(QT_ESTAT AS BIGINT) AS QT_ESTAT,
       CAST(KG_LIQUIDO AS BIGINT) AS KG_LIQUIDO, CAST(replace(VL_FOB, ',', '.') AS DECIMAL(18,2)) AS VL_FOB{more},
       '{kind}' AS TIPO_OPERACAO
FROM ({raw})"""


@register("silver_exports", _SILVER_TRADE.format(ncm=q.pad_nt("CO_NCM", 8), more="", kind="EXP", raw=_RAW_EXPORTS))
def silver_exports(spark, sf_dir):
    """Typed export rows."""
    return jobs.silver_trade_rows(stamped(raw_exports(si.Tables(spark, sf_dir)), LOAD_1), "EXP").drop("DATA_TRANSFORMACAO")


@register("silver_imports", _SILVER_TRADE.format(
    ncm=q.pad_nt("CO_NCM", 8), kind="IMP", raw=_RAW_EXPORTS,
    more=""", CAST(1.5 AS DECIMAL(18,4)) AS VL_FRETE, CAST(NULL AS DECIMAL(18,4)) AS VL_SEGURO"""))
def silver_imports(spark, sf_dir):
    """Typed import rows; an unparsable insurance becomes NULL."""
    raw = raw_exports(si.Tables(spark, sf_dir)).select("*", F.lit(" 1,5 ").alias("VL_FRETE"), F.lit("n/a").alias("VL_SEGURO"))
    return jobs.silver_trade_rows(stamped(raw, LOAD_1), "IMP").drop("DATA_TRANSFORMACAO")


@register("silver_products", f"""
SELECT {q.pad_nt('p_partkey', 8)} AS CO_NCM, '10' AS CO_UNID, {q.pad_nt('p_size', 6)} AS CO_SH6,
       {q.pad_nt('p_size % 7', 2)} AS CO_FAT_AGREG, CAST(NULL AS VARCHAR) AS CO_CUCI_ITEM,
       {q.pad_nt('p_size', 3)} AS CO_CGCE_N3, {q.pad_nt('p_partkey', 4)} AS CO_ISIC_CLASSE, '1' AS CO_EXP_SUBSET,
       p_name AS NO_NCM_POR
FROM part""")
def silver_products(spark, sf_dir):
    """L1: product codes without provenance; codes longer than their width keep every digit."""
    p = si.Tables(spark, sf_dir).part
    raw = p.select(text("p_partkey").alias("CO_NCM"), F.lit("10").alias("CO_UNID"), text("p_size").alias("CO_SH6"),
                   F.lit("1").alias("CO_PPE"), F.lit("1").alias("CO_PPI"), text(F.col("p_size") % 7).alias("CO_FAT_AGREG"),
                   F.lit(" \t").alias("CO_CUCI_ITEM"), text("p_size").alias("CO_CGCE_N3"), F.lit("1").alias("CO_SIIT"),
                   text("p_partkey").alias("CO_ISIC_CLASSE"), F.lit("1").alias("CO_EXP_SUBSET"),
                   F.col("p_name").alias("NO_NCM_POR"), F.lit("x").alias("NO_NCM_ESP"), F.lit("y").alias("NO_NCM_ING"))
    return jobs.silver_product_codes(stamped(raw, LOAD_1).withColumn("dt_ingestao", F.lit(LOAD_1.date())))


@register("silver_lookups", f"""
SELECT CAST(n_nationkey AS INTEGER) AS CO_MUN_GEO, n_name AS NO_MUN, CAST(n_regionkey AS VARCHAR) AS SG_UF FROM nation""")
def silver_lookups(spark, sf_dir):
    """A lookup with an integer code and a dropped column."""
    raw = si.Tables(spark, sf_dir).nation.select(
        text("n_nationkey").alias("CO_MUN_GEO"), F.col("n_name").alias("NO_MUN"), F.lower("n_name").alias("NO_MUN_MIN"),
        text("n_regionkey").alias("SG_UF"))
    return jobs.silver_lookup(stamped(raw, LOAD_1), *jobs.TRADE_LOOKUPS["uf_mun"])


# ------------------------------------------------------------------ registry silver, two loads

@register("silver_companies", f"""
SELECT {q.pad_nt('c_custkey', 8)} AS CNPJ_BASICO,
       {q.clean_text_sql("c_name || CASE WHEN c_custkey % 3 = 0 THEN ' Nova; São' ELSE '' END")} AS RAZAO_SOCIAL_NOME_EMPRESARIAL,
       {q.pad_nt('c_nationkey', 4)} AS NATUREZA_JURIDICA, '05' AS QUALIFICACAO_DO_RESPONSAVEL,
       CAST(c_nationkey * 100 + CASE WHEN c_custkey % 3 = 0 THEN 0.5 ELSE 0 END AS DECIMAL(18,2)) AS CAPITAL_SOCIAL_DA_EMPRESA,
       CASE WHEN c_custkey % 3 = 0 THEN 'NAO INFORMADO' ELSE '03' END AS PORTE_DA_EMPRESA,
       'NAO INFORMADO' AS ENTE_FEDERATIVO_RESPONSAVEL
FROM customer""")
def silver_companies(spark, sf_dir):
    """One row per company; a third of them came again in a later load with changed values."""
    c = si.Tables(spark, sf_dir).customer

    def load(df, name, capital, size):
        return df.select(F.concat(F.lit(" "), text("c_custkey"), F.lit(" ")).alias("CNPJ_BASICO"),
                         F.concat("c_name", F.lit(name)).alias("RAZAO_SOCIAL_NOME_EMPRESARIAL"),
                         text("c_nationkey").alias("NATUREZA_JURIDICA"), F.lit("5").alias("QUALIFICACAO_DO_RESPONSAVEL"),
                         F.concat(text(F.col("c_nationkey") * 100), F.lit(capital)).alias("CAPITAL_SOCIAL_DA_EMPRESA"),
                         F.lit(size).alias("PORTE_DA_EMPRESA"), F.lit(None).cast("string").alias("ENTE_FEDERATIVO_RESPONSAVEL"))
    first = load(c, "", ",00", " 03")
    sentinels = first.withColumn("CNPJ_BASICO", F.lit(" 00000000 "))  # rows that name no company
    return jobs.silver_companies(two_loads(first.unionByName(sentinels),
                                           load(c.where("c_custkey % 3 = 0"), " Nova; São", ",50", " ")))


@register("silver_establishments", f"""
WITH e AS (
  SELECT {q.pad_nt('o_custkey', 8)} AS CNPJ_BASICO, {q.pad_nt('o_orderkey', 4)} AS CNPJ_ORDEM,
         {q.pad_nt('o_orderkey % 97', 2)} AS CNPJ_DV, o_orderkey % 5 = 0 AS IS_MATRIZ,
         CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus = 'F' ELSE o_orderstatus = 'O' END AS IS_ATIVA,
         CASE WHEN o_orderkey % 2 = 0 THEN 'RJ' ELSE 'SP' END AS UF,
         CAST(o_orderdate AS DATE) AS DT_INICIO_ATIVIDADE,
         CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE '0000001,0000022' END AS CNAE_FISCAL_SECUNDARIA
  FROM orders)
SELECT e.*, CAST(coalesce(b.n, 0) AS BIGINT) AS QT_FILIAIS
FROM e LEFT JOIN (SELECT CNPJ_BASICO, count(*) AS n FROM e WHERE NOT IS_MATRIZ GROUP BY 1) b USING (CNPJ_BASICO)""")
def silver_establishments(spark, sf_dir):
    """One row per establishment and the branch count of the newest rows; half came twice."""
    o = si.Tables(spark, sf_dir).orders

    def load(df, active, uf, others):
        cols = {c: F.lit(None).cast("string") for c in S.ESTABLISHMENT_COLUMNS}
        cols |= {"CNPJ_BASICO": text("o_custkey"), "CNPJ_ORDEM": text("o_orderkey"), "CNPJ_DV": text(F.col("o_orderkey") % 97),
                 "IDENTIFICADOR_MATRIZ_FILIAL": F.when(F.col("o_orderkey") % 5 == 0, " 1").otherwise("2"),
                 "SITUACAO_CADASTRAL": F.when(F.col("o_orderstatus") == active, "02").otherwise("08"),
                 "DT_INICIO_ATIVIDADE": F.date_format("o_orderdate", "yyyyMMdd"), "UF": F.lit(uf),
                 "CNAE_FISCAL_SECUNDARIA": F.lit(others)}
        return df.select(*[v.alias(k) for k, v in cols.items()])
    out = jobs.silver_establishments(two_loads(load(o, "O", "sp", "1,22"), load(o.where("o_orderkey % 2 = 0"), "F", "rj", " ")))
    return out.select("CNPJ_BASICO", "CNPJ_ORDEM", "CNPJ_DV", "IS_MATRIZ", "IS_ATIVA", "UF", "DT_INICIO_ATIVIDADE",
                      "CNAE_FISCAL_SECUNDARIA", "QT_FILIAIS")


@register("silver_simples", f"""
SELECT {q.pad_nt('c_custkey', 8)} AS CNPJ_BASICO, CASE WHEN c_custkey % 4 = 0 THEN 'N' ELSE 'S' END AS OPCAO_PELO_SIMPLES,
       DATE '2020-01-01' AS DATA_DE_OPCAO_PELO_SIMPLES,
       CASE WHEN c_custkey % 4 = 0 THEN DATE '2024-01-31' END AS DATA_DE_EXCLUSAO_DO_SIMPLES, 'N' AS OPCAO_PELO_MEI,
       CAST(NULL AS DATE) AS DATA_DE_OPCAO_PELO_MEI, CAST(NULL AS DATE) AS DATA_DE_EXCLUSAO_DO_MEI
FROM customer WHERE c_custkey % 10 <> 9""")
def silver_simples(spark, sf_dir):
    """The newest option per company, though both loads carry the same option date."""
    c = si.Tables(spark, sf_dir).customer

    def load(df, option, end):
        return df.select(text("c_custkey").alias("CNPJ_BASICO"),
                         F.when(F.col("c_custkey") % 10 == 9, "?").otherwise(option).alias("OPCAO_PELO_SIMPLES"),
                         F.lit("20200101").alias("DATA_DE_OPCAO_PELO_SIMPLES"), F.lit(end).alias("DATA_DE_EXCLUSAO_DO_SIMPLES"),
                         F.lit("n ").alias("OPCAO_PELO_MEI"), F.lit("00000000").alias("DATA_DE_OPCAO_PELO_MEI"),
                         F.lit("").alias("DATA_DE_EXCLUSAO_DO_MEI"))
    return jobs.silver_simples(two_loads(load(c, "s", ""), load(c.where("c_custkey % 4 = 0"), "N", "20240131")))


@register("silver_partners", f"""
SELECT {q.pad_nt('s_nationkey', 8)} AS CNPJ_BASICO, CAST(s_suppkey AS VARCHAR) AS IDENTIFICADOR_DO_SOCIO,
       {q.clean_text_sql("s_name || CASE WHEN s_suppkey % 2 = 0 THEN ' Júnior' ELSE '' END")} AS NOME_DO_SOCIO,
       '***1**' AS CPF_CNPJ_DO_SOCIO, '05' AS QUALIFICACAO_DO_SOCIO,
       CASE WHEN s_suppkey % 2 = 0 THEN DATE '2021-01-01' ELSE DATE '2020-01-01' END AS DATA_DE_ENTRADA_NA_SOCIEDADE,
       CASE WHEN s_suppkey % 2 = 0 THEN '013' ELSE '105' END AS PAIS, CAST(NULL AS VARCHAR) AS FAIXA_ETARIA
FROM supplier""")
def silver_partners(spark, sf_dir):
    """The newest row per (company, partner)."""
    s = si.Tables(spark, sf_dir).supplier

    def load(df, more, day, country):
        return df.select(text("s_nationkey").alias("CNPJ_BASICO"), F.concat(F.lit(" "), text("s_suppkey")).alias("IDENTIFICADOR_DO_SOCIO"),
                         F.concat("s_name", F.lit(more)).alias("NOME_DO_SOCIO"), F.lit("***1**").alias("CPF_CNPJ_DO_SOCIO"),
                         F.lit("5").alias("QUALIFICACAO_DO_SOCIO"), F.lit(day).alias("DATA_DE_ENTRADA_NA_SOCIEDADE"),
                         F.lit(country).alias("PAIS"), F.lit(None).cast("string").alias("NOME_DO_REPRESENTANTE_LEGAL"),
                         F.lit(" ").alias("FAIXA_ETARIA"))
    out = jobs.silver_partners(two_loads(load(s, "", "20200101", " "), load(s.where("s_suppkey % 2 = 0"), " Júnior", "20210101", "13")))
    return out.drop("NOME_DO_REPRESENTANTE_LEGAL")


@register("silver_codes", f"""
SELECT {q.pad_nt('n_nationkey', 4)} AS CODIGO, {q.clean_text_sql("n_name")} AS DESCRICAO FROM nation
UNION ALL SELECT CAST(c_custkey + 10000 AS VARCHAR), {q.clean_text_sql("c_name")} FROM customer""")
def silver_codes(spark, sf_dir):
    """Padded codes, one row each; codes over the width stay apart."""
    t = si.Tables(spark, sf_dir)
    raw = t.nation.select(text("n_nationkey").alias("CODIGO"), F.col("n_name").alias("DESCRICAO")).unionByName(
        t.customer.select(text(F.col("c_custkey") + 10000).alias("CODIGO"), F.col("c_name").alias("DESCRICAO")))
    return jobs.silver_codes(stamped(raw.unionByName(raw), LOAD_1), 4)


# ------------------------------------------------------------------ regroup

@register("regroup_list", f"""
SELECT o_orderkey, o_custkey,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL
            ELSE {q.pad('o_custkey', 7)} || ',' || {q.pad('o_orderkey % 100', 7)} || ',' || {q.pad('1', 7)} END AS codes
FROM orders""")
def regroup_list(spark, sf_dir):
    """A delimited list exploded, padded and collected again in its order; rows without a list stay."""
    o = si.Tables(spark, sf_dir).orders.select("o_orderkey", "o_custkey", F.when(
        F.col("o_orderkey") % 4 != 0, F.concat_ws(",", text("o_custkey"), text(F.col("o_orderkey") % 100), F.lit("1"))).alias("codes"))
    return pad_and_regroup(o, ["o_orderkey", "o_custkey"], "codes", 7)
