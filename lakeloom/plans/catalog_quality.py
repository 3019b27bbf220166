"""Registered queries for cleaning helpers, predicates, dedup, checks and layout advice."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cleaning as cl
from ..functions.cleaning import ACCENTED, UNACCENTED
from ..operators import dedup as dd
from ..operators import layout as lo
from ..operators import trade_star as ts
from . import sqlparts as q
from . import standins as si
from .catalog import build_dims, build_facts, build_registry, register

# Spark's ``\s`` (ASCII whitespace incl. \x0B) written out for DuckDB's RE2.
_KEEP = r"'[^a-zA-Z0-9 \t\n\x0B\f\r]'"


def _accents_sql(expr: str) -> str:
    return f"regexp_replace(translate({expr}, '{ACCENTED}', '{UNACCENTED}'), {_KEEP}, '', 'g')"


# ------------------------------------------------------------------ text cleaning

@register("clean_text", f"""
SELECT doc_id,
       upper(CASE WHEN trim({_accents_sql('trim(text)')}) = '' THEN NULL ELSE {_accents_sql('trim(text)')} END)
         AS text_clean,
       CASE WHEN regexp_matches(source, '^[ \\t\\n\\x0B\\f\\r]*$') THEN NULL ELSE source END AS source_clean,
       trim(lang) AS lang_clean
FROM documents""")
def clean_text(spark, sf_dir):
    """F1, F2, F4, F5, F11 over whole documents."""
    d = si.Tables(spark, sf_dir).documents.select("doc_id", F.col("text").alias("text_clean"),
                                                  F.col("source").alias("source_clean"),
                                                  cl.strip("lang").alias("lang_clean"))
    cleaned = cl.clean_text_df(d, ["text_clean"])
    return cleaned.withColumn("source_clean", cl.whitespace_blank_to_null("source_clean"))


@register("charset_repair", "SELECT doc_id, text AS repaired, text AS kept FROM documents")
def charset_repair(spark, sf_dir):
    """every document double-encoded (UTF-8 bytes read as Latin-1) and repaired;
    the untouched text run through the same repair must stay as it is."""
    d = si.Tables(spark, sf_dir).documents
    # the double-encoded text is its own projection, so the repair reads it once per row
    broken = d.select("doc_id", "text", F.decode(F.encode("text", "UTF-8"), "ISO-8859-1").alias("mojibake"))
    return broken.select("doc_id", cl.repair_double_encoding(F.col("mojibake")).alias("repaired"),
                         cl.repair_double_encoding(F.col("text")).alias("kept"))


@register("placeholder_fill", f"""
SELECT {q.pad_nt('c_custkey', 8)} AS CNPJ_BASICO,
       CASE WHEN c_mktsegment IS NULL OR trim(c_mktsegment) = '' OR trim(c_mktsegment) IN ('0', 'MACHINERY')
            THEN 'NAO INFORMADO' ELSE c_mktsegment END AS PORTE,
       coalesce(CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END, 'SEM SALDO') AS SEGMENTO_ATIVO,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(c_nationkey AS VARCHAR) END AS PAIS_BRUTO,
       CASE WHEN c_acctbal < 0 OR trim(CAST(c_nationkey AS VARCHAR)) = ''
              OR lower(trim(CAST(c_nationkey AS VARCHAR))) = 'null'
            THEN '105' ELSE CAST(c_nationkey AS VARCHAR) END AS PAIS,
       coalesce(CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(c_nationkey AS BIGINT) END, 0) AS PAIS_NUM
FROM customer""")
def placeholder_fill(spark, sf_dir):
    """F6 (targets + '0' + blanks), F7 (coalesce), F9 (default country), F8 (fillna)."""
    c = si.Tables(spark, sf_dir).customer
    in_credit = F.col("c_acctbal") >= 0
    raw_country = F.when(in_credit, F.col("c_nationkey").cast("string"))
    out = c.select(
        cl.zero_pad(F.col("c_custkey"), 8, truncate=False).alias("CNPJ_BASICO"),
        cl.not_informed(F.col("c_mktsegment"), ["MACHINERY"]).alias("PORTE"),
        cl.null_to(F.when(in_credit, F.col("c_mktsegment")), "SEM SALDO").alias("SEGMENTO_ATIVO"),
        raw_country.alias("PAIS_BRUTO"),
        cl.default_country(raw_country).alias("PAIS"),
        F.when(in_credit, F.col("c_nationkey").cast("bigint")).alias("PAIS_NUM"))
    return cl.fill_null(out, 0, ["PAIS_NUM"])


@register("parse_dates", f"""
SELECT o_orderkey,
       CAST(try_strptime(strftime(o_orderdate, '%Y%m%d'), '%Y%m%d') AS DATE) AS DT_PEDIDO,
       CAST(try_strptime(CAST(year(o_orderdate) AS VARCHAR) || '0229', '%Y%m%d') AS DATE) AS DT_29_FEV,
       CAST(try_strptime(CASE WHEN o_orderstatus = 'O' THEN '00000000' ELSE '0' END, '%Y%m%d') AS DATE)
         AS DT_SENTINELA,
       {q.pad_nt('o_custkey', 8)} IS NOT NULL AND length({q.pad_nt('o_custkey', 8)}) = 8 AS CHAVE_OK
FROM orders""")
def parse_dates(spark, sf_dir):
    """F3 on valid, impossible (Feb 29 of common years) and sentinel dates; E3 key length."""
    o = si.Tables(spark, sf_dir).orders
    key = cl.zero_pad(F.col("o_custkey"), 8, truncate=False)
    return o.select(
        "o_orderkey",
        cl.parse_date(F.date_format("o_orderdate", "yyyyMMdd")).alias("DT_PEDIDO"),
        cl.parse_date(F.concat(F.year("o_orderdate").cast("string"), F.lit("0229"))).alias("DT_29_FEV"),
        cl.parse_date(F.when(F.col("o_orderstatus") == "O", F.lit("00000000")).otherwise(F.lit("0")))
          .alias("DT_SENTINELA"),
        cl.key_has_length(key, 8).alias("CHAVE_OK"))


@register("parse_decimal", """
SELECT c_custkey, TRY_CAST(c_acctbal AS DECIMAL(18,2)) AS VL_CAPITAL,
       CAST(NULL AS DECIMAL(18,2)) AS VL_INVALIDO
FROM customer""")
def parse_decimal(spark, sf_dir):
    """the balance written with a decimal comma and read back; names never parse."""
    c = si.Tables(spark, sf_dir).customer
    text = F.replace(c.c_acctbal.try_cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(","))
    return c.select("c_custkey", cl.parse_decimal(text).alias("VL_CAPITAL"),
                    cl.parse_decimal(F.col("c_name")).alias("VL_INVALIDO"))


@register("pad_list", """
SELECT l_orderkey, l_linenumber,
       array_to_string(list_transform(string_split(CAST(l_partkey AS VARCHAR) || ',' || CAST(l_suppkey AS VARCHAR)
         || ',' || CAST(l_linenumber AS VARCHAR), ','), lambda x: lpad(x, 7, '0')), ',') AS CNAE_SECUNDARIA
FROM lineitem""")
def pad_list(spark, sf_dir):
    """a delimited code list padded element-wise in place (no explode, no regroup)."""
    li = si.Tables(spark, sf_dir).lineitem
    raw = F.concat_ws(",", "l_partkey", "l_suppkey", "l_linenumber")
    return li.select("l_orderkey", "l_linenumber", cl.pad_list(raw, 7).alias("CNAE_SECUNDARIA"))


# ------------------------------------------------------------------ predicates

@register("row_filters", f"""
SELECT {q.pad_nt('c_custkey', 8)} AS CNPJ_BASICO, c_name, c_mktsegment
FROM customer
WHERE c_name IS NOT NULL AND c_name <> '' AND c_name <> ' '
  AND c_mktsegment IS NOT NULL AND c_mktsegment <> '' AND c_mktsegment <> ' '
  AND {q.pad_nt('c_custkey', 8)} <> '00000000'
  AND c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD')
  AND NOT regexp_matches(c_name, '^[ \\t\\n\\x0B\\f\\r]*$')""")
def row_filters(spark, sf_dir):
    """E1 (not NULL/blank), E2 (sentinel key), E4 (isin), E10 (regex blank)."""
    c = si.Tables(spark, sf_dir).customer
    out = c.select(cl.zero_pad(F.col("c_custkey"), 8, truncate=False).alias("CNPJ_BASICO"),
                   "c_name", "c_mktsegment")
    return out.filter(cl.not_null_or_blank("c_name", "c_mktsegment")
                      & cl.not_sentinel_key("CNPJ_BASICO")
                      & F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD")
                      & ~cl.is_blank_regex("c_name"))


# ------------------------------------------------------------------ dedup

@register("dedup_rows", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def dedup_rows(spark, sf_dir):
    """Full-row dedup of the key projection."""
    return dd.distinct_rows(si.Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber"))


@register("dedup_key", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_partkey NULLS FIRST, l_suppkey NULLS FIRST, l_quantity NULLS FIRST) = 1""")
def dedup_key(spark, sf_dir):
    """I11 with a total order (Q10): one line per (order, line number)."""
    li = si.Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_partkey",
                                                  "l_suppkey", "l_quantity")
    return dd.dedup_by_key(li, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"])


@register("latest_per_key", """
SELECT user_id, event_id, ts, event_type, value, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST,
        event_type DESC NULLS LAST, value DESC NULLS LAST, props DESC NULLS LAST) = 1""")
def latest_per_key(spark, sf_dir):
    """I1 as intended: newest event per user (aggregate form, skew-safe)."""
    ev = si.Tables(spark, sf_dir).events.select("user_id", "event_id", "ts", "event_type", "value", "props")
    return dd.latest_per_key(ev, ["user_id"], "ts", ["event_id"])


@register("key_distribution", f"""
SELECT substring({q.pad_nt('c_custkey', 8)}, 1, 5) AS prefixo, count(*) AS qt_empresas
FROM customer GROUP BY 1""")
def key_distribution(spark, sf_dir):
    """Companies per key prefix (distribution check)."""
    c = si.Tables(spark, sf_dir).customer
    key = cl.zero_pad(F.col("c_custkey"), 8, truncate=False)
    return (c.groupBy(F.substring(key, 1, 5).alias("prefixo")).count()
            .withColumnRenamed("count", "qt_empresas"))


# ------------------------------------------------------------------ typed contract

@register("typed_contract", """
SELECT TRY_CAST(CAST(l_orderkey AS VARCHAR) AS BIGINT) AS CO_PEDIDO,
       TRY_CAST(CAST(l_linenumber AS VARCHAR) AS INTEGER) AS NU_LINHA,
       TRY_CAST(CAST(l_quantity AS VARCHAR) AS DOUBLE) AS QT_ESTAT,
       TRY_CAST(CAST(l_extendedprice AS VARCHAR) AS DECIMAL(18,2)) AS VL_FOB,
       TRY_CAST(substring(CAST(l_shipdate AS VARCHAR), 1, 10) AS DATE) AS DT_EMBARQUE,
       l_returnflag AS CO_FLAG,
       'EXP' AS TIPO_OPERACAO
FROM lineitem""")
def typed_contract(spark, sf_dir):
    """All-string bronze rows typed into the silver contract."""
    li = si.Tables(spark, sf_dir).lineitem
    names = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate", "l_returnflag"]
    bronze = li.select(*names).toDF(*[n.upper() for n in names])                       # D7
    bronze = bronze.select([F.col(c).cast("string").alias(c) for c in bronze.columns])  # bronze: strings
    bronze = bronze.withColumn("TIPO_OPERACAO", F.lit("EXP"))                           # D8
    if "ORIGIN_FILE_NAME" in bronze.columns:                                             # D9
        bronze = bronze.drop("ORIGIN_FILE_NAME")
    b = bronze.alias("b")                                                               # D4
    out = b.select(
        cl.to_type(F.col("b.L_ORDERKEY"), "bigint").alias("CO_PEDIDO"),
        cl.to_type(F.col("b.L_LINENUMBER"), "int").alias("NU_LINHA"),
        cl.to_type(F.col("b.L_QUANTITY"), "double").alias("QT_ESTAT"),
        cl.to_type(F.col("b.L_EXTENDEDPRICE"), "decimal(18,2)").alias("VL_FOB"),
        cl.to_type(F.substring("b.L_SHIPDATE", 1, 10), "date").alias("DT_EMBARQUE"),
        F.col("b.L_RETURNFLAG").alias("CO_FLAG"),
        "TIPO_OPERACAO")
    return cl.drop_columns(out, "origin_path_name", "file_name_only")                   # D5


# ------------------------------------------------------------------ checks

@register("duplicate_keys", q.with_([q.DIM_MONTH_CTE, q.DIM_PRODUCT_CTE, q.DIM_GEO_CTE, q.DIM_LOCALITY_CTE], """
SELECT 'dim_month' AS dimension,
       (SELECT count(*) FROM (SELECT 1 FROM dim_month GROUP BY CO_ANO, CO_MES HAVING count(*) > 1) x) AS duplicate_keys
UNION ALL SELECT 'dim_product',
       (SELECT count(*) FROM (SELECT 1 FROM dim_product GROUP BY CO_NCM HAVING count(*) > 1) x)
UNION ALL SELECT 'dim_geography',
       (SELECT count(*) FROM (SELECT 1 FROM dim_geography GROUP BY CO_PAIS HAVING count(*) > 1) x)
UNION ALL SELECT 'dim_locality',
       (SELECT count(*) FROM (SELECT 1 FROM dim_locality GROUP BY CO_MUN_GEO HAVING count(*) > 1) x)"""))
def duplicate_keys(spark, sf_dir):
    """Number of keys that occur more than once, per dimension."""
    from ..operators.checks import duplicate_key_report
    t = si.Tables(spark, sf_dir)
    d_month, d_product, d_geo = build_dims(t)
    d_loc = ts.dim_locality(si.municipalities(t), si.states(t))
    return duplicate_key_report({"dim_month": (d_month, ["CO_ANO", "CO_MES"]),
                                 "dim_product": (d_product, ["CO_NCM"]),
                                 "dim_geography": (d_geo, ["CO_PAIS"]),
                                 "dim_locality": (d_loc, ["CO_MUN_GEO"])})


@register("table_counts", q.with_(q.STAR_CTES + [q.DIM_LOCALITY_CTE], """
SELECT 'dim_month' AS table_name, count(*) AS total_registros FROM dim_month
UNION ALL SELECT 'dim_product', count(*) FROM dim_product
UNION ALL SELECT 'dim_locality', count(*) FROM dim_locality
UNION ALL SELECT 'dim_geography', count(*) FROM dim_geography
UNION ALL SELECT 'fact_export', count(*) FROM fact_export
UNION ALL SELECT 'fact_import', count(*) FROM fact_import"""))
def table_counts(spark, sf_dir):
    """M8/H7: row count of every gold table, one row each."""
    from ..operators.checks import table_count_report
    t = si.Tables(spark, sf_dir)
    d_month, d_product, d_geo = build_dims(t)
    fexp, fimp = build_facts(t)
    d_loc = ts.dim_locality(si.municipalities(t), si.states(t))
    return table_count_report({"dim_month": d_month, "dim_product": d_product, "dim_locality": d_loc,
                               "dim_geography": d_geo, "fact_export": fexp, "fact_import": fimp})


# ------------------------------------------------------------------ skew and layout

@register("salt_advice", """
WITH c AS (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY l_suppkey),
s AS (SELECT max(n) AS max_count, quantile_disc(n, 0.5) AS median_count FROM c)
SELECT max_count, median_count,
       CASE WHEN median_count > 0 THEN max_count / median_count END AS ratio,
       CAST(CASE WHEN coalesce(median_count, 0) = 0 THEN 1
                 WHEN max_count / median_count < 1.5 THEN 1
                 WHEN max_count / median_count < 2.5 THEN 4
                 WHEN max_count / median_count < 4.0 THEN 8 ELSE 16 END AS INTEGER) AS salt
FROM s""")
def salt_advice(spark, sf_dir):
    """H4/J1 over lineitem by supplier."""
    return lo.salt_advice(si.Tables(spark, sf_dir).lineitem, "l_suppkey")


@register("salt_layout", """
WITH n AS (SELECT l_suppkey, count(*) AS c FROM lineitem GROUP BY 1)
SELECT count(*) AS suppliers, CAST(sum(c) AS BIGINT) AS rows, true AS in_range, true AS hot_key_split FROM n""")
def salt_layout(spark, sf_dir):
    """Lineitem salted by supplier with the advised bucket count. What must hold: no
    row or key lost, buckets in range, the largest supplier in every bucket."""
    li = si.Tables(spark, sf_dir).lineitem
    n = int(lo.salt_advice(li, "l_suppkey").first()["salt"])
    salted = lo.repartition_by_salt(li.select("l_suppkey", "l_orderkey", "l_linenumber"), "l_suppkey", n)
    per_key = salted.groupBy("l_suppkey", "salt").agg(F.count(F.lit(1)).alias("c")).groupBy("l_suppkey").agg(
        F.sum("c").alias("c"), F.count(F.lit(1)).alias("buckets"), F.min("salt").alias("low"), F.max("salt").alias("high"))
    return per_key.agg(F.count(F.lit(1)).alias("suppliers"), F.sum("c").alias("rows"),
                       ((F.min("low") >= 0) & (F.max("high") < n)).alias("in_range"),
                       (F.max(F.struct("c", "buckets"))["buckets"] == n).alias("hot_key_split"))


@register("partition_advice", q.with_(q.STAR_CTES, f"""
SELECT count(*) AS total_rows, {lo.FILE_MB_INCREMENTAL} AS desired_file_mb, true AS measured, true AS consistent
FROM fact_export"""))
def partition_advice(spark, sf_dir):
    """File-count advice for the export fact from a written sample's bytes. The
    bytes depend on the writer; the advice must follow from the figures reported."""
    fexp, _ = build_facts(si.Tables(spark, sf_dir))
    r = lo.partition_advice(fexp, lo.FILE_MB_INCREMENTAL)
    total = F.col("total_rows") * F.col("avg_row_bytes")
    wanted = F.greatest(F.lit(1.0), F.floor(total / (F.col("desired_file_mb") * 1048576.0)))
    return r.select("total_rows", "desired_file_mb", (F.col("avg_row_bytes") > 0).alias("measured"),
                    (F.col("recommended_partitions") == wanted).alias("consistent"))


@register("registry_counts", q.with_(q.REGISTRY_CTES, """
SELECT 'dim_company' AS table_name, count(*) AS total_registros FROM dim_company
UNION ALL SELECT 'dim_establishment', count(*) FROM dim_establishment
UNION ALL SELECT 'dim_partner', count(*) FROM dim_partner
UNION ALL SELECT 'fact_establishment', count(*) FROM fact_establishment"""))
def registry_counts(spark, sf_dir):
    """M8 for the registry star."""
    from ..operators.checks import table_count_report
    r = build_registry(si.Tables(spark, sf_dir))
    return table_count_report({"dim_company": r["d_company"], "dim_establishment": r["d_est"],
                               "dim_partner": r["d_partner"], "fact_establishment": r["fact"]})
