"""Registered queries over whole job runs: refreshes and republished files that reach silver, gold and
the quarantine, lookups whose columns drift, and every trade and registry table through the jobs."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..session import scratch_path
from ..sources.csv import read_table
from . import fixtures as fx
from . import incremental as inc
from . import jobs
from . import sqlparts as q
from . import standins as si
from .catalog import register
from .catalog_jobs import _RAW_EXPORTS, _SILVER_TRADE, raw_exports, stamped, text

DAYS = [dt.datetime(2024, 3, d, 6) for d in range(1, 8)]
FREIGHT = ["VL_FRETE", "VL_SEGURO"]


def _write_years(t: si.Tables, rows: DataFrame, landing: str, kind: str = "EXP") -> None:
    years = rows.withColumn("arquivo_ano", F.col("CO_ANO").cast("int"))  # numbers are sorted by their bits, texts by comparing
    fx.write_named_csv(t, years, landing, lambda y: f"{kind}_{y}.csv", "arquivo_ano")


def _first_year(t: si.Tables) -> int:
    return t.lineitem.agg(F.year(F.min("l_shipdate"))).first()[0]


# what is left after one year's file went and the next one was published without its second month
_LEFT = """CAST(CO_ANO AS INTEGER) > (SELECT min(year(l_shipdate)) FROM lineitem)
  AND NOT (CAST(CO_ANO AS INTEGER) = (SELECT min(year(l_shipdate)) FROM lineitem) + 1 AND CO_MES = '2')"""


def _shrink(t: si.Tables, rows: DataFrame, landing: str, kind: str = "EXP") -> None:
    year = _first_year(t)
    fx.remove_file(t, landing, f"{kind}_{year}.csv")
    _write_years(t, rows.where((F.col("CO_ANO") == str(year + 1)) & (F.col("CO_MES") != "2")), landing, kind)


# ------------------------------------------------------------------ refreshes

@register("silver_after_refresh", _SILVER_TRADE.format(
    ncm=q.pad_nt("CO_NCM", 8), more="", kind="EXP", raw=f"SELECT * FROM ({_RAW_EXPORTS}) WHERE {_LEFT}"))
def silver_after_refresh(spark, sf_dir):
    """A year and a month that the refreshed files no longer hold are gone from silver."""
    t = si.Tables(spark, sf_dir)
    landing, lake = scratch_path(spark, "landing-refresh"), jobs.Lake(scratch_path(spark, "lake-refresh"))
    rows = raw_exports(t)
    _write_years(t, rows, landing)
    for step in (jobs.bronze_trade(spark, landing, lake, DAYS[0]), jobs.silver_trade(spark, lake, DAYS[0])):
        step.collect()
    _shrink(t, rows, landing)
    jobs.bronze_trade(spark, landing, lake, DAYS[1], mode="full").collect()
    jobs.silver_trade(spark, lake, DAYS[1]).collect()
    return spark.read.parquet(lake.silver("exp_tratado")).drop("DATA_TRANSFORMACAO")


def _trade_lake(t: si.Tables, name: str) -> tuple[str, jobs.Lake]:
    """Export and import files by year (returned lines are imports) and the other silver tables."""
    spark = t.spark
    landing, lake = scratch_path(spark, f"landing-{name}"), jobs.Lake(scratch_path(spark, f"lake-{name}"))
    flag = F.col("SG_UF_NCM") == "R"
    rows = raw_exports(t)
    _write_years(t, rows.where(~flag), landing)
    _write_years(t, rows.where(flag).select("*", F.lit("1,5").alias(FREIGHT[0]), F.lit("0,25").alias(FREIGHT[1])), landing, "IMP")
    for table, df in {"ncm": si.product_codes(t), "ncm_sh": si.hs_lookup(t), "ncm_isic": si.isic_lookup(t),
                      "ncm_cgce": si.cgce_lookup(t), "ncm_fat_agreg": si.fat_lookup(t), "pais": si.countries(t),
                      "uf": si.states(t), "uf_mun": si.municipalities(t)}.items():
        df.write.mode("overwrite").parquet(lake.silver(f"{table}_tratado"))
    return landing, lake


_FACT = """
SELECT CAST(r.CO_ANO AS INTEGER) AS CO_ANO, CAST(r.CO_MES AS INTEGER) AS CO_MES, {ncm} AS CO_NCM,
       CAST(r.CO_PAIS AS INTEGER) AS CO_PAIS, r.SG_UF_NCM, CAST(r.QT_ESTAT AS BIGINT) AS quantidade_estatistica,
       CAST(r.KG_LIQUIDO AS BIGINT) AS peso_liquido_kg, CAST(replace(r.VL_FOB, ',', '.') AS DECIMAL(18,2)) AS valor_fob,
       {more}'{kind}' AS TIPO_OPERACAO, {month} AS fk_tempo, p.sk_produto AS fk_produto, g.sk_geografia AS fk_geografia
FROM ({raw}) r LEFT JOIN dim_product p ON p.CO_NCM = {ncm} LEFT JOIN dim_geography g ON g.CO_PAIS = CAST(r.CO_PAIS AS INTEGER)
WHERE {flag} AND {left}"""


def _fact_sql(kind: str, left: str) -> str:
    more = "CAST(1.5 AS DECIMAL(18,4)) AS valor_frete, CAST(0.25 AS DECIMAL(18,4)) AS valor_seguro, " if kind == "IMP" else ""
    return q.with_([q.DIM_PRODUCT_CTE, q.DIM_GEO_CTE], _FACT.format(
        ncm=q.pad_nt("r.CO_NCM", 8), more=more, kind=kind, raw=_RAW_EXPORTS, left=left,
        month=q.sk("CAST(r.CO_ANO AS INTEGER)", "CAST(r.CO_MES AS INTEGER)"),
        flag="r.SG_UF_NCM = 'R'" if kind == "IMP" else "r.SG_UF_NCM IS DISTINCT FROM 'R'"))


@register("fact_after_refresh", _fact_sql("IMP", _LEFT))
def fact_after_refresh(spark, sf_dir):
    """The same for imports up to the fact of the star."""
    t = si.Tables(spark, sf_dir)
    landing, lake = _trade_lake(t, "fact-refresh")
    imports = raw_exports(t).where("SG_UF_NCM = 'R'").select("*", F.lit("1,5").alias(FREIGHT[0]), F.lit("0,25").alias(FREIGHT[1]))
    for i, mode in enumerate(("incremental", "full")):
        jobs.bronze_trade(spark, landing, lake, DAYS[i], mode=mode).collect()
        jobs.silver_trade(spark, lake, DAYS[i]).collect()
        jobs.gold_trade(spark, lake, DAYS[i]).collect()
        if not i:
            _shrink(t, imports, landing, "IMP")
    return spark.read.parquet(lake.gold("fato_balanca_imp")).drop("data_processamento_fato")


@register("fact_after_republish", _fact_sql("EXP", _LEFT.replace(
    "CAST(CO_ANO AS INTEGER) > (SELECT min(year(l_shipdate)) FROM lineitem)", "true")))
def fact_after_republish(spark, sf_dir):
    """One year's file is published again without a month (``key="version"``): the month leaves
    silver and the fact, the rest of the year is loaded again, other years are not."""
    t = si.Tables(spark, sf_dir)
    landing, lake = _trade_lake(t, "fact-republish")
    exports = raw_exports(t).where("SG_UF_NCM <> 'R' OR SG_UF_NCM IS NULL")
    for i in range(2):
        jobs.bronze_trade(spark, landing, lake, DAYS[i], key="version").collect()
        jobs.silver_trade(spark, lake, DAYS[i]).collect()
        jobs.gold_trade(spark, lake, DAYS[i]).collect()
        if not i:
            year = _first_year(t) + 1
            _write_years(t, exports.where((F.col("CO_ANO") == str(year)) & (F.col("CO_MES") != "2")), landing)
    return spark.read.parquet(lake.gold("fato_balanca_exp")).drop("data_processamento_fato")


@register("rejects_after_refresh", """
WITH l AS (
  SELECT year(l_shipdate) AS y, 1 AS good, 0 AS bad FROM lineitem
  UNION ALL SELECT year(o_orderdate), 0, 1 FROM orders)
SELECT 'EXP_' || y || '.csv' AS nome_arquivo, CAST(sum(good) AS BIGINT) AS aceitos, CAST(sum(bad) AS BIGINT) AS rejeitados,
       CAST(sum(good) AS BIGINT) AS num_registros, CAST(sum(bad) AS BIGINT) AS num_rejeitados
FROM l GROUP BY y""")
def rejects_after_refresh(spark, sf_dir):
    """Accepted and rejected rows of a file are its lines, in the tables and in the manifest, after a load
    that died before its commit, files published again with other lines, and a full refresh."""
    t = si.Tables(spark, sf_dir)
    landing, lake = scratch_path(spark, "landing-rejects"), jobs.Lake(scratch_path(spark, "lake-rejects"))
    good = raw_exports(t).select(F.concat_ws(";", *S.EXPORT_COLUMNS).alias("linha"), "CO_ANO")
    bad = t.orders.select(F.concat_ws(";", text("o_orderkey"), F.lit("short")).alias("linha"),
                          text(F.year("o_orderdate")).alias("CO_ANO"))

    def publish(lines: DataFrame) -> None:
        header = ";".join(S.EXPORT_COLUMNS)
        years = lines.withColumnRenamed("CO_ANO", "ano_arquivo").select(F.col("linha").alias(header), "ano_arquivo")
        fx.write_named_lines(t, years, landing, lambda y: f"EXP_{y}.csv", "ano_arquivo")

    def load(day: int, full: bool = False, manifest: str | None = None) -> None:
        inc.load_new_files(spark, landing, manifest or lake.manifest, lake.bronze("exp"),
                           jobs.trade_reader(spark, S.EXPORT_COLUMNS, DAYS[day]), "EXP", DAYS[day], ["ano", "mes"],
                           glob="EXP_*.csv", full=full, key="version", quarantine_path=lake.quarantine("exp"))

    publish(good.union(bad).union(bad))
    load(0)
    load(1, manifest=os.path.join(lake.root, "lost"))       # data and rejects are there, its commit is not
    publish(good.union(bad).union(bad).union(bad))
    load(2)                                                 # every file came again with more broken lines
    load(3, full=True)
    publish(good.union(bad))
    load(4)                                                 # and again with fewer
    bronze = inc.read_bronze(spark, lake.bronze("exp"), lake.manifest, "EXP")
    seen = inc.committed(spark, bronze, lake.manifest, "EXP").select(F.col("file_name_only").alias("n"), F.lit(1).alias("g"), F.lit(0).alias("b"))
    left = inc.committed_rejects(spark, lake.quarantine("exp"), lake.manifest, "EXP").select(
        F.substring_index("arquivo", "/", -1), F.lit(0), F.lit(1))
    counts = seen.union(left).groupBy("n").agg(F.sum("g").alias("aceitos"), F.sum("b").alias("rejeitados"))
    live = inc.live_files(inc.read_manifest(spark, lake.manifest, "EXP"))
    return live.join(counts, live["nome_arquivo"] == counts["n"]).select(
        "nome_arquivo", "aceitos", "rejeitados", "num_registros", "num_rejeitados")


# ------------------------------------------------------------------ columns that come and go

@register("aux_columns", """
SELECT CAST(n_nationkey AS INTEGER) AS CO_UF, CAST(NULL AS VARCHAR) AS SG_UF, n_name AS NO_UF,
       'REGIAO ' || n_regionkey AS NO_REGIAO
FROM nation
UNION ALL
SELECT CAST(c_custkey + 1000 AS INTEGER), CAST(NULL AS VARCHAR), c_name, 'REGIAO ' || c_nationkey FROM customer""")
def aux_columns(spark, sf_dir):
    """A lookup gains a column, changes their order, then loses one and gains another; silver
    holds them all, those that the last file does not have as NULL."""
    t = si.Tables(spark, sf_dir)
    landing, lake = scratch_path(spark, "landing-aux"), jobs.Lake(scratch_path(spark, "lake-aux"))
    rows = t.nation.select(text("n_nationkey").alias("CO_UF"), F.substring("n_name", 1, 2).alias("SG_UF"),
                           F.col("n_name").alias("NO_UF"), F.concat(F.lit("REGIAO "), text("n_regionkey")).alias("NO_REGIAO"))
    rows = rows.unionByName(t.customer.select(
        text(F.col("c_custkey") + 1000).alias("CO_UF"), F.lit("X").alias("SG_UF"), F.col("c_name").alias("NO_UF"),
        F.concat(F.lit("REGIAO "), text("c_nationkey")).alias("NO_REGIAO")))
    for day, columns in enumerate((["CO_UF", "SG_UF"], ["NO_UF", "SG_UF", "CO_UF"], ["NO_REGIAO", "CO_UF", "NO_UF"])):
        fx.write_named_csv(t, rows.select(*columns), landing, "UF.csv")
        jobs.bronze_trade(spark, landing, lake, DAYS[day], key="version").collect()
        jobs.silver_trade(spark, lake, DAYS[day]).collect()
    return spark.read.parquet(lake.silver("uf_tratado"))


# ------------------------------------------------------------------ every table of the jobs

def _line(columns: list[str]) -> F.Column:
    return F.concat_ws(";", *[F.coalesce(text(f"`{c}`"), F.lit("<null>")) for c in columns])


def _lookup_columns(table: str) -> list[str]:
    pads, ints, drop = jobs.TRADE_LOOKUPS[table]
    return [*pads, *ints, "NO_TEXTO", *drop]


def _lookup_sql(table: str) -> str:
    pads, ints, _ = jobs.TRADE_LOOKUPS[table]
    values = [f"'{c}=' || {q.pad_nt('c_custkey', w)}" for c, w in pads.items()]
    values += [f"'{c}=' || CASE WHEN c_custkey % 10 = 0 THEN '<null>' ELSE CAST(c_custkey AS VARCHAR) END" for c in ints]
    values.append("'NO_TEXTO=' || CASE WHEN c_custkey % 7 = 0 THEN '<null>' ELSE c_name END")
    return f"SELECT '{table}' AS tabela, concat_ws(';', {', '.join(values)}) AS linha FROM customer"


@register("silver_lookup_tables", "\nUNION ALL ".join(_lookup_sql(table) for table in jobs.TRADE_LOOKUPS))
def silver_lookup_tables(spark, sf_dir):
    """Each auxiliary table by its own settings: codes padded and never cut, integer codes (NULL where
    they are none), blanks to NULL, unused columns and provenance gone. A line names every column left."""
    c = si.Tables(spark, sf_dir).customer
    out = None
    for table, settings in jobs.TRADE_LOOKUPS.items():
        pads, ints, drop = settings
        cols = [text("c_custkey").alias(x) for x in pads]
        cols += [F.when(F.col("c_custkey") % 10 == 0, "n/a").otherwise(F.concat(F.lit(" "), text("c_custkey"))).alias(x) for x in ints]
        cols += [F.when(F.col("c_custkey") % 7 == 0, " \t").otherwise(F.col("c_name")).alias("NO_TEXTO")]
        cols += [F.lit("unused").alias(x) for x in drop]
        silver = jobs.silver_lookup(stamped(c.select(*cols), DAYS[0]), *settings)
        named = F.concat_ws(";", *[F.concat(F.lit(f"{x}="), F.coalesce(text(x), F.lit("<null>"))) for x in silver.columns])
        rows = silver.select(F.lit(table).alias("tabela"), named.alias("linha"))
        out = rows if out is None else out.unionByName(rows)
    return out


_TRADE_JOB = f"""
SELECT 'imp' AS tabela, concat_ws(';', CO_ANO, CO_MES, CO_NCM, CO_UNID, CO_PAIS, SG_UF_NCM, CO_VIA, CO_URF, QT_ESTAT, KG_LIQUIDO,
       VL_FOB, '1,5', '0,25', CO_ANO, CO_MES) AS linha FROM ({_RAW_EXPORTS}) WHERE SG_UF_NCM = 'R'
UNION ALL
SELECT 'ncm', concat_ws(';', CAST(p_partkey AS VARCHAR), '10', '1', '1', '1', '1', '1', '1', '1', '1', '1', p_name || '; x', 'e', 'i', '2024-03-01')
FROM part
UNION ALL SELECT 'uf', concat_ws(';', CAST(c_custkey AS VARCHAR), c_name) FROM customer
UNION ALL SELECT 'pais_bloco', concat_ws(';', CAST(n_nationkey AS VARCHAR), n_name) FROM nation
UNION ALL SELECT 'status', concat_ws(';', t, 'ok', CAST(n AS VARCHAR), CAST(bad AS VARCHAR)) FROM (
  SELECT 'exp' AS t, 0 AS n, 0 AS bad
  UNION ALL SELECT 'imp', count(*), 0 FROM lineitem WHERE l_returnflag = 'R'
  UNION ALL SELECT 'ncm', count(*), 0 FROM part
  UNION ALL SELECT 'uf', count(*), 0 FROM customer
  UNION ALL SELECT 'pais_bloco', count(*), (SELECT count(*) FROM region) FROM nation)"""


@register("bronze_trade_tables", _TRADE_JOB)
def bronze_trade_tables(spark, sf_dir):
    """Imports by year and month, product codes by load date, auxiliary tables by their headers,
    routed by file name; a second run loads nothing more. One line a row, and the job's first report."""
    t = si.Tables(spark, sf_dir)
    landing, lake = scratch_path(spark, "landing-trade"), jobs.Lake(scratch_path(spark, "lake-trade"))
    _write_years(t, raw_exports(t).where("SG_UF_NCM = 'R'").select(
        "*", F.lit("1,5").alias(FREIGHT[0]), F.lit("0,25").alias(FREIGHT[1])), landing, "IMP")
    one = [F.lit("1").alias(c) for c in S.PRODUCT_COLUMNS[2:-3]]
    fx.write_named_csv(t, t.part.select(text("p_partkey").alias("CO_NCM"), F.lit("10").alias("CO_UNID"), *one,
                                        F.concat("p_name", F.lit("; x")).alias("NO_NCM_POR"), F.lit("e").alias("NO_NCM_ESP"),
                                        F.lit("i").alias("NO_NCM_ING")), landing, "NCM.csv")
    fx.write_named_csv(t, t.customer.select(text("c_custkey").alias("CO_UF"), F.col("c_name").alias("NO_UF")), landing, "UF.csv")
    block = t.nation.select(F.concat_ws(";", text("n_nationkey"), "n_name").alias("v")).union(t.region.select(F.lit("short")))
    fx.write_named_csv(t, block.select(F.col("v").alias("CO_PAIS;NO_BLOCO")), landing, "PAIS_BLOCO.csv", sep="\t", quote="")
    fx.write_named_csv(t, t.region.select("r_name"), landing, "LEIAME.txt")
    report = jobs.bronze_trade(spark, landing, lake, DAYS[0])
    jobs.bronze_trade(spark, landing, lake, DAYS[1]).collect()
    out = report.select(F.lit("status").alias("tabela"), _line(["tabela", "status", "registros", "rejeitados"]).alias("linha"))
    for table, tipo, columns in (("imp", "IMP", [*S.IMPORT_COLUMNS, "ano", "mes"]), ("ncm", "NCM", [*S.PRODUCT_COLUMNS, "dt_ingestao"]),
                                 ("uf", jobs.aux_type("uf"), ["CO_UF", "NO_UF"]),
                                 ("pais_bloco", jobs.aux_type("pais_bloco"), ["CO_PAIS", "NO_BLOCO"])):
        rows = inc.committed(spark, inc.read_bronze(spark, lake.bronze(table), lake.manifest, tipo), lake.manifest, tipo)
        out = out.unionByName(rows.select(F.lit(table).alias("tabela"), _line(columns).alias("linha")))
    return out


def _quoted(*columns) -> F.Column:
    return F.concat_ws(";", *[F.concat(F.lit('"'), c, F.lit('"')) for c in columns])


@register("bronze_registry_tables", """
SELECT 'empresas' AS tabela, concat_ws(';', lpad(CAST(c_custkey AS VARCHAR), 8, '0'), c_name || '; SA', '2062', '49', '1,00', '03', '') AS linha,
       '202403' AS anomes FROM customer
UNION ALL SELECT 'simples', concat_ws(';', lpad(CAST(c_custkey AS VARCHAR), 8, '0'), 'S', '20200101', '', 'N', '', ''), '202403' FROM customer
UNION ALL SELECT 'estabelecimentos', lpad(CAST(o_orderkey AS VARCHAR), 8, '0') || ';0001;90' || repeat(';x', 27), '202403' FROM orders
UNION ALL SELECT 'socios', lpad(CAST(s_suppkey AS VARCHAR), 8, '0') || ';2;' || s_name || repeat(';', 8), '202403' FROM supplier
UNION ALL SELECT 'paises', concat_ws(';', CAST(n_nationkey AS VARCHAR), n_name), '202404' FROM nation
UNION ALL SELECT 'rejeitados', CAST(r_regionkey AS VARCHAR) || ';short', 'empresas' FROM region""")
def bronze_registry_tables(spark, sf_dir):
    """Archives of five groups through the registry job in two loads, partitioned by load month; lines
    of the wrong width are in the quarantine; archives of the first load are not read again."""
    t = si.Tables(spark, sf_dir)
    landing, lake = scratch_path(spark, "landing-registry"), jobs.Lake(scratch_path(spark, "lake-registry"))
    key = lambda c: F.lpad(text(c), 8, "0")
    blank = F.lit("")
    companies = t.customer.select(_quoted(key("c_custkey"), F.concat("c_name", F.lit("; SA")), F.lit("2062"), F.lit("49"),
                                          F.lit("1,00"), F.lit("03"), blank).alias("value"))
    short = t.region.select(F.concat_ws(";", text("r_regionkey"), F.lit("short")).alias("value"))
    fx.write_archives(t, companies.union(short), "Empresas", "K.EMPRECSV", landing)
    fx.write_archives(t, t.customer.select(_quoted(key("c_custkey"), F.lit("S"), F.lit("20200101"), blank, F.lit("N"), blank,
                                                   blank).alias("value")), "Simples", "K.SIMPLES", landing)
    fx.write_archives(t, t.orders.select(_quoted(key("o_orderkey"), F.lit("0001"), F.lit("90"), *[F.lit("x")] * 27).alias("value")),
                      "Estabelecimentos", "K.ESTABELE", landing)
    fx.write_archives(t, t.supplier.select(_quoted(key("s_suppkey"), F.lit("2"), F.col("s_name"), *[blank] * 8).alias("value")),
                      "Socios", "K.SOCIOCSV", landing)
    jobs.bronze_registry(spark, landing, lake, DAYS[0]).collect()
    fx.write_archives(t, t.nation.select(_quoted(text("n_nationkey"), F.col("n_name")).alias("value")), "Paises", "K.PAISCSV", landing)
    jobs.bronze_registry(spark, landing, lake, dt.datetime(2024, 4, 1, 6)).collect()
    out = inc.committed_rejects(spark, lake.quarantine("empresas"), lake.manifest, "Empresas").select(
        F.lit("rejeitados").alias("tabela"), F.col("linha"), F.lit("empresas").alias("anomes"))
    for group in ("Empresas", "Simples", "Estabelecimentos", "Socios", "Paises"):
        table, columns = S.REGISTRY_GROUPS[group]
        rows = inc.committed(spark, inc.read_bronze(spark, lake.bronze(table), lake.manifest, group), lake.manifest, group)
        line = F.concat_ws(";", *[F.coalesce(F.col(c), F.lit("")) for c in columns])
        out = out.unionByName(rows.select(F.lit(table).alias("tabela"), line.alias("linha"), text("anomes").alias("anomes")))
    return out


@register("tables_by_name", _SILVER_TRADE.format(ncm=q.pad_nt("CO_NCM", 8), more="", kind="EXP", raw=_RAW_EXPORTS))
def tables_by_name(spark, sf_dir):
    """A silver table of the jobs, registered in the catalogue and read by its name."""
    t = si.Tables(spark, sf_dir)
    landing, lake = scratch_path(spark, "landing-names"), jobs.Lake(scratch_path(spark, "lake-names"))
    _write_years(t, raw_exports(t), landing)
    jobs.bronze_trade(spark, landing, lake, DAYS[0]).collect()
    jobs.silver_trade(spark, lake, DAYS[0]).collect()
    database = f"silver_{os.path.basename(lake.root).rsplit('-', 1)[1]}"
    jobs.register_tables(spark, lake, database, f"{database}_gold").collect()
    return read_table(spark, f"{database}.exp_tratado").drop("DATA_TRANSFORMACAO")
