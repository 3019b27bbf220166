"""Registered queries: one Spark plan and one independent DuckDB oracle per key.

``QUERIES[key] = (fn(spark, sf_dir) -> DataFrame, oracle_sql or None)``. Every plan
reads the driver's whole tables (or data Spark derives from them); a limit appears
only where it is the feature (the last-five-months report).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import trade_star as ts
from . import sqlparts as q
from . import standins as si

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}

REPORT_YEAR = 1998  # E9: the consolidated report's year filter (a feature, not a row cap)


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = (fn, sql)
        return fn
    return deco


# ------------------------------------------------------------------ trade star builders

def build_dims(t: si.Tables):
    d_month = ts.dim_month(si.trade_periods(t))
    d_product = ts.dim_product(si.product_codes(t), si.hs_lookup(t), si.isic_lookup(t),
                               si.cgce_lookup(t), si.fat_lookup(t))
    d_geo = ts.dim_geography(si.countries(t))
    return d_month, d_product, d_geo


def build_facts(t: si.Tables):
    d_month, d_product, d_geo = build_dims(t)
    fexp = ts.trade_fact(si.exports(t), d_month, d_product, d_geo, ts.EXPORT)
    fimp = ts.trade_fact(si.imports(t), d_month, d_product, d_geo, ts.IMPORT)
    return fexp, fimp


def build_consolidated(t: si.Tables):
    """Both operation types in one pass over the trade rows."""
    return ts.consolidated_once(ts.trade_fact(si.trade_rows(t), *build_dims(t), ts.IMPORT))


@register("dim_month", q.with_([q.DIM_MONTH_CTE], "SELECT * FROM dim_month"))
def dim_month(spark, sf_dir):
    t = si.Tables(spark, sf_dir)
    return ts.dim_month(si.trade_periods(t, "EXP"), si.trade_periods(t, "IMP"))


@register("dim_product", q.with_([q.DIM_PRODUCT_CTE], "SELECT * FROM dim_product"))
def dim_product(spark, sf_dir):
    return build_dims(si.Tables(spark, sf_dir))[1]


@register("dim_geography", q.with_([q.DIM_GEO_CTE], "SELECT * FROM dim_geography"))
def dim_geography(spark, sf_dir):
    return build_dims(si.Tables(spark, sf_dir))[2]


@register("dim_locality", q.with_([q.DIM_LOCALITY_CTE], "SELECT * FROM dim_locality"))
def dim_locality(spark, sf_dir):
    t = si.Tables(spark, sf_dir)
    return ts.dim_locality(si.municipalities(t), si.states(t))


@register("fact_export", q.with_(q.STAR_CTES, "SELECT * FROM fact_export"))
def fact_export(spark, sf_dir):
    return build_facts(si.Tables(spark, sf_dir))[0]


@register("fact_import", q.with_(q.STAR_CTES, "SELECT * FROM fact_import"))
def fact_import(spark, sf_dir):
    return build_facts(si.Tables(spark, sf_dir))[1]


@register("consolidated", q.with_(q.STAR_CTES, "SELECT * FROM consolidated"))
def consolidated(spark, sf_dir):
    return build_consolidated(si.Tables(spark, sf_dir))


@register("consolidated_union", q.with_(q.STAR_CTES, "SELECT * FROM consolidated"))
def consolidated_union(spark, sf_dir):
    """M7/I8 as the jobs publish it: a union of the two written facts."""
    return ts.consolidated(*build_facts(si.Tables(spark, sf_dir)))


_STATS_COMMON = """CO_ANO, CO_MES, COUNT(*) AS total_registros,
       CAST(SUM(quantidade_estatistica) AS BIGINT) AS total_quantidade,
       CAST(SUM(peso_liquido_kg) AS BIGINT) AS total_peso_kg,
       CAST(SUM(valor_fob) AS DECIMAL(38,2)) AS total_valor_fob"""


@register("monthly_stats_export", q.with_(q.STAR_CTES, f"""
SELECT {_STATS_COMMON}
FROM fact_export GROUP BY CO_ANO, CO_MES ORDER BY CO_ANO DESC, CO_MES DESC LIMIT 5"""))
def monthly_stats_export(spark, sf_dir):
    return ts.monthly_stats(build_facts(si.Tables(spark, sf_dir))[0], ts.EXPORT)


@register("monthly_stats_import", q.with_(q.STAR_CTES, f"""
SELECT {_STATS_COMMON},
       CAST(SUM(valor_frete) AS DECIMAL(38,4)) AS total_frete,
       CAST(SUM(valor_seguro) AS DECIMAL(38,4)) AS total_seguro
FROM fact_import GROUP BY CO_ANO, CO_MES ORDER BY CO_ANO DESC, CO_MES DESC LIMIT 5"""))
def monthly_stats_import(spark, sf_dir):
    return ts.monthly_stats(build_facts(si.Tables(spark, sf_dir))[1], ts.IMPORT)


@register("report_by_operation", q.with_(q.STAR_CTES, f"""
SELECT tipo_operacao, CAST(SUM(valor_fob) AS DECIMAL(38,2)) AS total_fob,
       CAST(SUM(valor_frete) AS DECIMAL(38,4)) AS total_frete, COUNT(*) AS total_linhas
FROM consolidated WHERE CO_ANO = {REPORT_YEAR} GROUP BY tipo_operacao"""))
def report_by_operation(spark, sf_dir):
    return ts.report_by_operation(build_consolidated(si.Tables(spark, sf_dir)), REPORT_YEAR)


@register("report_by_year", q.with_(q.STAR_CTES, """
SELECT CO_ANO, COUNT(*) AS total_registros, CAST(SUM(valor_fob) AS DECIMAL(38,2)) AS soma_valor_fob,
       CAST(SUM(peso_liquido_kg) AS BIGINT) AS soma_peso
FROM consolidated GROUP BY CO_ANO"""))
def report_by_year(spark, sf_dir):
    return ts.report_by_year(build_consolidated(si.Tables(spark, sf_dir)))


@register("fact_total", q.with_(q.STAR_CTES, """
SELECT COUNT(*) AS total_registros, CAST(SUM(valor_fob) AS DECIMAL(38,2)) AS soma_valor_fob
FROM fact_export"""))
def fact_total(spark, sf_dir):
    return ts.fact_total(build_facts(si.Tables(spark, sf_dir))[0])


# ------------------------------------------------------------------ registry star

from ..operators import registry_star as rs  # noqa: E402


def build_registry(t: si.Tables):
    comps, est = si.companies(t), si.establishments(t)
    d_company = rs.dim_company(comps, si.legal_natures(t))
    d_est = rs.dim_establishment(est, comps)
    d_partner = rs.dim_partner(si.partners(t), si.qualifications(t), si.registry_countries(t))
    fact = rs.fact_establishment(d_company, d_est)
    est_view = rs.dim_establishment(rs.establishment_flags(est), comps, flags=True)
    return dict(companies=comps, est=est, d_company=d_company, d_est=d_est, d_partner=d_partner,
                fact=fact, est_view=est_view)


def _reg(spark, sf_dir):
    return build_registry(si.Tables(spark, sf_dir))


R = q.REGISTRY_CTES


@register("dim_opening_date", q.with_(R, f"""
SELECT DT_INICIO_ATIVIDADE, CAST(year(DT_INICIO_ATIVIDADE) AS INTEGER) AS CO_ANO,
       CAST(month(DT_INICIO_ATIVIDADE) AS INTEGER) AS CO_MES,
       CAST(ceil(month(DT_INICIO_ATIVIDADE) / 3) AS BIGINT) AS CO_TRIMESTRE,
       CAST(ceil(month(DT_INICIO_ATIVIDADE) / 6) AS BIGINT) AS CO_SEMESTRE,
       strftime(DT_INICIO_ATIVIDADE, '%B') AS NO_MES,
       CAST(CAST(ceil(month(DT_INICIO_ATIVIDADE) / 3) AS BIGINT) AS VARCHAR) || 'º Trimestre' AS NO_TRIMESTRE,
       CAST(CAST(ceil(month(DT_INICIO_ATIVIDADE) / 6) AS BIGINT) AS VARCHAR) || 'º Semestre' AS NO_SEMESTRE,
       {q.sk('DT_INICIO_ATIVIDADE')} AS sk_tempo_abertura
FROM (SELECT DISTINCT DT_INICIO_ATIVIDADE FROM est WHERE DT_INICIO_ATIVIDADE IS NOT NULL) d"""))
def dim_opening_date(spark, sf_dir):
    return rs.dim_opening_date(si.establishments(si.Tables(spark, sf_dir)))


@register("dim_company", q.with_(R, "SELECT * FROM dim_company"))
def dim_company(spark, sf_dir):
    return _reg(spark, sf_dir)["d_company"]


@register("dim_establishment", q.with_(R, "SELECT * FROM dim_establishment"))
def dim_establishment(spark, sf_dir):
    return _reg(spark, sf_dir)["d_est"]


@register("dim_partner", q.with_(R, "SELECT * FROM dim_partner"))
def dim_partner(spark, sf_dir):
    return _reg(spark, sf_dir)["d_partner"]


@register("fact_establishment", q.with_(R, "SELECT * FROM fact_establishment"))
def fact_establishment(spark, sf_dir):
    return _reg(spark, sf_dir)["fact"]


@register("branch_counts", q.with_(R, """
SELECT CNPJ_BASICO, CNPJ_ORDEM, IS_MATRIZ, IS_ATIVA, QT_FILIAIS FROM flags"""))
def branch_counts(spark, sf_dir):
    est = si.establishments(si.Tables(spark, sf_dir))
    return rs.establishment_flags(est).select("CNPJ_BASICO", "CNPJ_ORDEM", "IS_MATRIZ", "IS_ATIVA",
                                              "QT_FILIAIS")


@register("company_complete", q.with_(R, """
SELECT e.CO_CNPJ_BASICO, e.NO_RAZAO_SOCIAL, e.VL_CAPITAL_SOCIAL, e.PORTE_EMPRESA AS NO_PORTE,
       e.SG_UF_RESPONSAVEL, est.CO_CNPJ_ORDEM, est.SG_UF, est.CO_MUNICIPIO, est.CO_CNAE_PRINCIPAL,
       est.DT_INICIO_ATIVIDADE, est.FL_ATIVA, est.QT_FILIAIS
FROM fact_establishment e LEFT JOIN est_view est ON e.CO_CNPJ_BASICO = est.CO_CNPJ_BASICO"""))
def company_complete(spark, sf_dir):
    r = _reg(spark, sf_dir)
    return rs.company_complete(r["fact"], r["est_view"])


@register("company_partner", q.with_(R, """
SELECT es.CO_CNPJ_BASICO, e.NO_RAZAO_SOCIAL, es.ID_SOCIO, es.NO_SOCIO, es.NU_CPF_CNPJ_SOCIO,
       es.NO_QUALIFICACAO, es.NO_FAIXA_ETARIA, es.NO_PAIS, es.DT_ENTRADA_SOCIEDADE,
       e.PORTE_EMPRESA AS NO_PORTE, e.VL_CAPITAL_SOCIAL
FROM dim_partner es LEFT JOIN fact_establishment e ON es.CO_CNPJ_BASICO = e.CO_CNPJ_BASICO"""))
def company_partner(spark, sf_dir):
    r = _reg(spark, sf_dir)
    return rs.company_partner(r["d_partner"], r["fact"])


@register("region_rollup", q.with_(R, """
SELECT est.SG_UF AS SG_UF,
       COUNT(DISTINCT e.CO_CNPJ_BASICO) AS total_empresas,
       COUNT(DISTINCT est.CO_CNPJ_BASICO) AS total_estabelecimentos,
       CAST(SUM(e.VL_CAPITAL_SOCIAL) AS DECIMAL(38,2)) AS total_capital_social,
       -- exact decimal mean rounded half-up at 6 places (integer arithmetic on cents)
       CAST(sign(SUM(e.VL_CAPITAL_SOCIAL)) * ((2 * abs(CAST(SUM(e.VL_CAPITAL_SOCIAL) * 100 AS HUGEINT)) * 10000
             + COUNT(e.VL_CAPITAL_SOCIAL)) // (2 * COUNT(e.VL_CAPITAL_SOCIAL))) AS DECIMAL(38,0))
         * CAST(0.000001 AS DECIMAL(38,6)) AS media_capital_social,
       CAST(SUM(CASE WHEN est.FL_ATIVA THEN 1 ELSE 0 END) AS BIGINT) AS estabelecimentos_ativos,
       CAST(SUM(est.QT_FILIAIS) AS BIGINT) AS total_filiais
FROM fact_establishment e LEFT JOIN est_view est ON e.CO_CNPJ_BASICO = est.CO_CNPJ_BASICO
GROUP BY est.SG_UF"""))
def region_rollup(spark, sf_dir):
    r = _reg(spark, sf_dir)
    return rs.region_rollup(r["fact"], r["est_view"])
