"""Company-registry gold: dimensions, fact and analytic views.

Skew notes. A company may own a third of all establishments. Per-company work is
therefore written as aggregates (map-side partial aggregation folds the hot company
before any shuffle) and joins to per-company results are many-to-one, which AQE's
skew-join split handles on the many side. No window over a company partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import flag_equals
from ..functions.keys import (month_name, quarter, quarter_label, semester, semester_label,
                              surrogate_key)
from .dedup import dedup_by_key
from .joins import broadcast_if_small


def _stamp(df: DataFrame, name: str, run_ts) -> DataFrame:
    return df if run_ts is None else df.withColumn(name, F.lit(run_ts).cast("timestamp"))


def dim_opening_date(establishments: DataFrame, run_ts=None) -> DataFrame:
    """One row per distinct non-NULL opening date (E5, I9) with calendar labels."""
    d = F.col("DT_INICIO_ATIVIDADE")
    base = establishments.select(d).filter(d.isNotNull()).distinct()
    out = base.select(
        d, F.year(d).alias("CO_ANO"), F.month(d).alias("CO_MES"),
        quarter(F.month(d)).alias("CO_TRIMESTRE"), semester(F.month(d)).alias("CO_SEMESTRE"),
        month_name(d).alias("NO_MES"),
        quarter_label(quarter(F.month(d))).alias("NO_TRIMESTRE"),
        semester_label(semester(F.month(d))).alias("NO_SEMESTRE"),
        surrogate_key(d).alias("sk_tempo_abertura"))
    return _stamp(out, "data_criacao", run_ts)


def dim_company(companies: DataFrame, natures: DataFrame, run_ts=None) -> DataFrame:
    """Company with its legal-nature description (selected, Q24), key, one row per key."""
    nat = broadcast_if_small(natures.select(F.col("CODIGO").alias("CODIGO_NATUREZA"),
                                            F.col("DESCRICAO").alias("DESCRICAO_NATUREZA")))
    j = companies.join(nat, F.col("NATUREZA_JURIDICA") == F.col("CODIGO_NATUREZA"), "left")
    out = j.select(
        F.col("CNPJ_BASICO").alias("CO_CNPJ_BASICO"),
        F.col("RAZAO_SOCIAL_NOME_EMPRESARIAL").alias("NO_RAZAO_SOCIAL"),
        "NATUREZA_JURIDICA",
        F.col("DESCRICAO_NATUREZA").alias("NO_NATUREZA_JURIDICA"),
        F.col("QUALIFICACAO_DO_RESPONSAVEL").alias("QUALIFICACAO_RESPONSAVEL"),
        F.col("CAPITAL_SOCIAL_DA_EMPRESA").alias("VL_CAPITAL_SOCIAL"),
        F.col("PORTE_DA_EMPRESA").alias("PORTE_EMPRESA"),
        "ENTE_FEDERATIVO_RESPONSAVEL",
    ).withColumn("sk_empresa", surrogate_key("CO_CNPJ_BASICO"))
    out = dedup_by_key(out, ["CO_CNPJ_BASICO"])
    return _stamp(out, "data_criacao", run_ts)


def dim_establishment(establishments: DataFrame, companies: DataFrame, run_ts=None, flags: bool = False) -> DataFrame:
    """Establishment with its company's size (a real equi join on the company
    key, not the self-comparison of Q11), key on the three id parts, one row per id.

    ``flags`` carries FL_ATIVA and QT_FILIAIS along, from rows that have them already (see
    ``establishment_flags``): the view that M17-M19 expect, without joining the rows to themselves.
    """
    own = [F.col("IS_ATIVA").alias("FL_ATIVA"), F.col("QT_FILIAIS")] if flags else []
    comp = companies.select(F.col("CNPJ_BASICO").alias("_cnpj"),
                            F.col("PORTE_DA_EMPRESA").alias("CO_PORTE"))
    comp = comp.groupBy("_cnpj").agg(F.min("CO_PORTE").alias("CO_PORTE"))
    j = establishments.join(comp, F.col("CNPJ_BASICO") == F.col("_cnpj"), "left")
    out = j.select(
        F.col("CNPJ_BASICO").alias("CO_CNPJ_BASICO"),
        F.col("CNPJ_ORDEM").alias("CO_CNPJ_ORDEM"),
        F.col("CNPJ_DV").alias("CO_CNPJ_DV"),
        F.col("UF").alias("SG_UF"),
        F.col("MUNICIPIO").alias("CO_MUNICIPIO"),
        F.col("CNAE_FISCAL_PRINCIPAL").alias("CO_CNAE_PRINCIPAL"),
        "DT_INICIO_ATIVIDADE",
        F.col("SITUACAO_CADASTRAL").alias("CO_SITUACAO_CADASTRAL"),
        "CO_PORTE", flag_equals("IDENTIFICADOR_MATRIZ_FILIAL", "1").alias("FL_MATRIZ"), *own
    ).withColumn("sk_estabelecimento", surrogate_key("CO_CNPJ_BASICO", "CO_CNPJ_ORDEM", "CO_CNPJ_DV"))
    out = dedup_by_key(out, ["CO_CNPJ_BASICO", "CO_CNPJ_ORDEM", "CO_CNPJ_DV"])
    return _stamp(out, "data_criacao", run_ts)


def dim_partner(partners: DataFrame, qualifications: DataFrame, countries: DataFrame,
                run_ts=None) -> DataFrame:
    """Partner with qualification and country descriptions, one row per (company, partner).

    The rows are reduced before descriptions and key are added: both follow from columns that a kept row
    has, so the wide ones are neither sorted nor shuffled. Of a code with several descriptions the
    first counts, as it would in the order of the joined rows.
    """
    base = dedup_by_key(partners.select(
        F.col("CNPJ_BASICO").alias("CO_CNPJ_BASICO"),
        F.col("IDENTIFICADOR_DO_SOCIO").alias("ID_SOCIO"),
        "NOME_DO_SOCIO", "CPF_CNPJ_DO_SOCIO", "QUALIFICACAO_DO_SOCIO", "FAIXA_ETARIA", "PAIS",
        "DATA_DE_ENTRADA_NA_SOCIEDADE"), ["CO_CNPJ_BASICO", "ID_SOCIO"])
    one = lambda codes: dedup_by_key(codes.select("CODIGO", "DESCRICAO"), ["CODIGO"])
    qual = broadcast_if_small(one(qualifications).toDF("CODIGO_QUALIFICACAO", "DESCRICAO_QUALIFICACAO"))
    ctry = broadcast_if_small(one(countries).toDF("CODIGO_PAIS", "DESCRICAO_PAIS"))
    j = (base.join(qual, F.col("QUALIFICACAO_DO_SOCIO") == F.col("CODIGO_QUALIFICACAO"), "left")
             .join(ctry, F.col("PAIS") == F.col("CODIGO_PAIS"), "left"))
    out = j.select(
        "CO_CNPJ_BASICO", "ID_SOCIO",
        F.col("NOME_DO_SOCIO").alias("NO_SOCIO"),
        F.col("CPF_CNPJ_DO_SOCIO").alias("NU_CPF_CNPJ_SOCIO"),
        F.col("QUALIFICACAO_DO_SOCIO").alias("CO_QUALIFICACAO"),
        F.col("DESCRICAO_QUALIFICACAO").alias("NO_QUALIFICACAO"),
        F.col("FAIXA_ETARIA").alias("NO_FAIXA_ETARIA"),
        F.col("PAIS").alias("CO_PAIS"),
        F.col("DESCRICAO_PAIS").alias("NO_PAIS"),
        F.col("DATA_DE_ENTRADA_NA_SOCIEDADE").alias("DT_ENTRADA_SOCIEDADE"),
    ).withColumn("sk_socio", surrogate_key("CO_CNPJ_BASICO", "ID_SOCIO"))
    return _stamp(out, "data_criacao", run_ts)


def head_office_order(prefix: str = "CO_CNPJ"):
    """Total order of a company's establishments (Q10): the head office first, then the numeric
    order number, then the check digits."""
    ordem, dv = F.col(f"{prefix}_ORDEM"), F.col(f"{prefix}_DV")
    return [~F.col("FL_MATRIZ"), F.length(ordem), ordem, dv]


def fact_establishment(d_company: DataFrame, d_establishment: DataFrame, run_ts=None) -> DataFrame:
    """One row per company with its head-office establishment.

    The establishment side is reduced to one row per company *before* the join
    (partial aggregation), so the join is one-to-one and a company with millions of
    branches costs no more than one with a single branch.
    """
    est = d_establishment.select(
        "CO_CNPJ_BASICO", "CO_CNPJ_ORDEM", "CO_CNPJ_DV", "FL_MATRIZ",
        F.col("SG_UF").alias("SG_UF_RESPONSAVEL"), "DT_INICIO_ATIVIDADE",
        F.col("sk_estabelecimento").alias("fk_estabelecimento"))
    head = dedup_by_key(est, ["CO_CNPJ_BASICO"], head_office_order())
    out = (d_company.select("CO_CNPJ_BASICO", "NO_RAZAO_SOCIAL", "VL_CAPITAL_SOCIAL", "PORTE_EMPRESA",
                            F.col("sk_empresa").alias("fk_empresa"))
           .join(head.drop("CO_CNPJ_ORDEM", "CO_CNPJ_DV", "FL_MATRIZ"), "CO_CNPJ_BASICO", "left")
           .select("CO_CNPJ_BASICO", "NO_RAZAO_SOCIAL", "VL_CAPITAL_SOCIAL", "PORTE_EMPRESA",
                   "SG_UF_RESPONSAVEL", "DT_INICIO_ATIVIDADE", "fk_empresa", "fk_estabelecimento"))
    if run_ts is not None:
        out = out.withColumn("data_processamento_fato", F.lit(run_ts).cast("timestamp"))
    return out


def establishment_flags(establishments: DataFrame) -> DataFrame:
    """L14 flags and branch count.

    IS_MATRIZ = identifier '1', IS_ATIVA = status '02' (NULL -> false); QT_FILIAIS =
    number of non-head-office establishments of the company, 0 when none.
    """
    flagged = establishments.select(
        "*", flag_equals("IDENTIFICADOR_MATRIZ_FILIAL", "1").alias("IS_MATRIZ"),
        flag_equals("SITUACAO_CADASTRAL", "02").alias("IS_ATIVA"))
    branches = (flagged.filter(~F.col("IS_MATRIZ")).groupBy("CNPJ_BASICO").count()
                .withColumnRenamed("count", "QT_FILIAIS"))
    return flagged.join(branches, "CNPJ_BASICO", "left").fillna(0, subset=["QT_FILIAIS"])


def establishment_view(d_establishment: DataFrame, flags: DataFrame) -> DataFrame:
    """Establishment dimension plus FL_ATIVA and QT_FILIAIS (the columns M17-M19 expect)."""
    f = flags.select(F.col("CNPJ_BASICO").alias("CO_CNPJ_BASICO"),
                     F.col("CNPJ_ORDEM").alias("CO_CNPJ_ORDEM"), F.col("CNPJ_DV").alias("CO_CNPJ_DV"),
                     F.col("IS_ATIVA").alias("FL_ATIVA"), "QT_FILIAIS")
    return d_establishment.join(f, ["CO_CNPJ_BASICO", "CO_CNPJ_ORDEM", "CO_CNPJ_DV"], "left")


def _fact_with_establishments(fact: DataFrame, est_view: DataFrame) -> DataFrame:
    """fact LEFT JOIN establishments on the company key, written skew-safe: a company may own a third of
    all establishments, and of an outer join only the preserved side can be split.

    The fact says itself which companies have no establishment (no head office, hence no key),
    so those rows are added to an inner join, whose two sides can both be split.
    """
    est = est_view.select(*[F.col(c).alias(f"est_{c}") for c in est_view.columns])
    matched = fact.join(est, fact["CO_CNPJ_BASICO"] == est["est_CO_CNPJ_BASICO"])
    alone = fact.where(F.col("fk_estabelecimento").isNull()).select(
        "*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in est.schema.fields])
    return matched.unionByName(alone)


def company_complete(fact: DataFrame, est_view: DataFrame) -> DataFrame:
    """Company fact with every establishment of the company."""
    j = _fact_with_establishments(fact, est_view)
    return j.select(
        "CO_CNPJ_BASICO", "NO_RAZAO_SOCIAL", "VL_CAPITAL_SOCIAL", F.col("PORTE_EMPRESA").alias("NO_PORTE"),
        "SG_UF_RESPONSAVEL", F.col("est_CO_CNPJ_ORDEM").alias("CO_CNPJ_ORDEM"), F.col("est_SG_UF").alias("SG_UF"),
        F.col("est_CO_MUNICIPIO").alias("CO_MUNICIPIO"), F.col("est_CO_CNAE_PRINCIPAL").alias("CO_CNAE_PRINCIPAL"),
        F.col("est_DT_INICIO_ATIVIDADE").alias("DT_INICIO_ATIVIDADE"), F.col("est_FL_ATIVA").alias("FL_ATIVA"),
        F.col("est_QT_FILIAIS").alias("QT_FILIAIS"))


def company_partner(d_partner: DataFrame, fact: DataFrame) -> DataFrame:
    """Partner profile with its company's figures."""
    es, e = d_partner.alias("es"), fact.alias("e")
    return es.join(e, F.col("es.CO_CNPJ_BASICO") == F.col("e.CO_CNPJ_BASICO"), "left").select(
        F.col("es.CO_CNPJ_BASICO").alias("CO_CNPJ_BASICO"), F.col("e.NO_RAZAO_SOCIAL").alias("NO_RAZAO_SOCIAL"),
        F.col("es.ID_SOCIO").alias("ID_SOCIO"), F.col("es.NO_SOCIO").alias("NO_SOCIO"),
        F.col("es.NU_CPF_CNPJ_SOCIO").alias("NU_CPF_CNPJ_SOCIO"),
        F.col("es.NO_QUALIFICACAO").alias("NO_QUALIFICACAO"),
        F.col("es.NO_FAIXA_ETARIA").alias("NO_FAIXA_ETARIA"), F.col("es.NO_PAIS").alias("NO_PAIS"),
        F.col("es.DT_ENTRADA_SOCIEDADE").alias("DT_ENTRADA_SOCIEDADE"),
        F.col("e.PORTE_EMPRESA").alias("NO_PORTE"), F.col("e.VL_CAPITAL_SOCIAL").alias("VL_CAPITAL_SOCIAL"))


def region_rollup(fact: DataFrame, est_view: DataFrame) -> DataFrame:
    """Per state, over company fact LEFT JOIN establishments (the view's grain)."""
    j = _fact_with_establishments(fact, est_view)
    return j.groupBy(F.col("est_SG_UF").alias("SG_UF")).agg(
        F.countDistinct("CO_CNPJ_BASICO").alias("total_empresas"),
        F.countDistinct("est_CO_CNPJ_BASICO").alias("total_estabelecimentos"),
        F.sum("VL_CAPITAL_SOCIAL").cast("decimal(38,2)").alias("total_capital_social"),
        F.avg("VL_CAPITAL_SOCIAL").cast("decimal(38,6)").alias("media_capital_social"),
        F.sum(F.when(F.col("est_FL_ATIVA"), 1).otherwise(0)).cast("bigint").alias("estabelecimentos_ativos"),
        F.sum("est_QT_FILIAIS").cast("bigint").alias("total_filiais"))
