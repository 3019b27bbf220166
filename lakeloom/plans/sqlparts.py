"""DuckDB oracle fragments mirroring ``standins`` (independent SQL, same contract).

Each ``*_CTE`` is one ``name AS (...)`` block; queries join the blocks they need.
"""

from __future__ import annotations


def pad(expr: str, width: int) -> str:
    """lpad to width, cutting longer values (Spark ``lpad`` semantics)."""
    return f"lpad(CAST({expr} AS VARCHAR), {width}, '0')"


def pad_nt(expr: str, width: int) -> str:
    """Pad without cutting."""
    s = f"CAST({expr} AS VARCHAR)"
    return f"(CASE WHEN length({s}) >= {width} THEN {s} ELSE lpad({s}, {width}, '0') END)"


def sk(*exprs: str) -> str:
    parts = ", ".join(f"CAST({e} AS VARCHAR)" for e in exprs)
    return f"sha256(concat_ws('||', {parts}))"


TRADE_CTE = f"""trade AS (
  SELECT CAST(year(l.l_shipdate) AS INTEGER) AS CO_ANO,
         CAST(month(l.l_shipdate) AS INTEGER) AS CO_MES,
         {pad_nt('l.l_partkey', 8)} AS CO_NCM,
         CAST(c.c_nationkey AS INTEGER) AS CO_PAIS,
         substring(c.c_mktsegment, 1, 2) AS SG_UF_NCM,
         TRY_CAST(l.l_quantity AS BIGINT) AS QT_ESTAT,
         TRY_CAST(l.l_quantity * 1000 AS BIGINT) AS KG_LIQUIDO,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS VL_FOB,
         CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_tax AS DECIMAL(12,2)) AS DECIMAL(18,4)) AS VL_FRETE,
         CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_discount AS DECIMAL(12,2)) AS DECIMAL(18,4)) AS VL_SEGURO,
         CASE WHEN coalesce(l.l_returnflag = 'R', false) THEN 'IMP' ELSE 'EXP' END AS TIPO_OPERACAO
  FROM lineitem l
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
)"""

DIM_MONTH_CTE = f"""dim_month AS (
  SELECT CO_ANO, CO_MES,
         CAST(ceil(CO_MES / 3) AS BIGINT) AS CO_TRIMESTRE,
         CAST(ceil(CO_MES / 6) AS BIGINT) AS CO_SEMESTRE,
         CAST(CAST(ceil(CO_MES / 3) AS BIGINT) AS VARCHAR) || 'º Trimestre' AS NO_TRIMESTRE,
         CAST(CAST(ceil(CO_MES / 6) AS BIGINT) AS VARCHAR) || 'º Semestre' AS NO_SEMESTRE,
         {sk('CO_ANO', 'CO_MES')} AS sk_tempo
  FROM (SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS CO_ANO,
                        CAST(month(l_shipdate) AS INTEGER) AS CO_MES FROM lineitem) p
)"""

DIM_PRODUCT_CTE = f"""ncm AS (
  SELECT {pad_nt('p_partkey', 8)} AS CO_NCM,
         {pad("regexp_extract(p_brand, '(\\d+)$', 1)", 6)} AS CO_SH6,
         p_type AS CO_ISIC_CLASSE,
         {pad('p_size', 3)} AS CO_CGCE_N3,
         {pad('CAST(floor(p_retailprice / 10) AS BIGINT)', 3)} AS CO_FAT_AGREG,
         upper(p_name) AS NO_NCM_POR
  FROM part
),
sh AS (
  SELECT CO_SH6, substring(CO_SH6, 1, 4) AS CO_SH4, substring(CO_SH6, 1, 2) AS CO_SH2, NO_SH6_POR
  FROM (SELECT {pad("regexp_extract(p_brand, '(\\d+)$', 1)", 6)} AS CO_SH6, min(p_brand) AS NO_SH6_POR
        FROM part GROUP BY 1) x
),
isic AS (SELECT DISTINCT p_type AS CO_ISIC_CLASSE, lower(p_type) AS NO_ISIC_CLASSE FROM part),
cgce AS (
  SELECT DISTINCT {pad('p_size', 3)} AS CO_CGCE_N3,
         {pad('CAST(floor(p_size / 10) AS BIGINT)', 2)} AS CO_CGCE_N2,
         'SIZE ' || CAST(p_size AS VARCHAR) AS NO_CGCE_N3
  FROM part
),
fat AS (
  SELECT DISTINCT {pad('CAST(floor(p_retailprice / 10) AS BIGINT)', 3)} AS CO_FAT_AGREG,
         'BAND ' || {pad('CAST(floor(p_retailprice / 10) AS BIGINT)', 3)} AS NO_FAT_AGREG
  FROM part
),
dim_product AS (
  SELECT ncm.*, sh.CO_SH4, sh.CO_SH2, sh.NO_SH6_POR, isic.NO_ISIC_CLASSE,
         cgce.CO_CGCE_N2, cgce.NO_CGCE_N3, fat.NO_FAT_AGREG,
         {sk('ncm.CO_NCM')} AS sk_produto
  FROM ncm
  LEFT JOIN sh ON ncm.CO_SH6 = sh.CO_SH6
  LEFT JOIN isic ON ncm.CO_ISIC_CLASSE = isic.CO_ISIC_CLASSE
  LEFT JOIN cgce ON ncm.CO_CGCE_N3 = cgce.CO_CGCE_N3
  LEFT JOIN fat ON ncm.CO_FAT_AGREG = fat.CO_FAT_AGREG
)"""

DIM_GEO_CTE = f"""dim_geography AS (
  SELECT CAST(n_nationkey AS INTEGER) AS CO_PAIS, {pad('n_nationkey', 3)} AS CO_PAIS_ISON3,
         n_name AS NO_PAIS, {sk('CAST(n_nationkey AS INTEGER)')} AS sk_geografia
  FROM nation
)"""

DIM_LOCALITY_CTE = f"""dim_locality AS (
  SELECT CAST(n.n_nationkey AS INTEGER) AS CO_MUN_GEO, n.n_name AS NO_MUN, {pad('n.n_regionkey', 2)} AS SG_UF,
         CAST(r.r_regionkey AS INTEGER) AS CO_UF, r.r_name AS NO_UF, 'REGIAO ' || r.r_name AS NO_REGIAO,
         {sk('r.r_name', 'CAST(n.n_nationkey AS INTEGER)')} AS sk_localidade
  FROM nation n LEFT JOIN region r ON {pad('n.n_regionkey', 2)} = {pad('r.r_regionkey', 2)}
)"""


def fact_cte(kind: str) -> str:
    name = "fact_export" if kind == "EXP" else "fact_import"
    extra = ("t.VL_FRETE AS valor_frete, t.VL_SEGURO AS valor_seguro," if kind == "IMP" else "")
    return f"""{name} AS (
  SELECT t.CO_ANO, t.CO_MES, t.CO_NCM, t.CO_PAIS, t.SG_UF_NCM,
         t.QT_ESTAT AS quantidade_estatistica, t.KG_LIQUIDO AS peso_liquido_kg, t.VL_FOB AS valor_fob,
         {extra}
         t.TIPO_OPERACAO,
         m.sk_tempo AS fk_tempo, p.sk_produto AS fk_produto, g.sk_geografia AS fk_geografia
  FROM trade t
  LEFT JOIN dim_month m ON t.CO_ANO = m.CO_ANO AND t.CO_MES = m.CO_MES
  LEFT JOIN dim_product p ON t.CO_NCM = p.CO_NCM
  LEFT JOIN dim_geography g ON t.CO_PAIS = g.CO_PAIS
  WHERE t.TIPO_OPERACAO = '{kind}'
)"""


CONSOLIDATED_CTE = """consolidated AS (
  SELECT fk_tempo, fk_produto, fk_geografia, CO_ANO, CO_MES, valor_fob, peso_liquido_kg,
         TIPO_OPERACAO AS tipo_operacao,
         CAST(0 AS DECIMAL(18,4)) AS valor_frete, CAST(0 AS DECIMAL(18,4)) AS valor_seguro
  FROM fact_export
  UNION ALL
  SELECT fk_tempo, fk_produto, fk_geografia, CO_ANO, CO_MES, valor_fob, peso_liquido_kg,
         TIPO_OPERACAO AS tipo_operacao, valor_frete, valor_seguro
  FROM fact_import
)"""

STAR_CTES = [TRADE_CTE, DIM_MONTH_CTE, DIM_PRODUCT_CTE, DIM_GEO_CTE,
             fact_cte("EXP"), fact_cte("IMP"), CONSOLIDATED_CTE]


def with_(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


# ------------------------------------------------------------------ registry

def clean_text_sql(expr: str) -> str:
    """trim -> accents -> keep [a-zA-Z0-9] and ASCII whitespace -> blank to NULL -> upper."""
    from ..functions.cleaning import ACCENTED, UNACCENTED
    r = (f"regexp_replace(translate(trim({expr}), '{ACCENTED}', '{UNACCENTED}'), "
         r"'[^a-zA-Z0-9 \t\n\x0B\f\r]', '', 'g')")
    return f"upper(CASE WHEN trim({r}) = '' THEN NULL ELSE {r} END)"


def order_all(*cols: str) -> str:
    return ", ".join(f"{c} NULLS FIRST" for c in cols)


COMPANIES_CTE = f"""companies AS (
  SELECT {pad_nt('c_custkey', 8)} AS CNPJ_BASICO,
         {clean_text_sql('c_name')} AS RAZAO_SOCIAL_NOME_EMPRESARIAL,
         {pad('c_nationkey', 4)} AS NATUREZA_JURIDICA,
         {pad('c_custkey % 5', 2)} AS QUALIFICACAO_DO_RESPONSAVEL,
         TRY_CAST(c_acctbal AS DECIMAL(18,2)) AS CAPITAL_SOCIAL_DA_EMPRESA,
         c_mktsegment AS PORTE_DA_EMPRESA,
         'NAO INFORMADO' AS ENTE_FEDERATIVO_RESPONSAVEL
  FROM customer
  WHERE {pad_nt('c_custkey', 8)} IS NOT NULL AND {pad_nt('c_custkey', 8)} <> '00000000'
)"""

NATURES_CTE = f"natures AS (SELECT {pad('n_nationkey', 4)} AS CODIGO, n_name AS DESCRICAO FROM nation)"
RCOUNTRIES_CTE = f"rcountries AS (SELECT {pad('n_nationkey', 3)} AS CODIGO, n_name AS DESCRICAO FROM nation)"
QUALS_CTE = f"quals AS (SELECT {pad('r_regionkey', 2)} AS CODIGO, r_name AS DESCRICAO FROM region)"

EST_CTE = f"""est AS (
  SELECT {pad_nt('o.o_custkey', 8)} AS CNPJ_BASICO,
         {pad_nt('o.o_orderkey', 4)} AS CNPJ_ORDEM,
         {pad('o.o_orderkey % 97', 2)} AS CNPJ_DV,
         CASE WHEN o.o_orderkey = h.head_key THEN '1' ELSE '2' END AS IDENTIFICADOR_MATRIZ_FILIAL,
         CASE WHEN o.o_orderstatus = 'O' THEN '02' WHEN o.o_orderstatus = 'F' THEN '08' ELSE '04' END
           AS SITUACAO_CADASTRAL,
         CAST(o.o_orderdate AS DATE) AS DT_INICIO_ATIVIDADE,
         {pad("regexp_extract(o.o_orderpriority, '^(\\d+)', 1)", 7)} AS CNAE_FISCAL_PRINCIPAL,
         {pad('n.n_regionkey', 2)} AS UF,
         {pad('c.c_nationkey', 4)} AS MUNICIPIO
  FROM orders o
  LEFT JOIN (SELECT o_custkey, max(o_orderkey) AS head_key FROM orders GROUP BY o_custkey) h
    ON o.o_custkey = h.o_custkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

PARTNERS_CTE = f"""partners AS (
  SELECT {pad_nt('p.o_custkey', 8)} AS CNPJ_BASICO,
         {pad_nt('p.l_suppkey', 6)} AS IDENTIFICADOR_DO_SOCIO,
         upper(s.s_name) AS NOME_DO_SOCIO,
         '***' || {pad('p.l_suppkey % 1000', 3)} || '**' AS CPF_CNPJ_DO_SOCIO,
         {pad('p.l_suppkey % 5', 2)} AS QUALIFICACAO_DO_SOCIO,
         CAST(p.first_date AS DATE) AS DATA_DE_ENTRADA_NA_SOCIEDADE,
         {pad('s.s_nationkey', 3)} AS PAIS,
         '0' AS FAIXA_ETARIA
  FROM (SELECT o.o_custkey, l.l_suppkey, min(o.o_orderdate) AS first_date
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
        GROUP BY o.o_custkey, l.l_suppkey) p
  LEFT JOIN supplier s ON p.l_suppkey = s.s_suppkey
)"""

DIM_COMPANY_CTE = f"""dim_company AS (
  SELECT c.CNPJ_BASICO AS CO_CNPJ_BASICO, c.RAZAO_SOCIAL_NOME_EMPRESARIAL AS NO_RAZAO_SOCIAL,
         c.NATUREZA_JURIDICA, n.DESCRICAO AS NO_NATUREZA_JURIDICA,
         c.QUALIFICACAO_DO_RESPONSAVEL AS QUALIFICACAO_RESPONSAVEL,
         c.CAPITAL_SOCIAL_DA_EMPRESA AS VL_CAPITAL_SOCIAL, c.PORTE_DA_EMPRESA AS PORTE_EMPRESA,
         c.ENTE_FEDERATIVO_RESPONSAVEL, {sk('c.CNPJ_BASICO')} AS sk_empresa
  FROM companies c LEFT JOIN natures n ON c.NATUREZA_JURIDICA = n.CODIGO
  QUALIFY row_number() OVER (PARTITION BY c.CNPJ_BASICO ORDER BY {order_all(
      'c.RAZAO_SOCIAL_NOME_EMPRESARIAL', 'c.NATUREZA_JURIDICA', 'n.DESCRICAO', 'c.QUALIFICACAO_DO_RESPONSAVEL',
      'c.CAPITAL_SOCIAL_DA_EMPRESA', 'c.PORTE_DA_EMPRESA')}) = 1
)"""

DIM_EST_CTE = f"""dim_establishment AS (
  SELECT e.CNPJ_BASICO AS CO_CNPJ_BASICO, e.CNPJ_ORDEM AS CO_CNPJ_ORDEM, e.CNPJ_DV AS CO_CNPJ_DV,
         e.UF AS SG_UF, e.MUNICIPIO AS CO_MUNICIPIO, e.CNAE_FISCAL_PRINCIPAL AS CO_CNAE_PRINCIPAL,
         e.DT_INICIO_ATIVIDADE, e.SITUACAO_CADASTRAL AS CO_SITUACAO_CADASTRAL, cp.CO_PORTE,
         coalesce(e.IDENTIFICADOR_MATRIZ_FILIAL = '1', false) AS FL_MATRIZ,
         {sk('e.CNPJ_BASICO', 'e.CNPJ_ORDEM', 'e.CNPJ_DV')} AS sk_estabelecimento
  FROM est e
  LEFT JOIN (SELECT CNPJ_BASICO, min(PORTE_DA_EMPRESA) AS CO_PORTE FROM companies GROUP BY CNPJ_BASICO) cp
    ON e.CNPJ_BASICO = cp.CNPJ_BASICO
  QUALIFY row_number() OVER (PARTITION BY e.CNPJ_BASICO, e.CNPJ_ORDEM, e.CNPJ_DV ORDER BY {order_all(
      'e.UF', 'e.MUNICIPIO', 'e.CNAE_FISCAL_PRINCIPAL', 'e.DT_INICIO_ATIVIDADE', 'e.SITUACAO_CADASTRAL',
      'cp.CO_PORTE', 'FL_MATRIZ')}) = 1
)"""

DIM_PARTNER_CTE = f"""dim_partner AS (
  SELECT p.CNPJ_BASICO AS CO_CNPJ_BASICO, p.IDENTIFICADOR_DO_SOCIO AS ID_SOCIO, p.NOME_DO_SOCIO AS NO_SOCIO,
         p.CPF_CNPJ_DO_SOCIO AS NU_CPF_CNPJ_SOCIO, p.QUALIFICACAO_DO_SOCIO AS CO_QUALIFICACAO,
         q.DESCRICAO AS NO_QUALIFICACAO, p.FAIXA_ETARIA AS NO_FAIXA_ETARIA, p.PAIS AS CO_PAIS,
         k.DESCRICAO AS NO_PAIS, p.DATA_DE_ENTRADA_NA_SOCIEDADE AS DT_ENTRADA_SOCIEDADE,
         {sk('p.CNPJ_BASICO', 'p.IDENTIFICADOR_DO_SOCIO')} AS sk_socio
  FROM partners p
  LEFT JOIN quals q ON p.QUALIFICACAO_DO_SOCIO = q.CODIGO
  LEFT JOIN rcountries k ON p.PAIS = k.CODIGO
  QUALIFY row_number() OVER (PARTITION BY p.CNPJ_BASICO, p.IDENTIFICADOR_DO_SOCIO ORDER BY {order_all(
      'p.NOME_DO_SOCIO', 'p.CPF_CNPJ_DO_SOCIO', 'p.QUALIFICACAO_DO_SOCIO', 'q.DESCRICAO', 'p.FAIXA_ETARIA',
      'p.PAIS', 'k.DESCRICAO', 'p.DATA_DE_ENTRADA_NA_SOCIEDADE')}) = 1
)"""

FACT_EST_CTE = """head AS (
  SELECT CO_CNPJ_BASICO, SG_UF AS SG_UF_RESPONSAVEL, DT_INICIO_ATIVIDADE, sk_estabelecimento AS fk_estabelecimento
  FROM dim_establishment
  QUALIFY row_number() OVER (PARTITION BY CO_CNPJ_BASICO ORDER BY NOT FL_MATRIZ, length(CO_CNPJ_ORDEM), CO_CNPJ_ORDEM,
          CO_CNPJ_DV, SG_UF NULLS FIRST, DT_INICIO_ATIVIDADE NULLS FIRST, sk_estabelecimento) = 1
),
fact_establishment AS (
  SELECT d.CO_CNPJ_BASICO, d.NO_RAZAO_SOCIAL, d.VL_CAPITAL_SOCIAL, d.PORTE_EMPRESA, h.SG_UF_RESPONSAVEL,
         h.DT_INICIO_ATIVIDADE, d.sk_empresa AS fk_empresa, h.fk_estabelecimento
  FROM dim_company d LEFT JOIN head h ON d.CO_CNPJ_BASICO = h.CO_CNPJ_BASICO
)"""

FLAGS_CTE = """flags AS (
  SELECT e.*, coalesce(e.IDENTIFICADOR_MATRIZ_FILIAL = '1', false) AS IS_MATRIZ,
         coalesce(e.SITUACAO_CADASTRAL = '02', false) AS IS_ATIVA,
         coalesce(b.QT_FILIAIS, 0) AS QT_FILIAIS
  FROM est e
  LEFT JOIN (SELECT CNPJ_BASICO, count(*) AS QT_FILIAIS FROM est
             WHERE NOT coalesce(IDENTIFICADOR_MATRIZ_FILIAL = '1', false) GROUP BY CNPJ_BASICO) b
    ON e.CNPJ_BASICO = b.CNPJ_BASICO
),
est_view AS (
  SELECT d.*, f.IS_ATIVA AS FL_ATIVA, f.QT_FILIAIS
  FROM dim_establishment d
  LEFT JOIN flags f ON d.CO_CNPJ_BASICO = f.CNPJ_BASICO AND d.CO_CNPJ_ORDEM = f.CNPJ_ORDEM
                   AND d.CO_CNPJ_DV = f.CNPJ_DV
)"""

REGISTRY_CTES = [COMPANIES_CTE, NATURES_CTE, RCOUNTRIES_CTE, QUALS_CTE, EST_CTE, PARTNERS_CTE,
                 DIM_COMPANY_CTE, DIM_EST_CTE, DIM_PARTNER_CTE, FACT_EST_CTE, FLAGS_CTE]
