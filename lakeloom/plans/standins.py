"""Silver-shaped inputs derived by Spark from the driver's parquet tables.

The source pipeline reads foreign-trade and company-registry files; the test data
is a TPC-H-like star. This module is the one place where that mapping lives:

* trade rows = lineitem (+ its order's customer): year/month from the ship date,
  product = part, country = customer nation, ``l_returnflag = 'R'`` are imports
  (freight = price x tax, insurance = price x discount), the rest exports;
* product hierarchy lookups = distinct brand, type, size and price band of part;
* countries = nation; states = region; municipalities = nation;
* companies = customer; establishments = orders (head office = lowest order key of
  the customer); partners = the suppliers that supplied a customer's orders;
  legal natures and countries = nation; qualifications = region.

Every function reads whole tables through ``Tables`` (column pruning and filters
reach the parquet scan) and returns a lazy DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cleaning import clean_text_df, not_informed, zero_pad
from ..operators.joins import broadcast_if_small

#: Suppliers (a key, a name and a code each) that are sent to every task rather than moving the pairs to them.
SUPPLIERS_BROADCAST = 1_000_000

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


class Tables:
    """Lazy handles on ``{sf_dir}/{name}.parquet``; ``overrides`` swaps in other sources
    (for example catalog tables bucketed on their join keys, see ``bucket_for_joins``)."""

    def __init__(self, spark: SparkSession, sf_dir: str, overrides: dict[str, DataFrame] | None = None):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        for name, df in (overrides or {}).items():
            setattr(self, name, df)

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        setattr(self, name, df)
        return df


# ------------------------------------------------------------------ trade

def trade_rows(t: Tables) -> DataFrame:
    """Typed trade rows for both operation types (silver exp/imp shape, L10/L11).

    lineitem LEFT JOIN orders LEFT JOIN customer: every line is kept once per
    matching order; a line without order/customer keeps a NULL country.
    """
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice",
                           "l_discount", "l_tax", "l_returnflag", "l_shipdate")
    # Both keys are primary; stated by an aggregate, so a query that reads neither country nor
    # segment reads lineitem alone.
    o = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey").dropDuplicates(["l_orderkey"])
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment").dropDuplicates(["o_custkey"])
    j = li.join(o, "l_orderkey", "left").join(c, "o_custkey", "left")
    is_imp = F.coalesce(F.col("l_returnflag") == F.lit("R"), F.lit(False))
    # Money is exact decimal from here on, so totals never depend on summation order.
    price = F.col("l_extendedprice").try_cast("decimal(18,2)")
    return j.select(
        F.year("l_shipdate").alias("CO_ANO"),
        F.month("l_shipdate").alias("CO_MES"),
        zero_pad(F.col("l_partkey"), 8, truncate=False).alias("CO_NCM"),
        F.col("c_nationkey").cast("int").alias("CO_PAIS"),
        F.substring("c_mktsegment", 1, 2).alias("SG_UF_NCM"),
        F.col("l_quantity").try_cast("bigint").alias("QT_ESTAT"),
        (F.col("l_quantity") * 1000).try_cast("bigint").alias("KG_LIQUIDO"),
        price.alias("VL_FOB"),
        (price * F.col("l_tax").try_cast("decimal(12,2)")).cast("decimal(18,4)").alias("VL_FRETE"),
        (price * F.col("l_discount").try_cast("decimal(12,2)")).cast("decimal(18,4)").alias("VL_SEGURO"),
        F.when(is_imp, F.lit("IMP")).otherwise(F.lit("EXP")).alias("TIPO_OPERACAO"),
    )


def exports(t: Tables) -> DataFrame:
    return trade_rows(t).filter(F.col("TIPO_OPERACAO") == "EXP").drop("VL_FRETE", "VL_SEGURO")


def imports(t: Tables) -> DataFrame:
    return trade_rows(t).filter(F.col("TIPO_OPERACAO") == "IMP")


def trade_periods(t: Tables, kind: str | None = None) -> DataFrame:
    """Year/month of one operation type, or of both. The left joins above keep every
    lineitem, so the distinct periods come from lineitem alone (no join needed)."""
    if kind is None:
        return t.lineitem.select(F.year("l_shipdate").alias("CO_ANO"), F.month("l_shipdate").alias("CO_MES"))
    flag = F.coalesce(F.col("l_returnflag") == F.lit("R"), F.lit(False))
    li = t.lineitem.filter(flag if kind == "IMP" else ~flag)
    return li.select(F.year("l_shipdate").alias("CO_ANO"), F.month("l_shipdate").alias("CO_MES"))


def product_codes(t: Tables) -> DataFrame:
    """Silver product table (L1 shape): one row per part."""
    p = t.part
    return p.select(
        zero_pad(F.col("p_partkey"), 8, truncate=False).alias("CO_NCM"),
        zero_pad(F.regexp_extract("p_brand", r"(\d+)$", 1), 6).alias("CO_SH6"),
        F.col("p_type").alias("CO_ISIC_CLASSE"),
        zero_pad(F.col("p_size"), 3).alias("CO_CGCE_N3"),
        zero_pad(F.floor(F.col("p_retailprice") / 10), 3).alias("CO_FAT_AGREG"),
        F.upper(F.col("p_name")).alias("NO_NCM_POR"),
    )


def hs_lookup(t: Tables) -> DataFrame:
    """L2 shape: HS hierarchy by brand."""
    code = zero_pad(F.regexp_extract("p_brand", r"(\d+)$", 1), 6)
    return (t.part.groupBy(code.alias("CO_SH6")).agg(F.min("p_brand").alias("NO_SH6_POR"))
            .select("CO_SH6", F.substring("CO_SH6", 1, 4).alias("CO_SH4"),
                    F.substring("CO_SH6", 1, 2).alias("CO_SH2"), "NO_SH6_POR"))


def isic_lookup(t: Tables) -> DataFrame:
    """L3 shape: activity class by part type."""
    return (t.part.select(F.col("p_type").alias("CO_ISIC_CLASSE")).distinct()
            .select("CO_ISIC_CLASSE", F.lower("CO_ISIC_CLASSE").alias("NO_ISIC_CLASSE")))


def cgce_lookup(t: Tables) -> DataFrame:
    """L4 shape: economic category by size (level 2 = tens of the size)."""
    return (t.part.select(F.col("p_size")).distinct()
            .select(zero_pad(F.col("p_size"), 3).alias("CO_CGCE_N3"),
                    zero_pad(F.floor(F.col("p_size") / 10), 2).alias("CO_CGCE_N2"),
                    F.concat(F.lit("SIZE "), F.col("p_size").cast("string")).alias("NO_CGCE_N3")))


def fat_lookup(t: Tables) -> DataFrame:
    """L5 shape: aggregate factor by price band of 10."""
    band = zero_pad(F.floor(F.col("p_retailprice") / 10), 3)
    return (t.part.select(band.alias("CO_FAT_AGREG")).distinct()
            .select("CO_FAT_AGREG", F.concat(F.lit("BAND "), F.col("CO_FAT_AGREG")).alias("NO_FAT_AGREG")))


def countries(t: Tables) -> DataFrame:
    """L6 shape."""
    return t.nation.select(F.col("n_nationkey").cast("int").alias("CO_PAIS"),
                           zero_pad(F.col("n_nationkey"), 3).alias("CO_PAIS_ISON3"),
                           F.col("n_name").alias("NO_PAIS"))


def states(t: Tables) -> DataFrame:
    """L8 shape."""
    return t.region.select(zero_pad(F.col("r_regionkey"), 2).alias("SG_UF"),
                           F.col("r_regionkey").cast("int").alias("CO_UF"),
                           F.col("r_name").alias("NO_UF"),
                           F.concat(F.lit("REGIAO "), F.col("r_name")).alias("NO_REGIAO"))


def municipalities(t: Tables) -> DataFrame:
    """L9 shape."""
    return t.nation.select(F.col("n_nationkey").cast("int").alias("CO_MUN_GEO"),
                           F.col("n_name").alias("NO_MUN"),
                           zero_pad(F.col("n_regionkey"), 2).alias("SG_UF"))


# ------------------------------------------------------------------ registry

def companies(t: Tables) -> DataFrame:
    """Silver companies (L13 shape) with the E1/E2 key rules applied."""
    c = t.customer.select(
        zero_pad(F.col("c_custkey"), 8, truncate=False).alias("CNPJ_BASICO"),
        F.col("c_name").alias("RAZAO_SOCIAL_NOME_EMPRESARIAL"),
        zero_pad(F.col("c_nationkey"), 4).alias("NATUREZA_JURIDICA"),
        zero_pad(F.pmod(F.col("c_custkey"), F.lit(5)), 2).alias("QUALIFICACAO_DO_RESPONSAVEL"),
        F.col("c_acctbal").try_cast("decimal(18,2)").alias("CAPITAL_SOCIAL_DA_EMPRESA"),
        F.col("c_mktsegment").alias("PORTE_DA_EMPRESA"),
        not_informed(F.lit(None).cast("string")).alias("ENTE_FEDERATIVO_RESPONSAVEL"),
    )
    c = c.filter(F.col("CNPJ_BASICO").isNotNull() & (F.col("CNPJ_BASICO") != "00000000"))
    return clean_text_df(c, ["RAZAO_SOCIAL_NOME_EMPRESARIAL"])


def legal_natures(t: Tables) -> DataFrame:
    """Code table (L16 shape): nation as legal nature."""
    return t.nation.select(zero_pad(F.col("n_nationkey"), 4).alias("CODIGO"),
                           F.col("n_name").alias("DESCRICAO"))


def registry_countries(t: Tables) -> DataFrame:
    """Code table (L17 shape)."""
    return t.nation.select(zero_pad(F.col("n_nationkey"), 3).alias("CODIGO"),
                           F.col("n_name").alias("DESCRICAO"))


def qualifications(t: Tables) -> DataFrame:
    """Code table (L18 shape): region as qualification."""
    return t.region.select(zero_pad(F.col("r_regionkey"), 2).alias("CODIGO"),
                           F.col("r_name").alias("DESCRICAO"))


def establishments(t: Tables) -> DataFrame:
    """Silver establishments (L14 shape) from orders.

    Head office (``IDENTIFICADOR_MATRIZ_FILIAL = '1'``) is the customer's highest order
    key, so it is not the lowest order number: a per-customer ``max`` (partially aggregated, so a hot customer is folded on
    the map side) joined back on the customer key (G2 form; AQE splits skewed keys).
    """
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    heads = o.groupBy("o_custkey").agg(F.max("o_orderkey").alias("head_key"))
    n = broadcast_if_small(t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey"))
    loc = (t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
           .join(n, "c_nationkey", "left"))
    j = o.join(heads, "o_custkey", "left").join(loc, "o_custkey", "left")
    status = (F.when(F.col("o_orderstatus") == "O", F.lit("02"))
               .when(F.col("o_orderstatus") == "F", F.lit("08"))
               .otherwise(F.lit("04")))
    return j.select(
        zero_pad(F.col("o_custkey"), 8, truncate=False).alias("CNPJ_BASICO"),
        zero_pad(F.col("o_orderkey"), 4, truncate=False).alias("CNPJ_ORDEM"),
        zero_pad(F.pmod(F.col("o_orderkey"), F.lit(97)), 2).alias("CNPJ_DV"),
        F.when(F.col("o_orderkey") == F.col("head_key"), F.lit("1")).otherwise(F.lit("2"))
         .alias("IDENTIFICADOR_MATRIZ_FILIAL"),
        status.alias("SITUACAO_CADASTRAL"),
        F.to_date("o_orderdate").alias("DT_INICIO_ATIVIDADE"),
        zero_pad(F.regexp_extract("o_orderpriority", r"^(\d+)", 1), 7).alias("CNAE_FISCAL_PRINCIPAL"),
        zero_pad(F.col("n_regionkey"), 2).alias("UF"),
        zero_pad(F.col("c_nationkey"), 4).alias("MUNICIPIO"),
    )


def partners(t: Tables) -> DataFrame:
    """Silver partners (L20 shape): suppliers that supplied a customer's orders.

    Pairs are aggregated after the lineitem-orders join (map-side partial
    aggregation first), entry date = first order date of the pair. They are grouped by the padded
    ids that stand for them one to one, so that a dimension with a row per (company, partner)
    finds its rows where they have to be; suppliers are broadcast while they are few.
    """
    li = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_suppkey")
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    pairs = (li.join(o, "o_orderkey")
               .groupBy(zero_pad(F.col("o_custkey"), 8, truncate=False).alias("CNPJ_BASICO"),
                        zero_pad(F.col("l_suppkey"), 6, truncate=False).alias("IDENTIFICADOR_DO_SOCIO"))
               .agg(F.min("o_orderdate").alias("first_date"), F.min("l_suppkey").alias("l_suppkey")))
    s = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_name", "s_nationkey")
    j = pairs.join(broadcast_if_small(s, SUPPLIERS_BROADCAST), "l_suppkey", "left")
    return j.select(
        "CNPJ_BASICO", "IDENTIFICADOR_DO_SOCIO",
        F.upper("s_name").alias("NOME_DO_SOCIO"),
        F.concat(F.lit("***"), zero_pad(F.pmod(F.col("l_suppkey"), F.lit(1000)), 3), F.lit("**"))
         .alias("CPF_CNPJ_DO_SOCIO"),
        zero_pad(F.pmod(F.col("l_suppkey"), F.lit(5)), 2).alias("QUALIFICACAO_DO_SOCIO"),
        F.to_date("first_date").alias("DATA_DE_ENTRADA_NA_SOCIEDADE"),
        zero_pad(F.col("s_nationkey"), 3).alias("PAIS"),
        F.lit("0").alias("FAIXA_ETARIA"),
    )


def bucket_for_joins(t: Tables, location: str, buckets: int, prefix: str = "lk") -> Tables:
    """Store lineitem and orders bucketed (and sorted) on the order key as catalog
    tables, once; joins between them then run without a shuffle (co-located). Returns
    a ``Tables`` whose lineitem/orders read the bucketed copies."""
    import os

    from ..sources.sinks import save_as_table
    li = t.lineitem.withColumnRenamed("l_orderkey", "orderkey")
    o = t.orders.withColumnRenamed("o_orderkey", "orderkey")
    save_as_table(li, f"{prefix}_lineitem", path=os.path.join(location, "lineitem"), bucket_by=(buckets, ["orderkey"]))
    save_as_table(o, f"{prefix}_orders", path=os.path.join(location, "orders"), bucket_by=(buckets, ["orderkey"]))
    spark = t.spark
    return Tables(spark, t.sf_dir, {
        "lineitem": spark.table(f"{prefix}_lineitem").withColumnRenamed("orderkey", "l_orderkey"),
        "orders": spark.table(f"{prefix}_orders").withColumnRenamed("orderkey", "o_orderkey")})
