"""Operator tests: dedup, joins, layout advice, star schema invariants."""

from pyspark.sql import functions as F

from lakeloom.operators import dedup as dd
from lakeloom.operators import layout as lo
from lakeloom.operators import trade_star as ts
from lakeloom.operators.checks import duplicate_keys
from lakeloom.operators.joins import broadcast_if_small


def test_dedup_by_key_is_deterministic(spark):
    df = spark.createDataFrame([("k", 3, "c"), ("k", 1, "z"), ("k", 1, "a"), ("j", None, "n")],
                               "key string, o int, v string")
    out = {r["key"]: (r["o"], r["v"]) for r in dd.dedup_by_key(df, ["key"], ["o"]).collect()}
    assert out == {"k": (1, "a"), "j": (None, "n")}
    last = {r["key"]: (r["o"], r["v"]) for r in dd.dedup_by_key(df, ["key"], ["o"], descending=True).collect()}
    assert last["k"] == (3, "c")


def test_latest_per_key_hot_key(spark):
    rows = [(1, i, f"e{i}") for i in range(3000)] + [(2, 5, "x")]
    df = spark.createDataFrame(rows, "u int, ts int, ev string")
    out = {r["u"]: r["ts"] for r in dd.latest_per_key(df, ["u"], "ts").collect()}
    assert out == {1: 2999, 2: 5}


def _groups(spark, sizes):
    rows = [(g, i) for g, n in enumerate(sizes) for i in range(n)]
    return spark.createDataFrame(rows, "g int, i int")


def test_salt_advice_thresholds(spark):
    cases = {(10, 10, 10): 1, (15, 10, 10): 4, (25, 10, 10): 8, (40, 10, 10): 16, (100, 10, 10): 16}
    for sizes, salt in cases.items():
        assert lo.salt_advice(_groups(spark, sizes), "g").first()["salt"] == salt


def test_add_salt_range_and_one_bucket(spark):
    df = _groups(spark, (50, 3))
    assert {r[0] for r in lo.add_salt(df, "g", 1).select("salt").collect()} == {0}
    assert all(0 <= r[0] < 8 for r in lo.add_salt(df, "i", 8).select("salt").collect())


def test_partition_advice_one_row(spark):
    df = spark.range(1000).withColumn("s", F.lit("x" * 50))
    r = lo.partition_advice(df, desired_file_mb=1, sample_rows=100).first()
    assert r["total_rows"] == 1000 and r["recommended_partitions"] >= 1 and r["avg_row_bytes"] > 0


def test_broadcast_if_small_keeps_results(spark):
    left = spark.range(100).withColumnRenamed("id", "k")
    right = spark.range(10).withColumnRenamed("id", "k").withColumn("v", F.col("k") * 2)
    for side in (broadcast_if_small(right, 5), broadcast_if_small(right, 50)):
        assert left.join(side, "k", "left").count() == 100


def test_consolidated_totals_equal_fact_totals(spark):
    exp = spark.createDataFrame([(2024, 1, "a", 1, 2, "10.50", "EXP", "t", "p", "g")],
                                "CO_ANO int, CO_MES int, CO_NCM string, quantidade_estatistica long, "
                                "peso_liquido_kg long, valor_fob string, TIPO_OPERACAO string, fk_tempo string, "
                                "fk_produto string, fk_geografia string").withColumn(
        "valor_fob", F.col("valor_fob").cast("decimal(18,2)"))
    imp = (exp.withColumn("TIPO_OPERACAO", F.lit("IMP"))
              .withColumn("valor_frete", F.lit(1.25).cast("decimal(18,4)"))
              .withColumn("valor_seguro", F.lit(0.5).cast("decimal(18,4)")))
    view = ts.consolidated(exp, imp)
    r = view.agg(F.sum("valor_fob").alias("f"), F.sum("valor_frete").alias("fr")).first()
    assert float(r["f"]) == 21.0 and float(r["fr"]) == 1.25
    rep = {x["CO_ANO"]: x["total_registros"] for x in ts.report_by_year(view).collect()}
    assert rep == {2024: 2}


def test_fact_left_joins_keep_rows_and_null_fk(spark):
    trade = spark.createDataFrame([(2024, 1, "00000001", 1, "SP", 1, 1, 1.0, "EXP"),
                                   (2024, 1, "99999999", 99, "SP", 1, 1, 1.0, "EXP")],
                                  "CO_ANO int, CO_MES int, CO_NCM string, CO_PAIS int, SG_UF_NCM string, "
                                  "QT_ESTAT long, KG_LIQUIDO long, VL_FOB double, TIPO_OPERACAO string")
    months = ts.dim_month(trade)
    prod = spark.createDataFrame([("00000001",)], "CO_NCM string").withColumn("sk_produto", F.lit("p"))
    geo = ts.dim_geography(spark.createDataFrame([(1, "BR")], "CO_PAIS int, NO_PAIS string"))
    fact = ts.trade_fact(trade, months, prod, geo)
    rows = {r["CO_NCM"]: r for r in fact.collect()}
    assert len(rows) == 2 and rows["99999999"]["fk_produto"] is None and rows["99999999"]["fk_geografia"] is None
    assert rows["00000001"]["fk_tempo"] is not None


def test_duplicate_keys_check(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (3,), (3,)], "k int")
    assert duplicate_keys(df, ["k"]).first()["duplicate_keys"] == 2


def test_dedup_by_key_on_all_columns(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    assert sorted(tuple(r) for r in dd.dedup_by_key(df, ["k", "v"]).collect()) == [(1, "a"), (2, "b")]
