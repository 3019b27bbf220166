"""A key holding a third of all rows: results stay whole and exact when AQE splits it."""

from pyspark.sql import functions as F

from lakeloom.operators import dedup as dd
from lakeloom.operators import layout as lo
from lakeloom.operators.joins import one_to_many_left


def _skewed(spark, n=30000):
    # key 0 holds a third of the rows, the rest spread over 2000 keys
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 2000 + 1).alias("k"),
        F.col("id").alias("v"))


def test_one_to_many_left_on_hot_key(spark):
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        many = _skewed(spark)
        one = spark.range(0, 2100).select(F.col("id").alias("key"), (F.col("id") * 10).alias("w"))
        out = one_to_many_left(one, many, "key", "k")
        ref = one.join(many, one["key"] == many["k"], "left")
        assert out.count() == ref.count()
        a = out.groupBy("key").agg(F.count("v").alias("c"), F.sum("v").alias("s")).orderBy("key").collect()
        b = ref.groupBy("key").agg(F.count("v").alias("c"), F.sum("v").alias("s")).orderBy("key").collect()
        assert a == b
        assert dict((r["key"], r["c"]) for r in a)[0] == 10000          # the hot key, whole
        assert dict((r["key"], r["c"]) for r in a)[2050] == 0            # a key with no match kept
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_dedup_and_latest_on_hot_key(spark):
    df = _skewed(spark)
    first = {r["k"]: r["v"] for r in dd.dedup_by_key(df, ["k"], ["v"]).collect()}
    last = {r["k"]: r["v"] for r in dd.latest_per_key(df, ["k"], "v").collect()}
    assert first[0] == 0 and last[0] == 29997 and len(first) == 2001


def test_salt_spreads_hot_key(spark):
    df = _skewed(spark)
    adv = lo.salt_advice(df, "k").first()
    assert adv["salt"] == 16
    counts = lo.add_salt(df, "v", adv["salt"]).filter("k = 0").groupBy("salt").count().collect()
    assert len(counts) == 16 and max(r["count"] for r in counts) < 10000 / 4
