"""Physical-plan checks: pruning and pushdown reach the scan, broadcasts are the bounded ones."""

import contextlib
import io
import os

from pyspark.sql import functions as F

from lakeloom.operators import trade_star as ts
from lakeloom.plans import standins as si
from lakeloom.sources import sinks

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_partition_pruning_on_year(spark, tmp_path):
    t = si.Tables(spark, SF)
    path = str(tmp_path / "fact")
    si.exports(t).write.partitionBy("CO_ANO", "CO_MES").parquet(path)
    p = plan(spark.read.parquet(path).filter(F.col("CO_ANO") == 1998).groupBy("CO_MES").count())
    assert "PartitionFilters: [isnotnull(CO_ANO" in p and "(CO_ANO" in p


def test_column_pruning_and_pushed_filters(spark):
    t = si.Tables(spark, SF)
    p = plan(t.lineitem.filter(F.col("l_returnflag") == "R").select("l_orderkey"))
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in p
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in p


def test_month_dimension_is_broadcast_in_fact(spark):
    t = si.Tables(spark, SF)
    from lakeloom.plans.catalog import build_dims
    d_month, d_product, d_geo = build_dims(t)
    p = plan(ts.trade_fact(si.exports(t), d_month, d_product, d_geo))
    assert "BroadcastHashJoin" in p


def test_dedup_is_partially_aggregated(spark):
    from lakeloom.operators.dedup import dedup_by_key
    p = plan(dedup_by_key(si.Tables(spark, SF).lineitem, ["l_suppkey"], ["l_orderkey"]))
    assert "partial_min" in p and "Window" not in p


def test_sinks_catalog_roundtrip(spark, tmp_path):
    df = spark.range(10).withColumn("k", F.col("id") % 3)
    sinks.save_as_table(df, "t_lakeloom_a", path=str(tmp_path / "a"), bucket_by=(4, ["k"]))
    sinks.rename_table(spark, "t_lakeloom_a", "t_lakeloom_b")
    assert spark.table("t_lakeloom_b").count() == 10
    sinks.write_table(df, str(tmp_path / "b"), mode="overwrite", partition_by=["k"])
    sinks.register_external(spark, "t_lakeloom_c", str(tmp_path / "b"))
    assert spark.table("t_lakeloom_c").count() == 10
    sinks.write_table(df.withColumn("extra", F.lit("x")), str(tmp_path / "b"), mode="append", partition_by=["k"])
    merged = sinks.read_merged(spark, str(tmp_path / "b"))
    assert "extra" in merged.columns and merged.count() == 20
    from pyspark.sql.types import LongType, StructField, StructType
    schema = StructType([StructField("n", LongType())])
    assert sinks.ensure_table(spark, str(tmp_path / "missing"), schema).count() == 0
    sinks.append_rows(spark, str(tmp_path / "ctl"), [(1,), (2,)], schema)
    assert spark.read.parquet(str(tmp_path / "ctl")).count() == 2
    for name in ("t_lakeloom_b", "t_lakeloom_c"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    assert os.path.exists(str(tmp_path / "a"))


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    """Co-located join: two tables bucketed alike on the key join with no Exchange."""
    a = spark.range(2000).select((F.col("id") % 97).alias("k"), F.col("id").alias("x"))
    b = spark.range(500).select((F.col("id") % 97).alias("k"), F.col("id").alias("y"))
    sinks.save_as_table(a, "t_bucket_a", path=str(tmp_path / "ba"), bucket_by=(8, ["k"]))
    sinks.save_as_table(b, "t_bucket_b", path=str(tmp_path / "bb"), bucket_by=(8, ["k"]))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = spark.table("t_bucket_a").join(spark.table("t_bucket_b"), "k")
        p = plan(j)
        assert "SortMergeJoin" in p and "Exchange" not in p
        assert j.count() == a.join(b, "k").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP TABLE IF EXISTS t_bucket_a")
        spark.sql("DROP TABLE IF EXISTS t_bucket_b")


def test_trade_rows_on_bucketed_tables(spark, tmp_path):
    """With lineitem and orders bucketed on the order key, the lineitem-orders join of
    the trade rows needs no shuffle, and the rows are the same."""
    t = si.Tables(spark, SF)
    bt = si.bucket_for_joins(t, str(tmp_path / "bucketed"), 8)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def exchanges(df):
            buf = io.StringIO()
            with contextlib.redirect_stdout(buf):
                df.explain()
            return [ln for ln in buf.getvalue().splitlines() if "Exchange hashpartitioning" in ln]

        rows = si.trade_rows(bt)
        plain, bucketed = exchanges(si.trade_rows(t)), exchanges(rows)
        assert any("l_orderkey" in ln for ln in plain)
        # only the customer-key exchanges of the second join remain
        assert bucketed and all("o_custkey" in ln for ln in bucketed)
        assert rows.count() == si.trade_rows(t).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP TABLE IF EXISTS lk_lineitem")
        spark.sql("DROP TABLE IF EXISTS lk_orders")


FILE_QUERIES = {"csv_roundtrip", "csv_corrupt", "csv_sanitized", "csv_rejects", "archive_lines", "file_routing",
                "incremental_rows", "incremental_files", "run_summary", "watermark_rows", "positional_shards",
                "stream_rows", "partition_advice", "salt_layout", "silver_summary", "bronze_trade_rows",
                "bronze_rejects", "csv_multiline", "silver_after_refresh", "fact_after_refresh", "fact_after_republish",
                "rejects_after_refresh", "aux_columns", "bronze_trade_tables", "bronze_registry_tables", "tables_by_name"}


def test_no_python_and_pruned_scans_in_table_queries(spark):
    """Table queries stay JVM-side (no Python evaluation) and never read all lineitem columns."""
    from lakeloom.plans.index import QUERIES
    full_lineitem = "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int," \
                    "l_quantity:double,l_extendedprice:double,l_discount:double,l_tax:double,l_returnflag:string," \
                    "l_linestatus:string,l_shipdate:timestamp_ntz>"
    for name, (fn, _sql) in sorted(QUERIES.items()):
        if name in FILE_QUERIES:
            continue
        p = plan(fn(spark, SF))
        assert "EvalPython" not in p and "MapInPandas" not in p, name
        assert full_lineitem not in p, name


def test_reports_read_only_what_they_report(spark):
    """Joins whose columns a report does not read are gone; the consolidated view passes once over lineitem."""
    from lakeloom.plans.index import QUERIES
    for name, fn in ((n, QUERIES[n][0]) for n in ("monthly_stats_export", "monthly_stats_import", "report_by_year", "fact_total")):
        p = plan(fn(spark, SF))
        for table in ("orders", "customer", "part", "nation"):
            assert f"/{table}.parquet" not in p, (name, table)
    assert 1 <= plan(QUERIES["consolidated"][0](spark, SF)).count("/lineitem.parquet") <= 2
