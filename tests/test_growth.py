"""Steps whose cost must follow the rows: what is shuffled, parsed once, and written by how many tasks."""

import datetime as dt
import glob
import os
import re
import zipfile

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from lakeloom.operators import registry_star as rs
from lakeloom.plans import fixtures as fx
from lakeloom.plans import incremental as inc
from lakeloom.plans import jobs
from lakeloom.plans import standins as si
from lakeloom import schemas as S
from lakeloom.sources.archives import lines_of_archives
from lakeloom.sources import quarantine
from lakeloom.sources.quarantine import store_rejects, stored_rejects
from lakeloom.sources.sinks import open_writers

PARTNERS = ("CNPJ_BASICO string, IDENTIFICADOR_DO_SOCIO string, NOME_DO_SOCIO string, CPF_CNPJ_DO_SOCIO string, "
            "QUALIFICACAO_DO_SOCIO string, DATA_DE_ENTRADA_NA_SOCIEDADE string, PAIS string, FAIXA_ETARIA string")
CODES = "CODIGO string, DESCRICAO string"


def test_partner_rows_are_reduced_before_the_wide_columns(spark):
    partners = spark.createDataFrame(
        [("1", "a", "X", "d", "01", "2", "001", "0"), ("1", "a", "X", "d", "01", "1", "001", "0"),
         ("1", "b", None, "d", "09", "1", None, "0"), (None, "b", "Y", None, None, None, "002", None),
         ("1", "c", "Z", "d", "02", "1", "002", "0"), ("1", "c", "Z", "c", "01", "9", "001", "1")], PARTNERS)
    qual = spark.createDataFrame([("01", "q1"), ("01", None), ("02", "q3"), ("02", "q2"), (None, "none")], CODES)
    countries = spark.createDataFrame([("001", "c1"), ("001", "c0"), ("002", "c2")], CODES)
    out = rs.dim_partner(partners, qual, countries)
    got = sorted((tuple(r)[:-1] for r in out.collect()), key=str)
    assert got == sorted([
        ("1", "a", "X", "d", "01", None, "0", "001", "c0", "1"), ("1", "b", None, "d", "09", None, "0", None, None, "1"),
        ("1", "c", "Z", "c", "01", None, "1", "001", "c0", "9"), (None, "b", "Y", None, None, None, None, "002", "c2", None)], key=str)
    assert out.columns[-1] == "sk_socio"
    plan = out._jdf.queryExecution().analyzed().toString()
    assert plan.index("sha2(") < plan.index("min(struct(")  # the key is made above the reduction


def test_partner_pairs_are_shuffled_once(spark, tmp_path):
    """From the pairs on there is one exchange by (company, partner); suppliers go to the rows."""
    tables = {"lineitem": spark.range(50).select(F.col("id").alias("l_orderkey"), (F.col("id") % 3).alias("l_suppkey")),
              "orders": spark.range(50).select(F.col("id").alias("o_orderkey"), (F.col("id") % 5).alias("o_custkey"),
                                               F.lit(dt.datetime(2024, 1, 1)).alias("o_orderdate")),
              "supplier": spark.range(3).select(F.col("id").alias("s_suppkey"), F.lit("s").alias("s_name"), F.lit(1).alias("s_nationkey"))}
    partners = si.partners(si.Tables(spark, str(tmp_path), tables))
    codes = spark.createDataFrame([("01", "x")], CODES)
    out = rs.dim_partner(partners, codes, codes)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(\w+#\d+, \w+#\d+, ", plan)) == 1
    assert out.count() == 15


def test_a_load_parses_its_files_once(spark, tmp_path, monkeypatch):
    landing, run = tmp_path / "landing", dt.datetime(2024, 1, 1, 6)
    landing.mkdir()
    row = "2020;1;1;10;1;SP;1;1;1;1;1,50"
    (landing / "EXP_2020.csv").write_text("\n".join([";".join(S.EXPORT_COLUMNS), row, "7;short", row, "x;y" + ";z" * 10]) + "\n")
    lake = jobs.Lake(str(tmp_path / "lake"))
    reader = jobs.trade_reader(spark, S.EXPORT_COLUMNS, run)
    alone = []  # the scan of broken lines alone is not stored any more
    monkeypatch.setattr(inc, "store_rejects", lambda df, *a, real=inc.store_rejects: alone.append(df) or real(df, *a))
    got = inc.load_new_files(spark, str(landing), lake.manifest, lake.bronze("exp"), reader, "EXP", run, ["ano", "mes"],
                             quarantine_path=lake.quarantine("exp"))
    assert got == (1, 2, 2)
    assert not [f for f in alone[0].inputFiles() if f.endswith(".csv")]
    bad = stored_rejects(spark, lake.quarantine("exp")).orderBy("linha").collect()
    assert [(r.linha, r.motivo, r.qt_delim) for r in bad] == [("7;short", "broken_record", 1), ("x;y" + ";z" * 10, "broken_record", 10)]
    assert all(r.arquivo.endswith("/EXP_2020.csv") for r in bad)
    stored = spark.read.parquet(lake.bronze("exp"))
    assert stored.count() == 2 and "_corrupt_record" not in stored.columns
    assert {(r.file_name_only, r.tipo_operacao, r.ano, r.mes) for r in stored.collect()} == {("EXP_2020.csv", "EXP", 2020, 1)}
    assert os.listdir(lake.bronze("exp")).count("batch_id=" + inc.batch_name(run, "EXP")) == 1
    assert not glob.glob(os.path.join(lake.bronze("exp"), "*rejeitados*"))


def test_a_named_file_is_written_by_many_tasks(spark, tmp_path, monkeypatch):
    t, landing = si.Tables(spark, str(tmp_path)), str(tmp_path / "landing")
    parts = []
    monkeypatch.setattr(fx, "_join_parts", lambda job, real=fx._join_parts: real(job), raising=False)
    real = fx._hadoop
    monkeypatch.setattr(fx, "_hadoop", lambda t, p: parts.extend(
        glob.glob(p) if p.endswith("part-*") else []) or real(t, p))
    rows = spark.range(0, 100, 1, 5).select(F.col("id").cast("string").alias("a"), F.lit("x;\"y").alias("b"), (F.col("id") % 2).alias("k"))
    for again in range(2):  # a second time the files are replaced
        fx.write_named_csv(t, rows, landing, lambda k: f"N_{k}.csv", "k")
    assert len(parts) == 20
    assert sorted(f for f in os.listdir(landing) if not f.startswith(".")) == ["N_0.csv", "N_1.csv"]
    got = open(os.path.join(landing, "N_1.csv"), encoding="iso-8859-1").read().splitlines()
    assert got[0] == "a;b" and sorted(got[1:]) == sorted(f'{i};"x;""y"' for i in range(1, 100, 2))
    fx.write_named_lines(t, rows.select(F.col("a").alias("v;w"), "k"), landing, lambda k: f"N_{k}.csv", "k")
    assert open(os.path.join(landing, "N_0.csv")).read().splitlines()[0] == "v;w"
    assert spark.read.text(landing).count() == 102


def test_each_archive_member_has_a_task_of_its_own(spark, tmp_path):
    for i in range(12):
        with zipfile.ZipFile(tmp_path / f"Socios{i}.zip", "w") as z:
            z.writestr("M", f"{i};a\r\n")
    paths = spark.createDataFrame([(f"file:{tmp_path}/Socios{i}.zip",) for i in range(12)], "path string")
    lines = lines_of_archives(spark, paths, stream=True)
    per_task = lines.groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) == 12


def test_batches_that_count_whole_are_taken_by_their_folders(spark, tmp_path):
    landing, lake = tmp_path / "landing", jobs.Lake(str(tmp_path / "lake"))
    landing.mkdir()

    def load(day, **years):
        for year, uf in years.items():
            (landing / f"EXP_{year[1:]}.csv").write_text(
                "\n".join([";".join(S.EXPORT_COLUMNS), *[f"{year[1:]};1;1;10;1;{u};1;1;1;1;1,50" for u in uf]]) + "\n")
        run = dt.datetime(2024, 1, day, 6)
        inc.load_new_files(spark, str(landing), lake.manifest, lake.bronze("exp"),
                           jobs.trade_reader(spark, S.EXPORT_COLUMNS, run), "EXP", run, ["ano", "mes"], key="version")

    def seen():
        bronze = inc.read_bronze(spark, lake.bronze("exp"), lake.manifest, "EXP")
        rows = inc.committed(spark, bronze, lake.manifest, "EXP")
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        return sorted((r.CO_ANO, r.SG_UF_NCM) for r in rows.collect()), plan.count("LeftSemi")

    load(1, _2020=["SP"], _2021=["RJ"])
    load(2, _2022=["MG", "MG"])
    assert seen() == ([("2020", "SP"), ("2021", "RJ"), ("2022", "MG"), ("2022", "MG")], 0)
    load(3, _2021=["BA", "CE"])  # the first batch counts in part: its files are looked at row by row
    rows, joins = seen()
    assert rows == [("2020", "SP"), ("2021", "BA"), ("2021", "CE"), ("2022", "MG"), ("2022", "MG")] and joins == 1
    load(4, _2020=["PA"])  # and now not at all
    assert seen() == ([("2020", "PA"), ("2021", "BA"), ("2021", "CE"), ("2022", "MG"), ("2022", "MG")], 0)


def _bytes(folder):
    return sum(os.path.getsize(os.path.join(top, f)) for top, _, names in os.walk(folder) for f in names)


def test_rejects_of_a_load_are_kept_packed(spark, tmp_path):
    landing, lake = tmp_path / "landing", jobs.Lake(str(tmp_path / "lake"))
    landing.mkdir()
    (landing / "EXP_2020.csv").write_text("\n".join([";".join(S.EXPORT_COLUMNS), *[f"{i};short" for i in range(3000)]]) + "\n")
    for day, key in ((1, "name"), (2, "version")):
        run = dt.datetime(2024, 1, day, 6)
        inc.load_new_files(spark, str(landing), lake.manifest, lake.bronze("exp"), jobs.trade_reader(spark, S.EXPORT_COLUMNS, run),
                           "EXP", run, ["ano", "mes"], key=key, quarantine_path=lake.quarantine("exp"))
        if day == 1:
            (landing / "EXP_2020.csv").write_text("\n".join([";".join(S.EXPORT_COLUMNS), *[f"{i};again" for i in range(3001)]]) + "\n")
    rejects = stored_rejects(spark, lake.quarantine("exp"))
    assert rejects.count() == 6001  # the former load's are still there
    assert _bytes(lake.quarantine("exp")) < 6001 * 20
    got = inc.committed_rejects(spark, lake.quarantine("exp"), lake.manifest, "EXP")
    assert sorted(r.linha for r in got.collect()) == sorted(f"{i};again" for i in range(3001))
    assert {(r.arquivo.rsplit("/", 1)[1], r.motivo, r.qt_delim) for r in got.collect()} == {("EXP_2020.csv", "broken_record", 1)}


def test_packed_and_plain_rejects_are_read_together(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(quarantine, "PACKED_ROWS", 2)
    rows = spark.createDataFrame([(f"f{i}", f'"{i};\u00e7', "broken_record", 1) for i in range(5)], quarantine.REJECT_SCHEMA).coalesce(1)
    path = str(tmp_path / "q")
    store_rejects(rows, path, "plain")
    assert store_rejects(rows, path, "packed", "gzip").count() == 5
    assert len(glob.glob(f"{path}/batch_id=packed/*.json.gz")) == 3  # a packed file is one task's: none is large
    assert len(glob.glob(f"{path}/batch_id=plain/*.json")) == 1
    assert sorted(r.linha for r in stored_rejects(spark, path).collect()) == sorted(2 * [f'"{i};\u00e7' for i in range(5)])


def test_parts_of_named_files_are_packed(spark, tmp_path, monkeypatch):
    t, landing, parts = si.Tables(spark, str(tmp_path)), str(tmp_path / "landing"), []
    real = fx._hadoop
    monkeypatch.setattr(fx, "_hadoop", lambda t, p: parts.extend(glob.glob(p) if p.endswith("part-*") else []) or real(t, p))
    rows = spark.range(0, 40_000, 1, 4).select(F.concat(F.lit("10;1;S\u00e3o "), "id").alias("a;b;c"), (F.col("id") % 2).alias("k"))
    sizes = []
    monkeypatch.setattr(fx, "ship_package", lambda s, real=fx.ship_package: sizes.append(sum(map(os.path.getsize, parts))) or real(s))
    fx.write_named_lines(t, rows, landing, lambda k: f"N_{k}.csv", "k")
    assert sizes[0] * 3 < _bytes(landing)
    got = open(os.path.join(landing, "N_1.csv"), encoding="iso-8859-1").read().splitlines()
    assert got[0] == "a;b;c" and sorted(got[1:]) == sorted(f"10;1;S\u00e3o {i}" for i in range(1, 40_000, 2))


def test_a_load_is_written_without_a_sort_by_partition(spark, tmp_path, monkeypatch):
    landing, lake, run = tmp_path / "landing", jobs.Lake(str(tmp_path / "lake")), dt.datetime(2024, 1, 1, 6)
    landing.mkdir()
    rows = [f"{2000 + i % 7};{i % 12 + 1};{i};10;1;SP;1;1;1;1;1,50" for i in range(200)]
    lines = [x for i, row in enumerate(rows) for x in ([row, f"{i};short"] if i % 3 else [row])]
    (landing / "EXP_2020.csv").write_text("\n".join([";".join(S.EXPORT_COLUMNS), *lines]) + "\n")
    key, writers = "spark.sql.maxConcurrentOutputFileWriters", {}
    before = spark.conf.get(key)
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, real=DataFrameWriter.parquet, **k: (
        writers.setdefault(path, spark.conf.get(key)), real(self, path, *a, **k))[1])
    monkeypatch.setattr(inc, "LOAD_WRITERS", 5)  # fewer than there are partitions
    got = inc.load_new_files(spark, str(landing), lake.manifest, lake.bronze("exp"), jobs.trade_reader(spark, S.EXPORT_COLUMNS, run),
                             "EXP", run, ["ano", "mes"], quarantine_path=lake.quarantine("exp"))
    assert got == (1, 200, 133) and writers[lake.bronze("exp")] == "5" and spark.conf.get(key) == before
    stored = spark.read.parquet(lake.bronze("exp"))
    assert sorted((r.ano, r.mes, r.CO_NCM) for r in stored.collect()) == sorted((2000 + i % 7, i % 12 + 1, str(i)) for i in range(200))
    assert sorted(r.linha for r in stored_rejects(spark, lake.quarantine("exp")).collect()) == sorted(f"{i};short" for i in range(200) if i % 3)
    assert all(".zstd." in f for f in stored.inputFiles())  # replaced batches stay until a refresh
    with pytest.raises(ValueError), open_writers(spark, 3):
        raise ValueError
    assert spark.conf.get(key) == before
