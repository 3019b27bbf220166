"""Readers on hand-made messy files (FIXTURES section 2) written to a fresh temp folder."""

import io
import os
import zipfile

from pyspark.sql import functions as F

from lakeloom.plans import incremental as inc
from lakeloom.sources.archives import archive_group, archive_lines
from lakeloom.sources.csv import align_columns, corrupt_records, read_csv_with_quotes
from lakeloom.sources.quarantine import store_rejects, stored_rejects
from lakeloom.sources.files import list_files, route_files
from lakeloom.sources.sanitize import sanitize_csv

HEADER = "CO_ANO;CO_MES;NO_NOME\r\n"


def write(path, text, enc="iso-8859-1"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as fh:
        fh.write(text.encode(enc))


def test_quoted_reader_routes_corrupt_rows(spark, tmp_path):
    body = (HEADER
            + '2024;1;"São Paulo; centro"\r\n'
            + '2024;2;"dito ""aspas"""\r\n'
            + '2024;3;"linha\nquebrada"\r\n'
            + "2024;4\r\n"
            + "2024;5;x;extra\r\n"
            + "\r\n")
    write(str(tmp_path / "in" / "EXP_2024.csv"), body)
    res = read_csv_with_quotes(spark, str(tmp_path / "in"), path_glob_filter="*.csv")
    ok = {r["CO_MES"]: r["NO_NOME"] for r in res.ok.collect()}
    assert ok == {"1": "São Paulo; centro", "2": 'dito "aspas"', "3": "linha\nquebrada"}
    bad = sorted(r[0] for r in corrupt_records(res.rejected).collect())
    assert bad == ["2024;4", "2024;5;x;extra"]
    q = str(tmp_path / "quarantine")
    store_rejects(res.rejected, q, "b1")
    store_rejects(res.rejected, q, "b2")
    assert store_rejects(res.rejected, q, "b2").count() == 2          # a retried load replaces its own part
    rows = sorted((r["linha"], r["qt_delim"], r["motivo"], r["batch_id"]) for r in stored_rejects(spark, q).collect())
    assert rows == [("2024;4", 1, "broken_record", b) for b in ("b1", "b2")] + [
        ("2024;5;x;extra", 2, "broken_record", b) for b in ("b1", "b2")]
    store_rejects(res.rejected.limit(0), q, "b3")                     # nothing rejected: nothing to read
    assert stored_rejects(spark, q).count() == 4


def test_align_columns(spark):
    df = spark.createDataFrame([("1", "x", "extra")], "A string, B string, Z string")
    out = align_columns(df, ["B", "A", "C"])
    assert out.columns == ["B", "A", "C"] and out.first()["C"] is None


def test_sanitizer_classifies_lines(spark, tmp_path):
    lines = ["CO;NO;UF", "1;Ana;SP", "CO;NO;UF", "﻿ co ; No;uf", "2|Bia|RJ", "3;Caio;MG;x",
             "4;Davi;BA", "", "CO;NO;UF"]
    write(str(tmp_path / "s" / "a.csv"), "\r\n".join(lines[:5]) + "\r\n", "utf-8")
    write(str(tmp_path / "s" / "b.csv"), "\n".join(lines[5:]) + "\n", "utf-8")
    res = sanitize_csv(spark, str(tmp_path / "s"), encoding="UTF-8")
    assert res.columns == ["CO", "NO", "UF"]
    assert sorted(r["CO"] for r in res.clean.collect()) == ["1", "4"]
    reasons = sorted((r["motivo"], r["qt_delim"]) for r in res.rejected.collect())
    assert reasons == [("bad_delimiter_count", 0), ("bad_delimiter_count", 3)] + [("duplicate_header", 2)] * 4
    # good + rejected partition the non-blank input lines
    assert res.clean.count() + res.rejected.count() == len([x for x in lines if x])


def test_sanitizer_forced_header_and_pipe(spark, tmp_path):
    write(str(tmp_path / "p" / "x.txt"), "1|a\n2|b\nbad\n", "latin-1")
    res = sanitize_csv(spark, str(tmp_path / "p"), delimiter="|", forced_header_cols=["K", "V"])
    assert sorted(tuple(r) for r in res.clean.collect()) == [("1", "a"), ("2", "b")]


def test_archives_same_member_name(spark, tmp_path):
    folder = tmp_path / "z"
    folder.mkdir()
    for i, rows in enumerate([["1;A", "2;B"], ["3;Ç"], ["4;D"]]):
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w") as zf:
            zf.writestr("same.EMPRECSV" if i < 2 else f"other{i}.EMPRECSV",
                        ("\r\n".join(rows) + "\r\n").encode("iso-8859-1"))
        (folder / f"Empresas{i}.zip").write_bytes(buf.getvalue())
    out = archive_lines(spark, str(folder)).collect()
    assert sorted(r["line"] for r in out) == ["1;A", "2;B", "3;Ç", "4;D"]
    assert {r["grp"] for r in out} == {"Empresas"}
    assert len({(r["archive"], r["member"]) for r in out}) == 3
    assert archive_group("Estabelecimentos12.zip") == "Estabelecimentos"


def test_file_routing(spark, tmp_path):
    for name in ["EXP_2024.csv", "IMP_2023.csv", "NCM.csv", "PAIS.csv", "EXP_24.csv", "x.txt"]:
        write(str(tmp_path / "r" / "sub" / name), "a;b\n")
    out = {r["name"]: (r["kind"], r["table_name"]) for r in route_files(list_files(spark, str(tmp_path / "r"))).collect()}
    assert out["EXP_2024.csv"] == ("EXP", "exp_2024") and out["IMP_2023.csv"][0] == "IMP"
    assert out["NCM.csv"][0] == "NCM" and out["PAIS.csv"] == ("AUX", "pais")
    assert out["EXP_24.csv"][0] == "AUX" and out["x.txt"][0] is None


def test_incremental_two_then_three_then_none(spark, tmp_path):
    import datetime as dt
    landing, manifest, bronze = (str(tmp_path / p) for p in ("landing", "manifest", "bronze"))

    def reader(paths):
        return read_csv_with_quotes(spark, paths, multiline=False).ok

    write(f"{landing}/EXP_2022.csv", HEADER + "2022;1;a\r\n2022;2;b\r\n")
    write(f"{landing}/EXP_2023.csv", HEADER + "2023;1;c\r\n")
    r1 = inc.load_new_files(spark, landing, manifest, bronze, reader, "EXP", dt.datetime(2024, 1, 1))
    write(f"{landing}/EXP_2024.csv", HEADER + "2024;1;d\r\n")
    r2 = inc.load_new_files(spark, landing, manifest, bronze, reader, "EXP", dt.datetime(2024, 1, 2))
    r3 = inc.load_new_files(spark, landing, manifest, bronze, reader, "EXP", dt.datetime(2024, 1, 3))
    assert (r1, r2, r3) == ((2, 3, 0), (1, 1, 0), (0, 0, 0))
    assert spark.read.parquet(bronze).count() == 4
    m = spark.read.parquet(manifest)
    assert m.agg(F.sum("num_registros")).first()[0] == spark.read.parquet(bronze).count()
    summary = inc.run_summary(m).first()
    assert (summary["arquivos"], summary["registros"]) == (3, 4)


def test_watermark_before_at_after(spark, tmp_path):
    import datetime as dt
    log = str(tmp_path / "wm")
    assert inc.read_watermark(spark, log, "t") is None
    t0, t1, t2 = (dt.datetime(2024, 1, d) for d in (1, 2, 3))
    df = spark.createDataFrame([(1, t0), (2, t1), (3, t2)], "id int, ingestion_dt timestamp")
    inc.register_watermark(spark, log, "t", df.filter(F.col("id") <= 2), t1)
    wm = inc.read_watermark(spark, log, "t")
    assert wm == t1
    assert [r["id"] for r in inc.after_watermark(df, wm).collect()] == [3]
    assert inc.read_watermark(spark, log, "other") is None


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_token = st.text(alphabet="abcXYZ019 ãé|", min_size=0, max_size=4)
_line = st.lists(_token, min_size=1, max_size=5).map(lambda ts: ";".join(ts))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(_line, min_size=1, max_size=25))
def test_sanitizer_partitions_its_input(spark, tmp_path_factory, lines):
    """Every non-blank line ends up either parsed or rejected, never both, never lost."""
    folder = tmp_path_factory.mktemp("prop")
    write(str(folder / "f.csv"), "\n".join(lines) + "\n")
    res = sanitize_csv(spark, str(folder), forced_header_cols=["A", "B", "C"])
    expected = sum(1 for ln in lines if ln.strip())
    good, bad = res.clean.count(), res.rejected.count()
    # rows equal to the header in every column are dropped after parsing
    headers = sum(1 for ln in lines if ln == "A;B;C")
    assert good + bad + headers == expected


def test_binary_lines_provenance_and_small_readers(spark, tmp_path):
    from lakeloom.sources.csv import empty_like, read_table, with_provenance
    from lakeloom.sources.sanitize import commonest_line, read_binary_files, read_lines
    write(str(tmp_path / "b" / "x.csv"), "CO;NO\r\n1;São\r\n\r\n2;Ção\r\n")
    lines = read_lines(spark, str(tmp_path / "b"))
    assert [r["linha"] for r in lines.collect()] == ["CO;NO", "1;São", "2;Ção"]
    assert read_binary_files(spark, str(tmp_path / "b")).select("length").first()[0] == 23
    assert commonest_line(lines) == "1;São"                            # all once: the smallest text
    assert commonest_line(lines.union(lines.where("linha like '2%'"))) == "2;Ção"
    ok = read_csv_with_quotes(spark, str(tmp_path / "b")).ok
    prov = with_provenance(ok).first()
    assert prov["file_name_only"] == "x.csv" and prov["origin_path_name"].endswith("/b/x.csv")
    e = empty_like(spark, ok.schema)
    assert e.count() == 0 and e.columns == ok.columns
    ok.write.parquet(str(tmp_path / "t"))
    assert read_table(spark, str(tmp_path / "t")).count() == 2


def test_left_lookup_modes(spark):
    from lakeloom.operators.joins import left_lookup
    df = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    lk = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    for mode in ("auto", "bounded", "check"):
        out = {r["k"]: r["v"] for r in left_lookup(df, lk, "k", mode).collect()}
        assert out == {1: "a", 2: "b", 3: None}


def test_expected_columns_align_header_driven_reads_only(spark, tmp_path):
    write(str(tmp_path / "e" / "x.csv"), "B;A;Z\n1;2;3\n")
    res = read_csv_with_quotes(spark, str(tmp_path / "e"), expected_cols=["A", "B", "C"])
    assert res.columns == ["A", "B", "C"] and tuple(res.ok.first()) == ("2", "1", None)
    from lakeloom.sources.csv import string_schema
    res2 = read_csv_with_quotes(spark, str(tmp_path / "e"), schema=string_schema(["P", "Q", "R"], None),
                                expected_cols=["A"])
    assert res2.columns == ["P", "Q", "R"]                      # Q2: a given schema wins


def test_manifest_version_key_reloads_republished_file(spark, tmp_path):
    import datetime as dt
    import time
    landing, manifest, bronze = (str(tmp_path / p) for p in ("landing", "manifest", "bronze"))

    def reader(paths):
        return read_csv_with_quotes(spark, paths, multiline=False).ok

    write(f"{landing}/EXP_2022.csv", HEADER + "2022;1;a\r\n")
    assert inc.load_new_files(spark, landing, manifest, bronze, reader, "EXP", dt.datetime(2024, 1, 1),
                              key="version") == (1, 1, 0)
    assert inc.load_new_files(spark, landing, manifest, bronze, reader, "EXP", dt.datetime(2024, 1, 2),
                              key="version") == (0, 0, 0)
    time.sleep(1.1)
    write(f"{landing}/EXP_2022.csv", HEADER + "2022;1;a\r\n2022;2;b\r\n")      # republished, same name
    assert inc.load_new_files(spark, landing, manifest, bronze, reader, "EXP", dt.datetime(2024, 1, 3)) == (0, 0, 0)
    assert inc.load_new_files(spark, landing, manifest, bronze, reader, "EXP", dt.datetime(2024, 1, 4),
                              key="version") == (1, 2, 0)
