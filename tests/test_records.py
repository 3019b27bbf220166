"""Quoted files read in splits, and archives read by member."""

import io
import random
import zipfile

import pytest

from lakeloom.sources import archives as A
from lakeloom.sources.csv import read_csv_with_quotes, string_schema
from lakeloom.sources.records import OPEN_QUOTE, numbered_lines, read_csv_records

HEADER = ["k", "name", "note"]


def text_of(rows, end="\r\n"):
    quoted = lambda v: '"' + v.replace('"', '""') + '"'
    return end.join([";".join(HEADER), *[";".join(quoted(v) for v in r) for r in rows]]) + end


def made(seed, n):
    rnd = random.Random(seed)
    bits = ["a;b", 'say ""', '"', "two\nlines", "\n", "Açúcar", "x" * 40, "", "three\n\nlines"]
    return [(str(i), "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 4))) + "z", rnd.choice(["plain", "q\"q", "l\nl"]))
            for i in range(n)]


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_one_large_file_in_many_tasks(spark, tmp_path, small_splits):
    rows = made(1, 900)
    (tmp_path / "big.csv").write_bytes(text_of(rows).encode("iso-8859-1"))
    (tmp_path / "small.csv").write_bytes(text_of(made(2, 3), "\n").encode("iso-8859-1"))
    path = str(tmp_path)
    assert numbered_lines(spark, path).select("file", "split").distinct().count() > 8
    got = read_csv_records(spark, path)
    whole = read_csv_with_quotes(spark, path, multiline=True)
    key = lambda df: sorted(tuple(r) for r in df.collect())
    assert key(got.ok.select(*HEADER)) == sorted(rows + made(2, 3)) == key(whole.ok.select(*HEADER))
    assert got.rejected.count() == 0 and got.columns == whole.columns
    assert {r[0].rsplit("/", 1)[1] for r in got.ok.select("origin_path_name").distinct().collect()} == {"big.csv", "small.csv"}


def test_rows_that_do_not_fit_and_open_quotes(spark, tmp_path, small_splits):
    lines = ["k;name;note", "1;a;b", "2;short", "", "3;a;b;c", '4;"x', 'y";z']
    (tmp_path / "a.csv").write_bytes("\n".join(lines).encode())
    (tmp_path / "b.csv").write_bytes(("k;name;note\n5;a;b\n6;\"never closed;b\n" + "7;a;b\n" * 3000).encode())
    (tmp_path / "empty.csv").write_bytes(b"")
    got = read_csv_records(spark, str(tmp_path), schema=string_schema(HEADER), max_lines=50)
    assert sorted(tuple(r) for r in got.ok.select(*HEADER).collect()) == [("1", "a", "b"), ("4", "x\ny", "z"), ("5", "a", "b")]
    reasons = [(r["linha"], r["motivo"]) for r in got.rejected.collect()]
    assert ("2;short", "broken_record") in reasons and ("3;a;b;c", "broken_record") in reasons
    assert sum(m == OPEN_QUOTE for _, m in reasons) == 3001  # no line is lost


def test_empty_folder_of_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"k;name;note\r\n")
    got = read_csv_records(spark, str(tmp_path))
    assert got.columns == HEADER and got.ok.count() == 0 and got.rejected.count() == 0


def test_one_archive_of_many_members_is_many_tasks(spark, tmp_path):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        zf.writestr("folder/", b"")
        for i in range(12):
            zf.writestr(f"m{i}.csv", "\n".join(f"{i};{j}" for j in range(50)))
    (tmp_path / "Empresas1.zip").write_bytes(buf.getvalue())
    lines = A.archive_lines(spark, str(tmp_path))
    assert A.archive_members(A.archive_files(spark, str(tmp_path))).count() == 12
    used = lines.selectExpr("spark_partition_id() AS p").distinct().count()
    assert lines.rdd.getNumPartitions() == 12 and used > 4
    assert sorted((r["member"], r["line_no"], r["line"]) for r in lines.collect()) == sorted(
        (f"m{i}.csv", j + 1, f"{i};{j}") for i in range(12) for j in range(50))
