"""The contract queries against their DuckDB statements, on a small table of the driver and on planted rows."""

import random

import duckdb
import pytest

from lakeloom.llm import queries

TABLES = "documents embeddings labels".split()


def rows_of(cursor_rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(r[i]) for i in order) for r in cursor_rows)


def same(spark, name, folder, place, tables=TABLES):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{place(t)}'")
    want = con.execute(queries.ORACLES[name])
    columns = [d[0] for d in want.description]
    got = queries.QUERIES[name](spark, folder)
    assert sorted(columns) == sorted(got.columns)
    assert rows_of(map(tuple, got.collect()), got.columns) == rows_of(want.fetchall(), columns)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_driver_table(spark, name):
    sf = "/root/testdata/sf0.001"
    same(spark, name, sf, lambda t: f"{sf}/{t}.parquet", [*TABLES, "pages"])


def test_certified_cutoffs(spark, tmp_path):
    """Enough labelled rows for certificates, so that the method's verdict and not the base rules decide."""
    rnd = random.Random(4)
    docs, labels = [], []
    for i in range(2600):
        words = ["w%d" % rnd.randint(0, 10**5) for _ in range(rnd.randint(12, 30))]
        junk = rnd.random() < 0.2
        if junk:
            words = [w + "#" * rnd.randint(0, 3) for w in words]
        docs.append((i, "\n".join([" ".join(words)] * rnd.choice([1, 1, 1, 2 if junk else 1])), rnd.choice(["en", "en", "en", None]), "s", 1))
        if rnd.random() < 0.9:
            labels.append((i, rnd.choice([None, int(not junk), int(not junk), int(not junk)]), 0))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    same(spark, "op7_quality_rules", str(tmp_path), lambda t: f"{tmp_path}/{t}.parquet/*.parquet" if t != "embeddings" else
         f"{tmp_path}/labels.parquet/*.parquet")
    out = queries.QUERIES["op7_quality_rules"](spark, str(tmp_path))
    assert out.where("not kept and not base_failed").count() > 100
