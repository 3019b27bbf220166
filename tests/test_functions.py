"""Unit tests for the Column -> Column helpers (FIXTURES section 2 cases)."""

import datetime as dt
import hashlib
from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeloom.functions import cleaning as cl
from lakeloom.functions import keys as k


def one(spark, col_expr, values, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(col_expr(F.col("x")).alias("y")).collect()]


def test_remove_accents_and_non_alnum(spark):
    out = one(spark, cl.remove_accents, ["São Paulo", "Açúcar", "Muñoz", "a-b_c!", None])
    assert out == ["Sao Paulo", "Acucar", "Muoz", "abc", None]


def test_blank_to_null_spaces_only(spark):
    assert one(spark, cl.blank_to_null, ["", " ", "\t", "0", None, "x"]) == [None, None, "\t", "0", None, "x"]


def test_whitespace_blank_to_null_keeps_values(spark):
    assert one(spark, cl.whitespace_blank_to_null, ["", " ", "\t", "a", None]) == [None, None, None, "a", None]


def test_not_informed(spark):
    f = lambda c: cl.not_informed(c, ["null", "NULL"])
    assert one(spark, f, ["", " ", "0", "00", "null", None, "x"]) == [
        "NAO INFORMADO", "NAO INFORMADO", "NAO INFORMADO", "00", "NAO INFORMADO", "NAO INFORMADO", "x"]


def test_default_country(spark):
    assert one(spark, cl.default_country, [None, "", " ", "null", "NULL", "023"]) == [
        "105", "105", "105", "105", "105", "023"]


def test_zero_pad_truncates_like_lpad_or_not(spark):
    assert one(spark, lambda c: cl.zero_pad(c, 8), ["1234567", "123456789", "00000000"]) == [
        "01234567", "12345678", "00000000"]
    assert one(spark, lambda c: cl.zero_pad(c, 8, truncate=False), ["123456789", "7"]) == [
        "123456789", "00000007"]


def test_parse_date_bad_values_are_null(spark):
    out = one(spark, cl.parse_date, ["20240229", "20230229", "00000000", "0", "", None])
    assert out == [dt.date(2024, 2, 29), None, None, None, None, None]


def test_parse_decimal(spark):
    out = one(spark, cl.parse_decimal, ["1000,00", "-5,5", "abc", None])
    assert out == [Decimal("1000.00"), Decimal("-5.50"), None, None]


def test_to_type_big_quantity_bigint(spark):
    assert one(spark, lambda c: cl.to_type(c, "bigint"), ["3000000000", "x"]) == [3000000000, None]
    assert one(spark, lambda c: cl.to_type(c, "int"), ["3000000000"]) == [None]


def test_repair_double_encoding(spark):
    broken = "São Paulo".encode("utf-8").decode("latin-1")
    out = one(spark, cl.repair_double_encoding, [broken, "São Paulo", "€uro", "plain", None])
    assert out == ["São Paulo", "São Paulo", "€uro", "plain", None]


def test_pad_list_keeps_nulls_and_order(spark):
    out = one(spark, cl.pad_list, ["1,22,333", "4", None])
    assert out == ["0000001,0000022,0000333", "0000004", None]


def test_flag_equals_null_is_false(spark):
    assert one(spark, lambda c: cl.flag_equals(c, "1"), ["1", "2", None]) == [True, False, False]


def test_delimiter_count_is_literal(spark):
    assert one(spark, lambda c: cl.delimiter_count(c, "|"), ["a|b|c", "a;b"]) == [2, 0]


def test_surrogate_key_semantics(spark):
    df = spark.createDataFrame([("2024", "1"), (None, None)], "a string, b string")
    rows = df.select(k.surrogate_key("a", "b").alias("h"), k.surrogate_key("a", "b", strict=True).alias("s")).collect()
    assert rows[0]["h"] == hashlib.sha256(b"2024||1").hexdigest()
    assert rows[1]["h"] == hashlib.sha256(b"").hexdigest()
    assert rows[1]["s"] is None


def test_quarter_semester_labels(spark):
    df = spark.createDataFrame([(m,) for m in range(1, 13)], "m int")
    rows = df.select(k.quarter("m").alias("q"), k.semester("m").alias("s"),
                     k.quarter_label(k.quarter("m")).alias("ql")).collect()
    assert [r["q"] for r in rows] == [1, 1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 4]
    assert [r["s"] for r in rows] == [1] * 6 + [2] * 6
    assert rows[0]["ql"] == "1º Trimestre"


def test_month_name_and_base_name(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 1), "/a/b/EXP_2024.csv")], "d date, p string")
    r = df.select(k.month_name("d").alias("m"), k.base_name("p").alias("b")).first()
    assert (r["m"], r["b"]) == ("March", "EXP_2024.csv")


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(min_value=-10**12, max_value=10**12), min_size=1, max_size=30),
       st.sampled_from([1, 4, 8, 16]))
def test_hash_bucket_in_range(spark, keys, n):
    df = spark.createDataFrame([(x,) for x in keys], "k long")
    vals = [r[0] for r in df.select(k.hash_bucket("k", n)).collect()]
    assert all(0 <= v < n for v in vals)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="aáÃçÇ ~-_xyz09", max_size=12), min_size=1, max_size=10))
def test_cleaning_is_idempotent(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    once = df.select(cl.remove_accents("x").alias("x"))
    twice = once.select(cl.remove_accents("x").alias("x"))
    assert once.collect() == twice.collect()
