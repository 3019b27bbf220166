"""Data-quality checks returned as tables.

Each check is a small aggregate per input; the per-input rows are combined with
``unionByName`` so one action evaluates all of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Number of key values that occur more than once (one row)."""
    return (df.groupBy(*keys).count().filter("count > 1")
              .agg(F.count(F.lit(1)).alias("duplicate_keys")))


def duplicate_key_report(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """M9: ``(dimension, duplicate_keys)`` for every named table."""
    parts = [duplicate_keys(df, keys).select(F.lit(name).alias("dimension"), "duplicate_keys")
             for name, (df, keys) in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def table_count_report(tables: dict[str, DataFrame]) -> DataFrame:
    """M8/H7: ``(table_name, total_registros)`` for every named table."""
    parts = [df.agg(F.count(F.lit(1)).alias("total_registros"))
               .select(F.lit(name).alias("table_name"), "total_registros")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)
