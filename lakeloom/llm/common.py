"""Helpers shared by the operators: shared-folder tables, free column names, row keys."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.session import ensure_checkpoint_dir, ship_package  # noqa: F401

#: The six ASCII white-space characters: space and U+0009 to U+000D.
ASCII_SPACE = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under ``spark.checkpoint.dir``; Spark's writer creates it."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


_tables: ContextVar[list[str] | None] = ContextVar("tables", default=None)


@contextmanager
def working_tables() -> Iterator[list[str]]:
    """The paths that ``written`` makes inside the block; nested blocks add to the outer ones."""
    mine: list[str] = []
    outer = _tables.get()
    token = _tables.set(mine)
    try:
        yield mine
    finally:
        _tables.reset(token)
        if outer is not None:
            outer += mine


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete working tables that nothing reads any more. The call for a collection lets Spark's
    cleaner see that their shuffles are done with as well, and free those files too."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    if paths:
        gc.collect()
        jvm.System.gc()


def written(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation, and every
    column read later is pruned at the scan.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path, compression=compression)
    if _tables.get() is not None:
        _tables.get().append(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, base: str) -> str:
    """``base``, or ``base`` with underscores, whichever the frame does not have (any case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def stable_key(*cols):
    """One non-null string for a tuple of columns; nulls stay apart from every value."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
