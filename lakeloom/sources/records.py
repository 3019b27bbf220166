"""Quoted delimited files with line breaks inside fields, read in splits (A1, K1-K4).

A multi-line CSV reader makes a file one task, as no split knows whether it begins inside quotes.
Here a file is read as lines, in splits, and the quotes decide afterwards:

1. one pass over the lines numbers them within their split and counts their quotes; whether a line
   begins inside quotes is then known but for the state in which its split begins;
2. that state is the parity of the quotes in all earlier splits of the file: a prefix sum over one
   row a split;
3. a line that begins outside quotes and has an even number of them is a record; the others are
   grouped by the line that their record begins with, and joined by line feeds.

Only lines of records that span lines are shuffled. A record of more than ``max_lines`` lines (a
quote that is never closed takes the rest of its file) is not put together: its lines are rejected
one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.joins import broadcast_if_small
from ..session import scratch_path, ship_package
from .csv import CORRUPT_COL, ReadResult, header_columns, string_schema
from .quarantine import BROKEN_RECORD, fields_set, reject

OPEN_QUOTE = "open_quote"
MAX_LINES = 10_000
_LINES = "file string, split long, no long, odd boolean, quotes long, start0 long, start1 long, line binary"


def _runs(changed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    start = np.flatnonzero(changed)
    return start, np.diff(np.r_[start, len(changed)])


def _numbered(quote: str):
    """Number the lines of each split; ``odd``: an odd number of quotes before the line in its split;
    ``start0``/``start1``: the last line up to this one with an even / odd number before it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, seen, parity, last = None, 0, 0, [-1, -1]
        for batch in batches:
            if not batch.num_rows:
                continue
            files, splits = batch.column(0), batch.column(1).to_numpy()
            file_no = files.dictionary_encode().indices.to_numpy()
            quotes = pc.count_substring(batch.column(2), quote).to_numpy().astype(np.int64)
            start, length = _runs(np.r_[True, (file_no[1:] != file_no[:-1]) | (splits[1:] != splits[:-1])])
            no, odd, starts = np.empty(len(splits), np.int64), np.empty(len(splits), bool), np.empty((2, len(splits)), np.int64)
            for s, n in zip(start, length):  # one turn a split
                here = (files[int(s)].as_py(), int(splits[s]))
                if here != place:
                    place, seen, parity, last = here, 0, 0, [-1, -1]
                at = slice(s, s + n)
                no[at] = seen + np.arange(n)
                before = parity + np.r_[0, np.cumsum(quotes[at])[:-1]]
                odd[at] = before % 2 == 1
                for k in (0, 1):
                    mark = np.where(odd[at] == bool(k), no[at], last[k])
                    starts[k, at] = np.maximum.accumulate(np.r_[last[k], mark])[1:]
                    last[k] = int(starts[k, s + n - 1])
                seen, parity = seen + int(n), int(before[-1] + quotes[s + n - 1]) % 2
            yield pa.RecordBatch.from_arrays(
                [files, batch.column(1), pa.array(no), pa.array(odd), pa.array(quotes), pa.array(starts[0]),
                 pa.array(starts[1]), batch.column(2)], [c.split()[0] for c in _LINES.split(", ")])

    return run


def numbered_lines(spark: SparkSession, path, recursive: bool = True, path_glob_filter: str | None = None,
                   quote: str = '"') -> DataFrame:
    """The lines of the files in splits, as bytes, written once: a later read must see the same splits."""
    ship_package(spark)
    r = spark.read.option("lineSep", "\n").option("recursiveFileLookup", str(recursive).lower())
    if path_glob_filter:
        r = r.option("pathGlobFilter", path_glob_filter)
    lines = r.text(path).select(F.col("_metadata.file_path").alias("file"),
                                F.col("_metadata.file_block_start").cast("long").alias("split"),
                                F.col("value").cast("binary").alias("line"))
    place = scratch_path(spark, "csv-lines")
    lines.mapInArrow(_numbered(quote), _LINES).write.mode("overwrite").parquet(place)
    return spark.read.schema(_LINES).parquet(place)


def quoted_records(spark: SparkSession, path, encoding: str = "iso-8859-1", recursive: bool = True,
                   path_glob_filter: str | None = None, quote: str = '"', max_lines: int = MAX_LINES) -> tuple[DataFrame, DataFrame]:
    """``(file, first, record)`` of every record, ``first`` marking the first one of a file, and ``(file, line)``
    of the lines of records that were too long. Blank records are left out."""
    lines = numbered_lines(spark, path, recursive, path_glob_filter, quote)
    splits = lines.groupBy("file", "split").agg(F.sum("quotes").alias("quotes"), F.max("start0").alias("last0"),
                                                F.max("start1").alias("last1"))  # one row a split
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    state = splits.select("*", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2).alias("state"))
    state = state.withColumn("last", F.when(F.col("state") == 0, F.col("last0")).otherwise(F.col("last1")))
    held = F.when(F.col("last") >= 0, F.struct(F.col("split").alias("split"), F.col("last").alias("no")))
    state = state.withColumn("open", F.last(held, ignorenulls=True).over(before)).select("file", "split", "state", "open")
    placed = lines.join(broadcast_if_small(state), ["file", "split"])
    inside = F.col("odd") != (F.col("state") == 1)
    start = F.when(F.col("state") == 0, F.col("start0")).otherwise(F.col("start1"))
    placed = placed.select(
        "file", "split", "no", "line", (~inside & (F.col("quotes") % 2 == 0)).alias("whole"),
        F.when(start >= 0, F.struct(F.col("split").alias("split"), start.alias("no"))).otherwise(F.col("open")).alias("record"))
    decode = lambda c: F.regexp_replace(F.decode(c, encoding), "\r$", "")
    first = (F.col("record.split") == 0) & (F.col("record.no") == 0)
    single = placed.where("whole").select("file", first.alias("first"), decode(F.col("line")).alias("record"))
    spread = placed.where("NOT whole").select("file", "record", "split", "no", "line")
    sizes = spread.groupBy("file", "record").agg(F.count("*").alias("n"))
    long = sizes.where(F.col("n") > max_lines).select("file", "record")
    parts = spread.join(sizes.where(F.col("n") <= max_lines).select("file", "record"), ["file", "record"]).groupBy("file", "record").agg(
        F.array_sort(F.collect_list(F.struct("split", "no", "line"))).alias("lines"))  # at most max_lines
    joined = parts.select("file", first.alias("first"), F.array_join(
        F.transform("lines", lambda x: decode(x["line"])), "\n").alias("record"))
    lost = spread.join(long, ["file", "record"]).select("file", decode(F.col("line")).alias("line"))
    return single.unionByName(joined).where(F.trim("record") != ""), lost


def read_csv_records(spark: SparkSession, path, delimiter: str = ";", encoding: str = "iso-8859-1", recursive: bool = True,
                     path_glob_filter: str | None = None, header: bool = True, schema: StructType | None = None,
                     quote: str = '"', escape: str = '"', ignore_ws: bool = True, max_lines: int = MAX_LINES) -> ReadResult:
    """A1/A2 in splits: the good and rejected rows of ``read_csv_with_quotes(multiline=True)``, the file of a
    good row in ``origin_path_name``. Quotes inside a quoted field are doubled, or escaped in pairs."""
    if schema is None:
        if not header:
            raise ValueError("a headerless read needs a schema")
        schema = string_schema(header_columns(spark, path, delimiter, encoding, recursive, path_glob_filter, quote, escape))
    columns = [c for c in schema.fieldNames() if c != CORRUPT_COL]
    records, lost = quoted_records(spark, path, encoding, recursive, path_glob_filter, quote, max_lines)
    body = records.where("NOT first") if header else records
    ddl = ", ".join(f"`{c}` STRING" for c in [*columns, CORRUPT_COL])
    options = {"sep": delimiter, "quote": quote, "escape": escape, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL,
               "ignoreLeadingWhiteSpace": str(ignore_ws).lower(), "ignoreTrailingWhiteSpace": str(ignore_ws).lower()}
    parsed = body.select(F.col("file"), F.from_csv("record", ddl, options).alias("r"))
    ok = parsed.where(F.col(f"r.{CORRUPT_COL}").isNull()).select(*[F.col(f"r.`{c}`").alias(c) for c in columns],
                                                                 F.col("file").alias("origin_path_name"))
    bad = parsed.where(F.col(f"r.{CORRUPT_COL}").isNotNull()).select("file", "r.*").select(*reject(
        F.col("file"), F.col(CORRUPT_COL), F.lit(BROKEN_RECORD), fields_set(columns) - 1))
    unclosed = lost.select(*reject(F.col("file"), F.col("line"), F.lit(OPEN_QUOTE), F.lit(None)))
    return ReadResult(ok, bad.unionByName(unclosed), columns)
