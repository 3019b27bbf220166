"""Messy landing files derived by Spark from the driver tables.

The source pipeline reads raw delimited files; these writers produce such files from
the parquet tables (every row of the table, written by Spark tasks into a fresh
folder under the shared checkpoint folder), so the readers are exercised end to end
on data that grows with the tables.
"""

from __future__ import annotations

import gzip
import os
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package
from ..sources.archives import open_stream
from ..sources.sinks import open_writers
from .standins import Tables

PART_COLUMNS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
# Decoration that puts a delimiter, quotes, a line break and Latin-1 letters in a field.
PART_NAME_SUFFIX = ("; \"", "\"\nAçúcar São Paulo")
FILE_WRITERS = 32
CUSTOMER_HEADER = "C_CUSTKEY;C_NAME;C_MKTSEGMENT"
CUSTOMER_HEADER_VARIANT = "\ufeff c_custkey ;C_Name;  c_mktsegment"


def messy_part_name(brand_col="p_brand", name_col="p_name"):
    return F.concat(F.col(name_col), F.lit(PART_NAME_SUFFIX[0]), F.col(brand_col), F.lit(PART_NAME_SUFFIX[1]))


def write_quoted_part_csv(t: Tables) -> str:
    """Latin-1, ``;``-separated, header in every file; quoted fields with the delimiter,
    doubled quotes and line breaks; plus short rows (``key;name`` from nation) that a
    quote-aware PERMISSIVE read must route to the corrupt set."""
    folder = scratch_path(t.spark, "landing-part")
    rows = t.part.select(
        F.col("p_partkey").cast("string").alias("p_partkey"), messy_part_name().alias("p_name"),
        "p_brand", "p_type", F.col("p_size").cast("string").alias("p_size"),
        F.col("p_retailprice").cast("string").alias("p_retailprice"))
    (rows.write.option("sep", ";").option("quote", '"').option("escape", '"').option("header", "true")
         .option("encoding", "ISO-8859-1").mode("overwrite").csv(os.path.join(folder, "good")))
    short = t.nation.select(F.concat_ws(";", F.col("n_nationkey").cast("string"), "n_name")
                            .alias(";".join(PART_COLUMNS)))
    (short.write.option("sep", "\t").option("quote", "").option("header", "true")
          .option("encoding", "ISO-8859-1").mode("overwrite").csv(os.path.join(folder, "short")))
    return folder


def write_broken_customer_lines(t: Tables) -> str:
    """UTF-8 lines: a good line, a line with one field too many and a ``|``-delimited
    line per customer; the header repeated (once per nation) and a BOM/case/spacing
    variant of it (once per region), all in arbitrary order across files."""
    folder = scratch_path(t.spark, "landing-customer")
    c = t.customer
    key = F.col("c_custkey").cast("string")
    good = c.select(F.concat_ws(";", key, "c_name", "c_mktsegment").alias("value"))
    extra = c.select(F.concat_ws(";", key, "c_name", "c_mktsegment", F.lit("EXTRA")).alias("value"))
    pipe = c.select(F.concat_ws("|", key, "c_name", "c_mktsegment").alias("value"))
    headers = t.nation.select(F.lit(CUSTOMER_HEADER).alias("value"))
    variants = t.region.select(F.lit(CUSTOMER_HEADER_VARIANT).alias("value"))
    lines = good.unionByName(extra).unionByName(pipe).unionByName(headers).unionByName(variants)
    lines.write.mode("overwrite").text(folder)
    return folder


def write_event_days(t: Tables, landing: str, first_day: str | None, last_day: str | None) -> None:
    """One folder of ``;``-separated files per event day (``dia=yyyyMMdd``) in a range."""
    ev = t.events.select(
        F.col("event_id").cast("string").alias("event_id"), F.col("user_id").cast("string").alias("user_id"),
        "event_type", F.col("value").cast("string").alias("value"), "props",
        F.date_format("ts", "yyyyMMdd").alias("dia"))
    if first_day:
        ev = ev.filter(F.col("dia") >= F.lit(first_day))
    if last_day:
        ev = ev.filter(F.col("dia") <= F.lit(last_day))
    (ev.write.option("sep", ";").option("quote", '"').option("escape", '"').option("header", "true")
       .option("encoding", "ISO-8859-1").mode("append").partitionBy("dia").csv(landing))


def _hadoop(t: Tables, path: str):
    p = t.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(t.spark.sparkContext._jsc.hadoopConfiguration())


def _join_parts(job: tuple[list[str], str]) -> None:
    """One file of many packed parts: the first part's header, every part's lines. The bytes go through in pieces."""
    parts, target = job
    with open_stream(target, "wb") as out:
        for i, part in enumerate(parts):
            with open_stream(part) as packed, gzip.open(packed) as lines:
                head = i > 0
                while piece := lines.read(1 << 22):
                    if head:
                        at = piece.find(b"\n")
                        if at < 0:
                            continue
                        piece, head = piece[at + 1:], False
                    out.write(piece)


def write_named_csv(t: Tables, rows, landing: str, names, by: str | None = None, sep: str = ";", quote: str = '"') -> None:
    """Header-bearing ``;`` Latin-1 files with names of their own, old files of these names replaced.

    ``names`` is the file's name, or a function from a value of the column ``by`` to it: one file
    for each value. The lines are written where they are, each task its part of every file; a few
    values would keep as few tasks busy. The parts of a file are then joined, byte by byte, by one
    task, and the file renamed. Parts are packed and old files go before the new ones are joined, so the
    lines lie on the disk in full only once.
    """
    staged = scratch_path(t.spark, "named-csv")
    w = (rows if by else rows.coalesce(1)).write.mode("overwrite")
    w = w.partitionBy(by).option("compression", "gzip") if by else w
    with open_writers(t.spark, FILE_WRITERS):
        w.option("sep", sep).option("header", "true").option("quote", quote).option("escape", '"').option(
            "encoding", "ISO-8859-1").csv(staged)
    root, fs = _hadoop(t, landing)
    fs.mkdirs(root)
    pattern, _ = _hadoop(t, os.path.join(staged, f"{by}=*" if by else "", "part-*"))
    parts: dict[str, list[str]] = {}
    for st in fs.globStatus(pattern):  # names of parts, no lines
        value = st.getPath().getParent().getName().partition("=")[2]
        parts.setdefault(names(value) if by else names, []).append(st.getPath().toString())
    targets = {name: _hadoop(t, os.path.join(landing, name))[0] for name in parts}
    for target in targets.values():
        fs.delete(target, False)
    made = {name: p[0] for name, p in parts.items()}
    if by and parts:
        made = {name: os.path.join(staged, f"_{name}") for name in parts}
        ship_package(t.spark)
        t.spark.sparkContext.parallelize([(sorted(parts[n]), made[n]) for n in made], len(made)).foreach(_join_parts)
    for name, path in made.items():
        fs.rename(_hadoop(t, path)[0], targets[name])
    fs.delete(_hadoop(t, staged)[0], True)


def write_named_lines(t: Tables, rows, landing: str, names, by: str) -> None:
    """The same for lines as they are: the one column besides ``by`` holds them and names the header line."""
    write_named_csv(t, rows, landing, names, by, sep="\t", quote="")


def remove_file(t: Tables, landing: str, name: str) -> None:
    path, fs = _hadoop(t, os.path.join(landing, name))
    fs.delete(path, False)


def _zip_writer(folder: str, member: str, group: str):
    """Stream one task's lines into one archive member (memory bounded by a batch).

    The archive is named after the partition and written under a temporary name, then
    renamed: a retried task (lost executor) replaces its archive instead of adding one.
    """
    def run(batches):
        from pyspark import TaskContext
        name = f"{group}{TaskContext.get().partitionId()}.zip"
        final = os.path.join(folder, name)
        tmp = os.path.join(folder, f".{name}.{TaskContext.get().taskAttemptId()}.tmp")
        n = 0
        with zipfile.ZipFile(tmp, "w", zipfile.ZIP_DEFLATED) as zf:
            with zf.open(member, "w") as out:
                for pdf in batches:  # a batch at a time: a call a line costs more than its compression
                    out.write("".join([v + "\r\n" for v in pdf["value"]]).encode("iso-8859-1"))
                    n += len(pdf)
        if n == 0:
            os.remove(tmp)
            return
        os.replace(tmp, final)
        yield pd.DataFrame({"archive": [name], "lines": [n]})
    return run


def write_archives(t: Tables, lines, group: str, member: str, folder: str) -> None:
    """The column ``value`` as headerless lines in ZIP archives ``<group><n>.zip``, one a partition of ``lines``."""
    lines.select("value").mapInPandas(_zip_writer(folder, member, group), "archive string, lines long").write.format(
        "noop").mode("overwrite").save()


def write_supplier_archives(t: Tables, partitions: int = 3) -> str:
    """Headerless ``;`` lines of supplier written as ZIP archives named ``Socios<n>.zip``,
    every archive holding a member of the same name; one archive per task (at least
    ``partitions`` archives)."""
    folder = scratch_path(t.spark, "landing-zip")
    lines = t.supplier.select(F.concat_ws(";", F.col("s_suppkey").cast("string"), "s_name",
                                          F.col("s_nationkey").cast("string")).alias("value"))
    # one archive per input partition (so archives grow in number, not size, with the data)
    n = max(partitions, lines.rdd.getNumPartitions())
    written = lines.repartition(n).mapInPandas(
        _zip_writer(folder, "K3241.SOCIOCSV", "Socios"), "archive string, lines long")
    written.write.format("noop").mode("overwrite").save()
    return folder


def write_named_trade_files(t: Tables) -> str:
    """Empty-bodied files named like a trade landing folder: ``EXP_yyyy.csv`` and
    ``IMP_yyyy.csv`` per ship year, ``NCM.csv``, one auxiliary CSV per region, one
    non-CSV file. Names are built by Spark; each task writes its own files."""
    folder = scratch_path(t.spark, "landing-names")
    years = t.lineitem.select(F.year("l_shipdate").cast("string").alias("y")).distinct()
    names = (years.select(F.concat(F.lit("EXP_"), "y", F.lit(".csv")).alias("name"))
             .unionByName(years.select(F.concat(F.lit("IMP_"), "y", F.lit(".csv")).alias("name")))
             .unionByName(t.region.select(F.concat(F.upper("r_name"), F.lit(".csv")).alias("name")))
             .unionByName(t.region.groupBy().agg(F.max(F.lit("NCM.csv")).alias("name")))
             .unionByName(t.region.groupBy().agg(F.max(F.lit("LEIAME.txt")).alias("name"))))

    def touch(batches):
        for pdf in batches:
            for n in pdf["name"]:
                with open(os.path.join(folder, n), "w", encoding="iso-8859-1") as fh:
                    fh.write("CO;NO\n")
            yield pdf

    names.mapInPandas(touch, "name string").write.format("noop").mode("overwrite").save()
    return folder
