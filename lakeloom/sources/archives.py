"""Archive extraction as a Spark job.

Only paths and member names travel. A first pass reads the central directory at the end of each
archive and lists its members; then every (archive, member) is a unit of work of its own: its
task opens the archive, seeks to the member and yields its records in bounded chunks. So one
archive of many members spreads over as many tasks, archives may be of any size, and nothing
passes through the driver. A member is a deflate stream, which has no place to start but its
beginning. On file systems that Python cannot open by path the content comes through
``binaryFile`` (2 GB an archive, one archive a task).
"""

from __future__ import annotations

import io
import re
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LINE_SCHEMA = "archive string, grp string, member string, line_no long, line string"
CHUNK_LINES = 50_000
MEMBER_TASKS = 20_000
STREAMED_SCHEMES = ("/", "file:")


def archive_group(name: str) -> str:
    """``Empresas3.zip`` -> ``Empresas``: base name without extension and digits."""
    stem = re.sub(r"\.[^.]*$", "", name)
    return re.sub(r"[0-9]", "", stem)


def _records(lines, quoted: bool):
    """(number of the first line, text) of each record. With ``quoted``, physical lines are put
    together until the quotes are even, so a line break inside quotes stays in its record."""
    start, held, odd = 0, [], False
    for number, line in lines:
        if not held:
            start = number
        held.append(line)
        odd ^= quoted and line.count('"') % 2 == 1
        if not odd:
            yield start, "\n".join(held)
            held = []
    if held:
        yield start, "\n".join(held)


def _member_lines(archive, path: str, encoding: str, drop_empty: bool, quoted: bool, only: str | None = None):
    """Frames of at most ``CHUNK_LINES`` records of one open archive, or of one member of it."""
    columns, rows = ["archive", "grp", "member", "line_no", "line"], []
    grp = archive_group(path.rsplit("/", 1)[-1])
    with zipfile.ZipFile(archive) as zf:
        for member in zf.namelist() if only is None else [only]:
            if member.endswith("/"):
                continue
            with zf.open(member) as fh:
                text = io.TextIOWrapper(fh, encoding=encoding, newline="\n")
                physical = ((i + 1, raw.rstrip("\n").rstrip("\r")) for i, raw in enumerate(text))
                for number, line in _records(physical, quoted):
                    if drop_empty and not line.strip():
                        continue
                    rows.append((path, grp, member, number, line))
                    if len(rows) >= CHUNK_LINES:
                        yield pd.DataFrame(rows, columns=columns)
                        rows = []
    if rows:
        yield pd.DataFrame(rows, columns=columns)


def _from_content(encoding: str, drop_empty: bool, quoted: bool):
    def run(batches):
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                yield from _member_lines(io.BytesIO(content), path, encoding, drop_empty, quoted)
    return run


def _place(path: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(path if "://" in path or ":" not in path else path.replace(":", "://", 1))


def _open(path: str):
    store, place = _place(path)
    return store.open_input_file(place)


def open_stream(path: str, mode: str = "rb"):
    """A file inside a task, in the store that its path names, to be read or (``"wb"``) written from start to end."""
    store, place = _place(path)
    return store.open_output_stream(place, compression=None) if mode == "wb" else store.open_input_stream(place, compression=None)


def _directory(batches):
    """``(path, member, size)`` of every member, from the central directories alone."""
    for pdf in batches:
        for path in pdf["path"]:
            with _open(path) as archive, zipfile.ZipFile(archive) as zf:
                rows = [(path, i.filename, i.file_size) for i in zf.infolist() if not i.is_dir()]
            yield pd.DataFrame(rows, columns=["path", "member", "size"])


def _from_path(encoding: str, drop_empty: bool, quoted: bool):
    def run(batches):
        for pdf in batches:
            for path, member in zip(pdf["path"], pdf["member"]):
                with _open(path) as archive:
                    yield from _member_lines(archive, path, encoding, drop_empty, quoted, member)
    return run


def archive_members(archives: DataFrame) -> DataFrame:
    """``(path, member, size)`` of every member of the archives whose ``path`` is listed."""
    paths = archives.select("path")
    return paths.repartition(paths.sparkSession.sparkContext.defaultParallelism).mapInPandas(
        _directory, "path string, member string, size long")


def group_of(path_col) -> "F.Column":
    """Column form of ``archive_group`` over a file path."""
    name = F.regexp_extract(path_col, r"[^/]+$", 0)
    return F.regexp_replace(F.regexp_replace(name, r"\.[^.]*$", ""), "[0-9]", "")


def archive_files(spark: SparkSession, path, glob: str = "*.zip", recursive: bool = True,
                  group: str | None = None) -> DataFrame:
    """The archives of a folder (one group's only, when given): path and size, no content read."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", str(recursive).lower()).load(path).select("path", "length"))
    return files if group is None else files.filter(group_of(F.col("path")) == F.lit(group))


def lines_of_archives(spark: SparkSession, archives: DataFrame, encoding: str = "iso-8859-1",
                      drop_empty_lines: bool = True, quoted: bool = False, stream: bool | None = None) -> DataFrame:
    """The records of the archives whose ``path`` is listed.

    ``stream=True`` opens an archive by its path inside the task and reads one member piece by
    piece, whatever its size; ``False`` takes the content through ``binaryFile`` (2 GB at most). By
    default paths that every node can open are streamed.
    """
    first = archives.select("path").first()
    if first is None:
        return spark.createDataFrame([], LINE_SCHEMA)
    if stream is None:
        stream = first["path"].startswith(STREAMED_SCHEMES)
    if stream:
        members = archive_members(archives)
        # a number of its own, as adaptive execution would put so few bytes into one task: a member a task
        # up to MEMBER_TASKS, then some members a task; by ranges, as hashes of so few names would give one
        # task several members and a third of them none
        tasks = max(1, min(members.count(), MEMBER_TASKS))
        return members.repartitionByRange(tasks, "path", "member").select("path", "member").mapInPandas(
            _from_path(encoding, drop_empty_lines, quoted), LINE_SCHEMA)
    names = [r["path"] for r in archives.select("path").collect()]  # archive names only
    bins = spark.read.format("binaryFile").load(names)
    return bins.select("path", "content").mapInPandas(_from_content(encoding, drop_empty_lines, quoted), LINE_SCHEMA)


def archive_lines(spark: SparkSession, path, encoding: str = "iso-8859-1", glob: str = "*.zip",
                  recursive: bool = True, drop_empty_lines: bool = True,
                  group: str | None = None, quoted: bool = False, stream: bool | None = None) -> DataFrame:
    """``(archive, grp, member, line_no, line)`` for every member line of every archive.

    Members are keyed by (archive, member), never by member name alone (Q32), so two
    archives holding a member of the same name stay distinct. ``group`` keeps only the
    archives of one group, selected on the file path before any archive is opened.
    """
    return lines_of_archives(spark, archive_files(spark, path, glob, recursive, group), encoding,
                             drop_empty_lines, quoted, stream)
