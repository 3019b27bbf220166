"""File inventory and routing as DataFrames.

The listing is a ``binaryFile`` scan that selects only ``path``, ``length`` and
``modificationTime``; ``content`` is pruned, so no file body is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import base_name

# Fixed values that must equal the source pipeline's for equal results.
EXPORT_PATTERN = r"^EXP_[0-9]{4}\.csv$"
IMPORT_PATTERN = r"^IMP_[0-9]{4}\.csv$"
PRODUCT_FILE = "NCM.csv"
CSV_EXTENSION = ".csv"
# End of fixed values.


def list_files(spark: SparkSession, path, recursive: bool = True, path_glob_filter: str | None = None,
               extension: str | None = None) -> DataFrame:
    """``(path, name, length, modificationTime)`` of every file below ``path``."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if path_glob_filter:
        r = r.option("pathGlobFilter", path_glob_filter)
    out = r.load(path).select("path", base_name(F.col("path")).alias("name"), "length", "modificationTime")
    if extension:
        out = out.filter(F.lower("name").endswith(extension.lower()))
    return out


def route_files(files: DataFrame) -> DataFrame:
    """``kind`` (EXP, IMP, NCM, AUX or NULL) and ``table_name`` (lower-cased base name)."""
    name = F.col("name")
    kind = (F.when(name.rlike(EXPORT_PATTERN), F.lit("EXP"))
             .when(name.rlike(IMPORT_PATTERN), F.lit("IMP"))
             .when(name == F.lit(PRODUCT_FILE), F.lit("NCM"))
             .when(F.lower(name).endswith(CSV_EXTENSION), F.lit("AUX")))
    table = F.lower(F.regexp_replace(name, r"\.[^.]*$", ""))
    return files.select("*", kind.alias("kind"), table.alias("table_name"))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, asked of the file system that it names."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder, asked of the file system that it names; whether it was there."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True))
