"""Lists in a text column taken apart, treated and collected again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import zero_pad


def pad_and_regroup(df: DataFrame, group: list[str], column: str, width: int, sep: str = ",") -> DataFrame:
    """One row per ``group`` with the elements of ``column`` padded (never cut) and joined again.

    The aggregate form of ``cleaning.pad_list``, for lists that are spread over several rows of
    a group: elements come in the order of their rows' text, then of their place in it. Groups
    without any element keep a NULL.
    """
    element = df.select(*group, F.col(column).alias("_list"), F.posexplode_outer(F.split(column, sep)).alias("_at", "_item"))
    item = F.when(F.col("_item").isNotNull(), F.struct(
        "_list", "_at", zero_pad(F.col("_item"), width, truncate=False).alias("_item")))
    held = element.groupBy(*group).agg(F.array_sort(F.collect_list(item)).alias("_items"))
    return held.select(*group, F.when(F.size("_items") > 0, F.array_join(
        F.transform("_items", lambda x: x["_item"]), sep)).alias(column))
