"""Join helpers: a size-checked broadcast and lookups.

Broadcast policy. A side is broadcast only when its size has a proven bound:
either a structural one (a calendar of months, a code table keyed by a fixed code
list) or one measured here (``broadcast_if_small`` counts at most ``max_rows + 1``
rows, so the check itself is bounded). Everything else is left to Catalyst and
AQE, which replan to a broadcast hash join only when the *runtime* size of a shuffle
stage is under ``spark.sql.adaptive.autoBroadcastJoinThreshold`` and otherwise keep
the sort-merge join (with skew-split of hot keys).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_BROADCAST_ROWS = 200_000  # code tables are far smaller; beyond this, a shuffle join


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast when ``df`` has at most ``max_rows`` rows, else return it as is."""
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def bounded_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast a side whose row count is bounded by construction (documented at call site)."""
    return F.broadcast(df)


def left_lookup(df: DataFrame, lookup: DataFrame, on, broadcast: str = "auto") -> DataFrame:
    """Left join to a code table. ``broadcast``: 'auto' (AQE decides), 'bounded', 'check'."""
    if broadcast == "bounded":
        lookup = bounded_broadcast(lookup)
    elif broadcast == "check":
        lookup = broadcast_if_small(lookup)
    return df.join(lookup, on=on, how="left")


def one_to_many_left(one: DataFrame, many: DataFrame, one_key: str, many_key: str) -> DataFrame:
    """``one LEFT JOIN many`` when ``one`` has a row per key and ``many`` may hold a hot key.

    AQE can split a skewed partition only on the preserved side of an outer join, and
    here the hot side is ``many``. The same result is built from an inner join (both
    sides splittable) plus the ``one`` rows whose key is absent from ``many``; that
    anti join runs against ``many``'s distinct keys, folded on the map side first.
    """
    matched = one.join(many, one[one_key] == many[many_key], "inner")
    keys = many.select(F.col(many_key).alias("__k")).distinct()
    unmatched = one.join(keys, one[one_key] == keys["__k"], "left_anti")
    for c in many.columns:
        if c not in unmatched.columns:
            unmatched = unmatched.withColumn(c, F.lit(None).cast(many.schema[c].dataType))
    return matched.unionByName(unmatched.select(*matched.columns))
