"""Deduplication operators.

Deterministic key dedup is written as an aggregate, not as ``row_number`` over a
window: ``min(struct(order..., rest...))`` per key is partially aggregated on the
map side, so a key that holds a third of all rows collapses before the shuffle
instead of landing whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_rows(df: DataFrame) -> DataFrame:
    """Full-row dedup (hash aggregate with map-side combine)."""
    return df.dropDuplicates()


def dedup_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] = (),
                 descending: bool = False) -> DataFrame:
    """Keep one row per key, the first by ``order_by`` then by every other column.

    NULLs sort first (Spark struct order), so the oracle uses ``NULLS FIRST``.
    ``descending=True`` keeps the last row instead (max over the same struct).
    """
    keys = list(keys)
    low_keys = {k.lower() for k in keys}
    rest = [c for c in df.columns if c.lower() not in low_keys]
    if not rest:  # the keys are the whole row: a plain distinct
        return df.dropDuplicates(keys)
    order_exprs = [(F.col(o) if isinstance(o, str) else o).alias(f"__o{i}")
                   for i, o in enumerate(order_by)]
    packed = F.struct(*order_exprs, *[F.col(c) for c in rest])
    pick = F.max(packed) if descending else F.min(packed)
    out = df.groupBy(*keys).agg(pick.alias("__row"))
    return out.select(*[F.col(f"__row.{c}").alias(c) if c.lower() not in low_keys else F.col(c)
                        for c in df.columns])


def latest_per_key(df: DataFrame, keys: Sequence[str], ts_col: str,
                   tiebreak: Sequence[str] = ()) -> DataFrame:
    """I1 as intended: the newest row per key (ties broken by ``tiebreak`` descending)."""
    return dedup_by_key(df, keys, [ts_col, *tiebreak], descending=True)
