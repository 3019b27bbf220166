"""Surrogate keys, hash buckets, calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the source pipeline's for equal results.
KEY_SEPARATOR = "||"
QUARTER_SUFFIX = "º Trimestre"
SEMESTER_SUFFIX = "º Semestre"
# End of fixed values.


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols, strict: bool = False) -> Column:
    """hex SHA-256 of the key parts joined by ``||``; NULL parts are skipped.

    ``strict=True`` gives NULL when every part is NULL instead of the hash of ``''``.
    """
    parts = [_c(c).cast("string") for c in cols]
    key = F.sha2(F.concat_ws(KEY_SEPARATOR, *parts), 256)
    if strict:
        any_set = F.lit(False)
        for p in parts:
            any_set = any_set | p.isNotNull()
        return F.when(any_set, key)
    return key


def hash_bucket(c, n: int) -> Column:
    """Bucket in [0, n), 0 when n == 1 (``pmod`` so never negative)."""
    if n <= 1:
        return F.lit(0)
    return F.pmod(F.xxhash64(_c(c)), F.lit(n)).cast("int")


def quarter(month) -> Column:
    """ceil(month / 3) as bigint."""
    return F.ceil(_c(month) / 3)


def semester(month) -> Column:
    return F.ceil(_c(month) / 6)


def quarter_label(q) -> Column:
    """F18."""
    return F.concat(_c(q).cast("string"), F.lit(QUARTER_SUFFIX))


def semester_label(s) -> Column:
    return F.concat(_c(s).cast("string"), F.lit(SEMESTER_SUFFIX))


def month_name(d) -> Column:
    """full English month name."""
    return F.date_format(_c(d), "MMMM")


def base_name(path) -> Column:
    """last path segment."""
    return F.substring_index(_c(path), "/", -1)
