"""Column cleaning helpers (F1-F15, F20, F24-F28) and row predicates.

Column -> Column builders are the primitives; the ``*_df`` forms apply one builder to
many columns in a single ``select`` (one Project, no ``withColumn`` loop), and with
``columns=None`` to every string column (D10). Every function stays inside
whole-stage codegen: only built-in expressions, ``try_*`` forms under ANSI mode.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the source pipeline's for equal results.
# Accented letters and their plain replacements, position by position.
ACCENTED = "áàâãäéèêëíìîïóòôõöúùûüçÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇ"
UNACCENTED = "aaaaaeeeeiiiiooooouuuucAAAAAEEEEIIIIOOOOOUUUUC"
NOT_INFORMED = "NAO INFORMADO"
DEFAULT_COUNTRY = "105"
NON_ALNUM_PATTERN = r"[^a-zA-Z0-9\s]"
BLANK_PATTERN = r"^\s*$"
# End of fixed values.


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def string_columns(df: DataFrame, columns: Iterable[str] | None = None) -> list[str]:
    """The listed columns that are strings, or every string column."""
    strings = [n for n, t in df.dtypes if t == "string"]
    if columns is None:
        return strings
    wanted = {c.lower() for c in columns}
    return [n for n in strings if n.lower() in wanted]


def apply_to_columns(df: DataFrame, columns: Iterable[str] | None,
                     fn: Callable[[Column], Column], strings_only: bool = True) -> DataFrame:
    """Apply ``fn`` to the chosen columns in one projection, order kept."""
    if strings_only:
        targets = set(string_columns(df, columns))
    else:
        targets = {c for c in df.columns if c.lower() in {x.lower() for x in columns or df.columns}}
    return df.select([fn(F.col(n)).alias(n) if n in targets else F.col(n) for n in df.columns])


# ---------------------------------------------------------------- Column builders

def strip(c) -> Column:
    """trim U+0020 on both sides (tabs stay, as Spark's ``trim``)."""
    return F.trim(_c(c))


def remove_accents(c) -> Column:
    """map accented letters to plain ones, then delete all but [a-zA-Z0-9] and whitespace."""
    return F.regexp_replace(F.translate(_c(c), ACCENTED, UNACCENTED), NON_ALNUM_PATTERN, "")


def blank_to_null(c) -> Column:
    """NULL, empty or spaces-only -> NULL."""
    c = _c(c)
    return F.when(F.trim(c) == "", F.lit(None).cast("string")).otherwise(c)


def whitespace_blank_to_null(c) -> Column:
    """any-whitespace-only -> NULL, everything else kept (always an ``otherwise``)."""
    c = _c(c)
    return F.when(c.rlike(BLANK_PATTERN), F.lit(None).cast("string")).otherwise(c)


def not_informed(c, targets: Iterable[str] = (), placeholder: str = NOT_INFORMED) -> Column:
    """NULL, blank, ``"0"`` or a trimmed value in ``targets`` -> placeholder."""
    c = _c(c)
    vals = sorted(set(targets) | {"0"})
    return (F.when(c.isNull() | (F.trim(c) == "") | F.trim(c).isin(vals), F.lit(placeholder))
            .otherwise(c))


def null_to(c, value) -> Column:
    """NULL -> constant."""
    return F.coalesce(_c(c), F.lit(value))


def default_country(c, default: str = DEFAULT_COUNTRY) -> Column:
    """NULL, blank or the literal text ``null`` -> default country code."""
    c = _c(c)
    return (F.when(c.isNull() | (F.trim(c) == "") | (F.lower(F.trim(c)) == "null"), F.lit(default))
            .otherwise(c))


def zero_pad(c, width: int, truncate: bool = True) -> Column:
    """left-pad with zeros. ``truncate=True`` is ``lpad`` (cuts longer values,
    the source contract); ``False`` never cuts, for keys that may outgrow ``width``."""
    s = _c(c).cast("string")
    if truncate:
        return F.lpad(s, width, "0")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def parse_date(c, fmt: str = "yyyyMMdd") -> Column:
    """text -> date; bad or impossible dates (20230229, 00000000, 0, '') -> NULL."""
    return F.try_to_date(_c(c).cast("string"), fmt)


def parse_decimal(c, precision: int = 18, scale: int = 2) -> Column:
    """``1000,00`` -> 1000.00 as decimal(p,s); unparsable -> NULL."""
    return F.replace(F.trim(_c(c)), F.lit(","), F.lit(".")).try_cast(f"decimal({precision},{scale})")


def to_type(c, type_name: str) -> Column:
    """cast where a bad value gives NULL, as the pre-ANSI contract."""
    return _c(c).try_cast(type_name)


def flag_equals(c, value: str) -> Column:
    """boolean flag, NULL -> false."""
    return F.coalesce(_c(c) == F.lit(value), F.lit(False))


def repair_double_encoding(c) -> Column:
    """undo text that was UTF-8 but decoded as Latin-1 (``SÃ£o`` -> ``São``).

    Only text made of code points <= U+00FF is a candidate; its Latin-1 bytes are read
    back as UTF-8 when they form valid UTF-8, else the text is kept (``São``, ``€uro``).
    """
    c = _c(c)
    candidate = F.try_validate_utf8(F.encode(c, "ISO-8859-1").cast("string"))
    return F.coalesce(F.when(c.rlike("^[\\x00-\\xff]*$"), candidate), c)


def pad_list(c, width: int = 7, sep: str = ",") -> Column:
    """pad every element of a delimited list, order kept; NULL stays NULL (no explode)."""
    return F.array_join(F.transform(F.split(_c(c), sep), lambda x: F.lpad(x, width, "0")), sep)


def delimiter_count(c, delimiter: str) -> Column:
    """A10: occurrences of a literal delimiter (``|`` is not a regex here)."""
    c = _c(c)
    return F.length(c) - F.length(F.replace(c, F.lit(delimiter), F.lit("")))


def collapse_spaces(c) -> Column:
    """BOM strip, trim, whitespace runs -> one space."""
    return F.regexp_replace(F.trim(F.regexp_replace(_c(c), "^\ufeff", "")), r"\s+", " ")


# ---------------------------------------------------------------- DataFrame forms

def strip_df(df: DataFrame, columns=None) -> DataFrame:
    return apply_to_columns(df, columns, strip)


def remove_accents_df(df: DataFrame, columns=None) -> DataFrame:
    return apply_to_columns(df, columns, remove_accents)


def blanks_to_null_df(df: DataFrame, columns=None) -> DataFrame:
    return apply_to_columns(df, columns, blank_to_null)


def whitespace_blanks_to_null_df(df: DataFrame, columns=None) -> DataFrame:
    return apply_to_columns(df, columns, whitespace_blank_to_null)


def not_informed_df(df: DataFrame, columns=None, targets: Iterable[str] = ()) -> DataFrame:
    targets = list(targets)
    return apply_to_columns(df, columns, lambda c: not_informed(c, targets))


def upper_df(df: DataFrame, columns=None) -> DataFrame:
    """F11."""
    return apply_to_columns(df, columns, F.upper)


def parse_dates_df(df: DataFrame, columns: Iterable[str], fmt: str = "yyyyMMdd") -> DataFrame:
    return apply_to_columns(df, columns, lambda c: parse_date(c, fmt), strings_only=False)


def zero_pad_df(df: DataFrame, widths: dict[str, int], truncate: bool = True) -> DataFrame:
    low = {k.lower(): v for k, v in widths.items()}
    return df.select([zero_pad(F.col(n), low[n.lower()], truncate).alias(n) if n.lower() in low
                      else F.col(n) for n in df.columns])


def fill_null(df: DataFrame, value, columns: Iterable[str]) -> DataFrame:
    """F8: ``fillna`` restricted to columns."""
    return df.fillna(value, subset=list(columns))


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Absent names are ignored."""
    return df.drop(*names)


def clean_text_df(df: DataFrame, columns=None, upper: bool = True) -> DataFrame:
    """The registry text recipe: F1 -> F2 -> F4 (-> F11).

    Written as two projections on purpose: the blank test and the value both use the
    cleaned text, and Catalyst keeps an expensive expression that is referenced twice
    in its own projection instead of evaluating the regex twice per row.
    """
    targets = set(string_columns(df, columns))
    cleaned = df.select([remove_accents(strip(F.col(n))).alias(n) if n in targets else F.col(n)
                         for n in df.columns])

    def finish(c: Column) -> Column:
        out = blank_to_null(c)
        return F.upper(out) if upper else out
    return cleaned.select([finish(F.col(n)).alias(n) if n in targets else F.col(n) for n in df.columns])


# ---------------------------------------------------------------- predicates

def not_null_or_blank(*columns: str) -> Column:
    """Keep rows where every listed column is non-NULL and not ``""``/``" "``."""
    cond = F.lit(True)
    for c in columns:
        col = F.col(c)
        cond = cond & col.isNotNull() & (col != "") & (col != " ")
    return cond


def not_sentinel_key(c, sentinel: str = "00000000") -> Column:
    """Reject the all-zero key (NULL keys are left to E1/E3)."""
    c = _c(c)
    return c.isNull() | (c != F.lit(sentinel))


def key_has_length(c, n: int) -> Column:
    """Key present with exact length."""
    c = _c(c)
    return c.isNotNull() & (F.length(c) == n)


def is_blank_regex(c) -> Column:
    """E10."""
    return _c(c).rlike(BLANK_PATTERN)
