"""Scalar expressions with the null contract of survey data.

Missing never raises and never leaks into an indicator: an indicator built on a
missing answer is 0, a number that cannot be parsed is null, and a ratio with a
zero denominator is null.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, IntegralType, StringType

# Answers that stand for "question not asked" or "no answer".
SKIP_ANSWERS = ("pase", "none", "nan", "")

ACCENTED = "áàâäãåéèêëíìîïóòôöõúùûüñçýÿ"
PLAIN = "aaaaaaeeeeiiiiooooouuuuncyy"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- text

def normalize_text(c: Column | str) -> Column:
    """Free text: null becomes '', the stray 0x96 dash becomes a space, runs of
    white space collapse, ends are trimmed, letters are lower-cased."""
    text = F.replace(F.coalesce(_col(c), F.lit("")), F.lit("\u0096"), F.lit(" "))
    return F.lower(F.trim(F.regexp_replace(text, r"(?U)[\s\x1c-\x1f]+", " ")))


def norm_cat(c: Column | str) -> Column:
    """Category text: trimmed and lower-cased; null stays null."""
    return F.lower(F.trim(_col(c).cast("string")))


def strip_accents(c: Column | str) -> Column:
    return F.translate(_col(c), ACCENTED + ACCENTED.upper(), PLAIN + PLAIN.upper())


def zfill(c: Column | str, width: int) -> Column:
    """Left-pad a code with zeros; a longer code is never shortened."""
    text = _col(c).cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def code_levels(c: Column | str, widths: Sequence[int]) -> list[Column]:
    """Prefixes of a hierarchical code, one column per width."""
    return [F.substring(_col(c), 1, w) for w in widths]


def _id_part(c: Column | str, dtype: DataType | None) -> Column:
    col = _col(c)
    if isinstance(dtype, (DoubleType, FloatType)):
        whole = col == F.floor(col)
        text = F.when(whole, col.cast("bigint").cast("string")).otherwise(col.cast("string"))
        return F.when(col.isNull() | F.isnan(col), F.lit("NA")).otherwise(text)
    if isinstance(dtype, IntegralType):
        return F.coalesce(col.cast("string"), F.lit("NA"))
    return F.coalesce(F.trim(col.cast("string")), F.lit("NA"))


def composite_id(cols: Sequence[Column | str], dtypes: Sequence[DataType | None] | None = None,
                 sep: str = "_") -> Column:
    """Parts joined with ``sep``; null prints as NA, a whole float as an integer."""
    kinds = dtypes or [StringType()] * len(cols)
    return F.concat_ws(sep, *[_id_part(c, t) for c, t in zip(cols, kinds)])


# ---------------------------------------------------------------- numbers

def null_if_nan(c: Column | str) -> Column:
    col = _col(c)
    return F.when(F.isnan(col), F.lit(None)).otherwise(col)


def as_number(c: Column | str) -> Column:
    """Number from any column; unreadable text and NaN become null."""
    return null_if_nan(_col(c).try_cast("double"))


def safe_divide(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b; null when either side is missing or b is zero."""
    return F.try_divide(as_number(a), as_number(b))


def row_sum(cols: Iterable[Column | str]) -> Column:
    """Row-wise sum of the given columns with missing counted as zero."""
    parts = [F.coalesce(as_number(c), F.lit(0.0)) for c in cols]
    return reduce(lambda x, y: x + y, parts, F.lit(0.0))


def count_positive(cols: Iterable[Column | str]) -> Column:
    """How many of the columns hold a value above zero."""
    parts = [flag(as_number(c) > 0) for c in cols]
    return reduce(lambda x, y: x + y, parts, F.lit(0))


# ---------------------------------------------------------------- indicators

def flag(cond: Column) -> Column:
    """0/1 integer of a condition; an undecided condition is 0."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def flag_in(c: Column | str, values: Iterable) -> Column:
    return flag(_col(c).isin(list(values)))


def flag_contains(c: Column | str, part: str) -> Column:
    return flag(_col(c).contains(part))


def flag_eq(a: Column | str, b) -> Column:
    return flag(_col(a) == b)


def flag_all(flags: Iterable[Column | str]) -> Column:
    """1 when every flag is 1."""
    return flag(reduce(lambda x, y: x & y, [_col(f) == 1 for f in flags]))


def if_else(cond: Column, yes, no) -> Column:
    """Two-way category; an undecided condition takes ``no``."""
    return F.when(cond, F.lit(yes)).otherwise(F.lit(no))


def between(c: Column | str, low, high) -> Column:
    """Inclusive range test on the numeric reading of a column."""
    return as_number(c).between(low, high)


def _reported(c: Column | str, skip: Sequence[str]) -> Column:
    return _col(c).isNotNull() & ~norm_cat(c).isin(list(skip))


def flag_reported(c: Column | str, skip: Sequence[str] = ("pase",)) -> Column:
    """1 when there is an answer and it is not a skip code."""
    return flag(_reported(c, skip))


def any_reported(cols: Sequence[Column | str], skip: Sequence[str] = SKIP_ANSWERS) -> Column:
    """1 when any of the columns holds an answer; no columns give 0."""
    if not cols:
        return F.lit(0)
    return flag(reduce(lambda x, y: x | y, [F.coalesce(_reported(c, skip), F.lit(False)) for c in cols]))


# ---------------------------------------------------------------- mapping

def map_values(c: Column | str, mapping: Mapping) -> Column:
    """Look a value up in a small dictionary; an unmapped value gives null."""
    if not mapping:
        return F.lit(None)
    table = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))
    return F.try_element_at(table, _col(c))


def label_rules(rules: Sequence[tuple[Column, object]], default) -> Column:
    """First rule whose condition holds gives the label."""
    out = None
    for cond, label in rules:
        value = label if isinstance(label, Column) else F.lit(label)
        out = F.when(cond, value) if out is None else out.when(cond, value)
    tail = default if isinstance(default, Column) else F.lit(default)
    return tail if out is None else out.otherwise(tail)
