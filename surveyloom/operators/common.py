"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

# Rows a side table may have before it is joined by shuffling instead of broadcasting.
BROADCAST_ROWS = 50_000


def attach_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row aggregate to every row of ``df``.

    The aggregate becomes a scalar subquery: it runs once and its values are
    constants in the scan of ``df``, so nothing is joined.
    """
    names = one_row.columns
    packed = one_row.select(F.struct(*names).alias("_s"))
    return df.withColumn("_s", packed.scalar()).select(
        *[F.col(c) for c in df.columns], *[F.col(f"_s.{n}").alias(n) for n in names])


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Run an aggregate that should be small and fix its rows in the plan, marked
    for broadcast. One that turns out to hold more than ``max_rows`` rows is
    checkpointed instead and joins by shuffle."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return cut_lineage(df)
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join where two missing keys are equal, keeping the left key columns."""
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                           *[c for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys])
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])


def missing(name: str, kind: str) -> Column:
    """True for null, and for NaN in a column of a floating type."""
    col = F.col(f"`{name}`")
    return col.isNull() | F.isnan(col) if kind in ("double", "float") else col.isNull()


def present_only(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The columns with NaN replaced by null and -0.0 by 0.0."""
    kinds = dict(df.dtypes)

    def plain(c: str) -> Column:
        col = F.col(f"`{c}`")
        return (col + F.lit(0.0)).cast(kinds[c]) if kinds[c] in ("double", "float") else col

    return df.select(*[F.when(~missing(c, kinds[c]), plain(c)).alias(c) for c in cols])


def by_chunks(cols: Sequence[str], build: Callable[[Sequence[str]], DataFrame], size: int = 100) -> DataFrame:
    """Union of a wide per-column aggregate taken over groups of columns. A
    columnar scan reads each column once either way, and the generated code of
    one aggregate stays small on tables with many hundred columns."""
    parts = [build(cols[i:i + size]) for i in range(0, len(cols), size)]
    return reduce(DataFrame.unionByName, parts)


def numeric_columns(df: DataFrame) -> list[str]:
    kinds = ("tinyint", "smallint", "int", "bigint", "float", "double")
    return [n for n, t in df.dtypes if t in kinds or t.startswith("decimal")]


def text_columns(df: DataFrame) -> list[str]:
    return [n for n, t in df.dtypes if t in ("string", "boolean") or t.startswith(("varchar", "char"))]


def long_numeric(df: DataFrame, cols: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """(ids…, variable, value) with the numeric reading of every column."""
    from ..functions import as_number

    picked = df.select(*[F.col(i) for i in ids], *[as_number(c).alias(c) for c in cols])
    return picked.unpivot(list(ids), list(cols), "variable", "value")


def long_text(df: DataFrame, cols: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """(ids…, variable, value) with every column as text."""
    picked = df.select(*[F.col(i) for i in ids], *[F.col(c).cast("string").alias(c) for c in cols])
    return picked.unpivot(list(ids), list(cols), "variable", "value")


def explode_stats(one_row: DataFrame, entries: Sequence[dict[str, Column]]) -> DataFrame:
    """Turn a one-row wide aggregate into one row per entry."""
    structs = [F.struct(*[v.alias(k) for k, v in e.items()]) for e in entries]
    return one_row.select(F.explode(F.array(*structs)).alias("_e")).select("_e.*")
