"""Filters that report what they did."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import as_number, normalize_text, zfill


def _prefix_condition(col: str, prefix: str, width: int) -> Column:
    """Prefix test on the zero-filled code. The plain ``startswith`` tests in
    front can be pushed to the scan; they hold for every code that matches."""
    exact = zfill(col, width).startswith(prefix)
    zeros = len(prefix) - len(prefix.lstrip("0"))
    starts = [prefix[i:] for i in range(zeros + 1)]
    if "" in starts:
        return exact
    text = F.col(col).cast("string")
    return reduce(lambda a, b: a | b, [text.startswith(s) for s in starts]) & exact


def filter_prefix(df: DataFrame, col: str, prefix: str, table: str = "",
                  width: int = 6) -> tuple[DataFrame, DataFrame]:
    """Keep the rows of one region and report rows before, rows after and the
    region codes left. A table without the column passes unchanged."""
    size = len(prefix)
    if col not in df.columns:
        audit = df.agg(F.count(F.lit(1)).alias("before_rows")).select(
            F.lit(table).alias("table_name"), F.lit(False).alias("has_code"), "before_rows",
            F.col("before_rows").alias("after_rows"), F.array().cast("array<string>").alias("codes_left"))
        return df, audit
    cond = _prefix_condition(col, prefix, width)
    kept = df.filter(cond).withColumn(col, zfill(col, width))
    audit = df.agg(
        F.count(F.lit(1)).alias("before_rows"), F.count_if(cond).alias("after_rows"),
        F.array_sort(F.collect_set(F.when(cond, F.substring(zfill(col, width), 1, size)))).alias("codes_left"),
    ).select(F.lit(table).alias("table_name"), F.lit(True).alias("has_code"),
             "before_rows", "after_rows", "codes_left")
    return kept, audit


def filter_all(tables: Mapping[str, DataFrame], col: str, prefix: str,
               width: int = 6) -> tuple[dict[str, DataFrame], DataFrame]:
    """The prefix filter over every table; the audit adds, per table, whether
    all rows left carry the wanted prefix."""
    done = {name: filter_prefix(df, col, prefix, name, width) for name, df in tables.items()}
    audit = reduce(DataFrame.unionByName, [a for _, a in done.values()])
    ok = ~F.col("has_code") | (F.col("codes_left") == F.array(F.lit(prefix)))
    return {n: d for n, (d, _) in done.items()}, audit.withColumn("all_match", ok)


def filter_catalog(df: DataFrame, contains: Mapping[str, str] | None = None,
                   not_contains: Mapping[str, str] | None = None, equals: Mapping[str, str] | None = None,
                   code: tuple[str, Sequence[str]] | None = None) -> DataFrame:
    """Compound text predicates on normalised text."""
    conds = [normalize_text(c).contains(s) for c, s in (contains or {}).items()]
    conds += [~normalize_text(c).contains(s) for c, s in (not_contains or {}).items()]
    conds += [F.col(c).cast("string") == s for c, s in (equals or {}).items()]
    if code:
        conds.append(F.col(code[0]).cast("string").isin(list(code[1])))
    return df.filter(reduce(lambda a, b: a & b, conds)) if conds else df


def drop_null_target(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """Keep the rows with a numeric target, cast to integer, and count the rest."""
    value = as_number(target)
    audit = df.agg(F.count(F.lit(1)).alias("rows_before"), F.count_if(F.col(target).isNull()).alias("null_targets"),
                   F.count_if(F.col(target).isNotNull() & value.isNull()).alias("unreadable_targets"),
                   F.count(value).alias("rows_after"))
    return df.filter(value.isNotNull()).withColumn(target, value.cast("int")), audit


def semi_keep(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in another table."""
    return df.join(keys.select(*on), list(on), "left_semi")


def metric_floor(df: DataFrame, metric: str, floor: float) -> DataFrame:
    return df.filter(F.col(metric) >= floor)
