"""Left equi-joins with checks. Keys are never missing in a valid table, so the
joins use plain equality: a chain of joins on one key keeps one partitioning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import explode_stats
from .quality import ensure_unique


def left_join(a: DataFrame, b: DataFrame, key: Sequence[str]) -> DataFrame:
    return a.join(b, list(key), "left")


def _new_columns(base: DataFrame, addon: DataFrame, key: Sequence[str]) -> list[str]:
    return [c for c in addon.columns if c not in key and c not in base.columns]


def _merge_audit(base: DataFrame, steps: Sequence[tuple[str, DataFrame, Sequence[str]]], key: Sequence[str]) -> DataFrame:
    """One row per (name, add-on, new columns), from the number of rows each table
    has per key: a left join multiplies the rows of a key by those of the add-on.
    Only keys and counts are joined, once per add-on; the merged tables are not run."""
    n = F.count(F.lit(1))
    sizes = base.groupBy(*key).agg(n.alias("_n0"))
    for i, (_, addon, _) in enumerate(steps, 1):
        sizes = left_join(sizes, addon.groupBy(*key).agg(n.alias(f"_a{i}")), key)
        sizes = sizes.withColumn(f"_n{i}", F.col(f"_n{i - 1}") * F.coalesce(f"_a{i}", F.lit(1)))
    every = range(len(steps) + 1)
    totals = sizes.agg(*[F.coalesce(F.sum(f"_n{i}"), F.lit(0)).alias(f"rows_{i}") for i in every],
                       *[F.coalesce(F.sum(F.col(f"_n{i}") - 1), F.lit(0)).alias(f"surplus_{i}") for i in every])
    totals = totals.select("*", *[addon.agg(n).scalar().alias(f"addon_{i}") for i, (_, addon, _) in enumerate(steps, 1)])
    return explode_stats(totals, [{
        "merge_name": F.lit(name), "base_rows_before": F.col(f"rows_{i - 1}"), "addon_rows": F.col(f"addon_{i}"),
        "rows_after_merge": F.col(f"rows_{i}"), "duplicated_after_merge": F.col(f"surplus_{i}"),
        "new_columns_added": F.lit("|".join(added))} for i, (name, _, added) in enumerate(steps, 1)])


def merge_with_audit(base: DataFrame, addon: DataFrame, key: Sequence[str], name: str,
                     check: bool = True) -> tuple[DataFrame, DataFrame]:
    """One-to-one left join. Columns the base already has are dropped from the
    add-on; one audit row is returned. A repeated key on either side fails when
    the merged table runs."""
    return merge_all(base, {name: addon}, key, check, f"base of {name}")


def merge_all(base: DataFrame, addons: Mapping[str, DataFrame], key: Sequence[str], check: bool = True,
              base_name: str = "base") -> tuple[DataFrame, DataFrame]:
    """Fold of the one-to-one left join over named add-ons, with one audit row each."""
    key, steps = list(key), []
    merged = ensure_unique(base, key, base_name) if check else base
    for name, addon in addons.items():
        added = _new_columns(merged, addon, key)
        addon = addon.select(*key, *added)
        steps.append((name, addon, added))
        merged = left_join(merged, ensure_unique(addon, key, name) if check else addon, key)
    return merged, _merge_audit(base, steps, key)


def mark_exists(df: DataFrame, keys: DataFrame, on: Sequence[str], flag: str) -> DataFrame:
    """1 when the key occurs on the right, else 0; rows are never multiplied."""
    marks = keys.select(*on).distinct().withColumn(flag, F.lit(1))
    return df.join(marks, list(on), "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(0)))


def attach_metadata(df: DataFrame, meta: DataFrame, on: str, defaults: Mapping[str, object]) -> DataFrame:
    """Join a metadata table and fill what it does not know with defaults. A key
    listed twice gives the smallest value of each column; rows are never multiplied."""
    side = meta.groupBy(on).agg(*[F.min(c).alias(c) for c in defaults])
    joined = df.join(side, on, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def lookup_first(df: DataFrame, sources: Sequence[tuple[DataFrame, str, str, str]], out: str,
                 default: Column) -> DataFrame:
    """Value from the first source that has the key. A source is (table, its key
    column, its value column, the key column of ``df``); a key listed twice in a
    source gives its smallest value."""
    found = []
    for i, (table, key, value, own) in enumerate(sources):
        side = table.groupBy(F.col(key).alias(own)).agg(F.min(value).alias(f"_v{i}"))
        df = df.join(side, own, "left")
        found.append(f"_v{i}")
    return df.withColumn(out, F.coalesce(*[F.col(f) for f in found], default)).drop(*found)


def missing_from(expected: DataFrame, actual: DataFrame, on: Sequence[str]) -> DataFrame:
    """Expected keys that do not occur."""
    return expected.join(actual.select(*on), list(on), "left_anti")


def align_series(series: Mapping[str, DataFrame], key: str, value: str) -> DataFrame:
    """Several keyed series side by side, gaps filled with zero."""
    parts = [df.select(F.lit(name).alias("_name"), F.col(key), F.col(value).cast("double").alias("_value"))
             for name, df in series.items()]
    long = reduce(DataFrame.unionByName, parts)
    return long.groupBy(key).pivot("_name", list(series)).agg(F.sum("_value")).na.fill(0.0)
