"""Profiles, summaries and distributions of a table.

Per-column statistics come from one wide aggregate; per-value statistics from one
long (variable, value) count, which combines on the map side, so a value that
fills a third of the table costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import as_number
from ..session import ship_by_value
from .common import (
    attach_scalars,
    by_chunks,
    explode_stats,
    long_numeric,
    long_text,
    missing,
    numeric_columns,
    present_only,
    small_side,
)
from .ordered import exact_quantiles

ship_by_value(__name__)

NULL_LABEL = "<NA>"


def _pct(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(part * 100.0, whole), 4)


# ---------------------------------------------------------------- counts

def group_count(df: DataFrame, keys: Sequence[str], out: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def distinct_count_by(df: DataFrame, unit: Sequence[str], keys: Sequence[str], out: str = "n_units") -> DataFrame:
    """Distinct units, then their count per group."""
    return df.select(*unit, *keys).distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def nunique_by(df: DataFrame, keys: Sequence[str], col: str, out: str = "n_unique") -> DataFrame:
    return df.groupBy(*keys).agg(F.count_distinct(col).alias(out))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per value, missing included, with percent of the total."""
    counts = df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    return attach_scalars(counts, total).select("value", "n", _pct(F.col("n"), F.col("_total")).alias("pct"))


def top_categories(df: DataFrame, col: str, n: int, null_label: str = NULL_LABEL) -> DataFrame:
    """Largest categories; missing counts as its own."""
    return (df.groupBy(F.coalesce(F.col(col).cast("string"), F.lit(null_label)).alias("category"))
            .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "category").limit(n))


def rate_by_category(df: DataFrame, col: str, target: str, n: int) -> DataFrame:
    """Size and target rate of the largest categories."""
    return (df.filter(F.col(col).isNotNull() & F.col(target).isNotNull())
            .groupBy(F.col(col).cast("string").alias("category"))
            .agg(F.count(F.lit(1)).alias("n"), F.avg(target).alias("rate"))
            .orderBy(F.desc("n"), "category").limit(n))


def class_distribution(df: DataFrame, target: str) -> DataFrame:
    """Rows, positives, negatives and positive rate in one row."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(target) == 1).alias("positives"),
                  F.count_if(F.col(target) == 0).alias("negatives")).withColumn(
        "positive_rate", F.try_divide(F.col("positives"), F.col("n_rows")))


def having_zero(df: DataFrame, key: str, col: str) -> DataFrame:
    """Groups whose sum is zero."""
    return df.groupBy(key).agg(F.sum(col).alias("total")).filter(F.col("total") == 0)


def mean_by(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in cols])


def max_by_keys(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.max(c).alias(c) for c in cols])


# ---------------------------------------------------------------- whole-table profiles

def _value_counts_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return long_text(present_only(df, cols), cols).groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n"))


def profile_columns(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Type, missing count and percent, and exact distinct count per column."""
    cols = list(cols or df.columns)
    kinds = dict(df.dtypes)
    table = F.create_map(*[F.lit(x) for c in cols for x in (c, kinds[c])])
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "variable string")
    counts = _value_counts_long(df, cols).groupBy("variable").agg(
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("null_count"),
        F.count("value").alias("n_unique"), F.sum("n").alias("_total"))
    # an empty table still has its columns
    listed = names.join(F.broadcast(counts), "variable", "left").na.fill(0, ["null_count", "n_unique", "_total"])
    pct = F.coalesce(_pct(F.col("null_count"), F.col("_total")), F.lit(0.0))
    return listed.select("variable", F.element_at(table, F.col("variable")).alias("dtype"), "null_count",
                         pct.alias("null_pct"), "n_unique")


def top_missing(profile: DataFrame, n: int = 25) -> DataFrame:
    """Columns with the highest missing percent."""
    return profile.orderBy(F.desc("null_pct"), "variable").limit(n)


def null_percent(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Missing percent per column from wide aggregates."""
    kinds = dict(df.dtypes)

    def part(some: Sequence[str]) -> DataFrame:
        wide = df.agg(F.count(F.lit(1)).alias("_total"), *[
            F.count_if(missing(c, kinds[c])).alias(f"m_{i}") for i, c in enumerate(some)])
        return explode_stats(wide, [
            {"variable": F.lit(c), "null_pct": F.coalesce(_pct(F.col(f"m_{i}"), F.col("_total")), F.lit(0.0))}
            for i, c in enumerate(some)])

    return by_chunks(list(cols or df.columns), part)


def column_shapes(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per column: present rows, all rows, whether it is constant (missing counts
    as a value), and whether its present values all lie in {0, 1}. Constants are
    found by comparing minimum and maximum, without counting distinct values."""
    kinds, numbers = dict(df.dtypes), set(numeric_columns(df))

    def part(some: Sequence[str]) -> DataFrame:
        aggs, entries = [F.count(F.lit(1)).alias("_total")], []
        for i, c in enumerate(some):
            value = F.when(~missing(c, kinds[c]), F.col(f"`{c}`"))
            if kinds[c].startswith(("struct", "array", "map")):
                value = F.to_json(value)
            off = (~as_number(c).isin(0.0, 1.0) if c in numbers
                   else F.lit(False) if kinds[c] == "boolean" else F.lit(True))
            aggs += [F.count(value).alias(f"k_{i}"), F.min(value).alias(f"a_{i}"), F.max(value).alias(f"b_{i}"),
                     F.count_if(value.isNotNull() & off).alias(f"o_{i}")]
            k, t = F.col(f"k_{i}"), F.col("_total")
            entries.append({"variable": F.lit(c), "dtype": F.lit(kinds[c]), "present": k, "total": t,
                            "is_constant": (k == 0) | ((k == t) & (F.col(f"a_{i}") == F.col(f"b_{i}"))),
                            "is_binary": F.col(f"o_{i}") == 0})
        return explode_stats(df.agg(*aggs), entries)

    return by_chunks(list(cols or df.columns), part)


def numeric_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, missing percent, mean, sample deviation, minimum, exact quartiles
    and maximum per column."""
    measures = (("n", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))

    def part(some: Sequence[str]) -> DataFrame:
        wide = df.agg(F.count(F.lit(1)).alias("_total"), *[
            f(as_number(c)).alias(f"{name}_{i}") for i, c in enumerate(some) for name, f in measures])
        return explode_stats(wide, [
            {"variable": F.lit(c), "count": F.col(f"n_{i}"),
             "missing_pct": _pct(F.col("_total") - F.col(f"n_{i}"), F.col("_total")),
             "mean": F.col(f"mean_{i}"), "std": F.col(f"std_{i}"),
             "min": F.col(f"min_{i}"), "max": F.col(f"max_{i}")} for i, c in enumerate(some)])

    moments = by_chunks(list(cols), part)
    quart = exact_quantiles(long_numeric(df, cols), ["variable"], "value", {"p25": .25, "median": .5, "p75": .75})
    return moments.join(quart, "variable", "left").select(
        "variable", "count", "missing_pct", "mean", "std", "min", "p25", "median", "p75", "max")


def numeric_by_target(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Count, mean, median, deviation, minimum and maximum per column and class."""
    long = long_numeric(df, cols, [target]).filter(F.col(target).isNotNull())
    stats = long.groupBy("variable", target).agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    med = exact_quantiles(long, ["variable", target], "value", {"median": .5})
    return stats.join(med, ["variable", target], "left").select(
        "variable", F.col(target).alias("target"), "count", "mean", "median", "std", "min", "max")


def categorical_summary(df: DataFrame, cols: Sequence[str], rare: int = 10) -> DataFrame:
    """Categories, missing percent, top category and its size, rare categories."""
    counts = _value_counts_long(df, cols)
    first = F.min(F.struct((-F.col("n")).alias("k"), F.coalesce("value", F.lit(NULL_LABEL)).alias("v")))
    out = counts.groupBy("variable").agg(
        F.count(F.lit(1)).alias("n_categories"), first.alias("_top"),
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("_null"), F.sum("n").alias("_total"),
        F.count_if(F.col("n") < rare).alias("rare_categories"))
    return out.select("variable", "n_categories", _pct(F.col("_null"), F.col("_total")).alias("missing_pct"),
                      F.col("_top.v").alias("top_category"), (-F.col("_top.k")).alias("top_n"), "rare_categories")


def rare_categories(df: DataFrame, cols: Sequence[str], below: int = 10, first: int = 10) -> DataFrame:
    """The first few categories seen fewer than ``below`` times, largest first."""
    counts = _value_counts_long(df, cols).filter(F.col("n") < below).withColumn(
        "value", F.coalesce("value", F.lit(NULL_LABEL)))
    order = Window.partitionBy("variable").orderBy(F.desc("n"), "value")
    kept = counts.withColumn("_i", F.row_number().over(order)).filter(F.col("_i") <= first)
    listed = F.array_sort(F.collect_list(F.struct("_i", "value")))
    return kept.groupBy("variable").agg(F.transform(listed, lambda s: s["value"]).alias("rare_categories"))


def distribution_report(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Quartiles of numeric columns and rare categories of text columns."""
    nulls = null_percent(df, [*numeric, *categorical])
    num = numeric_summary(df, numeric).select(
        "variable", F.lit("numeric").alias("kind"), "min", "p25", F.col("median").alias("p50"), "p75", "max")
    cat = nulls.filter(F.col("variable").isin(list(categorical))).select(
        "variable", F.lit("categorical").alias("kind")).join(rare_categories(df, categorical), "variable", "left")
    both = num.unionByName(cat, allowMissingColumns=True)
    return nulls.join(both, "variable").select("variable", "kind", "null_pct", "min", "p25", "p50", "p75", "max",
                                               F.to_json("rare_categories").alias("rare_categories"))


def iqr_outliers(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """Bounds of k interquartile ranges, and the rows outside of them."""
    long = long_numeric(df, cols)
    quart = exact_quantiles(long, ["variable"], "value", {"q1": .25, "q3": .75})
    bounds = small_side(quart.select(
        "variable", (F.col("q1") - k * (F.col("q3") - F.col("q1"))).alias("lower_iqr"),
        (F.col("q3") + k * (F.col("q3") - F.col("q1"))).alias("upper_iqr")))
    out = (F.col("value") < F.col("lower_iqr")) | (F.col("value") > F.col("upper_iqr"))
    counts = long.join(bounds, "variable", "left").groupBy("variable", "lower_iqr", "upper_iqr").agg(
        F.count_if(out).alias("outlier_count"), F.count(F.lit(1)).alias("_total"))
    return counts.select("variable", "lower_iqr", "upper_iqr", "outlier_count",
                         _pct(F.col("outlier_count"), F.col("_total")).alias("outlier_pct"))


def crosstab_by_target(df: DataFrame, cols: Sequence[str], target: str, classes: Sequence[int] = (0, 1),
                       normalize: str = "columns") -> DataFrame:
    """Share of each category, within the class (``columns``) or within the
    category (``index``)."""
    long = long_text(df, cols, [target]).filter(F.col(target).isin(list(classes)))
    counts = long.groupBy("variable", F.coalesce("value", F.lit(NULL_LABEL)).alias("category")).agg(
        *[F.count_if(F.col(target) == c).alias(f"n_{c}") for c in classes])
    if normalize == "columns":
        counts = attach_scalars(counts, df.agg(*[F.count_if(F.col(target) == c).alias(f"t_{c}") for c in classes]))
    else:
        whole = reduce(lambda a, b: a + b, [F.col(f"n_{c}") for c in classes])
        counts = counts.withColumns({f"t_{c}": whole for c in classes})
    return counts.select("variable", "category", *[
        F.try_divide(F.col(f"n_{c}"), F.col(f"t_{c}")).alias(f"pct_target_{c}") for c in classes])


# ---------------------------------------------------------------- correlation

def _pair_corr(x: Column, y: Column) -> Column:
    """Pearson correlation over the rows where both are present; null when either
    side is constant there."""
    return F.try_divide(F.regr_sxy(y, x), F.sqrt(F.regr_sxx(y, x)) * F.sqrt(F.regr_syy(y, x)))


def target_corr(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Absolute correlation with the target, one pass over the table."""
    y = as_number(target)

    def part(some: Sequence[str]) -> DataFrame:
        wide = df.agg(*[F.abs(_pair_corr(as_number(c), y)).alias(f"r_{i}") for i, c in enumerate(some)])
        return explode_stats(wide, [{"variable": F.lit(c), "abs_corr_target": F.col(f"r_{i}")}
                                    for i, c in enumerate(some)])

    return by_chunks(list(cols), part).orderBy(F.desc_nulls_last("abs_corr_target"), "variable")


def _pair_moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise-complete moments of many columns: every task multiplies its
    Arrow batches and emits one partial row per pair; Spark sums the partials."""
    p = len(cols)
    numbers = df.select(*[as_number(c).alias(c) for c in cols])
    means = [m or 0.0 for m in numbers.agg(*[F.avg(c) for c in cols]).first()]
    ia, ib = np.triu_indices(p, 1)

    def partial(batches):
        acc = np.zeros((6, p, p))
        for batch in batches:
            x = batch.to_numpy(dtype=float, na_value=np.nan) - np.asarray(means)
            have = ~np.isnan(x)
            z, m = np.where(have, x, 0.0), have.astype(float)
            acc += np.stack([m.T @ m, z.T @ m, m.T @ z, (z * z).T @ m, m.T @ (z * z), z.T @ z])
        yield pd.DataFrame({"a": ia, "b": ib, **{k: acc[j][ia, ib] for j, k in enumerate(
            ("n", "sa", "sb", "saa", "sbb", "sab"))}})

    schema = "a int, b int, n double, sa double, sb double, saa double, sbb double, sab double"
    total = numbers.mapInPandas(partial, schema).groupBy("a", "b").agg(
        *[F.sum(k).alias(k) for k in ("n", "sa", "sb", "saa", "sbb", "sab")])
    va = F.col("saa") - F.col("sa") * F.col("sa") / F.col("n")
    vb = F.col("sbb") - F.col("sb") * F.col("sb") / F.col("n")
    cov = F.col("sab") - F.col("sa") * F.col("sb") / F.col("n")
    tiny = 1e-12  # centred sums of a constant column differ from zero by rounding only
    varies = (F.col("n") > 1) & (va > tiny * F.col("saa")) & (vb > tiny * F.col("sbb"))
    names = F.array(*[F.lit(c) for c in cols])
    return total.filter(F.col("n") > 0).select(names[F.col("a")].alias("col_a"), names[F.col("b")].alias("col_b"),
                        F.when(varies, cov / (F.sqrt(va) * F.sqrt(vb))).alias("corr"))


def corr_pairs(df: DataFrame, cols: Sequence[str], at_least: float) -> DataFrame:
    """Column pairs with a correlation of at least ``at_least`` in size, from one
    pass for the means and one for the moments, however many columns there are."""
    pairs = _pair_moments(df, cols)
    return pairs.withColumn("abs_corr", F.abs("corr")).filter(F.col("abs_corr") >= at_least)


# ---------------------------------------------------------------- rows, bins, errors

def missing_by_row(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Missing cells of every row, as a count and as a percent of the columns."""
    count = reduce(lambda a, b: a + b, [missing(c, k).cast("int") for c, k in df.dtypes])
    return df.select(*keep, count.alias("missing_cols"),
                     F.round(count * 100.0 / len(df.columns), 4).alias("missing_pct"))


def rows_with_missing(df: DataFrame) -> DataFrame:
    """Rows, rows with any missing cell, and rows without."""
    some = reduce(lambda a, b: a | b, [missing(c, k) for c, k in df.dtypes])
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(some).alias("with_missing"),
                  F.count_if(~some).alias("without_missing"))


def histogram(df: DataFrame, col: str, target: str, bins: int = 25) -> DataFrame:
    """Rows per equal-width bin and class; the maximum falls in the last bin."""
    x = as_number(col)
    base = df.filter(x.isNotNull() & F.col(target).isNotNull()).select(x.alias("_x"), F.col(target).alias("target"))
    edges = base.agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    number = F.least(F.coalesce(F.floor(F.try_divide(F.col("_x") - F.col("_lo"), width)), F.lit(0)),
                     F.lit(bins - 1)).cast("int")
    return (attach_scalars(base, edges).groupBy((number + 1).alias("bin"), "target", "_lo", width.alias("_w"))
            .agg(F.count(F.lit(1)).alias("n"))
            .select("bin", "target", (F.col("_lo") + (F.col("bin") - 1) * F.col("_w")).alias("bin_start"),
                    (F.col("_lo") + F.col("bin") * F.col("_w")).alias("bin_end"), "n"))


def error_profile(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], top: int = 8) -> DataFrame:
    """What a set of error rows looks like: the largest numeric means and the
    most frequent value (ties: smallest) of the first categorical columns."""
    wide = df.agg(*[F.avg(as_number(c)).alias(f"m_{i}") for i, c in enumerate(numeric)])
    means = explode_stats(wide, [{"variable": F.lit(c), "mean": F.round(F.col(f"m_{i}"), 4)}
                                 for i, c in enumerate(numeric)])
    best = means.filter(F.col("mean").isNotNull()).orderBy(F.desc("mean"), "variable").limit(top).select(
        F.lit("numeric_mean").alias("kind"), "variable", "mean", F.lit(None).cast("string").alias("mode"))
    if not categorical:
        return best
    counts = _value_counts_long(df, list(categorical)[:top]).filter(F.col("value").isNotNull())
    modes = counts.groupBy("variable").agg(F.min(F.struct((-F.col("n")).alias("k"), "value")).alias("_m"))
    return best.unionByName(modes.select(
        F.lit("categorical_mode").alias("kind"), "variable", F.lit(None).cast("double").alias("mean"),
        F.col("_m.value").alias("mode")))
