"""Data preparation for models: exact splits, imputation, scaling, weights,
over-sampling. Everything learned is learned from the rows given."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import as_number
from ..session import cut_lineage
from .common import attach_scalars, join_keys, long_text, numeric_columns, small_side
from .filters import drop_null_target
from .ordered import _cell_starts, hash_bits, hash_cell, running_before
from .projection import select_existing

# ---------------------------------------------------------------- exact splits

def _class_counts(df: DataFrame, target: str) -> DataFrame:
    """One row per class, missing included: (target, n), written once."""
    return cut_lineage(df.groupBy(target).agg(F.count(F.lit(1)).alias("n")))


def _hash_order(ids: Sequence[str], seed: int) -> Column:
    return F.struct(F.xxhash64(F.lit(seed), *ids).alias("h"), *[F.col(i).alias(f"i{j}") for j, i in enumerate(ids)])


def _cutoffs(df: DataFrame, target: str, ids: Sequence[str], seed: int, wanted: DataFrame, rows: int) -> DataFrame:
    """(target, _rank, _key): the rows at the ``wanted`` (target, _rank) positions
    of the hash order of their class. Only the hash cells that hold a wanted
    position are ranked; they get finer with the number of ``rows``, so that a cell of
    the largest possible class stays small."""
    marked = df.select(target, _hash_order(ids, seed).alias("_key")).withColumn(
        "_cell", hash_cell(F.col("_key.h"), hash_bits(rows)))
    cells = marked.groupBy(target, "_cell").agg(F.count(F.lit(1)).alias("n"))
    placed = _cell_starts(cells, [target], ["n"], descending=False, keep=["n"])
    hit = (F.col("_rank") > F.col("_start_n")) & (F.col("_rank") <= F.col("_start_n") + F.col("n"))
    needed = small_side(join_keys(placed, wanted, [target], "inner").filter(hit).select(target, "_cell", "_start_n", "_rank"))
    inside = Window.partitionBy(target, "_cell", "_rank").orderBy("_key")
    return (join_keys(marked, needed, [target, "_cell"], "inner")
            .withColumn("_pos", F.col("_start_n") + F.row_number().over(inside))
            .filter(F.col("_pos") == F.col("_rank")).select(target, "_rank", "_key"))


def _row_total(counts: DataFrame) -> int:
    return counts.agg(F.sum("n")).first()[0] or 0


def _quotas(counts: DataFrame, target: str, share: float) -> DataFrame:
    """(target, _rank): how many rows of each class make up ``share`` of all rows,
    rounded up over all classes: floors first, the rest to the largest remainders
    (ties by the class as text)."""
    total = _row_total(counts)
    wanted = math.ceil(share * total)
    exact = F.lit(wanted).cast("bigint") * F.col("n") / F.lit(max(total, 1))
    parts = counts.select(target, F.floor(exact).alias("_floor"), (F.floor(exact) - exact).alias("_late"),
                          F.col(target).cast("string").alias("_name"), F.lit(1).cast("bigint").alias("_one"))
    over = wanted - (parts.agg(F.sum("_floor")).first()[0] or 0)
    placed = running_before(parts, ["_late", "_name"], "_one", "_place")
    return placed.select(target, (F.col("_floor") + (F.col("_place") < over).cast("bigint")).alias("_rank"))


def stratified_split(df: DataFrame, target: str, test_size: float, ids: Sequence[str], seed: int = 42,
                     out: str = "is_test") -> DataFrame:
    """Mark an exact stratified hold-out over any number of classes. The test size
    rounds up over all rows; its rows are the first of each class in the order of a
    hash of a unique id. Only cut-off keys are searched; the rows meet the one
    cut-off of their class and are not ranked."""
    counts = _class_counts(df, target)
    quotas = _quotas(counts, target, test_size)
    cuts = _cutoffs(df, target, ids, seed, quotas.filter(F.col("_rank") > 0), _row_total(counts))
    met = join_keys(df, small_side(cuts.select(target, F.col("_key").alias("_cut"))), [target], "left")
    first = (_hash_order(ids, seed) <= F.col("_cut")).cast("int")
    return met.select(*df.columns, F.coalesce(first, F.lit(0)).alias(out))


def stratified_folds(df: DataFrame, target: str, k: int, ids: Sequence[str], seed: int = 42,
                     out: str = "fold") -> DataFrame:
    """Folds 1..k whose sizes per class and in total differ by at most one, over
    any number of classes."""
    # row i of the class-sorted table belongs to fold i mod k; a class ends fold f
    # where its rows of the folds up to f are used up
    counts = _class_counts(df, target)
    placed = running_before(counts, [target], "n", "_offset")
    sizes = [F.floor((F.col("n") - F.pmod(F.lit(f) - F.col("_offset"), F.lit(k)) + k - 1) / k) for f in range(k)]
    ends = F.array(*[reduce(lambda a, b: a + b, sizes[:f + 1]) for f in range(k - 1)]).cast("array<bigint>")
    bounds = placed.select(target, ends.alias("_ends"))
    wanted = bounds.select(target, F.explode(F.array_distinct("_ends")).alias("_rank")).filter(F.col("_rank") > 0)
    cuts = _cutoffs(df, target, ids, seed, wanted, _row_total(counts)).groupBy(target).agg(
        F.map_from_entries(F.collect_list(F.struct("_rank", "_key"))).alias("_cuts"))  # at most k - 1 entries
    met = join_keys(df, small_side(join_keys(bounds, cuts, [target], "left")), [target], "left")
    met = met.withColumn("_k", _hash_order(ids, seed))
    passed = F.filter("_ends", lambda e: (e == 0) | (F.col("_k") > F.try_element_at(F.col("_cuts"), e)))
    return met.select(*df.columns, (F.size(passed) + 1).alias(out))


# ---------------------------------------------------------------- imputation and scaling

def fit_imputers(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> dict[str, object]:
    """Median per numeric and most frequent value (ties: smallest) per text
    column of the training rows."""
    from .stats import medians

    fill: dict[str, object] = dict(medians(train, numeric)) if numeric else {}
    if categorical:
        counts = long_text(train, categorical).filter(F.col("value").isNotNull()).groupBy("variable", "value").agg(
            F.count(F.lit(1)).alias("n"))
        modes = counts.groupBy("variable").agg(F.min(F.struct((-F.col("n")).alias("k"), "value")).alias("m"))
        known = {r["variable"]: r["m"]["value"] for r in modes.collect()}  # one row per column
        fill.update({c: known.get(c, "") for c in categorical})
    return fill


def impute(df: DataFrame, fill: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("string") if isinstance(v, str) else as_number(c), F.lit(v))
                           for c, v in fill.items()})


def standard_scale(df: DataFrame, cols: Sequence[str], with_mean: bool = True, suffix: str = "_scaled") -> DataFrame:
    """(x - mean) / population deviation; a constant column is divided by 1."""
    stats = df.agg(*[f(as_number(c)).alias(f"{p}_{c}") for c in cols
                     for p, f in (("_mu", F.avg), ("_sd", F.stddev_pop))])
    out = attach_scalars(df, stats)
    for c in cols:
        centred = as_number(c) - F.col(f"_mu_{c}") if with_mean else as_number(c)
        out = out.withColumn(c + suffix, centred / F.when(F.col(f"_sd_{c}") == 0, F.lit(1.0)).otherwise(F.col(f"_sd_{c}")))
    return out.drop(*stats.columns)


def min_max_scale(df: DataFrame, col: str, out: str) -> DataFrame:
    """Scores moved to [0, 1] by their minimum and maximum."""
    edges = df.agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    return attach_scalars(df, edges).withColumn(
        out, (F.col(col) - F.col("_lo")) / (F.col("_hi") - F.col("_lo") + F.lit(1e-9))).drop("_lo", "_hi")


# ---------------------------------------------------------------- weights and over-sampling

def positive_weight(df: DataFrame, target: str) -> DataFrame:
    """Negatives per positive; 1 without positives."""
    neg, pos = F.count_if(F.col(target) == 0), F.count_if(F.col(target) == 1)
    return df.agg(F.when(pos == 0, F.lit(1.0)).otherwise(F.try_divide(neg, pos)).alias("positive_weight"))


def class_weights(df: DataFrame, target: str, out: str = "class_weight") -> DataFrame:
    """Balanced weight of every row: rows / (classes · rows of the class), for a
    0/1 target."""
    stats = df.agg(F.count_if(F.col(target) == 0).alias("_n0"), F.count_if(F.col(target) == 1).alias("_n1"))
    total = F.col("_n0") + F.col("_n1")
    weight = F.when(F.col(target) == 1, F.try_divide(total, 2 * F.col("_n1"))).when(
        F.col(target) == 0, F.try_divide(total, 2 * F.col("_n0")))
    return attach_scalars(df, stats).withColumn(out, weight).drop("_n0", "_n1")


def smote(df: DataFrame, target: str, row_id: str, vector: str, k: int = 5, seed: int = 42,
          minority: int = 1) -> DataFrame:
    """Synthetic minority rows until both classes have the same size.

    A synthetic row lies at a hashed fraction of the way from a minority row to
    one of its k nearest minority neighbours. Every minority row makes the same
    number of rows, the first ones in hash order one more. Returns synthetic rows
    only: (row_id of the origin, neighbour_id, fraction, vector, target)."""
    from .neighbours import knn_join

    counts = df.filter(F.col(target).isNotNull()).groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    sizes = counts.agg(F.max("n").alias("largest"), F.sum(F.when(F.col(target) == minority, F.col("n"))).alias("small")).first()
    n_min = sizes["small"] or 0
    missing_rows = (sizes["largest"] or 0) - n_min
    if n_min < 2 or missing_rows == 0:
        return df.limit(0).select(F.col(row_id), F.col(row_id).alias("neighbour_id"), F.lit(0.0).alias("fraction"),
                                  vector, target)
    small = df.filter(F.col(target) == minority).select(row_id, vector)
    near = knn_join(small, row_id, vector, min(k, n_min - 1))
    packed = near.groupBy(F.col("id").alias("_origin")).agg(F.array_sort(F.collect_list(F.struct("rank", "neighbour_id"))).alias("_near"))
    base, extra = divmod(missing_rows, n_min)
    marked = small.withColumn("_one", F.lit(1))
    if extra:
        key = _hash_order([row_id], seed)
        wanted = df.sparkSession.createDataFrame([(1, extra)], "_one int, _rank bigint")
        cut = _cutoffs(marked, "_one", [row_id], seed, wanted, n_min).first()["_key"]
        limit = F.struct(*[F.lit(v).alias(n) for n, v in cut.asDict().items()])
        times = F.lit(base) + (key <= limit).cast("int")
    else:
        times = F.lit(base)
    draws = (marked.join(packed, F.col(row_id) == F.col("_origin")).withColumn("_times", times)
             .filter(F.col("_times") > 0)
             .select(row_id, F.col(vector).alias("_x"), "_near", F.explode(F.sequence(F.lit(1), "_times")).alias("_t"))
             .withColumn("neighbour_id", F.element_at("_near", (F.pmod(
                 F.xxhash64(F.lit(seed + 1), row_id, "_t"), F.size("_near")) + 1).cast("int"))["neighbour_id"])
             .withColumn("fraction", F.pmod(F.xxhash64(F.lit(seed + 2), row_id, "_t"), F.lit(1 << 30)) / float(1 << 30)))
    other = small.select(F.col(row_id).alias("neighbour_id"), F.col(vector).alias("_y"))
    mixed = F.zip_with("_x", "_y", lambda x, y: x + F.col("fraction") * (y - x))
    return draws.join(other, "neighbour_id").select(
        row_id, "neighbour_id", "fraction", mixed.alias(vector), F.lit(minority).cast(df.schema[target].dataType).alias(target))


# ---------------------------------------------------------------- feature sets and X, y

def feature_sets(top: Sequence[str], existing: Sequence[str], leak: Sequence[str],
                 engineered: Sequence[str]) -> dict[str, list[str]]:
    """Named column sets: all selected, without leakage, and each of them with the
    engineered columns."""
    full = [c for c in top if c in existing]
    safe = [c for c in full if c not in set(leak)]
    extra = [c for c in engineered if c in existing]
    return {"full": full, "full_plus_engineered": full + extra, "no_leakage": safe,
            "no_leakage_plus_engineered": safe + extra}


def feature_set_table(features: DataFrame, leak: DataFrame) -> DataFrame:
    """The same sets as a long (feature_set, variable) table. ``features`` has
    (variable, is_engineered); ``leak`` lists leaking variables."""
    safe = features.join(leak.select("variable"), "variable", "left_anti")
    parts = []
    for name, rows in (("full", features), ("no_leakage", safe)):
        parts.append(rows.filter(~F.col("is_engineered")).select(F.lit(name).alias("feature_set"), "variable"))
        # an engineered column is never listed as leakage
        both = rows.filter(~F.col("is_engineered")).select("variable").unionByName(
            features.filter("is_engineered").select("variable"))
        parts.append(both.select(F.lit(f"{name}_plus_engineered").alias("feature_set"), "variable"))
    from .reshape import union_all

    return union_all(parts)


def build_xy(df: DataFrame, features: Sequence[str], target: str, keep: Sequence[str] = ()
             ) -> tuple[DataFrame, DataFrame, list[str], list[str]]:
    """Rows with a valid target, the wanted columns, the drop counts, and the
    split of the features into numeric and other columns."""
    clean, audit = drop_null_target(df, target)
    x = select_existing(clean, [*keep, *features, target])
    numeric_kinds = set(numeric_columns(x)) | {n for n, t in x.dtypes if t == "boolean"}
    numeric = [c for c in features if c in x.columns and c in numeric_kinds]
    other = [c for c in features if c in x.columns and c not in numeric_kinds]
    return x, audit, numeric, other
