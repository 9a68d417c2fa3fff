"""Order-dependent operators that never sort a whole group in one task.

Ranks and running sums work in *slots*: rows are dealt by ranges of (group, value), whose
bounds Spark samples from the rows themselves, so that slots are about equally large
whatever the values look like (epoch seconds, names with one prefix, one large class). A
slot is sorted alone; its start is a sum over the small table of slots.

Exact quantiles work in *cells*: monotone functions of the value whose rows are counted
with a map-side combine. Only cells that hold a wanted rank are looked into, and one that
is still too large is cut again between its own smallest and largest value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import attach_scalars, missing, small_side

CELLS_PER_OCTAVE = 512
CELL_ROWS = 1 << 20   # rows of a cell that are sorted together
_LIFT = 600_000  # above the exponent range of a double times the cells per octave
_INF_CELL, _NAN_CELL = 2**60, 2**61


def value_cell(c: Column) -> Column:
    """Monotone cell number of a number: 512 cells per power of two. Infinities
    and NaN, the largest value in Spark's order, have end cells of their own."""
    x = c.cast("double")
    size = F.floor(F.log2(F.abs(x)) * CELLS_PER_OCTAVE) + _LIFT
    return (F.when(x == 0, F.lit(0)).when(F.isnan(x), F.lit(_NAN_CELL))
            .when(F.abs(x) == float("inf"), F.when(x > 0, F.lit(_INF_CELL)).otherwise(F.lit(-_INF_CELL)))
            .otherwise((F.signum(x) * size).cast("bigint"))).cast("bigint")


def hash_cell(h: Column, bits: int = 12) -> Column:
    """Monotone cell number of a 64-bit hash: its leading bits."""
    return F.shiftright(h, 64 - bits)


def hash_bits(rows: int) -> int:
    """Leading bits for which a hash cell of so many rows holds about ``CELL_ROWS`` / 16."""
    return min(40, max(12, (16 * rows // CELL_ROWS).bit_length()))


def _cell_starts(cells: DataFrame, by: Sequence[str], measures: Sequence[str], descending: bool,
                 keep: Sequence[str] = ()) -> DataFrame:
    """Running total of each measure over the cells before this one."""
    order = F.col("_cell").desc() if descending else F.col("_cell").asc()
    before = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return cells.select(*by, "_cell", *keep, *[
        F.coalesce(F.sum(m).over(before), F.lit(0)).alias(f"_start_{m}") for m in measures])


# ---------------------------------------------------------------- slots

def known(df: DataFrame, value: str) -> Column:
    """Whether a value is there; NaN counts as missing."""
    return ~missing(value, dict(df.dtypes)[value])


def slotted(df: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """``df`` dealt by ranges of (by, order) and written once, with the number of the range
    and the key ``_key`` of its group inside the range. A struct key also matches groups
    whose own key is missing."""
    dealt = cut_lineage(df.repartitionByRange(*by, *order).withColumn("_slot", F.spark_partition_id()))
    return dealt.withColumn("_key", F.struct("_slot", *by))


def slot_starts(sums: DataFrame, by: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Sums per ``_key`` become the totals of the group's slots before this one."""
    group = [F.col(f"_key.`{b}`") for b in by] or [F.lit(1)]
    before = Window.partitionBy(*group).orderBy("_key._slot").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("*", *[F.coalesce(F.sum(m).over(before), F.lit(0)).alias(f"_start_{m}") for m in measures])


def running_totals(df: DataFrame, by: Sequence[str], value: str, measures: Mapping[str, Column],
                   descending: bool = True) -> DataFrame:
    """One row per distinct ``value`` with each measure and its running sum
    (``cum_<measure>``, this value included) in value order. Missing values and NaN have
    no place in the order and are left out."""
    by, names = list(by), list(measures)
    order = F.col(value).desc() if descending else F.col(value).asc()
    per_value = df.filter(known(df, value)).groupBy(*by, value).agg(*[m.alias(k) for k, m in measures.items()])
    dealt = slotted(per_value, by, [order])
    starts = slot_starts(dealt.groupBy("_key").agg(*[F.sum(k).alias(k) for k in names]), by, names).drop(*names)
    inside = Window.partitionBy("_key").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return dealt.join(starts, "_key").select(*by, value, *names, *[
        (F.col(f"_start_{k}") + F.sum(k).over(inside)).alias(f"cum_{k}") for k in names])


def running_before(df: DataFrame, order: Sequence[str], measure: str, out: str) -> DataFrame:
    """The total of ``measure`` over all rows before each row, in an order that has
    no ties. Rows are dealt by range and summed inside their range; only one total
    per range is put in order in one place."""
    ranged = cut_lineage(df.repartitionByRange(*order).withColumn("_slot", F.spark_partition_id()))
    totals = ranged.groupBy("_slot").agg(F.sum(measure).alias("_n"))
    ranges = Window.partitionBy(F.lit(1)).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("_slot", F.coalesce(F.sum("_n").over(ranges), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_slot").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum(measure).over(inside), F.lit(0))
    return ranged.join(starts, "_slot").withColumn(out, F.col("_start") + within).select(*df.columns, out)


def rank_min(df: DataFrame, col: str, out: str, by: Sequence[str] = (), descending: bool = True) -> DataFrame:
    """Rank where ties share the smallest position; missing values and NaN get none.

    Rows are dealt by (value, hash of the row), so a frequent value is spread over as many
    ranges as it fills. Inside a range a row has its rank there plus the range's start;
    only rows of the value that a range begins with may take their rank from an earlier
    one, the first in which that value is the last."""
    by, there = list(by), known(df, col)
    order = F.col(col).desc() if descending else F.col(col).asc()
    spread = F.xxhash64(*[c for c, t in df.dtypes if "map<" not in t and t != "variant"])
    dealt = slotted(df.filter(there), by, [order, spread])
    placed = dealt.withColumn("_rank", F.rank().over(Window.partitionBy("_key").orderBy(order)))
    first, last = (F.max, F.min) if descending else (F.min, F.max)
    ends = placed.groupBy("_key").agg(F.count(F.lit(1)).alias("n"), F.max("_rank").alias("_late"),
                                      first(col).alias("_first"), last(col).alias("_last"))
    ends = slot_starts(ends, by, ["n"])
    # where the run of a value begins that ends one range and goes on in the next
    runs = ends.groupBy(*[F.col(f"_key.`{b}`").alias(f"_r_{b}") for b in by], F.col("_last").alias("_value")).agg(
        F.min(F.col("_start_n") + F.col("_late")).alias("_run"))
    same = F.col("_first") == F.col("_value")
    for b in by:
        same = same & F.col(f"_key.`{b}`").eqNullSafe(F.col(f"_r_{b}"))
    starts = ends.join(runs, same, "left").select("_key", "_start_n", "_first", "_run")
    rank = F.when(F.col(col) == F.col("_first"), F.coalesce("_run", F.col("_start_n") + 1)).otherwise(
        F.col("_start_n") + F.col("_rank"))
    ranked = placed.join(starts, "_key").select(*df.columns, rank.alias(out))
    return ranked.unionByName(df.filter(~there).withColumn(out, F.lit(None).cast("bigint")))


def mean_rank(df: DataFrame, first: str, second: str, out: str = "mean_rank") -> DataFrame:
    """Average of the two descending ranks."""
    ranked = rank_min(rank_min(df, first, f"rank_{first}"), second, f"rank_{second}")
    return ranked.withColumn(out, (F.col(f"rank_{first}") + F.col(f"rank_{second}")) / 2)


def hashed_position(df: DataFrame, by: Sequence[str], unique_id: Sequence[str], seed: int, out: str) -> DataFrame:
    """Position 1..n of every row inside its group, in the order of a seeded
    hash of a unique id: exact, and the same on every run and partitioning."""
    by, order = list(by), ["_h", *unique_id]
    dealt = slotted(df.withColumn("_h", F.xxhash64(F.lit(seed), *unique_id)), by, [F.col(c) for c in order])
    starts = slot_starts(dealt.groupBy("_key").agg(F.count(F.lit(1)).alias("n")), by, ["n"]).drop("n")
    place = F.col("_start_n") + F.row_number().over(Window.partitionBy("_key").orderBy(*order))
    return dealt.join(starts, "_key").withColumn(out, place).select(*df.columns, out)


def exact_quantiles(long: DataFrame, by: Sequence[str], value: str, probs: Mapping[str, float],
                    cell_rows: int = CELL_ROWS) -> DataFrame:
    """Exact, linearly interpolated quantiles per group.

    A pass counts rows per cell and finds the cells that hold the wanted ranks. While one
    of them has more than ``cell_rows`` rows and two values, all are cut into equal widths
    between their ends and counted again. Then only their distinct values are read and the
    ranks picked. No pass gathers a group in one task.
    """
    by = list(by)
    x = F.col(value).cast("double")
    rows = long.filter(F.col(value).isNotNull() & ~F.isnan(x)).select(*by, (x + F.lit(0.0)).alias("_x"))
    position = {k: (F.col("_total") - 1) * F.lit(float(p)) for k, p in probs.items()}
    ranks = [f(p) for p in position.values() for f in (F.floor, F.ceil)]

    def holding(cells: DataFrame, group: Sequence[str]) -> DataFrame:
        """Of counted cells (by, _cell, n, _lo, _hi, _total, _from) those with a wanted rank;
        ``_from`` is where the first cell of ``group`` starts."""
        before = Window.partitionBy(*group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
        start = F.col("_from") + F.coalesce(F.sum("n").over(before), F.lit(0))
        placed = cells.withColumn("_start", start)
        hit = F.exists(F.array(*ranks), lambda r: (r >= F.col("_start")) & (r < F.col("_start") + F.col("n")))
        return small_side(placed.filter(hit).select(*by, "_lo", "_hi", "_start", "_total", "n"))

    counted = [F.count(F.lit(1)).alias("n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi")]
    cells = rows.groupBy(*by, value_cell(F.col("_x")).alias("_cell")).agg(*counted)
    whole = F.sum("n").over(Window.partitionBy(*by)) if by else F.sum("n").over(Window.partitionBy(F.lit(1)))
    needed = holding(cells.withColumns({"_total": whole, "_from": F.lit(0)}), by or [F.lit(1)])

    def inside(needed: DataFrame) -> DataFrame:
        """The rows of the needed cells, with the cell's own columns."""
        side = needed.select(*[F.col(b).alias(f"_r_{b}") for b in by], "_lo", "_hi", "_start", "_total")
        match = (F.col("_x") >= F.col("_lo")) & (F.col("_x") <= F.col("_hi"))
        for b in by:
            match = match & F.col(b).eqNullSafe(F.col(f"_r_{b}"))
        return rows.join(side, match)

    while not needed.filter((F.col("n") > cell_rows) & (F.col("_lo") < F.col("_hi"))).isEmpty():
        part = inside(needed.withColumnRenamed("n", "_n"))
        # halves keep the width of the widest range finite; infinities are ends of their own
        share = (F.col("_x") / 2 - F.col("_lo") / 2) / (F.col("_hi") / 2 - F.col("_lo") / 2)
        cut = F.when(F.col("_x") == F.col("_lo"), 0).when(F.col("_x") == F.col("_hi"), 4095).otherwise(
            F.least(F.greatest(F.floor(F.coalesce(F.nanvl(share, F.lit(0.5)), F.lit(0.5)) * 4094).cast("int"), F.lit(0)), F.lit(4093)) + 1)
        group = [*by, "_start", "_total"]
        finer = part.groupBy(*group, cut.alias("_cell")).agg(*counted).withColumnRenamed("_start", "_from")
        needed = holding(finer, [*by, "_from"])

    values = inside(needed).groupBy(*by, "_start", "_total", "_x").agg(F.count(F.lit(1)).alias("n"))
    within = Window.partitionBy(*by, "_start").orderBy("_x").rowsBetween(Window.unboundedPreceding, 0)
    placed = values.withColumn("_end", F.col("_start") + F.sum("n").over(within))

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("_end") - F.col("n")) & (rank < F.col("_end")), F.col("_x")))

    picked = placed.groupBy(*by).agg(F.max("_total").alias("_total"), *[
        at(f(position[k])).alias(f"_{side}_{k}") for k in probs for side, f in (("lo", F.floor), ("hi", F.ceil))])

    def between(k: str) -> Column:
        lo, hi, part = F.col(f"_lo_{k}"), F.col(f"_hi_{k}"), position[k] - F.floor(position[k])
        # the ends of a flat or whole step may be infinite
        return F.when((lo == hi) | (part == 0), lo).otherwise(lo + (hi - lo) * part)

    return picked.select(*by, *[between(k).alias(k) for k in probs])


# ---------------------------------------------------------------- first / best per group

def _ordered_key(order: Sequence[Column | str]) -> list[Column]:
    """Sort key columns preceded by a null mark, so that missing sorts last."""
    key = []
    for o in order:
        c = F.col(o) if isinstance(o, str) else o
        key += [c.isNull(), c]
    return key


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                    keep: Sequence[str] | None = None) -> DataFrame:
    """First row of each group in a total order.

    A minimum over a struct combines on the map side, so a hot group is reduced to one row
    a task before the shuffle. Spark keeps such a minimum in a sort-based aggregate: a
    task sorts its rows by the group's key, but no group is ever gathered or sorted.
    """
    kept = [c for c in (keep or df.columns) if c not in keys]
    packed = F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(_ordered_key(order))],
                      *[F.col(c).alias(c) for c in kept])
    return (df.groupBy(*keys).agg(F.min(packed).alias("_first"))
            .select(*keys, *[F.col(f"_first.{c}").alias(c) for c in kept]))


dedup_first = first_per_group


def best_per_group(df: DataFrame, keys: Sequence[str], metric: str, tie: Sequence[str]) -> DataFrame:
    """Row with the highest metric in each group; ties go to the smallest ``tie``."""
    return first_per_group(df, keys, [-F.col(metric), *tie])


def best_per_objective(df: DataFrame, objectives: Sequence[dict], tie: Sequence[str]) -> DataFrame:
    """One winner per objective, all found in a single pass.

    An objective is ``{"label", "where" (Column or None), "by" [metrics, best
    first]}``; the highest metrics win, ties go to the smallest ``tie`` values.
    """
    row = [F.col(c) for c in df.columns]
    picks = []
    for i, obj in enumerate(objectives):
        keys = _ordered_key([-F.col(m) for m in obj["by"]] + list(tie))
        packed = F.struct(*[k.alias(f"_k{j}") for j, k in enumerate(keys)], F.struct(*row).alias("_row"))
        where = obj.get("where")
        picks.append(F.min(F.when(where, packed) if where is not None else packed).alias(f"_w{i}"))
    winners = F.array(*[
        F.struct(F.lit(o["label"]).alias("objective"), F.col(f"_w{i}._row").alias("_row"))
        for i, o in enumerate(objectives)])
    return (df.agg(*picks).select(F.explode(winners).alias("_e"))
            .filter(F.col("_e._row").isNotNull()).select("_e.objective", "_e._row.*"))


# ---------------------------------------------------------------- top-k and shares

def top_k(df: DataFrame, order: Sequence[tuple[str, str]], k: int) -> DataFrame:
    """First k rows of a mixed-direction sort, missing values last."""
    keys = [F.col(c).desc_nulls_last() if d == "desc" else F.col(c).asc_nulls_last() for c, d in order]
    return df.orderBy(*keys).limit(k)


def sample_head(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """First n rows in a stated order."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n)


def top_k_exclusive(df: DataFrame, item: str, rank: str, groups: Sequence[Sequence[str]], k: int) -> DataFrame:
    """Best k items by rank with at most one item per exclusion group.

    Groups are disjoint, so the greedy choice is the best-ranked item of each
    group; an item outside every group stands for itself.
    """
    group = F.concat(F.lit("item:"), F.col(item))
    for i, members in enumerate(groups):
        group = F.when(F.col(item).isin(list(members)), F.lit(f"group:{i}")).otherwise(group)
    marked = df.withColumn("_group", group)
    return first_per_group(marked, ["_group"], [rank, item]).drop("_group").orderBy(rank, item).limit(k)


def distinct_ordered(df: DataFrame, col: str, order: str, n: int) -> DataFrame:
    """First n distinct values in order of first appearance."""
    return df.groupBy(col).agg(F.min(order).alias("first_seen")).orderBy("first_seen", col).limit(n)


def share(df: DataFrame, col: str, out: str = "share") -> DataFrame:
    """Value divided by the column total."""
    total = df.agg(F.sum(col).alias("_total"))
    return attach_scalars(df, total).withColumn(out, F.try_divide(F.col(col), F.col("_total"))).drop("_total")
