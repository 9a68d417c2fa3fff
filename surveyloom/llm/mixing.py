"""Mixing sources to target weights under a time-varying curriculum.

Every source has a share of the mix (bounded by ``most`` times what it holds; the
excess goes to the others by weight) and a schedule: how its weight moves from the
start of training to the end. Its demand up to time t is its share times the integral
of the schedule; inverting that demand at the place where an occurrence of a document
stands in its source's own stream gives the time at which it is trained on. Sorting
all occurrences by that time, by range, gives the order of the whole mix.

A source's stream repeats its documents in a fixed order (by hash of the id) as often
as the share needs, and ends inside the last occurrence. Null sources are one source,
last in order; null texts have size 0; without rows there is no mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, materialise

MOST = 3.0
#: Slope of each weight class's schedule in [-1, 1]: weight at t is 1 + slope * (2t - 1)
#: times its mean, so light sources come early and heavy ones late.
SLOPES = (-0.5, 0.0, 0.5)
CELL_ROWS = 50_000


def size_of(text: str = "text") -> Column:
    """Number of words; null: 0."""
    words = F.array_remove(F.split(F.col(f"`{text}`").cast("string"), SPACE), "")
    return F.coalesce(F.size(words), F.lit(0)).cast("bigint")


def shares(sources: DataFrame, most: float = MOST, cycle: int = 3) -> DataFrame:
    """Adds weight, target and slope to one row per source (source, rows, source_size).

    Filling up: with sources in order of the level at which they reach their bound,
    the level of the rest follows from running sums, so one pass gives all targets.
    """
    everything = Window.partitionBy(F.lit(1))
    upto = lambda *keys: everything.orderBy(*keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    place = F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1
    df = sources.withColumn("_k", (place % cycle).cast("int")).withColumn("weight", (F.col("_k") + 1).cast("bigint"))
    df = df.withColumns({"_cap": most * F.col("source_size"), "_total": F.sum("source_size").over(everything).cast("double"),
                         "_weights": F.sum("weight").over(everything)})
    df = df.withColumn("_full", F.col("_cap") / F.col("weight"))
    order = (F.col("_full").asc(), F.col("source").asc_nulls_last())
    df = df.withColumns({"_caps": F.sum("_cap").over(upto(*order)), "_w": F.sum("weight").over(upto(*order))})
    # the level if this source and all before it are at their bound
    left = F.col("_weights") - F.col("_w")
    level = F.when(left > 0, (F.col("_total") - F.col("_caps")) / left)
    before = F.lag(level).over(everything.orderBy(*order))
    start = F.col("_total") / F.col("_weights")
    df = df.withColumn("_before", F.coalesce(before, start))
    df = df.withColumn("_bound", F.col("_before") >= F.col("_full"))
    # the bounded ones come first in this order, and the first free one has the level
    df = df.withColumn("_level", F.min(F.when(~F.col("_bound"), F.struct("_full", F.col("source").isNull(), "source", "_before"))).over(everything)["_before"])
    target = F.when(F.col("_bound"), F.col("_cap")).otherwise(F.col("weight") * F.col("_level"))
    slope = F.element_at(F.array(*[F.lit(s) for s in SLOPES]), F.col("_k") % len(SLOPES) + 1)
    return df.select("source", "rows", "source_size", "weight", target.alias("target"), slope.alias("slope"))


def when_reached(part: Column, slope: Column) -> Column:
    """The time in [0, 1] at which a source has been asked for ``part`` of its share:
    the inverse of t + slope * (t² - t)."""
    rest = 1 - slope
    root = F.sqrt(rest * rest + 4 * slope * part)
    return F.when(slope == 0, part).otherwise(2 * part / (rest + root))


def plan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", most: float = MOST) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, copies and the
    training positions of its occurrences.

    The running size of a source goes through cells of its hash order, about
    ``CELL_ROWS`` rows each however many the source has, so a source that holds a
    third of all rows is not one task.
    """
    narrow = materialise(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").cast("string").alias("source"),
                                     size_of(text).alias("size")))
    sources = narrow.groupBy("source").agg(F.count("*").alias("rows"), F.sum("size").alias("source_size"))
    targets = materialise(shares(sources, most))
    mark = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    # 28 bits of the mark, cut into as many equal ranges as the source needs
    cell = F.floor(F.conv(F.substring(mark, 1, 7), 16, 10).cast("bigint") * F.ceil(F.col("rows") / CELL_ROWS) / (1 << 28))
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    rows = narrow.join(targets.withColumnRenamed("source", "_s"), same("source", "_s")).drop("_s")
    rows = rows.withColumns({"mark": mark, "cell": cell})
    cells = rows.groupBy("source", "cell").agg(F.sum("size").alias("_n"))
    cells = cells.select(F.col("source").alias("_s"), F.col("cell").alias("_c"), (F.sum("_n").over(
        Window.partitionBy("source").orderBy("cell")) - F.col("_n")).alias("base"))
    inside = Window.partitionBy("source", "cell").orderBy("mark", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("before", F.sum("size").over(inside) - F.col("size"))
    rows = rows.join(cells, same("source", "_s") & (F.col("cell") == F.col("_c"))).withColumn("before", F.col("before") + F.col("base"))
    # the stream of a source: whole rounds, and one more up to the place where the share ends
    words = F.round("target").cast("bigint")
    rounds = F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(F.lit(0)).cast("bigint")
    rest = words - rounds * F.col("source_size")
    part = F.least(F.greatest(rest - F.col("before"), F.lit(0)), F.col("size"))
    rows = rows.withColumns({"rounds": rounds, "part": part})
    taken = F.col("rounds") * F.col("size") + F.col("part")
    copies = (F.col("rounds") + F.when(2 * F.col("part") >= F.greatest(F.col("size"), F.lit(1)), 1).otherwise(0)).cast("bigint")
    middle = lambda k: (k * F.col("source_size") + F.col("before") + F.col("size") / 2) / F.greatest(F.col("target"), F.lit(1.0))
    positions = F.when(F.col("_copies") > 0, F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1),
        lambda k: when_reached(F.least(middle(k), F.lit(1.0)), F.col("slope")))).otherwise(F.array().cast("array<double>"))
    rows = rows.withColumns({"taken": taken, "_copies": copies}).withColumn("positions", positions)
    return rows.select("doc_id", "source", "size", "source_size", "target", "taken", F.col("_copies").alias("copies"), "positions")


def curriculum(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", most: float = MOST) -> DataFrame:
    """The rows of ``docs`` in training order, as often as the mix takes them whole
    (a last occurrence counts if at least half of it is inside the share). Rows travel
    inside one struct, so columns of ``docs`` may have any names."""
    counted = plan(docs, doc_id, text, source, most).where("copies > 0")
    # rows that share an id and a source share their occurrences in turn
    slots = counted.groupBy(F.col("doc_id").alias("_d"), F.col("source").alias("_s"), F.col("size").alias("_z")).agg(
        F.min("positions").alias("_positions"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(f"`{doc_id}`").alias("id"),
                       F.col(f"`{source}`").cast("string").alias("source"), size_of(text).alias("size"))
    kept = rows.join(slots, F.col("id").eqNullSafe(F.col("_d")) & F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z")))
    spread = kept.select("doc", "id", F.explode("_positions").alias("position"))
    return spread.orderBy("position", "id").select("doc.*")
