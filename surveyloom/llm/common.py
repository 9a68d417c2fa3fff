"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words; everything else belongs to a word.
SPACE = r"[\x20\x09-\x0D]+"
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder named by the session; a local session without one
    (a test) gets its own, a cluster without one is an error."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    if not context.getCheckpointDir():
        if not configured:
            if not context.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            configured = tempfile.mkdtemp(prefix="llm-checkpoint-")
        context.setCheckpointDir(configured)
    return configured or context.getCheckpointDir()


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from the files."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


PART_ROWS = 20_000   # rows of a few short columns that a partition holds


def parts_for(spark: SparkSession, rows: int, each: int = PART_ROWS) -> int:
    """Partitions for so many rows: few rows do not make thousands of tasks and files."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // each))


def counted(df: DataFrame, each: int = PART_ROWS) -> tuple[DataFrame, int]:
    """``df`` written, to be read in as many partitions as its rows ask for; their number."""
    done = materialise(df)
    rows = done.count()
    return done.coalesce(parts_for(df.sparkSession, rows, each)), rows


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def word_list(text: Column) -> Column:
    """Array of the maximal runs of non-blank characters."""
    return F.array_remove(F.split(text, SPACE), "")


def running_total(df: DataFrame, order: list[str], value: str, out: str) -> DataFrame:
    """Exclusive running total of ``value`` in the order of ``order`` (which must
    be total), without sorting everything in one task.

    Range partitions are written with their number; a total per partition (one
    small row each) gives every partition its start, and the rows of one
    partition are summed in place.
    """
    ranged = df.repartitionByRange(*[F.col(c).asc() for c in order]).sortWithinPartitions(*order)
    placed = materialise(ranged.withColumn("_slot", F.spark_partition_id())
                         .withColumn("_at", F.monotonically_increasing_id()))
    starts, total = {}, 0
    for row in placed.groupBy("_slot").agg(F.sum(value).alias("_n")).orderBy("_slot").collect():
        starts[row["_slot"]] = total
        total += row["_n"] or 0
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)

    def add(batches):
        # Checkpointed partitions keep their rows in order; a slot never spans two.
        seen: dict[int, int] = {}
        for batch in batches:
            for slot, part in batch.groupby("_slot", sort=False):
                part = part.sort_values("_at")
                sums = part[value].cumsum()
                part[out] = sums - part[value] + seen.get(slot, starts[slot])
                seen[slot] = seen.get(slot, starts[slot]) + int(sums.iloc[-1])
                yield part.drop(columns=["_slot", "_at"])

    return placed.mapInPandas(add, f"{fields}, `{out}` bigint")
