"""Unions, distinct rows and changes of shape."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import long_text


def union_all(dfs: Sequence[DataFrame]) -> DataFrame:
    """Rows of all tables; a column a table lacks is missing there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def distinct(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return (df.select(*cols) if cols else df).distinct()


def is_subset(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Whether all present values belong to a list, in one row."""
    outside = F.count_if(F.col(col).isNotNull() & ~F.col(col).isin(list(values)))
    return df.agg(outside.alias("_out")).select(F.lit(col).alias("variable"), (F.col("_out") == 0).alias("is_subset"))


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "variable",
         value: str = "value") -> DataFrame:
    return df.unpivot(list(ids), list(values), name, value)


def pivot_matrix(df: DataFrame, row: str, col: str, value: str, cols: Sequence, top: int = 10) -> DataFrame:
    """Long → wide with gaps as zero, the row mean, and the rows with the highest
    mean. The column names are given, so no extra pass looks for them."""
    wide = df.groupBy(row).pivot(col, list(cols)).agg(F.sum(value)).na.fill(0.0)
    mean = reduce(lambda a, b: a + b, [F.col(str(c)) for c in cols]) / len(cols)
    return wide.withColumn("mean", mean).orderBy(F.desc("mean"), row).limit(top)


def dummy_levels(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per level of every text column: its dummy name and its size; a
    missing value is the level ``<NA>``."""
    return (long_text(df, cols).groupBy("variable", F.coalesce("value", F.lit("<NA>")).alias("level"))
            .agg(F.count(F.lit(1)).alias("n"))
            .withColumn("expanded_feature", F.concat_ws("__", "variable", "level")))


def long_dummies(df: DataFrame, cols: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """The ones of the dummy columns, one row each: (keep…, expanded_feature, flag).
    Any number of levels; ``dummy_levels`` is the table of all columns."""
    level = F.coalesce("value", F.lit("<NA>"))
    return long_text(df, cols, keep).select(
        *keep, F.concat_ws("__", "variable", level).alias("expanded_feature"), F.lit(1).alias("flag"))


def expand_dummies(df: DataFrame, cols: Sequence[str], keep: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Wide 0/1 columns, one per level, and the metadata row of every dummy. Every
    level is a column of the result and so a name in the plan; ``long_dummies`` has
    the same content for columns with very many levels."""
    meta = dummy_levels(df, cols)
    levels = meta.orderBy("variable", "level").collect()
    flags = [(F.coalesce(F.col(r["variable"]).cast("string"), F.lit("<NA>")) == r["level"]).cast("int")
             .alias(r["expanded_feature"]) for r in levels]
    return df.select(*keep, *flags), meta
