"""One-hot coding over a dictionary of levels that stays a table.

The levels of all columns are numbered by Spark and met by join, so their names never
come to the driver; it knows one number per column. Features are sparse vectors. The
dictionary is saved as Parquet next to the other stages and read again with them."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Model, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import long_text
from .metrics import group_importance
from .ordered import running_totals
from .prep import fit_imputers


def fit_levels(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(variable, level, code): the levels that occur, sorted and numbered from 0 in each
    column; a missing value is no level."""
    levels = long_text(train, cols).filter(F.col("value").isNotNull()).select("variable", F.col("value").alias("level")).distinct()
    numbered = running_totals(levels, ["variable"], "level", {"n": F.count(F.lit(1))}, descending=False)
    return cut_lineage(numbered.select("variable", "level", (F.col("cum_n") - 1).alias("code")))


def with_codes(df: DataFrame, levels: DataFrame, cols: Sequence[str], suffix: str = "__code") -> DataFrame:
    """Add the code of every column; null for a missing value and for an unknown level."""
    for c in cols:
        side = levels.filter(F.col("variable") == c).select(F.col("level").alias("_level"), F.col("code").alias(c + suffix))
        df = df.join(side, F.col(f"`{c}`").cast("string") == F.col("_level"), "left").drop("_level")
    return df


@dataclass(frozen=True)
class LevelEncoder:
    """Imputation, one-hot coding and assembly of a table, learned on training rows."""

    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    fill: Mapping[str, object]     # median or most frequent value per column
    sizes: Mapping[str, int]       # number of levels per column
    levels: DataFrame              # (variable, level, code)
    stages: PipelineModel

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``features``: the numbers, then for each category column one slot per
        level, all zero for an unknown one."""
        names = [f"{c}__cat" for c in self.categorical]
        df = df.withColumns({n: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(self.fill[c])) for n, c in zip(names, self.categorical)})
        own = F.col("variable")
        for n, c in zip(names, self.categorical):
            own = F.when(F.col("variable") == c, F.lit(n)).otherwise(own)
        df = with_codes(df, self.levels.withColumn("variable", own), names, "__code")
        df = df.withColumns({f"{c}__idx": F.coalesce(F.col(f"{n}__code"), F.lit(self.sizes[c])).cast("double")
                             for n, c in zip(names, self.categorical)})
        return self.stages.transform(df).drop(*names, *[f"{n}__code" for n in names], *[f"{c}__idx" for c in self.categorical],
                                              *[f"{c}__hot" for c in self.categorical])

    def slots(self) -> DataFrame:
        """(slot, variable, level): what each place of the vector stands for."""
        spark, at = self.levels.sparkSession, len(self.numeric)
        numbers = spark.createDataFrame([(i, c, None) for i, c in enumerate(self.numeric)], "slot bigint, variable string, level string")
        starts = {}
        for c in self.categorical:
            starts[c], at = at, at + self.sizes[c]
        first = F.lit(0)
        for c, start in starts.items():
            first = F.when(F.col("variable") == c, F.lit(start)).otherwise(first)
        return numbers.unionByName(self.levels.select((first + F.col("code")).cast("bigint").alias("slot"), "variable", "level"))

    def save(self, folder: str) -> None:
        spark = self.levels.sparkSession
        self.levels.write.mode("overwrite").parquet(f"{folder}/levels")
        self.stages.write().overwrite().save(f"{folder}/stages")
        rest = json.dumps({"numeric": self.numeric, "categorical": self.categorical, "fill": self.fill, "sizes": self.sizes})
        spark.createDataFrame([(rest,)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/encoder")


def load_encoder(spark: SparkSession, folder: str) -> LevelEncoder:
    rest = json.loads(spark.read.text(f"{folder}/encoder").first()["value"])
    return LevelEncoder(tuple(rest["numeric"]), tuple(rest["categorical"]), rest["fill"], rest["sizes"],
                        spark.read.parquet(f"{folder}/levels"), PipelineModel.load(f"{folder}/stages"))


def fit_encoder(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> LevelEncoder:
    """Learn fills and levels; a missing number takes the median, a missing category the
    most frequent level."""
    spark = train.sparkSession
    fill = fit_imputers(train, numeric, categorical)
    levels = fit_levels(train, categorical) if categorical else spark.createDataFrame([], "variable string, level string, code bigint")
    sizes = {c: 0 for c in categorical} | {r["variable"]: r["n"] for r in levels.groupBy("variable").agg(F.count(F.lit(1)).alias("n")).collect()}
    exprs = [f"coalesce(nanvl(try_cast(`{c}` AS DOUBLE), CAST(NULL AS DOUBLE)), CAST({float(fill[c])!r} AS DOUBLE)) AS `{c}__num`" for c in numeric]
    stages: list = [SQLTransformer(statement=f"SELECT {', '.join(['*', *exprs])} FROM __THIS__")]
    if categorical:
        # an encoder learns sizes from the largest index it sees: the place after all levels, which is dropped
        ends = spark.createDataFrame([tuple(float(sizes[c]) for c in categorical)], ", ".join(f"`{c}__idx` double" for c in categorical))
        stages.append(OneHotEncoder(inputCols=[f"{c}__idx" for c in categorical], outputCols=[f"{c}__hot" for c in categorical],
                                    dropLast=True).fit(ends))
    stages.append(VectorAssembler(inputCols=[f"{c}__num" for c in numeric] + [f"{c}__hot" for c in categorical], outputCol="features"))
    return LevelEncoder(tuple(numeric), tuple(categorical), fill, sizes, levels, PipelineModel(stages))


def importance_by_dictionary(fitted: Model, encoder: LevelEncoder) -> DataFrame:
    """Absolute coefficients or importances of a model on encoded rows, joined with the
    dictionary, summed to their variable and scaled to maximum 1."""
    weights = fitted.featureImportances if hasattr(fitted, "featureImportances") else fitted.coefficients
    slots = encoder.levels.sparkSession.createDataFrame([(i, float(w)) for i, w in enumerate(weights.toArray())], "slot bigint, weight double")
    return group_importance(slots.join(encoder.slots(), "slot"))
