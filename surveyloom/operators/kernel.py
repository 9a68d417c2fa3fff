"""Kernel features: a linear classifier on them approximates one with a Gaussian kernel.

A kernel machine compares every row with every support vector. Random Fourier features
(Rahimi and Recht, 2007) replace that by a fixed number of cosines of random
projections, whose inner products approach the kernel: the cost is rows times features,
nothing is kept per training row, and the model is a handful of numbers.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, HasSeed
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_by_value

ship_by_value(__name__)

KERNEL_FEATURES = 256


def scale_gamma(rows: DataFrame, features: str = "features") -> float:
    """1 / (number of features × variance of all their values): the width that suits data
    on any scale; 1 where the values do not vary or there are no rows. One aggregate."""
    summary = Summarizer.metrics("mean", "normL2", "count").summary(F.col(features))
    # the summary of no rows is an error, a group without rows is none
    found = rows.filter(F.col(features).isNotNull()).groupBy(F.lit(True)).agg(summary.alias("s")).select("s.*").first()
    if found is None:
        return 1.0
    mean, square = found["mean"].toArray(), found["normL2"].toArray() ** 2 / found["count"]
    variance = square.mean() - mean.mean() ** 2
    return float(1.0 / (len(mean) * variance)) if variance > 1e-12 * max(square.mean(), 1e-300) else 1.0


def fourier_map(width: int, dims: int, gamma: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Directions and phases; the legacy generator, whose numbers never change between versions."""
    draw = np.random.RandomState(seed)
    return draw.normal(size=(width, dims)) * np.sqrt(2.0 * gamma), draw.uniform(0.0, 2.0 * np.pi, size=dims)


def _cosines(dims: int, gamma: float, seed: int):
    made: dict[int, tuple[np.ndarray, np.ndarray]] = {}   # per task, by the width of the vectors

    def of_batch(vectors: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(vectors), index=vectors.index, dtype=object)
        known = vectors.notna().to_numpy()
        widths = vectors[known].map(len).to_numpy()
        for width in np.unique(widths):
            if width not in made:
                made[width] = fourier_map(int(width), dims, gamma, seed)
            directions, phases = made[width]
            places = np.flatnonzero(known)[widths == width]
            values = np.sqrt(2.0 / dims) * np.cos(np.stack(vectors.iloc[places].to_numpy()) @ directions + phases)
            for place, row in zip(places, values):
                out.iat[place] = row
        return out

    return F.pandas_udf(of_batch, "array<double>")


class KernelFeatures(Transformer, HasInputCol, HasOutputCol, HasSeed, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``outputCol``: ``dims`` cosine features of the vector ``inputCol``, whose inner
    product approaches exp(-gamma · |x - y|²). One matrix product per Arrow batch; the
    directions follow from the seed in each task, so nothing but the parameters is saved
    or shipped. A null vector stays null."""

    gamma = Param(Params._dummy(), "gamma", "factor of the squared distance", TypeConverters.toFloat)
    dims = Param(Params._dummy(), "dims", "number of features", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol="features", outputCol="kernel_features", gamma=1.0, dims=KERNEL_FEATURES, seed=42):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(inputCol="features", outputCol="kernel_features", gamma=1.0, dims=KERNEL_FEATURES, seed=42)

    def setOutputCol(self, value: str) -> KernelFeatures:
        return self._set(outputCol=value)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        made = _cosines(self.getOrDefault("dims"), self.getOrDefault("gamma"), self.getSeed())
        vector = F.col(self.getInputCol())
        # a dense array in either case; array_to_vector does not take null
        values = made(F.when(vector.isNotNull(), vector_to_array(vector)))
        return dataset.withColumn(self.getOutputCol(), F.when(vector.isNotNull(), array_to_vector(values)))
