"""Boosting in one task against Spark's, and models that list their trees only when asked."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors

from surveyloom.operators import boosting as B
from surveyloom.operators import models as M

WHOLE = {"subsamplingRate": 1.0, "featureSubsetStrategy": "all"}   # nothing is drawn, so both must agree


@pytest.fixture(scope="module")
def train(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(400):
        x = [float(rng.normal()), float(rng.integers(0, 40)), float(rng.integers(0, 2))]
        y = float(rng.random() < 1 / (1 + np.exp(-x[0] - 2 * x[2] + x[1] / 20)))
        rows.append((i, Vectors.dense(x), y, 1.0 + 2.5 * y))
    df = spark.createDataFrame(rows, ["id", "features", "label", "weight"]).repartition(3, "id").persist()
    df.count()
    yield df
    df.unpersist()


def scores(model, rows):
    return [r[0] for r in model.transform(rows).orderBy("id").select(vector_to_array("probability")[1]).collect()]


@pytest.mark.parametrize("params", [{"maxIter": 6, "maxDepth": 4}, {"maxIter": 4, "maxDepth": 3, "minInstancesPerNode": 25, "maxBins": 8},
                                    {"maxIter": 3, "maxDepth": 2, "minWeightFractionPerNode": 0.2, "stepSize": 0.3}])
def test_boosting_in_one_task_is_sparks(train, params):
    given = {**WHOLE, **params}
    fitted = M.fit_model(train, M.ModelConfig("gbt", "weighted", given))
    own = {"stepSize": 0.05, **given}
    spark_fit = GBTClassifier(weightCol="weight", seed=M.SEED, **own).fit(train)
    assert scores(fitted, train) == pytest.approx(scores(spark_fit, train), abs=1e-9)
    assert fitted.getNumTrees == params["maxIter"] and fitted.getMaxIter() == params["maxIter"]


def test_many_rows_are_boosted_by_spark(train, monkeypatch):
    cfg = M.ModelConfig("gbt", "weighted", {**WHOLE, "maxIter": 3, "maxDepth": 2})
    here = scores(M.fit_model(train, cfg), train)
    monkeypatch.setattr(B, "PART_ROWS", 100)
    assert scores(M.fit_model(train, cfg), train) == pytest.approx(here, abs=1e-9)


def test_a_boosted_fit_starts_few_jobs(spark, train):
    sc = spark.sparkContext
    sc.setJobGroup("boosted", "one boosted fit")
    try:
        M.fit_model(train, M.ModelConfig("gbt", "weighted", {"maxIter": 60, "maxDepth": 3}))
        assert len(sc.statusTracker().getJobIdsForGroup("boosted")) < 40   # some 250 when every level is a job
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_draws_follow_the_rows_and_not_their_order(train):
    cfg = M.ModelConfig("gbt", "weighted", {"maxIter": 5, "maxDepth": 3})
    assert scores(M.fit_model(train.orderBy("id"), cfg), train) == pytest.approx(scores(M.fit_model(train.orderBy("label", "id"), cfg), train), abs=1e-12)


@pytest.mark.parametrize("cfg", [M.ModelConfig("forest", "weighted", {"numTrees": 7, "maxDepth": 2}), M.ModelConfig("gbt", "weighted", {"maxIter": 7, "maxDepth": 2})])
def test_trees_are_listed_when_asked(train, cfg):
    fitted = M.fit_model(train, cfg)
    assert "trees" not in vars(fitted.copy())
    assert len(fitted.trees) == 7 and fitted.featureImportances.size == 3


@pytest.mark.parametrize("row", [(Vectors.dense([1.0]), 2.0, 1.0), (Vectors.dense([float("nan")]), 1.0, 1.0), (Vectors.dense([1.0]), 1.0, -1.0)])
def test_unfit_rows_are_refused(spark, row):
    df = spark.createDataFrame([row], ["features", "label", "weight"])
    with pytest.raises(Exception, match="features must be finite"):
        M.fit_model(df, M.ModelConfig("gbt", "weighted", {"maxIter": 2}))


def test_importance_forest_keeps_its_node_ids(monkeypatch, train):
    class Asked(Exception):
        pass

    def stop(*args):
        raise Asked(args)

    monkeypatch.setattr(M, "make_pipeline", stop)
    with pytest.raises(Asked) as caught:
        M.rf_importance(train, ["weight"], "label", "id")
    params = caught.value.args[0][4].params
    assert params["cacheNodeIds"] and (params["numTrees"], params["maxDepth"]) == (500, 15)
