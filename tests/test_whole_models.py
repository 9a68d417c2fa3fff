"""The registered model queries ask for the whole of their job (nothing is fitted here)."""

from collections import Counter
from threading import Barrier, Event

import pytest
from pyspark.sql import functions as F

from surveyloom.operators import models as M
from surveyloom.queries import QUERIES


class Asked(Exception):
    pass


def asked(monkeypatch, function, name, spark, data):
    def stop(*args, **kwargs):
        raise Asked(args, kwargs)

    monkeypatch.setattr(M, function, stop)
    with pytest.raises(Asked) as caught:
        QUERIES[name](spark, data)
    return caught.value.args


def test_boosting_runs_all_rounds(spark, data, monkeypatch):
    args, _ = asked(monkeypatch, "make_pipeline", "m04_gbt_scores", spark, data)
    assert M.model(args[4].name, **args[4].params).getMaxIter() == 300


def test_grid_has_every_configuration(spark, data, monkeypatch):
    args, _ = asked(monkeypatch, "grid_search", "m09b_grid_search_whole", spark, data)
    assert Counter(c.name for c in args[4]) == {"logistic": 6, "tree": 24, "forest": 24, "gbt": 16}


def test_cross_validation_has_four_sets_and_five_folds(spark, data, monkeypatch):
    args, named = asked(monkeypatch, "cross_validate", "m08b_cross_validate_four_sets_five_folds", spark, data)
    assert len(args[1]) == 4 and named["k"] == 5


def test_six_models_are_exported(spark, data, monkeypatch):
    args, _ = asked(monkeypatch, "export_models", "m11b_export_models_whole", spark, data)
    assert len(args[4]) == 6 and len({alias for alias, _, _ in args[4]}) == 6


def test_whole_cross_validation_has_two_hundred_fits(spark, data, monkeypatch):
    args, named = asked(monkeypatch, "cross_validate", "m08c_cross_validate_whole_benchmark", spark, data)
    assert len(args[1]) * named["k"] * len(args[4]) == 200


def test_training_rows_have_no_plan_behind_them(spark):
    rows = spark.range(0, 1000, 1, 16).withColumn("x", F.sqrt("id")).repartition(12, "id")
    kept = M._few_partitions(rows)
    assert kept.rdd.getNumPartitions() == 1 and kept.count() == 1000
    assert "Repartition" not in kept._jdf.queryExecution().analyzed().toString()
    kept.unpersist()


def test_folds_are_fitted_side_by_side(spark, monkeypatch):
    rows = [(i, float(i % 7), i % 3 == 0) for i in range(60)]
    df = spark.createDataFrame(rows, "id bigint, x double, y boolean").withColumn("y", F.col("y").cast("int"))
    meeting, fit = Barrier(2, timeout=120), M.fit_model

    def together(rows, cfg):
        meeting.wait()   # broken unless the fit of the other fold is under way too
        return fit(rows, cfg)

    monkeypatch.setattr(M, "fit_model", together)
    found = M.cross_validate(df, {"x": ["x"]}, "y", "id", [M.ModelConfig("tree")], k=2, thresholds=[0.5])
    assert {r["fold"]: r["tp"] + r["fn"] + r["tn"] + r["fp"] for r in found.collect()} == {1: 30, 2: 30}


def test_other_fits_are_scored_while_boosting_goes_on(spark, monkeypatch):
    rows = [(i, float(i % 7), int(i % 3 == 0)) for i in range(60)]
    df = spark.createDataFrame(rows, "id bigint, x double, y int")
    scored, waited, fit, score = Event(), [], M.fit_model, M.raw_scores

    def fitting(rows, cfg):
        if cfg.name == "gbt":
            waited.append(scored.wait(120))   # the tree is fitted and scored before boosting ends
        return fit(rows, cfg)

    def scoring(fits, *args):
        scored.set()
        return score(fits, *args)

    monkeypatch.setattr(M, "fit_model", fitting)
    monkeypatch.setattr(M, "raw_scores", scoring)
    grid = [M.ModelConfig("gbt", params={"maxIter": n, "maxDepth": 1}) for n in (1, 2)] + [M.ModelConfig("tree")]
    found = M.grid_search(df, ["x"], "y", "id", grid, thresholds=[0.5], parallelism=1).collect()
    assert sorted(r["configuration"] for r in found) == sorted(c.label for c in grid)
    assert waited == [True]
