"""One-hot coding over a table of levels, scores side by side, boosting prefixes."""

import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from surveyloom.operators import encode as E
from surveyloom.operators import models as M


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(8)
    data = [(k, rng.choice([1.0, 2.5, 4.0, None, float("nan")]), rng.choice(["a", "b", "c", None]), rng.choice(["x", "y"]), int(rng.random() < 0.4))
            for k in range(200)]
    return spark.createDataFrame(data, "id bigint, n double, c string, d string, y int").repartition(3)


def dense(df):
    return {r["id"]: r["v"] for r in df.select("id", vector_to_array("features").alias("v")).collect()}


def test_same_features_as_the_string_indexer(spark, rows, tmp_path):
    train, other = rows.where("id < 150 and coalesce(c, '') <> 'b'"), rows.where("id >= 150")
    encoder = E.fit_encoder(train, ["n"], ["c", "d"])
    prep = M.fit_preprocessor(train, ["n"], ["c", "d"], scale=False)
    assert dense(encoder.transform(other)) == dense(prep.transform(other))
    assert [tuple(r) for r in encoder.slots().orderBy("slot").collect()] == [
        (0, "n", None), (1, "c", "a"), (2, "c", "c"), (3, "d", "x"), (4, "d", "y")]
    encoder.save(f"{tmp_path}/encoder")
    again = E.load_encoder(spark, f"{tmp_path}/encoder")
    assert dense(again.transform(other)) == dense(encoder.transform(other)) and again.sizes == encoder.sizes


def test_importance_joins_the_dictionary(rows):
    encoder = E.fit_encoder(rows, ["n"], ["c", "d"])
    fitted = M.fit_model(M.training_rows(encoder.transform(rows), "weighted", "y", "id"), M.ModelConfig("logistic", "weighted"))
    got = {r["variable"]: r["influence"] for r in E.importance_by_dictionary(fitted, encoder).collect()}
    w = [abs(x) for x in fitted.coefficients.toArray()]
    sums = {"n": w[0], "c": sum(w[1:4]), "d": sum(w[4:6])}
    assert got == pytest.approx({k: v / max(sums.values()) for k, v in sums.items()})


def test_no_categories_and_empty_columns(spark, rows):
    assert {tuple(v) for v in dense(E.fit_encoder(rows, ["n"], []).transform(rows)).values()} == {(1.0,), (2.5,), (4.0,)}
    empty = rows.withColumn("c", F.lit(None).cast("string"))
    assert {len(v) for v in dense(E.fit_encoder(empty, ["n"], ["c", "d"]).transform(empty)).values()} == {3}


def test_scores_side_by_side_and_boosting_prefix(rows):
    prep = M.fit_preprocessor(rows, ["n"], ["c", "d"])
    prepared = prep.transform(rows)
    train = M.training_rows(prepared, "weighted", "y", "id").coalesce(1).persist()
    boosted = {"maxDepth": 2, "subsamplingRate": 0.8}
    long, short = (M.fit_model(train, M.ModelConfig("gbt", "weighted", {"maxIter": n, **boosted})) for n in (6, 3))
    fits = [({"name": "first"}, M.first_rounds(long, 3)), ({"name": "short"}, short), ({"name": "svc"}, M.fit_model(train, M.ModelConfig("svc", "weighted"))),
            ({"name": "logistic"}, M.fit_model(train, M.ModelConfig("logistic", "weighted")))]
    got = {}
    for r in M.raw_scores(fits, prepared, ["id"]).collect():
        got.setdefault(r["name"], {})[r["id"]] = r["score"]
    assert got["first"] == pytest.approx(got["short"])
    for name, fitted in (("short", short), ("logistic", fits[3][1])):
        one = fitted.transform(prepared).select("id", vector_to_array("probability")[1].alias("s"))
        assert got[name] == pytest.approx({r["id"]: r["s"] for r in one.collect()})
    margin = fits[2][1].transform(prepared).select("id", vector_to_array("rawPrediction")[1].alias("s"))
    assert got["svc"] == pytest.approx({r["id"]: r["s"] for r in margin.collect()})


def test_fits_answer_all_rounds_at_once():
    grid = M.parameter_grid()
    jobs = M._longest_rounds(grid)
    assert len(grid) == 70 and len(jobs) == 62 and sum(map(len, jobs.values())) == 70
    assert all(len(part) == 2 for most, part in jobs.items() if most.name == "gbt")


def test_margins_are_scaled_per_model(spark):
    rows = [("a", 0, -2.0, True), ("a", 1, 2.0, True), ("b", 0, 0.25, False), ("b", 1, 0.75, False), ("b", 1, None, False)]
    df = spark.createDataFrame(rows, "model string, label int, score double, is_margin boolean")
    got = {r["model"]: r for r in M.evaluate_scores(df, ["model"], [0.5]).collect()}
    assert (got["a"]["tp"], got["a"]["tn"], got["a"]["roc_auc"]) == (1, 1, 1.0)
    assert (got["b"]["tp"], got["b"]["tn"], got["b"]["fn"], got["b"]["pr_auc"]) == (1, 1, 0, 1.0)
