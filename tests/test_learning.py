import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from surveyloom.operators import metrics as M
from surveyloom.operators import models as ML
from surveyloom.operators import prep as P
from surveyloom.operators import stats as S
from surveyloom.operators.kernel import KernelFeatures, scale_gamma
from surveyloom.operators.neighbours import knn_join


def test_f_tail_known_values():
    # F with (1, d) degrees of freedom is a squared t; (2, d) has a closed form
    assert S.f_tail(3.0, 2.0, 10.0) == pytest.approx((1 + 2 * 3.0 / 10.0) ** -5.0, rel=1e-12)
    assert S.f_tail(1.0, 1.0, 1.0) == pytest.approx(0.5, rel=1e-12)
    assert S.f_tail(1e-9, 2.0, 50.0) == pytest.approx((1 + 2e-9 / 50) ** -25, rel=1e-12)
    assert S.f_tail(130.0, 2.0, 1514.0) == pytest.approx((1 + 260.0 / 1514.0) ** -757.0, rel=1e-9)
    assert 0 < S.f_tail(120.0, 1.0, 1515.0) < 1e-25
    assert S.f_tail(3.0, 2.0, 1e12) == pytest.approx(math.exp(-3.0), rel=1e-10)
    assert S.f_tail(0.5, 2.0, 1e12) == pytest.approx(math.exp(-0.5), rel=1e-10)
    assert S.f_tail(3.84145882, 1.0, 1e13) == pytest.approx(0.05, rel=1e-7)
    assert S.f_tail(1.0, 5e5, 5e5) == pytest.approx(0.5, rel=1e-8)
    assert S.f_tail(0.0, 1.0, 9.0) == 1.0 and S.f_tail(math.inf, 1.0, 9.0) == 0.0


def test_anova_matches_expanded_dummies(spark):
    rng = np.random.default_rng(1)
    rows = [(i, float(rng.normal(3 * (i % 2), 2)), ["a", "b", None][rng.integers(3)], int(i % 2)) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, x double, c string, y int")
    got = {r["expanded_feature"]: r for r in S.anova_f(df, ["x"], ["c"], "y").collect()}

    def f_value(v, y):
        g = v.mean()
        groups = [v[y == k] for k in (0, 1)]
        between = sum(len(z) * (z.mean() - g) ** 2 for z in groups)
        within = sum(((z - z.mean()) ** 2).sum() for z in groups)
        return between / (within / (len(v) - 2))

    y = np.array([r[3] for r in rows])
    assert got["x"]["f_score"] == pytest.approx(f_value(np.array([r[1] for r in rows]), y), rel=1e-9)
    for level in ("a", "b", "<NA>"):
        v = np.array([float((r[2] or "<NA>") == level) for r in rows])
        assert got[f"c__{level}"]["f_score"] == pytest.approx(f_value(v, y), rel=1e-9)
    assert got["x"]["p_value"] < 0.05 and got["x"]["significant_5pct"]


def test_constant_feature_scores_zero_without_p_value(spark):
    df = spark.createDataFrame([(1.0, "k", 0), (1.0, "k", 1), (None, "k", 1)], "x double, c string, y int")
    rows = S.anova_f(df, ["x"], ["c"], "y").collect()
    assert all(r["f_score"] == 0 and r["p_value"] is None and not r["significant_5pct"] for r in rows)


def test_mutual_info_of_a_copy_is_the_entropy(spark):
    df = spark.createDataFrame([(str(i % 2), i % 2) for i in range(40)], "c string, y int")
    assert S.mutual_info(df, ["c"], [], "y").first()["mutual_info"] == pytest.approx(math.log(2))


def test_codes_put_levels_in_order(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("b",), ("ab",)], "c string")
    got = {r["c"]: r["c_code"] for r in S.ordinal_encode(df, ["c"]).collect()}
    assert got == {None: 0, "a": 1, "ab": 2, "b": 3}


def test_split_has_the_exact_class_counts(spark):
    df = spark.range(1517).select("id", (F.col("id") < 207).cast("int").alias("y"))
    marked = P.stratified_split(df, "y", 0.3, ["id"])
    counts = {(r["y"], r["is_test"]): r["count"] for r in marked.groupBy("y", "is_test").count().collect()}
    assert counts == {(0, 1): 394, (1, 1): 62, (0, 0): 916, (1, 0): 145}
    again = P.stratified_split(df.repartition(3), "y", 0.3, ["id"])
    assert marked.join(again, ["id", "is_test"]).count() == 1517


def test_folds_differ_by_at_most_one(spark):
    df = spark.range(1517).select("id", (F.col("id") < 207).cast("int").alias("y"))
    folded = P.stratified_folds(df, "y", 5, ["id"])
    sizes = [r["count"] for r in folded.groupBy("fold").count().collect()]
    pos = [r["count"] for r in folded.filter("y = 1").groupBy("fold").count().collect()]
    assert sorted(sizes) == [303, 303, 303, 304, 304] and sorted(pos) == [41, 41, 41, 42, 42]


def test_folds_with_tiny_class(spark):
    df = spark.createDataFrame([(i, int(i < 2)) for i in range(11)], "id int, y int")
    folded = P.stratified_folds(df, "y", 5, ["id"]).collect()
    assert {r["fold"] for r in folded} == {1, 2, 3, 4, 5} and len({r["fold"] for r in folded if r["y"] == 1}) == 2


def brute(points, k):
    ids = sorted(points)
    out = set()
    for a in ids:
        order = sorted((float(np.sqrt(((points[a] - points[b]) ** 2).sum())), b) for b in ids if b != a)
        out |= {(a, b, i + 1) for i, (_, b) in enumerate(order[:k])}
    return out


@pytest.mark.parametrize("pivots,block", [(1, 2048), (6, 2048), (6, 10), (1, 7)])
def test_knn_is_exact_with_hot_copies(spark, pivots, block):
    rng = np.random.default_rng(7)
    points = {i: rng.integers(0, 6, 3).astype(float) for i in range(70)}
    points.update({100 + i: np.array([1.0, 1.0, 1.0]) for i in range(40)})  # a third are copies of one point
    df = spark.createDataFrame([(i, v.tolist()) for i, v in points.items()], "id bigint, v array<double>")
    got = knn_join(df, "id", "v", 4, block_rows=block, pivots=pivots).collect()
    assert {(r["id"], r["neighbour_id"], r["rank"]) for r in got} == brute(points, 4)


def test_knn_row_travels_once_per_block(spark, monkeypatch):
    """Without structure every cell stays open; a row still travels once per block, not per cell."""
    from surveyloom.operators import neighbours

    visits, cut = [], neighbours.cut_lineage

    def counted(df):
        out = cut(df)
        if "_r" in out.columns:
            listed = out.schema["_r"].dataType.names[0]
            visits.append(out.selectExpr(f"sum(size(_r.{listed})) n").first()["n"])
        return out

    monkeypatch.setattr(neighbours, "cut_lineage", counted)
    rng = np.random.default_rng(3)
    points = {i: rng.normal(size=24) for i in range(400)}
    df = spark.createDataFrame([(i, v.tolist()) for i, v in points.items()], "id bigint, v array<double>")
    got = knn_join(df, "id", "v", 3, block_rows=20, pivots=60).collect()
    assert {(r["id"], r["neighbour_id"], r["rank"]) for r in got} == brute(points, 3)
    assert sum(visits) <= 400 * 30


def test_smote_balances_and_stays_on_segments(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4).tolist(), int(i < 12)) for i in range(100)]
    df = spark.createDataFrame(rows, "id bigint, v array<double>, y int")
    made = P.smote(df, "y", "id", "v").collect()
    assert len(made) == 88 - 12
    by_id = {i: np.array(v) for i, v, _ in rows}
    near = {(a, b) for a, b, _ in brute({i: np.array(v) for i, v, y in rows if y}, 5)}
    for r in made:
        assert (r["id"], r["neighbour_id"]) in near and 0 <= r["fraction"] < 1
        want = by_id[r["id"]] + r["fraction"] * (by_id[r["neighbour_id"]] - by_id[r["id"]])
        assert np.allclose(want, r["v"])
    assert P.smote(df.filter("id < 24"), "y", "id", "v").count() == 0


def sk_auc(labels, scores):
    pos = [s for s, y in zip(scores, labels) if y]
    neg = [s for s, y in zip(scores, labels) if not y]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_curves_with_ties(spark):
    labels, scores = [1, 0, 1, 0, 1, 0], [0.9, 0.9, 0.4, 0.4, 0.4, 0.1]
    df = spark.createDataFrame(list(zip(labels, scores)), "label int, score double")
    assert M.roc_auc(df).first()[0] == pytest.approx(sk_auc(labels, scores))
    # recall steps: 1/3 at precision 1/2, then 2/3 at precision 3/5
    assert M.average_precision(df).first()[0] == pytest.approx(1 / 3 * 0.5 + 2 / 3 * 0.6)
    points = sorted((r["fpr"], r["tpr"]) for r in M.roc_curve(df).collect())
    assert points == [(0.0, 0.0), (pytest.approx(1 / 3), pytest.approx(1 / 3)), (pytest.approx(2 / 3), 1.0), (1.0, 1.0)]


def test_undefined_metrics(spark):
    df = spark.createDataFrame([(0, 0.2), (0, 0.6)], "label int, score double")
    assert M.roc_auc(df).first()[0] is None and M.average_precision(df).first()[0] == 0.0
    row = M.binary_metrics(df, 0.9).first()
    assert (row["precision"], row["recall"], row["f1"], row["accuracy"]) == (0.0, 0.0, 0.0, 1.0)
    report = {r["class"]: r for r in M.classification_report(
        df.withColumn("prediction", F.lit(1))).collect()}
    assert report["0"]["recall"] == 0.0 and report["1"]["support"] == 0 and report["accuracy"]["f1"] == 0.0


def training(spark, n=240):
    rng = np.random.default_rng(3)
    rows = [(i, float(rng.normal(2 * (i % 4 == 0))), ["a", "b", "c"][i % 3], int(i % 4 == 0)) for i in range(n)]
    rows[5] = (5, None, None, 0)
    return spark.createDataFrame(rows, "id bigint, x double, c string, y int")


def test_unseen_category_is_all_zero_and_imputation_is_learned(spark):
    fitted = ML.fit_preprocessor(training(spark), ["x"], ["c"])
    new = spark.createDataFrame([(1, 0.0, "a"), (2, None, "never seen")], "id bigint, x double, c string")
    got = {r["id"]: r["v"] for r in fitted.transform(new).select("id", vector_to_array("features").alias("v")).collect()}
    assert sum(got[1][1:]) == 1 and sum(got[2][1:]) == 0 and len(got[1]) == 4


def test_saved_model_scores_like_the_one_in_memory(spark, tmp_path):
    df = training(spark)
    fitted = ML.make_pipeline(df, ["x", "c"], "y", "id", ML.ModelConfig("logistic", "smote"))
    fitted.write().save(str(tmp_path / "m"))
    a = ML.score_table(fitted, df, 0.5, ["id"]).orderBy("id").collect()
    b = ML.score_table(str(tmp_path / "m"), df, 0.5, ["id"]).orderBy("id").collect()
    assert a == b and len(a) == 240


def test_cross_validation_shape_and_bounds(spark):
    out = ML.cross_validate(training(spark), {"all": ["x", "c"]}, "y", "id",
                            [ML.ModelConfig("logistic", "weighted"), ML.ModelConfig("tree", "smote")], k=2,
                            thresholds=(0.3, 0.6)).collect()
    assert len(out) == 2 * 2 * 2 and all(r["tp"] + r["fn"] == 30 and 0 <= r["roc_auc"] <= 1 for r in out)


def test_parameter_grid_sizes():
    grid = ML.parameter_grid()
    names = [g.name for g in grid]
    assert [names.count(n) for n in ("logistic", "tree", "forest", "gbt")] == [6, 24, 24, 16]


def test_importance_groups_slots(spark):
    df = training(spark)
    fitted = ML.make_pipeline(df, ["x", "c"], "y", "id", ML.ModelConfig("logistic", "weighted"))
    rows = {r["variable"]: r["influence"] for r in ML.grouped_importance(fitted, df).collect()}
    assert set(rows) == {"x", "c"} and max(rows.values()) == 1.0


def test_kernel_features_approach_the_kernel(spark):
    rng = np.random.default_rng(3)
    points = rng.normal(size=(30, 4))
    df = spark.createDataFrame([(i, Vectors.dense(v)) for i, v in enumerate(points)] + [(30, Vectors.sparse(4, [1], [2.0])), (31, None)],
                               StructType([StructField("id", IntegerType()), StructField("features", VectorUDT())])).repartition(3)
    made = {r["id"]: r["kernel_features"] for r in KernelFeatures(gamma=0.3, dims=8192, seed=1).transform(df).collect()}
    assert made[31] is None and len(made) == 32
    points = np.vstack([points, [0.0, 2.0, 0.0, 0.0]])
    z = np.stack([made[i].toArray() for i in range(31)])
    exact = np.exp(-0.3 * ((points[:, None] - points[None]) ** 2).sum(axis=2))
    assert np.abs(z @ z.T - exact).max() < 0.06
    assert scale_gamma(df) == pytest.approx(1 / (4 * points.var()))
    even = df.select(array_to_vector(F.array(F.lit(2.0), F.lit(2.0))).alias("features"))
    assert scale_gamma(df.limit(0)) == 1.0 and scale_gamma(even) == 1.0


def _rings(spark):
    rng = np.random.default_rng(4)
    angle, far = rng.uniform(0, 2 * np.pi, 240), np.arange(240) % 2
    radius = np.where(far == 1, 3.0, 1.0) + rng.normal(0, 0.1, 240)
    rows = [(i, float(radius[i] * np.cos(angle[i])), float(radius[i] * np.sin(angle[i])), ["a", "b", None][i % 3], int(far[i])) for i in range(240)]
    return spark.createDataFrame(rows, "id int, x double, y double, c string, target int")


def test_kernel_classifier_parts_rings_and_is_saved(spark, tmp_path):
    df = _rings(spark)
    cfg = ML.ModelConfig("kernel_svc", "weighted", {"C": 100.0, "dims": 128})
    fitted = ML.make_pipeline(df, ["x", "y", "c"], "target", "id", cfg)
    assert fitted.transform(df).filter("prediction <> target").count() == 0
    fitted.write().save(f"{tmp_path}/model")
    here = {r["id"]: r["score"] for r in ML.score_table(fitted, df, 0.5, ["id"]).collect()}
    again = {r["id"]: r["score"] for r in ML.score_table(f"{tmp_path}/model", df, 0.5, ["id"]).collect()}
    assert here == pytest.approx(again) and len(here) == 240
    with pytest.raises(ValueError):
        ML.grouped_importance(fitted, df)


def test_kernel_classifier_beside_others_in_cross_validation(spark):
    configs = [ML.ModelConfig("svc", "weighted"), ML.ModelConfig("kernel_svc", "weighted", {"C": 100.0, "dims": 128})]
    found = ML.cross_validate(_rings(spark), {"xy": ["x", "y"]}, "target", "id", configs, k=2, thresholds=(0.5,)).collect()
    area = {(r["model"], r["fold"]): r["roc_auc"] for r in found}
    assert all(area["kernel_svc", f] > 0.99 > 0.8 > area["svc", f] for f in (1, 2))
