"""Evaluation of scored tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.functions import col

from ..operators import metrics as M
from ..operators.models import THRESHOLDS
from .aggregates import rounded
from .registry import query

SCORED = """(SELECT o_orderkey, o_orderstatus AS model, CAST(o_orderpriority IN ('1-URGENT', '2-HIGH') AS INTEGER) AS label,
    ((o_custkey * 37 + CASE WHEN o_orderpriority = '1-URGENT' THEN 30 ELSE 0 END) % 101) / 101.0::DOUBLE AS score,
    o_totalprice FROM orders)"""


def scored(t):
    bump = F.when(col("o_orderpriority") == "1-URGENT", 30).otherwise(0)
    return t.orders.select(
        "o_orderkey", col("o_orderstatus").alias("model"),
        col("o_orderpriority").isin("1-URGENT", "2-HIGH").cast("int").alias("label"),
        (((col("o_custkey") * 37 + bump) % 101) / F.lit(101.0)).alias("score"), "o_totalprice")


def counts_sql(t):
    return f"""COUNT(*) FILTER (label = 0 AND score < {t}) AS tn, COUNT(*) FILTER (label = 0 AND score >= {t}) AS fp,
        COUNT(*) FILTER (label = 1 AND score < {t}) AS fn, COUNT(*) FILTER (label = 1 AND score >= {t}) AS tp,
        COUNT(*) FILTER (score IS NULL) AS unscored"""


RATES = """round((tn + tp) / (tn + fp + fn + tp), 6) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
    round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1"""
RATE_COLS = ("accuracy", "precision", "recall", "f1")


@query("f08_cumulative_scores", f"""
    SELECT score, COUNT(*) FILTER (label = 1) AS pos, COUNT(*) FILTER (label = 0) AS neg,
           CAST(SUM(COUNT(*) FILTER (label = 1)) OVER (ORDER BY score DESC) AS BIGINT) AS cum_pos,
           CAST(SUM(COUNT(*) FILTER (label = 0)) OVER (ORDER BY score DESC) AS BIGINT) AS cum_neg
    FROM (SELECT label, round(score, 9) AS score FROM {SCORED}) GROUP BY score""")
def _(t):
    return M.cumulative_scores(scored(t).withColumn("score", F.round("score", 9)))


@query("p01_confusion", f"SELECT model, {counts_sql(0.5)} FROM {SCORED} GROUP BY model")
def _(t):
    return M.confusion(scored(t), 0.5, by=["model"])


@query("p02_binary_metrics", f"SELECT *, {RATES} FROM (SELECT model, {counts_sql(0.35)} FROM {SCORED} GROUP BY model)")
def _(t):
    return rounded(M.binary_metrics(scored(t), 0.35, by=["model"]), *RATE_COLS)


@query("p02b_binary_metrics_undefined", f"SELECT *, {RATES} FROM (SELECT {counts_sql(2.0)} FROM {SCORED})")
def _(t):
    return rounded(M.binary_metrics(scored(t), 2.0), *RATE_COLS)


PRED = f"(SELECT CAST(label AS VARCHAR) AS l, CAST(CAST(score >= 0.4 AS INTEGER) AS VARCHAR) AS p FROM {SCORED})"


@query("p03_classification_report", f"""
    WITH c AS (SELECT class, round(coalesce(h / nullif(g, 0), 0), 6) AS precision, round(coalesce(h / nullif(s, 0), 0), 6) AS recall,
        round(coalesce(2 * h / nullif(g + s, 0), 0), 6) AS f1, s AS support, h / nullif(g, 0) AS rp, h / nullif(s, 0) AS rr,
        2 * h / nullif(g + s, 0) AS rf FROM (SELECT class, COUNT(*) FILTER (l = class) AS s, COUNT(*) FILTER (p = class) AS g,
          COUNT(*) FILTER (l = class AND p = class) AS h FROM {PRED}, (SELECT DISTINCT l AS class FROM {PRED}) GROUP BY class))
    SELECT class, precision, recall, f1, support FROM c
    UNION ALL SELECT 'accuracy', round(avg(CAST(l = p AS INTEGER)), 6), round(avg(CAST(l = p AS INTEGER)), 6),
        round(avg(CAST(l = p AS INTEGER)), 6), COUNT(*) FROM {PRED}
    UNION ALL SELECT 'macro avg', round(avg(rp), 6), round(avg(rr), 6), round(avg(rf), 6), CAST(SUM(support) AS BIGINT) FROM c
    UNION ALL SELECT 'weighted avg', round(SUM(rp * support) / SUM(support), 6), round(SUM(rr * support) / SUM(support), 6),
        round(SUM(rf * support) / SUM(support), 6), CAST(SUM(support) AS BIGINT) FROM c""")
def _(t):
    df = scored(t).withColumn("prediction", (col("score") >= 0.4).cast("int"))
    return rounded(M.classification_report(df), "precision", "recall", "f1")


@query("p04_threshold_sweep", f"""
    SELECT model, threshold, tn, fp, fn, tp, unscored, {RATES} FROM (""" + " UNION ALL ".join(
    f"SELECT model, {t}::DOUBLE AS threshold, {counts_sql(t)} FROM {SCORED} GROUP BY model" for t in THRESHOLDS) + ")")
def _(t):
    return rounded(M.threshold_sweep(scored(t), THRESHOLDS, by=["model"]), *RATE_COLS)


AUC = """SELECT {by} round((SUM(r) FILTER (label = 1) - p * (p + 1) / 2) / (p * n), 6) AS roc_auc FROM (
    SELECT *, rank() OVER ({part} ORDER BY score) + (COUNT(*) OVER ({both} score) - 1) / 2 AS r,
           SUM(label) OVER ({part}) AS p, SUM(1 - label) OVER ({part}) AS n FROM {t}) GROUP BY {by} p, n"""


@query("p05_roc_auc", AUC.format(by="model,", part="PARTITION BY model", both="PARTITION BY model,", t=SCORED))
def _(t):
    return rounded(M.roc_auc(scored(t), by=["model"]), "roc_auc")


@query("p05b_roc_auc_continuous", AUC.format(by="", part="", both="PARTITION BY", t="""(SELECT
    CAST(l_returnflag = 'R' AS INTEGER) AS label, l_extendedprice AS score FROM lineitem)"""))
def _(t):
    df = t.lineitem.select((col("l_returnflag") == "R").cast("int").alias("label"), col("l_extendedprice").alias("score"))
    return rounded(M.roc_auc(df), "roc_auc")


CURVE = f"""(SELECT model, score, pos, neg, SUM(pos) OVER w AS cp, SUM(neg) OVER w AS cn,
    SUM(pos) OVER (PARTITION BY model) AS p, SUM(neg) OVER (PARTITION BY model) AS n FROM (
      SELECT model, score, COUNT(*) FILTER (label = 1) AS pos, COUNT(*) FILTER (label = 0) AS neg FROM {SCORED} GROUP BY ALL)
    WINDOW w AS (PARTITION BY model ORDER BY score DESC))"""


@query("p06_average_precision", f"""
    SELECT model, round(SUM(pos * cp / (cp + cn)) / max(p), 6) AS average_precision FROM {CURVE} GROUP BY model""")
def _(t):
    return rounded(M.average_precision(scored(t), by=["model"]), "average_precision")


@query("p07_roc_curve", f"""
    SELECT model, round(score, 6) AS threshold, round(cn / n, 6) AS fpr, round(cp / p, 6) AS tpr FROM {CURVE}
    UNION ALL SELECT model, 'inf'::DOUBLE, 0.0, 0.0 FROM {CURVE} GROUP BY model""")
def _(t):
    curve = rounded(M.roc_curve(scored(t), by=["model"]), "fpr", "tpr")
    return curve.withColumn("threshold", F.when(col("threshold") > 1, col("threshold")).otherwise(F.round("threshold", 6)))


FOLDS = f"""(SELECT model, o_orderkey % 5 + 1 AS fold, {counts_sql(0.4)} FROM {SCORED} GROUP BY ALL)"""


@query("p08_compare_models", f"""
    SELECT model, round(avg(coalesce(tp / nullif(tp + fn, 0), 0)), 6) AS recall,
           round(avg(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)), 6) AS f1,
           round(avg((tn + tp) / (tn + fp + fn + tp)), 6) AS accuracy FROM {FOLDS} GROUP BY model""")
def _(t):
    folds = M.binary_metrics(scored(t).withColumn("fold", col("o_orderkey") % 5 + 1), 0.4, by=["model", "fold"])
    return rounded(M.compare_models(folds, ["model"], ["recall", "f1", "accuracy"], ["recall", "f1", "accuracy"]),
                   "recall", "f1", "accuracy")


SWEEP = f"(SELECT *, {RATES} FROM (" + " UNION ALL ".join(
    f"SELECT model, {t}::DOUBLE AS threshold, {counts_sql(t)} FROM {SCORED} GROUP BY model" for t in (0.2, 0.3, 0.4)) + "))"


@query("p09_winner_rows", f"""
    SELECT model, threshold, recall, precision FROM {SWEEP} WHERE threshold = 0.3""")
def _(t):
    sweep = M.threshold_sweep(scored(t), (0.2, 0.3, 0.4), by=["model"]).select("model", "threshold", "recall", "precision")
    winners = scored(t).select("model").distinct().withColumn("threshold", F.lit(0.1) + F.lit(0.2))  # 0.30000000000000004
    out = M.winner_rows(sweep, winners, ["model"])
    return rounded(out, "threshold", "recall", "precision")


@query("p10_error_rows", f"""
    SELECT o_orderkey, label, CAST(score >= 0.4 AS INTEGER) AS prediction,
           CASE WHEN label = 0 THEN 'false_positive' ELSE 'false_negative' END AS error_kind FROM {SCORED}
    WHERE label <> CAST(score >= 0.4 AS INTEGER)""")
def _(t):
    return M.error_rows(scored(t), 0.4).select("o_orderkey", "label", "prediction", "error_kind")


WEIGHTS = """(SELECT l_returnflag AS model, p_brand AS variable, SUM(abs(l_tax - 0.04)) AS w FROM lineitem JOIN part
    ON l_partkey = p_partkey GROUP BY ALL)"""


def slots(t):
    """Signed slot weights per model and source variable."""
    joined = t.lineitem.join(t.part, col("l_partkey") == col("p_partkey"))
    return joined.select(col("l_returnflag").alias("model"), col("p_brand").alias("variable"),
                         (col("l_tax") - 0.04).alias("weight"))


@query("p11_group_importance", f"""
    SELECT model, variable, round(w / max(w) OVER (PARTITION BY model), 6) AS influence FROM {WEIGHTS}""")
def _(t):
    return rounded(M.group_importance(slots(t), by=["model"]), "influence")


INFLUENCE = f"(SELECT model, variable, w / max(w) OVER (PARTITION BY model) AS i FROM {WEIGHTS})"
TOP10 = f"""(SELECT variable, max(i) FILTER (model = 'A') AS A, max(i) FILTER (model = 'N') AS N, max(i) FILTER (model = 'R') AS R
    FROM {INFLUENCE} GROUP BY variable ORDER BY (A + N + R) DESC, variable LIMIT 10)"""


@query("p12_influence_matrix", f"""
    SELECT variable, round(A, 6) AS A, round(N, 6) AS N, round(R, 6) AS R, round((A + N + R) / 3, 6) AS mean FROM {TOP10}""")
def _(t):
    wide, _long = M.influence_matrix(M.group_importance(slots(t), by=["model"]), ["A", "N", "R"])
    return rounded(wide, "A", "N", "R", "mean")


@query("p12b_influence_long", f"""
    SELECT variable, unnest(['A', 'N', 'R']) AS model, round(unnest([A, N, R]), 6) AS influence FROM {TOP10}""")
def _(t):
    _wide, long = M.influence_matrix(M.group_importance(slots(t), by=["model"]), ["A", "N", "R"])
    return rounded(long, "influence")


RESULTS = f"""(SELECT feature_set, model, {RATES} FROM (SELECT 'top' || (o_orderkey % 4) AS feature_set, model, {counts_sql(0.3)}
    FROM {SCORED} GROUP BY ALL))"""


def results(t):
    df = scored(t).withColumn("feature_set", F.concat(F.lit("top"), col("o_orderkey") % 4))
    return rounded(M.binary_metrics(df, 0.3, by=["feature_set", "model"]), *RATE_COLS)


@query("p13_compare_feature_sets", f"""
    SELECT feature_set, model, f1, recall FROM (SELECT *, row_number() OVER (PARTITION BY feature_set
      ORDER BY f1 DESC, model) AS i FROM {RESULTS}) WHERE i = 1""")
def _(t):
    return M.compare_feature_sets(results(t), "feature_set", "f1", ["model"]).select("feature_set", "model", "f1", "recall")


@query("p13b_best_against_finalists", f"""
    SELECT * FROM (SELECT 'best baseline' AS model, f1, recall, precision FROM {RESULTS} WHERE feature_set = 'top0'
                   ORDER BY f1 DESC, recall DESC, precision DESC LIMIT 1)
    UNION ALL SELECT model || ' | ' || feature_set, f1, recall, precision FROM {RESULTS} WHERE feature_set <> 'top0'""")
def _(t):
    cols = ["model", "f1", "recall", "precision"]
    base = results(t).filter("feature_set = 'top0'").select(*cols)
    tuned = results(t).filter("feature_set <> 'top0'").withColumn(
        "model", F.concat_ws(" | ", "model", "feature_set")).select(*cols)
    return M.best_against_finalists(base, tuned, ["f1", "recall", "precision"], "best baseline")


@query("p14_top10_view", f"""
    SELECT feature_set AS scenario, CASE model WHEN 'F' THEN 'LogisticRegression' WHEN 'O' THEN 'DecisionTree' END AS model_family,
           model || '__smote' AS model_name, 'smote' AS strategy, 0.3::DOUBLE AS threshold, precision, recall, f1,
           accuracy AS roc_auc, accuracy AS pr_auc FROM {RESULTS} ORDER BY recall DESC, f1 DESC, precision DESC, feature_set, model
    LIMIT 10""")
def _(t):
    summary = results(t).withColumns({"strategy": F.lit("smote"), "threshold": F.lit(0.3), "roc_auc": col("accuracy"),
                                      "pr_auc": col("accuracy")})
    return M.top_models_view(summary, {"F": "LogisticRegression", "O": "DecisionTree"})


# ---------------------------------------------------------------- unscored rows

HOLES = f"""(SELECT * REPLACE (CASE WHEN o_orderkey % 10 NOT IN (3, 7) THEN score END AS score) FROM {SCORED})"""
RATED = f"(SELECT * FROM {HOLES} WHERE score IS NOT NULL)"


def holes(t):
    """Every fifth row is unscored: half of them null, half NaN."""
    gap = F.when(col("o_orderkey") % 10 == 7, F.lit(float("nan"))).when(col("o_orderkey") % 10 != 3, col("score"))
    return scored(t).withColumn("score", gap)


@query("p01b_confusion_unscored", f"SELECT model, {counts_sql(0.5)} FROM {HOLES} GROUP BY model")
def _(t):
    return M.confusion(holes(t), 0.5, by=["model"])


@query("p02c_binary_metrics_unscored", f"SELECT *, {RATES} FROM (SELECT model, {counts_sql(0.35)} FROM {HOLES} GROUP BY model)")
def _(t):
    return rounded(M.binary_metrics(holes(t), 0.35, by=["model"]), *RATE_COLS)


@query("p04b_threshold_sweep_unscored", f"""
    SELECT model, threshold, tn, fp, fn, tp, unscored, {RATES} FROM (""" + " UNION ALL ".join(
    f"SELECT model, {t}::DOUBLE AS threshold, {counts_sql(t)} FROM {HOLES} GROUP BY model" for t in THRESHOLDS) + ")")
def _(t):
    return rounded(M.threshold_sweep(holes(t), THRESHOLDS, by=["model"]), *RATE_COLS)


@query("p05c_roc_auc_unscored", AUC.format(by="model,", part="PARTITION BY model", both="PARTITION BY model,", t=RATED))
def _(t):
    return rounded(M.roc_auc(holes(t), by=["model"]), "roc_auc")


@query("p06b_average_precision_unscored", f"""
    SELECT model, round(SUM(pos * cp / (cp + cn)) / max(p), 6) AS average_precision FROM {CURVE.replace(SCORED, RATED)} GROUP BY model""")
def _(t):
    return rounded(M.average_precision(holes(t), by=["model"]), "average_precision")


@query("p07b_roc_curve_unscored", f"""
    SELECT model, round(score, 6) AS threshold, round(cn / n, 6) AS fpr, round(cp / p, 6) AS tpr FROM {CURVE.replace(SCORED, RATED)}
    UNION ALL SELECT model, 'inf'::DOUBLE, 0.0, 0.0 FROM {CURVE.replace(SCORED, RATED)} GROUP BY model""")
def _(t):
    curve = rounded(M.roc_curve(holes(t), by=["model"]), "fpr", "tpr")
    return curve.withColumn("threshold", F.when(col("threshold") > 1, col("threshold")).otherwise(F.round("threshold", 6)))


@query("p09b_winner_rows_listed_twice", f"SELECT model, threshold, recall, precision FROM {SWEEP} WHERE threshold = 0.3")
def _(t):
    sweep = M.threshold_sweep(scored(t), (0.2, 0.3, 0.4), by=["model"]).select("model", "threshold", "recall", "precision")
    winners = scored(t).select("model").distinct().withColumn("threshold", F.lit(0.1) + F.lit(0.2))
    return rounded(M.winner_rows(sweep.unionByName(sweep), winners, ["model"]), "threshold", "recall", "precision")


@query("p10b_error_rows_unscored", f"""
    SELECT o_orderkey, label, CAST(score >= 0.4 AS INTEGER) AS prediction,
           CASE WHEN label = 0 THEN 'false_positive' ELSE 'false_negative' END AS error_kind FROM {RATED}
    WHERE label <> CAST(score >= 0.4 AS INTEGER)""")
def _(t):
    return M.error_rows(holes(t), 0.4).select("o_orderkey", "label", "prediction", "error_kind")
