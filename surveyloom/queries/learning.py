"""Model data preparation, models, and their application."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F
from pyspark.sql.functions import col

from .. import plans
from ..operators import encode as E
from ..operators import models as M
from ..operators import prep as P
from ..operators.common import attach_scalars
from ..operators.stats import medians, mutual_info
from ..session import ensure_checkpoint_dir
from .aggregates import DOCS, labelled, rounded
from .registry import query

FEATURES = ["n_chars", "text_length", "quality", "lang", "source"]


def _quota_sql(table, y):
    """Exact stratified quota: floors of the shares, rest to the largest remainders."""
    return f"""(SELECT {y}, n, CAST(floor(x) AS BIGINT) + CAST(row_number() OVER (ORDER BY x - floor(x) DESC, CAST({y} AS VARCHAR))
        <= k - SUM(floor(x)) OVER () AS BIGINT) AS q FROM (SELECT {y}, COUNT(*) AS n, ceil(0.3 * SUM(COUNT(*)) OVER ()) AS k,
        ceil(0.3 * SUM(COUNT(*)) OVER ()) * COUNT(*) / SUM(COUNT(*)) OVER () AS x FROM {table} GROUP BY {y}))"""


@query("l01_stratified_split_counts", f"""
    SELECT toxic, q AS n_test, n - q AS n_train FROM {_quota_sql("labels", "toxic")}""")
def _(t):
    marked = P.stratified_split(t.labels, "toxic", 0.3, ["doc_id"])
    return marked.groupBy("toxic").agg(F.count_if(col("is_test") == 1).alias("n_test"),
                                       F.count_if(col("is_test") == 0).alias("n_train"))


@query("l01b_stratified_split_many_classes", f"""
    SELECT o_orderpriority, q AS n_test, n - q AS n_train FROM {_quota_sql("orders", "o_orderpriority")}""")
def _(t):
    marked = P.stratified_split(t.orders, "o_orderpriority", 0.3, ["o_orderkey"])
    return marked.groupBy("o_orderpriority").agg(F.count_if(col("is_test") == 1).alias("n_test"),
                                                 F.count_if(col("is_test") == 0).alias("n_train"))


@query("l02_stratified_folds_counts", """
    SELECT o_orderpriority, fold, COUNT(*) AS n FROM (SELECT o_orderpriority,
      CAST((row_number() OVER (ORDER BY o_orderpriority) - 1) % 5 + 1 AS INTEGER) AS fold FROM orders) GROUP BY ALL""")
def _(t):
    folded = P.stratified_folds(t.orders, "o_orderpriority", 5, ["o_orderkey"])
    return folded.groupBy("o_orderpriority", "fold").agg(F.count(F.lit(1)).alias("n"))


@query("l01c_stratified_split_class_per_customer", f"""
    SELECT o_custkey, q AS n_test, n - q AS n_train FROM {_quota_sql("orders", "o_custkey")}""")
def _(t):
    marked = P.stratified_split(t.orders, "o_custkey", 0.3, ["o_orderkey"])
    return marked.groupBy("o_custkey").agg(F.count_if(col("is_test") == 1).alias("n_test"),
                                           F.count_if(col("is_test") == 0).alias("n_train"))


@query("l02b_stratified_folds_class_per_customer", """
    SELECT o_custkey, fold, COUNT(*) AS n FROM (SELECT o_custkey,
      CAST((row_number() OVER (ORDER BY o_custkey) - 1) % 5 + 1 AS INTEGER) AS fold FROM orders) GROUP BY ALL""")
def _(t):
    folded = P.stratified_folds(t.orders, "o_custkey", 5, ["o_orderkey"])
    return folded.groupBy("o_custkey", "fold").agg(F.count(F.lit(1)).alias("n"))


GAPS = """(SELECT doc_id, CASE WHEN doc_id % 7 <> 0 THEN n_chars END AS n_chars, nullif(source, 'src3') AS source
    FROM documents)"""


def gaps(t):
    return t.documents.select("doc_id", F.when(col("doc_id") % 7 != 0, col("n_chars")).alias("n_chars"),
                              F.nullif("source", F.lit("src3")).alias("source"))


@query("l04_impute_learned_on_train", f"""
    WITH tr AS (SELECT * FROM {GAPS} WHERE doc_id % 3 <> 0)
    SELECT doc_id, coalesce(CAST(n_chars AS DOUBLE), (SELECT quantile_cont(CAST(n_chars AS DOUBLE), 0.5) FROM tr)) AS n_chars,
           coalesce(source, (SELECT source FROM tr WHERE source IS NOT NULL GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1)) AS source
    FROM {GAPS} WHERE doc_id % 3 = 0""")
def _(t):
    df = gaps(t)
    fill = P.fit_imputers(df.filter("doc_id % 3 <> 0"), ["n_chars"], ["source"])
    return P.impute(df.filter("doc_id % 3 = 0"), fill)


@query("l05_one_hot_unseen_is_zero", f"""
    SELECT doc_id, CAST(source IN (SELECT source FROM {GAPS} WHERE doc_id % 3 <> 0 AND source < 'src15') AS INTEGER) AS ones,
           (SELECT COUNT(DISTINCT source) FROM {GAPS} WHERE doc_id % 3 <> 0 AND source < 'src15') AS slots
    FROM {GAPS} WHERE source IS NOT NULL""")
def _(t):
    from pyspark.ml.functions import vector_to_array

    df = gaps(t).filter("source IS NOT NULL")
    fitted = M.fit_preprocessor(df.filter("doc_id % 3 <> 0 AND source < 'src15'"), [], ["source"])
    hot = fitted.transform(df).select("doc_id", vector_to_array("features").alias("v"))
    return hot.select("doc_id", F.aggregate("v", F.lit(0.0), lambda a, x: a + x).cast("int").alias("ones"),
                      F.size("v").cast("bigint").alias("slots"))


@query("l05b_one_hot_level_per_customer", """
    WITH known AS (SELECT DISTINCT c_name FROM customer WHERE c_custkey % 3 <> 0 AND c_name IS NOT NULL),
         coded AS (SELECT c_name, row_number() OVER (ORDER BY c_name) - 1 AS code FROM known)
    SELECT c_custkey, code, (SELECT COUNT(*) FROM known) AS slots FROM customer LEFT JOIN coded USING (c_name)""")
def _(t):
    """A level per customer: the dictionary stays a table and meets the rows by join."""
    customers = t.customer.select("c_custkey", "c_name")
    encoder = E.fit_encoder(customers.filter("c_custkey % 3 <> 0"), [], ["c_name"])
    return E.with_codes(customers, encoder.levels, ["c_name"], "_code").select(
        "c_custkey", col("c_name_code").alias("code"), F.lit(encoder.sizes["c_name"]).cast("bigint").alias("slots"))


@query("l06_standard_scale", """
    SELECT l_orderkey, l_linenumber, l_partkey,
           round((l_quantity - avg(l_quantity) OVER ()) / stddev_pop(l_quantity) OVER (), 6) AS l_quantity_scaled,
           round((l_tax - avg(l_tax) OVER ()) / stddev_pop(l_tax) OVER (), 6) AS l_tax_scaled FROM lineitem""")
def _(t):
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_tax")
    out = P.standard_scale(li, ["l_quantity", "l_tax"]).drop("l_quantity", "l_tax")
    return rounded(out, "l_quantity_scaled", "l_tax_scaled")


@query("l07_class_weights", """
    SELECT doc_id, toxic, round((SELECT COUNT(*) FROM labels) / (2 * COUNT(*) OVER (PARTITION BY toxic)), 6) AS class_weight
    FROM labels""")
def _(t):
    return rounded(P.class_weights(t.labels.select("doc_id", "toxic"), "toxic"), "class_weight")


@query("l07b_positive_weight", """
    SELECT round(COUNT(*) FILTER (toxic = 0) / COUNT(*) FILTER (toxic = 1), 6) AS positive_weight FROM labels""")
def _(t):
    return rounded(P.positive_weight(t.labels, "toxic"), "positive_weight")


def _minority(t):
    return t.embeddings.select("vec_id", col("embedding").cast("array<double>").alias("v"),
                               (col("label") == 3).cast("int").alias("y"))


@query("l08_smote_balance", """
    SELECT COUNT(*) FILTER (label <> 3) - COUNT(*) FILTER (label = 3) AS n_synthetic, CAST(0 AS BIGINT) AS off_segment
    FROM embeddings""")
def _(t):
    """Classes become equal, and every synthetic row lies between a minority row
    and one of its nearest minority neighbours."""
    df = _minority(t)
    made = P.smote(df, "y", "vec_id", "v", k=5)
    a = df.filter("y = 1").select("vec_id", col("v").alias("xa"))
    b = df.filter("y = 1").select(col("vec_id").alias("neighbour_id"), col("v").alias("xb"))
    on_line = F.zip_with(F.zip_with("xa", "xb", lambda x, y: x + col("fraction") * (y - x)), "v", lambda p, q: F.abs(p - q))
    checked = made.join(a, "vec_id").join(b, "neighbour_id").withColumn("gap", F.array_max(on_line))
    return checked.agg(F.count(F.lit(1)).alias("n_synthetic"), F.count_if(
        (col("gap") > 1e-9) | (col("fraction") < 0) | (col("fraction") >= 1)).alias("off_segment"))


@query("l09_feature_set_table", """
    WITH f AS (SELECT p_brand || '/' || p_type AS variable, max(p_size) > 48 AS is_engineered,
                      min(p_size) < 2 AND NOT max(p_size) > 48 AS leaks FROM part GROUP BY 1)
    SELECT 'full' AS feature_set, variable FROM f WHERE NOT is_engineered
    UNION ALL SELECT 'full_plus_engineered', variable FROM f
    UNION ALL SELECT 'no_leakage', variable FROM f WHERE NOT is_engineered AND NOT leaks
    UNION ALL SELECT 'no_leakage_plus_engineered', variable FROM f WHERE is_engineered OR NOT leaks""")
def _(t):
    f = t.part.groupBy(F.concat_ws("/", "p_brand", "p_type").alias("variable")).agg(
        (F.max("p_size") > 48).alias("is_engineered"), (F.min("p_size") < 2).alias("low"))
    return P.feature_set_table(f.select("variable", "is_engineered"), f.filter("low AND NOT is_engineered"))


@query("l10_build_xy", f"""
    SELECT doc_id, n_chars, lang, toxic FROM (SELECT doc_id, n_chars, lang,
      CASE WHEN doc_id % 4 <> 0 THEN toxic END AS toxic FROM {DOCS}) WHERE toxic IS NOT NULL""")
def _(t):
    df = labelled(t).withColumn("toxic", F.when(col("doc_id") % 4 != 0, col("toxic")))
    return P.build_xy(df, ["n_chars", "lang", "absent"], "toxic", keep=["doc_id"])[0]


@query("l10b_build_xy_audit", f"""
    SELECT COUNT(*) AS rows_before, COUNT(*) FILTER (doc_id % 4 = 0) AS null_targets, COUNT(*) FILTER (doc_id % 4 = 1 AND lang = 'fr')
      AS unreadable_targets, COUNT(*) FILTER (doc_id % 4 <> 0 AND NOT coalesce(doc_id % 4 = 1 AND lang = 'fr', false)) AS rows_after,
      'n_chars,text_length' AS numeric_features, 'lang,source' AS other_features FROM {DOCS}""")
def _(t):
    """What was dropped for lack of a target, and how the features were split."""
    target = F.when((col("doc_id") % 4 == 1) & (col("lang") == "fr"), "unknown").when(col("doc_id") % 4 != 0, col("toxic").cast("string"))
    _, audit, numeric, other = P.build_xy(labelled(t).withColumn("toxic", target), ["n_chars", "lang", "text_length", "absent", "source"], "toxic")
    return audit.withColumns({"numeric_features": F.lit(",".join(numeric)), "other_features": F.lit(",".join(other))})


# ---------------------------------------------------------------- models

# Fitted values on many features have no SQL. What has: the rows that are scored, the
# range of a score, and the counts every confusion matrix must add up to. On one
# yes/no feature the fitted values have closed forms; see below.
SCORED_ROWS = """SELECT doc_id, toxic, true AS in_range FROM documents JOIN labels USING (doc_id)"""


def _scores(t, name, strategy="weighted"):
    df = labelled(t)
    fitted = M.make_pipeline(df, FEATURES, "toxic", "doc_id", M.ModelConfig(name, strategy))
    scored = M.predict_scores(fitted, df, ["doc_id", "toxic"])
    return scored.select("doc_id", "toxic", F.coalesce(col("score").between(0, 1), F.lit(False)).alias("in_range"))


@query("m01_logistic_scores", SCORED_ROWS)
def _(t):
    return _scores(t, "logistic")


@query("m02_tree_scores", SCORED_ROWS)
def _(t):
    return _scores(t, "tree")


@query("m03_forest_scores", SCORED_ROWS)
def _(t):
    return _scores(t, "forest")


@query("m04_gbt_scores", SCORED_ROWS)
def _(t):
    return _scores(t, "gbt")


@query("m05_svc_scores", SCORED_ROWS)
def _(t):
    return _scores(t, "svc")


@query("m06_pipeline_with_smote", SCORED_ROWS)
def _(t):
    return _scores(t, "logistic", "smote")


# One yes/no feature (English or not; missing and NaN are filled by the median): a model
# without penalty, or one tree over it, gives each side the share of its positives.
ENGLISH = """(SELECT doc_id, toxic, CASE WHEN lang = 'en' THEN 1 ELSE 0 END AS english
    FROM documents JOIN labels USING (doc_id))"""
RATE = f"""SELECT doc_id, round(avg(toxic) OVER (PARTITION BY english), 5) AS score FROM {ENGLISH}"""
BALANCED_RATE = f"""SELECT doc_id, round(p / (p + n), 5) AS score FROM (SELECT doc_id,
    SUM(toxic) OVER (PARTITION BY english) / SUM(toxic) OVER () AS p,
    SUM(1 - toxic) OVER (PARTITION BY english) / SUM(1 - toxic) OVER () AS n FROM {ENGLISH})"""
BOTH_CLASSES = {"maxIter": 3000, "regParam": 0.0, "tol": 1e-12}


def _one_flag(t, name, strategy, params):
    """Scores of a model on the one feature, which is numeric with holes: most documents
    are English, so the null or NaN of a quarter of them is filled with 1."""
    held = F.when(col("doc_id") % 8 == 1, F.lit(float("nan"))).when(col("doc_id") % 8 != 3, F.lit(1.0))
    df = labelled(t).select("doc_id", "toxic", F.when(col("lang") == "en", held).otherwise(F.lit(0.0)).alias("english"))
    fitted = M.make_pipeline(df, ["english"], "toxic", "doc_id", M.ModelConfig(name, strategy, params))
    return rounded(M.predict_scores(fitted, df, ["doc_id"]), "score", digits=5)


@query("m01b_logistic_is_the_rate", RATE)
def _(t):
    return _one_flag(t, "logistic", "plain", BOTH_CLASSES)


@query("m01c_weighted_logistic_is_the_balanced_rate", BALANCED_RATE)
def _(t):
    return _one_flag(t, "logistic", "weighted", BOTH_CLASSES)


# Spark merges leaves that predict the same class, so a tree shows the share of each side
# only where the sides predict different classes, as they do with balanced ones.
@query("m02b_weighted_tree_is_the_balanced_rate", BALANCED_RATE)
def _(t):
    return _one_flag(t, "tree", "weighted", {"maxDepth": 1, "minInstancesPerNode": 1})


@query("m02c_positive_weight_tree_is_the_balanced_rate", BALANCED_RATE)
def _(t):
    return _one_flag(t, "tree", "positive_weight", {"maxDepth": 1, "minInstancesPerNode": 1})


@query("m03b_one_tree_forest_is_the_balanced_rate", BALANCED_RATE)
def _(t):
    return _one_flag(t, "forest", "weighted", {"numTrees": 1, "bootstrap": False, "maxDepth": 1, "minInstancesPerNode": 1,
                                            "featureSubsetStrategy": "all"})


@query("m04b_one_boosting_round", f"""
    SELECT doc_id, round(1 / (1 + exp(-2 * (2 * avg(toxic) OVER (PARTITION BY english) - 1))), 5) AS score FROM {ENGLISH}""")
def _(t):
    """The first round fits the mean of -1 and 1; the score is the logistic of twice it."""
    return _one_flag(t, "gbt", "plain", {"maxIter": 1, "maxDepth": 1, "subsamplingRate": 1.0, "featureSubsetStrategy": "all"})


@query("m05b_svc_orders_the_sides", f"""
    SELECT doc_id, CASE WHEN rate > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS score FROM (SELECT doc_id, p / (p + n) AS rate FROM (
        SELECT doc_id, SUM(toxic) OVER (PARTITION BY english) / SUM(toxic) OVER () AS p,
        SUM(1 - toxic) OVER (PARTITION BY english) / SUM(1 - toxic) OVER () AS n FROM {ENGLISH}))""")
def _(t):
    """With balanced classes the margin's two values lie on either side of zero."""
    return _one_flag(t, "svc", "weighted", {})


# Two rings: points of the first two components are drawn half way to the centre within
# the median radius, and moved half as far again outwards beyond it. No line parts them.
RADII = """(SELECT vec_id, sqrt(CAST(embedding[1] AS DOUBLE) * embedding[1] + CAST(embedding[2] AS DOUBLE) * embedding[2]) AS r
    FROM embeddings)"""


@query("m05c_kernel_svc_parts_rings", f"""
    SELECT vec_id, CASE WHEN r > m THEN 1 ELSE 0 END AS outer_ring, CASE WHEN r > m THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction,
      true AS line_fails FROM (SELECT *, quantile_cont(r, 0.5) OVER () AS m FROM {RADII})""")
def _(t):
    """The kernel classifier gives every row its ring; the linear one misses a quarter of them or more."""
    x, y = (col("embedding")[i].cast("double") for i in (0, 1))
    points = t.embeddings.select("vec_id", x.alias("x"), y.alias("y"), F.sqrt(x * x + y * y).alias("r"))
    middle = medians(points, ["r"])["r"]
    rings = points.withColumn("outer_ring", (col("r") > middle).cast("int"))
    moved = F.when(col("outer_ring") == 1, 1.5).otherwise(0.5)
    rings = rings.select("vec_id", (col("x") * moved).alias("x"), (col("y") * moved).alias("y"), "outer_ring")

    def sides(name, params):
        fitted = M.make_pipeline(rings, ["x", "y"], "outer_ring", "vec_id", M.ModelConfig(name, "weighted", params))
        return fitted.transform(rings).select("vec_id", "outer_ring", "prediction")

    line = sides("svc", {}).agg((F.avg((col("prediction") != col("outer_ring")).cast("double")) >= 0.25).alias("line_fails"))
    return attach_scalars(sides("kernel_svc", {"C": 100.0}), line)


@query("m07_scaled_margin", """
    SELECT o_orderkey, round((o_totalprice - min(o_totalprice) OVER ()) / (max(o_totalprice) OVER () - min(o_totalprice) OVER ()
           + 1e-9), 6) AS score FROM orders""")
def _(t):
    return rounded(P.min_max_scale(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", "score"), "score").drop(
        "o_totalprice")


def _checked(df, *keys):
    """Counts of the confusion matrix, and whether all metrics follow from them."""
    def same(metric, value):
        return F.abs(col(metric) - F.coalesce(value, F.lit(0.0))) < 1e-9

    tp, fp, fn, tn = (col(c) for c in ("tp", "fp", "fn", "tn"))
    fine = (same("precision", F.try_divide(tp, tp + fp)) & same("recall", F.try_divide(tp, tp + fn))
            & same("f1", F.try_divide(2 * tp, 2 * tp + fp + fn)) & same("accuracy", F.try_divide(tp + tn, tp + tn + fp + fn))
            & col("roc_auc").between(0, 1) & col("pr_auc").between(0, 1))
    return df.select(*keys, "threshold", (tp + fn).alias("positives"), (tn + fp).alias("negatives"), fine.alias("consistent"))


def _thresholds(values):
    return "(SELECT unnest([" + ", ".join(f"{v}::DOUBLE" for v in values) + "]) AS threshold)"


TWO_FOLDS = """(SELECT fold, COUNT(*) FILTER (toxic = 1) AS positives, COUNT(*) FILTER (toxic = 0) AS negatives FROM (
    SELECT toxic, CAST((row_number() OVER (ORDER BY toxic) - 1) % 2 + 1 AS INTEGER) AS fold FROM labels) GROUP BY fold)"""
HOLD_OUT = f"""(SELECT max(q) FILTER (toxic = 1) AS positives, max(q) FILTER (toxic = 0) AS negatives
    FROM {_quota_sql("labels", "toxic")})"""


SETS = {"full": FEATURES, "no_leakage": ["n_chars", "text_length", "lang"]}


@query("m08_cross_validate", f"""
    SELECT s AS feature_set, fold, m AS model, w AS strategy, threshold, positives, negatives, true AS consistent
    FROM (SELECT unnest({list(SETS)}) AS s), (SELECT unnest(['logistic', 'tree']) AS m), (SELECT unnest(['weighted']) AS w),
         {TWO_FOLDS}, {_thresholds(M.THRESHOLDS)}""")
def _(t):
    configs = [M.ModelConfig(m, "weighted") for m in ("logistic", "tree")]
    return _checked(M.cross_validate(labelled(t), SETS, "toxic", "doc_id", configs, k=2), "feature_set", "fold", "model", "strategy")


@query("m09_grid_search", f"""
    SELECT model, strategy, n_configurations, threshold, positives, negatives, true AS consistent
    FROM (VALUES ('logistic', 3)) AS v(model, n_configurations), (SELECT unnest(['plain', 'weighted']) AS strategy),
         {HOLD_OUT}, {_thresholds(M.GRID_THRESHOLDS)}""")
def _(t):
    """The linear part of the grid, every configuration of it."""
    found = M.grid_search(labelled(t), ["n_chars", "text_length", "lang"], "toxic", "doc_id", M.parameter_grid(tree=False, forest=False, gbt=False))
    each = _checked(found, "model", "strategy", "configuration")
    return each.groupBy("model", "strategy", "threshold", "positives", "negatives").agg(
        F.count_distinct("configuration").cast("int").alias("n_configurations"), F.bool_and("consistent").alias("consistent"))


# The same three over the whole of their job; those above and below are parts of it.
FIVE_FOLDS = """(SELECT fold, COUNT(*) FILTER (toxic = 1) AS positives, COUNT(*) FILTER (toxic = 0) AS negatives FROM (
    SELECT toxic, CAST((row_number() OVER (ORDER BY toxic) - 1) % 5 + 1 AS INTEGER) AS fold FROM labels) GROUP BY fold)"""
FOUR_SETS = P.feature_sets(["n_chars", "lang", "source", "quality"], [*FEATURES, "text_per_char"], ["quality"], ["text_per_char"])


@query("m08b_cross_validate_four_sets_five_folds", f"""
    SELECT s AS feature_set, fold, m AS model, w AS strategy, threshold, positives, negatives, true AS consistent
    FROM (SELECT unnest({list(FOUR_SETS)}) AS s), (SELECT unnest(['logistic', 'tree']) AS m), (SELECT unnest(['weighted']) AS w),
         {FIVE_FOLDS}, {_thresholds(M.THRESHOLDS)}""")
def _(t):
    df = labelled(t).withColumn("text_per_char", F.try_divide("text_length", "n_chars"))
    configs = [M.ModelConfig(m, "weighted") for m in ("logistic", "tree")]
    return _checked(M.cross_validate(df, FOUR_SETS, "toxic", "doc_id", configs, k=5), "feature_set", "fold", "model", "strategy")


@query("m08c_cross_validate_whole_benchmark", f"""
    SELECT s AS feature_set, fold, m AS model, w AS strategy, threshold, positives, negatives, true AS consistent
    FROM (SELECT unnest({list(FOUR_SETS)}) AS s), (SELECT unnest(['logistic', 'tree', 'forest', 'gbt', 'svc']) AS m),
         (SELECT unnest(['weighted', 'smote']) AS w), {FIVE_FOLDS}, {_thresholds(M.THRESHOLDS)}""")
def _(t):
    """All five models under both strategies: 200 fits."""
    df = labelled(t).withColumn("text_per_char", F.try_divide("text_length", "n_chars"))
    found = M.cross_validate(df, FOUR_SETS, "toxic", "doc_id", plans.BENCHMARK_CONFIGS, k=5)
    return _checked(found, "feature_set", "fold", "model", "strategy")


@query("m09b_grid_search_whole", f"""
    SELECT model, strategy, n_configurations, threshold, positives, negatives, true AS consistent
    FROM (VALUES ('logistic', 'plain', 3), ('logistic', 'weighted', 3), ('tree', 'plain', 12), ('tree', 'weighted', 12),
                 ('forest', 'plain', 12), ('forest', 'weighted', 12), ('gbt', 'plain', 8), ('gbt', 'positive_weight', 8))
            AS v(model, strategy, n_configurations), {HOLD_OUT}, {_thresholds(M.GRID_THRESHOLDS)}""")
def _(t):
    """All 70 configurations of the grid."""
    found = M.grid_search(labelled(t), ["n_chars", "text_length", "lang"], "toxic", "doc_id", M.parameter_grid())
    each = _checked(found, "model", "strategy", "configuration")
    return each.groupBy("model", "strategy", "threshold", "positives", "negatives").agg(
        F.count_distinct("configuration").cast("int").alias("n_configurations"), F.bool_and("consistent").alias("consistent"))


@query("m10_evaluate_winner", f"""
    SELECT 'logistic' AS model, 0.4::DOUBLE AS threshold, positives, negatives, true AS consistent FROM {HOLD_OUT}""")
def _(t):
    return _checked(M.evaluate_winner(labelled(t), FEATURES, "toxic", "doc_id", M.ModelConfig("logistic", "weighted"),
                                      0.4)[1], "model")


@query("m10b_winner_report_supports", f"""
    SELECT class, support FROM (SELECT unnest([('0', negatives), ('1', positives), ('accuracy', positives + negatives),
      ('macro avg', positives + negatives), ('weighted avg', positives + negatives)]) AS x, x[1] AS class, x[2] AS support FROM {HOLD_OUT})""")
def _(t):
    """The report per class of the winner on the hold-out."""
    found = M.evaluate_winner(labelled(t), FEATURES, "toxic", "doc_id", M.ModelConfig("tree", "weighted"), 0.5)
    return found[4].select("class", col("support").cast("bigint").alias("support"))


@query("m10c_winner_errors_add_up", """
    SELECT kind AS error_kind, true AS as_counted, true AS profiled FROM (SELECT unnest(['false_positive', 'false_negative']) AS kind), (
        SELECT COUNT(*) AS n FROM labels) WHERE n > 0""")
def _(t):
    """Misclassified rows of the winner are as many as its matrix says, and each kind that
    occurs has a profile."""
    _, metrics, errors, profile, _ = M.evaluate_winner(labelled(t), FEATURES, "toxic", "doc_id", M.ModelConfig("tree", "weighted"), 0.5)
    kinds = metrics.select(F.explode(F.array(F.struct(F.lit("false_positive").alias("error_kind"), col("fp").alias("n")),
                                             F.struct(F.lit("false_negative").alias("error_kind"), col("fn").alias("n")))).alias("_k")).select("_k.*")
    rows = errors.groupBy("error_kind").agg(F.count(F.lit(1)).alias("rows"))
    named = profile.groupBy("error_kind").agg(F.count_if(col("mean").isNotNull() | col("mode").isNotNull()).alias("values"))
    joined = kinds.join(rows, "error_kind", "left").join(named, "error_kind", "left").na.fill(0, ["rows", "values"])
    return joined.select("error_kind", (col("rows") == col("n")).alias("as_counted"), ((col("values") > 0) == (col("n") > 0)).alias("profiled"))


@query("m11_export_models", """
    SELECT alias, model, strategy, threshold, n_features, COUNT(*) AS n_rows_trained, CAST(0 AS BIGINT) AS target_null_rows_dropped
    FROM labels, (VALUES ('radar', 'logistic', 'weighted', 0.2::DOUBLE, 5), ('plain', 'tree', 'plain', 0.5::DOUBLE, 5))
      AS v(alias, model, strategy, threshold, n_features) GROUP BY ALL""")
def _(t):
    folder = f"{ensure_checkpoint_dir(t._spark)}/models-{uuid.uuid4().hex}"
    return M.export_models(labelled(t), FEATURES, "toxic", "doc_id", [
        ("radar", M.ModelConfig("logistic", "weighted"), 0.2), ("plain", M.ModelConfig("tree"), 0.5)], folder).drop("path")


# Alias, configuration and threshold of each exported model; both boosters of the survey
# are gbt. The inventory lists the strategy each is fitted with: the baseline's estimators
# have no class weights there, although its own list calls them weighted.
EXPORTS = [
    ("LR-30", M.ModelConfig("logistic", "plain", {"maxIter": 1000}), 0.5),
    ("RF-30", M.ModelConfig("forest", "plain", {"numTrees": 100, "maxDepth": 30, "minInstancesPerNode": 1}), 0.5),
    ("XGB-30", M.ModelConfig("gbt", "plain", {"maxDepth": 6}), 0.5),
    ("RADAR MAX", M.ModelConfig("logistic", "smote"), 0.2),
    ("XGB BALANCE", M.ModelConfig("gbt", "positive_weight"), 0.4),
    ("LGBM PRECISO", M.ModelConfig("gbt", "smote"), 0.35),
]


@query("m11b_export_models_whole", """
    SELECT alias, model, strategy, threshold, n_features, COUNT(*) AS n_rows_trained, CAST(0 AS BIGINT) AS target_null_rows_dropped
    FROM labels, (VALUES ('LR-30', 'logistic', 'plain', 0.5::DOUBLE, 5), ('RF-30', 'forest', 'plain', 0.5::DOUBLE, 5),
        ('XGB-30', 'gbt', 'plain', 0.5::DOUBLE, 5), ('RADAR MAX', 'logistic', 'smote', 0.2::DOUBLE, 5),
        ('XGB BALANCE', 'gbt', 'positive_weight', 0.4::DOUBLE, 5), ('LGBM PRECISO', 'gbt', 'smote', 0.35::DOUBLE, 5))
      AS v(alias, model, strategy, threshold, n_features) GROUP BY ALL""")
def _(t):
    folder = f"{ensure_checkpoint_dir(t._spark)}/models-{uuid.uuid4().hex}"
    return M.export_models(labelled(t), FEATURES, "toxic", "doc_id", EXPORTS, folder).drop("path")


@query("m12_saved_model_scores_whole_table", """
    SELECT COUNT(*) AS n_rows, CAST(0 AS BIGINT) AS differing FROM documents""")
def _(t):
    """A saved pipeline, loaded again, scores every document as the one in memory."""
    train = labelled(t)
    cfg = M.ModelConfig("logistic", "weighted")
    fitted = M.make_pipeline(train, ["n_chars", "text_length", "lang"], "toxic", "doc_id", cfg)
    path = f"{ensure_checkpoint_dir(t._spark)}/model-{uuid.uuid4().hex}"
    fitted.write().save(path)
    docs = t.documents.select("doc_id", "lang", "n_chars", F.length("text").cast("bigint").alias("text_length"))
    here = M.score_table(fitted, docs, 0.2, ["doc_id"])
    again = M.score_table(PipelineModel.load(path), docs, 0.2, ["doc_id"]).withColumnsRenamed(
        {"score": "score2", "prediction": "prediction2"})
    return here.join(again, "doc_id").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(
        (F.abs(col("score") - col("score2")) > 1e-9) | (col("prediction") != col("prediction2"))).alias("differing"))


NAMES = "(SELECT unnest([" + ", ".join(f"'{c}'" for c in FEATURES) + "]) AS variable)"


@query("k09_rf_importance", f"""
    SELECT variable, true AS in_range, true AS rank_is_mean FROM {NAMES}, (SELECT COUNT(*) AS n FROM labels) WHERE n > 0""")
def _(t):
    forest = M.rf_importance(labelled(t), FEATURES, "toxic", "doc_id")
    mutual = mutual_info(labelled(t), ["lang", "source", "quality"], ["n_chars", "text_length"], "toxic")
    ranked = M.rank_by_two_scores(mutual, forest)
    return ranked.select("variable", col("rf_importance").between(0, 1).alias("in_range"), (
        col("mean_rank") * 2 == col("rank_mutual_info") + col("rank_rf_importance")).alias("rank_is_mean"))


@query("p11b_model_influence", f"""
    SELECT variable, true AS in_range, true AS scaled_to_one FROM {NAMES}, (SELECT COUNT(*) AS n FROM labels) WHERE n > 0""")
def _(t):
    df = labelled(t)
    fitted = M.make_pipeline(df, FEATURES, "toxic", "doc_id", M.ModelConfig("logistic", "weighted"))
    out = M.grouped_importance(fitted, df)
    return attach_scalars(out, out.agg(F.max("influence").alias("top"))).select(
        "variable", col("influence").between(0, 1).alias("in_range"), (col("top") == 1).alias("scaled_to_one"))


@query("m13_benchmark_run", f"""
    SELECT objective, positives, negatives, true AS consistent, 0 AS target_null_rows_dropped, positives_all + negatives_all AS n_rows_trained
    FROM (SELECT unnest(['most_detection', 'best_balance', 'no_leakage']) AS objective), {HOLD_OUT},
         (SELECT COUNT(*) FILTER (toxic = 1) AS positives_all, COUNT(*) FILTER (toxic = 0) AS negatives_all FROM labels)""")
def _(t):
    """Sets, folds, means, winners, hold-out and export as one run of two models; any
    precision will do, so that every objective has a winner."""
    folder = f"{ensure_checkpoint_dir(t._spark)}/models-{uuid.uuid4().hex}"
    done = plans.run_benchmark(labelled(t), SETS, "toxic", "doc_id", ["no_leakage"], [M.ModelConfig("logistic", "weighted"), M.ModelConfig("tree", "weighted")],
                               folder, k=2, min_precision=0.0).tables
    sides = done["exports"].select(col("alias").alias("objective"), col("target_null_rows_dropped").cast("int").alias("target_null_rows_dropped"),
                                   "n_rows_trained")
    return _checked(done["holdout"], "objective").drop("threshold").join(sides, "objective")
