"""Classifiers, cross-validation, tuning, export and whole-table scoring.

All fitting is Spark ML. Where an estimator differs from the usual single-node
one the difference is stated: gradient boosting is ``GBTClassifier`` and the
support-vector classifier is linear, on the features themselves (``svc``) or on random
Fourier features of a Gaussian kernel (``kernel_svc``).
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LinearSVC,
    LogisticRegression,
)
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .boosting import PART_ROWS, Boosting, Forest, first_rounds, fit_boosted
from .common import attach_scalars, join_keys, numeric_columns
from .kernel import KERNEL_FEATURES, KernelFeatures, scale_gamma
from .metrics import (
    classification_report,
    confusion,
    curve_areas,
    error_rows,
    group_importance,
    reaches,
    threshold_sweep,
)
from .ordered import mean_rank
from .prep import class_weights, fit_imputers, min_max_scale, positive_weight, smote, stratified_folds, stratified_split
from .profile import error_profile

# Thresholds swept by the benchmark and by the grid search.
THRESHOLDS = (0.20, 0.25, 0.30, 0.35, 0.40, 0.45, 0.50)
GRID_THRESHOLDS = (0.30, 0.35, 0.40, 0.45, 0.50)
SEED = 42


@dataclass(frozen=True)
class ModelConfig:
    """An estimator by name with its parameters, the imbalance strategy (``plain``,
    ``weighted``: balanced classes, ``positive_weight``: negatives per positive on the
    positives, ``smote``) and how its numeric columns are scaled."""

    name: str
    strategy: str = "plain"
    params: Mapping[str, object] = field(default_factory=dict)
    scale: bool = True
    with_mean: bool = True

    def __hash__(self) -> int:
        return hash(self.label)

    @property
    def label(self) -> str:
        extra = "".join(f"__{k}_{v}" for k, v in sorted(self.params.items()))
        return f"{self.name}__{self.strategy}{extra}"


def model(name: str, features: str = "features", label: str = "label", weight: str | None = None,
          total_weight: float | None = None, **params) -> Estimator:
    """A classifier with the benchmark's defaults; ``params`` overrides them.

    The penalty of the linear models is given as ``C`` (1 by default), the weight of
    the summed loss against half the squared coefficients. Spark averages the loss,
    so its own parameter is 1 / (C * ``total_weight``), the summed weight of the rows;
    ``regParam`` states it directly instead.
    """
    base = {"featuresCol": features, "labelCol": label}
    if weight:
        base["weightCol"] = weight
    if name in ("logistic", "svc"):
        penalty = float(params.pop("C", 1.0))
        if "regParam" not in params:
            if not total_weight:
                raise ValueError("a penalty given as C needs the weight of the training rows")
            params["regParam"] = 1.0 / (penalty * total_weight)
        # the hinge loss has corners, where steps go on long after the decision is settled
        linear, limits = (LogisticRegression, {"maxIter": 3000}) if name == "logistic" else (LinearSVC, {"maxIter": 100, "tol": 1e-3})
        made = linear(**{**limits, "standardization": False, **base, **params})
    elif name == "tree":
        made = DecisionTreeClassifier(**{"maxDepth": 5, "minInstancesPerNode": 10, "seed": SEED, **base, **params})
    elif name == "forest":
        made = Forest(**{"numTrees": 300, "maxDepth": 6, "minInstancesPerNode": 5, "seed": SEED, **base, **params})
    elif name == "gbt":
        made = Boosting(**{"maxIter": 300, "maxDepth": 5, "stepSize": 0.05, "subsamplingRate": 0.9,
                           "featureSubsetStrategy": "0.9", "seed": SEED, **base, **params})
    else:
        raise ValueError(f"unknown model {name!r}")
    return made


# ---------------------------------------------------------------- preprocessing

def _literal(value: object) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"CAST({float(value)!r} AS DOUBLE)"


def fit_preprocessor(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                     with_mean: bool = True, scale: bool = True) -> PipelineModel:
    """Imputation, scaling of the numeric columns by the population deviation (a
    constant column is divided by 1) and one-hot coding (unseen categories give all
    zeros), learned from the training rows. NaN counts as missing. Every stage is a
    Spark ML stage, so the whole can be saved."""
    fill = fit_imputers(train, numeric, categorical)
    as_double = {c: f"coalesce(nanvl(try_cast(`{c}` AS DOUBLE), CAST(NULL AS DOUBLE)), {_literal(fill[c])})" for c in numeric}
    if scale and numeric:
        moments = train.agg(*[F.expr(f"struct(avg({x}) AS mean, stddev_pop({x}) AS sd)").alias(c)
                              for c, x in as_double.items()]).first()
        for c, x in as_double.items():
            mean, sd = moments[c]["mean"], moments[c]["sd"]
            shifted = f"({x} - {_literal(mean)})" if with_mean and mean is not None else x
            as_double[c] = f"{shifted} / {_literal(sd or 1.0)}"
    exprs = [f"{x} AS `{c}__num`" for c, x in as_double.items()]
    exprs += [f"coalesce(CAST(`{c}` AS STRING), {_literal(fill[c])}) AS `{c}__cat`" for c in categorical]
    stages: list = [SQLTransformer(statement=f"SELECT *, {', '.join(exprs)} FROM __THIS__")]
    if categorical:
        stages.append(StringIndexer(inputCols=[f"{c}__cat" for c in categorical],
                                    outputCols=[f"{c}__idx" for c in categorical], handleInvalid="keep",
                                    stringOrderType="alphabetAsc"))
        stages.append(OneHotEncoder(inputCols=[f"{c}__idx" for c in categorical],
                                    outputCols=[f"{c}__hot" for c in categorical], dropLast=True))
    parts = [f"{c}__num" for c in numeric] + [f"{c}__hot" for c in categorical]
    stages.append(VectorAssembler(inputCols=parts, outputCol="features"))
    return Pipeline(stages=stages).fit(train)


def split_columns(df: DataFrame, features: Sequence[str]) -> tuple[list[str], list[str]]:
    kinds = set(numeric_columns(df)) | {n for n, t in df.dtypes if t == "boolean"}
    return [c for c in features if c in kinds], [c for c in features if c not in kinds]


def training_rows(prepared: DataFrame, strategy: str, target: str, row_id: str) -> DataFrame:
    """(features, label, weight) after the imbalance strategy: what an estimator is fitted on."""
    rows = prepared.select(row_id, "features", F.col(target).cast("double").alias("label"))
    if strategy == "weighted":
        return class_weights(rows, "label", "weight")
    if strategy == "positive_weight":
        weighted = attach_scalars(rows, positive_weight(rows, "label"))
        return weighted.withColumn("weight", F.when(F.col("label") == 1, F.col("positive_weight")).otherwise(1.0))
    if strategy == "smote":
        dense = rows.select(row_id, vector_to_array("features").alias("_v"), "label")
        extra = smote(dense, "label", row_id, "_v")
        both = dense.select("_v", "label").unionByName(extra.select("_v", "label"))
        return both.select(array_to_vector("_v").alias("features"), "label", F.lit(1.0).alias("weight"))
    if strategy != "plain":
        raise ValueError(f"unknown strategy {strategy!r}")
    return rows.withColumn("weight", F.lit(1.0))


def fit_model(rows: DataFrame, cfg: ModelConfig) -> Model:
    """The estimator of a configuration on prepared :func:`training_rows`. ``kernel_svc``
    is a chain of the kernel features (parameters ``dims``, and ``gamma``, which follows
    from the rows by default) and the linear classifier on them."""
    if cfg.name == "kernel_svc":
        params = dict(cfg.params)
        gamma, dims = params.pop("gamma", None), params.pop("dims", KERNEL_FEATURES)
        kernel = KernelFeatures(gamma=float(gamma or scale_gamma(rows)), dims=dims, seed=SEED)
        inner = kernel.transform(rows).select(F.col(kernel.getOutputCol()).alias("features"), "label", "weight")
        fitted = fit_model(inner, ModelConfig("svc", cfg.strategy, params))
        return PipelineModel([kernel, fitted._set(featuresCol=kernel.getOutputCol())])
    total = rows.agg(F.sum("weight")).first()[0] if cfg.name in ("logistic", "svc") else None
    estimator = model(cfg.name, weight="weight", total_weight=total, **dict(cfg.params))
    return fit_boosted(rows, estimator) if cfg.name == "gbt" else estimator.fit(rows)


def make_pipeline(train: DataFrame, features: Sequence[str], target: str, row_id: str, cfg: ModelConfig,
                  preprocessor: PipelineModel | None = None) -> PipelineModel:
    """Preprocessing and estimator as one saved-able pipeline model. Over-sampling
    happens on the prepared training rows, between the two."""
    narrow = train.select(*dict.fromkeys([row_id, *features, target]))
    prep = preprocessor or fit_preprocessor(narrow, *split_columns(train, features), cfg.with_mean, cfg.scale)
    rows = training_rows(prep.transform(narrow), cfg.strategy, target, row_id).persist()
    try:
        fitted = fit_model(rows, cfg)
    finally:
        rows.unpersist()
    return PipelineModel([*prep.stages, *chain_of(fitted)])


def chain_of(fitted: Model) -> list:
    """The stages of a fitted configuration; the last one is the classifier."""
    return list(fitted.stages) if isinstance(fitted, PipelineModel) else [fitted]


def predict_scores(fitted: PipelineModel, df: DataFrame, keep: Sequence[str], out: str = "score") -> DataFrame:
    """Probability of class 1, or the min-max scaled margin of a model without
    probabilities."""
    scored = fitted.transform(df)
    if "probability" in scored.columns:
        return scored.select(*keep, vector_to_array("probability")[1].alias(out))
    margin = scored.select(*keep, vector_to_array("rawPrediction")[1].alias("_margin"))
    return min_max_scale(margin, "_margin", out).drop("_margin")


# ---------------------------------------------------------------- evaluation loops

METRICS = ("threshold", "recall", "precision", "f1", "accuracy", "roc_auc", "pr_auc", "tn", "fp", "fn", "tp")


def raw_scores(fits: Sequence[tuple[Mapping[str, object], Model]], prepared: DataFrame, keep: Sequence[str]) -> DataFrame:
    """(tags, score, is_margin, keep) of every fitted estimator for every prepared row. The
    estimators stand side by side in one projection, so the rows are read once for all."""
    df, entries = prepared.select(*keep, "features"), []
    for i, (tags, fitted) in enumerate(fits):
        *before, last = chain_of(fitted)
        one, out = last.copy(), f"_s{i}"
        for j, stage in enumerate(before):
            df = stage.copy().setOutputCol(f"_f{i}_{j}").transform(df)
            one._set(featuresCol=f"_f{i}_{j}")
        kind = "probabilityCol" if one.hasParam("probabilityCol") else "rawPredictionCol"
        one._set(**{c: out if c == kind else "" for c in ("predictionCol", "rawPredictionCol", "probabilityCol") if one.hasParam(c)})
        df = one.transform(df)
        entries.append(F.struct(*[F.lit(v).alias(k) for k, v in tags.items()], vector_to_array(out)[1].alias("score"),
                                F.lit(kind == "rawPredictionCol").alias("is_margin")))
    return df.select(F.explode(F.array(*entries)).alias("_e"), *keep).select("_e.*", *keep)


def evaluate_scores(scores: DataFrame, by: Sequence[str], thresholds: Sequence[float]) -> DataFrame:
    """Threshold and curve metrics of every model in one long table of (by, label, score,
    is_margin): one sweep and one curve for all. Margins are scaled by their own ends."""
    ends = scores.filter("is_margin").groupBy(*by).agg(F.min("score").alias("_lo"), F.max("score").alias("_hi"))
    scaled = join_keys(scores, ends, list(by), "left").withColumn("score", F.when(
        F.col("is_margin"), (F.col("score") - F.col("_lo")) / (F.col("_hi") - F.col("_lo") + F.lit(1e-9))).otherwise(F.col("score")))
    scaled = scaled.select(*by, "label", "score")
    areas = curve_areas(scaled, by=by).withColumnRenamed("average_precision", "pr_auc")
    return join_keys(threshold_sweep(scaled, thresholds, by=by), areas, list(by), "left").select(*by, *METRICS)


def _longest_rounds(configs: Sequence[ModelConfig]) -> dict[ModelConfig, list[ModelConfig]]:
    """Which fits answer which configurations: boosted ones that differ in their rounds
    alone come from the fit with the most of them."""
    families: dict[tuple, list[ModelConfig]] = {}
    for cfg in configs:
        rest = tuple(sorted((k, v) for k, v in cfg.params.items() if k != "maxIter"))
        families.setdefault((cfg.name, cfg.strategy, rest, "" if "maxIter" in cfg.params and cfg.name == "gbt" else cfg.label), []).append(cfg)
    longest = lambda part: max(part, key=lambda c: c.params.get("maxIter", 0))
    return {longest(part): part for part in families.values()}


def _few_partitions(rows: DataFrame) -> DataFrame:
    """Training rows kept in memory, in no more partitions than their number asks for.

    A fit runs many jobs, and the plan behind its rows is sent with each; so the rows are
    written once, and nothing is behind them."""
    rows = rows.persist()
    try:
        wanted = max(1, -(-rows.count() // PART_ROWS))
        return cut_lineage(rows.coalesce(wanted)).persist()
    finally:
        rows.unpersist()


@contextmanager
def _pools(parallelism: int) -> Iterator[tuple[ThreadPool, ThreadPool]]:
    """Threads for boosted fits, each of which is one long task, and for all others, which
    are scored while boosting goes on."""
    with ThreadPool(parallelism) as boosted, ThreadPool(parallelism) as others:
        yield boosted, others


def _fitted_side_by_side(train: DataFrame, features: Sequence[str], target: str, row_id: str, configs: Sequence[ModelConfig],
                         pools: tuple[ThreadPool, ThreadPool]) -> Iterator[tuple[PipelineModel, list[tuple[ModelConfig, Model]]]]:
    """Every configuration fitted on ``train``, by the preprocessor it shares: that is
    learned once per way of scaling, over-sampling done once per strategy, and boosting
    once for all numbers of rounds. The fits run in ``pools`` (of :func:`_pools`); those
    that are not boosted come first, so that they are scored while boosting goes on."""
    numeric, categorical = split_columns(train, features)
    narrow = train.select(*dict.fromkeys([row_id, *features, target]))
    groups: dict[tuple, list[ModelConfig]] = {}
    for cfg in configs:
        groups.setdefault((cfg.scale, cfg.with_mean), []).append(cfg)
    for (scale, with_mean), same_scale in groups.items():
        prep = fit_preprocessor(narrow, numeric, categorical, with_mean, scale)
        prepared = prep.transform(narrow)
        strategies = list(dict.fromkeys(c.strategy for c in same_scale))
        rows: dict[str, DataFrame] = {}
        try:
            for s in strategies:
                rows[s] = _few_partitions(training_rows(prepared, s, target, row_id))
            jobs = list(_longest_rounds(same_scale).items())
            # the long fits first, so that none is left over at the end
            jobs.sort(key=lambda job: -("svc", "logistic", "kernel_svc", "tree", "forest", "gbt").index(job[0].name))
            shares = [[job for job in jobs if (job[0].name == "gbt") == boosted] for boosted in (True, False)]
            fits = [pool.map_async(lambda job, rows=rows: fit_model(rows[job[0].strategy], job[0]), share, chunksize=1)
                    for pool, share in zip(pools, shares)]
            for share, fitted in zip(shares[::-1], fits[::-1]):
                if share:
                    yield prep, [(cfg, m if cfg == most else first_rounds(m, cfg.params["maxIter"]))
                                 for (most, part), m in zip(share, fitted.get()) for cfg in part]
        finally:
            for part in rows.values():
                part.unpersist()


def cross_validate(df: DataFrame, sets: Mapping[str, Sequence[str]], target: str, row_id: str,
                   configs: Sequence[ModelConfig], k: int = 5, thresholds: Sequence[float] = THRESHOLDS,
                   seed: int = SEED, parallelism: int = 8) -> DataFrame:
    """Feature sets × folds × models × thresholds in long form. All fits write their scores
    of the held-out rows into one long table, which is evaluated once.

    Several folds are prepared and scored at a time and share the pool of fits: a fold
    has fewer long fits than there is room for."""
    folded = stratified_folds(df, target, k, [row_id], seed).persist()

    def scores(task: tuple[str, int]) -> list[DataFrame]:
        set_name, fold = task
        train = folded.filter(F.col("fold") != fold)
        valid = folded.filter(F.col("fold") == fold).withColumn("label", F.col(target).cast("int"))
        out = []
        for prep, fits in _fitted_side_by_side(train, sets[set_name], target, row_id, configs, pools):
            tagged = [({"feature_set": set_name, "fold": fold, "model": c.name, "strategy": c.strategy}, m) for c, m in fits]
            out.append(cut_lineage(raw_scores(tagged, prep.transform(valid), ["label"])))
        return out

    try:
        with _pools(parallelism) as pools, ThreadPool(max(1, parallelism // 2)) as folds:
            parts = [p for some in folds.map(scores, list(product(sets, range(1, k + 1))), chunksize=1) for p in some]
    finally:
        folded.unpersist()
    return evaluate_scores(reduce(DataFrame.unionByName, parts), ["feature_set", "fold", "model", "strategy"], thresholds)


def parameter_grid(logistic: bool = True, tree: bool = True, forest: bool = True, gbt: bool = True) -> list[ModelConfig]:
    """The tuning grid: 6 logistic, 24 tree, 24 forest and 16 boosted configurations."""
    depth = {"none": 30}  # the deepest that Spark grows
    out: list[ModelConfig] = []
    if logistic:
        out += [ModelConfig("logistic", s, {"C": c}) for c, s in product((0.1, 1.0, 3.0), ("plain", "weighted"))]
    if tree:
        out += [ModelConfig("tree", s, {"maxDepth": depth.get(d, d), "minInstancesPerNode": m})
                for d, m, s in product((3, 5, 8, "none"), (1, 5, 10), ("plain", "weighted"))]
    if forest:
        out += [ModelConfig("forest", s, {"numTrees": n, "maxDepth": depth.get(d, d), "minInstancesPerNode": m})
                for n, d, m, s in product((200, 400), (5, 10, "none"), (1, 5), ("plain", "weighted"))]
    if gbt:
        out += [ModelConfig("gbt", s, {"maxIter": n, "maxDepth": d, "stepSize": r})
                for n, d, r, s in product((200, 400), (3, 5), (0.05, 0.10), ("plain", "positive_weight"))]
    return out


def grid_search(df: DataFrame, features: Sequence[str], target: str, row_id: str, grid: Sequence[ModelConfig],
                thresholds: Sequence[float] = GRID_THRESHOLDS, test_size: float = 0.3, seed: int = SEED,
                parallelism: int = 8) -> DataFrame:
    """Every configuration fitted on the training part and swept over thresholds
    on the hold-out part."""
    marked = stratified_split(df, target, test_size, [row_id], seed).persist()
    parts: list[DataFrame] = []
    try:
        train, test = marked.filter("is_test = 0"), marked.filter("is_test = 1").withColumn("label", F.col(target).cast("int"))
        with _pools(parallelism) as pools:
            for prep, fits in _fitted_side_by_side(train, features, target, row_id, grid, pools):
                tagged = [({"model": c.name, "strategy": c.strategy, "configuration": c.label,
                            "params": json.dumps(dict(c.params), sort_keys=True)}, m) for c, m in fits]
                parts.append(cut_lineage(raw_scores(tagged, prep.transform(test), ["label"])))
    finally:
        marked.unpersist()
    return evaluate_scores(reduce(DataFrame.unionByName, parts), ["model", "strategy", "configuration", "params"], thresholds)


def evaluate_winner(df: DataFrame, features: Sequence[str], target: str, row_id: str, cfg: ModelConfig,
                    threshold: float, test_size: float = 0.3, seed: int = SEED
                    ) -> tuple[PipelineModel, DataFrame, DataFrame, DataFrame, DataFrame]:
    """Fit on the training part, then on the hold-out part: the model, one metric
    row, the misclassified rows, their profile by error kind, and the report per class."""
    marked = stratified_split(df, target, test_size, [row_id], seed)
    train, test = marked.filter("is_test = 0"), marked.filter("is_test = 1")
    fitted = make_pipeline(train, features, target, row_id, cfg)
    scored = cut_lineage(predict_scores(fitted, test.withColumn("label", F.col(target).cast("int")), [row_id, *features, "label"]))
    tagged = scored.select(F.lit(cfg.name).alias("model"), F.lit(cfg.strategy).alias("strategy"), "label", "score",
                           F.lit(False).alias("is_margin"))
    metrics = evaluate_scores(tagged, ["model", "strategy"], [threshold])
    errors = error_rows(scored, threshold)
    numeric, categorical = split_columns(df, features)
    profiles = [error_profile(errors.filter(F.col("error_kind") == kind), numeric, categorical).withColumn(
        "error_kind", F.lit(kind)) for kind in ("false_positive", "false_negative")]
    predicted = scored.select("label", reaches(F.col("score"), threshold).cast("int").alias("prediction"))
    return fitted, metrics, errors, profiles[0].unionByName(profiles[1]), classification_report(predicted)


def model_matrix_json(metrics: DataFrame) -> DataFrame:
    """Metric rows with the confusion matrix as JSON text."""
    return metrics.withColumn("confusion_matrix", F.to_json(F.array(F.array("tn", "fp"), F.array("fn", "tp"))))


# ---------------------------------------------------------------- export and scoring

def export_models(df: DataFrame, features: Sequence[str], target: str, row_id: str,
                  exports: Sequence[tuple[str, ModelConfig, float]], folder: str, parallelism: int = 8) -> DataFrame:
    """Fit every configuration on all rows with a target, save it, and list what
    was saved. An export is (alias, configuration, threshold). The fits run side by side
    and share preprocessing and over-sampling; equal configurations are fitted once."""
    clean = df.filter(F.col(target).isNotNull())
    counts = df.agg(F.count(F.lit(1)).alias("all"), F.count(target).alias("kept")).first()
    configs = list(dict.fromkeys(cfg for _, cfg, _ in exports))
    fitted: dict[ModelConfig, PipelineModel] = {}
    with _pools(parallelism) as pools:
        for prep, fits in _fitted_side_by_side(clean, features, target, row_id, configs, pools):
            fitted.update((cfg, PipelineModel([*prep.stages, *chain_of(m)])) for cfg, m in fits)
    rows = []
    for alias, cfg, threshold in exports:
        path = f"{folder.rstrip('/')}/{alias}"
        fitted[cfg].write().overwrite().save(path)
        rows.append((alias, cfg.name, cfg.strategy, float(threshold), len(features), counts["kept"],
                     counts["all"] - counts["kept"], path))
    return df.sparkSession.createDataFrame(rows, (
        "alias string, model string, strategy string, threshold double, n_features int, n_rows_trained bigint, "
        "target_null_rows_dropped bigint, path string"))


def score_table(fitted: PipelineModel | str, df: DataFrame, threshold: float, keep: Sequence[str]) -> DataFrame:
    """Score and decision for every row of a table, from a model or its folder."""
    if isinstance(fitted, str):
        fitted = PipelineModel.load(fitted)
    scored = predict_scores(fitted, df, keep)
    return scored.withColumn("prediction", reaches(F.col("score"), threshold).cast("int"))


def grouped_importance(fitted: PipelineModel, df: DataFrame) -> DataFrame:
    """Absolute coefficients or importances, summed from feature slots to source
    columns and scaled to maximum 1."""
    last = fitted.stages[-1]
    if last.getFeaturesCol() != "features":
        raise ValueError("features of a kernel have no source column")
    weights = last.featureImportances if hasattr(last, "featureImportances") else last.coefficients
    prepared = PipelineModel(fitted.stages[:-1]).transform(df.limit(1))
    attrs = prepared.schema["features"].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for group in attrs.values() for a in group}
    rows = []
    for i, w in enumerate(weights.toArray()):
        name = names.get(i, f"slot_{i}")
        rows.append((name.split("__hot_")[0] if "__hot_" in name else name.removesuffix("__num"), float(w)))
    return group_importance(df.sparkSession.createDataFrame(rows, "variable string, weight double"))


def rf_importance(df: DataFrame, features: Sequence[str], target: str, row_id: str, trees: int = 500) -> DataFrame:
    """Importance of every column in a class-weighted random forest. The node that a row has
    reached is kept, so that no level passes its row through all trees from their roots."""
    cfg = ModelConfig("forest", "weighted", {"numTrees": trees, "maxDepth": 15, "minInstancesPerNode": 3, "cacheNodeIds": True})
    clean = df.filter(F.col(target).isNotNull())
    fitted = make_pipeline(clean, features, target, row_id, cfg)
    return grouped_importance(fitted, clean).withColumnRenamed("influence", "rf_importance")


def rank_by_two_scores(mutual: DataFrame, forest: DataFrame) -> DataFrame:
    """Ranking by the average of the two ranks, then by both scores."""
    both = mutual.join(forest, "variable")
    return mean_rank(both, "mutual_info", "rf_importance").orderBy(
        "mean_rank", F.desc("mutual_info"), F.desc("rf_importance"), "variable")


def confusion_of(fitted: PipelineModel, df: DataFrame, target: str, threshold: float) -> DataFrame:
    scored = predict_scores(fitted, df.withColumn("label", F.col(target).cast("int")), ["label"])
    return confusion(scored, threshold)
