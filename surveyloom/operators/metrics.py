"""Evaluation of scored tables (label 0/1, score). Threshold metrics are one
aggregate; curve metrics run over distinct scores with running totals by range.

A row whose score is null or NaN is unscored: it is in no count but ``unscored``, no
total and no curve."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import label_rules
from .common import attach_scalars, explode_stats, join_keys, small_side
from .ordered import best_per_group, first_per_group, known, running_totals, top_k
from .reshape import melt, union_all


def _zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def reaches(score: Column, threshold: float) -> Column:
    """Whether a score is at or above the threshold; NaN is missing and gives null."""
    return F.when(~F.isnan(score.cast("double")), score >= threshold)


def _unscored(score: str) -> Column:
    value = F.col(score).cast("double")
    return F.count_if(value.isNull() | F.isnan(value)).alias("unscored")


def _confusion_cols(label: Column, predicted: Column) -> dict[str, Column]:
    return {"tn": F.count_if((label == 0) & ~predicted), "fp": F.count_if((label == 0) & predicted),
            "fn": F.count_if((label == 1) & ~predicted), "tp": F.count_if((label == 1) & predicted)}


def _rates(tn: Column, fp: Column, fn: Column, tp: Column) -> dict[str, Column]:
    precision, recall = _zero(F.try_divide(tp, tp + fp)), _zero(F.try_divide(tp, tp + fn))
    return {"accuracy": _zero(F.try_divide(tp + tn, tn + fp + fn + tp)), "precision": precision, "recall": recall,
            "f1": _zero(F.try_divide(2 * tp, 2 * tp + fp + fn))}


def confusion(df: DataFrame, threshold: float, label: str = "label", score: str = "score",
              by: Sequence[str] = ()) -> DataFrame:
    """TN, FP, FN and TP when scores at or above the threshold are positive, and the
    number of unscored rows."""
    counts = _confusion_cols(F.col(label), reaches(F.col(score), threshold))
    return df.groupBy(*by).agg(*[c.alias(n) for n, c in counts.items()], _unscored(score))


def binary_metrics(df: DataFrame, threshold: float, label: str = "label", score: str = "score",
                   by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall and F1; undefined ones are 0."""
    counts = confusion(df, threshold, label, score, by)
    return counts.withColumns(_rates(*[F.col(c) for c in ("tn", "fp", "fn", "tp")]))


def threshold_sweep(df: DataFrame, thresholds: Sequence[float], label: str = "label", score: str = "score",
                    by: Sequence[str] = ()) -> DataFrame:
    """The metrics at every threshold, from one aggregate over the table."""
    aggs, entries = [], []
    for i, t in enumerate(thresholds):
        names = {n: f"{n}_{i}" for n in ("tn", "fp", "fn", "tp")}
        counts = _confusion_cols(F.col(label), reaches(F.col(score), float(t)))
        aggs += [c.alias(names[n]) for n, c in counts.items()]
        cols = {n: F.col(a) for n, a in names.items()}
        entries.append({**{b: F.col(b) for b in by}, "threshold": F.lit(float(t)), **cols, "unscored": F.col("unscored"), **_rates(**cols)})
    return explode_stats(df.groupBy(*by).agg(*aggs, _unscored(score)), entries)


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, with macro and weighted means."""
    pairs = df.groupBy(F.col(label).alias("l"), F.col(prediction).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    sides = pairs.select(F.explode(F.array(
        F.struct(F.col("l").cast("string").alias("class"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias(
            "guessed"), F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(0).alias("hits")),
        F.struct(F.col("p").cast("string").alias("class"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias(
            "guessed"), F.lit(0).cast("bigint").alias("hits")))).alias("e")).select("e.*")
    per = sides.groupBy("class").agg(F.sum("support").alias("support"), F.sum("guessed").alias("g"),
                                     F.sum("hits").alias("h"))
    per = per.select("class", _zero(F.try_divide("h", "g")).alias("precision"),
                     _zero(F.try_divide("h", "support")).alias("recall"),
                     _zero(F.try_divide(2 * F.col("h"), F.col("g") + F.col("support"))).alias("f1"), "support")
    metrics = ("precision", "recall", "f1")
    macro = per.agg(*[F.avg(m).alias(m) for m in metrics], F.sum("support").alias("support"))
    weighted = per.agg(*[_zero(F.try_divide(F.sum(F.col(m) * F.col("support")), F.sum("support"))).alias(m)
                         for m in metrics], F.sum("support").alias("support"))
    accuracy = pairs.agg(F.try_divide(F.sum(F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(0)),
                                      F.sum("n")).alias("a"), F.sum("n").alias("support")).select(
        F.lit("accuracy").alias("class"), *[F.col("a").alias(m) for m in metrics], "support")
    return union_all([per, accuracy, macro.select(F.lit("macro avg").alias("class"), *metrics, "support"),
                      weighted.select(F.lit("weighted avg").alias("class"), *metrics, "support")])


# ---------------------------------------------------------------- curves

def cumulative_scores(df: DataFrame, label: str = "label", score: str = "score",
                      by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives at each distinct score, and at or above it."""
    return running_totals(df, by, score, {"pos": F.count_if(F.col(label) == 1), "neg": F.count_if(F.col(label) == 0)})


def _with_totals(curve: DataFrame, df: DataFrame, label: str, score: str, by: Sequence[str]) -> DataFrame:
    scored = df.filter(known(df, score))
    totals = scored.groupBy(*by).agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n"))
    if not by:
        return attach_scalars(curve, totals)
    return join_keys(curve, small_side(totals), list(by), "inner")


def curve_areas(df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """roc_auc and average_precision from one curve.

    The area under the ROC curve is exact: ties count one half; null for one class.
    Average precision is step-wise: recall gained at each score times the precision
    there; 0 without positives."""
    curve = _with_totals(cumulative_scores(df, label, score, by), df, label, score, by)
    # negatives below this score = all negatives minus those at or above it
    wins = F.col("pos") * ((F.col("n") - F.col("cum_neg")) + F.col("neg") * 0.5)
    step = F.col("pos") * F.try_divide(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg"))
    return curve.groupBy(*by).agg(
        F.try_divide(F.sum(wins), F.max(F.col("p").cast("double") * F.col("n"))).alias("roc_auc"),
        _zero(F.try_divide(F.sum(step), F.max("p"))).alias("average_precision"))


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    return curve_areas(df, label, score, by).select(*by, "roc_auc")


def average_precision(df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    return curve_areas(df, label, score, by).select(*by, "average_precision")


def roc_curve(df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """(fpr, tpr) at every distinct score, and the origin per curve."""
    curve = _with_totals(cumulative_scores(df, label, score, by), df, label, score, by)
    points = curve.select(*by, F.col(score).alias("threshold"), F.try_divide("cum_neg", "n").alias("fpr"),
                          F.try_divide("cum_pos", "p").alias("tpr"))
    origin = df.select(*by).distinct() if by else df.agg(F.count(F.lit(1)).alias("_n")).select()
    start = origin.select(*by, F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.unionByName(start)


# ---------------------------------------------------------------- comparisons

def compare_models(results: DataFrame, keys: Sequence[str], metrics: Sequence[str],
                   order: Sequence[str]) -> DataFrame:
    """Metric means over folds, best first."""
    means = results.groupBy(*keys).agg(*[F.avg(m).alias(m) for m in metrics])
    return means.orderBy(*[F.col(m).desc_nulls_last() for m in order], *keys)


def winner_rows(summary: DataFrame, winners: DataFrame, keys: Sequence[str], threshold: str = "threshold") -> DataFrame:
    """Winners joined back to their metrics; thresholds compare by rounded value."""
    bp = F.round(F.col(threshold) * 10000).cast("bigint")
    left = winners.withColumn("_t", bp)
    right = summary.withColumn("_t", bp).drop(threshold)
    rest = [c for c in right.columns if c not in keys and c != "_t"]
    right = first_per_group(right, [*keys, "_t"], rest, rest)   # a summary row listed twice counts once
    return left.join(right, [*keys, "_t"], "left").drop("_t")


def error_rows(df: DataFrame, threshold: float, label: str = "label", score: str = "score") -> DataFrame:
    """False positives and false negatives with their kind."""
    predicted = reaches(F.col(score), threshold).cast("int")
    kind = F.when((F.col(label) == 0) & (predicted == 1), "false_positive").when(
        (F.col(label) == 1) & (predicted == 0), "false_negative")
    return df.withColumns({"prediction": predicted, "error_kind": kind}).filter(F.col("error_kind").isNotNull())


def group_importance(slots: DataFrame, base: str = "variable", weight: str = "weight",
                     by: Sequence[str] = ()) -> DataFrame:
    """Absolute slot weights summed to their source variable, scaled to maximum 1."""
    sums = slots.groupBy(*by, base).agg(F.sum(F.abs(weight)).alias("_w"))
    if by:
        top = small_side(sums.groupBy(*by).agg(F.max("_w").alias("_top")))
        sums = join_keys(sums, top, list(by), "inner")
    else:
        sums = attach_scalars(sums, sums.agg(F.max("_w").alias("_top")))
    scaled = F.when(F.col("_top") > 0, F.col("_w") / F.col("_top")).otherwise(F.col("_w"))
    return sums.select(*by, base, scaled.alias("influence"))


def influence_matrix(long: DataFrame, models: Sequence[str], row: str = "variable", col: str = "model",
                     value: str = "influence", top: int = 10) -> tuple[DataFrame, DataFrame]:
    """Most influential variables by mean over models: wide, and long."""
    from .reshape import pivot_matrix

    wide = pivot_matrix(long, row, col, value, models, top)
    return wide, melt(wide, [row], list(models), col, value)


def compare_feature_sets(results: DataFrame, key: str, metric: str, tie: Sequence[str]) -> DataFrame:
    """Best row of every feature set."""
    return best_per_group(results, [key], metric, tie)


def best_against_finalists(baseline: DataFrame, finalists: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """The best baseline row next to the tuned finalists."""
    best = top_k(baseline, [(m, "desc") for m in order], 1).withColumn("model", F.lit(label))
    return union_all([best, finalists])


def top_models_view(summary: DataFrame, families: Mapping[str, str], k: int = 10) -> DataFrame:
    """Top-k rows by recall, F1 and precision with report names and the model family."""
    best = top_k(summary, [("recall", "desc"), ("f1", "desc"), ("precision", "desc"), ("feature_set", "asc"),
                           ("model", "asc"), ("strategy", "asc"), ("threshold", "asc")], k)
    family = label_rules([(F.col("model") == k_, v) for k_, v in families.items()], F.lit(None).cast("string"))
    return best.select(F.col("feature_set").alias("scenario"), family.alias("model_family"),
                       F.concat_ws("__", "model", "strategy").alias("model_name"), "strategy", "threshold",
                       "precision", "recall", "f1", "roc_auc", "pr_auc")
