"""Ensembles of trees: boosting without a job per level of every tree, and models that
list their trees only when asked.

``GBTClassifier`` runs about five jobs a round. For rows that lie in one partition anyway,
each of them has one short task, and starting them is nearly all of the time: 200 fits of
300 rounds ask for 60,000 jobs. Here all rounds of such a fit run in one task, over counts
per bin of numpy arrays; the trees are written in the form of a saved Spark model and read
back as one. More rows than ``PART_ROWS`` are fitted by Spark, round by round.

What is learned is what ``GBTClassifier`` learns: its bins, its log loss, least-squares
trees on what is left of it, its first tree on the labels with weight 1. Only the draws of
rows and features come from another generator.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_by_value

ship_by_value(__name__)

PART_ROWS = 50_000   # training rows a partition holds at least, so that few rows make few tasks

_NODES = ("treeID int, nodeData struct<id int, prediction double, impurity double, impurityStats array<double>, rawCount bigint, "
          "gain double, leftChild int, rightChild int, split struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>>")
_ARROW = pa.schema([("treeID", pa.int32()), ("nodeData", pa.struct([
    ("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())),
    ("rawCount", pa.int64()), ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()), ("split", pa.struct([
        ("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())), ("numCategories", pa.int32())]))]))])
_FOLLOWED = ("maxIter", "maxDepth", "stepSize", "subsamplingRate", "featureSubsetStrategy", "seed", "maxBins", "minInstancesPerNode",
             "minInfoGain", "minWeightFractionPerNode")


# PySpark reads every attribute of a model that is no property when it looks for parameters,
# and the trees are a cached attribute: each becomes a Python object with all its parameters
# (some seconds for 300 trees, one model at a time). As properties they are passed over.

class ForestModel(RandomForestClassificationModel):
    @property
    def trees(self) -> list:
        return RandomForestClassificationModel.trees.func(self)


class BoostedModel(GBTClassificationModel):
    @property
    def trees(self) -> list:
        return GBTClassificationModel.trees.func(self)


class Forest(RandomForestClassifier):
    def _create_model(self, java_model) -> ForestModel:
        return ForestModel(java_model)


class Boosting(GBTClassifier):
    def _create_model(self, java_model) -> BoostedModel:
        return BoostedModel(java_model)


def find_splits(values: np.ndarray, weights: np.ndarray, bins: int) -> np.ndarray:
    """Thresholds between the bins of a feature: between all values where they are few, else
    where the weight below is nearest to equal shares."""
    distinct, place = np.unique(values, return_inverse=True)
    if len(distinct) <= bins:
        return (distinct[:-1] + distinct[1:]) / 2.0
    held = np.cumsum(np.bincount(place, weights=weights)).tolist()
    share = target = held[-1] / bins
    out = []
    for i in range(1, len(distinct)):
        if abs(held[i - 1] - target) < abs(held[i] - target):
            out.append((distinct[i - 1] + distinct[i]) / 2.0)
            target += share
    return np.array(out)


def features_per_node(strategy: str, width: int) -> int:
    """How many features a node chooses from; a single tree takes all by default."""
    named = {"auto": width, "all": width, "sqrt": np.ceil(np.sqrt(width)), "log2": max(1, np.ceil(np.log2(width))),
             "onethird": np.ceil(width / 3.0)}
    if strategy in named:
        return int(named[strategy])
    return min(int(strategy), width) if strategy.isdigit() else int(np.ceil(float(strategy) * width))


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.divide(a, b, out=np.zeros_like(a), where=b > 0)


def grow_tree(codes: np.ndarray, slots: np.ndarray, thresholds: list[np.ndarray], target: np.ndarray, weight: np.ndarray,
              drawn: np.ndarray, draw: np.random.RandomState, params: dict) -> tuple[list[dict], np.ndarray]:
    """(nodes, prediction per row) of one least-squares tree, level by level, learned from
    the rows that were drawn. A child has a higher id than its parent."""
    width, bins, depth = codes.shape[1], params["maxBins"], params["maxDepth"]
    some = features_per_node(params["featureSubsetStrategy"], width)
    allowed = np.arange(bins - 1)[None, :] < np.array([len(t) for t in thresholds])[:, None]
    rows, all_weight = np.flatnonzero(drawn), weight[drawn].sum()
    wy = weight * target
    at, end = np.zeros(len(codes), dtype=np.int64), np.zeros(len(codes))   # the open node a row lies in, what a closed one gives
    nodes: list[dict] = []
    ids = np.array([0])
    for level in range(depth + 1):
        k, mine = len(ids), at[rows]
        w, y, yy = (np.bincount(mine, weights=v[rows], minlength=k) for v in (weight, wy, wy * target))
        n, mean = np.bincount(mine, minlength=k), _ratio(y, w)
        impurity = _ratio(yy - mean * y, w)
        gain, feature, cut = np.full(k, -1.0), np.full(k, -1), np.zeros(k, dtype=np.int64)
        if level < depth:
            cells = (mine[:, None] * (width * bins) + slots[rows]).ravel()
            counted = [np.bincount(cells, weights=v, minlength=k * width * bins).reshape(k, width, bins).cumsum(axis=2)[:, :, :-1]
                       for v in (None, np.repeat(weight[rows], width), np.repeat(wy[rows], width))]
            left_n, left_w, left_y = counted
            right_n, right_w, right_y = n[:, None, None] - left_n, w[:, None, None] - left_w, y[:, None, None] - left_y
            least, share = params["minInstancesPerNode"], params["minWeightFractionPerNode"] * all_weight
            fine = allowed[None] & (left_n >= least) & (right_n >= least) & (left_w >= share) & (right_w >= share)
            if some < width:
                taken = np.zeros((k, width), dtype=bool)
                np.put_along_axis(taken, draw.random_sample((k, width)).argpartition(some - 1, axis=1)[:, :some], True, axis=1)
                fine &= taken[:, :, None]
            better = _ratio(left_y ** 2, left_w) + _ratio(right_y ** 2, right_w) - (mean * y)[:, None, None]
            better = np.where(fine, better, -np.inf).reshape(k, -1)
            best = better.argmax(axis=1)
            gain = _ratio(better[np.arange(k), best], w)
            feature, cut = np.divmod(best, bins - 1)
        split = np.isfinite(gain) & (gain > 0) & (gain >= params["minInfoGain"])
        children = len(nodes) + k + 2 * (np.cumsum(split) - 1)
        for i in range(k):
            made = {"id": int(ids[i]), "prediction": float(mean[i]), "impurity": float(impurity[i]), "rawCount": int(n[i]),
                    "impurityStats": [float(w[i]), float(y[i]), float(yy[i])]}
            if split[i]:
                f = int(feature[i])
                made |= {"gain": float(gain[i]), "leftChild": int(children[i]), "rightChild": int(children[i]) + 1, "split": {
                    "featureIndex": f, "leftCategoriesOrThreshold": [float(thresholds[f][cut[i]])], "numCategories": -1}}
            else:
                made |= {"gain": -1.0, "leftChild": -1, "rightChild": -1, "split": {
                    "featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1}}
            nodes.append(made)
        inside = np.flatnonzero(at >= 0)
        here = at[inside]
        end[inside] = mean[here]
        onward = split[here]
        at[inside[~onward]] = -1
        inside, here = inside[onward], here[onward]
        if not len(inside):
            break
        order = np.cumsum(split) - 1
        at[inside] = 2 * order[here] + (codes[inside, feature[here]] > cut[here])
        rows = rows[at[rows] >= 0]
        ids = (children[split][:, None] + np.arange(2)).ravel()
    return nodes, end


def boost(x: np.ndarray, label: np.ndarray, weight: np.ndarray, params: dict) -> Iterator[list[dict]]:
    """The nodes of one tree after another. What is drawn in a round follows from the seed,
    the round and the rows, not from the order in which they come, so fewer rounds are a start of more."""
    order = np.lexsort((*x.T, label, weight))
    x, weight, sign = x[order], weight[order], 2.0 * label[order] - 1.0
    bins = params["maxBins"]
    thresholds = [find_splits(x[:, f], weight, min(bins, len(x))) for f in range(x.shape[1])]
    codes = np.stack([np.searchsorted(t, x[:, f], side="left") for f, t in enumerate(thresholds)], axis=1)
    slots = codes + np.arange(x.shape[1]) * bins
    margin = np.zeros(len(x))
    for i in range(params["maxIter"]):
        draw = np.random.RandomState((params["seed"] + i) % (1 << 32))   # the generator whose numbers never change
        drawn = draw.random_sample(len(x)) < params["subsamplingRate"]
        target = sign if i == 0 else 4.0 * sign / (1.0 + np.exp(np.minimum(2.0 * sign * margin, 700.0)))
        nodes, found = grow_tree(codes, slots, thresholds, target, weight, drawn, draw, params)
        margin += found * (1.0 if i == 0 else params["stepSize"])
        yield nodes


def _rounds(params: dict):
    """All rounds over the one partition of rows, as nodes of saved trees."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.Table.from_batches(batches).combine_chunks() if (batches := list(batches)) else None
        if held is None or held.num_rows == 0:
            raise ValueError("boosting needs rows")
        if any(held[c].null_count for c in ("x", "label", "weight")):
            raise ValueError("features, labels and weights of training rows must not be null")
        x = np.stack(held["x"].to_numpy(zero_copy_only=False)).astype(float)
        label, weight = held["label"].to_numpy().astype(float), held["weight"].to_numpy().astype(float)
        if not (np.isfinite(x).all() and np.isin(label, (0.0, 1.0)).all() and np.isfinite(weight).all() and (weight >= 0).all()):
            raise ValueError("features must be finite, labels 0 or 1, weights finite and not negative")
        for tree, nodes in enumerate(boost(x, label, weight, params)):
            yield pa.RecordBatch.from_pylist([{"treeID": tree, "nodeData": node} for node in nodes], schema=_ARROW)

    return run


def _described(name: str, uid: str, version: str, set_: dict, default: dict, **more) -> str:
    return json.dumps({"class": name, "timestamp": int(time.time() * 1000), "sparkVersion": version, "uid": uid,
                       "paramMap": set_, "defaultParamMap": default, **more})


def fit_boosted(rows: DataFrame, gbt: Boosting) -> BoostedModel:
    """``gbt`` fitted on ``rows``: all rounds in one task where one partition holds the rows."""
    stated = {p.name: gbt.getOrDefault(p) for p in gbt.params if gbt.isDefined(p)}
    if stated.get("validationIndicatorCol") or rows.limit(PART_ROWS + 1).count() > PART_ROWS:
        return gbt.fit(rows)
    spark = rows.sparkSession
    weight = F.col(gbt.getWeightCol()).cast("double") if stated.get("weightCol") else F.lit(1.0)
    narrow = rows.select(vector_to_array(gbt.getFeaturesCol()).alias("x"), F.col(gbt.getLabelCol()).cast("double").alias("label"),
                         weight.alias("weight"))
    first = narrow.select(F.size("x")).first()
    path = f"{ensure_checkpoint_dir(spark)}/boosted-{uuid.uuid4().hex}"
    trees = narrow.coalesce(1).mapInArrow(_rounds({name: stated[name] for name in _FOLLOWED}), _NODES)
    trees.write.parquet(f"{path}/data")
    # a saved model lists its parameters by name, and each tree its own
    given = [{p.name: v for p, v in held.items()} for held in (gbt._paramMap, gbt._defaultParamMap)]
    shared = [{n: v for n, v in part.items() if n not in ("maxIter", "stepSize", "subsamplingRate", "featureSubsetStrategy", "lossType", "validationTol",
                                                         "probabilityCol", "rawPredictionCol", "validationIndicatorCol", "thresholds")} for part in given]
    one = _described("org.apache.spark.ml.regression.DecisionTreeRegressionModel", f"dtr_{uuid.uuid4().hex[:12]}", spark.version, *shared)
    whole = _described("org.apache.spark.ml.classification.GBTClassificationModel", gbt.uid, spark.version, *given,
                       numFeatures=first[0], numTrees=stated["maxIter"])
    spark.range(0, stated["maxIter"], 1, 1).select(
        F.col("id").cast("int").alias("_1"), F.lit(one).alias("_2"),
        F.when(F.col("id") == 0, 1.0).otherwise(float(stated["stepSize"])).alias("_3")).write.parquet(f"{path}/treesMetadata")
    spark.range(0, 1, 1, 1).select(F.lit(whole).alias("value")).write.text(f"{path}/metadata")
    return gbt._copyValues(BoostedModel(GBTClassificationModel.read()._jread.load(path)))


def first_rounds(fitted: GBTClassificationModel, rounds: int) -> BoostedModel:
    """The boosted model after its first rounds: what fewer rounds would have given."""
    gateway = SparkContext._gateway
    start = [gateway.new_array(kind, rounds) for kind in (gateway.jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, gateway.jvm.double)]
    for some, all_ in zip(start, (fitted._java_obj.trees(), fitted._java_obj.treeWeights())):
        gateway.jvm.java.lang.System.arraycopy(all_, 0, some, 0, rounds)
    return BoostedModel(gateway.jvm.org.apache.spark.ml.classification.GBTClassificationModel(fitted.uid, *start))
