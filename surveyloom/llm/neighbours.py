"""Approximate nearest neighbours (largest inner product) over shifted Hilbert curves.

Distinct vectors are projected on a few random directions, once per curve; the
projected values become cells of a shifted grid, with cell borders from a bounded
sample, and the Hilbert key of the cell orders all vectors of that curve. The orders
are range-partitioned and numbered by Spark. A query looks at the vectors at most
``window`` places away on every curve; what the windows find is merged and ranked by
the inner product of the original vectors.

The window is not guessed: for a bounded number of sampled queries the true
neighbours are found by brute force, and the window is set so that the wanted share
of them lies inside on some curve. Data without structure needs wide windows.

Vectors that are null or zero, hold null or non-finite components, or have another
length than the most frequent one take no part. Copies of a vector are one vector in
the search; ties go to the smaller id. Rows that share id and vector are one.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship_by_value
from .common import materialise, running_total

ship_by_value(__name__)

K, CURVES, AXES, BITS = 20, 4, 4, 10
SAMPLE = 5_000      # vectors from which cell borders are taken
PROBES = 100        # queries whose true neighbours set the window
RECALL = 0.97       # share of those neighbours that the windows must hold
BLOCK = 8_192       # most vectors of a block that one task compares


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of integer points (n, axes): undo the rotations bit by bit, then
    interleave (after J. Skilling, Programming the Hilbert curve, 2004)."""
    x = cells.astype(np.int64).T.copy()
    axes, q = len(x), 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(axes):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(high, p, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    t, q = np.zeros_like(x[0]), 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[axes - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(axes):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, v): distinct rows that take part."""
    v = F.transform(F.col(f"`{vector}`"), lambda x: x.cast("double"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = vectors.select(F.col(f"`{vec_id}`").cast("bigint").alias("vec_id"), v.alias("v")).where(
        F.col("v").isNotNull() & F.col("vec_id").isNotNull() & ~F.exists("v", bad) & F.exists("v", lambda x: x != 0))
    usual = rows.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").first()
    return rows.where(F.size("v") == (usual["size"] if usual else -1)).distinct()


def curves(classes: DataFrame, count: int, axes: int, bits: int) -> DataFrame:
    """(curve, cid, place): the place of every vector on every curve."""
    sample = [r["v"] for r in classes.orderBy(F.xxhash64("cid"), "cid").limit(SAMPLE).collect()]
    seen, rng = np.array(sample), np.random.default_rng(7)
    width = seen.shape[1]
    turns = [np.linalg.qr(rng.normal(size=(width, min(axes, width))))[0] for _ in range(count)]
    borders = [np.quantile(seen @ t, np.linspace(0, 1, 1 << (bits - 1))[1:-1], axis=0) for t in turns]
    shifts = rng.integers(0, 1 << (bits - 1), size=(count, min(axes, width)))

    def keyed(frames):
        for f in frames:
            m = np.array(f["v"].tolist(), dtype=np.float64).reshape(len(f), -1)
            for c in range(count) if len(f) else ():
                p = m @ turns[c]
                cells = np.stack([np.searchsorted(borders[c][:, i], p[:, i]) for i in range(p.shape[1])], axis=1)
                yield pd.DataFrame({"curve": c, "key": hilbert(cells + shifts[c], bits), "cid": f["cid"].to_numpy(), "one": 1})

    rows = classes.mapInPandas(keyed, "curve int, key bigint, cid bigint, one bigint")
    placed = running_total(rows, ["curve", "key", "cid"], "one", "at")
    return placed.select("curve", "cid", "at")


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Indices of the ``k`` largest scores, ties by smaller id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= least)
    else:
        keep = np.arange(len(scores))
    return keep[np.lexsort((ids[keep], -scores[keep]))[:k]]


def true_neighbours(classes: DataFrame, probes: list[tuple[int, list[float]]], k: int) -> dict[int, list[int]]:
    """Brute force for a bounded number of probes, in blocks of vectors."""
    ask = np.array([v for _, v in probes])

    def top(frames):
        for f in frames:
            if len(f):
                ids, s = f["cid"].to_numpy(), ask @ np.array(f["v"].tolist()).T
                for i in range(len(ask)):
                    b = _best(s[i], ids, k + 1)
                    yield pd.DataFrame({"probe": i, "cid": ids[b], "score": s[i][b]})

    found = classes.mapInPandas(top, "probe int, cid bigint, score double")
    rank = F.row_number().over(Window.partitionBy("probe").orderBy(F.desc("score"), "cid"))
    out: dict[int, list[int]] = {q: [] for q, _ in probes}
    for r in found.withColumn("r", rank).where(F.col("r") <= k + 1).collect():
        out[probes[r["probe"]][0]].append(r["cid"])
    return out


def fit_window(classes: DataFrame, placed: DataFrame, asked: DataFrame, k: int, recall: float) -> int:
    """Places to look at on each side so that ``recall`` of the probes' neighbours are inside."""
    probes = [(r["cid"], r["v"]) for r in asked.orderBy(F.xxhash64("cid"), "cid").limit(PROBES).collect()]
    near = true_neighbours(classes, probes, k)
    wanted = sorted({c for q, cs in near.items() for c in (q, *cs)})
    at = {(r["curve"], r["cid"]): r["at"] for r in placed.where(F.col("cid").isin(wanted)).collect()}
    lines = sorted({c for c, _ in at})
    apart = [min(abs(at[c, q] - at[c, n]) for c in lines) for q, ns in near.items() for n in ns if n != q]
    return int(np.quantile(apart, recall, method="higher")) + 1 if apart else 1


def search(vectors: DataFrame, is_query: Column, k: int = K, vec_id: str = "vec_id", vector: str = "embedding",
           count: int = CURVES, axes: int = AXES, bits: int = BITS, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for each row for which
    ``is_query`` (a condition on ``vec_id``) holds, the row's own id excepted."""
    spark = vectors.sparkSession
    rows = materialise(usable(vectors, vec_id, vector))
    place = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    # the smallest ids of each class of copies: no result needs more of them
    first = rows.withColumn("r", place).where(F.col("r") <= k + 1)
    classes = materialise(first.groupBy("v").agg(F.min("vec_id").alias("cid"), F.sort_array(F.collect_list("vec_id")).alias("ids")))
    queries = materialise(rows.where(is_query).join(classes.select("v", "cid"), "v").select(F.col("vec_id").alias("query_id"), "cid"))
    total = classes.count()
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    if not total or queries.isEmpty():
        return empty
    asked = materialise(classes.join(queries.select("cid").distinct(), "cid", "left_semi"))
    placed = materialise(curves(classes, count, axes, bits))
    window = fit_window(classes, placed, asked, k, recall)
    block = int(min(BLOCK, max(512, window)))
    on = placed.withColumn("at", F.col("at") - F.col("curve").cast("bigint") * total)
    data = on.join(classes.select("cid", "v"), "cid").select("curve", F.floor(F.col("at") / block).alias("block"), "cid", "v")
    low = F.greatest(F.floor((F.col("at") - window) / block), F.lit(0))
    high = F.least(F.floor((F.col("at") + window) / block), F.lit((total - 1) // block))
    ask = on.join(asked.select("cid", "v"), "cid").select(
        F.col("curve").alias("line"), F.explode(F.sequence(low, high)).alias("part"), F.col("cid").alias("q"), F.col("v").alias("w"))

    def compare(q: pd.DataFrame, d: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(d):
            return pd.DataFrame({"q": [], "cid": [], "score": []})
        ids, m = d["cid"].to_numpy(), np.array(d["v"].tolist()).T
        out = []
        for i in range(0, len(q), 256):
            s = np.array(q["w"].iloc[i:i + 256].tolist()) @ m
            for name, row in zip(q["q"].iloc[i:i + 256], s):
                b = _best(row, ids, k + 1)
                out.append(pd.DataFrame({"q": name, "cid": ids[b], "score": row[b]}))
        return pd.concat(out)

    found = ask.groupBy("line", "part").cogroup(data.groupBy("curve", "block")).applyInPandas(compare, "q bigint, cid bigint, score double")
    merged = found.groupBy("q", "cid").agg(F.max("score").alias("score"))
    best = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "cid"))
    merged = merged.withColumn("r", best).where(F.col("r") <= k + 1).join(classes.select("cid", "ids"), "cid")
    single = merged.select("q", F.explode("ids").alias("vec_id"), "score")
    best = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
    lists = single.withColumn("r", best).where(F.col("r") <= k + 1).groupBy("q").agg(
        F.sort_array(F.collect_list(F.struct("r", "vec_id", "score"))).alias("near"))
    own = queries.join(lists, queries["cid"] == lists["q"]).select("query_id", F.slice(F.filter(
        "near", lambda x: x["vec_id"] != F.col("query_id")), 1, k).alias("near"))
    flat = own.select("query_id", F.posexplode("near").alias("i", "x"))
    return flat.select("query_id", (F.col("i") + 1).cast("int").alias("rank"), "x.vec_id", "x.score")
