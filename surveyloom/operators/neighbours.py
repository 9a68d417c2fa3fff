"""Exact k nearest neighbours with pivots and the triangle inequality, ring by ring.

About √rows rows are pivots and every row belongs to the cell of the nearest of them.
Cells whose pivots are close are kept together in blocks, a bounded number of them until
a block's vectors would fill ``BLOCK_BYTES``. A row goes to blocks in the order of their
pivots' distances, its own first and then more. Its k-th distance so far is its bound, and
a cell that the triangle inequality puts beyond the bound is never compared; a block of
such cells is not visited. As the bound gets tighter, most rows are done early.

A row travels once per block that it visits, however many cells of it are open. Rows on
their way to a block travel in chunks of bounded size, and the block is copied to a chunk
once; a task compares one chunk with one block and emits at most k candidates per row, so
the pairs themselves are never written.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, ship_by_value

ship_by_value(__name__)

BLOCK_ROWS = 2048
BLOCKS = 16             # blocks of a table, unless their vectors would be larger than that:
BLOCK_BYTES = 32 << 20
RING = 4                # blocks a row visits after its own, four times as many in each later ring
_PIECE = 1 << 22        # distances of a task that are held at once
_SCHEMA = "id bigint, neighbour_id bigint, distance double"


def _squares(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Squared distances by a matrix product; see :func:`_slack` for its rounding error."""
    return np.maximum((q * q).sum(axis=1)[:, None] + (x * x).sum(axis=1)[None, :] - 2.0 * (q @ x.T), 0.0)


def _slack(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """What a squared distance of :func:`_squares` may be off by, per row of ``q``."""
    return 1e-12 * q.shape[1] * ((q * q).sum(axis=1) + (x * x).sum(axis=1).max() + 1.0)


def _nearest(q: np.ndarray, own: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int, bound: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows of ``q``, distances, ids) of the top-k in ``x`` of the rows that have something
    within their bound, ties by id; gaps are infinite. A matrix product picks some more
    candidates than asked for, exact differences order them."""
    rough = _squares(q, x)
    rough[own[:, None] == ids[None, :]] = np.inf
    slack = 2 * _slack(q, x)
    who = np.flatnonzero(rough.min(axis=1) <= (bound * (1 + 1e-12)) ** 2 + slack)
    q, own, rough = q[who], own[who], rough[who]
    some = min(k + 8, len(x))
    picked = np.argpartition(rough, some - 1, axis=1)[:, :some]
    reach = np.take_along_axis(rough, picked, axis=1)
    limit = np.partition(reach, min(k, some) - 1, axis=1)[:, min(k, some) - 1] + slack[who]
    dist, near = np.full((len(q), k), np.inf), np.full((len(q), k), np.iinfo(np.int64).max)

    def add(rows, maybe):
        exact = np.sqrt(((x[maybe] - q[rows][:, None, :]) ** 2).sum(axis=2))
        exact[own[rows][:, None] == ids[maybe]] = np.inf
        order = np.lexsort((ids[maybe], exact), axis=1)[:, :k]
        dist[rows, :order.shape[1]] = np.take_along_axis(exact, order, axis=1)
        near[rows, :order.shape[1]] = np.take_along_axis(ids[maybe], order, axis=1)

    # rows with more ties at the limit than were picked are taken one by one
    crowded = (rough <= limit[:, None]).sum(axis=1) > some
    simple = np.flatnonzero(~crowded)
    for at in range(0, len(simple), 1024):
        add(simple[at:at + 1024], picked[simple[at:at + 1024]])
    for i in np.flatnonzero(crowded):
        add(np.array([i]), np.flatnonzero(rough[i] <= limit[i])[None, :])
    return who, dist, near


def _search(queries: pd.DataFrame, data: pd.DataFrame, points: np.ndarray, radius: np.ndarray, k: int) -> pd.DataFrame:
    """Top-k within their bounds of one chunk of rows against one block, cell by cell: each
    row's nearest cell first, then those that its bound leaves open."""
    q, own, theta = np.stack(queries["v"].to_numpy()).astype(float), queries["id"].to_numpy(), queries["theta"].to_numpy(float)
    data = data.sort_values("cell", kind="stable")
    x, ids = np.stack(data["v"].to_numpy()).astype(float), data["id"].to_numpy()
    cells, starts = np.unique(data["cell"].to_numpy(), return_index=True)
    ends = [*starts[1:], len(x)]
    far = np.sqrt(_squares(q, points[cells])) - radius[cells]      # no row of the cell is nearer
    slack = np.sqrt(2 * _slack(q, points)) + 1e-9
    home = (far + radius[cells]).argmin(axis=1)
    dist, near = np.full((len(q), k), np.inf), np.full((len(q), k), np.iinfo(np.int64).max)
    bound = theta.copy()
    for first in (True, False):
        for c, (start, end) in enumerate(zip(starts, ends)):
            rows = np.flatnonzero((home == c) == first)
            rows = rows[far[rows, c] <= bound[rows] + slack[rows]]
            step = max(1, _PIECE // (end - start))
            for at in range(0, len(rows), step):
                some = rows[at:at + step]
                who, d, i = _nearest(q[some], own[some], x[start:end], ids[start:end], k, bound[some])
                some = some[who]
                d, i = np.hstack([dist[some], d]), np.hstack([near[some], i])
                best = np.lexsort((i, d), axis=1)[:, :k]
                dist[some], near[some] = np.take_along_axis(d, best, axis=1), np.take_along_axis(i, best, axis=1)
                bound[some] = np.minimum(bound[some], dist[some, -1])
    who, place = np.nonzero(np.isfinite(dist) & (dist <= theta[:, None]))
    return pd.DataFrame({"id": own[who], "neighbour_id": near[who, place], "distance": dist[who, place]})


def _pack(cells: list[int], sizes: np.ndarray, points: np.ndarray, rows: int) -> list[list[int]]:
    """Cells in groups of up to ``rows`` rows, those around one of the first pivots next to
    each other; a larger cell is a group of its own."""
    lead = _squares(points[cells], points[:BLOCKS])
    out, held = [], 0
    for i in np.lexsort((lead.min(axis=1), lead.argmin(axis=1))):
        n = int(sizes[cells[i]])
        if not out or held + n > rows:
            out.append([])
            held = 0
        out[-1].append(cells[i])
        held += n
    return out


def knn_join(df: DataFrame, row_id: str, vector: str, k: int, block_rows: int = BLOCK_ROWS,
             pivots: int | None = None) -> DataFrame:
    """(id, neighbour_id, distance, rank) for the k nearest other rows by
    Euclidean distance; ties go to the smaller id. Exact.

    Equal vectors are searched once. At most k + 1 ids of a group of copies can
    be an answer, so the size of the group does not matter to the search.
    """
    narrow = df.schema[vector].dataType.simpleString() == "array<float>"   # half the bytes on their way, exact as doubles
    base = df.filter(F.col(vector).isNotNull()).select(
        F.col(row_id).cast("bigint").alias("id"), F.col(vector).cast("array<float>" if narrow else "array<double>").alias("v"))
    first = Window.partitionBy("v").orderBy("id")
    groups = cut_lineage(
        base.withColumn("_i", F.row_number().over(first)).filter(F.col("_i") <= k + 1)
        .groupBy("v").agg(F.min("id").alias("id"), F.array_sort(F.collect_list("id")).alias("ids")))
    near = _knn_distinct(groups.select("id", "v"), k, block_rows, pivots)
    if groups.filter(F.size("ids") > 1).limit(1).count() == 0:
        return near
    members = groups.select(F.col("id").alias("neighbour_id"), "ids")
    found = near.join(members, "neighbour_id").select("id", "distance", F.explode("ids").alias("nid")).unionByName(
        groups.select("id", F.lit(0.0).alias("distance"), F.explode("ids").alias("nid")))
    best = Window.partitionBy("id").orderBy("distance", "nid")
    listed = found.withColumn("_i", F.row_number().over(best)).filter(F.col("_i") <= k + 1).groupBy("id").agg(
        F.array_sort(F.collect_list(F.struct("distance", "nid"))).alias("_near"))
    answers = groups.select("id", "v").join(listed, "id").select("v", "_near")
    others = F.slice(F.filter("_near", lambda s: s["nid"] != F.col("id")), 1, k)
    return base.join(answers, "v").select("id", F.posexplode(others).alias("_p", "_s")).select(
        "id", F.col("_s.nid").alias("neighbour_id"), "_s.distance", (F.col("_p") + 1).alias("rank"))


def _knn_distinct(base: DataFrame, k: int, block_rows: int, pivots: int | None) -> DataFrame:
    """The search over distinct vectors; one with a part that is no finite number has no distances."""
    base = base.filter(F.forall("v", lambda x: F.abs(x) < float("inf")))
    context, total = base.sparkSession.sparkContext, base.count()
    if total == 0:
        return base.select("id", F.col("id").alias("neighbour_id"), F.lit(0.0).alias("distance"), F.lit(1).alias("rank")).limit(0)
    # a few MB of pivots for a billion rows
    wanted = pivots or (1 if total <= block_rows else min(math.isqrt(total), -(-4 * total // block_rows)))
    chosen = base.orderBy(F.xxhash64("id"), "id").limit(wanted).collect()
    points = np.array([r["v"] for r in chosen], dtype=float)
    shared = context.broadcast(points)

    @F.pandas_udf("cell int, far double")
    def home(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for v in batches:
            q = np.stack(v.to_numpy()).astype(float)
            d = _squares(q, shared.value)
            cell = d.argmin(axis=1)
            yield pd.DataFrame({"cell": cell.astype(np.int32), "far": np.sqrt(d[np.arange(len(q)), cell] + _slack(q, shared.value))})

    dealt = base.withColumn("_h", home("v"))
    stats = {r["cell"]: r for r in dealt.groupBy("_h.cell").agg(F.count(F.lit(1)).alias("n"), F.max("_h.far").alias("far")).collect()}
    sizes = np.array([stats[c]["n"] if c in stats else 0 for c in range(len(points))])
    limit = max(block_rows, min(-(-total // BLOCKS), BLOCK_BYTES // (8 * max(points.shape[1], 1))))
    groups = _pack(sorted(stats), sizes, points, limit)
    radius = context.broadcast(np.array([stats[c]["far"] if c in stats else -1.0 for c in range(len(points))]))
    # cells in the order of their groups, and where each group starts
    listed = np.array([c for group in groups for c in group])
    starts = np.cumsum([0, *map(len, groups)])[:-1]
    many = [max(1, -(-int(sizes[group].sum()) // limit)) for group in groups]
    session = base.sparkSession
    blocks = session.createDataFrame(list(enumerate(many)), "part int, blocks int")
    placed = session.createDataFrame([(c, g, many[g]) for g, group in enumerate(groups) for c in group], "cell int, part int, blocks int")
    rows = cut_lineage(dealt.select("id", "v", F.col("_h.cell").alias("cell")).join(F.broadcast(placed), "cell").select(
        "id", "v", "cell", "part", F.pmod(F.xxhash64("id"), "blocks").cast("int").alias("block")))

    @F.pandas_udf("parts array<int>, seen int, more boolean")
    def ring(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for v, theta, seen, wide in batches:
            q, bound, first, take = np.stack(v.to_numpy()).astype(float), theta.to_numpy(float), seen.to_numpy(), wide.to_numpy()
            d = np.sqrt(_squares(q, shared.value))[:, listed]
            slack = np.sqrt(2 * _slack(q, shared.value)) + 1e-9
            open_ = np.minimum.reduceat(d - radius.value[listed], starts, axis=1) <= (bound + slack)[:, None]
            order = np.argsort(np.minimum.reduceat(d, starts, axis=1), axis=1, kind="stable")
            reached = np.take_along_axis(open_, order, axis=1)
            parts, more = [], []
            for i, (at, n) in enumerate(zip(first, take)):
                parts.append(order[i, at:at + n][reached[i, at:at + n]].astype(np.int32))
                more.append(bool(reached[i, at + n:].any()))
            yield pd.DataFrame({"parts": parts, "seen": (first + take).astype(np.int32), "more": more})

    def compare(key, q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        if q.empty or x.empty:
            return pd.DataFrame({"id": pd.Series(dtype="int64"), "neighbour_id": pd.Series(dtype="int64"), "distance": pd.Series(dtype="float64")})
        return _search(q, x, shared.value, radius.value, k)

    order = Window.partitionBy("id").orderBy("distance", "neighbour_id")
    state = rows.select("id", "v", F.lit(float("inf")).alias("theta"), F.lit(0).alias("seen"))
    best, wide = None, 1
    while True:
        state = cut_lineage(state.withColumn("_r", ring("v", "theta", "seen", F.lit(wide))))
        visits = state.select("id", "v", "theta", F.explode("_r.parts").alias("part")).join(F.broadcast(blocks), "part").select(
            "id", "v", "theta", "part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        chunks = F.broadcast(visits.groupBy("part", "block").agg(F.ceil(F.count(F.lit(1)) / limit).cast("int").alias("chunks")))
        spread = visits.join(chunks, ["part", "block"]).select(
            "id", "v", "theta", "part", "block", F.pmod(F.xxhash64("id"), "chunks").cast("int").alias("chunk"))
        data = rows.join(chunks, ["part", "block"]).select(
            "id", "v", "cell", "part", "block", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
        data = data.select(*[F.col(c).alias(c) for c in data.columns])
        spot = ["part", "block", "chunk"]
        found = spread.groupBy(*spot).cogroup(data.groupBy(*spot)).applyInPandas(compare, _SCHEMA)
        found = found if best is None else best.drop("rank").unionByName(found)
        best = cut_lineage(found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k))
        left = state.filter("_r.more").select("id", "v", F.col("_r.seen").alias("seen"))
        if left.isEmpty():
            return best.select("id", "neighbour_id", "distance", "rank")
        bound = best.groupBy("id").agg(F.when(F.count(F.lit(1)) >= k, F.max("distance")).otherwise(F.lit(float("inf"))).alias("theta"))
        state = left.join(bound, "id", "left").withColumn("theta", F.coalesce("theta", F.lit(float("inf"))))
        wide = RING if wide == 1 else 4 * wide
