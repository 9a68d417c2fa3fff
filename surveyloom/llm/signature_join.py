"""Jaccard join of word n-grams through signature trees.

Equal shingle sets are one entry. Two similar entries share one of the first tokens of
their sets in any common order of tokens; the order is by an approximate corpus count
from a bounded sketch, rarest first, so a common passage brings no strangers together.
Entries that share such a token form a group, and groups of the same members are one.
What two entries can share at most follows from the places of the first token that both
have; an entry stays in a group only if some other member leaves enough.

In a group every entry is a signature: a bitmap of its tokens, of a width that follows
from its size. Signature trees are built over blocks of a group; a node holds the
OR of the bitmaps below, their range of sizes and the most tokens that share a bit. The
trees of two blocks are traversed together, and a pair of nodes is left as soon as the
largest overlap that their bitmaps and sizes allow is too small, or all below is known
to be connected. What reaches the leaves is a candidate.

Candidates only need to connect what the links connect, so a round proposes a forest:
a pair whose ends are not connected yet. Proposals are checked on the whole sets; the
links merge their ends, the others are remembered, and rounds go on until none is left.
A group of near copies thus costs about as many comparisons as it has members.

A null text counts as empty. Without words a set is empty and linked with nothing, not
even its copies. Null ids are passed over when the smallest id is taken.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..session import ship_by_value
from .common import counted, materialise, parts_for
from .simhash import components
from .sketch import Counter, SCHEMA as SKETCH, SEGMENT, cells_for, merged

ship_by_value(__name__)

SHINGLE, PERCENT = 4, 85
CELLS_A_ROW, MOST_CELLS = 8, 1 << 24      # at most 64 MB in a task and 16 MB broadcast
BLOCK, FAN = 8192, 16
BROADCAST_ROWS = 200_000
SET_ROWS = 5_000      # rows with whole sets that a partition holds
SEARCHES = 4          # tasks of a search or a comparison for each partition of its rows
PLACE_BITS = 16       # low bits of a spread token that hold its place in the set
FEW = 64              # members of a token that are looked at pair by pair before they form a group
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


# ---------------------------------------------------------------- sets of shingles

def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all runs of ``width`` words; fewer words are one
    run. A run's hash is a chain over the hashes of its words."""
    words = text.translate(_LOWER).split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    run = min(width, len(words))
    chain = np.full(len(words) - run + 1, run, dtype=np.uint64)
    for k in range(run):
        chain = _mix(chain ^ hashes[k:len(words) - run + 1 + k])
    return np.unique(chain)


def least_overlap(n: int, percent: int = PERCENT) -> int:
    """Tokens that a set of ``n`` shares with any similar one."""
    return -(-percent * n // 100)


def _texts(column: pa.Array) -> Iterator[bytes]:
    return (t.as_py() or b"" for t in column)


def _key(found: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(found.tobytes())


def entries(docs: DataFrame, cells: int, width: int = SHINGLE) -> tuple[DataFrame, np.ndarray]:
    """((doc_id, key, n) per row, the class of counts of each sketch cell): both from one
    pass over the texts."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    nothing = to_arrow_type(docs.schema["doc_id"].dataType)

    def run(batches):
        own = Counter(cells, np.uint32)
        for batch in batches:
            sets = [shingles(t, width) for t in _texts(batch.column(1))]
            for k in range(0, len(sets), 256):
                own.add(np.concatenate(sets[k:k + 256]) & np.uint64(cells - 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(_key, sets), pa.binary()), pa.array([len(s) for s in sets], pa.int64()),
                 pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.binary())], names=["doc_id", "key", "n", "segment", "counts"])
        for part in own.segments():
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, nothing), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int64()), *part.columns], names=["doc_id", "key", "n", "segment", "counts"])

    rows = materialise(docs.mapInArrow(run, f"doc_id {kind}, key binary, n bigint, {SKETCH}"))
    found = merged(rows.where("segment is not null").select("segment", "counts"), np.uint32,
                          reduce=lambda total: np.ceil(np.log2(total.astype(float) + 1) * 4).astype(np.uint8).tobytes())
    classes = np.zeros(cells, dtype=np.uint8)
    for segment, part in found.items():
        classes[segment * SEGMENT:segment * SEGMENT + len(part)] = np.frombuffer(part, dtype=np.uint8)
    return rows.where("segment is null").select("doc_id", "key", "n"), classes


def first_tokens(found: np.ndarray, classes: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The tokens of a set, rarest first, of which any similar set shares one."""
    some = len(found) - least_overlap(len(found), percent) + 1
    rank = classes[found & np.uint64(len(classes) - 1)]
    return found[np.lexsort((found, rank))[:some]]


def spread(docs: DataFrame, classes, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(token, key, n): every entry under each of its first tokens, copies mostly once. The
    low bits of a token are its place (at most the largest that they hold); tokens that are
    alike in the bits left only meet more."""
    most = (1 << PLACE_BITS) - 1

    def run(batches):
        seen: set[bytes] = set()
        for batch in batches:
            tokens, keys, sizes = [], [], []
            for t in _texts(batch.column(1)):
                found = shingles(t, width)
                key = _key(found)
                if not len(found) or key in seen:
                    continue
                if len(seen) > 1 << 20:
                    seen.clear()
                seen.add(key)
                first = first_tokens(found, classes.value, percent)
                place = np.minimum(np.arange(len(first)), most).astype(np.uint64)
                tokens.append(first >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS) | place)
                keys += [key] * len(tokens[-1])
                sizes += [len(found)] * len(tokens[-1])
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens).view(np.int64)), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64())],
                                                 names=["token", "key", "n"])

    return docs.mapInArrow(run, "token bigint, key binary, n bigint")


# ---------------------------------------------------------------- signatures and trees

def signature(found: np.ndarray) -> np.ndarray:
    """Bitmap (64-bit words) of a set, four to eight bits a token and 2048 at least."""
    bits = max(2048, 4 << int(len(found) - 1).bit_length())
    spots = np.unique(found & np.uint64(bits - 1))
    out = np.zeros(bits // 64, dtype=np.uint64)
    np.bitwise_or.at(out, (spots >> np.uint64(6)).astype(np.int64), np.uint64(1) << (spots & np.uint64(63)))
    return out


def fold(bitmaps: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps at a smaller width: a token's bit is its hash modulo the width."""
    while bitmaps.shape[-1] > words:
        half = bitmaps.shape[-1] // 2
        bitmaps = bitmaps[..., :half] | bitmaps[..., half:]
    return bitmaps


class Tree:
    """Entries of one width, sorted by size, under nodes of ``FAN`` children each. A level
    holds bitmaps, smallest and largest size, and the most tokens hidden by shared bits."""

    def __init__(self, sizes: np.ndarray, bitmaps: np.ndarray):
        hidden = sizes - np.bitwise_count(bitmaps).sum(axis=1, dtype=np.int64)
        self.levels = [(bitmaps, sizes, sizes, hidden)]
        while len(self.levels[-1][1]) > 1:
            bits, low, high, hid = self.levels[-1]
            at = np.arange(0, len(low), FAN)
            self.levels.append((np.bitwise_or.reduceat(bits, at, axis=0), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at),
                                np.maximum.reduceat(hid, at)))

    def at(self, words: int) -> Tree:
        """The same tree with bitmaps of ``words`` words."""
        if self.levels[0][0].shape[1] == words:
            return self
        return Tree(self.levels[0][1], fold(self.levels[0][0], words))


def possible(left, i, right, j, percent: int = PERCENT) -> np.ndarray:
    """Whether anything below node i can be similar to anything below node j: from sizes,
    and from the tokens that can lie in the bits which both have."""
    bits, low, high, hidden = left
    bits2, low2, high2, hidden2 = right
    both = np.bitwise_count(bits[i] & bits2[j]).sum(axis=1, dtype=np.int64)
    most = np.minimum(np.minimum(high[i], high2[j]), both + np.minimum(hidden[i], hidden2[j]))
    return ((100 + percent) * most >= percent * (low[i] + low2[j])) & (100 * high[i] >= percent * low2[j]) & (100 * high2[j] >= percent * low[i])


_PAIRS = 1 << 14


def candidates(a: Tree, b: Tree, same: bool, apart, percent: int = PERCENT) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of entries (i of a, j of b; i < j within one tree) that the trees cannot rule
    out, depth first in bounded pieces. ``apart(level_a, i, level_b, j)`` says which pairs
    of nodes still have something to connect.

    The left node opens first: one entry's own tokens rule out more than a node's do."""
    steps = np.arange(FAN)
    stack = [(len(a.levels) - 1, len(b.levels) - 1, np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64))]
    while stack:
        x, y, i, j = stack.pop()
        if len(i) > _PAIRS:
            stack += [(x, y, i[k:k + _PAIRS], j[k:k + _PAIRS]) for k in range(0, len(i), _PAIRS)][::-1]
            continue
        if same:
            keep = i * FAN ** x < (j + 1) * FAN ** y - 1   # some entry of j comes after the first of i
            i, j = i[keep], j[keep]
        keep = apart(x, i, y, j)
        i, j = i[keep], j[keep]
        keep = possible(a.levels[x], i, b.levels[y], j, percent)
        i, j = i[keep], j[keep]
        if not len(i):
            continue
        if x == y == 0:
            yield i, j
        elif x > 0:
            i, j = (i[:, None] * FAN + steps).ravel(), np.repeat(j, FAN)
            keep = i < len(a.levels[x - 1][1])
            stack.append((x - 1, y, i[keep], j[keep]))
        else:
            i, j = np.repeat(i, FAN), (j[:, None] * FAN + steps).ravel()
            keep = j < len(b.levels[y - 1][1])
            stack.append((x, y - 1, i[keep], j[keep]))


def forest(left: pd.DataFrame, right: pd.DataFrame | None, percent: int = PERCENT, doubtful: int = 0) -> list[tuple[bytes, bytes]]:
    """Proposals that connect what may be similar between two blocks (or within ``left``).

    The first ``doubtful`` candidates are proposed without taking them for links; each
    one after that connects its ends, so that others between them are left out.

    Blocks have key, n, signature, root (what is connected already has one root) and
    failed (keys that an earlier check found not similar)."""
    rows = left if right is None else pd.concat([left, right], ignore_index=True)
    names, root = np.unique(rows["root"].to_numpy(dtype=object), return_inverse=True)
    side = np.zeros(len(rows), dtype=np.int64) if right is None else (np.arange(len(rows)) >= len(left)).astype(np.int64)
    sizes, keys = rows["n"].to_numpy(dtype=np.int64), rows["key"].tolist()
    words = np.array([len(s) // 8 for s in rows["signature"]])
    failed = [set(f) if f is not None and len(f) else () for f in rows["failed"]]
    common = np.bincount(root).argmax()
    trees: dict[tuple[int, int], tuple[np.ndarray, Tree]] = {}
    for s, w in sorted(set(zip(side.tolist(), words.tolist()))):
        at = np.nonzero((side == s) & (words == w))[0]
        at = at[np.lexsort((sizes[at], root[at] != common))]   # what is connected already lies together
        bitmaps = np.frombuffer(b"".join(rows["signature"].iloc[k] for k in at), dtype=np.uint64).reshape(len(at), w)
        trees[s, w] = at, Tree(sizes[at], bitmaps)
    out = []

    def visit(a, b, same):
        nonlocal doubtful
        (at, one), (bt, two) = a, b
        width = min(one.levels[0][0].shape[1], two.levels[0][0].shape[1])
        one, two = one.at(width), two.at(width)

        def apart(x, i, y, j):
            # roots that are alike below both nodes: nothing to connect
            (low, high), (low2, high2) = spans(at, x), spans(bt, y)
            return (low[i] != high[i]) | (low2[j] != high2[j]) | (low[i] != low2[j])

        cache = {}

        def spans(places, level):
            key = (id(places), level)
            if key not in cache:
                r = root[places]
                low = high = r
                for _ in range(level):
                    k = np.arange(0, len(low), FAN)
                    low, high = np.minimum.reduceat(low, k), np.maximum.reduceat(high, k)
                cache[key] = low, high
            return cache[key]

        for i, j in candidates(one, two, same, apart, percent):
            p, q = at[i], bt[j]
            while len(p):
                keep = root[p] != root[q]
                p, q = p[keep], q[keep]
                ok = [k for k in range(len(p)) if keys[q[k]] not in failed[p[k]] and keys[p[k]] not in failed[q[k]]] if any(failed) else range(len(p))
                if not len(ok):
                    break
                if doubtful > 0:
                    out.extend((keys[p[k]], keys[q[k]]) for k in ok[:doubtful])
                    doubtful -= len(ok)
                    rest = ok[len(ok) + doubtful:] if doubtful < 0 else []
                    p, q = p[rest], q[rest]
                    continue
                k = ok[0]
                out.append((keys[p[k]], keys[q[k]]))
                old, new = root[q[k]], root[p[k]]
                root[root == old] = new
                cache.clear()
                p, q = p[k + 1:], q[k + 1:]

    own = list(trees.items())
    for n, ((s, w), a) in enumerate(own):
        for (s2, w2), b in own[n:]:
            if right is None and (s, w) == (s2, w2):
                visit(a, a, True)
            elif right is None or s != s2:
                # compatible sizes lie in the same width or the next
                if max(w, w2) <= 2 * min(w, w2):
                    visit(a, b, False)
    return out


# ---------------------------------------------------------------- the join in Spark

def _groups(tokens: DataFrame, percent: int) -> DataFrame:
    """(g, key, n, c, band): groups of two or more entries, each with another one whose
    size and place of the token allow a link; of groups with the same members one.

    Two similar entries meet under the first token that both have, before which neither has
    one of the other's: they share at most what is left of each from there on. So a row has
    a largest size ``u`` of the other, and a pair needs both. Up to ``FEW`` members of a
    token are held against each other, more are taken as they are.

    Rows are dealt by token once: copies are dropped, groups counted and their members
    found on that partitioning. Links stay in a band of sizes or go to the next."""
    width = float(-np.log(percent / 100)) * 1.01   # a little wider than the ratio that a link allows
    token, place = F.shiftrightunsigned("token", PLACE_BITS), F.col("token").bitwiseAND((1 << PLACE_BITS) - 1)
    members = tokens.repartition(token).select(token.alias("t"), place.alias("place"), "key", "n").groupBy("t", "key").agg(
        F.min("place").alias("place"), F.min("n").alias("n"))
    inside = Window.partitionBy("t")
    shared = members.withColumn("c", F.count("*").over(inside)).where("c > 1")
    shared = shared.withColumn("u", F.expr(f"({100 + percent} * (n - place)) div {percent} - n"))
    shared = shared.withColumn("others", F.collect_list(F.when(F.col("c") <= FEW, F.struct("n", "u"))).over(inside))
    fits = F.filter("others", lambda o: (o["n"] <= F.col("u")) & (o["u"] >= F.col("n")) & (100 * o["n"] >= percent * F.col("n"))
                    & (100 * F.col("n") >= percent * o["n"]))
    # a row that allows its own size is among the others itself
    shared = shared.where((F.col("c") > FEW) | (F.size(fits) > (F.col("u") >= F.col("n")).cast("int"))).withColumn(
        "band", F.floor(F.log(F.col("n").cast("double")) / width).cast("int"))
    shared = shared.withColumns({"c": F.count("*").over(inside), "x": F.bit_xor(F.xxhash64("key")).over(inside),
                                 "y": F.bit_xor(F.xxhash64(F.lit(1), "key")).over(inside)}).where("c > 1")
    # a group is named by its members, so those of several tokens fall together
    shared = shared.select(F.xxhash64("c", "x", "y").alias("g"), "key", "n", "c", "band")
    found, rows = counted(shared.dropDuplicates(["g", "key"]))
    parts = parts_for(tokens.sparkSession, rows)
    near = found.groupBy("g", "band").agg(F.count("*").alias("m")).coalesce(parts).select("g", F.explode(F.array(
        F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"), "m")
    near = near.groupBy("g", "band").agg(F.sum("m").alias("m")).where("m > 1").select("g", "band")
    return found.join(near, ["g", "band"], "left_semi").select("g", "key", "n", "c", "band").coalesce(parts)


def _signed(batches):
    for batch in batches:
        sets = [shingles(t) for t in _texts(batch.column(0))]
        yield pa.RecordBatch.from_arrays([pa.array(map(_key, sets), pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary()),
                                          pa.array([signature(s).tobytes() if len(s) else b"" for s in sets], pa.binary())],
                                         names=["key", "found", "signature"])


def _similar(percent: int):
    def run(batches):
        for batch in batches:
            good = []
            for a, b in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (a, b))
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(good, pa.bool_())], names=["a", "b", "good"])

    return run


def _maybe(percent: int):
    """(a, b) of the rows (a, n, signature, b, m, signature) that may be similar."""
    def run(batches):
        for batch in batches:
            a, n, x, b, m, y = batch.columns
            good = []
            for p, u, q, v in zip(n.to_pylist(), x, m.to_pylist(), y):
                u, v = (np.frombuffer(w.as_buffer(), dtype=np.uint64) for w in (u, v))
                width = min(len(u), len(v))
                u, v = fold(u, width), fold(v, width)
                both = int(np.bitwise_count(u & v).sum())
                most = both + min(p - int(np.bitwise_count(u).sum()), q - int(np.bitwise_count(v).sum()))
                good.append((100 + percent) * min(p, q, most) >= percent * (p + q))
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def _blocks(groups: DataFrame, block: int) -> DataFrame:
    """Adds ``share``: a group of up to ``block`` entries is one block; of a larger one each
    band of sizes is cut into equal shares by hash."""
    large = groups.where(F.col("c") > block)
    counts = large.groupBy(F.col("g").alias("_g"), F.col("band").alias("_b")).agg(F.count("*").alias("_m"))
    share = F.pmod(F.xxhash64("key"), F.ceil(F.col("_m") / block).cast("bigint")).cast("int")
    large = large.join(counts, (F.col("g") == F.col("_g")) & (F.col("band") == F.col("_b"))).withColumn("share", share)
    small = groups.where(F.col("c") <= block).withColumns({"band": F.lit(0), "share": F.lit(0)})
    out = ["g", "band", "share", "key", "n", "c"]
    return small.select(out).unionByName(large.select(out))


def _small(df: DataFrame) -> DataFrame:
    """A written table of keys, marked for broadcast if its counted rows are few MB."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def links(docs: DataFrame, classes: DataFrame, found: np.ndarray, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """(node, root) of the entries that are similar to another, directly or in steps.

    First each group is compared with its centre, the entry that shares the most, which
    connects a group of near copies at once. Then the trees of the blocks are searched:
    within blocks, and then between the blocks of a group.

    A round is many small shuffles: their results lie in as many partitions as the counted
    rows they come from ask for, so that few rows do not make thousands of tasks and files."""
    spark = docs.sparkSession
    order = spark.sparkContext.broadcast(found)
    # tokens travel with a 64-bit hash of the key; what is left of them gets all keys of it
    tokens = spread(docs, order, percent=percent).withColumn("key", F.xxhash64("key"))
    met, n_met = counted(_groups(tokens, percent).withColumnRenamed("key", "short"))
    parts = parts_for(spark, n_met)
    named = materialise(classes.withColumn("short", F.xxhash64("key")).join(
        _small(materialise(met.select("short").distinct().coalesce(parts))), "short", "left_semi").coalesce(parts))
    groups = materialise(met.join(_small(named.select("short", "key")), "short").select("g", "key", "n", "c", "band").coalesce(parts))
    keys = named.select("key")
    ids = materialise(named.select(F.col("least").alias("_id")).distinct().coalesce(parts))
    texts = docs.join(_small(ids), F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi").select("text")
    sets, n_sets = counted(texts.mapInArrow(_signed, "key binary, found binary, signature binary").join(_small(keys), "key", "left_semi"), SET_ROWS)
    if n_sets > keys.count():   # rows that repeat an id
        sets = materialise(sets.dropDuplicates(["key"]).coalesce(parts_for(spark, n_sets, SET_ROWS)))
    placed = materialise(_blocks(groups, block).coalesce(parts))
    pair = "a binary, b binary"
    checked: list[DataFrame] = []

    def check(pairs: DataFrame) -> DataFrame:
        """The roots after the distinct ``pairs`` were compared on their whole sets."""
        pairs = materialise(pairs)
        # each side picks its sets first, so that only sets of a pair travel
        left = sets.select(F.col("key").alias("a"), F.col("found").alias("x")).join(_small(pairs), "a")
        right = sets.select(F.col("key").alias("b"), F.col("found").alias("y")).join(_small(pairs.select(*[F.col(c).alias(c) for c in "ab"])), "b")
        both = left.join(right, ["a", "b"]).select("a", "b", "x", "y").coalesce(SEARCHES * parts)
        checked.append(materialise(both.mapInArrow(_similar(percent), f"{pair}, good boolean")))
        good = checked[0]
        for more in checked[1:]:
            good = good.unionByName(more)
        return materialise(components(good.where("good").select("a", "b")))

    # the centre of a group; narrow pairs first, signatures once for each
    shared = groups.groupBy("key").agg(F.sum("c").alias("shared"))
    centres = groups.join(shared, "key").coalesce(parts).groupBy("g").agg(F.max(F.struct("shared", "key", "n")).alias("_c"))
    stars = groups.join(centres, "g").where(F.col("key") != F.col("_c.key")).select(
        F.col("key").alias("a"), "n", F.col("_c.key").alias("b"), F.col("_c.n").alias("m"))
    stars = stars.where(100 * F.least("n", "m") >= percent * F.greatest("n", "m")).coalesce(parts).distinct().coalesce(parts)
    stars = stars.join(sets.select(F.col("key").alias("a"), F.col("signature").alias("x")), "a").coalesce(SEARCHES * parts).join(
        sets.select(F.col("key").alias("b"), F.col("signature").alias("y")), "b").select("a", "n", "x", "b", "m", "y").coalesce(SEARCHES * parts)
    stars = stars.mapInArrow(_maybe(percent), pair)
    roots = check(stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().coalesce(parts))

    def rows_now(again: DataFrame | None, least: int) -> DataFrame:
        """The members of all groups of more than ``least`` that are not connected yet, with
        what is known of them."""
        known = roots.select(F.col("node").alias("key"), "root")
        rows = placed.where(F.col("c") > least)
        rows = rows if again is None else rows.join(again, "g", "left_semi")
        rows = rows.join(known, "key", "left").withColumn("root", F.coalesce("root", "key")).coalesce(parts)
        several = rows.groupBy("g").agg(F.min("root").alias("_a"), F.max("root").alias("_b")).where("_a != _b").select("g")
        bad = None
        for part in checked:
            bad = part.where("not good") if bad is None else bad.unionByName(part.where("not good"))
        failed = bad.groupBy(F.col("a").alias("key")).agg(F.collect_set("b").alias("failed"))
        rows = materialise(rows.join(several, "g", "left_semi").coalesce(parts).join(failed, "key", "left").coalesce(parts))
        # most signatures are settled after the first round: only those still asked for travel
        wanted = materialise(rows.select("key").distinct().coalesce(parts))
        return materialise(rows.join(sets.select("key", "signature").join(_small(wanted), "key", "left_semi"), "key").coalesce(SEARCHES * parts))

    def within(rows: DataFrame, doubtful: int) -> DataFrame:
        spot = ["g", "band", "share"]
        several = rows.groupBy(*spot).agg(F.min("root").alias("_a"), F.max("root").alias("_b")).where("_a != _b").select(*spot)
        def propose(key, part):
            return pd.DataFrame([(key[0], *p) for p in forest(part, None, percent, doubtful)], columns=["g", "a", "b"])
        return rows.join(several, spot, "left_semi").groupBy(*spot).applyInPandas(propose, f"g bigint, {pair}")

    def between(rows: DataFrame, doubtful: int) -> DataFrame:
        # pairs of blocks of one group: their number, not that of the entries, counts
        blocks = rows.groupBy("g", "band", "share").agg(F.min("root").alias("low"), F.max("root").alias("high"))
        other = blocks.select("g", *[F.col(c).alias(f"{c}2") for c in ("band", "share", "low", "high")])
        pairs = blocks.join(other, "g").where("(band2 = band and share2 > share) or band2 = band + 1").where("low != high or low2 != high2 or low != low2")
        spot = ["g", "band", "share", "band2", "share2"]
        pairs = materialise(pairs.select(*spot))
        first = rows.join(pairs, ["g", "band", "share"])
        other = rows.select(*[F.col(c).alias(f"{c}2" if c in ("band", "share") else c) for c in rows.columns])
        second = other.join(pairs.select(*[F.col(c).alias(c) for c in spot]), ["g", "band2", "share2"])
        def propose(key, left, right):
            return pd.DataFrame([(key[0], *p) for p in forest(left, right, percent, doubtful)], columns=["g", "a", "b"])
        return first.groupBy(*spot).cogroup(second.groupBy(*spot)).applyInPandas(propose, f"g bigint, {pair}")

    # two entries were compared as centre and member; only larger groups than a block have several
    for search, least in ((within, 2), (between, block)):
        again, doubtful = None, 0
        while True:
            rows = rows_now(again, least)
            found_pairs = materialise(search(rows, doubtful).coalesce(SEARCHES * parts).select("g", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
            if found_pairs.isEmpty():
                break
            roots = check(found_pairs.select("a", "b").distinct().coalesce(parts))
            # a group is settled unless a proposal of it failed
            again = materialise(found_pairs.join(checked[-1].where("not good"), ["a", "b"]).select("g").distinct().coalesce(parts))
            if again.isEmpty():
                break
            # where proposals fail, many more are checked at a time
            doubtful = 4 * doubtful or 256
    return roots


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row: the size of its set and the
    smallest id among all rows reachable over links, the row itself included."""
    docs = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").cast("binary").alias("text"))
    total = docs.count()
    parts = parts_for(docs.sparkSession, total)
    rows, found = entries(docs, cells_for(total, CELLS_A_ROW, MOST_CELLS))
    classes = materialise(rows.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("least")).coalesce(parts))
    roots = links(docs, classes, found, percent, block)
    joined = classes.join(roots, F.col("key") == F.col("node"), "left").select("key", "least", F.coalesce("root", "key").alias("root")).coalesce(parts)
    smallest = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    named = joined.join(smallest, "root").select("key", "component_id").coalesce(parts)
    some = rows.where("n > 0").join(named, "key").select("doc_id", F.col("n").alias("n_shingles"), "component_id").coalesce(parts)
    none = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return some.unionByName(none)
