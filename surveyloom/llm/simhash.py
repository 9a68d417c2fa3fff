"""SimHash near-duplicates by anchor-point covering.

Anchors are the words of a covering code: nine blocks of the perfect (7,4) Hamming
code, so that every 63-bit string has one nearest anchor, one bit away at most in
each block (the last bit is left out). Two fingerprints at distance 2 or less have
a string between them that is within 1 of both; so each is sent to the anchors of
all strings within 1 of itself, about 25 of them, and such a pair meets at one.
At an anchor that holds few fingerprints they are compared. At a crowded one no
pairs are made: fingerprints within 2 of each other are those that share a string
within 1, so each is tied to the smallest fingerprint at each of its 65 strings.

Copies are one fingerprint throughout. A null text counts as empty; texts without
words have fingerprint zero and are linked like any other.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_by_value
from .common import materialise, parts_for

ship_by_value(__name__)

SHINGLE, SEED, DISTANCE = 3, 42, 2
CROWDED = 32   # fingerprints from which an anchor is resolved without pairs
EDGE_ROWS = 20_000   # edges that a partition holds, so that few edges make few files
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_ROWS = 1 << 16


def fingerprint_of(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64 bits: each is set if it is set in over half of the shingles' hashes."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    width = min(shingle, len(words))
    starts, stops = [0, *ends][:len(words) - width + 1], [e - 1 for e in ends[width - 1:]]
    hash_of = xxhash.xxh64_intdigest
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, len(starts), _ROWS):
        pairs = list(zip(starts[i:i + _ROWS], stops[i:i + _ROWS]))
        hashes = np.fromiter((hash_of(line[a:b], seed) for a, b in pairs), dtype=np.uint64, count=len(pairs))
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        # blocks of 255 rows fit the bytes they are summed in
        counts += np.add.reduceat(bits, np.arange(0, len(bits), 255), axis=0, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(starts)).tobytes(), "big")


def fingerprint(text: Column, shingle: int = SHINGLE, seed: int = SEED) -> Column:
    """bigint holding the 64 bits of the fingerprint of a text column."""
    @F.arrow_udf("bigint")
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            texts = part.cast(pa.binary() if pa.types.is_string(part.type) else pa.large_binary())
            found = np.fromiter((fingerprint_of(t.as_py() or b"", shingle, seed) for t in texts), dtype=np.uint64, count=len(part))
            yield pa.array(found.view(np.int64))

    return run(text.cast("string"))


def code_tables() -> tuple[np.ndarray, np.ndarray]:
    """For each 7-bit word: its nearest codeword, and up to three others that are
    nearest to a word one flip away (-1 where there are fewer)."""
    check = [[(p >> k) & 1 for p in range(1, 8)] for k in range(3)]
    syndrome = lambda w: sum((sum(c * ((w >> i) & 1) for i, c in enumerate(row)) & 1) << k for k, row in enumerate(check))
    near = [w ^ (1 << (s - 1)) if (s := syndrome(w)) else w for w in range(128)]
    others = [sorted({near[w ^ (1 << i)] for i in range(7)} - {near[w]}) for w in range(128)]
    return np.array(near, dtype=np.uint64), np.array([[*o, -1, -1, -1][:3] for o in others], dtype=np.int64)


def anchors_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, anchor): the anchors nearest to any string within 1 of each print."""
    near, others = code_tables()
    blocks = [((prints >> np.uint64(7 * b)) & np.uint64(127)).astype(np.int64) for b in range(9)]
    home = np.zeros_like(prints)
    for b, v in enumerate(blocks):
        home |= near[v] << np.uint64(7 * b)
    index, found = [np.arange(len(prints))], [home]
    for b, v in enumerate(blocks):
        rest = home & ~(np.uint64(127) << np.uint64(7 * b))
        for k in range(3):
            other = others[v, k]
            has = np.nonzero(other >= 0)[0]
            index.append(has)
            found.append(rest[has] | (other[has].astype(np.uint64) << np.uint64(7 * b)))
    return np.concatenate(index), np.concatenate(found)


def _at_anchors(batches):
    for batch in batches:
        prints = batch.column(0).to_numpy().view(np.uint64)
        for i in range(0, len(prints), _ROWS):
            part = prints[i:i + _ROWS]
            index, anchor = anchors_of(part)
            yield pa.RecordBatch.from_pydict({"anchor": anchor.view(np.int64), "fp": part[index].view(np.int64)})


def _balls(batches):
    flips = np.array([0, *(1 << b for b in range(64))], dtype=np.uint64)
    for batch in batches:
        prints = batch.column(0).to_numpy().view(np.uint64)
        for i in range(0, len(prints), 4096):
            part = prints[i:i + 4096]
            yield pa.RecordBatch.from_pydict({"spot": (part[:, None] ^ flips).ravel().view(np.int64),
                                              "fp": np.repeat(part, 65).view(np.int64)})


def links(prints: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """Edges (a, b) over distinct fingerprints (one bigint column ``fp``), enough to
    connect all that are within two bits of each other, directly or in steps."""
    spread = prints.select("fp").mapInArrow(_at_anchors, "anchor bigint, fp bigint")
    shared = spread.groupBy("anchor").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("n > 1")
    shared = materialise(shared)
    close = lambda df: df.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE).select("a", "b")
    twos = close(shared.where("n = 2"))
    more = materialise(spread.join(shared.where("n > 2").select("anchor", "n"), "anchor"))
    few = more.where(F.col("n") <= crowded).groupBy("anchor").agg(F.collect_list("fp").alias("fps"))
    few = close(few.select(F.explode("fps").alias("a"), "fps").select("a", F.explode("fps").alias("b")).where("a < b"))
    dense = more.where(F.col("n") > crowded).select("fp").distinct().mapInArrow(_balls, "spot bigint, fp bigint")
    least = dense.groupBy("spot").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1").select("spot", "a")
    stars = dense.join(least, "spot").where(F.col("fp") != F.col("a")).select("a", F.col("fp").alias("b"))
    return twos.unionByName(few).unionByName(stars).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge; root is the smallest node reachable.

    Alternates large-star and small-star rounds until the edges stay the same, however
    many that takes; each round is a minimum per node and a join with it, never a list
    per node. A round deals its edges several times, so they lie in as many partitions as
    their counted number asks for: few edges do not leave thousands of files on disk.
    """
    cur = materialise(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct())
    state = None
    while True:
        mark = cur.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == state:
            return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct().coalesce(parts))
        state = mark
        parts = parts_for(edges.sparkSession, mark[0], EDGE_ROWS)
        cur = cur.coalesce(parts)
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.coalesce(parts).distinct().coalesce(parts)
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u")
        cur = materialise(small.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                          .unionByName(down.select("u", F.col("m").alias("v"))).coalesce(parts).distinct().coalesce(parts))


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, component_id) for every row: the smallest id among all rows that
    are reachable over links, the row itself included. Null ids are passed over; a
    group without any other has a null component."""
    prints = materialise(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), fingerprint(F.col(f"`{text}`"), shingle).alias("fp")))
    classes = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(classes))
    joined = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    named = joined.join(smallest, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """One row of each group: that with the smallest id (one of them, if rows share it)."""
    return keep_smallest(docs, groups(docs, doc_id, text, shingle), doc_id)


def keep_smallest(docs: DataFrame, found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id is the component_id of their group in ``found``.

    Rows travel inside one struct, so columns of ``docs`` may have any names."""
    found = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = found.groupBy(F.col("doc_id").alias("keep")).agg(F.count("*").alias("n"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(f"`{doc_id}`").alias("id"))
    rows = rows.join(kept, F.col("id").eqNullSafe(F.col("keep")), "inner")
    single = rows.where("n = 1").select("doc")
    several = rows.where("n > 1").dropDuplicates(["id"]).select("doc")
    return single.unionByName(several).select("doc.*")
