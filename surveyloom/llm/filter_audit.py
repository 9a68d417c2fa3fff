"""How filters interact: what every filter removes at every place of every order.

One pass over the texts gives each document a mask of the filters that it fails. For
the filter "same text as a smaller id" a counting Bloom sketch comes first: each task
counts its texts in one small array, the merged counts prove most texts unique, and
only the rest is shuffled with its full text for the exact smallest id.

Counts per (part, mask, labels) are additive, so all orders follow from them: at its
place in an order a filter removes the documents that fail it and none before it.

A null text counts as empty, a null part as the empty string. Null ids are neither
smaller nor larger than any other, so such rows never fail the duplicate filter. Rows
that repeat an id count each; several labels of an id count as 1 if one of them is 1.
Without documents there are no parts and no rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_by_value
from .common import materialise, text_or_empty, word_list
from .sketch import Counter, SCHEMA as SKETCH, SEGMENT, cells_for, merged

ship_by_value(__name__)

HASHES, CELLS_A_ROW, MOST_CELLS = 4, 8, 1 << 26   # at most 64 MB in a task and 8 MB broadcast


def conditions(text: Column) -> dict[str, Column]:
    """The production filters: a condition is true for a document that fails."""
    words = word_list(text)
    n = F.size(words)
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    return {"A": n < 100, "B": 100 * F.size(F.array_distinct(words)) < 80 * n,
            "C": 100 * capitals > 10 * F.length(text), "D": text.rlike("[#$%&*|]")}


def _spots(first: np.ndarray, second: np.ndarray, cells: int) -> np.ndarray:
    """One row of cells per text, from its two hashes."""
    steps = np.arange(HASHES, dtype=np.uint64)
    mixed = first.view(np.uint64)[:, None] + steps * (second.view(np.uint64)[:, None] | np.uint64(1))
    return (mixed >> np.uint64(20)) & np.uint64(cells - 1)


def _numbers(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64, copy=False)


def repeated_cells(prints: DataFrame, cells: int) -> np.ndarray:
    """Bitmap of the cells that two or more rows of ``prints`` (h1, h2) have counted."""
    def count(batches):
        own = Counter(cells)
        for batch in batches:
            own.add(_spots(_numbers(batch.column(0)), _numbers(batch.column(1)), cells).ravel())
        yield from own.segments()

    found = merged(prints.select("h1", "h2").mapInArrow(count, SKETCH),
                          reduce=lambda total: np.packbits(total > 1, bitorder="little").tobytes())
    bits = np.zeros(cells // 8, dtype=np.uint8)
    for segment, part in found.items():
        at = segment * SEGMENT // 8
        bits[at:at + len(part)] = np.frombuffer(part, dtype=np.uint8)
    return bits


def maybe_repeated(bits, cells: int):
    """Column function (h1, h2): false only for a text that no other row holds."""
    @F.arrow_udf("boolean")
    def test(first: pa.Array, second: pa.Array) -> pa.Array:
        spots = _spots(_numbers(first), _numbers(second), cells)
        marks = bits.value[spots >> np.uint64(3)] >> (spots & np.uint64(7)).astype(np.uint8) & 1
        return pa.array(marks.all(axis=1))

    return test


def masks(docs: DataFrame, failed: Mapping[str, Column], doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(doc_id, part, mask, n): documents by id and the filters they fail, bit k for the
    k-th of ``failed`` and the last bit for a text that a smaller id has too.

    Equal rows are counted before the shuffle; the texts that may repeat are reduced to
    (text, smallest id) there, so that a text a third of all rows hold is no hot key."""
    body = text_or_empty(text)
    h1, h2 = F.xxhash64(body), F.xxhash64(F.lit(7), body)
    mask = sum((F.when(c, 1 << k).otherwise(0) for k, c in enumerate(failed.values())), F.lit(0))
    ident = F.col(f"`{doc_id}`").alias("doc_id")
    narrow = materialise(docs.select(ident, F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"), mask.alias("mask"),
                                     h1.alias("h1"), h2.alias("h2")))
    named = narrow.where("doc_id is not null")
    cells = cells_for(named.count(), CELLS_A_ROW, MOST_CELLS)
    maybe = maybe_repeated(docs.sparkSession.sparkContext.broadcast(repeated_cells(named, cells)), cells)
    texts = docs.select(ident, body.alias("body"), h1.alias("h1"), h2.alias("h2")).where("doc_id is not null")
    least = texts.where(maybe("h1", "h2")).groupBy("body").agg(F.min("doc_id").alias("doc_id"))
    # an id and two hashes name its text: only rows that share the id could mix them up
    least = least.select("doc_id", F.xxhash64("body").alias("h1"), F.xxhash64(F.lit(7), "body").alias("h2"), F.lit(True).alias("least"))
    counted = named.groupBy("doc_id", "h1", "h2", "part", "mask").agg(F.count("*").alias("n")).withColumn("maybe", maybe("h1", "h2"))
    again = counted.where("maybe").join(least, ["doc_id", "h1", "h2"], "left").withColumn(
        "mask", F.when(F.col("least"), F.col("mask")).otherwise(F.col("mask") + (1 << len(failed))))
    keep = ["doc_id", "part", "mask", "n"]
    nameless = narrow.where("doc_id is null").groupBy("doc_id", "part", "mask").agg(F.count("*").alias("n"))
    return counted.where("not maybe").select(keep).unionByName(again.select(keep)).unionByName(nameless)


def mask_counts(marked: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): the additive counts; ``good`` and ``toxic`` are the
    documents labelled quality = 1 and toxic = 1."""
    one = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("is_good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("is_toxic"))
    named = marked.where("doc_id is not null").join(one, "doc_id", "left")
    nameless = marked.where("doc_id is null").select("*", F.lit(False).alias("is_good"), F.lit(False).alias("is_toxic"))
    return named.unionByName(nameless).groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("is_good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("is_toxic"), F.col("n")).otherwise(0)).alias("toxic"))


def orders(counts: DataFrame, names: str) -> DataFrame:
    """Every part, order and step from the counts per mask.

    What a filter removes depends on the set of filters before it, not on their order;
    so the masks are summed once for each (filter, set) and the orders look them up."""
    bit = {f: 1 << k for k, f in enumerate(names)}
    every = [(f, sum(bit[g] for g in before)) for f in names
             for r in range(len(names)) for before in sorted({tuple(sorted(p)) for p in permutations(set(names) - {f}, r)})]
    sets = F.array(*[F.struct(F.lit(f).alias("filter"), F.lit(bit[f]).alias("bit"), F.lit(before).alias("before")) for f, before in every])
    spread = counts.withColumn("_s", F.explode(sets)).select("*", "_s.*")
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    earlier = F.col("mask").bitwiseAND(F.col("before")) != 0
    # of all orders, those in which this filter is the first of the ones that a document fails
    turns = F.lit(factorial(len(names))) / F.greatest(F.bit_count("mask"), F.lit(1))
    total = lambda when, what="n": F.sum(F.when(when, F.col(what)).otherwise(0)).cast("bigint")
    summed = spread.groupBy("part", "filter", "before").agg(
        total(~fails & ~earlier).alias("kept"), total(fails & ~earlier).alias("removed"), total(fails & earlier).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"), total(fails & ~earlier, "good").alias("good_lost"),
        total(fails & ~earlier, "toxic").alias("toxic_lost"),
        F.sum(F.when(fails, F.col("n") * turns.cast("bigint")).otherwise(0)).cast("bigint").alias("shapley"))
    places: dict[tuple[str, int], list[tuple[str, int]]] = {}
    for order in permutations(names):
        for k, f in enumerate(order):
            places.setdefault((f, sum(bit[g] for g in order[:k])), []).append(("".join(order), k + 1))
    listed = F.map_from_arrays(
        F.array(*[F.lit(f"{f}{before}") for f, before in places]),
        F.array(*[F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(k).alias("step")) for o, k in found]) for found in places.values()]))
    spot = F.explode(F.element_at(listed, F.concat("filter", F.col("before").cast("string"))))
    return summed.withColumn("_p", spot).select("part", "_p.filter_order", "_p.step", "kept", "removed", "redundant", "unique_fails",
                                                "good_lost", "toxic_lost", "shapley")


def audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang",
          failed: Mapping[str, Column] | None = None, duplicate: str = "E") -> DataFrame:
    """One row per part, order of the filters and step; ``failed`` maps one letter to the
    condition of a filter, ``duplicate`` is the letter of the duplicate filter."""
    failed = conditions(text_or_empty(text)) if failed is None else failed
    return orders(mask_counts(masks(docs, failed, doc_id, text, part), labels), "".join(failed) + duplicate)
