"""Importance resampling towards a target: documents whose words look more like the
target texts than like the corpus get a higher chance to be drawn.

Features are hashed into buckets. Counts per bucket of the corpus and of the target give
each bucket a gain; the gains are one array that scores a document's buckets at once. A
document's weight plus Gumbel noise drawn from its id is its score, and the highest
scores are a draw without replacement in proportion to the exponentials of the weights.

Ranks come from a least-significant-digit radix sort over Spark: for each digit of the
composite key (score downwards, id upwards) every block of rows counts its digits, prefix
sums over (digit, block) say where each run of equal digits goes, and rows move to their
destination, ties in the order they had. A destination names the next pass's block.

A null text has no features and weight 0. A null id draws its noise as the empty text
and comes last in a tie; rows that repeat an id are drawn one by one. Without documents
nothing is drawn; with an empty target all counts of the target are 0.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship_by_value
from .common import materialise

ship_by_value(__name__)

BUCKETS, WORDS, LEAST_WORDS, PERCENT, SEED = 10_000, 1, 20, 10, 2024
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
DIGIT_BITS, BLOCK_BITS = 16, 20   # a block is 2^20 places of the order


def buckets_of(text: bytes, width: int = WORDS, buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """Number of words, and the bucket of each run of 1 to ``width`` words."""
    words = _WORD.findall(text.translate(_LOWER))
    runs = [words] + [[b" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] for k in range(2, width + 1)]
    found = [np.fromiter(map(zlib.crc32, r), dtype=np.uint32, count=len(r)) % buckets for r in runs]
    return len(words), np.concatenate(found)


def featurise(rows: DataFrame, ident: Column, text: Column, width: int = WORDS, buckets: int = BUCKETS) -> DataFrame:
    """(id, n_words, buckets): the buckets of all features of each text."""
    kind = "smallint" if buckets <= 1 << 15 else "int"
    store = np.int16 if buckets <= 1 << 15 else np.int32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # a list column counts its values in 32 bits: few rows at a time
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                done = [buckets_of(t.as_py() or b"", width, buckets) for t in part.column(1)]
                ends = np.cumsum([0, *(len(b) for _, b in done)])
                values = np.concatenate([b for _, b in done]).astype(store)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([n for n, _ in done], pa.int64()),
                     pa.ListArray.from_arrays(ends.astype(np.int32), pa.array(values))], names=["id", "n_words", "buckets"])

    picked = rows.select(ident.alias("id"), text.cast("string").cast("binary").alias("text"))
    return picked.mapInArrow(run, f"id {picked.schema['id'].dataType.simpleString()}, n_words bigint, buckets array<{kind}>")


def bucket_counts(features: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket: each task counts its rows in one array of fixed length."""
    def run(batches):
        counts = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            counts += np.bincount(batch.column(0).flatten().to_numpy(), minlength=buckets)
        has = np.nonzero(counts)[0]
        yield pa.RecordBatch.from_arrays([pa.array(has, pa.int64()), pa.array(counts[has])], names=["bucket", "n"])

    total = np.zeros(buckets, dtype=np.int64)
    for r in features.select("buckets").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[r["bucket"]] = r["n"]
    return total


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log ratio of the smoothed shares of each bucket, rounded down."""
    b, s, t = float(len(corpus)), corpus.astype(float), target.astype(float)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + b) / ((s + 1) * (t.sum() + b)))).astype(np.int64)


def weight_of(column: Column, gain) -> Column:
    """Mean gain of a document's buckets, rounded down; 0 without features."""
    @F.arrow_udf("bigint")
    def run(lists: pa.Array) -> pa.Array:
        ends = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).cumsum()
        sums = np.concatenate([[0], np.cumsum(gain.value[lists.flatten().to_numpy()])])
        starts = np.concatenate([[0], ends])[:-1]
        return pa.array((sums[ends] - sums[starts]) // np.maximum(ends - starts, 1))

    return run(column)


def noise(ident: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from the digest of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("bigint")


# ---------------------------------------------------------------- radix sort

def ordered_bits(number: Column, descending: bool = False) -> Column:
    """A bigint whose unsigned bits sort as the number does, or the other way round."""
    flipped = number.bitwiseXOR(F.lit(-(1 << 63)))
    return F.bitwise_not(flipped) if descending else flipped


def _digits(rows: DataFrame, keys: Sequence[str], bits: int) -> list[tuple[str, int, int]]:
    """(key, shift, width) of the digits to pass over, the least significant first. Bits
    in which all rows agree are in no digit."""
    found = rows.agg(*[f(k).alias(f"{n}_{k}") for k in keys for n, f in (("or", F.bit_or), ("and", F.bit_and))]).first()
    out = []
    for k in reversed(keys):
        if found[f"or_{k}"] is None:
            continue
        differ = (found[f"or_{k}"] ^ found[f"and_{k}"]) & ((1 << 64) - 1)
        if differ:
            low, high = (differ & -differ).bit_length() - 1, differ.bit_length()
            passes = -(-(high - low) // bits)
            width = -(-(high - low) // passes)
            out += [(k, at, min(width, high - at)) for at in range(low, high, width)]
    return out


def radix_rank(rows: DataFrame, keys: Sequence[str], out: str = "rank", digit_bits: int = DIGIT_BITS, block_bits: int = BLOCK_BITS) -> DataFrame:
    """``rows`` with their place (from 1) in the order of ``keys``, the first being the
    most significant; keys are bigints taken as 64 unsigned bits without nulls.

    A block holds at most 2^``block_bits`` rows, so rows of one block and digit are a
    bounded group however often a digit occurs."""
    state = materialise(rows.withColumn("_at", F.monotonically_increasing_id()))
    first = True
    for key, shift, width in _digits(state, keys, digit_bits):
        digit = F.shiftrightunsigned(F.col(key), shift).bitwiseAND(F.lit((1 << width) - 1).cast("bigint"))
        cut = state.withColumns({"_block": F.shiftright("_at", block_bits), "_digit": digit})
        counts = cut.groupBy("_digit", "_block").agg(F.count("*").alias("_n"))
        # runs of one digit in the order of the blocks, after all runs of smaller digits
        per_digit = counts.groupBy("_digit").agg(F.sum("_n").alias("_all")).select("_digit", (F.sum("_all").over(
            Window.partitionBy(F.lit(1)).orderBy("_digit")) - F.col("_all")).alias("_from"))   # at most 2^digit_bits rows
        earlier = F.sum("_n").over(Window.partitionBy("_digit").orderBy("_block")) - F.col("_n")
        starts = counts.withColumn("_earlier", earlier).join(per_digit, "_digit").select(
            "_digit", "_block", (F.col("_from") + F.col("_earlier")).alias("_start"))
        inside = F.row_number().over(Window.partitionBy("_digit", "_block").orderBy("_at")) - 1
        moved = cut.withColumn("_in", inside).join(starts, ["_digit", "_block"])
        state = materialise(moved.select(*rows.columns, (F.col("_start") + F.col("_in")).cast("bigint").alias("_at")))
        first = False
    if first:   # all keys are equal: any order is the order, but places must follow each other
        return radix_rank(state.withColumn("_all", F.col("_at")).drop("_at"), ["_all"], out, digit_bits, block_bits).drop("_all") \
            if state.limit(2).count() > 1 else state.drop("_at").withColumn(out, F.lit(1).cast("bigint"))
    return state.select(*rows.columns, (F.col("_at") + 1).alias(out))


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WORDS, buckets: int = BUCKETS,
             percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank): rank is the place of a drawn document and
    null for any other. Drawn are the highest scores of the documents with ``least_words``
    words or more, ``percent`` of their number rounded down."""
    rows = materialise(featurise(docs, F.col(f"`{doc_id}`"), F.col(f"`{text}`"), width, buckets))
    wanted = featurise(target, F.lit(None).cast("bigint"), F.col("text"), width, buckets)
    gain = docs.sparkSession.sparkContext.broadcast(gains(bucket_counts(rows, buckets), bucket_counts(wanted, buckets)))
    scored = rows.select(F.col("id").alias("doc_id"), "n_words", F.size("buckets").cast("bigint").alias("n_features"),
                         weight_of(F.col("buckets"), gain).alias("weight"))
    scored = materialise(scored.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)))
    fit = scored.where(F.col("n_words") >= least_words)
    drawn = fit.count() * percent // 100
    number = F.col("doc_id").cast("bigint")
    keyed = fit.withColumns({"_score": ordered_bits(F.col("score"), descending=True), "_null": number.isNull().cast("bigint"),
                             "_id": ordered_bits(F.coalesce(number, F.lit(0).cast("bigint")))})
    ranked = radix_rank(keyed, ["_score", "_null", "_id"])
    out = ["doc_id", "n_features", "weight", "score"]
    ranked = ranked.select(*out, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))
    rest = scored.where(~(F.col("n_words") >= least_words)).select(*out, F.lit(None).cast("bigint").alias("rank"))
    return ranked.unionByName(rest)
