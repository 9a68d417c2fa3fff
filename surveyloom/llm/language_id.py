"""Language identification by rank-order n-gram profiles.

A profile is the list of the most frequent n-grams (one to three letters of
blank-padded words) of a language. A document's own list is compared to each
profile by out-of-place distance: how far every n-gram stands from its rank there,
with a fixed penalty for one that is missing. The smallest distance wins.

Null texts and texts without a letter are ``und`` with score 0, and so is
everything when no language was learned. Ties go to the smaller language name.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship_by_value
from .common import materialise

ship_by_value(__name__)

PROFILE = 400          # n-grams in a profile, and at most in a document's list
BLOCK = 1000            # languages whose profiles are compared at a time: 3 MB of them
_HELD = 2_000_000       # counts a task holds per language before it sums them up
_MOST = 8_000_000       # and of all languages before it passes them on


def letter_table() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def count_grams(text: str, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram codes of the blank-padded words of a text, in order, and how
    often each occurs. A code packs one to three code points."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    inside = letters[points]
    keep = inside.copy()
    keep[1:] |= inside[:-1]          # one blank after each word
    keep[0] = True
    line = np.where(inside, points, 32)[keep].astype(np.int64)
    blank = line == 32
    pairs = (line[:-1] << 21) | line[1:]
    triples = ((pairs[:-1] << 21) | line[2:])[~blank[1:-1]]
    codes = np.concatenate([line[~blank], pairs, triples])
    codes.sort()
    starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.empty(0, np.int64)
    return codes[starts], np.diff(starts, append=len(codes))


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sum of several (codes, counts)."""
    codes, place = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    counts = np.bincount(place, weights=np.concatenate([n for _, n in parts]), minlength=len(codes))
    return codes, counts.astype(np.int64)


def first(codes: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
    """The most frequent codes in order; ties by code."""
    if len(n) > size:
        least = np.partition(n, len(n) - size)[len(n) - size]
        keep = n >= least
        codes, n = codes[keep], n[keep]
    return codes[np.lexsort((codes, -n))[:size]]


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", size: int = PROFILE) -> DataFrame:
    """(lang, grams): the profile of every language of the given rows, codes by rank.

    Counts are summed per task and then by Spark; a language keeps its ``size`` first
    n-grams, however many languages there are."""
    def counted(batches):
        letters, seen, held = letter_table(), defaultdict(list), Counter()

        def passed_on():
            for name, parts in seen.items():
                codes, n = merged(parts)
                yield pa.RecordBatch.from_pydict({"lang": pa.array([name] * len(codes), pa.string()), "gram": codes, "n": n})
            seen.clear()
            held.clear()

        for batch in batches:
            for t, name in zip(batch.column(0), batch.column(1)):
                name, found = name.as_py(), count_grams(t.as_py(), letters)
                seen[name].append(found)
                held[name] += len(found[0])
                if held[name] > _HELD:
                    seen[name] = [merged(seen[name])]
                    held[name] = len(seen[name][0][0])
            if held.total() > _MOST:
                yield from passed_on()
        yield from passed_on()

    known = docs.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")).dropna()
    summed = known.mapInArrow(counted, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    ranked = summed.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram")))
    listed = ranked.where(F.col("rank") <= size).groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("rank", "gram"))).alias("g"))
    return materialise(listed.select("lang", F.col("g.gram").alias("grams")))


def blocks(profiles: DataFrame, size: int = BLOCK) -> Iterator[list[tuple[str, list[int]]]]:
    """The profiles in the order of their names, ``size`` languages at a time."""
    part: list[tuple[str, list[int]]] = []
    for r in profiles.orderBy("lang").toLocalIterator():
        part.append((r["lang"], r["grams"]))
        if len(part) == size:
            yield part
            part = []
    if part:
        yield part


def identify(profiles: list[tuple[str, list[int]]], size: int = PROFILE):
    """A function of a text: (language, score from 0 to 1)."""
    names = [n for n, _ in profiles]
    known = np.unique(np.array([g for _, p in profiles for g in p], dtype=np.int64))
    missing = 10 * size
    ranks = np.full((len(names), len(known) + 1), missing, dtype=np.int64)
    for i, (_, p) in enumerate(profiles):
        ranks[i, np.searchsorted(known, np.array(p, dtype=np.int64))] = np.arange(len(p))
    letters = letter_table()

    def of(text: str | None) -> tuple[str, float]:
        codes, n = count_grams(text, letters) if text and names else ((), ())
        if not len(codes):
            return "und", 0.0
        mine = first(codes, n, size)
        place = np.searchsorted(known, mine)
        place[known[np.minimum(place, len(known) - 1)] != mine] = len(known)
        far = ranks[:, place]
        apart = np.where(far == missing, size, np.abs(far - np.arange(len(mine))))
        total = np.minimum(apart, size).sum(axis=1)
        best = int(np.argmin(total))
        return names[best], 1.0 - float(total[best]) / (size * len(mine))

    return of


def predict(profiles: DataFrame, text: Column, size: int = PROFILE, block: int = BLOCK) -> Column:
    """Struct (lang_pred, score) of a text column; nothing but the text is read. Blocks of
    languages are compared one after the other, and the best so far stays (of equals the
    first by name)."""
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])

    def rated(part: list[tuple[str, list[int]]]) -> Column:
        @F.arrow_udf("lang_pred string, score double")
        def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
            of = identify(part, size)
            for texts in parts:
                found = [of(t) for t in texts.to_pylist()]
                yield pa.array([{"lang_pred": a, "score": b} for a, b in found], type=kind)

        return run(text.cast("string"))

    best = None
    for part in blocks(profiles, block):
        one = rated(part)
        best = one if best is None else F.when(one["score"] > best["score"], one).otherwise(best)
    return rated([]) if best is None else best
