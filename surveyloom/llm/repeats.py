"""Removal of byte strings that repeat anywhere in the corpus, by prefix-free parsing.

A rolling hash over eight bytes triggers the cuts: the place of its (leftmost)
minimum in the first ``SPAN`` bytes of a 400-byte window belongs to that window's
content, so equal windows have it at the same distance. Windows in a row that share
a trigger make a phrase. The dictionary holds the distinct phrases with the stretch
of text that its windows cover; the parse is the list of phrases of each document.

1. A trigger whose following bytes (those that all its windows must have in common)
   occur once in the corpus starts no repeat: such phrases are dropped, by count.
2. A phrase that occurs twice or more repeats as a whole.
3. A phrase that occurs once, but shares the bytes after its trigger with another, is
   at the edge of a repeat. Only dictionary entries of such groups are compared window
   by window: next to each other where the group is small, over a shuffle otherwise.

The order of suffixes is needed here only as far as equality of 400 bytes, so phrases
and windows are ranked by digest and not by their place in a sorted suffix array
(see the README). Nothing is ever larger than one document or one bounded group.

Null texts count as empty. Rows that share an id and a text are documents of their
own. Overlapping repeats are one removed run.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_by_value
from .common import materialise

ship_by_value(__name__)

LENGTH = 400        # bytes of a repeat
SPAN = 256          # window starts over which a trigger is the minimum
SMALL_GROUP = 4_000   # dictionary entries that are compared inside one task
_BATCH = 20_000

_digest = xxhash.xxh3_64_intdigest


def phrases(data: bytes, length: int = LENGTH, span: int = SPAN) -> tuple[list[int], list[int], list[int]]:
    """(first window start, end of window starts, trigger) of each phrase."""
    starts = len(data) - length + 1
    if starts <= 0:
        return [], [], []
    n = starts + span - 1
    h = np.ndarray((n,), dtype="<u8", buffer=data, strides=(1,)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    # the place in the low bits makes the leftmost of equal hashes the smallest
    bits = np.uint64(max(24, n.bit_length()))
    h = (h >> bits << bits) | np.arange(n, dtype=np.uint64)
    rows = np.full(-(-n // span) * span, np.iinfo(np.uint64).max)
    rows[:n] = h
    rows = rows.reshape(-1, span)
    upto = np.minimum.accumulate(rows, axis=1).ravel()
    onward = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    low = np.minimum(onward[:starts], upto[span - 1:span - 1 + starts])
    cut = np.flatnonzero(low[1:] != low[:-1]) + 1
    first = np.concatenate([[0], cut])
    trigger = (low[first] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    return first.tolist(), [*cut.tolist(), starts], trigger.tolist()


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, dtype=np.uint64).view(np.int64))


def _texts(batches) -> Iterator[tuple[object, bytes, int]]:
    """(id, text bytes, key of the document) of every row."""
    for batch in batches:
        for doc, text in zip(batch.column(0), batch.column(1).cast(pa.binary())):
            doc, data = doc.as_py(), text.as_py() or b""
            yield doc, data, _digest(data, _digest(str(doc)) & 0xFFFFFFFF)


def _after(length: int, span: int):
    """Digest of the bytes after each trigger that all its windows hold."""
    def run(batches):
        held: list[int] = []
        for _, data, _ in _texts(batches):
            held += [_digest(data[q:q + length - span + 1]) for q in phrases(data, length, span)[2]]
            if len(held) > _BATCH:
                yield pa.RecordBatch.from_pydict({"after": _signed(held)})
                held = []
        yield pa.RecordBatch.from_pydict({"after": _signed(held)})
    return run


def _parse(length: int, span: int):
    """Every phrase: digest after the trigger, digest of its stretch, document, place."""
    def run(batches):
        names = ("after", "phrase", "doc", "place")
        held: list[tuple[int, int, int, int]] = []
        for _, data, key in _texts(batches):
            held += [(_digest(data[q:q + length - span + 1]), _digest(data[s:e - 1 + length]), key, s << 16 | e - s)
                     for s, e, q in zip(*phrases(data, length, span))]
            if len(held) > _BATCH:
                yield pa.RecordBatch.from_pydict({n: _signed(list(c)) for n, c in zip(names, zip(*held))})
                held = []
        if held:
            yield pa.RecordBatch.from_pydict({n: _signed(list(c)) for n, c in zip(names, zip(*held))})
    return run


def _windows(stretch: bytes, length: int) -> list[bytes]:
    return [xxhash.xxh3_128_digest(stretch[i:i + length]) for i in range(len(stretch) - length + 1)]


def _intervals(hits: list[int]) -> list[tuple[int, int]]:
    """Runs of consecutive numbers as (first, count)."""
    out: list[list[int]] = []
    for i in hits:
        if out and out[-1][0] + out[-1][1] == i:
            out[-1][1] += 1
        else:
            out.append([i, 1])
    return [tuple(x) for x in out]


def _small_groups(length: int):
    """Entries of one group after another (rows sorted by group): the windows of
    single phrases that another entry of the group holds too."""
    def flagged(group):
        digests = [_windows(zstandard.decompress(r["stretch"]), length) for r in group]
        seen = Counter(d for ds in digests for d in ds)
        for r, ds in zip(group, digests):
            if r["n"] == 1:
                start = r["place"] >> 16
                for i, n in _intervals([i for i, d in enumerate(ds) if seen[d] > 1]):
                    yield r["doc"], start + i, n

    def run(batches):
        group: list[dict] = []
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if group and row["after"] != group[0]["after"]:
                    out += flagged(group)
                    group = []
                group.append(row)
            yield _runs(out)
        yield _runs(list(flagged(group)))
    return run


def _runs(rows) -> pa.RecordBatch:
    doc, start, n = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_pydict({"doc": pa.array(doc, pa.int64()), "start": pa.array(start, pa.int64()), "n": pa.array(n, pa.int64())})


def _spread(length: int):
    """Window digests of the entries of a large group, one row each."""
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                ds = _windows(zstandard.decompress(r["stretch"]), length)
                yield pa.RecordBatch.from_pydict({"window": pa.array(ds, pa.binary()), "doc": [r["doc"]] * len(ds), "single": [r["n"] == 1] * len(ds),
                                                  "start": [(r["place"] >> 16) + i for i in range(len(ds))]})
    return run


def _stretches(batches):
    """The text of the dictionary entries that a document stands for."""
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            data = zstandard.decompress(r["packed"])
            for e in r["entries"]:
                start, count = e["place"] >> 16, e["place"] & 65535
                stretch = data[start:start + count - 1 + r["length"]]
                if _digest(stretch) == e["phrase"] % (1 << 64):
                    out.append({"after": e["after"], "doc": r["doc"], "place": e["place"], "n": e["n"], "stretch": zstandard.compress(stretch, 1)})
        yield pa.RecordBatch.from_pylist(out, schema=_ENTRY)


_ENTRY = pa.schema([("after", pa.int64()), ("doc", pa.int64()), ("place", pa.int64()), ("n", pa.int64()), ("stretch", pa.binary())])


def _packed(batches):
    """(doc_id, key, compressed text): what is shuffled of a text."""
    squeeze = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        keys, packed = [], []
        for _, data, key in _texts([batch]):
            keys.append(key)
            packed.append(squeeze.compress(data))
        yield pa.RecordBatch.from_arrays([batch.column(0), _signed(keys), pa.array(packed, pa.binary())], names=["doc_id", "doc", "packed"])


def covered(runs: list[tuple[int, int]], size: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """Maximal (start, end) byte runs under windows that start in ``runs``."""
    out: list[list[int]] = []
    for start, n in sorted(runs):
        end = min(start + n - 1 + length, size)
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [tuple(x) for x in out]


def _cut(kind: str, length: int):
    def run(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                data = zstandard.decompress(r["packed"])
                spans = covered([(x["start"], x["n"]) for x in r["runs"] or ()], len(data), length)
                ends = [0, *(x for s in spans for x in s), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(ends[::2], ends[1::2]))
                rows.append({"n_bytes": len(data), "removed": [{"start": a, "end": b} for a, b in spans],
                             "kept_sha256": hashlib.sha256(kept).hexdigest(), "kept": kept})
            cols = pa.RecordBatch.from_pylist(rows, schema=_CUT)
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols.columns], names=["doc_id", *cols.schema.names])
    return run


_CUT = pa.schema([("n_bytes", pa.int64()), ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                  ("kept_sha256", pa.string()), ("kept", pa.binary())])


def repeated_runs(texts: DataFrame, length: int = LENGTH, span: int = SPAN, small: int = SMALL_GROUP) -> DataFrame:
    """(doc, start, n): runs of window starts whose window occurs elsewhere too; doc is
    the key of a document in ``texts`` (doc_id, text)."""
    shared = texts.mapInArrow(_after(length, span), "after bigint").groupBy("after").agg(F.count("*").alias("c")).where("c > 1")
    shared = materialise(shared.select("after"))
    parse = texts.mapInArrow(_parse(length, span), "after bigint, phrase bigint, doc bigint, place bigint")
    parse = materialise(parse.join(shared, "after"))
    entries = materialise(parse.groupBy("after", "phrase").agg(
        F.count("*").alias("n"), F.first("doc").alias("doc"), F.first("place").alias("place")))
    whole = entries.where("n > 1").select("after", "phrase")
    runs = parse.join(whole, ["after", "phrase"], "left_semi").select(
        "doc", F.shiftright("place", 16).alias("start"), F.col("place").bitwiseAND(65535).alias("n"))
    # the edges of repeats: groups with several entries, one of them single
    groups = entries.groupBy("after").agg(F.count("*").alias("c"), F.min("n").alias("least")).where("c > 1 and least = 1").select("after", "c")
    edges = entries.join(groups.select("after"), "after", "left_semi")
    asked = edges.groupBy("doc").agg(F.collect_list(F.struct("after", "phrase", "place", "n")).alias("entries"))
    packed = texts.mapInArrow(_packed, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, doc bigint, packed binary").drop("doc_id")
    joined = packed.join(asked, "doc").select("doc", "packed", "entries", F.lit(length).alias("length"))
    stretches = joined.mapInArrow(_stretches, "after bigint, doc bigint, place bigint, n bigint, stretch binary")
    stretches = materialise(stretches.join(groups, "after"))
    near = stretches.where(F.col("c") <= small).drop("c").repartition("after").sortWithinPartitions("after", "doc", "place")
    near = near.mapInArrow(_small_groups(length), "doc bigint, start bigint, n bigint")
    wide = stretches.where(F.col("c") > small).mapInArrow(_spread(length), "window binary, doc bigint, single boolean, start bigint")
    twice = wide.groupBy("window").agg(F.count("*").alias("c")).where("c > 1")
    far = wide.where("single").join(twice, "window", "left_semi").select("doc", "start", F.lit(1).cast("bigint").alias("n"))
    return runs.unionByName(near).unionByName(far)


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, span: int = SPAN,
                   small: int = SMALL_GROUP) -> DataFrame:
    """doc_id, n_bytes, removed (array of start, end), kept_sha256 and kept (the
    remaining bytes, which may split a character) of every row."""
    texts = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    runs = repeated_runs(texts, length, span, small).groupBy("doc").agg(F.collect_list(F.struct("start", "n")).alias("runs"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    packed = texts.mapInArrow(_packed, f"doc_id {kind}, doc bigint, packed binary")
    joined = packed.join(runs, "doc", "left").select("doc_id", "packed", "runs")
    return joined.mapInArrow(_cut(kind, length), f"doc_id {kind}, n_bytes bigint, removed array<struct<start:bigint,end:bigint>>, kept_sha256 string, kept binary")
