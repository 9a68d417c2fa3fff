"""Secret scan: keyed assignments, access keys, hex runs and random-looking strings.

All of it is column expressions. Places of matches come from the lengths of what
a pattern matches and of what lies between; random-looking strings are found by
Shannon entropy in a sliding window, with counts updated character by character
and a threshold per character class. Allowed stretches and base spans are cut out
of a candidate, and what is left on either side is judged by itself. A null text
has no spans.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

# The given patterns.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
KINDS = ("assign", "access", "hex", "entropy")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="
CANDIDATE = "[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
#: Character class of a candidate, the pattern it must match, and the entropy in
#: bits that some window of it must reach. The first class that matches counts.
CLASSES = (
    ("digits", "^[0-9+/_=-]+$", 2.9),
    ("hex", "^[0-9A-Fa-f]+$", 3.0),
    ("mixed", "(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])", 3.6),
    ("letters and digits", "(?=.*[0-9])(?=.*[A-Za-z])", 3.75),
    ("letters", "^", 3.9),
)
#: Pieces that look random as a whole and are no secrets: UUIDs, joined words, digests.
ALLOWED = (
    "^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$",
    "^/?[A-Za-z]+([-_/=+][A-Za-z]+)+([-_/][0-9]{1,4})?/?$",
    "^(sha1|sha256|sha384|sha512|md5)-",
)
#: Stretches that are no secret wherever they stand: alphabets, digits in order, words of samples.
STRETCHES = ("abcdefghijkl(mnopqrstuvwxyz)?", "0123456789", "example", "sample", "placeholder", "license")
_BLOCK = 512


def _pairs(gaps: str, found: str) -> Column:
    return F.transform(found, lambda m, i: F.struct(F.length(F.get(gaps, i)).alias("gap"), m.alias("m")))


def _placed(pairs: str | Column) -> Column:
    """Running positions of (gap, m) pairs."""
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def step(state, p):
        begin = state["at"] + p["gap"]
        end = begin + F.length(p["m"])
        one = F.struct(begin.alias("start"), end.alias("end"), p["m"].alias("value"))
        return F.struct(end.alias("at"), F.array_append(state["out"], one).alias("out"))

    def block(state, first):
        inner = F.aggregate(F.slice(pairs, first + 1, _BLOCK),
                            F.struct(state["at"].alias("at"), empty.alias("out")), step)
        return F.struct(inner["at"].alias("at"), F.array_append(state["out"], inner["out"]).alias("out"))

    blocks = F.sequence(F.lit(0), F.size(pairs) - 1, F.lit(_BLOCK))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<struct<start:int,end:int,value:string>>>").alias("out"))
    return F.when(F.size(pairs) > 0, F.flatten(F.aggregate(blocks, start, block)["out"])).otherwise(empty)


def locate_all(df: DataFrame, text: str, pattern: str, out: str) -> DataFrame:
    """Add ``out``: array of (start, end, value), the leftmost non-overlapping
    matches in code points. Texts without a match are only searched once."""
    hit = F.col(text).rlike(pattern)
    df = df.withColumn("_f", F.when(hit, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>")))
    df = df.withColumn("_p", F.when(F.size("_f") > 0, F.split(text, pattern, -1)).otherwise(F.array().cast("array<string>")))
    df = df.withColumn("_z", F.when(F.size("_f") > 0, _pairs("_p", "_f")).otherwise(F.array().cast("array<struct<gap:int,m:string>>")))
    return df.withColumn(out, _placed("_z")).drop("_f", "_p", "_z")


def window_entropy(value: Column, width: int = WINDOW) -> Column:
    """Largest Shannon entropy of any window of ``width`` characters.

    The state holds a count per character and the sum of c·log2(c); a step adds
    one character and takes one away, so no window is counted anew.
    """
    weigh = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(width + 2)])
    slot = lambda i: F.instr(F.lit(ALPHABET), F.substring(value, i, F.lit(1)))

    def step(state, i):
        new, old = slot(i), F.when(i > width, slot(i - width)).otherwise(F.lit(0))
        counts = state["counts"]
        has_new, has_old = F.get(counts, new), F.get(counts, old)
        moved = F.when(new == old, state["sum"]).otherwise(
            state["sum"] + F.get(weigh, has_new + 1) - F.get(weigh, has_new)
            + F.when(old > 0, F.get(weigh, has_old - 1) - F.get(weigh, has_old)).otherwise(0.0))
        after = F.when(new == old, counts).otherwise(F.transform(
            counts, lambda c, k: c + (k == new).cast("int") - ((k == old) & (old > 0)).cast("int")))
        bits = F.lit(math.log2(width)) - moved / width
        return F.struct(after.alias("counts"), moved.alias("sum"),
                        F.greatest(state["best"], F.when(i >= width, bits).otherwise(0.0)).alias("best"))

    start = F.struct(F.array_repeat(F.lit(0), len(ALPHABET) + 1).alias("counts"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"))
    return F.aggregate(F.sequence(F.lit(1), F.length(value)), start, step)["best"]


def _random_looking(value: Column, classes, allowed, width: int) -> Column:
    least = F.lit(None).cast("double")
    for _, pattern, bits in reversed(classes):
        least = F.when(value.rlike(pattern), F.lit(bits).cast("double")).otherwise(least)
    free = F.lit(False)
    for pattern in allowed:
        free = free | value.rlike(pattern)
    return F.when(free | least.isNull() | (F.length(value) < width), F.lit(False)).otherwise(window_entropy(value, width) >= least)


def _blank_base(candidate: Column) -> Column:
    """The candidate's value with a space for every character of a base span."""
    def blank(value, b):
        low = F.greatest(b["start"] - candidate["start"], F.lit(0))
        high = F.least(b["end"], candidate["end"]) - candidate["start"]
        return F.concat(F.substring(value, F.lit(1), low), F.repeat(F.lit(" "), high - low),
                        F.substring(value, high + 1, F.length(value)))

    touching = F.filter("base", lambda b: (b["start"] < candidate["end"]) & (candidate["start"] < b["end"]))
    return F.aggregate(touching, candidate["value"], blank)


def _pieces(blanked: Column, stretches) -> Column:
    """(start, end, value) of what lies between allowed stretches and blanks."""
    cut = F.lit("(?i:" + "|".join([*stretches, r"\x20+"]) + ")")
    kept, gone = F.split(blanked, cut, -1), F.regexp_extract_all(blanked, cut, F.lit(0))
    return _placed(F.transform(kept, lambda m, i: F.struct(
        F.coalesce(F.length(F.get(gone, i - 1)), F.lit(0)).alias("gap"), m.alias("m"))))


def scan(docs: DataFrame, text: str = "text", classes=CLASSES, allowed=ALLOWED, stretches=STRETCHES,
         width: int = WINDOW) -> DataFrame:
    """All columns of ``docs`` under ``doc`` and ``base`` and ``spans``: arrays of
    (start, rank, end, kind, value), ordered by start and then kind. ``spans`` holds
    the base spans and the random-looking strings beside them."""
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), text_or_empty(text).alias("_t"))
    # Runs of hex digits and access keys are whole runs, so the length can stand in the pattern.
    for pattern, out in ((ASSIGN, "_assign"), ("AKIA[A-Z0-9]{14,}", "_access"), ("[0-9a-f]{16,}", "_hex"), (CANDIDATE, "_cand")):
        df = locate_all(df, "_t", pattern, out)
    named = lambda c, rank: F.transform(c, lambda s: F.struct(
        s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"),
        F.lit(KINDS[rank]).alias("kind"), s["value"].alias("value")))
    keyed = F.filter("_assign", lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= 12)
    df = df.withColumn("base", F.sort_array(F.concat(named(keyed, 0), named("_access", 1), named("_hex", 2))))
    # The steps are columns of their own, so that a lambda does not repeat what it reads.
    df = df.withColumn("_blank", F.transform("_cand", lambda c: F.struct(c["start"].alias("start"), _blank_base(c).alias("value"))))
    df = df.withColumn("_piece", F.flatten(F.transform("_blank", lambda c: F.transform(
        _pieces(c["value"], stretches), lambda p: F.struct((c["start"] + p["start"]).alias("start"), (c["start"] + p["end"]).alias("end"),
                                                           p["value"].alias("value"))))))
    loose = F.filter("_piece", lambda s: _random_looking(s["value"], classes, allowed, width))
    df = df.withColumn("_loose", F.when(F.size("_cand") > 0, named(loose, 3)).otherwise(named("_cand", 3)))
    return df.select("doc", "base", F.sort_array(F.concat("base", "_loose")).alias("spans"))


def listed(spans: str) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def how_many(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
