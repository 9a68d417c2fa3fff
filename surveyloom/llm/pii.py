"""Personal data: fixed patterns, and a semi-Markov conditional random field.

The field scores whole spans: a segmentation of the words around digits and ``@``
into entities (at most ``MAX_WORDS`` words and ``MAX_CHARS`` characters) and single
words of no kind. Features look at the span as a whole (its shape, its digit count,
a checksum, valid octets, the word before), and bounded-entity dynamic programming
finds the best boundaries and kinds together. It is trained here on what the fixed
patterns find in a bounded sample, by the gradient of the conditional likelihood.

Words without a digit or ``@`` can't be part of an entity, so the words between
two such regions split the text into parts that are segmented on their own; this
is exact. Spans of the patterns always stay; the field adds those that touch none.
A null text has no spans.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_by_value
from .common import materialise

ship_by_value(__name__)

KINDS = ("email", "ip", "card", "phone")
MAX_WORDS, MAX_CHARS = 5, 64      # bound of an entity
SAMPLE = 120                      # texts of each kind, and of none, that the field is trained on
SAMPLE_CHARS = 200_000            # longer texts are not trained on; the others are used whole
CERTAIN = 2.0                     # log-odds by which an added span must beat plain words

# The given patterns.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_ANCHOR = re.compile(r"[0-9@]")
_OUTER = ".,;:!?\"'()[]{}<>"
_RUN = re.compile(r"[0-9]+|[A-Za-z]+|[^\x00-\x7f]+")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches found from each ``@``, so that long runs cost one step each."""
    done = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            yield "email", start, m.end()
            done = at = m.end()
        else:
            at += 1
            done = at


def base_spans(text: str) -> list[Span]:
    """Matches of the fixed patterns, by start and then kind."""
    if not _ANCHOR.search(text):
        return []
    found = list(_emails(text))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() and c.isascii() for c in m.group()) <= 15:
            found.append(("phone", *m.span()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def regions(text: str) -> Iterator[list[tuple[int, int]]]:
    """Word spans around each stretch of words that hold a digit or ``@``: words up
    to ``MAX_WORDS`` - 2 apart may share an entity and stay in one region."""
    words, last = [], -1
    if not _ANCHOR.search(text):
        return
    gap: list[tuple[int, int]] = []
    for m in _WORD.finditer(text):
        if _ANCHOR.search(text, m.start(), m.end()):
            words += gap if words else []
            words.append(m.span())
            gap = []
        elif words:
            gap.append(m.span())
            if len(gap) > MAX_WORDS - 2:
                yield words
                words, gap = [], []
    if words:
        yield words


def trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """The span without outer punctuation; an opening bracket stays if it closes inside."""
    while end > start and text[end - 1] in _OUTER and not (text[end - 1] == ")" and "(" in text[start:end]):
        end -= 1
    while start < end and text[start] in _OUTER and not (text[start] == "(" and ")" in text[start:end]):
        start += 1
    return start, end


def _few(n: int) -> str:
    return str(n) if n < 20 else "many"


def features(text: str, start: int, end: int, words: int) -> list[str]:
    """What the field sees of a candidate span: the span as a whole and the word before."""
    span = text[start:end]
    digits = re.sub(r"[^0-9]", "", span)
    letters = any(c.isalpha() for c in span)
    marks = "".join(sorted(set(re.sub(r"[A-Za-z0-9]", "", span))))
    shape = _RUN.sub(lambda m: "9" * min(len(m.group()), 4) if m.group()[0].isdigit() else "a", span)
    found = [f"shape={shape[:24]}", f"digits={_few(len(digits))}", f"words={words}", f"marks={marks[:8]}", f"letters={letters}"]
    if span.count("@") == 1 and "." in span.split("@")[1].strip("."):
        found.append("address")
    if not letters:
        parts = re.findall(r"[0-9]+", span)
        if len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts):
            found.append("octets")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append("checksum")
        if span[0] in "+(":
            found.append("dialled")
    before = text[max(0, start - 24):start].split()
    found.append("after=" + (before[-1].lower().strip(_OUTER + "=") if before else ""))
    return found


def candidates(text: str, words: list[tuple[int, int]]) -> dict[tuple[int, int], tuple[int, int, list[str]]]:
    """(first word, last word) -> (start, end, features) of the possible entities."""
    out = {}
    for i in range(len(words)):
        for j in range(i, min(i + MAX_WORDS, len(words))):
            if words[j][1] - words[i][0] > MAX_CHARS + 8:
                break
            ends = [_ANCHOR.search(text, *words[k]) for k in (i, j)]
            if all(ends):
                start, end = trimmed(text, words[i][0], words[j][1])
                if 0 < end - start <= MAX_CHARS:
                    out[i, j] = (start, end, features(text, start, end, j - i + 1))
    return out


def possible(feats: list[str]) -> Iterator[str]:
    """Kinds that a span can be at all, by what a kind is made of."""
    digits = int(feats[1].removeprefix("digits=").replace("many", "20"))
    plain = feats[4] == "letters=False"
    tests = {"email": "address" in feats, "ip": "octets" in feats, "card": plain and 12 <= digits <= 19, "phone": plain and 9 <= digits <= 15}
    return (k for k in KINDS if tests[k])


def scores(found: dict, weights: dict[str, float]) -> dict[tuple[int, int, str], float]:
    """Score of every (first word, last word, kind); a plain word scores 0."""
    get = weights.get
    return {(i, j, k): sum(get(f"{k}|{f}", 0.0) for f in feats) + get(f"{k}|", 0.0)
            for (i, j), (_, _, feats) in found.items() for k in possible(feats)}


def best_path(n: int, scored: dict[tuple[int, int, str], float]) -> list[tuple[int, int, str]]:
    """Best segmentation of ``n`` words: bounded-entity Viterbi."""
    ending: dict[int, list] = {}
    for (i, j, k), s in scored.items():
        ending.setdefault(j, []).append((i, k, s))
    best, back = [0.0] * (n + 1), [None] * (n + 1)
    for j in range(n):
        best[j + 1], back[j + 1] = best[j], None
        for i, k, s in ending.get(j, ()):
            if best[i] + s > best[j + 1]:
                best[j + 1], back[j + 1] = best[i] + s, (i, j, k)
    path, at = [], n
    while at:
        if back[at]:
            path.append(back[at])
            at = back[at][0]
        else:
            at -= 1
    return path[::-1]


def marginals(n: int, scored: dict[tuple[int, int, str], float]) -> dict[tuple[int, int, str], float]:
    """Probability of every segment under the field: forward and backward sums."""
    def plus(a: float, b: float) -> float:
        return max(a, b) + math.log1p(math.exp(-abs(a - b)))

    ending: dict[int, list] = {}
    starting: dict[int, list] = {}
    for (i, j, _), s in scored.items():
        ending.setdefault(j, []).append((i, s))
        starting.setdefault(i, []).append((j, s))
    ahead, behind = [0.0] * (n + 1), [0.0] * (n + 1)
    for j in range(n):
        ahead[j + 1] = ahead[j]
        for i, s in ending.get(j, ()):
            ahead[j + 1] = plus(ahead[j + 1], ahead[i] + s)
    for i in range(n - 1, -1, -1):
        behind[i] = behind[i + 1]
        for j, s in starting.get(i, ()):
            behind[i] = plus(behind[i], behind[j + 1] + s)
    return {(i, j, k): math.exp(min(0.0, ahead[i] + s + behind[j + 1] - ahead[n])) for (i, j, k), s in scored.items()}


def examples(text: str) -> Iterator[tuple[int, dict, dict]]:
    """(words, candidates, true segments by the patterns) of every region."""
    spans = base_spans(text)
    for words in regions(text):
        found = candidates(text, words)
        true = {(i, j, k) for (i, j), (s, e, _) in found.items() for k, a, b in spans if (a, b) == (s, e)}
        yield len(words), found, true


def fit(texts: list[str], epochs: int = 6, rate: float = 0.3, decay: float = 1e-4) -> dict[str, float]:
    """Weights by gradient ascent on the conditional likelihood, region by region."""
    weights: dict[str, float] = {f"{k}|": -4.0 for k in KINDS}
    regions_of = [x for t in texts for x in examples(t) if x[1]]
    for epoch in range(epochs):
        step = rate / (1 + epoch)
        for n, found, true in regions_of:
            for (i, j, k), p in marginals(n, scores(found, weights)).items():
                error = ((i, j, k) in true) - p
                if abs(error) > 1e-3:
                    for name in (*(f"{k}|{f}" for f in found[i, j][2]), f"{k}|"):
                        w = weights.get(name, 0.0)
                        weights[name] = w + step * (error - decay * w)
    return weights


def train(docs: DataFrame, text: str = "text", sample: int = SAMPLE, most_chars: int = SAMPLE_CHARS) -> dict[str, float]:
    """Fit on whole texts: of those that may hold a kind, by a plain pattern for each, the
    ``sample`` with the smallest hashes, and as many with a digit or ``@`` that hold none.
    Copies are one text. The model doesn't depend on the order of rows; at most
    5 * ``sample`` texts of ``most_chars`` characters or fewer leave their tasks."""
    t = F.col(f"`{text}`").cast("string")
    holds = {"email": t.contains("@"), "ip": t.rlike(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]"), "card": t.rlike(r"([0-9][\x20-]?){12}"),
             "phone": t.rlike(r"\+[0-9]")}
    asked = docs.select(t.alias("t"), F.xxhash64(t).alias("h"), *[c.alias(k) for k, c in holds.items()]).where(
        t.rlike("[0-9@]") & (F.length(t) <= most_chars))
    hashes = materialise(asked.groupBy("h").agg(*[F.max(k).alias(k) for k in holds]))
    none = ~(F.col("email") | F.col("ip") | F.col("card") | F.col("phone"))
    chosen: set[int] = set()
    for wanted in (*(F.col(k) for k in holds), none):
        chosen.update(r["h"] for r in hashes.where(wanted).orderBy("h").limit(sample).collect())
    if not chosen:
        return fit([])
    rows = asked.where(F.col("h").isin(*chosen)).groupBy("h").agg(F.min("t").alias("t")).orderBy("h").collect()
    return fit([r["t"] for r in rows])


def all_spans(text: str, weights: dict[str, float]) -> tuple[list[Span], list[Span]]:
    """Base spans, and base spans with those that the field adds."""
    base = base_spans(text)
    added = []
    for words in regions(text):
        found = candidates(text, words)
        scored = {key: s - CERTAIN for key, s in scores(found, weights).items() if s > CERTAIN}
        for i, j, k in best_path(len(words), scored):
            start, end, _ = found[i, j]
            if not any(a < end and start < b for _, a, b in base):
                added.append((k, start, end))
    return base, sorted(base + added, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def detect(text: Column, weights: dict[str, float]) -> Column:
    """Struct (base, spans) of arrays of (kind, start, end) in code points, for the
    whole text of a column."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    kind = pa.struct([("base", pa.list_(span)), ("spans", pa.list_(span))])

    @F.arrow_udf("base array<struct<kind:string,start:int,end:int>>, spans array<struct<kind:string,start:int,end:int>>")
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        named = lambda spans: [{"kind": k, "start": a, "end": b} for k, a, b in spans]
        for part in parts:
            rows = (all_spans(t.as_py() or "", weights) for t in part)
            yield pa.array([{"base": named(a), "spans": named(b)} for a, b in rows], type=kind)

    return run(text.cast("string"))


def mask(text: Column, weights: dict[str, float]) -> Column:
    """The text with every span replaced by its kind in brackets; of overlapping
    spans the later ones end the earlier. Null stays null."""
    @F.arrow_udf("string")
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            out = []
            for t in part.to_pylist():
                spans = all_spans(t, weights)[1] if t else []
                pieces, at = [], 0
                for k, a, b in spans:
                    if a >= at:
                        pieces += [t[at:a], f"[{k}]"]
                    at = max(at, b)
                out.append("".join([*pieces, t[at:]]) if spans else t)
            yield pa.array(out, pa.string())

    return run(text.cast("string"))
