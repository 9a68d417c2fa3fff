"""Byte-pair encoding as a bounded-lookahead transducer, and its decoder.

Merges are applied in the order of their list. What follows a position can change
the tokens before it only through a chain of merges of rising rank, each of which
takes the left part of the one before as (the start of) its right part. The longest
such chain, in bytes, is computed once from the merge list: tokens that end further
than that before the end of the bytes read so far never change. The encoder keeps
that many bytes besides the tokens of one step, so memory does not grow with the
length of a run. The decoder keeps at most three bytes of an unfinished character.

Null and empty texts have no tokens.
"""

from __future__ import annotations

import codecs
import heapq
import itertools
import json
import re
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..session import ship_by_value

ship_by_value(__name__)

# Fixed value: the pattern by which this kind of vocabulary cuts text before merging.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The same cut for texts of Latin letters up to U+024F without odd digits or blanks, where
# it can be said in ranges that the standard library scans faster.
_LETTER = "A-Za-z\\xaa\\xb5\\xba\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\u024f"
_PLAIN_PIECES = re.compile(rf" ?[{_LETTER}]+| ?[0-9]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^\s0-9{_LETTER}]+|\s+(?!\S)|\s+")
_NOT_PLAIN = re.compile(rf"[^\x00-\x1b\x20-\x7e\xa1-\xa9\xab-\xb1\xb4\xb6-\xb8\xbb\xbf\xd7\xf7\u2010-\u2027\u20ac{_LETTER}]")
_STEP = 2048           # bytes read at a time from a long run, besides the lookahead
_LONG_TEXT = 1 << 20   # characters from which pieces are taken one by one
_CACHED = 1 << 19      # short pieces whose tokens a task keeps
_PAIR = 20             # bits of an id in the key of a pair


def byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte in vocabulary files."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def lookahead(merges: list[tuple[bytes, bytes]]) -> int:
    """Bytes after which a token can no longer change.

    ``reach[t]``: how far left of its own right end a difference can come to lie by
    a merge whose left part is ``t``. A merge (a, b) is set off by an earlier one
    whose left part begins ``b`` (is ``b`` or a left descendant of it).
    """
    left: dict[bytes, bytes] = {}
    reach: dict[bytes, int] = {}
    for a, b in merges:
        if any(len(x) > 1 and x not in left for x in (a, b)):
            raise ValueError("a merge uses a token that no earlier merge makes")
        start, chain = b, reach.get(b, 0)
        while start in left:
            start = left[start]
            chain = max(chain, reach.get(start, 0))
        reach[a] = max(reach.get(a, 0), len(a) + chain)
        left.setdefault(a + b, a)
    return max(reach.values(), default=0)


def load(path: str) -> dict:
    """The parts of a byte-level BPE file, as plain values that travel to workers."""
    spec = json.loads(Path(path).read_text(encoding="utf-8"))
    letters = byte_letters()
    to_bytes = lambda t: bytes(letters[c] for c in t)
    added = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
    ids = {to_bytes(t): i for t, i in spec["model"]["vocab"].items() if t not in added}
    merges = [tuple(map(to_bytes, m.split(" ") if isinstance(m, str) else m)) for m in spec["model"]["merges"]]
    ranks = {ids[a] << _PAIR | ids[b]: rank for rank, (a, b) in enumerate(merges)}
    names = {i: b for b, i in ids.items()} | {i: t.encode() for t, i in added.items()}
    return {"single": [ids[bytes([b])] for b in range(256)], "ranks": ranks,
            "made": [ids[a + b] for a, b in merges], "added": added,
            "names": [names.get(i, b"") for i in range(max(names) + 1)], "lookahead": lookahead(merges)}


class Transducer:
    """Bytes of one piece in, stable token ids out."""

    def __init__(self, model: dict):
        self.single, self.ranks, self.made, self.names = model["single"], model["ranks"], model["made"], model["names"]
        self.hold = model["lookahead"]

    def merge(self, data: bytes) -> list[int]:
        """Tokens of ``data`` taken as a whole: merges by rank, then from the left."""
        ids, rank_of, made = [self.single[b] for b in data], self.ranks.get, self.made
        none = len(made)
        if len(ids) <= 64:
            ranks = [rank_of(a << _PAIR | b, none) for a, b in zip(ids, ids[1:])]
            while ranks and (best := min(ranks)) < none:
                i = ranks.index(best)
                ids[i:i + 2] = [made[best]]
                del ranks[i]
                if i:
                    ranks[i - 1] = rank_of(ids[i - 1] << _PAIR | ids[i], none)
                if i < len(ranks):
                    ranks[i] = rank_of(ids[i] << _PAIR | ids[i + 1], none)
            return ids
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(r, i) for i in range(n - 1) if (r := rank_of(ids[i] << _PAIR | ids[i + 1], none)) < none]
        heapq.heapify(queue)
        while queue:
            rank, i = heapq.heappop(queue)
            j = after[i]
            if ids[i] < 0 or j >= n or rank_of(ids[i] << _PAIR | ids[j], none) != rank:
                continue
            ids[i], ids[j] = made[rank], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank_of(ids[i] << _PAIR | ids[k], none)) < none:
                    heapq.heappush(queue, (r, i))
            if (h := before[i]) >= 0 and (r := rank_of(ids[h] << _PAIR | ids[i], none)) < none:
                heapq.heappush(queue, (r, h))
        return [t for t in ids if t >= 0]

    def run(self, data: Iterable[bytes]) -> Iterator[int]:
        """Tokens of a piece that arrives in parts; each is emitted once stable."""
        held = b""
        for part in data:
            held += part
            if len(held) <= self.hold:
                continue
            end = 0
            for token in self.merge(held):
                if end + len(self.names[token]) > len(held) - self.hold:
                    break
                end += len(self.names[token])
                yield token
            held = held[end:]
        yield from self.merge(held)


class Pieces(dict):
    """Piece -> its ids; short pieces are kept until the cache is full."""

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.transducer = transducer

    def __missing__(self, piece: str) -> tuple[int, ...]:
        if len(piece) > 512:
            parts = (piece[i:i + _STEP // 4].encode() for i in range(0, len(piece), _STEP // 4))
            return tuple(self.transducer.run(parts))
        found = tuple(self.transducer.merge(piece.encode()))
        if len(piece) <= 32:
            if len(self) >= _CACHED:
                self.clear()
            self[piece] = found
        return found


def encoder(model: dict):
    """A function of a text: the list of its token ids."""
    any_text = regex.compile(PIECES)
    special = regex.compile("(" + "|".join(map(regex.escape, sorted(model["added"], key=len, reverse=True))) + ")") if model["added"] else None
    cache = Pieces(Transducer(model))

    def ids(text: str) -> list[int]:
        out: list[int] = []
        parts = special.split(text) if special is not None and special.search(text) else [text]
        for part in parts:
            cut = any_text if _NOT_PLAIN.search(part) else _PLAIN_PIECES
            if part in model["added"]:
                out.append(model["added"][part])
            elif len(part) < _LONG_TEXT:
                out.extend(itertools.chain.from_iterable(map(cache.__getitem__, cut.findall(part))))
            else:
                for m in cut.finditer(part):
                    out.extend(cache[m.group()])
        return out

    return ids


class Decoder:
    """Token ids in, text out; bytes of an unfinished character wait for the next
    call, and what can't be a character becomes U+FFFD."""

    def __init__(self, names: list[bytes]):
        self.names, self.state = names, codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        return self.state.decode(b"".join(map(self.names.__getitem__, ids)))

    def end(self) -> str:
        return self.state.decode(b"", final=True)


def encode(text: Column, model) -> Column:
    """array<int> of the token ids of a text column; ``model`` is a Spark
    broadcast of :func:`load`, whose size is that of the vocabulary file."""
    @F.arrow_udf("array<int>")
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ids = encoder(model.value)
        for part in parts:
            found = [np.array(ids(t.as_py() or ""), dtype=np.int32) for t in part]
            ends = np.cumsum([0, *map(len, found)])
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(found) if found else np.empty(0, np.int32)))

    return run(text.cast("string"))


def decode(ids: Column, model) -> Column:
    """The text of an array<int> column of token ids; null counts as empty."""
    @F.arrow_udf("string")
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names = model.value["names"]
        for part in parts:
            texts = []
            for row in part:
                decoder, values = Decoder(names), row.values
                values = values.to_numpy() if values is not None else np.empty(0, np.int32)
                steps = [decoder.feed(values[i:i + 65536].tolist()) for i in range(0, len(values), 65536)]
                texts.append("".join([*steps, decoder.end()]))
            yield pa.array(texts, pa.string())

    return run(ids)
