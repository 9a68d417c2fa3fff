"""Chat formatting as a prefix tree: shared initial turns are emitted once.

A turn is written as ``<|role|>`` newline, text, ``<|end|>`` newline; backslash, ``<``
and ``|`` are escaped by a backslash in roles and texts, so no text can hold a mark,
and reading back is exact. The node of a turn is named by the digest of all turns up
to it. Conversations are sorted by these names, by range; the first conversation that
has a node owns it, and (owner, depth) is the depth-first order of the nodes. Running
totals give every node its place in the stream. A node comes with the position of its
first character on its own path and with the intervals of the stream that hold its
ancestors: what its characters may attend to, besides themselves.

Units are code points. Null roles and texts are empty; turns are ordered by turn, role
and text (null turns first), repeated rows are turns of their own; rows without a
conversation id are one conversation. A conversation is one record: its turns, and
nothing else, are brought together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_by_value
from .common import materialise, running_total

ship_by_value(__name__)

END = "<|end|>\n"


def escape(text: Column) -> Column:
    for mark in ("\\", "<", "|"):
        text = F.replace(text, F.lit(mark), F.lit("\\" + mark))
    return text


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def head(role: Column) -> Column:
    return F.concat(F.lit("<|"), escape(role), F.lit("|>\n"))


def paths(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, at, turns, keys): conversations in the order of their paths."""
    clean = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    rows = turns.select(F.col(f"`{conv_id}`").alias("conv_id"), F.struct(
        F.col(f"`{turn}`").alias("turn"), clean(role).alias("role"), clean(text).alias("text")).alias("t"))
    convs = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    part = lambda t: F.concat(head(t["role"]), escape(t["text"]), F.lit(END))
    start = F.struct(F.lit("").alias("last"), F.array().cast("array<string>").alias("keys"))

    def grow(state, t):
        key = F.md5(F.concat(state["last"], part(t)).cast("binary"))
        return F.struct(key.alias("last"), F.array_append(state["keys"], key).alias("keys"))

    convs = convs.withColumn("keys", F.aggregate("turns", start, grow)["keys"])
    ordered = convs.repartitionByRange("keys", "conv_id").sortWithinPartitions("keys", "conv_id")
    return materialise(ordered.withColumn("at", F.monotonically_increasing_id()))


def build(turns: DataFrame, **columns) -> tuple[DataFrame, DataFrame]:
    """The two outputs: nodes and conversations.

    Nodes (key, depth, start, length, loss_start, loss_length, formatted, position,
    attention): ``start`` is the place in the stream, the loss mask covers the escaped
    text of assistant turns (offsets inside the node), ``position`` is that of the first
    character, ``attention`` the (start, end) intervals of the ancestors, joined where
    they touch. Conversations (conv_id, path): the node keys from the root.
    """
    convs = paths(turns, **columns)
    steps = convs.select("at", F.posexplode(F.arrays_zip("turns", "keys")).alias("depth", "x"))
    steps = steps.select("at", "depth", F.col("x.keys").alias("key"), F.col("x.turns.role").alias("role"), F.col("x.turns.text").alias("text"))
    nodes = steps.groupBy("key").agg(F.min("at").alias("owner"), F.first("depth").alias("depth"), F.first("role").alias("role"), F.first("text").alias("text"))
    mine = F.col("role") == "assistant"
    nodes = nodes.withColumn("formatted", F.concat(head(F.col("role")), escape(F.col("text")), F.lit(END)))
    nodes = nodes.select("key", "owner", "depth", "formatted", F.length("formatted").cast("bigint").alias("length"),
                         F.length(head(F.col("role"))).alias("loss_start"),
                         F.when(mine, F.length(escape(F.col("text")))).otherwise(F.lit(0)).alias("loss_length"))
    placed = materialise(running_total(nodes, ["owner", "depth"], "length", "start"))
    # the path of an owner holds the ancestors of all nodes it owns
    spots = placed.select("key", "owner", "depth", "start", "length")
    owners = spots.select("owner").distinct().withColumnRenamed("owner", "at")
    along = steps.select("at", "key").join(owners, "at", "left_semi").join(spots, "key")
    along = along.groupBy("at").agg(F.sort_array(F.collect_list(F.struct("depth", "start", "length", "owner", "key"))).alias("path"))

    def walk(state, s):
        spans, end = state["spans"], s["start"] + s["length"]
        last = F.get(spans, F.size(spans) - 1)
        fresh = F.struct(s["start"].alias("start"), end.alias("end"))
        grown = F.struct(last["start"].alias("start"), end.alias("end"))
        seen = F.struct(s["key"].alias("key"), state["position"].alias("position"), spans.alias("attention"))
        return F.struct(
            (state["position"] + s["length"]).alias("position"),
            F.when((F.size(spans) > 0) & (last["end"] == s["start"]), F.array_append(F.slice(spans, 1, F.size(spans) - 1), grown))
            .otherwise(F.array_append(spans, fresh)).alias("spans"),
            F.when(s["owner"] == F.col("at"), F.array_append(state["seen"], seen)).otherwise(state["seen"]).alias("seen"))

    # one pass over a path gives all its nodes their position and ancestors; the path is not copied
    nothing = F.struct(
        F.lit(0).cast("bigint").alias("position"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"),
        F.array().cast("array<struct<key:string,position:bigint,attention:array<struct<start:bigint,end:bigint>>>>").alias("seen"))
    seen = along.select(F.inline(F.aggregate("path", nothing, walk)["seen"]))
    return placed.drop("owner").join(seen, "key"), convs.select("conv_id", F.col("keys").alias("path"))


def read_back(nodes: DataFrame, conversations: DataFrame) -> DataFrame:
    """(conv_id, formatted, turns, loss): each conversation put together again from the
    stream; turns (role, text) and the texts under the loss mask are unescaped."""
    steps = conversations.select("conv_id", F.posexplode("path").alias("depth", "key"))
    met = steps.join(nodes.select("key", "formatted", "loss_start", "loss_length"), "key")
    whole = met.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("depth", "formatted", "loss_start", "loss_length"))).alias("p"))
    text = lambda s: F.substring(s["formatted"], s["loss_start"] + 1, F.length(s["formatted"]) - s["loss_start"] - len(END))
    role = lambda s: F.substring(s["formatted"], F.lit(3), s["loss_start"] - 5)
    return whole.select(
        "conv_id", F.array_join(F.transform("p", lambda s: s["formatted"]), "").alias("formatted"),
        F.transform("p", lambda s: F.struct(unescape(role(s)).alias("role"), unescape(text(s)).alias("text"))).alias("turns"),
        F.transform("p", lambda s: unescape(F.substring(s["formatted"], s["loss_start"] + 1, s["loss_length"]))).alias("loss"))
