r"""Chat formatting with a prefix tree: shared initial turns are written once, in depth-first order.

A turn becomes `<|turn|>role<|text|>text<|end|>`. Control strings inside roles and texts (these and the usual ones of
other templates: anything like `<|`, `<s>`, `</s>`, `[INST]`, `[/INST]`) get a backslash after their first character,
one more if they have some already; taking one away restores the text.

Conversations with the same first turns share the nodes of a tree. Every node belongs to the smallest conversation that
passes through it, so the tree falls into chains, one for each conversation that adds a turn of its own: its first new
turn to its last. Depth-first order is the order of chains by the path (minus the depth where a chain leaves its parent,
conversation) of the chains above. The packed stream is the chains in that order. A node gets its place in the stream,
the position id of its first token (tokens are code points here) and the intervals of the stream it may attend to: one
for each chain on its path, its own last, each of them from the chain's begin.

Node identities are sums over the turns so far of 128-bit hashes of (position, role, text), taken in a window, so a
long conversation is never held in one row. Depth-first places come from sums of range partitions.

Edges: null roles and texts count as empty; turns of equal number keep the order of role and hash of the text; a null
conversation id is a conversation; equal conversations and those that are the begin of others share all nodes; an
empty table gives empty results.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableqa.llm import common

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
_PARTS = 4
MARKS = ("size", "loss_from", "position", "attention", "intervals")
DIGESTS = (
    "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars",
    "positions_sha256", "attention_sha256", "n_intervals",
)


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)(\||/?s>|/?INST\])", r"$1\\$2$3")


_ESCAPED = re.compile(r"([<\[])\\(\\*)(\||/?s>|/?INST\])")
_FORMATTED = re.compile(r"<\|turn\|>(.*?)<\|text\|>(.*?)<\|end\|>", re.DOTALL)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def formatted_turns(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """One row for each turn: conv, depth from 0, segment, loss span inside it, node identity, position id."""
    body = rows.select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    ).withColumn("text_hash", F.xxhash64("text"))
    ordered = Window.partitionBy("conv").orderBy("turn", "role", "text_hash")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, 0)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    head = F.concat(F.lit(TURN), escaped(F.col("role")), F.lit(TEXT))
    numbered = body.withColumn("depth", F.row_number().over(ordered) - 1).select(
        "conv", "turn", "role", "text_hash", "depth", F.concat(head, escaped(F.col("text")), F.lit(END)).alias("segment"),
        F.when(F.col("role") == "assistant", F.length(head)).alias("loss_from"),
        F.md5(F.to_json(F.struct("depth", "role", "text")).cast("binary")).alias("digest"),
    )
    parts = [F.conv(F.substring("digest", 8 * i + 1, 8), 16, 10).cast("long") for i in range(_PARTS)]
    return numbered.select(
        "conv", "depth", "segment", F.length("segment").cast("long").alias("size"), "loss_from",
        F.struct("depth", *[F.sum(p).over(so_far).alias(f"h{i}") for i, p in enumerate(parts)]).alias("node"),
        F.coalesce(F.sum(F.length("segment").cast("long")).over(before), F.lit(0).cast("long")).alias("position"),
    )


def prefix_tree(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                ) -> tuple[DataFrame, DataFrame]:
    """The packed stream and where each conversation lies in it.

    nodes: chain (conversation that owns the node), depth, segment, size, loss_from (start of a text that counts for the
    loss, inside the segment; else null), start (place in the stream), position (id of the first token), attends (array
    of intervals of the stream, end exclusive, up to the end of the node).
    conversations: conv, n_turns, size, runs (array of the intervals that make it up, with chain and start depth).
    """
    turns = common.cut(formatted_turns(rows, conv, turn, role, text))
    # null ids sort first, so they own what they share
    owners = turns.groupBy("node").agg(F.min(F.struct(F.col("conv").isNotNull().alias("named"), F.col("conv").alias("id"))).alias("owner"))
    owned = turns.join(owners, "node").select(
        "conv", "depth", "segment", "size", "loss_from", "position", F.col("owner.id").alias("chain"),
    )
    owned = common.cut(owned)
    runs = owned.groupBy("conv", "chain").agg(
        F.min("depth").alias("depth"), F.sum("size").alias("size"), F.count(F.lit(1)).alias("turns"),
    )
    paths = runs.groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("depth", "chain", "size", "turns"))).alias("runs"),
    )
    paths = common.cut(paths)
    own = F.element_at("runs", -1)
    chains = paths.where(own["chain"].eqNullSafe(F.col("conv"))).select(
        F.col("conv").alias("chain"), own["size"].alias("size"),
        F.transform("runs", lambda r: F.struct((-r["depth"]).alias("d"), r["chain"].alias("c"))).alias("path"),
    )
    placed = _places(chains)
    # several chains can hang on the same conversation, so places are joined to the runs one by one
    located = (
        paths.select("conv", F.posexplode("runs").alias("n", "run")).select("conv", "n", "run.*")
        .join(placed.select(F.col("chain").alias("of"), "begin"), F.col("chain").eqNullSafe(F.col("of")))
        .groupBy("conv").agg(
            F.sort_array(F.collect_list(F.struct("n", F.col("begin").alias("start"), (F.col("begin") + F.col("size")).alias("end"), "chain", "depth", "turns"))).alias("runs"),
        )
    )
    conversations = common.cut(located.select(
        "conv", F.aggregate("runs", F.lit(0).cast("long"), lambda a, r: a + r["turns"]).alias("n_turns"),
        F.aggregate("runs", F.lit(0).cast("long"), lambda a, r: a + r["end"] - r["start"]).alias("size"), "runs",
    ))
    # a node's own chain is the last run of the conversation that owns it
    nodes = owned.where(F.col("chain").eqNullSafe(F.col("conv"))).drop("conv").join(
        conversations.select(F.col("conv").alias("of"), "runs"), F.col("chain").eqNullSafe(F.col("of"))
    ).withColumn("own", F.element_at("runs", -1))
    first = F.aggregate(F.slice("runs", 1, F.size("runs") - 1), F.lit(0).cast("long"), lambda a, r: a + r["end"] - r["start"])
    start = F.col("own.start") + F.col("position") - first
    nodes = nodes.select(
        "chain", "depth", "segment", "size", "loss_from", start.alias("start"), "position",
        F.concat(
            F.transform(F.slice("runs", 1, F.size("runs") - 1), lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"))),
            F.array(F.struct(F.col("own.start").alias("start"), (start + F.col("size")).alias("end"))),
        ).alias("attends"),
    )
    return nodes, conversations


def _places(chains: DataFrame) -> DataFrame:
    """`begin`: sum of the sizes of all chains that come earlier in depth-first order, by range partitions."""
    spread = common.cut(
        chains.repartitionByRange("path").withColumn("part", F.spark_partition_id())
    )
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("part").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    # one row for each partition
    offsets = spread.groupBy("part").agg(F.sum("size").alias("all")).select(
        F.col("part").alias("of"), F.coalesce(F.sum("all").over(earlier), zero).alias("offset")
    )
    return spread.withColumn("inside", F.coalesce(F.sum("size").over(inside), zero)).join(
        F.broadcast(offsets), F.col("part") == F.col("of")
    ).select("chain", (F.col("offset") + F.col("inside")).alias("begin"))


def read_back(nodes: DataFrame, conversations: DataFrame) -> DataFrame:
    """Each conversation's formatted text and marks of its turns, read through its intervals of the stream.

    A chain's nodes are put together once; of each interval a conversation takes the nodes that start in it. Marks (in
    order of the turns): size, loss_from, position of the first token, attention (digest of the intervals attended to,
    as `start-end` joined by commas) and how many these are.
    """
    intervals = F.array_join(F.transform("attends", lambda a: F.concat_ws("-", a["start"], a["end"])), ",")
    marked = F.struct(
        "start", "segment", "size", "loss_from", "position",
        F.sha2(intervals.cast("binary"), 256).alias("attention"), F.size("attends").cast("long").alias("intervals"),
    )
    blocks = nodes.groupBy("chain").agg(F.sort_array(F.collect_list(marked)).alias("nodes")).withColumnRenamed("chain", "of")
    inside = F.filter("nodes", lambda n: (n["start"] >= F.col("begin")) & (n["start"] < F.col("end")))
    parts = (
        conversations.select("conv", F.explode("runs").alias("run"))
        .select("conv", "run.n", "run.chain", F.col("run.start").alias("begin"), F.col("run.end").alias("end"))
        .join(blocks, F.col("chain").eqNullSafe(F.col("of")))
        .groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("n", inside.alias("nodes")))).alias("parts"))
    )
    turns = parts.select("conv", F.flatten(F.transform("parts", lambda p: p["nodes"])).alias("turns"))
    return turns.select(
        "conv", F.array_join(F.transform("turns", lambda n: n["segment"]), "").alias("formatted"),
        F.transform("turns", lambda n: F.struct(*[n[c].alias(c) for c in MARKS])).alias("marks"),
    )


def digests(formatted: DataFrame) -> DataFrame:
    """Turns, loss texts and their digests, parsed from the formatted text and its marks.

    positions_sha256 is of the turns' position ids joined by commas, attention_sha256 of their attention digests joined by
    newlines; n_intervals counts the intervals that the turns attend to.
    """

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for conv, text, marks in zip(frame["conv"], frame["formatted"], frame["marks"]):
                turns = [(unescaped(a), unescaped(b)) for a, b in _FORMATTED.findall(text)]
                loss, at = [], 0
                for mark in marks:
                    size, start = mark["size"], mark["loss_from"]
                    if start is not None and start == start:
                        loss.append(unescaped(text[at + int(start) : at + int(size) - len(END)]))
                    at += int(size)
                learnt = "".join(loss)
                positions, attention = ",".join(str(m["position"]) for m in marks), "\n".join(m["attention"] for m in marks)
                out.append((
                    conv, len(turns), hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest(),
                    len(learnt), hashlib.sha256(learnt.encode()).hexdigest(), len(text),
                    hashlib.sha256(positions.encode()).hexdigest(), hashlib.sha256(attention.encode()).hexdigest(),
                    sum(m["intervals"] for m in marks),
                ))
            yield pd.DataFrame(out, columns=["conv", *DIGESTS])

    # ids travel as text, since pandas would turn whole numbers with nulls into floats
    kind = dict(formatted.dtypes)["conv"]
    return formatted.withColumn("conv", F.col("conv").cast("string")).mapInPandas(
        read, "conv string, " + ", ".join(f"{name} {'string' if name.endswith('sha256') else 'long'}" for name in DIGESTS)
    ).withColumn("conv", F.col("conv").cast(kind))
