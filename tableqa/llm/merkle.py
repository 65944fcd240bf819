"""Merkle manifest of a dataset: leaves of rows, a tree for each group, a tree over the groups, proofs and their check.

A leaf is the hash of a row's fields. The leaves of a group are in order of the row key; as long as several nodes remain,
every FAN consecutive ones become the hash of their digests (the last run may be shorter, even a single node). What
remains is the group's subroot; subroots in order of the group make the root in the same way.

Subtree exchange: BLOCK = FAN^3 consecutive nodes are a superblock. Going up, superblocks are reduced to one node each
and these are the nodes of the next round, so rounds grow with the logarithm of the rows to the base 4096. Going down,
the nodes of a superblock are cogrouped with the outer nodes that they need (at each outer level the digests left and
right of the path), and one call finishes the local reduction, joins the proofs and folds them. Groups of few rows
share a call, so a call sees at most 2 * BLOCK nodes whatever the groups are; a group of a third of all rows is as many
calls as it has superblocks. Positions come from a range sort, so no window runs over a group of rows.

Edges: a null field is `-`; null keys come first in their group, ties are in order of their leaves; repeated rows are
leaves of their own; null texts stay null under tampering; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableqa.llm import common

FAN = 16
BLOCK = FAN**3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value: Column) -> Column:
    """A field as the hash reads it: its length in bytes, a colon and the text; `-` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256)


def runs(nodes: list[str]) -> list[list[str]]:
    return [nodes[at : at + FAN] for at in range(0, len(nodes), FAN)]


def reduce_block(nodes: list[str], whole: bool) -> list[list[str]]:
    """All levels of a superblock from its nodes to its top. A whole group ends at a single node, a part after FAN^3."""
    levels = [nodes]
    while len(levels[-1]) > 1 if whole else len(levels) < 4:
        levels.append([digest(*run) for run in runs(levels[-1])])
    return levels


def ordered(rows: DataFrame, *keys: str) -> DataFrame:
    """`rows` with their place `g` in the order of the keys, gapless from 0, and the partition `part` they lie in.

    One range shuffle; ties of the keys follow the rows' first order, so equal rows are spread, too. The driver gets one
    number for each partition.
    """
    numbered = common.cut(rows.withColumn("_tie", F.monotonically_increasing_id()))
    placed = numbered.repartitionByRange(*keys, "_tie").sortWithinPartitions(*keys, "_tie").drop("_tie")
    placed = common.cut(placed.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    sizes = sorted(placed.groupBy(part.alias("part")).count().collect())
    before = itertools.accumulate([r["count"] for r in sizes], initial=0)
    offsets = rows.sparkSession.createDataFrame([(r["part"], b) for r, b in zip(sizes, before)], "_part long, _before long")
    return placed.join(F.broadcast(offsets), part == F.col("_part")).select(  # a row for each partition
        *[F.col(c) for c in rows.columns], (F.col("_before") + F.col("_at") % (1 << 33)).alias("g"), F.col("_part").alias("part")
    )


def _calls(nodes: DataFrame) -> DataFrame:
    """Adds the call (c1, c2) that handles a node: its superblock, or a stretch of groups that are smaller than that."""
    few = F.col("n") <= BLOCK
    return nodes.withColumn("c1", F.when(few, F.lit(-1)).otherwise(F.col("seq")).cast("long")).withColumn(
        "c2", F.when(few, F.col("seq").bitwiseAND(F.lit(-BLOCK))).otherwise(F.floor(F.col("i") / BLOCK)).cast("long")
    )


def _blocks(part: pd.DataFrame) -> Iterator[tuple[int, int, int, pd.DataFrame]]:
    """Superblocks of a call: group, number of the superblock, nodes of the group, and its own nodes in order."""
    part = part.sort_values(["seq", "i"], kind="stable")
    for (seq, block), own in part.groupby([part["seq"], part["i"] // BLOCK], sort=True):
        yield int(seq), int(block), int(own["n"].iloc[0]), own


def _up(part: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame([
        (seq, block, (n - 1) // BLOCK + 1, reduce_block(own["node"].tolist(), n <= BLOCK)[-1][0]) for seq, block, n, own in _blocks(part)
    ], columns=["seq", "i", "n", "node"])


def _paths(levels: list[list[str]], place: int) -> list[tuple[str, str]]:
    """For each level of a block below its top, the digests left and right of the path from a node."""
    out = []
    for nodes in levels[:-1]:
        run = nodes[place // FAN * FAN : (place // FAN + 1) * FAN]
        out.append(("".join(run[: place % FAN]), "".join(run[place % FAN + 1 :])))
        place //= FAN
    return out


def _outer_of(outer: pd.DataFrame) -> dict[tuple[int, int], list[tuple[bool, str, str]]]:
    """Steps above each superblock, from below; `top` tells those of the tree over the groups."""
    found: dict[tuple[int, int], list[tuple[bool, str, str]]] = {}
    rows = outer.sort_values(["seq", "i", "level"])
    for seq, block, top, before, after in zip(rows["seq"], rows["i"], rows["top"], rows["before"], rows["after"]):
        found.setdefault((int(seq), int(block)), []).append((bool(top), before, after))
    return found


STEPS = "seq long, i long, level int, top boolean, before string, after string"


def _down(part: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    """Steps of every node of a call: those inside its superblock and those above."""
    above, out = _outer_of(outer), []
    for seq, block, n, own in _blocks(part):
        levels = reduce_block(own["node"].tolist(), n <= BLOCK)
        for i in own["i"]:
            steps = [(False, *s) for s in _paths(levels, int(i) - block * BLOCK)] + above.get((seq, block), [])
            out += [(seq, int(i), level, *step) for level, step in enumerate(steps)]
    return pd.DataFrame(out, columns=["seq", "i", "level", "top", "before", "after"])


def _with_calls(steps: DataFrame, blocks: DataFrame) -> DataFrame:
    """Steps of superblocks, keyed by the call that handles the superblock one level below."""
    return steps.join(blocks.select("seq", "i", "c1", "c2"), ["seq", "i"])


def exchange(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Superblocks of `nodes` (seq, i, n, node) with their calls, and the subroot (seq, node) of every group."""
    called = _calls(nodes.select("seq", "i", "n", "node"))
    # the call is a function of the group and the superblock, so it is kept with the superblock's node
    schema = "seq long, i long, n long, node string, c1 long, c2 long"

    def up(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return _up(part).assign(c1=int(key[0]), c2=int(key[1]))

    blocks = common.cut(called.groupBy("c1", "c2").applyInPandas(up, schema))
    return blocks, blocks.where("n = 1").select("seq", "node")


def steps_above(nodes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Superblocks of `nodes`, the steps above each of them within its group, and the subroots."""
    blocks, ended = exchange(nodes)
    more = blocks.where("n > 1")
    if more.isEmpty():
        return blocks, nodes.sparkSession.createDataFrame([], STEPS), ended
    steps, subroots = path_steps(more)
    return blocks, steps, ended.union(subroots)


def path_steps(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Steps of every node up to the top of its group, and the tops."""
    blocks, above, tops = steps_above(nodes)
    outer = _with_calls(above, blocks)
    steps = _calls(nodes.select("seq", "i", "n", "node")).groupBy("c1", "c2").cogroup(outer.groupBy("c1", "c2")).applyInPandas(_down, STEPS)
    return common.cut(steps), tops


def _fold(part: pd.DataFrame, outer: pd.DataFrame, columns: list[str]) -> pd.DataFrame:
    above, out = _outer_of(outer), []
    for seq, block, n, own in _blocks(part):
        levels, outside = reduce_block(own["node"].tolist(), n <= BLOCK), above.get((seq, block), [])
        subroot = root = levels[-1][0]
        for top, before, after in outside:
            root = digest(before, root, after)
            subroot = subroot if top else root
        outer_proof = "".join(before + after for _, before, after in outside)
        for key, i, leaf, other in zip(own["key"], own["i"], own["node"], own["other"]):
            inside = _paths(levels, int(i) - block * BLOCK)
            proof, folded = hashlib.sha256(), leaf if other is None else other
            for before, after in inside:
                proof.update((before + after).encode())
                folded = digest(before, folded, after)
            proof.update(outer_proof.encode())
            for _, before, after in outside:
                folded = digest(before, folded, after)
            out.append((key, leaf, subroot, root, proof.hexdigest(), folded, folded == root))
    return pd.DataFrame(out, columns=columns)


def leaves(docs: DataFrame, key: str = "doc_id", group: str = "source") -> DataFrame:
    """key, grp, node (the leaf) and other: the leaf of a tampered row, null where the row was left alone.

    Rows whose key has a crc32 that 5 divides are tampered with: A-Z of the text become lower case.
    """
    value = {c: F.col(f"`{c}`") for c in FIELDS}
    tampered = value | {"text": F.translate(value["text"], UPPER, LOWER)}
    chosen = F.crc32(value[key].cast("string").cast("binary")) % 5 == 0
    return docs.select(
        value[key].alias("key"), value[group].cast("string").alias("grp"), leaf_of(*value.values()).alias("node"),
        F.when(chosen, leaf_of(*tampered.values())).alias("other"),
    )


def manifest(docs: DataFrame, key: str = "doc_id", group: str = "source") -> DataFrame:
    """One row for each row of `docs`: key, leaf, subroot, root, proof_sha256, folded_root, verified."""
    columns = [key, "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    schema = f"`{key}` string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    rows = ordered(leaves(docs, key, group), "grp", "key", "node")
    # first place and size of a group from one row for each group and partition, joined back by both
    group_rows = Window.partitionBy("grp")
    spans = rows.groupBy("grp", "part").agg(F.min("g").alias("first"), F.count(F.lit(1)).alias("rows")).select(
        F.col("grp").alias("_grp"), F.col("part").alias("_part"), F.min("first").over(group_rows).alias("seq"), F.sum("rows").over(group_rows).alias("n")
    )
    same = F.col("grp").eqNullSafe(F.col("_grp")) & (F.col("part") == F.col("_part"))
    place = (F.col("g") - F.col("seq")).alias("i")
    # keys travel as text, which pandas keeps exact beside nulls
    nodes = common.cut(rows.join(common.small(spans), same).select(F.col("key").cast("string"), "node", "other", "seq", "n", place))
    kind = docs.schema[key].dataType
    if nodes.isEmpty():
        return docs.sparkSession.createDataFrame([], schema).withColumn(key, F.col(f"`{key}`").cast(kind))
    blocks, above, subroots = steps_above(nodes)
    # the groups' places are in order of the groups, as rows were sorted by group first
    tops = common.cut(ordered(subroots, "seq").select(F.lit(0).cast("long").alias("seq"), F.col("seq").alias("of"), F.col("g").alias("i"), "node"))
    over, _ = path_steps(tops.withColumn("n", F.lit(tops.count())))
    top_steps = over.join(tops.select("i", "of"), "i").select(
        F.col("of").alias("seq"), (F.col("level") + 1000).alias("level"), F.lit(True).alias("top"), "before", "after"
    )
    # a group's steps to the root belong to each of its superblocks
    outer = _with_calls(above, blocks).select("c1", "c2", "seq", "i", "level", "top", "before", "after").union(
        top_steps.join(blocks, "seq").select("c1", "c2", "seq", "i", "level", "top", "before", "after")
    )

    def fold(part: pd.DataFrame, steps: pd.DataFrame) -> pd.DataFrame:
        return _fold(part, steps, columns)

    folded = _calls(nodes).groupBy("c1", "c2").cogroup(outer.groupBy("c1", "c2")).applyInPandas(fold, schema)
    return folded.withColumn(key, F.col(f"`{key}`").cast(kind))


def manifest_sql(levels: int = 7) -> str:
    """The manifest as SQL over `documents`, for groups and group counts up to 16^levels."""
    part = lambda c: f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"
    lowered = f"translate(text, '{UPPER}', '{LOWER}')"
    leaf = lambda text: "sha256(" + " || ".join(part(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    ctes = [f"""leaves AS (
  SELECT doc_id, leaf, CASE WHEN crc % 5 = 0 THEN other ELSE leaf END AS other, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS seq,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i
  FROM (SELECT doc_id, source, {leaf("text")} AS leaf, {leaf(lowered)} AS other, {crc32_sql("CAST(doc_id AS VARCHAR)")} AS crc FROM documents))""",
        "a0 AS (SELECT seq, i, leaf AS node FROM leaves)"]

    def climb(name: str, source: str) -> None:
        ctes.append(f"""{name} AS (
  SELECT r.seq, r.run AS i, CASE WHEN r.n = 1 THEN r.nodes[1] ELSE sha256(array_to_string(r.nodes, '')) END AS node, r.nodes, r.n > 1 AS hashed
  FROM (SELECT seq, i // 16 AS run, list(node ORDER BY i) AS nodes, any_value(n) AS n
        FROM (SELECT *, count(*) OVER (PARTITION BY seq) AS n FROM {source}) GROUP BY seq, i // 16) r)""")

    for k in range(levels):
        climb(f"a{k + 1}", f"a{k}")
    ctes.append(f"t0 AS (SELECT 0 AS seq, seq AS i, node FROM a{levels})")
    for k in range(levels):
        climb(f"t{k + 1}", f"t{k}")
    ctes.append("f0 AS (SELECT doc_id, leaf, other AS folded, '' AS proof, seq, i FROM leaves)")
    tables = [(f"a{k + 1}", "seq") for k in range(levels)] + [(f"t{k + 1}", "0") for k in range(levels)]
    for k, (table, _) in enumerate(tables):
        group, place = ("f.seq", "f.i") if k < levels else ("0", "f.seq" if k == levels else "f.i")
        ctes.append(f"""f{k + 1} AS (
  SELECT f.doc_id, f.leaf, f.seq, {place} // 16 AS i,
    CASE WHEN t.hashed THEN f.proof || array_to_string(t.nodes[1 : {place} % 16] || t.nodes[{place} % 16 + 2 :], '') ELSE f.proof END AS proof,
    CASE WHEN t.hashed THEN sha256(array_to_string(t.nodes[1 : {place} % 16] || [f.folded] || t.nodes[{place} % 16 + 2 :], '')) ELSE f.folded END AS folded
  FROM f{k} f JOIN {table} t ON t.seq = {group} AND t.i = {place} // 16)""")
    last = len(tables)
    return "WITH " + ",\n".join(ctes) + f"""
SELECT f.doc_id, f.leaf, s.node AS subroot, r.node AS root, sha256(f.proof) AS proof_sha256, f.folded AS folded_root, f.folded = r.node AS verified
FROM f{last} f JOIN a{levels} s ON s.seq = f.seq CROSS JOIN t{levels} r"""


def crc32_sql(text: str) -> str:
    """crc32 of an ASCII text in SQL without that function: one bit after the other (0xEDB88320 is the polynomial)."""
    byte = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda d, z : xor(d >> 1, 3988292384 * (d & 1)))"
    codes = f"[CAST(ascii(x) AS BIGINT) FOR x IN string_split({text}, '')]"
    return f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {codes}), lambda c, b : {byte}), 4294967295)"
