"""Exact top-k inner products by the threshold algorithm over sorted lists, one list for each dimension.

Candidates are dealt into blocks. A block keeps its vectors and, for every dimension, their order by that component.
The lists are walked from both ends, so that the queries of a group share what they meet; vectors are scored in full when
they are met first, and a query stops as soon as the best possible sum of the unseen rest is below its k-th result.
Before that, every query gets a lower bound for its k-th result from one block, so that the other blocks stop early;
bounds never change a result.

Queries travel in groups and candidates in blocks, so a task holds one of each, whatever the number of either. Equal
vectors are one candidate with its k + 1 smallest ids (more cannot enter a result, as ties go to smaller ids).

Edges: vectors that are null, hold a null or a non-finite component, or lack an id take no part; vectors
that are shorter than the longest one, empty ones too, count as if zeros followed; repeated ids count as separate rows; fewer than k candidates give what there is; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableqa.llm import common

SCALE = 64
BLOCK = 8192  # candidates of a block
GROUP = 1024  # queries of a group
STEP = 512  # vectors scored between two looks at the bounds


def usable(vector: str) -> Column:
    """No null vector, no null and no non-finite component."""
    v = F.col(f"`{vector}`")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    return v.isNotNull() & ~F.coalesce(bad, F.lit(True))


def integer_vectors(df: DataFrame, key: str, vector: str, scale: int = SCALE) -> DataFrame:
    """`vec_id` and `v`: floor(scale * x) of every component as long."""
    return df.where(usable(vector) & F.col(f"`{key}`").isNotNull()).select(
        F.col(f"`{key}`").cast("long").alias("vec_id"),
        F.transform(F.col(f"`{vector}`"), lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long")).alias("v"),
    )


def exact_type(queries: np.ndarray, block: np.ndarray) -> type:
    """A float type in which all sums of products of these whole numbers are exact, or else int64."""
    most = int(np.abs(block).max(initial=0)) * int(np.abs(queries).max(initial=0)) * block.shape[1]
    return np.float32 if most < 2**24 else np.float64 if most < 2**53 else np.int64


def threshold_search(queries: np.ndarray, block: np.ndarray, need: int, floors: np.ndarray) -> tuple[np.ndarray, ...]:
    """Positions (query, vector) and scores of all vectors of `block` that can be among the best `need` of a query.

    All lists are walked from both ends at once, so the vectors that have been met down to a depth are the same for
    every query: those with a component of at most that rank from either end. They are taken in that order, some
    hundred at a time, and scored for all queries that still run. No component of a vector not yet met lies outside the
    list entries at the depth, so a query's best possible rest is the sum of its better products with these. It stops
    when that is below its bound, the `need`-th score so far or its floor. floors: scores that `need` vectors reach
    somewhere, so that lower ones do not matter.
    """
    kind = exact_type(queries, block)
    n = len(block)
    ranks = np.argsort(np.argsort(block, axis=0, kind="stable"), axis=0, kind="stable")
    depth = np.minimum(ranks, n - 1 - ranks).min(axis=1)
    order = np.argsort(depth, kind="stable")
    lists, met, q = np.sort(block, axis=0), block[order].astype(kind), queries.astype(kind)
    running, bounds = np.arange(len(q)), floors.astype(np.int64).copy()
    best = np.full((need, len(q)), np.iinfo(np.int64).min, dtype=np.int64)
    found = []
    for at in range(0, n, STEP):
        scores = (met[at : at + STEP] @ q[running].T).astype(np.int64)
        row, col = np.nonzero(scores >= bounds[running])
        found.append((running[col], order[at + row], scores[row, col]))
        kept = np.concatenate([best[:, running], scores])
        best[:, running] = np.partition(kept, len(kept) - need, axis=0)[len(kept) - need :]
        bounds[running] = np.maximum(bounds[running], best[:, running].min(axis=0))
        if at + STEP >= n:
            break
        t = depth[order[at + STEP]]
        of = queries[running]
        rest = np.where(of > 0, of * lists[n - 1 - t], of * lists[t]).sum(axis=1)
        running = running[rest >= bounds[running]]
        if not len(running):
            break
    of, position, score = (np.concatenate(x) for x in zip(*found))
    good = score >= bounds[of]
    return of[good], position[good], score[good]


def search_block(queries: pd.DataFrame, candidates: pd.DataFrame, k: int) -> pd.DataFrame:
    """Rows (query_id, vec_id, score) that hold the k best of this block for each query."""
    if not len(queries) or not len(candidates):
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
    asked, block = (np.array(x.tolist(), dtype=np.int64) for x in (queries["q"], candidates["v"]))
    # one more than k, as the query's own vector may be among them
    of, position, score = threshold_search(asked, block, k + 1, queries["floor"].to_numpy())
    ids = candidates["ids"].to_numpy()
    lengths = np.array([len(i) for i in ids])[position]
    rows = pd.DataFrame({
        "query_id": np.repeat(queries["query_id"].to_numpy()[of], lengths),
        "vec_id": np.concatenate([ids[p] for p in position]) if len(position) else [], "score": np.repeat(score, lengths),
    }).astype("int64")
    rows = rows[rows["query_id"] != rows["vec_id"]].sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
    return rows.groupby("query_id").head(k)


def top_k(queries: DataFrame, candidates: DataFrame, k: int, block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """The k best candidates of every query: query_id, rank, vec_id, score; ties go to the smaller id.

    Both tables hold vec_id and v (see integer_vectors). A candidate with the query's own id is left out.
    """
    least = Window.partitionBy("v").orderBy("vec_id")
    shared = (
        candidates.select("v", "vec_id").withColumn("n", F.row_number().over(least)).where(F.col("n") <= k + 1)
        .groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    )
    shared = common.cut(shared)
    asked = common.cut(queries.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q")).distinct())
    n, m = shared.count(), asked.count()
    widths = shared.select(F.size("v").alias("w")).union(asked.select(F.size("q"))).agg(F.min("w"), F.max("w")).first()
    if widths[0] != widths[1]:  # missing components count as zero
        filled = lambda c: F.concat(c, F.array_repeat(F.lit(0).cast("long"), F.lit(widths[1]) - F.size(c))).alias(c)
        # vectors that become equal are told apart by nothing but their ids
        shared = common.cut(shared.select(filled("v"), F.explode("ids").alias("vec_id")).withColumn("n", F.row_number().over(least)).where(
            F.col("n") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
        asked = common.cut(asked.select("query_id", filled("q")).distinct())
        n = shared.count()
    blocks, groups = max(1, -(-n // block)), max(1, -(-m // group))
    blocked = shared.withColumn("b", F.pmod(F.xxhash64("v"), F.lit(blocks)).cast("int"))
    grouped = asked.withColumn("g", F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int"))
    pairs = "query_id long, vec_id long, score long"

    def search(asked_rows: DataFrame, rows: DataFrame, in_blocks: range | list[int]) -> DataFrame:
        at = F.explode(F.array(*[F.lit(b) for b in in_blocks])).alias("b")
        left = asked_rows.select("query_id", "q", "floor", "g", at)
        right = rows.select("v", "ids", "b", F.explode(F.array(*[F.lit(g) for g in range(groups)])).alias("g"))
        return left.groupBy("g", "b").cogroup(right.groupBy("g", "b")).applyInPandas(
            lambda a, b: search_block(a, b, k), pairs
        )

    lowest = F.lit(-(2**62)).cast("long")
    first = search(grouped.withColumn("floor", lowest), blocked.where("b = 0"), [0])
    if blocks > 1:
        first = common.cut(first)
        bounds = first.groupBy("query_id").agg(F.count(F.lit(1)).alias("c"), F.min("score").alias("low"))
        bounded = grouped.join(bounds, "query_id", "left").withColumn(
            "floor", F.when(F.col("c") >= k, F.col("low")).otherwise(lowest)
        )
        first = first.unionByName(search(bounded, blocked.where("b > 0"), range(1, blocks)))
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        first.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
