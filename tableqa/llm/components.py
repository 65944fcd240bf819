"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableqa.llm import common


def _star(links: DataFrame, large: bool, tasks: int) -> DataFrame:
    """One step. Minima are combined before the shuffle; the table joined back has one row for each node. Links that one
    task holds are not shuffled at all."""
    if large:
        sides = links.select(F.explode(F.array(
            F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v"))
        )).alias("side")).select("side.*")
    else:
        sides = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = sides.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
    joined = sides.join(least, "u")
    if large:
        moved = joined.where("v > u").select(F.col("v").alias("a"), F.col("low").alias("b"))
    else:
        moved = joined.select(F.col("v").alias("a"), F.col("low").alias("b")).union(least.select("u", "low"))
    return moved.where("a <> b").coalesce(tasks).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (columns a and b); root is the smallest node of the component.

    Each round is cut by a checkpoint in the shared folder; rounds grow with the logarithm of the nodes. A round has as many
    tasks as its links are worth: rounds of few links in many partitions would write more files than rows. Links may hold
    repeats and loops; nodes without a link do not appear.
    """
    links = common.packed(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state, tasks = None, links.rdd.getNumPartitions()
    while True:
        links = common.cut(_star(_star(links, True, tasks), False, tasks))
        now = links.agg(
            F.count(F.lit(1)), F.expr("sum(cast(xxhash64(a, b) as decimal(38, 0)))"),
        ).first()
        tasks = common.tasks(now[0])
        links = links.coalesce(tasks)
        if now == state or now[0] == 0:
            break
        state = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        links.select("b", "b").distinct()
    ).coalesce(tasks)
