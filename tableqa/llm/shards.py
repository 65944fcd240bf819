"""Sharding by weighted rendezvous hashing: the key and the list of shards alone decide where a row goes.

Every shard draws a number from the key, weighted as -weight / ln(u); the largest draw wins. A new shard can only win
rows for itself, so growing from n to n + 1 shards moves about 1 / (n + 1) of the rows, all of them into the new one.

Edges: null keys count as one key (the empty hash) and share a shard; repeated rows share a shard and get different
slots; an empty table gives an empty result; other columns are kept as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rendezvous_shard(key: Column, weights: Sequence[float]) -> Column:
    """Number of the winning shard for `key`; the shard of weight w gets its share w / sum(weights) of the keys."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive, one for each shard")

    def draw(shard: int, weight: float) -> Column:
        unit = (F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11) + F.lit(0.5)) / F.lit(float(2**53))
        return F.struct((F.lit(-float(weight)) / F.ln(unit)).alias("draw"), F.lit(-shard).alias("minus_shard"))

    draws = [draw(i, w) for i, w in enumerate(weights)]
    best = F.greatest(*draws) if len(draws) > 1 else draws[0]
    return (-best["minus_shard"]).cast("int")


def assign_shards(df: DataFrame, key: str, weights: Sequence[float], output: str = "shard") -> DataFrame:
    """`df` with its shard; no shuffle, so texts stay where they are."""
    return df.withColumn(output, rendezvous_shard(F.col(f"`{key}`"), weights))


def number_slots(rows: DataFrame, shard: str = "shard", buckets: int = 256, output: str = "slot") -> DataFrame:
    """Gapless numbers from 0 within every shard, for narrow `rows` (keys and digests, no texts).

    A shard is numbered in `buckets` pieces by a hash of the whole row, so no task holds a shard. Equal rows are
    counted before they are shuffled and written out again at the end, so one row with many copies is no hot spot.
    The offsets table has a row for each shard and bucket at most.
    """
    columns = rows.columns
    taken = set(columns)
    names = []
    for name in ("_bucket", "_copies", "_before", "_offset", "_copy"):
        while name in taken:
            name += "_"
        names.append(name)
    bucket, copies, before, offset, copy = names
    counted = (
        rows.withColumn(bucket, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in columns]), F.lit(buckets)))
        .groupBy(*columns, bucket)
        .agg(F.count(F.lit(1)).alias(copies))
    )
    totals = counted.groupBy(shard, bucket).agg(F.sum(copies).alias(before))
    earlier = Window.partitionBy(shard).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col(shard).alias(f"{offset}s"), F.col(bucket).alias(f"{offset}b"),
        F.coalesce(F.sum(before).over(earlier), F.lit(0)).alias(offset),
    )
    inside = (
        Window.partitionBy(shard, bucket).orderBy(*[F.col(f"`{c}`") for c in columns])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        counted.withColumn(before, F.coalesce(F.sum(copies).over(inside), F.lit(0)))
        .join(F.broadcast(offsets), F.col(shard).eqNullSafe(F.col(f"{offset}s")) & (F.col(bucket) == F.col(f"{offset}b")))
        .withColumn(copy, F.explode(F.sequence(F.lit(0).cast("long"), F.col(copies) - 1)))
        .select(*columns, (F.col(offset) + F.col(before) + F.col(copy)).alias(output))
    )


def shard_documents(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, size, checksum, shard, slot and the shard with one more: the plan of a sharded write of equal weights.

    size: UTF-8 bytes of the text (null: none) plus 8; the checksum of a null text is that of the empty one.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    narrow = docs.select(
        F.col(f"`{key}`").alias(key),
        (F.length(body) + 8).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous_shard(F.col(f"`{key}`"), [1.0] * shards).alias("shard"),
        rendezvous_shard(F.col(f"`{key}`"), [1.0] * (shards + 1)).alias("grown_shard"),
    )
    return number_slots(narrow)
