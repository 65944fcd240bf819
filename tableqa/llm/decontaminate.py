"""Benchmark decontamination by SimHash of item-sized windows; DataFrame operations only.

A window has as many words as a benchmark item; a text of fewer words is one window as a whole. Windows are taken wherever a text shares a five-word shingle with an
item, so that the shared shingle has the same place in both; a window without one has similarity 0. Windows get a
64-bit SimHash of their shingles. The fingerprint is cut into seven blocks, and the items are filed under all values
within two bits of each block: fingerprints that differ in at most 20 bits agree up to two bits in one block at least,
so every window finds all items of its size within the radius. Full distances are checked, then the exact weighted
similarity of the shingles (sum of the smaller by sum of the larger multiplicities) decides; 0.8 or more is a leak.

The radius: windows of similarity 0.8 differ in 9.7 of 64 bits on average, with a deviation of 2.9, so 20 bits lose
about one pair in five thousand at the very threshold and fewer above it.

Items of fewer than five words are one shingle. Edges: null, empty and too short texts leak nothing; items without
words are ignored; every text of a null item id is an item of its own, reported with the null id; repeated rows of documents or items give repeated results for each item row only; a doc id used by
several texts gives a row for each text that leaks; empty tables give no rows.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableqa.llm import common

SHINGLE = 5
BLOCKS = ((0, 10), (10, 9), (19, 9), (28, 9), (37, 9), (46, 9), (55, 9))
RADIUS = 20
_LANES = 0x0000000100000001  # two counters of 32 bits in a long


def simhash(grams: Column) -> Column:
    """Fingerprint of an array of hashes: bits set in over half of them. Counters of bits i and i + 32 share a long."""
    zeros, shifts = F.array_repeat(F.lit(0).cast("long"), 32), F.sequence(F.lit(0), F.lit(31))

    def bit(count: Column, half: Column, at: Column) -> Column:
        return F.when(count * 2 > half, F.call_function("shiftleft", F.lit(1).cast("long"), at)).otherwise(F.lit(0).cast("long"))

    def of(hashes: Column) -> Column:
        counts = F.aggregate(hashes, zeros, lambda sums, x: F.zip_with(
            sums, shifts, lambda s, i: s + F.call_function("shiftrightunsigned", x, i).bitwiseAND(F.lit(_LANES))
        ))
        halves = F.zip_with(counts, shifts, lambda c, i: bit(c.bitwiseAND(F.lit(0xFFFFFFFF)), F.size(hashes), i).bitwiseOR(
            bit(F.shiftrightunsigned(c, 32), F.size(hashes), i + 32)
        ))
        return F.aggregate(halves, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))

    return common.bound(grams, of)


def weighted(grams: Column) -> Column:
    """The multiset as a set: every hash with the number of equal ones before it."""
    return common.bound(F.sort_array(grams), lambda ordered: F.transform(
        ordered, lambda x, i: F.xxhash64(x, i.cast("long") - F.array_position(ordered, x))
    ))


def similarity(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)


def _block(fp: Column, first: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << width) - 1)).cast("int")


def _filed(fp: Column, number: int, first: int, width: int) -> Column:
    """All values within two bits of a block of `fp`, as (b, value)."""
    flips = [sum(1 << x for x in bits) for size in range(3) for bits in itertools.combinations(range(width), size)]
    block = _block(fp, first, width)
    return F.transform(F.array(*map(F.lit, flips)), lambda f: F.struct(F.lit(number).alias("b"), block.bitwiseXOR(f).alias("value")))


def item_table(items: DataFrame, key: str, text: str) -> DataFrame:
    """item, id (hash of item and words, never null), n (words), k (words of a shingle), grams, fp, shingles."""
    n = F.size("w")
    shorter = [F.when(n == k, common.word_grams(F.col("w"), k)) for k in range(1, SHINGLE)]
    return (
        items.select(F.col(f"`{key}`").alias("item"), common.words(text).alias("w")).where(n > 0)
        .select("item", F.xxhash64("item", "w").alias("id"), n.alias("n"), F.least(n, F.lit(SHINGLE)).alias("k"),
                F.coalesce(*shorter, common.word_grams(F.col("w"), SHINGLE)).alias("all"))
        .select("item", "id", "n", "k", F.slice("all", F.lit(1), F.col("n") - F.col("k") + 1).alias("grams"))
        .select("item", "id", "n", "k", "grams", simhash(F.col("grams")).alias("fp"), weighted(F.col("grams")).alias("shingles"))
    )


def anchored_windows(docs: DataFrame, items: DataFrame, key: str, text: str, k: int, threshold: float) -> DataFrame:
    """(key, mark, n, size, start): where a text shares a shingle with an item of n words; one scan, no shuffle of texts.

    A text of fewer words is one window of its own size, if so few can reach `threshold`.
    """
    places = items.where(F.col("k") == k).select("n", F.posexplode("grams").alias("at", "gram")).distinct()
    hashed = docs.select(
        F.col(f"`{key}`").alias("key"), F.xxhash64(F.col(f"`{text}`")).alias("mark"), common.words(text).alias("w"),
    ).select("key", "mark", F.size("w").alias("words"), F.posexplode(common.word_grams(F.col("w"), k)).alias("p", "gram"))
    # a window that would stick out is moved to the begin or end of the text
    start = F.greatest(F.lit(0), F.least(F.col("p") - F.col("at"), F.col("words") - F.col("n")))
    size = F.least("words", "n")
    return (
        hashed.join(common.small(places), "gram")
        .where((size - k + 1 >= (F.col("n") - k + 1) * F.lit(threshold - 1e-9)) & (F.col("p") <= F.col("words") - k))
        .select("key", "mark", "n", size.alias("size"), start.alias("start")).distinct()
    )


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
          item_text: str = "text", threshold: float = 0.8, radius: int = RADIUS) -> DataFrame:
    """A row for each text and item that it contains: key, item, start and n_words of the best window, similarity, distance."""
    if not 0 <= radius < 3 * len(BLOCKS):
        raise ValueError(f"radius must be below {3 * len(BLOCKS)}")
    known = common.cut(item_table(items, item_key, item_text))
    files = known.select("item", "id", "n", "k", "fp", F.explode(F.concat(*[
        _filed(F.col("fp"), i, first, width) for i, (first, width) in enumerate(BLOCKS)
    ])).alias("f")).select("item", "id", "n", "k", "fp", "f.b", "f.value")
    out = None
    for k in sorted(r[0] for r in known.select("k").distinct().collect()):  # one to five values
        windows = common.cut(anchored_windows(docs, known, key, text, k, threshold))
        of = windows.select(F.col("key").alias("of"), F.col("mark").alias("of_mark"), F.struct("start", "n", "size").alias("window"))
        listed = of.groupBy("of", "of_mark").agg(F.collect_list("window").alias("windows"))
        named = docs.select(F.col(f"`{key}`").alias("key"), F.xxhash64(F.col(f"`{text}`")).alias("mark"), F.col(f"`{text}`").alias("body"))
        same = F.col("key").eqNullSafe(F.col("of")) & (F.col("mark") == F.col("of_mark"))
        cutouts = (
            named.join(common.small(listed), same)
            .select("key", "mark", "windows", common.word_grams(common.words("body"), k).alias("grams"))
            .select("key", "mark", "grams", F.explode("windows").alias("w"))
            .select("key", "mark", F.col("w.n").alias("n"), F.col("w.size").alias("size"), F.col("w.start").alias("start"),
                    F.slice("grams", F.col("w.start") + 1, F.col("w.size") - k + 1).alias("grams"))
            .withColumn("window_fp", simhash(F.col("grams")))
        )
        cutouts = common.cut(cutouts)  # else the optimizer writes the fingerprint out anew for every block
        blocks = cutouts.select("key", "mark", "n", "size", "start", "window_fp", "grams", F.explode(F.array(*[
            F.struct(F.lit(i).alias("b"), _block(F.col("window_fp"), first, width).alias("value")) for i, (first, width) in enumerate(BLOCKS)
        ])).alias("f")).select("key", "mark", "n", "size", "start", "window_fp", "grams", "f.b", "f.value")
        distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("window_fp")))
        near = (
            blocks.join(common.small(files.where(F.col("k") == k)), ["n", "b", "value"])
            .withColumn("distance", distance).where(F.col("distance") <= radius)
            .join(common.small(known.select("id", "shingles").dropDuplicates(["id"])), "id")
            .withColumn("similarity", similarity(weighted(F.col("grams")), F.col("shingles")))
            .where(F.col("similarity") >= threshold)
        )
        best = near.groupBy("key", "mark", "item", F.when(F.col("item").isNull(), F.col("id")).alias("unnamed")).agg(F.max(F.struct(
            "similarity", (-F.col("start")).alias("before"), (-F.col("distance")).alias("nearer"), F.col("size").alias("words"),
        )).alias("best"))
        found = best.select(
            F.col("key").alias(key), F.col("mark").alias("text_hash"), F.col("item").alias(item_key), (-F.col("best.before")).cast("long").alias("start"),
            F.col("best.words").cast("long").alias("n_words"), F.col("best.similarity").alias("similarity"), (-F.col("best.nearer")).alias("distance"),
        )
        out = found if out is None else out.unionByName(found)
    if out is None:
        return docs.sparkSession.createDataFrame([], f"{key} long, text_hash long, {item_key} long, start long, n_words long, similarity double, distance int")
    return out


def clean(docs: DataFrame, leaked: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` without the texts that `leaks` has found."""
    of, of_mark = common.free_names(docs, "leak_key", "leak_mark")
    bad = leaked.select(F.col(key).alias(of), F.col("text_hash").alias(of_mark)).distinct()
    return docs.join(common.small(bad), F.col(f"`{key}`").eqNullSafe(F.col(of)) & (F.xxhash64(F.col(f"`{text}`")) == F.col(of_mark)), "left_anti")
