"""Near-duplicates by SimHash fingerprints and multi-index hashing.

A fingerprint has 64 bits; two documents link if theirs differ in at most `radius` bits. The fingerprint is cut into
three segments. If two fingerprints differ in at most r = 3q + s bits (s < 3), then one of the first s + 1 segments
differs in at most q bits or one of the others in at most q - 1. So every distinct fingerprint looks up the Hamming ball
of that size around each of its segments in the table of segments, and full distances of what is found are checked.
That finds every link. With 21 or 22 bits a segment, a lookup meets n / 2^21 unrelated fingerprints.

Equal fingerprints are one entry, so copies cost nothing. A table entry whose segment is shared by more than `hot`
distinct fingerprints is not compared in pairs: all fingerprints that meet there write out the ball of half the radius
around themselves, and those that share a point of it are chained to the smallest one. Two fingerprints within the
radius have a point half-way, so no link is lost, and rows grow with the group, not with its square.

Edges: null and empty texts and texts without words have fingerprint zero and are linked like any other; repeated rows
are separate members; null ids stay, and a class whose ids are all null has a null id; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableqa.llm import common
from tableqa.llm.components import components

SEED = 42
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit and width
HOT = 4096
PIECE = 1 << 16  # shingles hashed in one step


def _split(text: str | None) -> list[bytes]:
    """bytes.lower and bytes.split change A-Z and split at ASCII white space only, as asked for."""
    return (text or "").encode("utf-8", "replace").lower().split()


def _shingle_hashes(found: list[bytes], words: int) -> Iterator[np.ndarray]:
    """Hashes of the shingles of the words, in order and in pieces; none without words."""
    if not found:
        return
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), dtype=np.int64, count=len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(found) - words + 1)
    starts, ends = starts[:n].tolist(), (ends[words - 1 :] if len(found) >= words else ends[-1:]).tolist()
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, PIECE):
        yield np.array([digest(joined[a:b], SEED) for a, b in zip(starts[at : at + PIECE], ends[at : at + PIECE])], dtype=np.uint64)


def _over_half(pieces: Iterable[np.ndarray]) -> int:
    """Signed 64-bit number: a bit is set if it is set in over half of the hashes."""
    ones, n = np.zeros(64, dtype=np.int64), 0
    for hashes in pieces:
        n += len(hashes)
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        for part in range(0, len(bits), 255):  # sums of so many bits fit a byte
            ones += bits[part : part + 255].sum(axis=0, dtype=np.uint8)
    return int(np.packbits(ones * 2 > n).view(">i8")[0])


def fingerprint(text: str | None, words: int = 4) -> int:
    """Signed 64-bit fingerprint: a bit is set if it is set in over half the hashes of the shingles."""
    return _over_half(_shingle_hashes(_split(text), words))


def fingerprints(text: Column, words: int = 4) -> Column:
    """Column of fingerprints; only the text goes to Python."""

    @F.pandas_udf("long")
    def simhash(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([fingerprint(t, words) for t in part], dtype="int64")

    return simhash(text)


def _balls(radius: int) -> list[tuple[int, int, int, list[int]]]:
    """Segment number, first bit, mask and the differences to look up in that segment."""
    each, more = divmod(radius, len(SEGMENTS))
    out = []
    for number, (first, width) in enumerate(SEGMENTS):
        reach = each if number <= more else each - 1
        flips = [
            sum(1 << bit for bit in bits) for size in range(reach + 1) for bits in itertools.combinations(range(width), size)
        ]
        if reach >= 0:
            out.append((number, first, (1 << width) - 1, flips))
    return out


def _segment(fp: Column, first: int, mask: int) -> Column:
    return F.shiftrightunsigned(fp, first).bitwiseAND(F.lit(mask)).cast("int")


def links(distinct: DataFrame, radius: int = 4, hot: int = HOT) -> DataFrame:
    """Links (a, b) between the fingerprints of `distinct` (column fp, no repeats) that connect what is within `radius`.

    All links between fingerprints outside hot segments; within those, chains that connect the same classes.
    """
    if radius not in (0, 2, 4, 6):
        raise ValueError("radius must be 0, 2, 4 or 6")  # an even one, so that balls of half of it meet half-way
    fp, balls = F.col("fp"), _balls(radius)
    probes = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(number).cast("byte").alias("s"), _segment(fp, first, mask).bitwiseXOR(F.lit(flip)).alias("key"))
        for number, first, mask, flips in balls for flip in flips
    ])).alias("p")).select("fp", "p.s", "p.key")
    entries = distinct.select(fp.alias("other"), F.explode(F.array(*[
        F.struct(F.lit(number).cast("byte").alias("s"), _segment(fp, first, mask).alias("key"))
        for number, first, mask, _ in balls
    ])).alias("p")).select("other", "p.s", "p.key")
    crowded = common.cut(entries.groupBy("s", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot))
    any_hot = crowded.count() > 0
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("other")))
    if not any_hot:
        return _pairs(probes, entries, distance, radius)
    calm = [t.join(crowded, ["s", "key"], "left_anti") for t in (probes, entries)]
    meeting = (
        probes.join(crowded, ["s", "key"], "left_semi").select("fp")
        .union(entries.join(crowded, ["s", "key"], "left_semi").select("other")).distinct()
    )
    return _pairs(*calm, distance, radius).union(_chains(meeting, radius))


def _pairs(probes: DataFrame, entries: DataFrame, distance: Column, radius: int) -> DataFrame:
    # both fingerprints of a pair look up the same ball, so one direction is enough
    return (
        probes.join(entries, ["s", "key"]).where((F.col("fp") < F.col("other")) & (distance <= radius))
        .select(F.col("fp").alias("a"), F.col("other").alias("b")).distinct()
    )


def _chains(meeting: DataFrame, radius: int) -> DataFrame:
    """Each fingerprint is linked to the smallest one that shares a point of its ball of half the radius."""
    reached = meeting.select("fp", F.explode(_ball_points(F.col("fp"), radius // 2)).alias("point"))
    least = reached.groupBy("point").agg(F.min("fp").alias("low"))
    return (
        reached.join(least, "point").where("fp <> low").select(F.col("fp").alias("a"), F.col("low").alias("b")).distinct()
    )


def _ball_points(fp: Column, reach: int) -> Column:
    """Array of all 64-bit values within `reach` flips of fp, built by flipping one more bit at a time."""
    points = F.array(fp)
    for _ in range(reach):
        points = F.array_distinct(F.concat(points, F.flatten(F.transform(
            points, lambda p: F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: p.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)))
        ))))
    return points


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 4, radius: int = 4,
                    hot: int = HOT) -> DataFrame:
    """One row for each document: its key, `fingerprint` (16 hex digits) and `component_id`, the smallest key reachable."""
    marked = common.cut(docs.select(F.col(f"`{key}`").alias(key), fingerprints(F.col(f"`{text}`"), words).alias("fp")))
    distinct = marked.groupBy("fp").agg(F.min(key).alias("least"))
    distinct = common.cut(distinct)
    roots = components(links(distinct.select("fp"), radius, hot))
    rooted = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(names, "root").select(F.col("fp").alias("of"), "component_id")
    return marked.join(classes, F.col("fp") == F.col("of")).select(
        key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


# ---------------------------------------------------------------------------------------------------------------
# Near-duplicates by similarity: links of fingerprints, and all texts that share a shingle of their prefixes, which holds
# every pair that is similar enough; exact similarity decides
# ---------------------------------------------------------------------------------------------------------------

RADIUS = 4  # bits in which fingerprints that link may differ
ORDER_TEXTS, ORDER_KEPT = 8192, 1 << 18  # texts in which shingles are counted to put them in order, and counts kept
SKETCH = 512  # least bits of a text's sketch
FEW = 16  # texts of one shingle that are compared in pairs before classes are known
HUB = 256  # pairs of one text that are verified in one place
PLACE = 1024  # texts outside the largest class of a shingle that are compared with all others in one place
TEXTS, PAIRS_EACH = 4096, 2048  # texts with their shingles, and pairs to be compared, that make a task
BATCH = 1000  # texts or pairs that Python holds at once
SLACK = 1e-6  # bounds are loose by this much, so that no rounding drops a pair


def _as_set(hashes: np.ndarray) -> np.ndarray:
    """A multiset of hashes as a set: hashes mixed with the number of equal ones before."""
    hashes = np.sort(hashes)
    first = np.concatenate([[True], hashes[1:] != hashes[:-1]]) if len(hashes) else np.zeros(0, dtype=bool)
    at = np.arange(len(hashes))
    before = (at - np.maximum.accumulate(np.where(first, at, 0))).astype(np.uint64)
    return (hashes + before * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def _all_hashes(text: str | None, words: int) -> np.ndarray:
    return np.concatenate([np.zeros(0, dtype=np.uint64), *_shingle_hashes(_split(text), words)])


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """The multiset of a text's shingles as a set; none without words."""
    return _as_set(_all_hashes(text, words))


def prefix_length(n: int, similarity: float) -> int:
    """Two sets of the similarity share one of so many first elements of each, in whatever order all sets are put."""
    return n - math.ceil(similarity * n - SLACK) + 1


def prefix(shingles: np.ndarray, similarity: float, known: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first shingles of the set by (count, value). `known` is sorted; a shingle that is not in it has count 0."""
    often = np.zeros(len(shingles), dtype=np.int64)
    if len(known):
        at = np.minimum(np.searchsorted(known, shingles), len(known) - 1)
        often = np.where(known[at] == shingles, counts[at], 0)
    return shingles[np.lexsort((shingles, often))[: prefix_length(len(shingles), similarity)]]


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Parities of the numbers of shingles in groups, at least as many as shingles and a power of two of them, SKETCH or more:
    two sets differ in as many shingles at least as their sketches in bits. Halves of one, added, are a sketch of half the size."""
    size = max(SKETCH, 1 << max(0, len(shingles) - 1).bit_length())
    groups = np.bincount((shingles.view(np.uint64) % np.uint64(size)).astype(np.int64), minlength=size)
    return np.packbits((groups & 1).astype(np.uint8)).view(np.int64)


def _sketch_distance(a: Column, b: Column) -> Column:
    """Bits in which sketches differ, the larger one halved; 0 if one is over twice the size."""
    def halved(x: Column, other: Column) -> Column:
        half = (F.size(x) / 2).cast("int")
        return F.when(F.size(x) > F.size(other), F.zip_with(F.slice(x, F.lit(1), half), F.slice(x, half + 1, half), lambda u, v: u.bitwiseXOR(v))).otherwise(x)

    bits = F.zip_with(halved(a, b), halved(b, a), lambda u, v: F.bit_count(u.bitwiseXOR(v)))
    return F.coalesce(F.aggregate(bits, F.lit(0), lambda total, n: total + n), F.lit(0))


def _high(n: Column, rest: Column, similarity: float) -> Column:
    """Size of the largest set that can be similar enough to one of n elements, if they share no more than rest."""
    share = F.least(n / F.lit(similarity), rest * F.lit((1 + similarity) / similarity) - n)
    return F.floor(share + F.lit(SLACK)).cast("int")


def _meetings(entries: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs of entries (value, id, n, high), and the entries of crowded values, which need more than these pairs.

    `high` is the size of the largest text that a text of size n can be similar to if this value is the first that the two
    share; neither may be larger than the other's. Up to `most` texts of a value are paired with each other. Of more, each is
    paired with the hub, the text that has the smallest part of its values before this one, so the most in common with
    others. An entry stays unless all texts of the value are too large for it.
    """
    whole = Window.partitionBy("value")
    met = entries.withColumn("many", F.count(F.lit(1)).over(whole)).where("many > 1")
    met = met.withColumn("first", F.min(F.struct((-F.col("high") / F.col("n")).alias("part"), "id")).over(whole))
    met = met.withColumn("least", F.min("n").over(whole)).withColumn("others", F.collect_list(F.struct("id", "n", "high")).over(
        whole.orderBy("id").rowsBetween(1, most)
    ))
    fitting = F.filter("others", lambda x: (x.id != F.col("id")) & (x.n <= F.col("high")) & (F.col("n") <= x.high))
    partners = F.when(F.col("many") <= most, F.transform(fitting, lambda x: x.id)).otherwise(F.array().cast("array<long>"))
    met = common.packed(met.select(
        "value", "id", "n", "high", F.col("first.id").alias("hub"), (F.col("many") > most).alias("crowded"),
        (F.col("high") >= F.col("least")).alias("able"), partners.alias("partners"),
    ).where("crowded AND able OR size(partners) > 0"))
    crowd = met.where("crowded")
    pairs = met.select(F.explode("partners").alias("a"), F.col("id").alias("b"))
    with_hub = crowd.where("id <> hub").select(F.col("id").alias("a"), F.col("hub").alias("b"))
    return pairs.union(with_hub).distinct(), crowd.select("value", "id", "n", "high")


def _reordered(sets: DataFrame, similarity: float) -> DataFrame:
    """Entries of the prefixes of texts (id, set), in the order of the number of these texts that hold a shingle. Those of one
    text alone come first and meet nobody."""
    held = sets.select("id", F.size("set").alias("n"), F.explode("set").alias("value"))
    counts = common.packed(held.groupBy("value").agg(F.count(F.lit(1)).alias("often")).where("often > 1"))
    shared = held.join(common.small(counts), "value").groupBy("id", "n").agg(F.array_sort(F.collect_list(F.struct("often", "value"))).alias("shared"))
    alone = F.col("n") - F.size("shared")
    length = F.col("n") - F.ceil(F.col("n") * F.lit(similarity) - F.lit(SLACK)).cast("int") + 1
    entries = shared.select("id", "n", alone.alias("alone"), F.posexplode(F.slice("shared", F.lit(1), F.greatest(length - alone, F.lit(0)))).alias("at", "x"))
    return entries.select(F.col("x.value").alias("value"), "id", "n", _high(F.col("n"), F.col("n") - F.col("alone") - F.col("at"), similarity).alias("high"))


def _several(crowd: DataFrame) -> DataFrame:
    """Entries, with their class (root), of values that hold several classes: adds the largest one and the number of others."""
    sizes = crowd.groupBy("value", "root").agg(F.count(F.lit(1)).alias("n"))
    values = sizes.groupBy("value").agg(
        F.max(F.struct("n", "root")).alias("largest"), F.sum("n").alias("all"), F.count(F.lit(1)).alias("classes")
    ).where("classes > 1")
    values = common.packed(values.select("value", F.col("largest.root").alias("largest"), (F.col("all") - F.col("largest.n")).alias("strays")))
    return common.packed(crowd.join(common.small(values), "value"))


def _across(met: DataFrame) -> DataFrame:
    """All candidate pairs of different classes that meet in the values of `_several`.

    One of such a pair at least is not of the value's largest class, so those texts are compared with all of the value, in
    places of PLACE of them. Only pairs that can be similar enough leave the join.
    """
    places = F.ceil(F.col("strays") / PLACE).cast("int")
    a, b = ([F.col(c).alias(f"{c}_{x}") for c in ("id", "n", "high", "root")] for x in "ab")
    strays = met.where("root <> largest").select("value", F.pmod(F.xxhash64("id"), places).cast("int").alias("place"), *a)
    others = met.select("value", F.explode(F.sequence(F.lit(0), places - 1)).alias("place"), "largest", *b)
    return strays.join(others, ["value", "place"]).where(
        "root_a <> root_b AND (root_b = largest OR id_a > id_b) AND n_a <= high_b AND n_b <= high_a"
    ).select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct()


def _fingerprint_pairs(texts: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Candidate pairs (a > b) of texts (id, fp): `links` between the smallest texts of fingerprints, and each text of a
    fingerprint with its smallest one."""
    hubs = common.packed(texts.groupBy("fp").agg(F.min("id").alias("hub")))
    equal = texts.select("id", "fp").join(hubs, "fp").where("id > hub").select(F.col("id").alias("a"), F.col("hub").alias("b"))
    near = links(hubs.select("fp"), radius).toDF("fa", "fb")
    for x in "ab":
        near = common.small(common.packed(near)).join(hubs.select(F.col("fp").alias(f"f{x}"), F.col("hub").alias(f"h{x}")), f"f{x}")
    return equal.union(near.select(F.greatest("ha", "hb").alias("a"), F.least("ha", "hb").alias("b"))).distinct()


def similar_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, similarity: float = 0.8) -> DataFrame:
    """key, mark (hash of the text), class: classes of texts whose word shingles are `similarity` or more alike.

    Two texts link if the exact weighted similarity of their shingles (sum of the smaller by sum of the larger
    multiplicities) is at least `similarity`. No link is lost, whatever the texts: candidates that are not compared are of one
    class already or cannot be similar enough. Texts of the same words are one unit.

    Candidates are the links of `links` (fingerprints that differ in RADIUS bits at most, by Hamming balls around segments),
    which hold most near copies, and all texts that share a shingle of their prefixes: if all shingles are put in one
    order, two texts of the similarity share one of the first n - similarity * n + 1 of each. Any order will do. Here
    shingles that are frequent in some ORDER_TEXTS texts come last, so that few texts meet who have little in common; those
    counts decide on the work, not on the result. Size, what is left behind the shared shingle and sketches drop candidates
    that cannot reach the similarity.

    Of a crowded shingle each text is first compared with the hub. If several classes remain, the texts outside the
    largest one, PLACE at most, are compared with all of the shingle. Where they are more, the texts are put in order anew,
    by the exact counts of all their shingles among them, and meet again; what is crowded then is compared whole, but for
    pairs of one class. That grows with the square of the texts only where many texts that have over `similarity` of their
    shingles in common with others do not link to the largest class.

    Edges: null texts and texts without words are one class; repeated rows are rows of one class; null keys stay; other
    columns are not read; an empty table gives no rows.
    """
    body = F.col(f"`{text}`")
    mark = F.xxhash64(F.coalesce(body, F.lit("")))

    @F.pandas_udf("array<long>")
    def shingles(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([shingle_set(t, words) for t in part], dtype=object)

    @F.pandas_udf("double")
    def shared_part(a: pd.Series, b: pd.Series) -> pd.Series:
        both = np.array([len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(a, b)], dtype=float)
        total = a.map(len).to_numpy(dtype=float) + b.map(len).to_numpy(dtype=float) - both
        return pd.Series(both / np.maximum(total, 1))

    bodies = docs.select(mark.alias("mark"), F.coalesce(body, F.lit("")).alias("body"))
    some = bodies.where(F.pmod("mark", F.lit(max(1, docs.count() // ORDER_TEXTS))) == 0).dropDuplicates(["mark"])
    with common.batches(docs.sparkSession, BATCH):
        counted = common.packed(some.select(F.explode(shingles("body")).alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    kept, least = 0, 2
    for n, times in sorted(map(tuple, counted.groupBy("n").count().collect()), reverse=True):
        kept += times
        if kept > ORDER_KEPT:
            least = n + 1
            break
    frequent = counted.where(F.col("n") >= least).toArrow()
    known, counts = (frequent.column(c).to_numpy() for c in ("value", "n"))
    known, counts = known[np.argsort(known)], counts[np.argsort(known)]

    @F.pandas_udf("unit long, n int, fp long, bits array<long>, prefix array<long>")
    def signature(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for t in part:
                hashes = _all_hashes(t, words)
                own = _as_set(hashes)
                out.append((
                    np.uint64(xxhash.xxh64_intdigest(b" ".join(_split(t)), SEED)).astype(np.int64), max(1, len(own)),
                    _over_half([hashes]), sketch(own), prefix(own, similarity, known, counts),
                ))
            yield pd.DataFrame(out, columns=["unit", "n", "fp", "bits", "prefix"])

    with common.batches(docs.sparkSession, BATCH):
        marked = common.cut(docs.select(F.col(f"`{key}`").alias("key"), mark.alias("mark"), signature(body).alias("w")).select(
            "key", "mark", "w.*", F.monotonically_increasing_id().alias("row")
        ))
    first = marked.groupBy("unit").agg(F.min("row").alias("first"))
    again = common.packed(marked.select("unit", "row").join(first, "unit").where("row <> first").select("row"))
    single = marked.join(common.small(again), "row", "left_anti").withColumnRenamed("unit", "id")
    texts = common.packed(single.select("id", "mark", "n", "fp", "bits"), TEXTS)
    units = marked.select("key", "mark", "unit")
    na, nb = F.col("na"), F.col("nb")
    # n elements that differ in d share (n - d) / 2 at most
    possible = (F.greatest(na, nb) * F.lit(similarity) <= F.least(na, nb) + F.lit(SLACK)) & (
        (na + nb - F.col("d")) / 2 >= (na + nb) * F.lit(similarity / (1 + similarity)) - F.lit(SLACK)
    )
    left, right = (texts.select(F.col("id").alias(x), F.col("n").alias(f"n{x}"), F.col("bits").alias(f"h{x}")) for x in "ab")
    found = roots = None

    def sets_of(ids: DataFrame) -> DataFrame:
        """Shingles of the texts; only these texts are read again."""
        wanted = common.packed(texts.select("id", F.col("mark").alias("of")).join(ids, "id", "left_semi"))
        read = bodies.join(common.small(wanted), F.col("mark") == F.col("of"))
        with common.batches(docs.sparkSession, BATCH):
            return common.packed(read.select("id", "body").dropDuplicates(["id"]).select("id", shingles("body").alias("set")), TEXTS)

    def held(pairs: DataFrame) -> DataFrame:
        """The texts of pairs."""
        return common.small(common.packed(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()))

    def verified(pairs: DataFrame, sets: DataFrame | None) -> DataFrame:
        """Pairs (a, b) of the exact similarity. A few sets go to all pairs; of many, each goes to the pairs of its text, and
        hubs are dealt to several places."""
        ids = held(pairs)
        sets = sets_of(ids) if sets is None else sets.join(ids, "id", "left_semi")
        few = common.small(sets)
        of_a, of_b = (few.select(F.col("id").alias(x), F.col("set").alias(f"s{x}")) for x in "ab")
        if few is not sets:
            compared = pairs.repartition(common.tasks(pairs.count(), PAIRS_EACH)).join(of_b, "b").join(of_a, "a")
        else:
            hubs = common.packed(pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / HUB).cast("int").alias("places")))
            busy = common.small(hubs.where("places > 1"))
            dealt = pairs.join(busy, "b", "left").select("a", "b", F.pmod(F.xxhash64("a"), F.coalesce("places", F.lit(1))).cast("int").alias("place"))
            sent = of_b.join(common.small(hubs), "b").select("b", F.explode(F.sequence(F.lit(0), F.col("places") - 1)).alias("place"), "sb")
            compared = dealt.join(sent, ["b", "place"]).join(of_a, "a")
        alike = compared.select("a", "b", shared_part("sa", "sb").alias("similarity")).where(F.col("similarity") >= similarity)
        with common.batches(docs.sparkSession, BATCH):
            return common.packed(alike.select("a", "b"))

    def root_of(rows: DataFrame, column: str, name: str) -> DataFrame:
        """Adds the class of a text so far."""
        if roots is None:
            return rows.withColumn(name, F.col(column))
        named = common.small(roots.select(F.col("node").alias("_node"), F.col("root").alias("_root")))
        return rows.join(named, F.col(column) == F.col("_node"), "left").withColumn(name, F.coalesce("_root", column)).drop("_node", "_root")

    def apart(pairs: DataFrame) -> DataFrame:
        return root_of(root_of(pairs, "a", "root_a"), "b", "root_b").where("root_a <> root_b").drop("root_a", "root_b")

    def sifted(pairs: DataFrame) -> DataFrame:
        """Pairs of different classes that can be similar enough, with the distance of their sketches."""
        pairs = common.packed(apart(pairs))
        of_b = right.join(held(pairs).withColumnRenamed("id", "b"), "b", "left_semi")
        met = left.join(common.small(pairs), "a").join(of_b, "b").withColumn("d", _sketch_distance(F.col("ha"), F.col("hb")))
        return common.packed(met.where(possible).select("a", "b", "d"))

    def joined(pairs: DataFrame, sets: DataFrame | None = None) -> None:
        """Joins the classes of all pairs that are similar: of each text with its nearest candidate first, which joins most
        copies, then of all others that are still of different classes."""
        nonlocal found, roots
        near = sifted(pairs)
        nearest = near.groupBy("a").agg(F.min(F.struct("d", "b")).alias("x")).select("a", F.col("x.b").alias("b"))
        for choose in (lambda: nearest, lambda: apart(near.select("a", "b"))):
            chosen = common.packed(choose())
            if chosen.isEmpty():
                return
            links_ = verified(chosen, sets)
            found = links_ if found is None else found.union(links_)
            roots = common.packed(components(found))

    entries = single.select("id", "n", F.posexplode("prefix").alias("at", "value")).select(
        "value", "id", "n", _high(F.col("n"), F.col("n") - F.col("at"), similarity).alias("high")
    )
    pairs, crowd = _meetings(entries, FEW)
    joined(_fingerprint_pairs(texts).union(pairs))
    met = _several(root_of(crowd, "id", "root"))
    if not met.isEmpty():
        joined(_across(met.where(F.col("strays") <= PLACE)))
        wide = met.where(F.col("strays") > PLACE).select("value", "id", "n", "high")
        met = _several(root_of(wide, "id", "root"))
    if not met.isEmpty():
        sets = sets_of(common.small(common.packed(met.select("id").distinct())))
        pairs, crowd = _meetings(_reordered(sets, similarity), FEW)
        joined(pairs, sets)
        met = _several(root_of(crowd, "id", "root"))
        if not met.isEmpty():
            joined(_across(met), sets)
    if roots is None:
        return units.select(F.col("key").alias(key), "mark", F.col("unit").alias("class"))
    return units.join(common.small(roots), F.col("unit") == F.col("node"), "left").select(
        F.col("key").alias(key), "mark", F.coalesce("root", "unit").alias("class")
    )


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """`docs` with one row for each class: that of the smallest key (null keys last; for equal keys the smallest mark).

    Of rows that agree in key and text the one of the smallest hash of all columns stays. Internal columns get names that
    `docs` does not have.
    """
    classes = common.cut(similar_classes(docs, key, text, **options).toDF("key", "mark", "class"))
    least = classes.groupBy("class").agg(F.min(F.struct(F.col("key").isNull().alias("unnamed"), "key", "mark")).alias("kept"))
    times = classes.groupBy("key", "mark").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    of_key, of_mark, copies = common.free_names(docs, "key", "mark", "copies")
    kept = least.select(F.col("kept.key").alias(of_key), F.col("kept.mark").alias(of_mark))
    repeated = times.select(F.col("key").alias("_k"), F.col("mark").alias("_m"), "times")
    kept = common.packed(kept.join(repeated, F.col(of_key).eqNullSafe(F.col("_k")) & (F.col(of_mark) == F.col("_m")), "left").select(
        of_key, of_mark, F.coalesce("times", F.lit(1)).alias(copies)
    ))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    mark = F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    same = F.col(f"`{key}`").eqNullSafe(F.col(of_key)) & (mark == F.col(of_mark))
    single = kept.where(F.col(copies) == 1)
    listed = common.small(single)
    if listed is not single:
        once = docs.join(listed, same).select(*columns)
    else:  # too many to be sent to the texts, unlike most often the rows that go; if both are, the texts are shuffled
        named = classes.select(F.col("key").alias(of_key), F.col("mark").alias(of_mark)).distinct()
        stays = single.select(F.col(of_key).alias("_k"), F.col(of_mark).alias("_m"))
        goes = common.packed(named.join(stays, F.col(of_key).eqNullSafe(F.col("_k")) & (F.col(of_mark) == F.col("_m")), "left_anti"))
        once = docs.join(common.small(goes), same, "left_anti").select(*columns)
    more = kept.where(F.col(copies) > 1)
    if more.isEmpty():
        return once
    row = F.struct(*[c.alias(f"c{i}") for i, c in enumerate(columns)])
    # the least of a group is found map-side, so rows of one null key and text are one row a task
    chosen = docs.join(common.small(more), same).select(of_key, of_mark, row.alias("row")).groupBy(of_key, of_mark).agg(
        F.min_by("row", F.xxhash64("row")).alias("row")
    )
    return once.union(chosen.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)]))
