import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tableqa.llm import common, shards, simhash
from tableqa.llm.components import components


def plain_fingerprint(text, words=4):
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(found[i : i + words]), 42) for i in range(max(1, len(found) - words + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(pairs, nodes):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def test_components(spark):
    random.seed(4)
    pairs = [(random.randrange(400), random.randrange(400)) for _ in range(230)] + [(1000 + i, 1001 + i) for i in range(150)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    expected = classes(pairs, {n for p in pairs for n in p})
    linked = {n for a, b in pairs if a != b for n in (a, b)}
    assert got == {n: expected[n] for n in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("hot", [4096, 1])
def test_near_duplicates_equal_all_pairs(spark, documents, texts, hot):
    rows = simhash.near_duplicates(documents, hot=hot).collect()
    assert len(rows) == len(texts)
    fps = {plain_fingerprint(t) for _, t in texts}
    ordered = sorted(fps)
    pairs = [(a, b) for i, a in enumerate(ordered) for b in ordered[:i] if bin(a ^ b).count("1") <= 4]
    of = classes(pairs, ordered)
    least = {}
    for i, t in texts:
        root = of[plain_fingerprint(t)]
        if i is not None:
            least[root] = min(i, least.get(root, i))
    key = lambda row: tuple(-1 if x is None else x for x in row)
    expected = [(i, f"{plain_fingerprint(t):016x}", least.get(of[plain_fingerprint(t)])) for i, t in texts]
    assert sorted(map(key, [(r.doc_id, r.fingerprint, r.component_id) for r in rows])) == sorted(map(key, expected))


@pytest.mark.parametrize("hot", [4096, 2])
def test_links_in_dense_groups(spark, hot):
    random.seed(5)
    base = random.getrandbits(64)
    values = {base}
    for _ in range(300):
        v = base
        for b in random.sample(range(64), random.choice((1, 2, 3, 6))):
            v ^= 1 << b
        values.add(v)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    found = components(simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), hot=hot))
    got = {r.node: r.root for r in found.collect()}
    ordered = sorted(signed)
    pairs = [(a, b) for i, a in enumerate(ordered) for b in ordered[:i] if bin((a ^ b) & (2**64 - 1)).count("1") <= 4]
    expected = classes(pairs, ordered)
    assert all(got.get(v, v) == expected[v] for v in ordered)


def test_similar_texts_are_one_class(spark):
    random.seed(6)
    words = [f"w{i}" for i in range(5000)]
    rows, groups = [], {}
    for g in range(60):
        base = random.choices(words, k=200)
        for c in range(5):
            copy = list(base)
            for _ in range(c % 3):  # at most two changed words: similarity of 0.9 and more
                copy[random.randrange(200)] = "changed"
            rows.append((len(rows), " ".join(copy)))
            groups.setdefault(g, []).append(len(rows) - 1)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r["class"] for r in simhash.similar_classes(docs).collect()}
    joined = sum(len({got[i] for i in ids}) == 1 for ids in groups.values())
    assert joined >= 58 and len(set(got.values())) >= 60
    kept = simhash.drop_near_duplicates(docs.union(docs)).collect()
    assert len({r.doc_id for r in kept}) == len(kept) == len(set(got.values()))
    dense = spark.createDataFrame([(i, " ".join(["same"] * 50 + [f"end{i}"])) for i in range(60)], docs.schema)
    assert simhash.drop_near_duplicates(dense).count() == 1
    assert simhash.drop_near_duplicates(docs.limit(0)).count() == 0


def test_similar_classes_hold_the_threshold(spark):
    random.seed(8)

    def multiset(text):
        found = text.lower().split()
        return Counter(tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4)))

    def alike(a, b):
        return sum((multiset(a) & multiset(b)).values()) / sum((multiset(a) | multiset(b)).values())

    rows, below, above = [], [], []
    for g in range(240):
        base = [f"g{g}w{i}" for i in range(204)]
        changed = 25 if g % 2 else 22  # words at the end: 175 of 225 shingles alike (0.78), or 178 of 222 (0.80)
        other = base[: 204 - changed] + [f"g{g}v{i}" for i in range(changed)]
        rows += [(2 * g, " ".join(base)), (2 * g + 1, " ".join(other))]
        (above if alike(rows[-2][1], rows[-1][1]) >= 0.8 else below).append(2 * g)
    assert len(above) == len(below) == 120
    # equal fingerprints, since one shingle is over half of each, but different texts
    rows += [(1000 + i, "same " * 45 + " ".join(f"tail{i}x{k}" for k in range(36))) for i in range(3)]
    got = {r.doc_id: r["class"] for r in simhash.similar_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert not any(got[i] == got[i + 1] for i in below)
    assert sum(got[i] == got[i + 1] for i in above) >= 115
    assert len({got[1000 + i] for i in range(3)}) == 3


def test_pairs_grow_with_texts_that_share_a_majority_shingle(spark, monkeypatch):
    """Texts whose fingerprints are equal by one frequent shingle, though they are 0.43 alike."""
    meetings, pairs = simhash._meetings, []

    def counted(entries, everything):
        found, crowd = meetings(entries, everything)
        pairs.append(found.count())
        return found, crowd

    monkeypatch.setattr(simhash, "_meetings", counted)
    made = {}
    for n in (100, 300):
        rows = [(i, "same " * 64 + " ".join(f"t{i}x{k}" for k in range(36))) for i in range(n)]
        pairs.clear()
        got = {r["class"] for r in simhash.similar_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert len(got) == n
        made[n] = sum(pairs)
    assert made[300] < 5 * max(made[100], 300)


def test_recall_against_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, Counter(simhash.shingle_set(r.text, 5).tolist())) for r in docs.collect()]
    holders, shared = {}, Counter()
    for i, shingles in rows:
        for x in shingles:
            holders.setdefault(x, []).append(i)
    for ids in holders.values():
        if len(ids) < 200:
            shared.update((a, b) for k, a in enumerate(ids) for b in ids[k + 1 :])
    size = {i: len(s) for i, s in rows}
    pairs = [(a, b) for (a, b), n in shared.items() if n / (size[a] + size[b] - n) >= 0.8]
    got = {r.doc_id: r["class"] for r in simhash.similar_classes(docs).collect()}
    assert len(pairs) > 20
    assert sum(got[a] == got[b] for a, b in pairs) >= 0.95 * len(pairs)
    expected = classes(pairs, [i for i, _ in rows])
    assert all(expected[a] == expected[b] for a in got for b in got if a < b and got[a] == got[b])


def test_dropping_with_clashing_names_and_null_keys(spark):
    columns = ["key", "mark", "class", "copies", "unit", "n", "fp", "bands", "more", "_key", "_mark", "_n", "id", "node", "root"]
    docs = spark.createDataFrame([(None, "one two three four five six")] * 4 + [(3, "other words stand in this one here")] * 2 + [(9, None)], "doc_id long, text string")
    for c in columns:
        docs = docs.withColumn(c, F.lit(c))
    docs = docs.withColumn("copies", F.monotonically_increasing_id())
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert {(r.doc_id, r.text, r["class"], r._key) for r in kept.collect()} == {
        (None, "one two three four five six", "class", "_key"), (3, "other words stand in this one here", "class", "_key"), (9, None, "class", "_key"),
    }
    assert kept.count() == 3


def test_links_of_fingerprints_are_candidates(spark, monkeypatch):
    """Without the bands, what links by fingerprint is joined if it is similar, over several hops and in hot segments."""
    random.seed(9)
    rows, groups = [], []
    for g in range(30):
        base = [f"g{g}w{i}" for i in range(300)]
        groups.append([])
        for c in range(4):  # one word more is changed at each step
            groups[-1].append(len(rows))
            rows.append((len(rows), " ".join(["x"] * c + base[c:])))
    rows += [(1000 + i, "same " * 64 + " ".join(f"t{i}x{k}" for k in range(36))) for i in range(20)]  # equal fingerprints, 0.43 alike
    monkeypatch.setattr(simhash, "_meetings", lambda entries, most: (
        entries.limit(0).select(F.col("id").alias("a"), F.col("id").alias("b")), entries.limit(0)
    ))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r["class"] for r in simhash.similar_classes(docs).collect()}
    fps = {i: plain_fingerprint(t, 5) for i, t in rows}
    near = [(a, b) for ids in groups for k, a in enumerate(ids) for b in ids[k + 1 :] if bin(fps[a] ^ fps[b]).count("1") <= 4]
    assert len(near) > 30 and all(got[a] == got[b] for a, b in near)
    assert len({got[1000 + i] for i in range(20)}) == 20


def test_components_of_few_links_take_few_tasks(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pairs = [(i, i // 2) for i in range(1, 500)] + [(-i, -i // 3) for i in range(600, 700)]
        got = components(spark.createDataFrame(pairs, "a long, b long"))
        assert got.rdd.getNumPartitions() == 1
        expected = classes(pairs, {n for p in pairs for n in p})
        assert {r.node: r.root for r in got.collect()} == expected
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_many_kept_texts_are_not_shuffled(spark, monkeypatch, capsys):
    """More texts stay than may be broadcast, but few go."""
    rows = [(i, f"text number {i} has words {i * 7} of its own {i * 13}") for i in range(400)]
    rows += [(1000 + i, rows[i][1]) for i in range(20)] + [(None, rows[30][1]), (None, "a text without an id stands here"), (5, rows[5][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(common.small, "__defaults__", (100, 32 << 20))
    kept = simhash.drop_near_duplicates(docs)
    capsys.readouterr()
    kept.where("doc_id <> 5").explain()
    plan = capsys.readouterr().out
    assert "LeftAnti" in plan and "SortMergeJoin" not in plan
    assert sorted((r.doc_id if r.doc_id is not None else -1) for r in kept.collect()) == [-1, *range(400)]


def test_classes_do_not_depend_on_what_is_broadcast(spark, monkeypatch):
    random.seed(10)
    rows = []
    for g in range(6):
        base = [f"g{g}w{i}" for i in range(150)]
        for _ in range(25):  # some pairs over 0.8, some below
            copy = list(base)
            for _ in range(random.choice((1, 3, 5))):
                copy[random.randrange(150)] = f"v{random.randrange(10**6)}"
            rows.append((len(rows), " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = []
    for limit in (200_000, 0):
        monkeypatch.setattr(common.small, "__defaults__", (limit, 32 << 20))
        found.append({r.doc_id: r["class"] for r in simhash.similar_classes(docs).collect()})
    assert found[0] == found[1] and 6 <= len(set(found[0].values())) < 150


@pytest.mark.parametrize("few, place, kept", [(16, 1024, 1 << 18), (2, 7, 0)])
def test_no_link_is_lost_in_crowded_groups(spark, monkeypatch, few, place, kept):
    """Texts that link through a few others only, in groups where all share most of their shingles."""
    random.seed(11)
    rows = []
    for g in range(3):
        base = [f"g{g}w{i}" for i in range(150)]
        for changed in [2] * 45 + [1] * 2 + [3] * 30 + [5] * 10:
            copy = list(base)
            for at in random.sample(range(6, 144), changed):
                copy[at] = f"v{len(rows)}x{at}"
            rows.append((len(rows), " ".join(copy)))
    sets = {i: frozenset(simhash.shingle_set(t, 5).tolist()) for i, t in rows}
    alike = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    expected = classes([(a, b) for a in sets for b in range(a) if alike(a, b)], sets)
    for name, value in (("FEW", few), ("PLACE", place), ("ORDER_KEPT", kept)):
        monkeypatch.setattr(simhash, name, value, raising=False)
    docs = spark.createDataFrame(random.sample(rows, len(rows)), "doc_id long, text string")
    got = {r.doc_id: r["class"] for r in simhash.similar_classes(docs).collect()}
    least = {}
    for i in sorted(got):
        least.setdefault(got[i], i)
    assert 30 < len(set(expected.values())) < 200
    assert {i: least[c] for i, c in got.items()} == expected


def test_prefixes_and_sketches_lose_no_pair():
    random.seed(12)
    known = np.array(sorted(random.sample(range(5000), 300)), dtype=np.int64)
    counts = np.array([random.randrange(2, 9) for _ in known], dtype=np.int64)
    met = 0
    for _ in range(3000):
        a = set(random.sample(range(5000), random.randrange(1, 200)))
        b = set(random.sample(sorted(a), random.randrange(max(1, len(a) * 3 // 4), len(a) + 1))) | set(random.sample(range(5000), random.randrange(len(a) // 6 + 1)))
        x, y = (np.array(sorted(s), dtype=np.int64) for s in (a, b))
        assert np.bitwise_count((simhash.sketch(x) ^ simhash.sketch(y)).view(np.uint64)).sum() <= len(a ^ b)
        if len(a & b) >= 0.8 * len(a | b):
            met += 1
            assert set(simhash.prefix(x, 0.8, known, counts).tolist()) & set(simhash.prefix(y, 0.8, known, counts).tolist())
    assert met > 300


def test_sketches_of_two_sizes(spark):
    random.seed(13)
    sets = [set(random.sample(range(10**6), n)) for n in (3, 500, 512, 513, 600, 1100, 3000)]
    sets += [s | {2 * 10**6} for s in sets]
    rows = [(i, k, simhash.sketch(np.array(sorted(a), dtype=np.int64)).tolist(), simhash.sketch(np.array(sorted(b), dtype=np.int64)).tolist())
            for i, a in enumerate(sets) for k, b in enumerate(sets)]
    found = spark.createDataFrame(rows, "i int, k int, a array<long>, b array<long>").select("i", "k", simhash._sketch_distance(F.col("a"), F.col("b")).alias("d"))
    for r in found.collect():
        d = len(sets[r.i] ^ sets[r.k])
        assert r.d <= d and (d > 1 or r.d == d)
        assert r.d > 200 or d < 400 or len(sets[r.i]) > 2 * len(sets[r.k]) or len(sets[r.k]) > 2 * len(sets[r.i])


def test_sharding(spark, documents, texts):
    rows = shards.shard_documents(documents, 24).collect()
    assert len(rows) == len(texts)
    for shard in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert all(r.grown_shard in (r.shard, 24) for r in rows) and any(r.grown_shard == 24 for r in rows)
    size = {i: len((t or "").encode()) + 8 for i, t in texts}
    crc = {i: zlib.crc32((t or "").encode()) for i, t in texts}
    assert all(r["size"] == size[r.doc_id] and r.text_crc32 == crc[r.doc_id] for r in rows)
    assert shards.shard_documents(documents.limit(0), 3).count() == 0


def test_weights_and_moves(spark):
    keys = spark.range(20_000).withColumnRenamed("id", "k")
    placed = shards.assign_shards(keys, "k", [1, 2, 5])
    share = {r.shard: r["count"] / 20_000 for r in placed.groupBy("shard").count().collect()}
    assert all(abs(share[i] - w / 8) < 0.02 for i, w in enumerate((1, 2, 5)))
    with_more = shards.assign_shards(placed, "k", [1, 2, 5, 2], "later")
    assert with_more.where("shard <> later AND later <> 3").count() == 0
    assert abs(with_more.where("later = 3").count() / 20_000 - 0.2) < 0.02
    with pytest.raises(ValueError):
        shards.rendezvous_shard(F.col("k"), [1, 0])
    copies = keys.select(F.lit(1).alias("a"), F.lit(0).alias("shard"))
    assert [tuple(r) for r in shards.number_slots(copies).agg(F.min("slot"), F.max("slot"), F.count_distinct("slot")).collect()] == [(0, 19_999, 20_000)]


def test_shards_equal_a_plain_draw(spark, documents):
    def shard_of(key, weights):
        seed = 42 if key is None else xxhash.xxh64_intdigest(key.to_bytes(8, "little", signed=True), 42)
        units = [((xxhash.xxh64_intdigest(i.to_bytes(4, "little"), seed) >> 11) + 0.5) / 2**53 for i in range(len(weights))]
        return max(range(len(weights)), key=lambda i: (-weights[i] / math.log(units[i]), -i))

    for r in shards.shard_documents(documents, 24).collect():
        assert (r.shard, r.grown_shard) == (shard_of(r.doc_id, [1.0] * 24), shard_of(r.doc_id, [1.0] * 25))
    keys = spark.range(-500, 1500).withColumnRenamed("id", "k")
    assert all(r.shard == shard_of(r.k, [1, 2, 5]) for r in shards.assign_shards(keys, "k", [1, 2, 5]).collect())
