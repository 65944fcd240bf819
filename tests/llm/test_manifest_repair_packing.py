import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from oracle_check import connect, difference
from tableqa.llm import merkle, packing, queries, repair
from tableqa.llm.queries import tokenizer_path

WORDS = tokenizer_path("word_bpe_49k.json")


# --- Merkle manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, text):
    parts = []
    for value in (row.doc_id, row.source, row.lang, row.n_chars, text):
        value = None if value is None else str(value)
        parts.append("-" if value is None else f"{len(value.encode())}:{value}")
    return sha(*parts)


def plain_tree(nodes):
    """Root and, for each node, the runs on its way: (place in the run, run)."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, place in enumerate(at):
            run = nodes[place // 16 * 16 : place // 16 * 16 + 16]
            ways[k].append((place % 16, run))
            at[k] = place // 16
        nodes = [sha(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
    return nodes[0], ways


def plain_manifest(rows):
    groups = defaultdict(list)
    for row in rows:
        lowered = None if row.text is None else "".join(c.lower() if c.isascii() else c for c in row.text)
        leaf = plain_leaf(row, row.text)
        tampered = row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 5 == 0
        groups[row.source].append(((row.doc_id is not None, row.doc_id or 0, leaf), row.doc_id, leaf, plain_leaf(row, lowered) if tampered else leaf))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([leaf for _, _, leaf, _ in sorted(groups[s], key=lambda x: x[0])]) for s in order}
    root, tops = plain_tree([trees[s][0] for s in order])
    out = []
    for s, top in zip(order, tops):
        for (_, doc_id, leaf, other), way in zip(sorted(groups[s], key=lambda x: x[0]), trees[s][1]):
            proof, folded = "", other
            for place, run in way + top:
                proof += "".join(run[:place] + run[place + 1 :])
                folded = sha(*run[:place], folded, *run[place + 1 :])
            out.append((doc_id, leaf, trees[s][0], root, sha(proof), folded, folded == root))
    return out


def none_first(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


def test_manifest_equals_plain_trees(spark, documents):
    got = [tuple(r) for r in merkle.manifest(documents).collect()]
    assert none_first(got) == none_first(plain_manifest(documents.collect()))
    assert 0 < sum(r[-1] for r in got) < len(got)


def test_manifest_of_large_and_many_groups(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(i, f"Text {i % 7}", None, "hot", i) for i in range(9000)] + [(20_000 + i, "One", "en", f"s{i}", 3) for i in range(5000)]
    docs = spark.createDataFrame(rows, schema).repartition(5)
    got = [tuple(r) for r in merkle.manifest(docs).collect()]
    assert none_first(got) == none_first(plain_manifest(docs.collect()))


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None)], [(5, "A", "en", "x", 1)] * 40])
def test_manifest_of_few_rows(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("seq", "i", "node", "other", "grp", "g", "part", "_at", "_tie", "leaf", "c1"):
        docs = docs.withColumn(name, F.lit(name))
    got = merkle.manifest(docs)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert none_first([tuple(r) for r in got.collect()]) == (none_first(plain_manifest(docs.collect())) if rows else [])


# --- conversation repair


def plain_best(symbols):
    """Cost and audit by whole texts instead of tables."""
    best = {0: (0, ""), 1: (10, "II"), 2: (5, "I"), 3: (0, "")}
    for symbol in reversed(symbols):
        best = {q: min((c + best[to][0], e + best[to][1]) for e, c, to in repair.edits(q, symbol)) for q in repair.STATES}
        for _ in range(3):
            best = {q: min(best[q], (best[repair.NEXT[q]][0] + 5, "I" + best[repair.NEXT[q]][1])) for q in best}
    return best[0]


@pytest.mark.parametrize("block", [1, 3, 4])
def test_blocks_equal_plain_costs(block):
    random.seed(block)
    table = repair.tables(block)
    for _ in range(600):
        symbols = [random.choice([0, 1, 2, 2, 2, 3, 4, 4, 4, 5, 6, 7, 8]) for _ in range(random.randrange(18))]
        found = np.array(symbols, dtype=np.int16)
        assert (int(table.costs(found, 0)[0]), table.trace(found, 0)[0]) == plain_best(symbols)


def plain_repair(rows):
    """rows: (role, text) of a conversation in order."""
    counts, seen, symbols, kinds = [0, 0, 0], set(), [], []
    for role, text in rows:
        kind, body = "sua".find(role[:1]) if role else -1, text.rstrip(repair.SPACE)
        kind = 3 if kind < 0 else kind
        fault = 0 if not body else 1 if (role, text) in seen else 2 if body[-1] not in ".!?" else None
        seen.add((role, text))
        if fault is not None:
            counts[fault] += 1
        symbols.append(8 if fault in (0, 1) else kind * 2 + (fault == 2))
        kinds.append(kind)
    illegal = sum((a, b) not in ((0, 1), (1, 2), (2, 1)) for a, b in zip(kinds, kinds[1:]))
    cost, audit = plain_best(symbols)
    out, at, wanted = [], iter(rows), "user"
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(at)
        if edit == "D":
            continue
        role = role if edit == "K" else wanted
        out.append(f"{role}:{text}")
        wanted = "assistant" if role[0] == "u" else "user"
    return (*counts, illegal, cost, audit, sha("\n".join(out)))


def odd_conversations(spark, n=60):
    random.seed(8)
    rows = [(3, t, random.choice(["user", "assistant"]), random.choice(["Hm.", "Well", "Yes!", f"Turn {t}?", ""])) for t in range(120)]
    rows += [(None, None if t % 3 else t, random.choice(["user", "system", None]), random.choice(["a.", "b.", None, "\t "])) for t in range(15)]
    for c in range(10, 10 + n):
        for t in range(random.randrange(1, 9)):
            rows.append((c, t * random.choice([1, 1, 2]), random.choice(["system", "user", "assistant", "tool", ""]), random.choice(["Hi.", "no", "É. ", " ", "x!\n"])))
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def signed_hash(text):
    value = xxhash.xxh64_intdigest(text.encode(), 42)
    return value - (1 << 64) if value >> 63 else value


@pytest.mark.parametrize("limit, segment", [(4096, 4096), (5, 7), (0, 1)])
def test_repair_equals_plain_search(spark, limit, segment):
    table = odd_conversations(spark)
    groups = defaultdict(list)
    for r in repair.damage(table).collect():
        groups[r.conv].append(((r.turn is not None, r.turn or 0, r.role.encode(), signed_hash(r.text)), r.turn, r.role, r.text))
    expected = []
    for conv in {r.conv_id for r in table.collect()}:
        own = sorted(groups.get(conv, []))
        turns = [t for _, t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        expected.append((conv, gaps, *plain_repair([(role, text) for _, _, role, text in own])))
    got = repair.repaired_digests(table.withColumn("pos", F.lit("x")).withColumn("conv", F.lit(1)), limit=limit, segment=segment)
    assert got.columns[:2] == ["conv_id", "gaps"]
    assert none_first([tuple(r) for r in got.collect()]) == none_first(expected)


def test_damage_and_empty_table(spark):
    table = odd_conversations(spark, 200)
    fates = defaultdict(list)
    for r in table.where("conv_id >= 10").collect():
        fates[zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % 20].append(r)
    damaged = repair.damage(table.where("conv_id >= 10"))
    assert damaged.count() == table.where("conv_id >= 10").count() - len(fates[0]) + len(fates[3])
    got = {(r.conv, r.turn) for r in damaged.collect()}
    assert not got & {(r.conv_id, r.turn) for r in fates[0]}
    empty = repair.repaired_digests(table.limit(0))
    assert empty.count() == 0 and empty.columns[-1] == "repaired_sha256"


# --- packing


def test_ids_equal_the_library():
    spec = open(WORDS, encoding="utf-8").read()
    words, library = packing.Words(spec, table_rows=300), Tokenizer.from_str(spec)
    random.seed(3)
    parts = ["a", "É", "é", "ß", "İ", "K", "1", "²", "٣", "'s", "'", "’", "don't", "I'LL", "&&&", "...", "<|endoftext|>", " ", " ", "\x1c", "\x85", "\n",
             "\t", "́", "漢", "가", "😀", "ﬁ", "Å", "word", "Hello,", "(y)", "‍", "\x00", "ΑΣ", "ς", "ǅ", " ", " ", "×", "÷"]
    texts = ["".join(random.choice(parts) for _ in range(random.randrange(25))) for _ in range(4000)] + [None, "", "x " * 50_000]
    for at in range(0, len(texts), 997):
        batch = texts[at : at + 997]
        ids, begins = words.encode(pa.array(batch))
        for k, text in enumerate(batch):
            assert ids[begins[k] : begins[k + 1]].tolist() == library.encode(text or "", add_special_tokens=False).ids + [1], text


@pytest.mark.parametrize("shard_tokens", [packing.SHARD_TOKENS, 20_000])
def test_every_id_lies_in_one_piece(spark, documents, texts, shard_tokens):
    rows = packing.pack(documents, WORDS, shard_tokens=shard_tokens).collect()
    library, by_doc, by_sequence = Tokenizer.from_file(WORDS), defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    expected = defaultdict(list)
    for key, text in texts:
        expected[key].append(library.encode(text or "", add_special_tokens=False).ids + [1])
    assert by_doc.keys() == expected.keys()
    for key, copies in expected.items():
        pieces, ids = sorted(by_doc[key], key=lambda r: r.start), copies[0]
        assert all(r.doc_tokens == len(ids) for r in pieces)
        cover = np.zeros(len(ids), dtype=int)
        for r in pieces:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], dtype="<u4").tobytes())
            cover[r.start : r.start + r.length] += 1
        assert (cover == len(copies)).all() and all(c == ids for c in copies)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048 and (at == 2048 or at & (at - 1) == 0)


def test_scores_are_bm25():
    rng = np.random.default_rng(1)
    rests = [rng.integers(0, 40, rng.integers(1, 60)).astype("<u2") for _ in range(30)]
    frequency = np.zeros(50, dtype=np.int64)
    for r in rests:
        frequency[np.unique(r)] += 1
    mean = sum(map(len, rests)) / len(rests)
    model = packing.Bm25(frequency, len(rests), mean)
    index = packing.Index(rests, model, query_terms=50)
    for seed in range(5):
        plain = []
        for r in rests:
            score = 0.0
            for term in set(rests[seed].tolist()):
                tf, n = int((r == term).sum()), int(frequency[term])
                idf = math.log(1 + (len(rests) - n + 0.5) / (n + 0.5))
                score += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(r) / mean))
            plain.append(score)
        assert np.allclose(index.scores(seed), plain)


def test_neighbours_fill_the_window_of_their_seed():
    topics = [list(range(t * 10, t * 10 + 10)) for t in range(4)]
    rests = [np.array(topics[k % 4] * 20, dtype="<u2") for k in range(40)]  # 200 tokens each, 2,000 a topic
    frequency = np.full(40, 10)
    windows = packing.fill_windows(rests, packing.Bm25(frequency, 40, 200.0))
    assert sorted(sum(n for _, _, n in w) for w in windows)[-3:] == [2048] * 3
    assert [len({d % 4 for d, _, _ in w}) for w in windows[:3]] == [2, 2, 2]  # a topic and the one that fills the last 48
    assert sum(n for w in windows for _, _, n in w) == 8000


def test_powers_of_two_and_plan():
    pieces = [(0, 5, 700), (1, 0, 3), (2, 0, 800)]
    made = packing.powers_of_two(pieces)
    assert [sum(n for _, _, n in w) for w in made] == [1024, 256, 128, 64, 16, 8, 4, 2, 1]
    assert sorted(x for w in made for d, a, n in w for x in [(d, a + i) for i in range(n)]) == sorted((d, a + i) for d, a, n in pieces for i in range(n))
    first, splits = packing.shard_plan({0: 60, 1: 60, 2: 950, 3: 10, 5: 5}, 5, 100)
    assert first.tolist() == [0, 1, 2, 12, 0, 12] and splits.tolist() == [1, 1, 10, 1, 1, 1]


def test_packing_of_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, row string, windows int, shard int, key int")
    assert packing.pack(empty, WORDS).collect() == []
    copies = spark.createDataFrame([(None, "same words here")] * 500 + [(1, None)] * 300, "doc_id long, text string")
    rows = packing.pack(copies, WORDS, shard_tokens=600).collect()
    assert sum(r.length for r in rows) == 500 * 4 + 300
    assert len({r.sequence_id >> 32 for r in rows}) > 10  # one text of many copies is split over shards


@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op12_conversation_repair"])
def test_queries_equal_their_sql(spark, name):
    sf_dir = "/root/testdata/sf0.001"
    assert difference(queries.QUERIES[name](spark, sf_dir), connect(sf_dir), queries.ORACLES[name]) is None
