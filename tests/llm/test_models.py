import collections
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from oracle_check import connect, difference
from tableqa.llm import common, lm, queries, topk

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("scale", [1, 1000, 2**20])
def test_threshold_search_finds_all(scale):
    random.seed(1)
    draw = np.random.default_rng(3)
    block = draw.integers(-9, 9, (700, 6)) * scale
    block[::3] = block[0]
    asked = draw.integers(-9, 9, (20, 6)) * scale
    asked[0] = 0
    floors = np.full(20, -(2**62))
    of, position, score = topk.threshold_search(asked, block, 5, floors)
    for q in range(20):
        every = block @ asked[q]
        least = np.sort(every)[-5]
        assert set(position[of == q]) == set(np.flatnonzero(every >= least)) and np.array_equal(np.sort(score[of == q]), np.sort(every[every >= least]))


@pytest.mark.parametrize("block", [topk.BLOCK, 40])
def test_top_k_equals_brute_force(spark, block):
    draw = np.random.default_rng(5)
    vectors = [(i, [float(x) for x in draw.integers(-3, 4, 5)]) for i in range(300)]
    vectors += [(300 + i, [1.0, 2.0, 0.0, 0.0, 1.0]) for i in range(90)]
    bad = [(900, None), (920, [1.0, None, 0.0, 0.0, 0.0]), (940, [float("nan")] * 5), (960, [float("inf")] + [0.0] * 4), (None, [1.0] * 5)]
    df = spark.createDataFrame(vectors + bad, "vec_id long, e array<double>").withColumn("v", F.lit(1))
    rows = topk.integer_vectors(df, "vec_id", "e", 64)
    got = topk.top_k(rows.where("vec_id % 20 = 0"), rows, 7, block=block, group=6).collect()
    expected = []
    for q, v in vectors:
        if q % 20 == 0:
            best = sorted((-sum(64 * a * 64 * b for a, b in zip(v, w)), i) for i, w in vectors if i != q)[:7]
            expected += [(q, n, i, int(-s)) for n, (s, i) in enumerate(best, 1)]
    assert sorted(map(tuple, got)) == sorted(expected)
    assert topk.top_k(rows.limit(0), rows, 7).count() == 0 and topk.top_k(rows.where("vec_id = 0"), rows.where("vec_id < 3"), 7).count() == 2


def test_op5_equals_its_sql(spark):
    assert difference(queries.QUERIES["op5_exact_topk"](spark, SF_DIR), connect(SF_DIR), queries.ORACLES["op5_exact_topk"]) is None


def plain_model(rows, kept, held):
    """Scores by the formula of the module, from plain counts."""
    tokens = [(i, (t or "").encode().lower().split() + [None]) for i, t in rows]

    def counts(of):
        one, two = collections.Counter(), collections.Counter()
        for i, words in tokens:
            if of(i):
                before = "begin"
                one["begin"] += 1
                for w in words:
                    one[w] += 1
                    two[before, w] += 1
                    before = w
        return one, two, sum(n for w, n in one.items() if w != "begin")

    (u, b, n), (uk, bk, nk), (uh, bh, _) = counts(lambda i: kept(i) or held(i)), counts(kept), counts(held)
    v = len(u) - ("begin" in u)
    m = lm.fit_weight(np.array([uk[w] / max(1, nk) * (v + 1) for w in uh if w != "begin"]), np.array([float(c) for w, c in uh.items() if w != "begin"]))
    low = lambda one, total, w: m * one[w] / max(1, total) + (1 - m) / (v + 1)
    groups = collections.defaultdict(list)
    for (a, w), c in bh.items():
        if uk[a]:
            ratio = max(bk[a, w], 1e-9) / uk[a] / low(uk, nk, w)
            groups[int(math.log2(uk[a]))].append((math.exp(round(math.log(ratio) / lm.STEP) * lm.STEP), c))
    weights = {g: lm.fit_weight(*map(np.array, zip(*pairs))) for g, pairs in groups.items()}
    out = []
    for i, words in tokens:
        base = score = known = 0
        before = "begin"
        for w in words:
            lam = weights.get(int(math.log2(u[before])), 0) if u[before] else 0
            score += math.log10(lam * (b[before, w] / u[before] if u[before] else 0) + (1 - lam) * low(u, n, w))
            base += math.log10((u[w] + 0.5) / (n + 0.5 * (v + 1)))
            known += u[w] > 0
            before = w
        out.append((i, len(words), known, n, base, score))
    return out


@pytest.mark.parametrize("head, bucket", [(lm.HEAD, lm.BUCKET), (60, 4096), (0, 4096)])
def test_scores_equal_plain_ones(spark, documents, texts, monkeypatch, head, bucket):
    monkeypatch.setattr(lm, "BUCKET", bucket)
    fold = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5
    remainder = common.fold("doc_id", 5)
    rows = lm.score_texts(documents, kept=remainder > 1, held=remainder == 0, head=head).collect()
    key = lambda r: (-1 if r[0] is None else r[0], *r[1:])
    expected = sorted(map(key, plain_model(texts, lambda i: fold(i) > 1, lambda i: fold(i) == 0)))
    got = sorted(key((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)) for r in rows)
    assert [g[:4] for g in got] == [e[:4] for e in expected]
    assert np.allclose([g[4:] for g in got], [e[4:] for e in expected], rtol=1e-7)


def test_scores_without_training_texts(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    rows = {r.doc_id: r for r in lm.score_texts(docs, kept=F.lit(False), held=F.lit(False)).collect()}
    assert (rows[1].n_tokens, rows[1].n_known, rows[1].train_tokens, rows[2].n_tokens) == (3, 0, 0, 1)
    assert rows[1].base_score == 0 and abs(rows[1].score) < 1e-9
    assert lm.score_texts(docs.limit(0)).count() == 0


def test_pipeline(spark):
    """Whole run: nothing without letters, one of each set of equal texts, no benchmark item, no pattern, exact tokens."""
    docs = {r.doc_id: r.text for r in common.load(spark, SF_DIR, "documents").collect()}
    items = [r.text for r in common.load(spark, SF_DIR, "benchmark").collect()]
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert len({r.doc_id for r in rows}) == len(rows) > 0.7 * len(docs)
    assert len({docs[r.doc_id] for r in rows}) == len(rows)
    assert not any(item in docs[r.doc_id] for r in rows for item in items)
    assert all("@" not in r.text or "@" in docs[r.doc_id] for r in rows) and any("<EMAIL>" in r.text for r in rows)
    assert all(r.n_chars == len(r.text) and r.decoded == r.text.replace("▁", " ") for r in rows)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "personal_data", "sentencepiece"]
    spare = common.load(spark, SF_DIR, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, spare, SF_DIR).count() == 0


def test_stages_keep_clean_documents_and_columns(spark, documents):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    rows = documents.select(*columns).where("doc_id IS NULL OR doc_id >= 9005")
    for name, stage in corpus_pipeline.STAGES[1:4]:
        assert stage(spark, rows, SF_DIR).columns == columns
    kept = corpus_pipeline.near_dedup(spark, rows, SF_DIR).collect()
    assert sorted(r.doc_id or 0 for r in kept) == [0, 9005, 9006, 9007]


CLASHING = ["score", "ambiguous", "lang_pred", "_guess", "key", "mark", "_key", "_mark", "_n", "class", "copies", "of", "of_mark", "spans", "_of", "_of_mark",
            "_spans", "_leak_key", "_leak_mark", "leak_key", "leak_mark", "id", "unit", "item", "grams", "words", "body", "term", "other_column_5", "a.b"]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:4])
def test_stages_keep_columns_of_any_name(spark, documents, name, stage):
    rows = documents.select("doc_id", "text", "lang", "source", "n_chars").where("doc_id < 60 OR doc_id > 9000")
    for c in CLASHING:
        rows = rows.withColumn(c, F.lit(f"own {c}"))
    kept = stage(spark, rows, SF_DIR)
    assert kept.columns == rows.columns
    assert kept.select(*[F.col(f"`{c}`") for c in CLASHING]).distinct().collect() == [tuple(f"own {c}" for c in CLASHING)]


def test_shorter_vectors_count_as_if_zeros_followed(spark):
    rows = [(0, [1.0, 2.0, 3.0]), (1, [1.0]), (2, []), (3, [1.0, 0.0, 0.0]), (4, [0.0, -1.0]), (5, None)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    vectors = topk.integer_vectors(table, "vec_id", "embedding")
    padded = {i: [64 * x for x in v] + [0] * (3 - len(v)) for i, v in rows if v is not None}
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.top_k(vectors, vectors, k=3).collect()}
    for q in padded:
        order = sorted((-sum(a * b for a, b in zip(padded[q], padded[c])), c) for c in padded if c != q)[:3]
        assert [got[q, i + 1] for i in range(3)] == [(c, -s) for s, c in order]


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n != "pipeline" and not n.startswith(("op5", "op6", "op1_"))])
def test_queries_cover_the_whole_table(spark, name):
    rows = queries.QUERIES[name](spark, SF_DIR)
    if name.startswith("op3"):
        found = {(r.doc_id, r.item_id) for r in rows.collect()}
        texts = {r.doc_id: r.text for r in common.load(spark, SF_DIR, "documents").collect()}
        items = {r.item_id: r.text for r in common.load(spark, SF_DIR, "benchmark").collect()}
        assert {(d, i) for d, t in texts.items() for i, x in items.items() if x in t} <= found
    elif name.startswith("op2"):
        assert rows.count() == common.load(spark, SF_DIR, "conversations").select("conv_id").distinct().count() + 1
    elif name.startswith("op12"):
        assert rows.count() == common.load(spark, SF_DIR, "conversations").select("conv_id").distinct().count()
    elif name.startswith("op13"):
        assert rows.select("doc_id").distinct().count() == common.load(spark, SF_DIR, "documents").count()
    else:
        assert rows.count() == common.load(spark, SF_DIR, "documents").count()
