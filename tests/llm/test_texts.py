import hashlib
import math
import random
import re
from collections import Counter

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tableqa.llm import chat, common, decontaminate, langid, licenses, pieces, pii

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def test_pieces_equal_the_library(spark, documents, texts):
    odd = ["▁a", " ", "   ", "a  b\n c\t", "</s><s>", "😀é中", "\0", "x▁▁y ", "<0x41>"]
    extra = spark.createDataFrame([(i, t) for i, t in enumerate(odd)], "doc_id long, text string")
    rows = pieces.encode(documents.select("doc_id", "text").union(extra), MODEL).collect()
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for r in rows:
        ids = library.encode(r.text or "", add_bos=True, add_eos=True)
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        assert (r.n_tokens, r.ids, r.decoded) == (len(ids), raw, library.decode(ids))
        assert (r.ids_sha256, r.decoded_sha256) == (hashlib.sha256(raw).hexdigest(), hashlib.sha256(r.decoded.encode()).hexdigest())
    assert len(rows) == len(texts) + len(odd)
    back = pieces.decode(pieces.encode(extra, MODEL).drop("decoded"), MODEL).collect()
    assert all(r.decoded == r.text.replace("▁", " ") for r in back)


def test_a_full_table_starts_anew():
    small = pieces.Pieces(pieces.read_model(MODEL), table_rows=4)
    large = pieces.Pieces(pieces.read_model(MODEL))
    text = " ".join(f"word{i}" for i in range(50))
    assert small.encode(text) == large.encode(text)


def test_the_tables_of_words_are_bounded_in_characters_too():
    model = pieces.read_model(MODEL)
    held, large = pieces.Pieces(model, table_rows=1000, table_chars=20_000), pieces.Pieces(model)
    for i in range(60):
        text = " ".join(f"word{i}x{k}" + "abc " * 3 + "z" * 500 + str(k) for k in range(10)) + " the same words in all \u2581 texts"
        assert held.encode(text) == large.encode(text)
        words = [*held.table, *held.older]
        assert len(words) <= 1000 and sum(map(len, words)) <= 20_000 and set(held.odd) <= {*words}
    assert " the" in held.table
    for i in range(0, 3_000_000, 100_000):
        held.encode(" ".join(map(str, range(i, i + 1500))))
        assert len(held.table) + len(held.older) <= 1000


def test_python_gets_whole_texts_in_batches_of_few_bytes(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    rows = spark.range(200).select("id", F.repeat(F.lit("some words "), 5000).alias("text")).coalesce(1)
    for use in (lambda: pieces.encode(rows, MODEL), lambda: langid.predict(rows, langid.LanguageModel([], *[None] * 4))):
        spark.conf.unset(name)
        use()
        sizes = [r.n for r in rows.mapInArrow(lambda bs: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in bs), "n long").collect()]
        assert sum(sizes) > 200 * 55_000 and max(sizes) <= common.BATCH_BYTES + 60_000
    spark.conf.set(name, "9000000b")
    pieces.encode(rows, MODEL)
    assert spark.conf.get(name) == "9000000b"  # a session's own limit stays
    spark.conf.unset(name)


def test_language_id(spark, documents, texts):
    model = langid.train(documents)
    rows = langid.predict(documents, model).collect()
    assert len(rows) == len(texts)
    assert all(r.lang_pred == "und" and r.score == 0 for r in rows if not any(map(str.isalpha, r.text or "")))
    known = [r for r in rows if r.doc_id is not None and r.doc_id < 9000]
    assert sum(r.lang_pred == r.lang for r in known) > 0.97 * len(known)
    assert all(0 <= r.score <= 1 for r in rows)
    assert {r.lang_pred for r in langid.predict(documents, langid.train(documents.limit(0))).collect()} == {"und"}
    one = langid.predict(documents, langid.train(documents.where("lang = 'de'"))).collect()
    assert {r.lang_pred for r in one} == {"de", "und"}


def test_language_id_of_documents_it_has_not_learned_from(documents):
    held_out = common.fold("doc_id", 5) == 0
    model = langid.train(documents.where(~held_out))
    rows = langid.predict(documents.where(held_out).where("doc_id < 9000"), model).collect()
    assert len(rows) > 30 and sum(r.lang_pred == r.lang for r in rows) > 0.97 * len(rows)


def test_codewords_tell_languages_apart():
    for n in (2, 3, 5, 12):
        code = langid.codewords(n)
        assert len({tuple(r) for r in code.tolist()}) == n and all(len(set(c)) == 2 for c in code.T.tolist())


RX = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for order, (kind, pattern) in enumerate(RX.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            double = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
            luhn = sum(d - 9 * (d > 9) for d in double) % 10 == 0
            if {"email": True, "ip": kind == "ip" and all(int(p) < 256 for p in m.group().split(".")),
                    "card": 12 <= len(digits) <= 19 and luhn, "phone": 9 <= len(digits) <= 15}[kind]:
                out.append((m.start(), order, m.end(), kind, m.group()))
    return sorted(out)


def test_personal_data_patterns(spark, documents, texts):
    odd = ["a@b.c@d.e_f@g.h", "1.2.3.4.5.6.7.8", "256.1.1.1 1.1.1.255", "4111 1111-1111 1111", "+1 (988) 555-2485", "😀 x@y.zz é", "+1+22 333 4444555", "9" * 300]
    docs = documents.select("doc_id", "text").union(spark.createDataFrame([(i, t) for i, t in enumerate(odd, 5000)], "doc_id long, text string"))
    rows = pii.find(docs).collect()
    expected = {**dict(texts), **dict(enumerate(odd, 5000))}
    assert len(rows) == len(texts) + len(odd)
    for r in rows:
        assert [tuple(s) for s in r.base] == plain_spans(expected[r.doc_id]), expected[r.doc_id]
        assert set(r.base) <= set(r.spans)


def test_terms_that_reveal(spark):
    rows = [(i, f"reach Zorblatt now at z@corp.com and the number {i} was {'x' * i} here") for i in range(1, 7)]
    rows += [(100 + i, f"the letter number {i} was long and here nobody is named {'y' * (i % 9)}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("more", F.lit(1))
    found = {r.doc_id: [s["value"] for s in r.spans if s["kind"] == "term"] for r in pii.find(docs).collect()}
    assert all("Zorblatt" in found[i] and "the" not in found[i] for i in range(1, 7))
    assert not any(found[i] for i in found if i >= 100)
    safe = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert "Zorblatt" not in safe[3] and "<EMAIL>" in safe[3] and "<NAME>" in safe[3]
    assert all(safe[i] == t for i, t in rows if i >= 100)
    assert pii.find(docs.limit(0)).count() == 0 and pii.sanitise(docs).columns == docs.columns


def test_terms_are_counted_and_marked_by_text(spark):
    far = " ".join(f"filler{i}" for i in range(12))
    rows = [(i, f"Dear Quibbly of unit {i} {far} write to q@far.org {far} regards Quibbly and 李明 again") for i in range(4)]
    rows += [(50, "meanwhile Quibbly was seen elsewhere without any address"), (51, "nobody at all")]
    # the same sentence in different texts, and copies of it
    rows += [(100 + i, f"contact Vexmoor by v@one.net today {'u' * (i + 1)}") for i in range(5)] + [(200 + i, "contact Vexmoor by v@one.net today u") for i in range(60)]
    rows += [(1000 + i, f"contact by today dear of unit write to regards and again {far} text number{i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: [s["value"] for s in r.spans if s["kind"] == "term"] for r in pii.find(docs).collect()}
    assert all(found[i].count("Quibbly") == 2 and found[i].count("李明") == 1 for i in range(4))
    assert found[50] == ["Quibbly"] and not found[51]
    assert all(found[i] == ["Vexmoor"] for i in (*range(100, 105), *range(200, 260)))
    assert not any(found[i] for i in found if i >= 1000)
    safe = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert not any("Quibbly" in t or "Vexmoor" in t for t in safe.values())


def test_terms_equal_plain_counts(spark):
    """Disclosing terms against counts over all pairs, and an ordinary word that stands with an address now and then."""
    random.seed(9)
    rows = [(i, " ".join(random.choices(["ab", "cd", "ef", "gh", "ij"], k=6)) + f" lone{i}") for i in range(900)]
    for e in range(6):
        rows += [(2000 + 10 * e + i, f"mail p{e}@x.org name{e} ordinary{i % 2} twin{e if i < 2 else 99} c{e}{i}") for i in range(4)]
    rows += [(5000 + i, f"ordinary{i % 2} day c{i}") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    base = pii.common.cut(docs.select(F.col("doc_id").alias("key"), F.xxhash64("text").alias("mark"), pii.base_spans(F.col("text")).alias("spans")))
    got = {(r.entity, r.term) for r in pii.disclosures(docs, base, "text", 1.0, 2).collect()}
    words = {i: {w.lower() for w in t.split() if "@" not in w} for i, t in rows}
    holds = {i: {f"email:{w}" for w in t.split() if "@" in w} for i, t in rows}
    n_t, n_e, n_te = Counter(), Counter(), Counter()
    for i, _ in rows:
        n_t.update(words[i])
        n_e.update(holds[i])
        n_te.update((e, w) for e in holds[i] for w in words[i])
    several = sum(n >= 2 for n in n_t.values())
    expected = {
        (e, w) for (e, w), n in n_te.items()
        if n >= 2 and 2 * n >= n_t[w] and n * math.log2(len(rows) / n_e[e]) >= math.log2(several) + pii.MARGIN
    }
    assert got == expected and {(f"email:p{e}@x.org", f"name{e}") for e in range(6)} <= got
    assert not any(w.startswith("ordinary") for _, w in got)


def plain_places(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    out = []
    for label, phrase in licenses.BASE_PHRASES:
        p = phrase.split()
        out += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    return len(words), sorted(out)


def test_license_scan(spark, documents, texts):
    odd = ["cc by cc by MIT license, Apache LICENSE!", "mİt license Mıt license mit licenseK", "gnu general public\nlicense", "mit licenséx",
           "Permission is hereby granted, free of charge, to any person obtaining one copy of this software", "CC BY-NC 4.0"]
    docs = documents.select("doc_id", "text").union(spark.createDataFrame([(i, t) for i, t in enumerate(odd, 5000)], "doc_id long, text string"))
    rows = licenses.scan(docs, licenses.templates(spark)).collect()
    expected = {**dict(texts), **dict(enumerate(odd, 5000))}
    assert len(rows) == len(texts) + len(odd)
    for r in rows:
        n, places = plain_places(expected[r.doc_id])
        labels = ",".join(sorted({x for _, x in places}))
        assert (r.n_words, r.n_base, r.base_labels) == (n, len(places), labels), expected[r.doc_id]
        assert (r.first_word, r.last_word) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert set(filter(None, labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
    found = {r.doc_id: r.labels for r in rows}
    assert found[5004] == "mit" and found[5005] == "cc-by,cc-by-nc"


def test_leaks(spark, documents):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    planted = items.select((F.col("item_id") + 20_000).alias("doc_id"), F.concat(F.lit("Before it all. "), F.col("text"), F.lit(" and after")).alias("text"))
    words = F.split("text", " ")
    edited = items.where(F.size(words) >= 50).select(
        (F.col("item_id") + 30_000).alias("doc_id"), F.concat(F.lit("intro words "), F.array_join(F.concat(F.slice(words, 1, 20), F.array(F.lit("changed")), F.slice(words, 22, 500)), " ")).alias("text"),
    )
    found = decontaminate.leaks(planted.union(edited), items).collect()
    assert {(r.doc_id - 20_000) for r in found if r.doc_id < 30_000 and r.similarity == 1.0} == {r.item_id for r in items.collect()}
    assert {r.doc_id for r in found if r.doc_id >= 30_000} == {r.doc_id for r in edited.collect()}
    clean = documents.where("doc_id IS NULL OR doc_id >= 9000")
    assert decontaminate.leaks(clean, items).count() == 0
    assert decontaminate.leaks(planted.limit(0), items).count() == 0 and decontaminate.leaks(planted, items.limit(0)).count() == 0
    kept = decontaminate.clean(clean.select("doc_id", "text").union(planted), decontaminate.leaks(planted, items))
    assert sorted(r.doc_id or 0 for r in kept.collect()) == sorted(r.doc_id or 0 for r in clean.collect())
    short = spark.createDataFrame([(1, "two words"), (2, "")], "item_id long, text string")
    assert [(r.doc_id, r.item_id, r.start) for r in decontaminate.leaks(spark.createDataFrame([(5, "here Two, words"), (6, "two")], "doc_id long, text string"), short).collect()] == [(5, 1, 1)]


def test_leaks_of_shortened_items(spark):
    words = [f"item{i}" for i in range(59)]
    items = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(f"few{i}" for i in range(15)))], "item_id long, text string")
    docs = spark.createDataFrame([
        (1, " ".join(words[:54])), (2, " ".join(words[1:58])), (3, " ".join(words[:40])), (4, " ".join(f"few{i}" for i in range(14))), (5, "few1 few2 few3 few4"),
    ], "doc_id long, text string")
    found = sorted((r.doc_id, r.item_id, r.start, r.n_words, round(r.similarity, 4)) for r in decontaminate.leaks(docs, items).collect())
    assert found == [(1, 1, 0, 54, round(50 / 55, 4)), (2, 1, 0, 57, round(53 / 55, 4)), (4, 2, 0, 14, round(10 / 11, 4))]


def test_leaks_of_items_without_id(spark):
    one, two = " ".join(f"one{i}" for i in range(20)), " ".join(f"two{i}" for i in range(20))
    items = spark.createDataFrame([(None, one), (None, two), (3, "other words of an item here")], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"before {one} after"), (2, f"{one} {two}"), (3, "nothing")], "doc_id long, text string")
    found = decontaminate.leaks(docs, items)
    assert sorted((r.doc_id, r.item_id, r.start) for r in found.collect()) == [(1, None, 1), (2, None, 0), (2, None, 20)]
    assert [r.doc_id for r in decontaminate.clean(docs, found).collect()] == [3]


def test_fingerprints_in_sql_equal_plain_ones(spark):
    df = spark.createDataFrame([([1, -5, 2**62, 77],), ([-1],), ([3, 3],)], "g array<long>")
    for r in df.select("g", decontaminate.simhash(F.col("g")).alias("fp")).collect():
        plain = sum(1 << b for b in range(64) if 2 * sum((x % 2**64) >> b & 1 for x in r.g) > len(r.g))
        assert r.fp % 2**64 == plain


@pytest.fixture(scope="module")
def talks(spark):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"turn {t}" if t < c else f"own {c} {t}") for c in range(6) for t in range(6)]
    rows += [(10, 0, "user", "turn 0"), (11, 0, "user", "turn 0"), (11, 1, "assistant", None), (12, 0, None, "<|turn|>x<\\|end|></s>[INST] [/INST]")]
    rows += [(13, t, "assistant", "<|end|>" * t) for t in range(3)] + [(None, 0, "user", "nameless"), (14, 0, "user", "turn 0"), (14, 0, "user", "turn 0")]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("size", F.lit(0)), rows


def test_chat_round_trip(talks):
    df, rows = talks
    nodes, conversations = chat.prefix_tree(df)
    got = {r.conv: r for r in chat.digests(chat.read_back(nodes, conversations)).collect()}
    for conv in {r[0] for r in rows}:
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=lambda r: r[1])]
        loss = "".join(t for role, t in turns if role == "assistant")
        r = got[conv]
        assert (r.n_turns, r.loss_chars, r.loss_sha256) == (len(turns), len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
    empty = chat.prefix_tree(df.limit(0))
    assert empty[0].count() == 0 and empty[1].count() == 0


def test_the_stream_is_depth_first_and_shares_turns(talks):
    nodes = sorted(chat.prefix_tree(talks[0])[0].collect(), key=lambda r: r.start)
    stream, path = "", []
    for n in nodes:
        assert n.start == len(stream) and n.size == len(n.segment)  # gapless, every node once
        stream += n.segment
        seen = "".join(stream[i["start"] : i["end"]] for i in n.attends)
        assert seen.endswith(n.segment) and len(seen) == n.position + n.size  # ancestors and itself, nothing else
        path = path[: n.depth]
        assert len(path) == n.depth and seen == "".join(path) + n.segment  # depth-first: ancestors are on the current path
        path.append(n.segment)
    assert sum("<|turn|>user<|text|>turn 0<|end|>" == n.segment and n.depth == 0 for n in nodes) == 1


def test_positions_and_attention_against_a_walk_of_the_tree(talks):
    """The digests of the query against a tree of nested dicts that is walked depth-first, a chain before its branches."""
    df, rows = talks

    def segment(role, text):
        marked = [re.sub(r"([<\[])(\\*)(\||/?s>|/?INST\])", r"\1\\\2\3", part or "") for part in (role, text)]
        return f"{chat.TURN}{marked[0]}{chat.TEXT}{marked[1]}{chat.END}"

    def rank(conv):
        return (conv is not None, conv or 0)

    root = {"children": {}}
    convs = {conv: [segment(r[2], r[3]) for r in sorted((r for r in rows if r[0] == conv), key=lambda r: r[1])] for conv in {r[0] for r in rows}}
    for conv in sorted(convs, key=rank):  # the smallest conversation that passes through a node owns it
        at = root
        for text in convs[conv]:
            at = at["children"].setdefault(text, {"children": {}, "owner": conv, "text": text})
    place, todo = 0, [(root, 0, [])]
    while todo:
        node, position, spans = todo.pop()
        if node is not root:
            node["position"] = position
            size, same = len(node["text"]), spans and spans[-1][2] == node["owner"]
            spans = [*spans[:-1], (spans[-1][0], place + size, node["owner"])] if same else [*spans, (place, place + size, node["owner"])]
            node["attends"] = ",".join(f"{a}-{b}" for a, b, _ in spans)
            node["n"], place, position = len(spans), place + size, position + size
        own = node.get("owner", "no conversation")
        after = sorted(node["children"].values(), key=lambda c: (c["owner"] != own, rank(c["owner"])))
        todo += [(child, position, spans) for child in reversed(after)]
    nodes, conversations = chat.prefix_tree(df)
    got = {r.conv: r for r in chat.digests(chat.read_back(nodes, conversations)).collect()}
    assert got.keys() == convs.keys()
    for conv, texts in convs.items():
        at, path = root, []
        for text in texts:
            at = at["children"][text]
            path.append(at)
        r = got[conv]
        masks = [hashlib.sha256(n["attends"].encode()).hexdigest() for n in path]
        assert r.positions_sha256 == hashlib.sha256(",".join(str(n["position"]) for n in path).encode()).hexdigest()
        assert r.attention_sha256 == hashlib.sha256("\n".join(masks).encode()).hexdigest()
        assert r.n_intervals == sum(n["n"] for n in path)
    assert place == max(e for n in nodes.collect() for e in [n.start + n.size])
