"""Packing of documents into sequences by lexical retrieval.

A document is its tokens and an end id. As many full windows as it has are sequences of their own; the rest is packed: a
BM25 inverted index (terms are token ids, document frequencies are those of all rests) returns the unused neighbours of
a seed document, which fill its window in order of their score. Where nothing unused shares a term, the next unused
document does. The last one is cut where the window ends and what is left of it is the seed of the next window.

The index is sharded by content: a document goes to the shard of its heaviest BM25 term that another one has, too, so
copies and texts on one topic meet. Terms are packed into shards of about `shard_tokens` tokens by their sums; a term of
more is split by a hash of the row number, whatever holds it, so no shard grows with the table. Sums and frequencies have
a row for each term of the vocabulary, which bounds what the driver and the broadcasts get.

There is no padding: only the last window of a shard can be short, and it is cut into sequences of falling powers of two
(11 at most for a window of 2,048).

Token ids are those of the library. White space parts words for this tokenizer, so words are encoded apart and each task
keeps a table of the words it has met, bounded by `table_rows`; a word's letters and the punctuation behind it are looked
up apart. When the table is full it starts anew, which costs time but changes nothing.

Edges: null and empty texts are the end id alone; repeated rows are documents of their own, also with null ids; a text of
any length is cut into windows; ties of scores and weights go to the smaller row number or term; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from tableqa.llm import common

WINDOW, END = 2048, 1
SHARD_TOKENS, QUERY_TERMS = 1 << 19, 32
K1, B = 1.2, 0.75
ROW_WEIGHT = 32  # tokens that a row counts beside its own, so shards of very short texts stay small
TABLE_ROWS = 1 << 19
SLICE_BYTES, SLICE_ROWS = 16 << 20, 512
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
# letters, then ASCII punctuation but the apostrophe, which may begin a contraction
WORD = f"^(?P<core>[{LETTERS}]+)(?P<tail>[!-&(-/:-@\\[-`{{-~]*)$"
_PLAIN = re.compile(f"[{LETTERS}]+")
# the rules under which words can be encoded apart (fixed values of the tokenizer's file)
_RULES = [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"},
]
_SPLIT = {
    "type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True,
}


class Words:
    """Token ids of texts through a table of words: row number of a word, and the ids of all rows one after the other."""

    def __init__(self, spec: str, table_rows: int = TABLE_ROWS):
        parts = json.loads(spec)
        if (parts["normalizer"] or {}).get("normalizers") != _RULES or (parts["pre_tokenizer"] or {}).get("pretokenizers", [None])[0] != _SPLIT:
            raise ValueError("words of this tokenizer cannot be encoded apart")
        self.tokenizer, self.table_rows = Tokenizer.from_str(spec), table_rows
        self.model, self.bytes = self.tokenizer.model, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.clear()

    def clear(self) -> None:
        self.rows: dict[str, int] = {"": 0}
        self.ids, self.used = np.zeros(1 << 16, dtype=np.int32), 1
        self.ids[0] = END
        self.starts, self.lengths = [0, 0], [0, 1]  # row 1 is the end of a document

    def _word(self, word: str) -> list[int]:
        if not _PLAIN.fullmatch(word):
            return self.tokenizer.encode(word, add_special_tokens=False).ids
        if not word.isascii():
            word = self.bytes.pre_tokenize_str(word)[0][0]
        return [t.id for t in self.model.tokenize(word)]

    def lookup(self, words: list[str]) -> np.ndarray:
        rows = [self.rows.get(w, -1) for w in words]
        for k, row in enumerate(rows):
            if row < 0:
                found = self._word(words[k])
                while self.used + len(found) > len(self.ids):
                    self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
                self.ids[self.used : self.used + len(found)] = found
                rows[k] = self.rows[words[k]] = len(self.starts)
                self.starts.append(self.used)
                self.lengths.append(len(found))
                self.used += len(found)
        return np.array(rows, dtype=np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts with their ends, one after the other, and the place where each begins."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.string()), ""))
        offsets = split.offsets.to_numpy().astype(np.int64)
        coded = pc.list_flatten(split).dictionary_encode()
        distinct, index = coded.dictionary, coded.indices.to_numpy()
        parts = pc.extract_regex(distinct, WORD)
        known = parts.is_valid()
        core = pc.if_else(known, pc.utf8_lower(pc.struct_field(parts, "core")), distinct).dictionary_encode()
        tail = pc.if_else(known, pc.struct_field(parts, "tail"), "").dictionary_encode()
        if len(self.rows) + len(core.dictionary) + len(tail.dictionary) > self.table_rows:
            self.clear()
        pair = np.empty((len(distinct), 2), dtype=np.int64)
        for k, part in enumerate((core, tail)):
            pair[:, k] = self.lookup(part.dictionary.to_numpy(zero_copy_only=False).tolist())[part.indices.to_numpy()] if len(distinct) else 0
        starts, lengths = np.array(self.starts), np.array(self.lengths)
        items = np.insert(pair[index].ravel(), 2 * (offsets[1:] - offsets[0]), 1)
        sizes = lengths[items]
        ends = np.cumsum(sizes)
        places = np.repeat(starts[items] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
        last = 2 * (offsets[1:] - offsets[0]) + np.arange(len(texts))  # item of each text's end
        return self.ids[places], np.concatenate([[0], ends[last]]).astype(np.int64)


_WORDS: dict[str, Words] = {}


def opened(path: str, spec: str) -> Words:
    """One tokenizer and table for each Python worker."""
    if path not in _WORDS:
        _WORDS[path] = Words(spec)
    return _WORDS[path]


def slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Runs of texts of about `size` bytes, with the place of the first."""
    total = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)) // size
    cuts = [0, *(np.flatnonzero(np.diff(total)) + 1).tolist(), len(texts)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield a, texts.slice(a, b - a)


TOKENS = "key string, doc_tokens long, windows array<long>, rest binary"


def token_rows(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """key, doc_tokens, crc32 of each full window, and the ids of the rest as little-endian unsigned 16-bit integers."""
    with open(tokenizer_path, encoding="utf-8") as file:
        spec = docs.sparkSession.sparkContext.broadcast(file.read())

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = opened(tokenizer_path, spec.value)
        for batch in batches:
            for at, texts in slices(batch.column(1)):
                ids, begins = words.encode(texts)
                wide, narrow = memoryview(ids.astype("<u4").tobytes()), ids.astype("<u2").tobytes()
                windows, rests = [], []
                for a, b in zip(begins[:-1].tolist(), begins[1:].tolist()):
                    cut = b - (b - a) % window
                    windows.append([zlib.crc32(wide[4 * x : 4 * (x + window)]) for x in range(a, cut, window)])
                    rests.append(narrow[2 * cut : 2 * b])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, len(texts)), pa.array(np.diff(begins), pa.int64()),
                    pa.array(windows, pa.list_(pa.int64())), pa.array(rests, pa.binary()),
                ], names=["key", "doc_tokens", "windows", "rest"])

    return docs.select(F.col(f"`{key}`").cast("string").alias("key"), F.col(f"`{text}`").alias("text")).mapInArrow(tokens, TOKENS)


def ids_of(rest: bytes) -> np.ndarray:
    return np.frombuffer(rest, dtype="<u2")


def term_counts(rests: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows (document, term, how often) in order of both, and the documents' lengths."""
    lengths = np.array([len(r) for r in rests], dtype=np.int64)
    flat = np.concatenate(rests) if rests else np.zeros(0, dtype="<u2")
    pairs = np.sort(np.repeat(np.arange(len(rests)) << 16, lengths) | flat)
    first = np.flatnonzero(np.diff(pairs, prepend=-1))
    return pairs[first] >> 16, pairs[first] & 0xFFFF, np.diff(np.append(first, len(pairs))), lengths


class Bm25:
    """Weights of terms from the document frequencies and the mean length of the whole collection."""

    def __init__(self, frequency: np.ndarray, documents: int, mean: float):
        self.frequency, self.mean = frequency, max(mean, 1.0)
        self.idf = np.log1p((documents - frequency + 0.5) / (frequency + 0.5)).astype(np.float64)

    def weight(self, terms: np.ndarray, tf: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return self.idf[terms] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / self.mean))

    def heaviest(self, rests: list[np.ndarray]) -> np.ndarray:
        """The heaviest term of each document that another one has, too; -1 without one."""
        docs, terms, tf, lengths = term_counts(rests)
        shared = self.frequency[terms] > 1
        docs, terms, tf = docs[shared], terms[shared], tf[shared]
        found = np.full(len(rests), -1, dtype=np.int64)
        if len(docs):
            weights = self.weight(terms, tf, lengths[docs])
            starts = np.flatnonzero(np.diff(docs, prepend=-1))
            most = np.maximum.reduceat(weights, starts)
            best = np.flatnonzero(weights == np.repeat(most, np.diff(np.append(starts, len(docs)))))[::-1]
            found[docs[best]] = terms[best]  # in falling order, so the smallest of equal terms stays
        return found


class Index:
    """Inverted index of one shard."""

    def __init__(self, rests: list[np.ndarray], model: Bm25, query_terms: int = QUERY_TERMS):
        self.rests, self.model, self.query_terms = rests, model, query_terms
        docs, terms, tf, lengths = term_counts(rests)
        order = np.argsort(terms, kind="stable")
        terms, self.members = terms[order], docs[order]
        self.weights = model.weight(terms, tf[order], lengths[self.members])
        self.bounds = np.searchsorted(terms, np.arange(len(model.idf) + 1))

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of all documents of the shard against the heaviest terms of the seed."""
        ids = self.rests[seed]
        terms, tf = np.unique(ids, return_counts=True)
        asked = terms[np.argsort(-self.model.weight(terms, tf, len(ids)), kind="stable")[: self.query_terms]]
        parts = [slice(self.bounds[t], self.bounds[t + 1]) for t in asked.astype(np.int64)]
        if not parts:
            return np.zeros(len(self.rests))
        members = np.concatenate([self.members[p] for p in parts])
        return np.bincount(members, np.concatenate([self.weights[p] for p in parts]), minlength=len(self.rests))


def fill_windows(rests: list[np.ndarray], model: Bm25, window: int = WINDOW, query_terms: int = QUERY_TERMS) -> list[list[tuple[int, int, int]]]:
    """Windows of pieces (document, start, length). All are full but the last, which is cut into powers of two."""
    index, used = Index(rests, model, query_terms), np.array([len(r) == 0 for r in rests], dtype=bool)
    made: list[list[tuple[int, int, int]]] = []
    piece, room, done, seed, unused = [], window, 0, None, 0

    def place(doc: int, start: int) -> bool:
        """Puts as much of a document as fits; what is left of it is the next seed."""
        nonlocal piece, room, done, seed
        used[doc] = True
        took = min(room, len(rests[doc]) - start)
        piece.append((doc, start, took))
        room -= took
        if room:
            return False
        made.append(piece)
        piece, room = [], window
        seed, done = (doc, start + took) if start + took < len(rests[doc]) else (None, 0)
        return True

    while True:
        while unused < len(rests) and used[unused]:
            unused += 1
        if seed is None:
            if unused == len(rests):
                break
            seed, done = unused, 0
        doc, start, seed = seed, done, None
        if place(doc, start):
            continue
        scores = np.where(used, 0.0, index.scores(doc))
        near = np.flatnonzero(scores > 0)
        full = False
        for other in near[np.argsort(-scores[near], kind="stable")].tolist():
            full = place(other, 0)
            if full:
                break
        while not full:  # nothing unused shares a term
            while unused < len(rests) and used[unused]:
                unused += 1
            if unused == len(rests):
                return made + powers_of_two(piece)
            full = place(unused, 0)
    return made + powers_of_two(piece)


def powers_of_two(pieces: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """Pieces of a short window, cut into sequences whose lengths are falling powers of two."""
    total, out = sum(n for _, _, n in pieces), []
    waiting = pieces[::-1]
    while total:
        room = 1 << (total.bit_length() - 1)
        total -= room
        out.append([])
        while room:
            doc, start, n = waiting.pop()
            took = min(room, n)
            out[-1].append((doc, start, took))
            if took < n:
                waiting.append((doc, start + took, n - took))
            room -= took
    return out


def shard_plan(sizes: dict[int, int], vocabulary: int, shard_tokens: int) -> tuple[np.ndarray, np.ndarray]:
    """First shard of every term and number of shards that its documents are split over; the last entry is for no term."""
    first, splits, shard, filled = np.zeros(vocabulary + 1, dtype=np.int64), np.ones(vocabulary + 1, dtype=np.int64), 0, 0
    for term, size in sorted(sizes.items()):
        if filled and filled + size > shard_tokens:
            shard, filled = shard + 1, 0
        first[term], splits[term] = shard, -(-size // shard_tokens)
        if size > shard_tokens:
            shard += int(splits[term])
        else:
            filled, splits[term] = filled + size, 1
    return first, splits


PIECES = "key string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", window: int = WINDOW,
         shard_tokens: int = SHARD_TOKENS, query_terms: int = QUERY_TERMS) -> DataFrame:
    """One row for each piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    path = common.fresh_path(spark, "packing_tokens")
    made = token_rows(docs, tokenizer_path, key, text, window).withColumn("row", F.monotonically_increasing_id())
    made.write.option("compression", "zstd").parquet(path)
    tokens = spark.read.parquet(path)
    vocabulary = Tokenizer.from_file(tokenizer_path).get_vocab_size()
    if vocabulary > 1 << 16:
        raise ValueError("ids of this tokenizer need more than 16 bits")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(vocabulary, dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                counts += np.bincount(term_counts([ids_of(r) for r in batch.column(0).slice(at, SLICE_ROWS).to_pylist()])[1], minlength=vocabulary)
        terms = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.int64()), pa.array(counts[terms], pa.int64())], names=["term", "n"])

    # a row for each term of the vocabulary at most
    found = tokens.select("rest").mapInArrow(frequencies, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    frequency = np.zeros(vocabulary, dtype=np.int64)
    frequency[found["term"].to_numpy(dtype=np.int64)] = found["n"].to_numpy(dtype=np.int64)
    filled, total = tokens.where("octet_length(rest) > 0").agg(F.count(F.lit(1)), F.sum(F.octet_length("rest") / 2)).first()
    model = spark.sparkContext.broadcast(Bm25(frequency, filled, (total or 0) / max(filled, 1)))

    def heaviest(rest: pd.Series) -> np.ndarray:
        parts = [model.value.heaviest([ids_of(r) for r in rest[at : at + SLICE_ROWS]]) for at in range(0, len(rest), SLICE_ROWS)]
        return np.concatenate([np.zeros(0, dtype=np.int64), *parts])

    @F.pandas_udf("long")
    def route(rest: pd.Series) -> pd.Series:
        terms = heaviest(rest)
        return pd.Series(np.where(terms < 0, vocabulary, terms))

    weight = F.octet_length("rest") / 2 + 2 * F.size("windows") + ROW_WEIGHT
    sums = tokens.select(route("rest").alias("term"), weight.cast("long").alias("w")).groupBy("term").agg(F.sum("w").alias("w"))
    plan = spark.sparkContext.broadcast(shard_plan({r.term: r.w for r in sums.collect()}, vocabulary, shard_tokens))

    @F.pandas_udf("long")
    def shard(rest: pd.Series, drawn: pd.Series) -> pd.Series:
        first, splits = plan.value
        terms = heaviest(rest)  # -1 is the last entry
        return pd.Series(first[terms] + drawn.to_numpy() % splits[terms])

    def packed(shard_key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("row")
        rests = [ids_of(r) for r in part["rest"]]
        keys, sizes, base = part["key"].tolist(), part["doc_tokens"].tolist(), int(shard_key[0]) << 32
        out, sequence = [], base
        for doc, crcs in enumerate(part["windows"]):
            for k, crc in enumerate(crcs):
                out.append((keys[doc], k * window, window, int(crc), sizes[doc], sequence, 0))
                sequence += 1
        for pieces in fill_windows(rests, model.value, window, query_terms):
            offset = 0
            for doc, start, n in pieces:
                crc = zlib.crc32(rests[doc][start : start + n].astype("<u4").tobytes())
                out.append((keys[doc], sizes[doc] - len(rests[doc]) + start, n, crc, sizes[doc], sequence, offset))
                offset += n
            sequence += 1
        return pd.DataFrame(out, columns=["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    drawn = F.xxhash64("row").bitwiseAND(F.lit((1 << 62) - 1))
    pieces = tokens.withColumn("shard", shard("rest", drawn)).groupBy("shard").applyInPandas(packed, PIECES)
    return pieces.withColumn("key", F.col("key").cast(docs.schema[key].dataType)).withColumnRenamed("key", key)
