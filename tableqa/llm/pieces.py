"""SentencePiece encoding and decoding through a table of distinct marked words.

A text is a begin marker and words that start with their white-space markers. No piece of the model has a marker after
another character (checked when the model is opened), so merges never cross from one word into the next and words can be
segmented apart. Every task keeps a table of the distinct marked words it has met: a word is segmented and decoded once,
and the ids and texts of a document are joined from the table by position. The table is bounded in words (`table_rows`)
and in their characters (`table_chars`): of two tables of half that size the older one goes when the newer one is full,
and words that are met again move to the newer one. What goes is segmented again, which costs time but changes nothing;
one text's own words are held beyond that only if they alone are more. A table for the whole corpus would have to send
the position of every word through two shuffles, several times the size of the texts themselves.

Edges: null texts count as empty and give the begin and end ids alone; repeated rows give repeated rows; a literal
U+2581 equals a space for the model, so it decodes to a space, as the library does it.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from tableqa.llm import common

MARK = "▁"
TABLE_ROWS = 1 << 17  # words of both tables, and
TABLE_CHARS = 1 << 22  # their characters, so that a task's tables stay below some 40 MB
SLICE = 128  # texts whose results leave a task together
_WORDS = re.compile(r" +[^ ]*")
_MODELS: dict[str, "Pieces"] = {}


class Pieces:
    """The model of a task, with its table of words."""

    def __init__(self, model: bytes, table_rows: int = TABLE_ROWS, table_chars: int = TABLE_CHARS):
        spec = model_pb2.ModelProto()
        spec.ParseFromString(model)
        if any(MARK in p.piece.lstrip(MARK) for p in spec.pieces):
            raise ValueError("pieces of this model cross white-space markers")
        rule = spec.normalizer_spec
        if rule.precompiled_charsmap or rule.remove_extra_whitespaces or not rule.escape_whitespaces:
            raise ValueError("this model rewrites texts before it segments them")
        if any(p.type == model_pb2.ModelProto.SentencePiece.USER_DEFINED for p in spec.pieces):
            raise ValueError("this model has user-defined pieces")
        self.prefix = " " if rule.add_dummy_prefix else ""
        rule.add_dummy_prefix = False  # words bring their own markers
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=spec.SerializeToString())
        self.table_rows, self.table_chars = table_rows, table_chars
        self.table: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.odd: dict[str, str] = {}  # of words that are not decoded to themselves
        self.chars = 0  # of the words in `table`
        self.begin, self.end = (i.to_bytes(4, "little") for i in (self.processor.bos_id(), self.processor.eos_id()))

    def words(self, text: str) -> list[str]:
        """Marked words whose concatenation is the text with its begin marker."""
        marked = self.prefix + text.replace(MARK, " ")
        head = len(marked.split(" ", 1)[0])  # of models that add no begin marker
        return ([marked[:head]] if head else []) + _WORDS.findall(marked, head)

    def learn(self, words: set[str]) -> None:
        """Brings words into the table. When it holds half of what is allowed, it becomes the older table and a new one begins."""
        new = [w for w in words if w not in self.table]
        chars = sum(map(len, new))
        if self.table and (len(self.table) + len(new) > self.table_rows // 2 or self.chars + chars > self.table_chars // 2):
            self.older, self.table = self.table, {}
            self.odd = {w: t for w, t in self.odd.items() if w in self.older}
            new, chars = list(words), sum(map(len, words))
        self.chars = chars + (self.chars if self.table else 0)
        self.table.update((w, self.older[w]) for w in new if w in self.older)
        unknown = [w for w in new if w not in self.older]
        ids = self.processor.encode(unknown, num_threads=1)
        for word, own, back in zip(unknown, ids, self.processor.decode(ids, num_threads=1)):
            self.table[word] = struct.pack(f"<{len(own)}I", *own)
            if back != word:
                self.odd[word] = back

    def encode(self, text: str) -> tuple[bytes, str]:
        """Ids with begin and end as little-endian unsigned 32-bit integers, and their decoded text."""
        if not text:
            return self.begin + self.end, ""
        words = self.words(text)
        ids, back = [self.begin], []
        for at in range(0, len(words), self.table_rows // 2):
            part = words[at : at + self.table_rows // 2]
            if not all(map(self.table.__contains__, part)):
                self.learn(set(part))
            ids += map(self.table.__getitem__, part)
            back += [self.odd.get(w, w) for w in part] if self.odd else part
        ids.append(self.end)
        decoded = "".join(back)
        return b"".join(ids), decoded.removeprefix(self.prefix) if self.prefix else decoded


def opened(path: str, model: bytes) -> Pieces:
    """One model and table for each Python worker."""
    if path not in _MODELS:
        _MODELS[path] = Pieces(model)
    return _MODELS[path]


def read_model(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode(docs: DataFrame, model_path: str, text: str = "text", keep_ids: bool = True) -> DataFrame:
    """`docs` with n_tokens, ids (binary, little-endian unsigned 32-bit; left out unless kept), decoded text and digests.

    The model file (half a megabyte here) is read where the job starts and broadcast to the tasks.
    """
    common.light_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(read_model(model_path))

    made = [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]
    made += [("ids", T.BinaryType()), ("decoded", T.StringType())] if keep_ids else []
    names = {n for n, _ in made}
    rows = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in names or c == text])
    place, kept = rows.columns.index(text), [i for i, c in enumerate(rows.columns) if c not in names]
    schema = T.StructType([rows.schema[i] for i in kept] + [T.StructField(n, k) for n, k in made])

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = opened(model_path, model.value)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):  # results leave in small parts, so a batch is never held twice
                part = batch.slice(at, SLICE)
                found = [pieces.encode(body or "") for body in part.column(place).to_pylist()]
                columns = [
                    pa.array([len(ids) // 4 for ids, _ in found], pa.int64()),
                    pa.array([hashlib.sha256(ids).hexdigest() for ids, _ in found], pa.string()),
                    pa.array([hashlib.sha256(back.encode()).hexdigest() for _, back in found], pa.string()),
                ]
                if keep_ids:
                    columns += [pa.array([ids for ids, _ in found], pa.binary()), pa.array([back for _, back in found], pa.string())]
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in kept], *columns], names=schema.names)

    return rows.mapInArrow(segment, schema)


def decode(rows: DataFrame, model_path: str, ids: str = "ids", output: str = "decoded") -> DataFrame:
    """Texts of id sequences (binary, as `encode` writes them); null ids give null."""
    model = rows.sparkSession.sparkContext.broadcast(read_model(model_path))

    @F.arrow_udf("string")
    def back(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        processor = sentencepiece.SentencePieceProcessor(model_proto=model.value)
        for part in parts:
            yield pa.array([
                None if i is None else processor.decode(memoryview(i).cast("I").tolist()) for i in part.to_pylist()
            ], pa.string())

    return rows.withColumn(output, back(F.col(f"`{ids}`")))
