"""Language identification by error-correcting output codes over byte n-grams.

Every language has a codeword; for each of its bits a binary n-gram classifier (log odds of hashed byte 1- to 3-grams,
smoothed, languages of a side weighing alike) tells one set of languages from the other. A document's margins are
decoded by loss: the codeword with the smallest sum of exp(-code * margin), each bit weighted by how often its
classifier was right for that language in training. If the runner-up is almost as near, the document is flagged.

Training reads a bounded sample of labelled rows (`sample_rows`, picked by a hash of the key), counts n-grams in Spark
and keeps a table of 2^16 rows and a column for each bit. Predictions read whole texts, in pieces of bounded size.

Edges: null texts and texts without a letter are `und` with score 0 and not ambiguous; without labelled rows every
document is `und`; with one language all texts with letters get it with score 1. Extra columns are ignored.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableqa.llm import common

UNKNOWN = "und"
FEATURES = 1 << 16
PIECE = 1 << 20  # bytes of a text looked at in one step
_NOT_LETTERS = re.compile(r"[\W\d_]+")


@dataclass
class LanguageModel:
    languages: list[str]
    code: np.ndarray  # languages x bits, of -1 and 1
    weights: np.ndarray  # FEATURES x bits
    scale: np.ndarray  # bits: mean size of a margin in training
    trust: np.ndarray  # languages x bits: share of right bits in training, rows sum to 1


def codewords(languages: int) -> np.ndarray:
    """All splits of the languages into two sets for up to five of them, else 10 * log2(n) seeded random splits."""
    if languages < 2:
        return np.ones((languages, 0), dtype=np.int8)
    if languages <= 5:
        rest = list(itertools.product((1, -1), repeat=languages - 1))[1:]
        return np.array([(1, *r) for r in rest], dtype=np.int8).T
    draw, columns = np.random.default_rng(7), {}
    while len(columns) < int(np.ceil(10 * np.log2(languages))) or len({*map(tuple, np.array([*columns]).T)}) < languages:
        column = draw.choice((-1, 1), languages)
        column *= column[0]
        if len({*column.tolist()}) == 2:
            columns[tuple(column.tolist())] = True
    return np.array([*columns], dtype=np.int8).T


def letters_of(text: str | None) -> str:
    """Lower-cased text with everything but letters as single spaces; empty if there is no letter."""
    if not text:
        return ""
    cleaned = _NOT_LETTERS.sub(" ", text.lower())
    return f" {cleaned.strip()} " if any(map(str.isalpha, cleaned)) else ""


def features(cleaned: str) -> Iterator[np.ndarray]:
    """Hashed byte 1-, 2- and 3-grams, in pieces of bounded size that overlap by two bytes."""
    raw = np.frombuffer(cleaned.encode("utf-8", "replace"), dtype=np.uint8)
    for start in range(0, len(raw), PIECE):
        b = raw[max(0, start - 2) : start + PIECE].astype(np.uint32)
        new = min(start, 2)  # bytes of the piece that an earlier one has counted
        grams = np.concatenate([
            b[new:] * np.uint32(0x9E3779B1),
            (b[max(0, new - 1) : -1] | b[max(0, new - 1) + 1 :] << 8 | np.uint32(1 << 24)) * np.uint32(0x85EBCA6B),
            (b[:-2] | b[1:-1] << 8 | b[2:] << 16 | np.uint32(2 << 24)) * np.uint32(0xC2B2AE35),
        ])
        yield (grams >> np.uint32(16)).astype(np.int64)


def margins(text: str, weights: np.ndarray) -> np.ndarray | None:
    cleaned = letters_of(text)
    if not cleaned:
        return None
    total, n = np.zeros(weights.shape[1]), 0
    for grams in features(cleaned):
        total += weights[grams].sum(axis=0, dtype=np.float64)
        n += len(grams)
    return total / n


def labelled_sample(docs: DataFrame, key: str, text: str, lang: str, rows: int) -> DataFrame:
    """Rows with a text and a language, about `rows` of them at most, picked by a hash of the key and the text."""
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    share = min(1.0, rows / max(1, known.count()))
    draw = F.shiftrightunsigned(F.xxhash64(F.col(key), F.length(text)), 11) / F.lit(float(2**53))
    return known.where(draw < share).select(F.col(text).alias("text"), F.col(lang).alias("lang"))


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample_rows: int = 20_000,
          smoothing: float = 0.5) -> LanguageModel:
    """Learns from the rows of `docs` that have a language; `sample_rows` bounds how many are read for it."""
    common.light_batches(docs.sparkSession)
    sample = labelled_sample(docs, key, text, lang, sample_rows)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[str, np.ndarray] = {}
        for frame in frames:
            for body, name in zip(frame["text"], frame["lang"]):
                of = counts.setdefault(name, np.zeros(FEATURES, dtype=np.int64))
                for grams in features(letters_of(body)):
                    of += np.bincount(grams, minlength=FEATURES)
        for name, of in counts.items():
            seen = np.flatnonzero(of)
            yield pd.DataFrame({"lang": name, "gram": seen, "n": of[seen]})

    grams = sample.mapInPandas(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    table = grams.toPandas()  # at most 2^16 rows for each language
    languages = sorted(table["lang"].unique())
    code = codewords(len(languages))
    share = np.full((len(languages), FEATURES), smoothing)
    for i, name in enumerate(languages):
        of = table[table["lang"] == name]
        share[i, of["gram"].to_numpy()] += of["n"].to_numpy()
    share /= share.sum(axis=1, keepdims=True)
    weights = np.zeros((FEATURES, code.shape[1]), dtype=np.float32)
    for bit in range(code.shape[1]):
        one, other = share[code[:, bit] > 0].mean(axis=0), share[code[:, bit] < 0].mean(axis=0)
        weights[:, bit] = np.log(one / other)
    model = LanguageModel(languages, code, weights, np.ones(code.shape[1]), np.ones(code.shape))
    return calibrate(model, sample) if code.shape[1] else model


def calibrate(model: LanguageModel, sample: DataFrame) -> LanguageModel:
    """Size of the margins and share of right bits by language, from the sample."""
    spark = sample.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def judge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        of = {name: i for i, name in enumerate(known.languages)}
        bits = known.code.shape[1]
        size, right, n = np.zeros(bits), np.zeros(known.code.shape), np.zeros(len(known.languages))
        for frame in frames:
            for body, name in zip(frame["text"], frame["lang"]):
                m = margins(body, known.weights)
                if m is not None and name in of:
                    size += np.abs(m)
                    right[of[name]] += m * known.code[of[name]] > 0
                    n[of[name]] += 1
        for i in range(len(n)):
            yield pd.DataFrame({"language": i, "bit": range(bits), "docs": n[i], "good": right[i], "size": size / len(n)})

    found = (
        sample.mapInPandas(judge, "language int, bit int, docs double, good double, size double")
        .groupBy("language", "bit").agg(F.sum("docs").alias("docs"), F.sum("good").alias("good"), F.sum("size").alias("size"))
        .toPandas()
    )
    trust, scale, docs = np.ones(model.code.shape), np.zeros(model.code.shape[1]), 0.0
    for row in found.itertuples():
        trust[row.language, row.bit] = (row.good + 1) / (row.docs + 2)
        scale[row.bit] += row.size
        docs += row.docs / model.code.shape[1]
    trust = np.maximum(trust - 0.5, 0.01)
    shared.unpersist()
    return LanguageModel(
        model.languages, model.code, model.weights, np.maximum(scale / max(docs, 1), 1e-6),
        trust / trust.sum(axis=1, keepdims=True),
    )


def decode(margin: np.ndarray | None, model: LanguageModel, gap: float) -> tuple[str, float, bool]:
    """Language, score and whether the runner-up's loss is within `gap` of the winner's, as a share of both."""
    if margin is None or not model.languages:
        return UNKNOWN, 0.0, False
    if len(model.languages) == 1:
        return model.languages[0], 1.0, False
    loss = (model.trust * np.exp(-model.code * np.clip(margin / model.scale, -20, 20))).sum(axis=1)
    order = np.argsort(loss, kind="stable")
    first, second = loss[order[0]], loss[order[1]]
    near = 1 / np.maximum(loss, 1e-300)
    return model.languages[order[0]], float(near[order[0]] / near.sum()), bool((second - first) / (second + first) < gap)


def predict(docs: DataFrame, model: LanguageModel, text: str = "text", gap: float = 0.1) -> DataFrame:
    """`docs` with `lang_pred`, `score` (0 to 1) and `ambiguous`; only the text goes to Python."""
    common.light_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def guess(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for part in parts:
            rows = [decode(margins(t, known.weights), known, gap) for t in part]
            yield pd.DataFrame(rows, columns=["lang_pred", "score", "ambiguous"])

    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score", "ambiguous", "_guess")]
    return docs.select(*kept, guess(F.col(f"`{text}`")).alias("_guess")).select(*kept, "_guess.*")
