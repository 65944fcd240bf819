"""Language-model scoring by deleted interpolation of word bigrams, unigrams and a uniform floor.

    p(w | v) = l(v) * c(v, w) / c(v) + (1 - l(v)) * low(w),    low(w) = m * c(w) / N + (1 - m) / (V + 1)

c are counts over all training texts. The weight l depends on the frequency of the context v alone (one weight for each
power of two); l and m are learned by expectation-maximisation: a fold of the training texts is held out, the
probabilities come from the counts of the other training texts, and the weights maximise the likelihood of the held-out
counts. For EM, held-out counts are summed by context class and ratio of the two probabilities (in steps of one percent).

Words are 64-bit hashes. The `head` most frequent words (a fixed number, 2^20) are broadcast with their counts. A bigram
of two such words is a number of 40 bits; batches of texts send these numbers with the places of their texts, sorted and
compressed, to buckets of a few million tokens, where equal ones are counted and scored together. Bigrams that alone would
fill a sixteenth of a bucket (at most 16 for each bucket) are counted first and scored where the text is read, so none
is a hot spot. Bigrams with a rarer word go through joins with the whole vocabulary.

Edges: null texts count as empty and consist of the end token; repeated rows (equal key and text) get equal scores and
do count in training; without training texts every token has probability one; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableqa.llm import common

HEAD = 1 << 20
BATCH = 1 << 20  # tokens of a batch of texts
BUCKET = 1 << 21  # tokens of a bucket
HOT_SHARE = 16  # a bigram with more than 1 / HOT_SHARE of a bucket's tokens is hot
CLASSES = 40  # of context frequencies, by power of two; the first is for contexts that training lacks
STEP = 0.01  # of the logarithm of a ratio
_END, _BEGIN = 1, HEAD  # hash of the end token, number of the begin context
_BITS = 21  # of a number of a head word or the begin context

ROWS = "key long, kept boolean, held boolean, k1 long, k2 long, n long"


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of the words and the end token. bytes.lower and bytes.split treat ASCII only, as asked for."""
    digest = xxhash.xxh3_64_intdigest
    found = [digest(w) for w in (text or "").encode("utf-8", "replace").lower().split()]
    found.append(_END)
    return np.array(found, dtype=np.uint64)


class Head:
    """Counts of the most frequent words, by sorted hash, and the totals."""

    def __init__(self, hashes: np.ndarray, train: np.ndarray, kept: np.ndarray, totals: dict):
        order = np.argsort(hashes)
        self.hashes, self.train, self.kept = hashes[order], train[order], kept[order]
        self.totals = totals

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Number of a head word, or the hash with its top bit set (a negative number) of another."""
        distinct, back = np.unique(hashes, return_inverse=True)
        at = np.minimum(np.searchsorted(self.hashes, distinct), max(0, len(self.hashes) - 1))
        rare = (distinct | np.uint64(1 << 63)).view(np.int64)
        known = self.hashes[at] == distinct if len(self.hashes) else np.zeros(len(distinct), dtype=bool)
        return np.where(known, at, rare)[back]


def context_class(count: np.ndarray) -> np.ndarray:
    return np.where(count > 0, 1 + np.floor(np.log2(np.maximum(count, 1))), 0).astype(np.int64)


def batches(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray]]:
    """Rows, hashes of all tokens and row of each token, about BATCH tokens at a time; long texts are batches alone."""
    rows, parts, size = [], [], 0

    def packed():
        lengths = [len(p) for p in parts]
        return pd.DataFrame(rows), np.concatenate(parts), np.repeat(np.arange(len(rows)), lengths)

    for frame in frames:
        for row in frame.itertuples(index=False):
            hashes = word_hashes(row.text)
            rows.append((row.key, row.doc_id, row.kept, row.held, row.named))
            parts.append(hashes)
            size += len(hashes)
            if size >= BATCH:
                yield packed()
                rows, parts, size = [], [], 0
    if rows:
        yield packed()


def contexts(numbers: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Number of the word before each token; the begin context at the first of a text."""
    before = np.empty_like(numbers)
    before[1:] = numbers[:-1]
    before[np.flatnonzero(np.diff(of, prepend=-1))] = _BEGIN
    return before


def mixed(codes: np.ndarray) -> np.ndarray:
    return (codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)


def squeeze(*columns: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(
        c.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes() for c in columns
    ))


def unsqueeze(data: bytes, columns: int) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    return [c.reshape(8, -1).T.copy().view("<i8").ravel() for c in np.split(raw, columns)]


def vocabulary(texts: DataFrame) -> DataFrame:
    """word (hash), train, kept: counts of the training texts, and of those that are not held out."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, hashes, of in batches(frames):
            kept = rows[2].to_numpy()[of]
            distinct, back = np.unique(hashes, return_inverse=True)
            yield pd.DataFrame({
                "word": (distinct | np.uint64(1 << 63)).view(np.int64), "plain": distinct.view(np.int64),
                "train": np.bincount(back), "kept": np.bincount(back, weights=kept).astype(np.int64),
            })

    return texts.where("kept OR held").mapInPandas(count, "word long, plain long, train long, kept long").groupBy("word", "plain").agg(
        F.sum("train").alias("train"), F.sum("kept").alias("kept")
    )


def fit_weight(ratio: np.ndarray, counts: np.ndarray, rounds: int = 60) -> float:
    """Weight of the first of two distributions whose ratio is given, by EM on held-out counts."""
    weight, total = 0.5, counts.sum()
    if total <= 0:
        return 0.0
    for _ in range(rounds):
        weight = float((counts * (weight * ratio / (weight * ratio + 1 - weight))).sum() / total)
        weight = min(max(weight, 1e-6), 1 - 1e-6)
    return weight


def interpolated(p2: np.ndarray, low: np.ndarray, weights: np.ndarray, classes: np.ndarray) -> np.ndarray:
    w = weights[classes]
    return np.log10(w * p2 + (1 - w) * low)


def score_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", kept: Column | None = None,
                held: Column | None = None, head: int = HEAD) -> DataFrame:
    """key, n_tokens, n_known, train_tokens, base_score, score for every row of `docs`.

    kept, held: which rows are for counts, and which of the training rows are held out for the weights (both are
    training rows; the final counts cover both). By default a fifth is held out and all others are kept.
    """
    spark = docs.sparkSession
    kept = kept if kept is not None else common.fold(f"`{key}`", 5) != 0
    held = held if held is not None else ~kept
    texts = docs.select(
        F.xxhash64(F.col(f"`{key}`"), F.col(f"`{text}`")).alias("key"), kept.alias("kept"), held.alias("held"), F.col(f"`{text}`").alias("text"),
        F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(0).cast("long")).alias("doc_id"), F.col(f"`{key}`").isNotNull().alias("named"),
    )
    path = common.fresh_path(spark, "vocabulary")
    vocabulary(texts).write.parquet(path)
    words = spark.read.parquet(path)
    sums = words.agg(F.sum("train"), F.sum("kept"), F.count(F.lit(1))).first()
    totals = {"N": sums[0] or 0, "kept": sums[1] or 0, "V": sums[2] or 0}
    begins = texts.agg(F.count_if(F.expr("kept OR held")), F.count_if("kept")).first()
    # the unigram level: exact held-out counts by kept count
    levels = words.groupBy("kept").agg(F.sum(F.col("train") - F.col("kept")).alias("n")).where("n > 0")
    levels = _columns(levels, "kept", "n")  # as many rows as different counts
    low_ratio = levels["kept"] / max(1, totals["kept"]) * (totals["V"] + 1)
    totals["m"] = fit_weight(low_ratio, levels["n"].astype(float))
    totals["begin"], totals["begin_kept"] = begins
    top = _columns(_frequent(words, head), "plain", "train", "kept")
    known = spark.sparkContext.broadcast(Head(
        top["plain"].view(np.uint64), top["train"], top["kept"], totals,
    ))
    buckets = max(1, -(-totals["N"] // BUCKET))

    rare = _rare_rows(texts, known, words)
    classes, hot = _head_statistics(texts, known, buckets)
    stats = rare.where("c1k > 0 AND n_held > 0").select(
        (F.floor(F.log2("c1k")) + 1).cast("int").alias("class"),
        F.round(F.ln(F.greatest(F.col("ck"), F.lit(1e-9)) / F.col("c1k") / F.col("low_kept")) / STEP).cast("int").alias("bin"), "n_held",
    ).groupBy("class", "bin").agg(F.sum("n_held").alias("n")).toPandas()
    stats = pd.concat([stats, classes]).groupby(["class", "bin"], as_index=False)["n"].sum()
    weights = np.zeros(CLASSES + 24)
    for number, of in stats.groupby("class"):
        weights[int(number)] = fit_weight(np.exp(of["bin"].to_numpy() * STEP), of["n"].to_numpy(dtype=float))

    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.when(F.col("c1") > 0, F.floor(F.log2("c1")) + 1).otherwise(0).cast("int"))
    p2 = F.when(F.col("c1") > 0, F.col("c") / F.col("c1")).otherwise(F.lit(0.0))
    rare_scores = rare.select(
        "key", (F.col("n") * F.log10(weight * p2 + (1 - weight) * F.col("low"))).alias("score"),
        F.when(F.col("k2") < 0, F.col("n") * F.log10((F.col("c2") + 0.5) / F.lit(totals["N"] + 0.5 * (totals["V"] + 1)))).otherwise(F.lit(0.0)).alias("base"),
        F.when((F.col("k2") < 0) & (F.col("c2") > 0), F.col("n")).otherwise(F.lit(0).cast("long")).alias("known"),
    ).groupBy("key").agg(F.sum("score").alias("score"), F.sum("base").alias("base"), F.sum("known").alias("known"))
    scored = _head_scores(texts, known, buckets, weights, hot)
    parts = scored.unionByName(rare_scores.select(
        "key", F.lit(None).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("copies"), F.lit(0).cast("long").alias("n_tokens"),
        F.col("known").cast("long").alias("known"), "base", "score",
    ))
    summed = parts.groupBy("key").agg(
        F.max("doc_id").alias("doc_id"), F.sum("copies").alias("copies"), F.sum("n_tokens").alias("n_tokens"),
        F.sum("known").alias("known"), F.sum("base").alias("base"), F.sum("score").alias("score"),
    )
    whole = lambda c: (F.col(c) / F.col("copies")).cast("long")  # noqa: E731  copies of a row have been added up
    return summed.select(
        F.col("doc_id").alias(key), whole("n_tokens").alias("n_tokens"), whole("known").alias("n_known"),
        F.lit(totals["N"]).cast("long").alias("train_tokens"), (F.col("base") / F.col("copies")).alias("base_score"),
        (F.col("score") / F.col("copies")).alias("score"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"),
    ).drop("copy")


def _columns(df: DataFrame, *names: str) -> dict[str, np.ndarray]:
    """Whole columns of a table of bounded size, through Arrow."""
    table = df.select(*names).toArrow()
    return {n: table[n].to_numpy() for n in names}


def _frequent(words: DataFrame, head: int) -> DataFrame:
    """Words whose count is reached by no more than `head` words: all above a count, none at random."""
    counts = _columns(words.groupBy("train").agg(F.count(F.lit(1)).alias("n")), "train", "n")
    order = np.argsort(-counts["train"])
    upto = np.searchsorted(np.cumsum(counts["n"][order]), head, side="right")
    least = counts["train"][order][upto - 1] if upto else None
    return words.where(F.lit(False) if least is None else F.col("train") >= int(least))


def _rare_rows(texts: DataFrame, known, words: DataFrame) -> DataFrame:
    """Bigrams with a word outside the head, with all counts: key, k2, n, n_held, c1, c1k, c2, c, ck, low, low_kept."""

    def emit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, hashes, of in batches(frames):
            k2 = known.value.numbers(hashes)
            k1 = contexts(k2, of)
            at = np.flatnonzero((k1 < 0) | (k2 < 0))
            frame = pd.DataFrame({"of": of[at], "k1": k1[at], "k2": k2[at]})
            frame = frame.groupby(["of", "k1", "k2"], as_index=False, sort=False).size()
            yield pd.DataFrame({
                "key": rows[0].to_numpy()[frame["of"]], "kept": rows[2].to_numpy(bool)[frame["of"]],
                "held": rows[3].to_numpy(bool)[frame["of"]], "k1": frame["k1"], "k2": frame["k2"], "n": frame["size"],
            })

    rows = texts.mapInPandas(emit, ROWS)
    totals = known.value.totals
    path = common.fresh_path(texts.sparkSession, "rare")
    counts = lambda n, train, part: words.select(
        F.col("word").alias(n), F.col("train").alias(train), F.col("kept").alias(part)
    )

    @F.pandas_udf("train long, kept long")
    def of_head(number: pd.Series) -> pd.DataFrame:
        head, at = known.value, number.fillna(-1).to_numpy(np.int64)
        inside, size = (at >= 0) & (at < len(head.hashes)), max(1, len(head.hashes))
        train, kept = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        train[inside], kept[inside] = head.train[at[inside] % size], head.kept[at[inside] % size]
        train[at == _BEGIN], kept[at == _BEGIN] = head.totals["begin"], head.totals["begin_kept"]
        return pd.DataFrame({"train": train, "kept": kept})

    pairs = rows.groupBy("k1", "k2").agg(
        F.sum(F.when(F.col("kept") | F.col("held"), F.col("n")).otherwise(0)).alias("c"),
        F.sum(F.when(F.col("kept"), F.col("n")).otherwise(0)).alias("ck"),
    )
    # a word has at most one row in the vocabulary; most pairs are single, so counts are joined to pairs, then to rows
    pairs = (
        pairs.join(counts("k1", "t1", "s1"), "k1", "left").join(counts("k2", "t2", "s2"), "k2", "left")
        .withColumn("h1", of_head("k1")).withColumn("h2", of_head("k2"))
    )
    count = lambda joined, own: F.coalesce(F.col(joined), F.col(own))
    n, kept, v, m = totals["N"], totals["kept"], totals["V"], totals["m"]
    low = lambda c, all_: F.lit(m) * c / F.lit(float(max(1, all_))) + F.lit((1 - m) / (v + 1))
    pairs = pairs.select(
        "k1", "k2", "c", "ck", count("t1", "h1.train").alias("c1"), count("s1", "h1.kept").alias("c1k"), count("t2", "h2.train").alias("c2"),
        low(count("t2", "h2.train"), n).alias("low"), low(count("s2", "h2.kept"), kept).alias("low_kept"),
    )
    rows.join(pairs, ["k1", "k2"]).select(
        "key", "k2", "n", F.when(F.col("held"), F.col("n")).otherwise(0).alias("n_held"), "c1", "c1k", "c2", "c", "ck", "low", "low_kept",
    ).write.parquet(path)
    return texts.sparkSession.read.parquet(path)


def _packets(codes: np.ndarray, buckets: int) -> Iterator[tuple[int, slice, np.ndarray]]:
    """Bucket, its slice, and the order that sorts codes by bucket and value."""
    to = (mixed(codes) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((codes, to))
    edges = np.searchsorted(to[order], np.arange(buckets + 1))
    for bucket in range(buckets):
        if edges[bucket + 1] > edges[bucket]:
            yield bucket, slice(edges[bucket], edges[bucket + 1]), order


def _head_statistics(texts: DataFrame, known, buckets: int) -> tuple[pd.DataFrame, dict[int, int]]:
    """Held-out counts by context class and ratio, and hot bigrams with their training counts."""

    def emit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, hashes, of in batches(frames):
            k2 = known.value.numbers(hashes)
            k1 = contexts(k2, of)
            at = np.flatnonzero((k1 >= 0) & (k2 >= 0))
            codes, back = np.unique(k1[at] << _BITS | k2[at], return_inverse=True)
            kept = np.bincount(back, weights=rows[2].to_numpy(bool)[of[at]], minlength=len(codes))
            held = np.bincount(back, weights=rows[3].to_numpy(bool)[of[at]], minlength=len(codes))
            out = []
            for bucket, part, order in _packets(codes, buckets):
                o = order[part]
                out.append((bucket, squeeze(np.diff(codes[o], prepend=0), kept[o], held[o])))
            yield pd.DataFrame(out, columns=["bucket", "data"])

    least = BUCKET // HOT_SHARE

    def count(frame: pd.DataFrame) -> pd.DataFrame:
        head = known.value
        t, size = head.totals, max(1, len(head.hashes))
        parts = [unsqueeze(d, 3) for d in frame["data"]]
        codes, back = np.unique(np.concatenate([np.cumsum(p[0]) for p in parts]), return_inverse=True)
        kept = np.bincount(back, weights=np.concatenate([p[1] for p in parts]))
        held = np.bincount(back, weights=np.concatenate([p[2] for p in parts]))
        k1, k2 = codes >> _BITS, codes & ((1 << _BITS) - 1)
        c1 = np.where(k1 == _BEGIN, t["begin_kept"], head.kept[k1 % size])
        low = t["m"] * head.kept[k2 % size] / max(1, t["kept"]) + (1 - t["m"]) / (t["V"] + 1)
        use = (held > 0) & (c1 > 0)
        ratio = np.maximum(kept[use], 1e-9) / c1[use] / low[use]
        bins = pd.DataFrame({"class": context_class(c1[use]), "bin": np.round(np.log(ratio) / STEP).astype(np.int64), "n": held[use].astype(np.int64)})
        bins = bins.groupby(["class", "bin"], as_index=False)["n"].sum()
        hot = kept + held > least
        return pd.concat([bins, pd.DataFrame({"class": -1, "bin": codes[hot], "n": (kept + held)[hot].astype(np.int64)})]).astype("int64")

    made = texts.where("kept OR held").mapInPandas(emit, "bucket int, data binary").groupBy("bucket").applyInPandas(count, "class long, bin long, n long")
    table = made.groupBy("class", "bin").agg(F.sum("n").alias("n")).toPandas()
    hot = table[table["class"] < 0]
    return table[table["class"] >= 0], dict(zip(hot["bin"].tolist(), hot["n"].tolist()))


def _head_scores(texts: DataFrame, known, buckets: int, weights: np.ndarray, hot: dict[int, int]) -> DataFrame:
    """Sums over bigrams of head words, a row for each text: key, doc_id, copies, n_tokens, known, base, score."""
    hot_codes = np.array(sorted(hot), dtype=np.int64)
    hot_counts = np.array([hot[c] for c in sorted(hot)], dtype=np.int64)

    def probabilities(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        head = known.value
        t, size = head.totals, max(1, len(head.hashes))
        k1, k2 = codes >> _BITS, codes & ((1 << _BITS) - 1)
        c1 = np.where(k1 == _BEGIN, t["begin"], head.train[k1 % size])
        low = t["m"] * head.train[k2 % size] / max(1, t["N"]) + (1 - t["m"]) / (t["V"] + 1)
        return interpolated(counts / np.maximum(c1, 1), low, weights, context_class(c1))

    def emit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        head = known.value
        scale = head.totals["N"] + 0.5 * (head.totals["V"] + 1)
        base = np.append(np.log10((head.train + 0.5) / scale), 0.0)
        for rows, hashes, of in batches(frames):
            k2 = head.numbers(hashes)
            k1 = contexts(k2, of)
            n, keys = len(rows), rows[0].to_numpy(np.int64)
            in_head = k2 >= 0
            base_sum = np.bincount(of[in_head], weights=base[k2[in_head]], minlength=n)
            known_sum = np.bincount(of[in_head], minlength=n)
            at = np.flatnonzero((k1 >= 0) & in_head)
            codes, docs = k1[at] << _BITS | k2[at], of[at]
            trained = (rows[2].to_numpy(bool) | rows[3].to_numpy(bool))[docs]
            score = np.zeros(n)
            if len(hot_codes):
                place = np.minimum(np.searchsorted(hot_codes, codes), len(hot_codes) - 1)
                is_hot = hot_codes[place] == codes
                score += np.bincount(docs[is_hot], weights=probabilities(codes[is_hot], hot_counts[place[is_hot]]), minlength=n)
                codes, docs, trained = codes[~is_hot], docs[~is_hot], trained[~is_hot]
            packets = []
            for bucket, part, order in _packets(codes, buckets):
                o = order[part]
                names, local = np.unique(docs[o], return_inverse=True)
                packets.append((bucket, squeeze(np.diff(codes[o], prepend=0), local * 2 + trained[o]), squeeze(keys[names])))
            # whole numbers have no nulls here, as pandas would turn them into floats
            yield pd.DataFrame(packets, columns=["bucket", "data", "names"]).reindex(columns=columns).fillna({c: 0 for c in columns[3:]})
            yield pd.DataFrame({
                "bucket": keys % buckets, "data": None, "names": None, "key": keys, "doc_id": rows[1].to_numpy(), "named": rows[4].to_numpy(),
                "n_tokens": np.bincount(of, minlength=n), "known": known_sum, "base": base_sum, "score": score,
            })[columns]

    def score_bucket(frame: pd.DataFrame) -> pd.DataFrame:
        own = frame[frame["data"].isna()].drop(columns=["bucket", "data", "names"]).assign(copies=1)
        frame = frame[frame["data"].notna()]
        if not len(frame):
            return grouped(own)
        parts = [unsqueeze(d, 2) for d in frame["data"]]
        names = [unsqueeze(d, 1)[0] for d in frame["names"]]
        keys, spots = np.unique(np.concatenate(names), return_inverse=True)
        first = np.cumsum([0] + [len(x) for x in names])
        docs = np.concatenate([spots[first[i] : first[i + 1]][p[1] >> 1] for i, p in enumerate(parts)])
        trained = np.concatenate([p[1] & 1 for p in parts])
        codes, back = np.unique(np.concatenate([np.cumsum(p[0]) for p in parts]), return_inverse=True)
        value = probabilities(codes, np.bincount(back, weights=trained))
        inner = pd.DataFrame({
            "key": keys, "doc_id": 0, "named": False, "n_tokens": 0, "known": 0, "base": 0.0, "copies": 0,
            "score": np.bincount(docs, weights=value[back], minlength=len(keys)),
        })
        return grouped(pd.concat([own, inner]))

    def grouped(rows: pd.DataFrame) -> pd.DataFrame:
        """Sums of a bucket, packed for each group of texts: as many packets as groups, however many texts."""
        out = [
            (group, squeeze(*[part[c].to_numpy(np.int64) for c in order_out[:6]], *[part[c].to_numpy(np.float64).view("<i8") for c in order_out[6:]]))
            for group, part in rows.groupby(rows["key"] % buckets)
        ]
        return pd.DataFrame(out, columns=["group", "data"])

    def add_up(frame: pd.DataFrame) -> pd.DataFrame:
        """Sums of the texts of a group over all buckets."""
        parts = [unsqueeze(d, len(order_out)) for d in frame["data"]]
        whole = {c: np.concatenate([p[i] for p in parts]) for i, c in enumerate(order_out)}
        keys, spots = np.unique(whole["key"], return_inverse=True)
        out = {"key": keys, "doc_id": np.zeros(len(keys), np.int64), "named": np.zeros(len(keys), bool)}
        named = whole["named"] > 0
        out["doc_id"][spots[named]], out["named"][spots[named]] = whole["doc_id"][named], True
        for c in order_out[3:6]:
            out[c] = np.bincount(spots, weights=whole[c], minlength=len(keys)).astype(np.int64)
        for c in order_out[6:]:
            out[c] = np.bincount(spots, weights=whole[c].view(np.float64), minlength=len(keys))
        return pd.DataFrame(out)[order_out]

    columns = ["bucket", "data", "names", "key", "doc_id", "named", "n_tokens", "known", "base", "score"]
    order_out = ["key", "doc_id", "named", "copies", "n_tokens", "known", "base", "score"]
    sums = "key long, doc_id long, named boolean, {}n_tokens long, known long, base double, score double"
    sent = texts.mapInPandas(emit, "bucket long, data binary, names binary, " + sums.format(""))
    # packets and the sums of the texts themselves go through one shuffle
    packed = sent.groupBy("bucket").applyInPandas(score_bucket, "group long, data binary")
    scored = packed.groupBy("group").applyInPandas(add_up, sums.format("copies long, "))
    return scored.withColumn("doc_id", F.when(F.col("named"), F.col("doc_id"))).drop("named")
