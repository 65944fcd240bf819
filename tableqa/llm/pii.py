r"""Personal data: patterns with checks, and terms that reveal them by corpus co-occurrence; DataFrame operations only.

Patterns find e-mail addresses, IP addresses, card numbers (Luhn) and phone numbers in whole texts. What they find are
the protected entities. Every word that stands in a text with an entity is a candidate. Over the whole corpus,

    left(entity | term) = log2(n_t / n_te)

is what remains unknown of an entity, in bits, to a reader who sees the term: n_t and n_te are the distinct texts with the
term and with both. A term is a disclosure where at most `bits` remain (1: the entity is in half of the term's texts or
more, whatever the size of the corpus), where it stands in `support` distinct texts with the entity or more, and where
chance does not explain that: n_te texts at log2(N / n_e) bits each must tell more than it takes to name one term of all,
by MARGIN bits. Disclosing terms are marked wherever they stand, also in texts without the entity. Found data are
generalised to their kind, capitalised terms to <NAME>, other terms are removed.

Edges: null and empty texts hold nothing; a repeated row repeats its result; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableqa.llm import common

# The patterns asked for, written so that they cannot recurse or start again inside a run: a match begins after the last
# one or at the begin of a run of its first class, where the leftmost match of the plain pattern begins, too.
_LOCAL, _HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_HOST}++(?:\.{_HOST}++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = tuple(PATTERNS)
BITS, SUPPORT, MARGIN = 1.0, 2, 7.0
_SPANS = "array<struct<start:int,end:int,value:string>>"
_WORD = r"[\p{L}][\p{L}\p{N}'’-]*"


def matches(text: Column, pattern: str, keep: Callable[[Column], Column] | None = None) -> Column:
    """Leftmost non-overlapping matches, those that `keep` takes: array of (start, end, value), code points from 0, end exclusive."""
    steps = F.zip_with(
        F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda gap, hit: F.struct(F.length(gap).alias("gap"), hit.alias("hit")),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("found"))

    def step(done: Column, x: Column) -> Column:
        begin = done["at"] + x["gap"]
        end = begin + F.length(x["hit"])
        span = F.struct(begin.alias("start"), end.alias("end"), x["hit"].alias("value"))
        left_out = x["hit"].isNull() if keep is None else x["hit"].isNull() | ~keep(x["hit"])
        return F.struct(
            F.coalesce(end, begin).alias("at"),
            F.when(left_out, done["found"]).otherwise(F.concat(done["found"], F.array(span))).alias("found"),
        )

    return F.aggregate(steps, start, step)["found"]


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def value(i: Column) -> Column:
        digit = F.substring(digits, i, F.lit(1)).cast("int")
        doubled = digit * 2
        return F.when((F.length(digits) - i) % 2 == 1, F.when(doubled > 9, doubled - 9).otherwise(doubled)).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda a, i: a + value(i)) % 10 == 0


def _passes(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?:\.|$)){4}$")
    if kind == "card":
        return F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """Array of (start, order, end, kind, value) of all kinds, by start, then kind."""
    text = F.coalesce(text, F.lit(""))
    possible = {
        "email": F.contains(text, F.lit("@")), "ip": text.rlike(r"[0-9]\.[0-9]"),
        "card": text.rlike(r"[0-9](?:[\x20-]?[0-9]){11}"), "phone": text.rlike(r"\+[0-9]"),
    }
    none = F.array().cast("array<struct<start:int,order:int,end:int,kind:string,value:string>>")

    def kept(order: int, kind: str) -> Column:
        good = F.filter(matches(text, PATTERNS[kind]), lambda m: _passes(kind, m["value"]))
        return F.transform(good, lambda m: F.struct(
            m["start"].alias("start"), F.lit(order).alias("order"), m["end"].alias("end"), F.lit(kind).alias("kind"), m["value"].alias("value"),
        ))

    kinds = [F.when(possible[kind], kept(order, kind)).otherwise(none) for order, kind in enumerate(KINDS)]
    return F.array_sort(F.concat(*kinds))


def terms(text: Column) -> Column:
    """Distinct lower-cased words outside e-mail addresses; no other pattern holds a letter."""
    text = F.coalesce(text, F.lit(""))
    plain = F.when(F.contains(text, F.lit("@")), F.regexp_replace(text, PATTERNS["email"], " ")).otherwise(text)
    return F.array_distinct(F.transform(F.regexp_extract_all(plain, F.lit(_WORD), F.lit(0)), lambda w: F.lower(w)))


def disclosures(docs: DataFrame, base: DataFrame, text: str, bits: float, support: int) -> DataFrame:
    """(entity, term, bits): terms that reveal an entity, and what they leave unknown. All counts are of distinct texts."""
    entity = F.transform("spans", lambda s: F.concat_ws(":", s["kind"], F.lower(s["value"])))
    named = base.select("mark", F.explode(F.array_distinct(entity)).alias("entity")).distinct()
    sizes = named.groupBy("entity").agg(F.count(F.lit(1)).alias("n_e")).where(F.col("n_e") >= support)
    held = common.cut(named.join(common.small(sizes), "entity").groupBy("mark").agg(F.collect_list(F.struct("entity", "n_e")).alias("entities")))
    copies = common.cut(base.groupBy("mark").agg(F.count(F.lit(1)).alias("n"))).where("n > 1").select(F.col("mark").alias("of"), "n")
    total, largest = base.select("mark").distinct().count(), held.agg(F.max(F.array_max(F.transform("entities", lambda e: e["n_e"])))).first()[0]
    # each of c copies of a text counts 1/c; sums are rounded to the whole number of distinct texts
    worded = docs.select(F.xxhash64(F.col(f"`{text}`")).alias("mark"), terms(F.col(f"`{text}`")).alias("terms")).join(
        common.small(copies), F.col("mark") == F.col("of"), "left"
    ).select("mark", "terms", (1 / F.coalesce("n", F.lit(1))).alias("weight"))
    texts = F.round(F.sum("weight")).cast("long")
    # counted for all words, partly before the shuffle; words too frequent for any entity leave before pairs are made
    counts = common.cut(worded.select("weight", F.explode("terms").alias("term")).groupBy("term").agg(texts.alias("n_t")).where(F.col("n_t") >= support))
    # a term of more texts than this is left with more bits for every entity
    most = 2**bits * (largest or 0) * (1 + 1e-9)
    frequent = counts.where(F.col("n_t") > most).select("term")
    # of a text's entities only those that are frequent enough for the term meet it
    fits = F.filter("entities", lambda e: e["n_e"] * F.lit(2**bits * (1 + 1e-9)) >= F.col("n_t"))
    pairs = (
        worded.join(common.small(held), "mark").select("weight", "entities", F.explode("terms").alias("term"))
        .join(common.small(frequent), "term", "left_anti").join(counts, "term")
        .select("weight", "term", "n_t", F.explode(fits).alias("e"))
        .groupBy("e.entity", "e.n_e", "term", "n_t").agg(texts.alias("n_te")).where(F.col("n_te") >= support)
    )
    left = F.log2(F.col("n_t") / F.col("n_te"))
    told = F.col("n_te") * F.log2(F.lit(float(max(total, 1))) / F.col("n_e"))
    to_name_one = math.log2(max(counts.count(), 1)) + MARGIN
    return pairs.withColumn("bits", left).where((left <= bits + 1e-9) & (told >= to_name_one)).select("entity", "term", "bits")


def added_spans(docs: DataFrame, base: DataFrame, key: str, text: str, bits: float, support: int) -> DataFrame:
    """key, mark, added: array of (start, order, end, kind, value) of disclosing terms, wherever they stand in any text."""
    revealing = common.cut(disclosures(docs, base, text, bits, support).select("term").distinct())
    body = docs.select(F.col(f"`{key}`").alias("key"), F.xxhash64(F.col(f"`{text}`")).alias("mark"), F.col(f"`{text}`").alias("body"))
    hits = common.cut(
        body.select("key", "mark", F.explode(terms(F.col("body"))).alias("term")).join(common.small(revealing), "term")
        .groupBy("key", "mark").agg(F.collect_set("term").alias("terms"))
    ).select(F.col("key").alias("of"), F.col("mark").alias("of_mark"), "terms")
    found = matches(F.col("body"), _WORD, lambda w: F.array_contains(F.col("terms"), F.lower(w)))
    return body.join(common.small(hits), F.col("key").eqNullSafe(F.col("of")) & (F.col("mark") == F.col("of_mark"))).select(
        "key", "mark", F.transform(found, lambda w: F.struct(
            w["start"].alias("start"), F.lit(len(KINDS)).alias("order"), w["end"].alias("end"), F.lit("term").alias("kind"), w["value"].alias("value"),
        )).alias("added"),
    ).dropDuplicates(["key", "mark"])


def find(docs: DataFrame, key: str = "doc_id", text: str = "text", bits: float = BITS, support: int = SUPPORT) -> DataFrame:
    """One row for each document: key, mark (hash of the text), base (spans of the patterns), spans (all, by start)."""
    base = common.cut(docs.select(
        F.col(f"`{key}`").alias("key"), F.xxhash64(F.col(f"`{text}`")).alias("mark"), base_spans(F.col(f"`{text}`")).alias("spans"),
    ))
    added = added_spans(docs, base, key, text, bits, support)
    extra = added.select(F.col("key").alias("of"), F.col("mark").alias("of_mark"), "added")
    outside = F.filter("added", lambda a: ~F.exists("spans", lambda b: (a["start"] < b["end"]) & (b["start"] < a["end"])))
    every = F.when(F.col("added").isNull(), F.col("spans")).otherwise(F.array_sort(F.concat("spans", outside)))
    return base.join(extra, F.col("key").eqNullSafe(F.col("of")) & (F.col("mark") == F.col("of_mark")), "left").select(
        F.col("key").alias(key), "mark", F.col("spans").alias("base"), every.alias("spans")
    )


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(text: Column, spans: Column) -> Column:
    """`text` with spans generalised to <KIND> or <NAME>, or removed; a span that begins inside an earlier one is part of it."""
    def step(done: Column, s: Column) -> Column:
        name = F.when(s["kind"] != "term", F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">"))).when(
            s["value"].rlike(r"^\p{Lu}"), F.lit("<NAME>")).otherwise(F.lit(""))
        inside = s["start"] < done["at"]
        return F.struct(
            F.greatest(done["at"], s["end"]).alias("at"),
            F.when(inside, done["out"]).otherwise(F.concat(done["out"], F.substring(text, done["at"] + 1, s["start"] - done["at"]), name)).alias("out"),
        )

    done = F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step)
    rest = F.substring(text, done["at"] + 1, F.length(text))
    return F.when(F.size(spans) > 0, F.concat(done["out"], rest)).otherwise(text)


def sanitise(docs: DataFrame, key: str = "doc_id", text: str = "text", bits: float = BITS, support: int = SUPPORT) -> DataFrame:
    """`docs` with personal data and disclosing terms masked in `text`; texts without any stay as they are, nulls too."""
    of, of_mark, spans = common.free_names(docs, "of", "of_mark", "spans")
    found = find(docs, key, text, bits, support).where(F.size("spans") > 0)
    found = common.cut(found.select(F.col(key).alias(of), F.col("mark").alias(of_mark), F.col("spans").alias(spans)).dropDuplicates([of, of_mark]))
    same = F.col(f"`{key}`").eqNullSafe(F.col(of)) & (F.xxhash64(F.col(f"`{text}`")) == F.col(of_mark))
    body = F.col(f"`{text}`")
    clean = F.when(F.col(spans).isNull(), body).otherwise(masked(body, F.col(spans))).alias(text)
    return docs.join(common.small(found), same, "left").select(*[clean if c == text else F.col(f"`{c}`") for c in docs.columns])
