"""Registered queries of the operators, each over its whole table, with SQL where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableqa.llm import chat, common, decontaminate, langid, licenses, lm, merkle, packing, pieces, pii, repair, shards, simhash, topk

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def tokenizer_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_simhash_near_dedup")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(common.load(spark, sf, "documents"), words=4, radius=4)


@query("op2_chat_format")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    rows = common.only(common.load(spark, sf, "conversations"), "conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)], "conv_id long, turn long, role string, text string")
    nodes, conversations = chat.prefix_tree(rows.unionByName(extra))
    return chat.digests(chat.read_back(nodes, conversations)).withColumnRenamed("conv", "conv_id")


@query("op3_benchmark_decontamination")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.leaks(common.load(spark, sf, "documents"), common.load(spark, sf, "benchmark")).drop("text_hash")


@query("op4_sentencepiece")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    docs = common.only(common.load(spark, sf, "documents"), "doc_id", "text")
    return pieces.encode(docs, tokenizer_path(), keep_ids=False).drop("text")


# floor(64 * x) as integers; every vector against every query
OP5_SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(coalesce(list_sum([p[1] * p[2] FOR p IN list_zip(q.v, c.v)]), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20"""


@query("op5_exact_topk", OP5_SQL)
def op5(spark: SparkSession, sf: str) -> DataFrame:
    vectors = topk.integer_vectors(common.load(spark, sf, "embeddings"), "vec_id", "embedding")
    return topk.top_k(vectors.where("vec_id % 20 = 0"), vectors, k=20)


@query("op6_lm_scoring")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    docs = common.only(common.load(spark, sf, "documents"), "doc_id", "text")
    remainder = common.fold("doc_id", 5)
    scored = lm.score_texts(docs, kept=remainder > 1, held=remainder == 0)
    return scored.withColumn("held_out", common.fold("doc_id", 5) == 1)


@query("op7_pii")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    found = pii.find(common.load(spark, sf, "documents"))
    counts = [
        F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}") for kind in ("email", "ip", "card", "phone")
    ]
    return found.select(
        "doc_id", *counts, F.sha2(pii.listed(F.col("base")).cast("binary"), 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans")
    )


@query("op8_rendezvous_sharding")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    return shards.shard_documents(common.load(spark, sf, "documents"), shards=24)


@query("op9_license_scan")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan(common.load(spark, sf, "documents"), licenses.templates(spark))


@query("op10_language_id")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    docs = common.only(common.load(spark, sf, "documents"), "doc_id", "text", "lang")
    held_out = common.fold("doc_id", 5) == 0
    model = langid.train(docs.where(~held_out))
    return langid.predict(docs.select("doc_id", "text", held_out.alias("held_out")), model).drop("text")


@query("op11_merkle_manifest", merkle.manifest_sql())
def op11(spark: SparkSession, sf: str) -> DataFrame:
    return merkle.manifest(common.load(spark, sf, "documents"))


@query("op12_conversation_repair", repair.repair_sql())
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return repair.repaired_digests(common.load(spark, sf, "conversations"))


@query("op13_lexical_packing")
def op13(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(common.load(spark, sf, "documents"), tokenizer_path("word_bpe_49k.json"))


@query("pipeline")
def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)
