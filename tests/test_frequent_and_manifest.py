import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tableqa.operators import checks, extract, frequent
from tableqa.sinks import manifest

RUN_TS = datetime(2024, 5, 6, 7, 8, 9)


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("kind", ["long", "string", "date", "timestamp", "decimal(12,2)", "boolean", "double", "binary"])
def test_top_values_equal_counting(spark, kind):
    rng = random.Random(4)
    values = [rng.choice([1, 1, 1, 2, 2, 3, 4, None]) if rng.random() < 0.7 else rng.randrange(10, 5000) for _ in range(3000)]
    raw = spark.createDataFrame([(v,) for v in values], "v int")
    value = {"date": "date_add(DATE'2020-01-01', v)", "timestamp": "timestamp_seconds(v)", "boolean": "v % 2 = 0", "binary": "CAST(CAST(v AS STRING) AS BINARY)"}
    df = raw.selectExpr(f"{value.get(kind, f'CAST(v AS {kind})')} AS v")
    for n in (1, 3, 10):
        assert rows(frequent.top_values(df, "v", n)) == rows(checks.value_distribution(df, "v", n))


def test_proof_holds_or_is_refused(spark):
    frequent_ones = spark.range(40_000).select(F.when(F.col("id") % 2 == 0, F.col("id") % 6).otherwise(F.col("id")).alias("v"))
    proven = frequent.proven_top_values(frequent_ones, "v", n=3, tracked=192)
    assert [tuple(r) for r in proven] == rows(checks.value_distribution(frequent_ones, "v", 3))
    assert frequent.proven_top_values(spark.range(40_000).toDF("v"), "v", n=3, tracked=192) is None
    assert frequent.proven_top_values(frequent_ones, "v", n=4, tracked=192) is None  # the fourth is no more frequent than unseen ones
    few = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    assert rows(frequent.top_values(few, "v", 10)) == [(None, 1), ("a", 1), ("b", 1)]
    assert rows(frequent.top_values(few.limit(0), "v", 10)) == []


def test_what_a_summary_leaves_out_is_below_the_bound(spark):
    rng = random.Random(1)
    values = [int(rng.paretovariate(0.6)) for _ in range(30_000)]
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(7)
    listed = {r["value"] for r in frequent.candidates(df, "v", 96).collect()}
    unseen = [r["freq"] for r in df.groupBy("v").agg(F.count(F.lit(1)).alias("freq")).collect() if r["v"] not in listed]
    assert max(unseen) <= frequent.unseen_bound(30_000, 96)


def numbered(spark, n=1050):
    source = spark.range(n).select(F.col("id").alias("k"), F.concat(F.lit("t"), "id").alias("name")).repartition(6)
    return extract.full_extract(source, "k", RUN_TS, batch_size=100, rows_per_bucket=120)


def test_pages_open_exactly_their_files(spark, tmp_path):
    df = numbered(spark)
    listed = manifest.write_numbered(df, f"{tmp_path}/x", chunk_size=100).orderBy("first_rn").collect()
    assert [(r.row_count, r.first_rn, r.last_rn) for r in listed] == [(100, a, a + 99) for a in range(1, 1001, 100)] + [(50, 1001, 1050)]
    assert all(r.bytes > 0 for r in listed)
    for start, end, files in ((1, 100, 1), (100, 101, 2), (950, 2000, 2), (1, 1050, 11)):
        page = manifest.numbered_page(spark, f"{tmp_path}/x", start, end)
        assert len(page.inputFiles()) == files
        assert sorted(int(r.rn) for r in page.collect()) == list(range(start, min(end, 1050) + 1))
    assert manifest.numbered_page(spark, f"{tmp_path}/x", 5000, 6000).count() == 0
    assert sorted(page.columns) == sorted(df.columns)
    with pytest.raises(ValueError, match="already"):
        manifest.write_numbered(df, f"{tmp_path}/x")


def test_an_unfinished_write_is_not_seen(spark, tmp_path):
    path = f"{tmp_path}/x"
    broken = numbered(spark).withColumn("name", F.when(F.col("rn") == "700", F.raise_error(F.lit("lost"))).otherwise(F.col("name")))
    with pytest.raises(Exception, match="lost"):
        manifest.write_numbered(broken, path, chunk_size=100)
    # what a killed writer leaves behind
    numbered(spark).limit(77).write.parquet(f"{path}/data_left")
    assert not manifest.is_finished(spark, path)
    with pytest.raises(ValueError, match="no finished"):
        manifest.numbered_page(spark, path, 1, 10)
    assert manifest.write_numbered(numbered(spark), path, chunk_size=100).agg(F.sum("row_count")).first()[0] == 1050
    assert manifest.numbered_page(spark, path, 1, 1050).count() == 1050


def test_numbers_are_checked(spark, tmp_path):
    for fault in (numbered(spark).where("rn <> '7'"), numbered(spark).union(numbered(spark).where("rn = '7'"))):
        with pytest.raises(ValueError, match="row numbers"):
            manifest.write_numbered(fault, f"{tmp_path}/{id(fault)}", chunk_size=100)
