import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tableqa.operators import numbering

N = 60_000
PER_BUCKET = 5_000


def third():
    return F.col("id") % 3 == 0

CASES = {
    "unique": lambda df: df.select((F.col("id") * 7919 % N).alias("k"), F.lit("x").alias("v")),
    "one_hot_key": lambda df: df.select(F.when(third(), 42).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")),
    "copies": lambda df: df.select(
        F.when(third(), 420).otherwise(F.col("id")).alias("k"), F.when(third(), "same").otherwise("y").alias("v")
    ),
    "null_keys": lambda df: df.select(F.when(~third(), F.col("id")).alias("k"), F.col("id").alias("v")),
    "null_copies": lambda df: df.select(F.when(~third(), F.col("id")).alias("k"), F.lit(-0.0).alias("v")),
    "text_keys": lambda df: df.select(
        F.concat(F.lit("Customer#"), F.lpad((F.col("id") * 7919 % N).cast("string"), 9, "0")).alias("k")
    ),
    "all_copies": lambda df: df.select(F.lit("z").alias("k"), F.lit(1).alias("v")),
    "binary_keys": lambda df: df.select(F.sha2(F.col("id").cast("string"), 256).cast("binary").alias("k")),
    "float_keys": lambda df: df.select(
        F.when(third(), float("nan")).otherwise(F.col("id") / 7).alias("k"), F.col("id").alias("v")
    ),
    "times": lambda df: df.select(F.timestamp_seconds(F.col("id") * 7919 % N).cast("timestamp_ntz").alias("k")),
}


def ranks(df):
    """First and last number of every key, from counts alone."""
    upto = F.sum("c").over(Window.orderBy(F.asc_nulls_first("k")))
    return df.groupBy("k").agg(F.count(F.lit(1)).alias("c")).select("k", (upto - F.col("c") + 1).alias("a"), upto.alias("b"), "c")


@pytest.mark.parametrize("case", CASES)
def test_numbers_equal_row_number_and_no_bucket_is_large(spark, case):
    df = CASES[case](spark.range(N))
    layout = numbering.plan_layout(df, "k", PER_BUCKET)
    assert len(layout.bounds) > 1 or layout.hot_keys
    numbered = numbering.number_rows(df, "k", layout=layout, rows_per_bucket=PER_BUCKET)
    got = numbered.groupBy("k").agg(F.min("rn").alias("a"), F.max("rn").alias("b"), F.countDistinct("rn").alias("c"))
    assert got.exceptAll(ranks(df)).count() == 0
    assert numbered.count() == N
    assert numbered.drop("rn").exceptAll(df).count() == 0

    buckets = numbering.bucketed(df, "k", layout)
    largest = buckets.groupBy("__bucket").agg(F.count_distinct(*df.columns).alias("n")).agg(F.max("n")).first()[0]
    assert largest <= 3 * PER_BUCKET


def test_many_buckets(spark):
    df = CASES["one_hot_key"](spark.range(N))
    layout = numbering.plan_layout(df, "k", 50)
    assert len(layout.bounds).bit_length() > numbering.COMPILED_STEPS and max(layout.splits) > 1
    got = numbering.number_rows(df, "k", layout=layout).groupBy("k").agg(
        F.min("rn").alias("a"), F.max("rn").alias("b"), F.countDistinct("rn").alias("c")
    )
    assert got.exceptAll(ranks(df)).count() == 0


def test_copies_keep_their_exact_values(spark):
    df = CASES["null_copies"](spark.range(N))
    layout = numbering.plan_layout(df, "k", PER_BUCKET)
    assert layout.heavy_rows
    texts = numbering.number_rows(df, "k", layout=layout).select(F.col("v").cast("string")).distinct().collect()
    assert [r[0] for r in texts] == ["-0.0"]


def test_small_and_empty_tables(spark):
    df = spark.createDataFrame([(3,), (None,), (1,)], "k int")
    assert sorted((r.rn, r.k) for r in numbering.number_rows(df, "k").collect()) == [(1, None), (2, 1), (3, 3)]
    assert numbering.number_rows(df.filter("k > 9"), "k").count() == 0


def test_the_bucket_search_is_compiled_into_the_scan_stage(spark):
    df = CASES["unique"](spark.range(N))
    layout = numbering.plan_layout(df, "k", PER_BUCKET)
    plan = numbering.number_rows(df, "k", layout=layout)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
    assert "SinglePartition" not in plan.split("BroadcastExchange")[0]


@pytest.mark.parametrize("table, key, size", [("orders", "o_orderkey", 1000), ("lineitem", "l_orderkey", 5000), ("customer", "c_name", 100)])
def test_registered_numberings_run_in_buckets(spark, table, key, size):
    df = spark.read.parquet(f"/root/testdata/sf0.01/{table}.parquet")
    assert len(numbering.plan_layout(df, key, size).bounds) > 1


def test_running_totals(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, "", "a", "b"]), i, rng.randrange(4)) for i in range(400)]
    df = spark.createDataFrame(rows, "a string, b int, n int").repartition(5)
    got = {(r.a, r.b): r.before for r in numbering.running_totals(df, ["a", "b"], "n", "before").collect()}
    total = 0
    for a, b, n in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1])):
        assert got[a, b] == total
        total += n
    assert len(got) == len(rows)
    assert numbering.running_totals(df.limit(0), ["a"], "n", "before").count() == 0


def test_buckets_for_all_tasks_and_no_more_than_a_number_holds(spark):
    assert numbering.plan_layout(spark.range(15_000), "id").bounds == []
    assert len(numbering.plan_layout(spark.range(45_000), "id").bounds) >= 3  # below a million rows, but worth several tasks
    with pytest.raises(ValueError, match="rows_per_bucket"):
        numbering.plan_layout(spark.range(1 << 20), "id", rows_per_bucket=1)
