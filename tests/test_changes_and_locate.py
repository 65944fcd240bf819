import itertools
import random
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tableqa import jobs
from tableqa.operators import changes, compare, extract, locate

FEED = "k long, sys_change_version long, sys_change_operation string"
RUN_TS = datetime(2024, 5, 6, 7, 8, 9)


def plan_of(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def fold(operations):
    """Net operation of one key, change by change."""
    net = None
    for op in operations:
        if net is None:
            net = op
        elif op == "D":
            net = "gone" if net == "I" else "D"
        else:
            net = {"D": "U", "gone": "I"}.get(net, net)
    return None if net == "gone" else net


def valid(operations):
    """A key is inserted only where it is not, changed and deleted only where it is."""
    there = operations[0] != "I" if operations else True
    for op in operations:
        if (op == "I") == there:
            return False
        there = op != "D"
    return True


SEQUENCES = [s for n in range(1, 6) for s in itertools.product("DIU", repeat=n) if valid(s)]


def test_net_changes_equal_a_fold_change_by_change(spark):
    rows = [(k, 10 * i + k % 3, op) for k, s in enumerate(SEQUENCES) for i, op in enumerate(s)]
    random.seed(2)
    random.shuffle(rows)
    got = {r.k: (r.sys_change_version, r.sys_change_operation) for r in changes.net_changes(spark.createDataFrame(rows, FEED), "k").collect()}
    assert got == {k: (10 * (len(s) - 1) + k % 3, fold(s)) for k, s in enumerate(SEQUENCES) if fold(s)}


@pytest.mark.parametrize("cut", [1, 2, 3, 4])
def test_net_changes_of_two_stretches_merge(spark, cut):
    rows = [(k, i, op) for k, s in enumerate(SEQUENCES) for i, op in enumerate(s)]
    feed = spark.createDataFrame(rows, FEED)
    parts = [changes.net_changes(f, "k", m, keep_gone=True) for f, m in ((feed.where(f"sys_change_version < {cut}"), None), (feed, cut - 1))]
    for keep in (False, True):
        merged = changes.merge_net_changes(*parts, "k", keep_gone=keep)
        assert sorted(merged.collect()) == sorted(changes.net_changes(feed, "k", keep_gone=keep).collect())


def test_net_changes_edges(spark):
    feed = spark.createDataFrame([(None, 5, "I"), (None, 6, "U"), (1, 7, "D"), (1, 7, "I"), (2, None, "D"), (3, -4, "U"), (4, 1, "U")], FEED)
    got = {r.k: tuple(r)[1:] for r in changes.net_changes(feed, "k").collect()}
    assert got == {None: (6, "I"), 1: (7, "U"), 3: (-4, "U"), 4: (1, "U")}
    assert changes.net_changes(feed.limit(0), "k").count() == 0
    assert changes.net_changes(feed, "k", 6).count() == 1
    two = feed.withColumn("l", F.lit("x")).withColumnRenamed("sys_change_version", "v").withColumn("v", F.col("v").cast("string"))
    assert changes.net_changes(two, ["k", "l"], version="v").columns == ["k", "l", "v", "sys_change_operation"]
    for bad in ((1, 1, "X"), (1, 1, None), (1, 1 << 62, "U")):
        with pytest.raises(Exception, match="change"):
            changes.net_changes(spark.createDataFrame([bad], FEED), "k").collect()


def test_net_changes_fold_before_the_shuffle(spark):
    feed = spark.range(40_000).select(F.lit(7).alias("k"), F.col("id").alias("sys_change_version"), F.lit("U").alias("sys_change_operation"))
    net = changes.net_changes(feed, "k")
    plan = plan_of(net)
    assert "Sort" not in plan and plan.count("HashAggregate") == 2 and plan.index("partial_min") > plan.index("Exchange")
    assert [tuple(r) for r in net.collect()] == [(7, 39_999, "U")]


def test_net_extract_has_a_row_a_key(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (5, "e")], "k long, name string")
    feed = spark.createDataFrame([(1, 1, "I"), (1, 2, "U"), (2, 3, "U"), (2, 4, "U"), (3, 5, "I"), (3, 6, "D"), (4, 7, "U"), (4, 8, "D")], FEED)
    raw = extract.changed_rows(feed, base, "k")
    net = extract.changed_rows(feed, base, "k", net=True)
    assert raw.count() == 8
    assert sorted(map(tuple, net.collect())) == [(1, "a", 2, "I"), (2, "b", 4, "U"), (4, None, 8, "D")]
    assert extract.extract(base, "k", RUN_TS, "change_tracking", changes=feed, net=True).count() == 3
    assert extract.extract(base, "k", RUN_TS, "full", changes=feed, net=True).count() == 3


# --- where tables differ

ROWS = "k long, a string, b double"


def plain_differences(left, right):
    out = {}
    for key in {r[0] for r in left + right}:
        mine, other = [r for r in left if r[0] == key], [r for r in right if r[0] == key]
        lost, rest = 0, list(map(repr, other))
        for r in map(repr, mine):
            if r in rest:
                rest.remove(r)
            else:
                lost += 1
        if lost or rest:
            status = "MISSING" if not other else "EXTRA" if not mine else "CHANGED"
            out[key] = (status, len(mine), len(other), lost, len(rest))
    return out


def located(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def changed_copy(rows, rng):
    out = []
    for k, a, b in rows:
        fate = rng.random()
        if fate < 0.02:
            continue
        out.append((k, a, b + 1 if fate > 0.99 else b))
        if 0.5 < fate < 0.51:
            out.append((k, a, b))
    return out + [(10_000 + i, "new", 0.5) for i in range(5)] + [(-3, None, float("nan"))]


@pytest.mark.parametrize("leaf_rows, ranges", [(1_000_000, 255), (10, 7), (1, 1), (0, 255)])
def test_located_differences_equal_plain_ones(spark, leaf_rows, ranges):
    rng = random.Random(leaf_rows)
    rows = [(i // 2 if i % 5 else 42, f"t{i % 7}", i / 4) for i in range(1500)] + [(None, "n", 1.0)] * 3 + [(7, None, float("nan"))]
    copy = changed_copy(rows, rng)
    sides = [spark.createDataFrame(r, ROWS) for r in (rows, copy)]
    assert located(locate.locate_differences(*sides, "k", ranges, leaf_rows)) == plain_differences(rows, copy)
    assert locate.locate_differences(sides[0], sides[0].repartition(3), "k", ranges, leaf_rows).count() == 0


@pytest.mark.parametrize("kind", ["string", "date", "timestamp", "decimal(12,3)", "float", "binary", "boolean"])
def test_located_differences_by_keys_of_any_type(spark, kind):
    value = {"date": "date_add(DATE'2020-01-01', CAST(id AS INT))", "timestamp": "timestamp_seconds(id * 1000.5)", "binary": "CAST(CAST(id AS STRING) AS BINARY)",
             "boolean": "id % 2 = 0"}.get(kind, f"CAST(id / 8 AS {kind})")
    rows = spark.range(400).selectExpr(f"CASE WHEN id % 50 <> 1 THEN {value} END AS k", "id")
    copy = rows.where("id NOT IN (33, 201)").union(rows.where("id = 350").selectExpr("k", "id + 1"))
    got = locate.locate_differences(rows, copy, "k", ranges=9, leaf_rows=20).collect()
    lost, added = sum(r.lost for r in got), sum(r.added for r in got)
    assert (lost, added) == (2, 1)
    wanted = {repr(r.k) for r in rows.where("id IN (33, 201, 350)").collect()}
    assert {repr(r.k) for r in got} == wanted


def test_only_ranges_that_differ_are_read_again(spark, tmp_path):
    spark.range(20_000).selectExpr("id AS k", "id % 10 AS v").repartitionByRange(8, "k").sortWithinPartitions("k").write.parquet(f"{tmp_path}/a")
    left = spark.read.parquet(f"{tmp_path}/a")
    right = left.withColumn("v", F.when(F.col("k") == 777, 99).otherwise(F.col("v")))
    found = locate.locate_differences(left, right, "k", leaf_rows=500)
    assert located(found) == {777: ("CHANGED", 1, 1, 1, 1)}
    assert "PushedFilters: [" in plan_of(found) and "GreaterThan(k," in plan_of(found)


def test_equal_tables_shuffle_no_rows(spark, tmp_path):
    spark.range(1000).selectExpr("id", "id % 3 AS v").write.parquet(f"{tmp_path}/a")
    rows = spark.read.parquet(f"{tmp_path}/a")
    outcome = compare.compare_tables(rows, rows, by="sums")
    assert tuple(outcome.first()) == ("PASS", 1000, 1000)
    assert "hashpartitioning" not in plan_of(outcome) and "rangepartitioning" not in plan_of(outcome)
    assert tuple(compare.compare_tables(rows, rows.union(rows), by="sums").first()) == ("FAIL", 1000, 2000)
    assert tuple(compare.compare_tables(rows, rows.withColumnRenamed("v", "w"), by="sums").first()) == ("FAIL", 1000, 1000)
    assert tuple(compare.compare_tables(rows.limit(0), rows.limit(0), by="sums").first()) == ("PASS", 0, 0)
    with pytest.raises(ValueError):
        locate.locate_differences(rows, rows.drop("v"), "id")


def test_changed_columns(spark):
    left = spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (None, "c", 3.0), (4, "d", 4.0), (4, "d", 4.0), (5, "e", float("nan"))], ROWS)
    right = spark.createDataFrame([(1, "A", 2.0), (2, "b", 2.0), (None, "x", 3.0), (4, "d", 4.5), (4, "d", 4.0), (5, "e", float("nan"))], ROWS)
    found = locate.locate_differences(left, right, "k")
    got = {r.k: r["columns"] for r in locate.changed_columns(left, right, "k", found).collect()}
    assert got == {1: ["a", "b"], 2: ["b"], None: ["a"]}


# --- in order


def sequence(spark, values, step=1):
    return spark.createDataFrame([(i * step, v) for i, v in enumerate(values)], "place long, v string")


@settings(max_examples=12, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=30), st.lists(st.sampled_from("abc"), max_size=30), st.integers(1, 9))
def test_order_equals_lists(spark, a, b, bucket):
    for other in (a, b):
        first = next((i + 1 for i, (x, y) in enumerate(itertools.zip_longest(a, other)) if x != y), None)
        got = locate.compare_ordered(sequence(spark, a), sequence(spark, other, 3), "place", rows_per_bucket=bucket).first()
        assert tuple(got) == ("PASS" if a == other else "FAIL", len(a), len(other), first)


def test_swapped_rows_fail_in_order_only(spark):
    values = [f"v{i}" for i in range(3000)]
    swapped = values[:1234] + [values[1235], values[1234]] + values[1236:]
    left, right = sequence(spark, values), sequence(spark, swapped)
    assert tuple(locate.compare_ordered(left, right, "place", rows_per_bucket=100).first()) == ("FAIL", 3000, 3000, 1235)
    assert compare.compare_tables(left, right, ordered_by="place").first().status == "FAIL"
    assert compare.compare_tables(left, left.repartition(5), ordered_by="place").first().status == "PASS"
    assert compare.compare_tables(left.drop("place"), right.drop("place")).first().status == "PASS"
    numbered = left.withColumn("place", F.col("place") + 1)
    outcome = locate.compare_ordered(numbered, numbered.repartition(4), "place", numbered=True, rows_per_bucket=64)
    assert tuple(outcome.first()) == ("PASS", 3000, 3000, None)
    assert tuple(locate.compare_ordered(left, right.withColumnRenamed("v", "w"), "place").first()) == ("FAIL", 3000, 3000, None)


def test_query_compare_names_its_differences(spark, tmp_path):
    spark.range(50).selectExpr("id AS k", "id * 2 AS v").createOrReplaceTempView("compared")
    source = spark.sql("SELECT k, CASE WHEN k = 9 THEN -1 ELSE v END AS v FROM compared WHERE k <> 3")
    check = {"query_id": 4, "query_text": "SELECT * FROM compared"}
    row = jobs.job_query_compare(source, check, f"{tmp_path}/out", RUN_TS, single=False, key="k").first()
    assert row.status == "FAIL" and row.error_message.startswith("differences: ")
    got = located(spark.read.parquet(row.error_message.removeprefix("differences: ")))
    assert got == {3: ("EXTRA", 0, 1, 0, 1), 9: ("CHANGED", 1, 1, 1, 1)}
    row = jobs.job_query_compare(spark.table("compared"), check, f"{tmp_path}/same", RUN_TS, key="k", ordered_by="k").first()
    assert (row.status, row.error_message) == ("PASS", None)
