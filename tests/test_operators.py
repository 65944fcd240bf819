from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tableqa.operators import checks, compare, extract, metrics
from tableqa.operators.metrics import NeededChecks

RUN_TS = datetime(2024, 5, 6, 7, 8, 9)


def pairs(df):
    return {r.key: r.value for r in df.collect()}


@pytest.fixture(scope="module")
def people(spark):
    rows = [(1, "a", None), (1, "b", None), (None, "c", 1.0), (None, None, 2.0), (2, "e", 3.0)]
    return spark.createDataFrame(rows, "PersonId int, FirstName string, score double")


def test_counts_and_nulls(people):
    assert checks.count_total_rows(people).first().total_rows == 5
    assert checks.nulls_wide(people).first().asDict() == {"nulls_PersonId": 2, "nulls_FirstName": 1, "nulls_score": 2}
    assert pairs(checks.nulls_long(people)) == {
        "nulls_per_column|person_id": 2, "nulls_per_column|first_name": 1, "nulls_per_column|score": 2
    }
    assert checks.nulls_wide(people.filter("false")).first().nulls_score == 0


def test_wide_tables_are_counted_in_groups(spark):
    df = spark.range(3).select(*[F.when(F.col("id") > 0, F.col("id")).alias(f"c.{i}|x") for i in range(450)])
    got = pairs(checks.nulls_long(df))
    assert len(got) == 450 and set(got.values()) == {1}


def test_duplicates_count_null_keys_as_equal(people):
    assert {(r.PersonId, r.cnt) for r in checks.duplicate_keys(people, "PersonId").collect()} == {(1, 2), (None, 2)}
    assert checks.duplicate_excess(people, "PersonId").first().excess_rows == 2
    assert checks.duplicate_excess(people.filter("false"), "PersonId").first().excess_rows == 0


def test_duplicates_inside_files_and_across_them(spark, tmp_path):
    for i, keys in enumerate([[1, 1, 2], [1, 3, 3, 3]]):
        spark.createDataFrame([(k,) for k in keys], "k int").coalesce(1).write.parquet(f"{tmp_path}/t/part={i}")
    df = spark.read.parquet(f"{tmp_path}/t")
    per_file = checks.duplicate_excess(df, "k", per=[F.col("_metadata.file_path")]).collect()
    assert sorted(r.excess_rows for r in per_file) == [1, 2]
    assert checks.duplicate_excess(df, "k").first().excess_rows == 4
    shards = metrics.observed_metrics(df, NeededChecks(True, "all", True, ("k",)), per_file=True)
    assert pairs(metrics.sum_metrics(shards)) == {
        "count_total_rows": 7, "nulls_per_column|k": 0, "nulls_per_column|part": 0, "duplicates_primary_key": 3
    }


def test_metrics_of_parts_of_several_files(spark, tmp_path):
    for keys in ([1, 1, 2], [1, None, 3], [2, None]):
        rows = spark.createDataFrame([(k, p) for k in keys for p in ("a", None)], "k int, p1 string")
        rows.coalesce(1).write.mode("append").partitionBy("p1").parquet(f"{tmp_path}/t")
    got = metrics.observed_metrics(spark.read.parquet(f"{tmp_path}/t"), NeededChecks(True, "all", True, ("k",)), per=("p1",))
    assert sorted((r.p1 or "", r.key, r.value) for r in got.collect()) == sorted(
        (p, k, n) for p in ("a", "") for k, n in (("count_total_rows", 8), ("nulls_per_column|k", 2), ("duplicates_primary_key", 4))
    )
    assert metrics.observed_metrics(spark.range(2), NeededChecks(), per=("id",)).columns == ["id", "key", "value"]
    with pytest.raises(ValueError):
        metrics.observed_metrics(spark.range(2), NeededChecks(True), per_file=True, per=("id",))


def test_value_distribution_breaks_ties_by_value(spark):
    df = spark.createDataFrame([(v,) for v in "bbaacd"], "v string")
    assert [(r.v, r.freq) for r in checks.value_distribution(df, "v", 3).collect()] == [("a", 2), ("b", 2), ("c", 1)]


def test_needed_checks_have_three_null_states():
    assert metrics.needed_checks(["count_total_rows"], "AddressId").nulls is None
    assert metrics.needed_checks(["nulls_per_column", "nulls_per_column|X"]).nulls == "all"
    needed = metrics.needed_checks(["Nulls_Per_Column|AddressId", "duplicates_primary_key"], "AddressId")
    assert needed == NeededChecks(False, frozenset({"address_id"}), True, ("address_id",))
    assert not metrics.needed_checks(["duplicates_primary_key"]).duplicates


def test_observed_metrics(people):
    needed = NeededChecks(True, frozenset({"first_name", "gone"}), True, ("person_id",))
    assert pairs(metrics.observed_metrics(people, needed)) == {
        "count_total_rows": 5, "nulls_per_column|first_name": 1, "duplicates_primary_key": 2
    }
    assert pairs(metrics.observed_metrics(people, NeededChecks())) == {}
    tagged = people.withColumn("rn", F.lit("1"))
    assert "nulls_per_column|rn" not in pairs(metrics.observed_metrics(tagged, NeededChecks(nulls="all")))


def test_counts_from_footers_equal_counts_of_columns(spark, people, tmp_path):
    path = f"{tmp_path}/people"
    people.withColumn("tags", F.array(F.lit("x"), F.lit(None))).repartition(3).write.parquet(path)
    df = spark.read.parquet(path)
    needed = NeededChecks(True, "all", True, ("person_id",))
    assert pairs(metrics.observed_metrics(df, needed, footers_of=path)) == pairs(metrics.observed_metrics(df, needed))
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    with pytest.raises(ValueError):
        metrics.observed_metrics(df, needed, per_file=True, footers_of=path)


def test_other_footer_errors_are_not_hidden(spark, people, tmp_path):
    with pytest.raises(Exception, match="(?i)path"):
        metrics.observed_metrics(people, NeededChecks(True), footers_of=f"{tmp_path}/nowhere").count()


def results(spark, rows):
    return spark.createDataFrame(rows, "query_id bigint, check_type string, status string, value string")


def test_expected_metrics_of_every_form(spark):
    df = results(spark, [
        (1, "count_total_rows", "OK", "12"),
        (2, "nulls_per_column", "OK", '[{"nulls_AddressId":3,"nulls_b":null,"other":9}]'),
        (3, "duplicates_primary_key", "OK", '[{"k":1,"cnt":3},{"k":2,"cnt":"2"},{"k":3,"cnt":"x"}]'),
        (4, "nulls_per_column|CityName", "SUCCESS", "7"),
        (5, "hashcheck", "OK", '[{"a":1}]'),
        (6, "nulls_per_column|Broken", "ERROR", None),
        (7, "count_total_rows", "OK", "99"),
    ])
    assert pairs(metrics.expected_metrics(df)) == {
        "count_total_rows": 12, "nulls_per_column|address_id": 3, "nulls_per_column|b": 0,
        "duplicates_primary_key": 3, "nulls_per_column|city_name": 7, "nulls_per_column|broken": None,
    }
    assert pairs(metrics.expected_metrics(df, keep="last"))["count_total_rows"] == 99


def test_expected_metrics_of_other_result_shapes(spark):
    df = results(spark, [
        (1, "COUNT_TOTAL_ROWS", "OK", '[{"Total_Rows":"5"}]'),
        (2, "duplicates_primary_key", "OK", '[{"k":1,"count":4}]'),
        (3, "nulls_per_column", "OK", '{"nulls_x":1}'),
    ])
    assert pairs(metrics.expected_metrics(df)) == {
        "count_total_rows": 5, "duplicates_primary_key": 3, "nulls_per_column|x": 1
    }
    scalar = results(spark, [(1, "duplicates_primary_key", "OK", "6"), (2, "nulls_per_column|a", "OK", "oops")])
    assert pairs(metrics.expected_metrics(scalar)) == {"duplicates_primary_key": 6, "nulls_per_column|a": 0}
    whole = results(spark, [(1, "duplicates_primary_key", "OK", '[{"cnt":2}]')]).withColumn("excess_rows", F.lit(5000))
    assert pairs(metrics.expected_metrics(whole)) == {"duplicates_primary_key": 5000}


def test_metric_map(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "key string, value bigint")
    assert metrics.metric_map(df).first().metrics == {"a": 1, "b": 2}


def metric(spark, rows, kind="bigint"):
    return spark.createDataFrame(rows, f"key string, value {kind}")


def test_compare_metrics_statuses(spark):
    expected = metric(spark, [("same", 1), ("off", 1), ("no_copy", 1), ("none", None), ("failed", None)])
    observed = metric(spark, [("same", 1), ("off", 3), ("no_sql", 1), ("none", None), ("failed", 2)])
    alerts = compare.compare_metrics(expected, observed, RUN_TS)
    assert {r.key: r.status for r in alerts.collect()} == {
        "same": "OK", "off": "MISMATCH", "no_copy": "MISSING_PARQUET", "no_sql": "MISSING_SQL", "none": "MISSING_BOTH",
        "failed": "MISSING_SQL",
    }
    assert alerts.columns == ["key", "status", "expected", "observed", "evaluated_at_utc"]
    within = compare.compare_metrics(expected, observed, RUN_TS, tolerance=2.0, only_failures=True)
    assert {r.key for r in within.collect()} == {"no_copy", "no_sql", "none", "failed"}


def test_compare_metrics_of_text_values(spark):
    expected, observed = metric(spark, [("a", "12"), ("b", "x")], "string"), metric(spark, [("a", "12.7"), ("b", "y")], "string")
    exact = {r.key: r.status for r in compare.compare_metrics(expected, observed, RUN_TS).collect()}
    lenient = {r.key: r.status for r in compare.compare_metrics(expected, observed, RUN_TS, lenient=True).collect()}
    assert exact == {"a": "MISMATCH", "b": "MISMATCH"} and lenient == {"a": "OK", "b": "OK"}


@pytest.mark.parametrize("by", ["digest", "columns"])
def test_compare_tables(spark, people, by):
    def outcome(a, b):
        return tuple(compare.compare_tables(a, b, by).first())

    assert outcome(people, people.orderBy(F.desc("score"))) == ("PASS", 5, 5)
    assert outcome(people, people.union(people.limit(1))) == ("FAIL", 5, 6)
    assert outcome(people.limit(0), people.limit(0)) == ("PASS", 0, 0)
    assert outcome(people, people.withColumnRenamed("score", "points")) == ("FAIL", 5, 5)
    assert outcome(people, people.withColumn("score", F.lit(1).cast("float"))) == ("FAIL", 5, 5)
    nan = spark.createDataFrame([(float("nan"), None)], "a double, b string")
    assert outcome(nan, nan) == ("PASS", 1, 1)


def test_full_extract(spark):
    df = spark.createDataFrame([(3, datetime(2024, 1, 1), bytearray(b"a\xff")), (1, None, None)], "KeyId int, at timestamp_ntz, raw binary")
    rows = extract.full_extract(df, "KeyId", RUN_TS, version=4, batch_size=1).orderBy("rn").collect()
    assert rows[1].asDict() == {
        "key_id": "3", "at": "2024-01-01 00:00:00", "raw": "a", "sys_change_version": "4", "sys_change_operation": "I",
        "ingestion_datetime_utc": RUN_TS.isoformat(), "rn": "2", "batch_id": 1,
    }
    typed = extract.full_extract(df, "KeyId", RUN_TS, as_text=False, batch_size=None)
    assert dict(typed.dtypes)["key_id"] == "int" and "batch_id" not in typed.columns
    assert {r.at for r in typed.collect()} == {"2024-01-01T00:00:00", None}


def test_batches_cover_the_table_once(spark):
    df = spark.range(1, 1001).withColumnRenamed("id", "k")
    rows = extract.full_extract(df, "k", RUN_TS, batch_size=300)
    sizes = extract.batch_sizes(rows, 300).orderBy("batch_id").collect()
    assert [tuple(r) for r in sizes] == [(0, 300, 1, 300), (1, 300, 301, 600), (2, 300, 601, 900), (3, 100, 901, 1000)]
    pages = [extract.batch_page(rows, r.first_rn, r.last_rn).count() for r in sizes]
    assert pages == [300, 300, 300, 100]


@pytest.fixture(scope="module")
def change_tables(spark):
    base = spark.createDataFrame([(1, "one"), (2, "two"), (4, "four")], "Id int, name string")
    feed = [(1, 5, "U"), (3, 6, "D"), (4, 2, "I"), (2, 9, "I")]
    return spark.createDataFrame(feed, "Id int, sys_change_version bigint, sys_change_operation string"), base


def test_change_extract(spark, change_tables):
    changes, base = change_tables
    rows = extract.change_extract(changes, base, "Id", RUN_TS, min_version=4).orderBy("rn").collect()
    assert [(r.id, r.name, r.sys_change_version, r.sys_change_operation, r.rn) for r in rows] == [
        ("1", "one", "5", "U", "1"), ("2", "two", "9", "I", "2"), ("3", None, "6", "D", "3")
    ]
    lost = extract.change_extract(changes, base, "Id", RUN_TS, min_version=4, keep_null_pk=True).orderBy("rn").collect()
    assert [(r.id, r.sys_change_operation) for r in lost] == [(None, "D"), ("1", "U"), ("2", "I")]


def test_extract_modes(change_tables):
    changes, base = change_tables
    full = extract.extract(base, "Id", RUN_TS, "FULL", changes=changes)
    assert full.count() == 3 and {r.sys_change_version for r in full.collect()} == {"9"}
    assert extract.extract(base, "Id", RUN_TS, "change_tracking", reload=True).count() == 3
    assert extract.extract(base, "Id", RUN_TS, "change_tracking", changes=changes, min_version=5).count() == 2
    with pytest.raises(ValueError, match="unsupported"):
        extract.extract(base, "Id", RUN_TS, "delta")
    with pytest.raises(ValueError, match="feed"):
        extract.extract(base, "Id", RUN_TS, "change_tracking")


def test_high_water_mark_compares_numbers(spark):
    df = spark.createDataFrame([("9",), ("10",), (None,), ("x",)], "sys_change_version string")
    assert extract.high_water_mark(df) == 10
    assert extract.high_water_mark(df.limit(0)) == 0
    assert extract.high_water_mark(None) == 0 and extract.high_water_mark(spark.range(1)) == 0
    assert extract.target_name("Db", "Sales", "Address") == "db_sales_address"


def test_metrics_of_numbers_and_text_are_compared_as_text(spark):
    numbers = spark.createDataFrame([("a", 1), ("b", 2)], "key string, value bigint")
    texts = spark.createDataFrame([("a", "1"), ("b", "many")], "key string, value string")
    got = {r.key: r.status for r in compare.compare_metrics(numbers, texts, RUN_TS, tolerance=5).collect()}
    assert got == {"a": "OK", "b": "MISMATCH"}


def test_nested_maps_are_equal_in_any_order(spark):
    make = lambda m: spark.sql(f"SELECT named_struct('m', {m}) AS s, array({m}) AS a, map('k', {m}) AS mm")
    one, other, third = make("map('x', 1, 'y', 2)"), make("map('y', 2, 'x', 1)"), make("map('y', 1, 'x', 2)")
    assert compare.compare_tables(one, other).first().status == "PASS"
    assert compare.compare_tables(one, third).first().status == "FAIL"


def test_a_few_changes_do_not_shuffle_the_base(spark, tmp_path):
    spark.range(200_000).select(F.col("id").alias("k"), F.lit("x").alias("v")).write.parquet(f"{tmp_path}/base")
    base = spark.read.parquet(f"{tmp_path}/base")
    feed = spark.createDataFrame([(7, 3, "U")], "k bigint, sys_change_version bigint, sys_change_operation string")
    changed = extract.changed_rows(feed, base, "k")
    assert [tuple(r) for r in changed.collect()] == [(7, "x", 3, "U")]
    plan = changed._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan


def test_a_page_of_a_written_extract_reads_its_batches(spark, tmp_path):
    rows = extract.full_extract(spark.range(100), "id", RUN_TS, batch_size=10, rows_per_bucket=20)
    rows.write.parquet(f"{tmp_path}/x")
    page = extract.batch_page(spark.read.parquet(f"{tmp_path}/x"), 25, 34, batch_size=10)
    assert sorted(int(r.rn) for r in page.collect()) == list(range(25, 35))
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(batch_id,2)" in plan and "LessThanOrEqual(batch_id,3)" in plan


def test_contents_of_source_and_extract(spark):
    source = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "RowId int, v string")
    landed = extract.full_extract(source, "RowId", RUN_TS)
    same = compare.compare_content(source, landed, ("v",)).collect()
    assert {r.key: (r.status, r.expected, r.observed) for r in same} == {"hashcheck": ("OK", 3, 3), "value_dist_v": ("OK", 3, 3)}
    moved = compare.compare_content(source, landed.withColumn("v", F.replace("v", F.lit("a"), F.lit("c"))), ("v",)).collect()
    assert {(r.status, r.differing) for r in moved} == {("MISMATCH", 2)}
