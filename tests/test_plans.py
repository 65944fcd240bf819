import json
from datetime import datetime

import pytest

from tableqa import schemas
from tableqa.operators import metrics
from tableqa.plans import build, run, select
from tableqa.sources import tables

RUN_TS = datetime(2024, 5, 6, 7, 8, 9)


def catalog(spark, rows):
    return spark.createDataFrame(rows, schemas.COLUMN_CATALOG)


@pytest.fixture(scope="module")
def address(spark):
    return catalog(spark, [
        ("Db", "locale", "Address", "City", 2), ("Db", "locale", "Address", "AddressId", 1),
        ("Db", "locale", "Address", "City", 2), ("Db", "a", "Empty", None, None), ("Db", "locale", "B", "Id", 1),
    ])


def plan_rows(plan):
    return [(r.query_id, r.table_name, r.check_type) for r in plan.orderBy("query_id").collect()]


def test_plan_order_and_numbers(address):
    assert plan_rows(build.generate_plan(address)) == [
        (1, "Address", "count_total_rows"), (2, "Address", "nulls_per_column"), (3, "Address", "hashcheck"),
        (4, "Address", "duplicates_primary_key"), (5, "B", "count_total_rows"), (6, "B", "nulls_per_column"),
        (7, "B", "hashcheck"), (8, "B", "duplicates_primary_key"),
    ]
    kept = build.generate_plan(address, skip_empty=False)
    assert plan_rows(kept)[0] == (1, "Empty", "count_total_rows") and kept.count() == 9
    assert [(f.name, f.dataType) for f in kept.schema] == [(f.name, f.dataType) for f in schemas.PLAN]


def test_plan_texts_for_the_server(address):
    plan = build.generate_plan(address, build.ALL_CHECKS, dialect="tsql", pk={"Address": "City"})
    texts = {r.check_type: r.query_text for r in plan.filter("table_name = 'Address'").collect()}
    name = "[Db].[locale].[Address]"
    assert texts == {
        "count_total_rows": f"SELECT COUNT(*) AS total_rows FROM {name}",
        "nulls_per_column": (
            "SELECT SUM(CASE WHEN [AddressId] IS NULL THEN 1 ELSE 0 END) AS [nulls_AddressId], "
            f"SUM(CASE WHEN [City] IS NULL THEN 1 ELSE 0 END) AS [nulls_City] FROM {name}"
        ),
        "hashcheck": (
            "SELECT *, CONVERT(VARCHAR(64), HASHBYTES('SHA2_256', CONCAT_WS('|', CAST([AddressId] AS NVARCHAR(MAX)), "
            f"CAST([City] AS NVARCHAR(MAX)))), 2) AS hashcheck FROM {name}"
        ),
        "value_dist_AddressId": (
            f"SELECT [AddressId], COUNT(*) AS freq FROM {name} GROUP BY [AddressId] ORDER BY freq DESC, [AddressId] "
            "OFFSET 0 ROWS FETCH NEXT 10 ROWS ONLY"
        ),
        "duplicates_primary_key": (
            f"SELECT [City] AS key_value, COUNT(*) AS cnt FROM {name} GROUP BY [City] HAVING COUNT(*) > 1"
        ),
    }


def test_narrow_plan_and_key_for_all_tables(address):
    plan = build.generate_plan(address, (build.NULLS_CHECK, build.DUPLICATES_CHECK), nulls="narrow", pk="Id", parts=2)
    rows = plan.filter("table_name = 'Address'").orderBy("query_id").collect()
    assert [r.check_type for r in rows] == [
        "nulls_per_column|AddressId", "nulls_per_column|City", "duplicates_primary_key"
    ]
    assert rows[0].query_text == "SELECT count_if(`AddressId` IS NULL) AS `nulls_AddressId` FROM `locale`.`Address`"
    assert "GROUP BY `Id`" in rows[2].query_text
    with pytest.raises(ValueError):
        build.generate_plan(address, ("nonsense",))


def test_columns_per_table(address):
    rows = {tuple(r)[:-1]: r.columns for r in build.columns_per_table(address, ("table_schema", "table_name")).collect()}
    assert rows == {("locale", "Address"): ["AddressId", "City"], ("a", "Empty"): [], ("locale", "B"): ["Id"]}


def test_merged_plans(address):
    first, second = build.generate_plan(address), build.generate_plan(address, (build.COUNT_CHECK,))
    assert sorted(r.query_id for r in build.merge_plans(first, second).collect()) == list(range(1, 11))


def test_read_plan(spark, address):
    plan = build.generate_plan(address, nulls="narrow").cache()
    read = lambda *a, **k: [r.check_type for r in select.read_plan(plan, "Db", "locale", "Address", *a, **k).collect()]
    assert read(["NULLS_PER_COLUMN"]) == ["nulls_per_column|AddressId", "nulls_per_column|City"]
    assert read(["nulls_per_column|addressid", "hashcheck"]) == ["nulls_per_column|AddressId", "hashcheck"]
    assert read(["nulls_per_column"], exact=True) == []
    dist = build.generate_plan(address, build.ALL_CHECKS)
    assert [r.check_type for r in select.read_plan(dist, "Db", "locale", "Address", ["value_dist"]).collect()] == ["value_dist_AddressId"]
    assert read([]) == [] and len(read([], empty_means_all=True)) == 5
    assert read(None, empty_means_all=True, limit=2) == ["count_total_rows", "nulls_per_column|AddressId"]
    assert select.read_plan(plan, "Db", "locale", "x' OR '1'='1", ["hashcheck"]).count() == 0


@pytest.fixture(scope="module")
def pets(spark):
    rows = [(1, "cat", None), (1, "dog", 2.5), (2, None, None)]
    df = spark.createDataFrame(rows, "PetId int, kind string, weight double")
    df.createOrReplaceTempView("pets")
    return build.generate_plan(tables.column_metadata(spark, {"pets": df}, "db", "s"), build.ALL_CHECKS, parts=1)


@pytest.mark.parametrize("fuse", [True, False])
def test_run_plan(spark, pets, fuse):
    got = {r.check_type: r for r in run.run_plan(spark, pets, RUN_TS, fuse=fuse).collect()}
    assert {r.status for r in got.values()} == {"OK"}
    assert got["count_total_rows"].value == "3"
    assert json.loads(got["nulls_per_column"].value) == [{"nulls_PetId": 0, "nulls_kind": 1, "nulls_weight": 2}]
    rows_of = lambda check: [r.asDict() for r in spark.read.parquet(got[check].value).collect()]
    assert rows_of("duplicates_primary_key") == [{"key_value": 1, "cnt": 2}]
    assert got["duplicates_primary_key"].excess_rows == 1
    assert sorted(r["freq"] for r in rows_of("value_dist_PetId")) == [1, 2]
    hashes = rows_of("hashcheck")
    assert len(hashes) == 3 and set(hashes[0]) == {"PetId", "kind", "weight", "hashcheck"}


def test_fused_checks_share_one_scan(spark, pets):
    texts = [r.query_text for r in pets.filter("expected_output_format = 'single_row_scalar'").collect()]
    spark.read.table("pets").write.mode("overwrite").saveAsTable("pets_stored")
    merged = ", ".join(f"(SELECT struct(*) FROM ({t.replace('`pets`', 'pets_stored')})) AS r{i}" for i, t in enumerate(texts))
    plan = spark.sql("SELECT " + merged)._jdf.queryExecution().optimizedPlan().toString()
    assert "mergedValue" in plan


def test_fused_and_single_runs_give_the_same_text(spark):
    texts = [
        "SELECT max(ts) AS m FROM VALUES (TIMESTAMP '2024-01-01 00:00:00') AS t(ts)", "SELECT true AS b",
        "SELECT 1.50 AS d", "SELECT CAST(NULL AS INT) AS n", "SELECT 1 AS a WHERE false", "SELECT array(1, 2) AS x",
        "SELECT 1 AS `a.b|c`, NULL AS e",
    ]
    plan = spark.createDataFrame([plan_row(i, t) for i, t in enumerate(texts)], schemas.PLAN)
    runs = [
        [(r.query_id, r.status, r.value, r.rowcount) for r in run.run_plan(spark, plan, RUN_TS, fuse=f).collect()]
        for f in (True, False)
    ]
    assert runs[0] == runs[1] and {r[1] for r in runs[0]} == {"OK"}


def plan_row(query_id, text, check_type="count_total_rows", shape="single_row_scalar"):
    return (query_id, "t", "db", "s", check_type, text, shape)


def test_failed_checks_keep_their_error_and_the_others_run(spark):
    rows = [
        plan_row(1, "SELECT COUNT(*) AS total_rows FROM range(7);"),
        plan_row(2, "SELECT count(*) FROM no_such_table"),
        plan_row(3, "SELECT cast('x' AS int) AS total_rows", "count_total_rows"),
        plan_row(4, "SELECT id FROM range(3)"),
        plan_row(5, "SELECT id FROM range(0)"),
    ]
    plan = spark.createDataFrame(rows, schemas.PLAN)
    got = {r.query_id: r for r in run.run_plan(spark, plan, RUN_TS).collect()}
    assert {i: r.status for i, r in got.items()} == {1: "OK", 2: "ERROR", 3: "ERROR", 4: "OK", 5: "OK"}
    assert got[1].value == "7" and "no_such_table" in got[2].error and "CAST_INVALID_INPUT" in got[3].error
    assert (got[4].rowcount, got[5].rowcount, got[5].value) == (3, 0, None)
    stored = {r.query_id: r for r in run.qa_results(run.run_plan(spark, plan, RUN_TS), RUN_TS, "/p").collect()}
    assert (stored[1].status, stored[1].result_value, stored[1].rowcount, stored[1].parquet_path) == ("SUCCESS", "7", 1, "/p")
    assert (stored[2].status, stored[2].rowcount, stored[2].result_value) == ("ERROR", 0, None)


def test_long_results_are_measured_whole(spark):
    text = "SELECT id AS key_value, 3 AS cnt FROM range(2500)"
    plan = spark.createDataFrame([plan_row(1, text, "duplicates_primary_key", "multi_row_summary")], schemas.PLAN)
    results = run.run_plan(spark, plan, RUN_TS)
    row = results.first()
    assert row.rowcount == 2500 and row.excess_rows == 5000
    assert spark.read.parquet(row.value).count() == 2500
    assert metrics.expected_metrics(results).first().value == 5000


def test_another_runner(spark):
    plan = spark.createDataFrame([plan_row(1, "server text")], schemas.PLAN)
    results = run.run_plan(spark, plan, RUN_TS, runner=lambda text: spark.createDataFrame([(text,)], "v string"))
    assert results.first().value == "server text"
