import json
from datetime import datetime
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tableqa import jobs, schemas
from tableqa.plans import build, run
from tableqa.sinks import writers
from tableqa.sources import jdbc, tables

RUN_TS = datetime(2024, 5, 6, 7, 8, 9)
CONFIG = {"server": "db.example", "database": "Shop", "username": "u", "password": "p", "driver": "x.Driver"}


def files(path, pattern="part-*"):
    return sorted(Path(path).glob(pattern))


def test_jdbc_options_and_aliases():
    options = jdbc.jdbc_options(CONFIG)
    assert options == {
        "url": "jdbc:sqlserver://db.example:1433;databaseName=Shop;encrypt=true;trustServerCertificate=true;packetSize=512",
        "user": "u", "password": "p", "driver": "x.Driver",
    }
    assert jdbc.resolve_connection(CONFIG) == options
    assert jdbc.resolve_connection(connection_name="shop", aliases={"shop": CONFIG}) == options
    assert jdbc.jdbc_options({"url": "jdbc:x"}) == {"url": "jdbc:x"}
    with pytest.raises(ValueError, match="unknown"):
        jdbc.resolve_connection(connection_name="other", aliases={"shop": CONFIG})
    with pytest.raises(ValueError, match="either"):
        jdbc.resolve_connection()


def test_jdbc_texts():
    assert jdbc.table_query("sa]les", "T") == "SELECT * FROM [sa]]les].[T]"
    assert jdbc.change_query("s", "T", "Id", 7) == (
        "SELECT c.[Id], c.SYS_CHANGE_VERSION AS sys_change_version, c.SYS_CHANGE_OPERATION AS sys_change_operation "
        "FROM CHANGETABLE(CHANGES [s].[T], 7) AS c"
    )


def test_changed_rows_are_joined_by_the_server():
    assert jdbc.change_rows_query("s", "T", "Id", ["Id", "na]me"], 7) == (
        "SELECT c.[Id], b.[na]]me], c.SYS_CHANGE_VERSION AS sys_change_version, c.SYS_CHANGE_OPERATION AS sys_change_operation "
        "FROM CHANGETABLE(CHANGES [s].[T], 7) AS c LEFT JOIN [s].[T] AS b ON b.[Id] = c.[Id]"
    )


def test_jdbc_timeouts_and_bounds():
    options = jdbc.jdbc_options({"url": "u", "login_timeout": 30, "query_timeout": 600})
    assert options == {"url": "u", "loginTimeout": "30", "queryTimeout": "600"}
    with pytest.raises(ValueError, match="lower_bound"):
        jdbc.jdbc_reader(Recorder(), {"url": "u"}, schema="s", table="T", partition_column="k")


def test_jdbc_ranges_of_equal_size():
    assert jdbc.quantile_query("SELECT 1 AS k", "k", 4) == (
        "SELECT MIN([k]) AS bound FROM (SELECT [k], NTILE(4) OVER (ORDER BY [k]) AS part FROM (SELECT 1 AS k) AS src "
        "WHERE [k] IS NOT NULL) AS parts GROUP BY part"
    )
    assert jdbc.range_predicates("k", [30, 1, 10, 10]) == ["[k] < 10 OR [k] IS NULL", "[k] >= 10 AND [k] < 30", "[k] >= 30"]
    assert jdbc.range_predicates("k", ["a", "o'b"]) == ["[k] < 'o''b' OR [k] IS NULL", "[k] >= 'o''b'"]
    assert jdbc.range_predicates("k", [5, 5]) == ["1 = 1"] and jdbc.range_predicates("k", []) == ["1 = 1"]


class Recorder:
    """Stands in for a reader and keeps its options."""

    def __init__(self):
        self.read, self.set = self, {}

    def format(self, name):
        self.set["format"] = name
        return self

    def options(self, **options):
        self.set.update(options)
        return self

    def option(self, name, value):
        self.set[name] = value
        return self


def test_jdbc_reader_options():
    whole = jdbc.jdbc_reader(Recorder(), {"url": "u"}, schema="s", table="T").set
    assert whole == {"format": "jdbc", "url": "u", "fetchsize": 100_000, "query": "SELECT * FROM [s].[T]"}
    split = jdbc.jdbc_reader(
        Recorder(), {"url": "u"}, query="SELECT 1 AS k", partition_column="k", lower_bound=1, upper_bound=9, num_partitions=4
    ).set
    assert split["dbtable"] == "(SELECT 1 AS k) AS src" and split["numPartitions"] == 4 and "query" not in split
    with pytest.raises(ValueError):
        jdbc.jdbc_reader(Recorder(), {"url": "u"})


def test_jdbc_split_reads(spark, monkeypatch):
    calls = []

    def fake(bounds):
        def read(_, options, **arguments):
            calls.append(arguments)
            return spark.createDataFrame([bounds], "lower_bound int, upper_bound int")

        return read

    monkeypatch.setattr(jdbc, "read_jdbc", fake((1, 90)))
    jdbc.read_jdbc_split(spark, {"url": "u"}, "Id", 8, schema="s", table="T")
    assert calls[0]["query"] == (
        "SELECT MIN([Id]) AS lower_bound, MAX([Id]) AS upper_bound FROM (SELECT * FROM [s].[T]) AS src"
    )
    assert (calls[1]["lower_bound"], calls[1]["upper_bound"], calls[1]["num_partitions"]) == ("1", "90", 8)
    monkeypatch.setattr(jdbc, "read_jdbc", fake((None, None)))
    jdbc.read_jdbc_split(spark, {"url": "u"}, "Id", 8, query="SELECT 1 AS Id")
    assert "partition_column" not in calls[3] and calls[3]["query"] == "SELECT 1 AS Id"


def test_sources(spark, tmp_path):
    df = tables.rows_to_df(spark, [(2,), (1,)], "a int")
    df.createOrReplaceTempView("two_rows")
    assert tables.read_source(spark, table="two_rows").count() == 2
    assert tables.read_source(spark, table="two_rows", query="SELECT 1 AS x").columns == ["x"]
    with pytest.raises(ValueError):
        tables.read_source(spark)
    assert [r.a for r in tables.first_rows(df, 1, "a").collect()] == [1]
    assert [tuple(r) for r in tables.column_metadata(spark, {"t": df}, "c", "s").collect()] == [("c", "s", "t", "a", 1)]
    typed = tables.column_metadata(spark, {"t": df}, "c", "s", data_types=True)
    assert tables.column_types(typed, "t") == {"a": "int"}
    staged = tables.stage(df, "t")
    assert sorted(r.a for r in staged.collect()) == [1, 2]
    assert spark.conf.get("spark.checkpoint.dir") in staged.inputFiles()[0]
    tables.column_metadata(spark, {"t": df}, "c", "s").drop("ordinal_position").createOrReplaceTempView("cat")
    assert tables.read_column_catalog(spark, "cat").columns == schemas.COLUMN_CATALOG.names[:4]
    df.write.parquet(f"{tmp_path}/p")
    assert tables.read_parquet(spark, f"{tmp_path}/p").count() == 2


def test_extract_files_hold_a_chunk_each(spark, tmp_path):
    path = writers.write_extract(spark.range(15000).coalesce(1), f"{tmp_path}/x", 4000)
    assert sorted(spark.read.parquet(str(f)).count() for f in files(path)) == [3000, 4000, 4000, 4000]
    assert all(".snappy." in f.name for f in files(path))
    assert len(writers.written_files(spark, path)) == 4


def test_single_file(spark, tmp_path):
    path = writers.write_single(spark.range(100).repartition(4), f"{tmp_path}/", RUN_TS)
    assert path == f"{tmp_path}/extract_20240506_070809.snappy.parquet" and len(files(path)) == 1
    assert writers.write_single(spark.range(0), f"{tmp_path}/none", RUN_TS) is None
    assert not Path(f"{tmp_path}/none").exists()
    large = writers.write_single(spark.range(100).repartition(4), f"{tmp_path}/large", RUN_TS, single=False)
    assert len(files(large)) == 4 and spark.read.parquet(large).count() == 100


def test_json_lines_and_prefix(spark, tmp_path):
    prefix = writers.run_prefix(f"{tmp_path}/", "qa_alerts", RUN_TS)
    assert prefix == f"{tmp_path}/qa_alerts/2024/05/06/070809"
    df = spark.createDataFrame([("a", None), ("b", 1)], "k string, v int").repartition(2)
    (file,) = files(writers.write_jsonl(df, prefix), "part-*.json")
    assert sorted(map(json.loads, file.read_text().splitlines()), key=lambda r: r["k"]) == [
        {"k": "a", "v": None}, {"k": "b", "v": 1}
    ]


def test_results_and_plan_tables(spark, tmp_path):
    row = {n: None for n in schemas.QA_RESULTS.names}
    old = spark.createDataFrame([{**row, "run_ts": datetime(2024, 1, 1), "query_id": 1}], schemas.QA_RESULTS)
    new = spark.createDataFrame([{**row, "run_ts": RUN_TS, "query_id": 2}], schemas.QA_RESULTS)
    writers.append_results(old, path=f"{tmp_path}/r")
    writers.append_results(new, path=f"{tmp_path}/r")
    assert [r.query_id for r in writers.latest_results(spark.read.parquet(f"{tmp_path}/r"), 2).collect()] == [2, 1]
    writers.append_results(old, table="qa_results_table")
    writers.append_results(new, table="qa_results_table")
    assert spark.table("qa_results_table").count() == 2
    metadata = tables.column_metadata(spark, {"t": spark.range(1)})
    for _ in range(2):
        jobs.job_generate_plan(metadata, table="plan_table")
    assert spark.table("plan_table").count() == 4
    writers.save_plan(spark.table("plan_table"), path=f"{tmp_path}/plan")
    assert spark.read.parquet(f"{tmp_path}/plan").count() == 4


@pytest.fixture(scope="module")
def shop(spark):
    rows = [(i, None if i % 5 == 0 else f"n{i}", datetime(2024, 1, 1)) for i in [*range(1, 40), 7, 7]]
    df = spark.createDataFrame(rows, "OrderId bigint, CustomerName string, at timestamp_ntz")
    df.createOrReplaceTempView("Shop")
    plan = build.generate_plan(tables.column_metadata(spark, {"Shop": df}, "db", "s"), build.ALL_CHECKS, parts=1)
    return df, plan, jobs.TableId("db", "s", "Shop")


CHECKS = ["count_total_rows", "nulls_per_column", "duplicates_primary_key"]


@pytest.mark.parametrize("footers", [True, False])
def test_extract_reconcile(spark, shop, tmp_path, footers):
    df, plan, table = shop
    alerts = jobs.job_extract_reconcile(
        df, table, "OrderId", plan, CHECKS, str(tmp_path), RUN_TS, batch_size=10, chunk_size=7, footers=footers
    )
    assert {r.key: (r.status, r.expected) for r in alerts.collect()} == {
        "count_total_rows": ("OK", 41), "nulls_per_column|order_id": ("OK", 0),
        "nulls_per_column|customer_name": ("OK", 7), "nulls_per_column|at": ("OK", 0), "duplicates_primary_key": ("OK", 2),
    }
    assert spark.read.json(f"{tmp_path}/qa_results/2024/05/06/070809").count() == 3
    landed = spark.read.parquet(f"{tmp_path}/data/2024/05/06/070809")
    assert landed.count() == 41 and landed.select("rn").distinct().count() == 41


@pytest.mark.parametrize(
    "fault, expected",
    [
        (lambda df: df.filter("OrderId <> 3"), {"count_total_rows": "MISMATCH"}),
        (lambda df: df.withColumn("CustomerName", F.expr("nullif(CustomerName, 'n1')")), {"nulls_per_column|customer_name": "MISMATCH"}),
        (lambda df: df.union(df.filter("OrderId = 4")), {"count_total_rows": "MISMATCH", "duplicates_primary_key": "MISMATCH"}),
        (lambda df: df.drop("at"), {"nulls_per_column|at": "MISSING_PARQUET"}),
        (lambda df: df.withColumn("loaded_by", F.lit("x")), {"nulls_per_column|loaded_by": "MISSING_SQL"}),
        (lambda df: df, {}),
    ],
)
def test_planted_faults_give_exactly_their_alerts(spark, shop, tmp_path, fault, expected):
    df, plan, table = shop
    alerts = jobs.job_extract_reconcile(
        fault(df), table, "OrderId", plan, CHECKS, str(tmp_path), RUN_TS, only_failures=True
    )
    assert {r.key: r.status for r in alerts.collect()} == expected


def test_a_live_source_is_read_once(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    def live(frames):
        for frame in frames:
            reads.add(len(frame))
            yield frame

    source = spark.range(500).mapInPandas(live, "id long")
    before = len(list(Path(spark.conf.get("spark.checkpoint.dir")).glob("tableqa_source_*")))
    landed = jobs.job_extract(source, "id", f"{tmp_path}/x", RUN_TS)
    assert landed.count() == 500 and landed.select("rn").distinct().count() == 500
    assert reads.value == 500
    assert len(list(Path(spark.conf.get("spark.checkpoint.dir")).glob("tableqa_source_*"))) == before
    spark.range(9).write.parquet(f"{tmp_path}/files")
    files = spark.read.parquet(f"{tmp_path}/files").filter("id > 3")
    assert jobs.job_extract(files, "id", f"{tmp_path}/y", RUN_TS, land_first=False).count() == 5


def test_a_query_result_is_computed_once(spark, tmp_path):
    rows = spark.sparkContext.accumulator(0)

    def live(frames):
        for frame in frames:
            rows.add(len(frame))
            yield frame

    writers.write_single(spark.range(100).mapInPandas(live, "id long"), f"{tmp_path}/one", RUN_TS)
    assert rows.value == 100
    rows.add(-100)
    outcome = run.run_check(spark.range(100).mapInPandas(live, "id long"), "hashcheck", land=f"{tmp_path}/result")
    assert (outcome["rowcount"], outcome["value"], rows.value) == (100, f"{tmp_path}/result", 100)


def test_the_job_can_be_repeated(spark, shop, tmp_path):
    df, plan, table = shop
    for hour in (1, 2):
        run_ts = datetime(2024, 1, 1, hour)
        alerts = jobs.job_extract_reconcile(df, table, "OrderId", plan, CHECKS, str(tmp_path), run_ts)
        assert {r.status for r in alerts.collect()} == {"OK"}
    assert len(list(Path(tmp_path).glob("data/2024/01/01/*"))) == 2


def test_staging_needs_a_shared_folder():
    class Bare:
        """A session without any shared folder."""

        def __init__(self):
            self.conf = self.sparkContext = self

        def get(self, name, default):
            return default

        def getCheckpointDir(self):
            return None

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        tables.staging_path(Bare(), "x")


def test_changes_after_what_the_target_holds(spark, tmp_path):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "Id int, name string")
    feed = spark.createDataFrame(
        [(1, 3, "U"), (2, 12, "U"), (5, 14, "D")], "Id int, sys_change_version bigint, sys_change_operation string"
    )

    def changes(name):
        return jobs.job_extract(
            base, "Id", f"{tmp_path}/{name}", RUN_TS, mode="change_tracking", changes=feed, target_table="db_s_target"
        )

    first = changes("first")
    assert first.count() == 3
    first.filter("sys_change_version < 10").write.saveAsTable("db_s_target")
    assert sorted(r.id for r in changes("second").collect()) == ["2", "5"]


def test_extract_and_qa(spark, shop, tmp_path):
    df, plan, table = shop
    results = jobs.job_extract_and_qa(
        df, table, plan, f"{tmp_path}/", RUN_TS, results_path=f"{tmp_path}/results", limit=3
    )
    assert [r.status for r in results.collect()] == ["SUCCESS"] * 3
    assert spark.read.parquet(f"{tmp_path}/results").schema.names == schemas.QA_RESULTS.names
    empty = jobs.job_extract_and_qa(
        df.limit(0), table, plan, f"{tmp_path}/none/", RUN_TS, results_path=f"{tmp_path}/results", check_types=["count_total_rows"]
    )
    assert [(r.parquet_path, r.result_value) for r in empty.collect()] == [(None, "41")]


def test_single_file_has_row_groups_for_several_readers(spark, tmp_path):
    path = writers.write_single(spark.range(1_200_000), f"{tmp_path}/one", RUN_TS)
    (name,) = files(path)
    held = pq.ParquetFile(name).metadata
    assert [held.row_group(i).num_rows for i in range(held.num_row_groups)] == [500_000, 500_000, 200_000]


def test_query_compare(spark, shop, tmp_path):
    df = shop[0]
    check = {"query_id": 5, "table_name": "Shop", "check_type": "equality"}

    def outcome(text, name):
        return jobs.job_query_compare(df, {**check, "query_text": text}, f"{tmp_path}/{name}", RUN_TS).first()

    assert outcome("SELECT * FROM Shop", "a").status == "PASS"
    failed = outcome("SELECT * FROM Shop WHERE OrderId > 1", "b")
    assert (failed.status, failed.row_count_sql, failed.row_count_bq) == ("FAIL", 41, 40)
    error = outcome("SELECT * FROM nowhere", "c")
    assert error.status == "ERROR" and "nowhere" in error.error_message and error.query_id == 5
