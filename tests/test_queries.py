"""Every registered query against the SQL that states its result."""

import duckdb
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

import __spark_entry__ as contract
from oracle_check import connect, difference
from tableqa import registry

QUERIES, ORACLES = registry.QUERIES, registry.ORACLES


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None


@pytest.fixture(scope="module")
def split_tables(spark, tmp_path_factory):
    """lineitem in eight files, documents of one language; both queries and their SQL read them."""
    folder = str(tmp_path_factory.mktemp("split"))
    registry.load(spark, SF_DIR, "lineitem").repartition(8).write.parquet(f"{folder}/lineitem.parquet")
    registry.load(spark, SF_DIR, "documents").withColumn("lang", F.lit("en")).write.parquet(f"{folder}/documents.parquet")
    con = duckdb.connect()
    for name in ("lineitem", "documents"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet/*.parquet')")
    return folder, con


@pytest.mark.parametrize("name", ["duplicate_excess_per_file", "shard_metrics", "sum_metrics", "compare_tables_documents"])
def test_query_of_tables_in_several_files(spark, split_tables, name):
    folder, con = split_tables
    assert difference(QUERIES[name](spark, folder), con, ORACLES[name]) is None


def test_all_tasks_write_the_files_of_lineitem(spark, split_tables):
    files = registry.lineitem_files(registry.with_shared_folder(spark), split_tables[0])
    assert files.select("part").distinct().count() == 3 and len(files.inputFiles()) > 3


def test_documents_of_one_language_are_not_compared_in_one_task(spark, split_tables, monkeypatch):
    most = []

    def dealt(expected, observed, **options):
        held = observed.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()
        most.append(held[0] / held[1])
        return expected.limit(1)

    monkeypatch.setattr(registry.compare, "compare_tables", dealt)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        QUERIES["compare_tables_documents"](spark, split_tables[0])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert most[0] < 0.5


def test_entry_shows_good_and_bad_metrics(spark):
    statuses = {r.status for r in contract.entry(spark).collect()}
    assert {"OK", "MISMATCH", "MISSING_SQL", "MISSING_PARQUET"} <= statuses
