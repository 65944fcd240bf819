import shutil

import pytest
from pyspark.sql import functions as F

from tableqa.operators import checks, incremental
from tableqa.operators.metrics import NeededChecks, observed_metrics

ALL = NeededChecks(count_total_rows=True, nulls="all", duplicates=True, primary_key=("order_key",))


def table(spark, first, last):
    """Rows whose keys repeat inside and between files; nulls in all columns."""
    ids = spark.range(first, last)
    return ids.select(
        F.when(F.col("id") % 11 != 0, F.col("id") % 70).alias("OrderKey"), F.when(F.col("id") % 3 != 0, F.concat(F.lit("w"), F.col("id") % 5)).alias("word"),
        F.array("id").alias("nested"),
    )


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def folders(tmp_path):
    return str(tmp_path / "data"), str(tmp_path / "states")


def agree(spark, data, states):
    everything = spark.read.parquet(data)
    got = rows(incremental.merged_metrics(spark, data, states, "OrderKey"))
    assert got == rows(observed_metrics(everything, ALL).select("key", F.col("value").cast("long")))
    for n in (1, 3, 100):
        top = incremental.merged_top_values(spark, data, states, "word", n)
        assert top.columns == ["word", "freq"] and [tuple(r) for r in top.collect()] == [tuple(r) for r in checks.value_distribution(everything, "word", n).collect()]


def test_later_runs_measure_new_files_only(spark, folders):
    data, states = folders
    watched = ["OrderKey", "word", ["OrderKey", "word"]]
    table(spark, 0, 300).repartition(3).write.parquet(data)
    assert len(incremental.measure_new_files(spark, data, states, watched)) == 3
    agree(spark, data, states)
    assert incremental.measure_new_files(spark, data, states, watched) == []
    table(spark, 200, 500).repartition(2).write.mode("append").parquet(data)
    with pytest.raises(ValueError, match="2 files"):
        incremental.merged_metrics(spark, data, states).collect()
    new = incremental.measure_new_files(spark, data, states, watched)
    assert len(new) == 2 and {r.file_path for r in spark.read.parquet(f"{states}/counts").select("file_path").distinct().collect()} >= set(new)
    agree(spark, data, states)
    pairs = dict(rows(incremental.merged_metrics(spark, data, states, ["OrderKey", "word"])))["duplicates_primary_key"]
    assert pairs == checks.duplicate_excess(spark.read.parquet(data), ["OrderKey", "word"]).first()[0]


def test_removed_files_drop_out_and_replaced_ones_are_measured_again(spark, folders, tmp_path):
    data, states = folders
    table(spark, 0, 200).repartition(2).write.parquet(data)
    incremental.measure_new_files(spark, data, states, ["OrderKey", "word"])
    first, second = sorted(p.name for p in (tmp_path / "data").glob("*.parquet"))
    (tmp_path / "data" / first).unlink()
    (tmp_path / "data" / f".{first}.crc").unlink()
    agree(spark, data, states)
    table(spark, 900, 1000).coalesce(1).write.parquet(str(tmp_path / "other"))
    (tmp_path / "data" / f".{second}.crc").unlink()
    shutil.copy(next((tmp_path / "other").glob("*.parquet")), tmp_path / "data" / second)
    assert len(incremental.measure_new_files(spark, data, states, ["OrderKey", "word"])) == 1
    agree(spark, data, states)


def test_a_failed_run_does_not_count(spark, folders, monkeypatch):
    data, states = folders
    table(spark, 0, 100).coalesce(1).write.parquet(data)
    with pytest.raises(Exception):  # after the counts are written
        incremental.measure_new_files(spark, data, states, ["OrderKey", "word", "no such column"])
    assert incremental.measured_files(spark, states).count() == 0
    assert len(incremental.measure_new_files(spark, data, states, ["OrderKey", "word"])) == 1
    agree(spark, data, states)


def test_runs_at_the_same_time_count_once(spark, folders, monkeypatch):
    data, states = folders
    table(spark, 0, 100).repartition(2).write.parquet(data)
    for _ in range(2):  # neither sees what the other has measured
        with monkeypatch.context() as m:
            m.setattr(incremental, "measured_files", lambda spark, states: spark.createDataFrame([], incremental._FILES))
            assert len(incremental.measure_new_files(spark, data, states, ["OrderKey", "word"])) == 2
    agree(spark, data, states)


def test_empty_folder_and_empty_files(spark, folders, tmp_path):
    data, states = folders
    (tmp_path / "data").mkdir()
    assert incremental.measure_new_files(spark, data, states) == []
    assert incremental.merged_metrics(spark, data, states).count() == 0
    table(spark, 0, 0).write.mode("append").parquet(data)
    incremental.measure_new_files(spark, data, states, ["OrderKey", "word"])
    agree(spark, data, states)
    assert {r.value for r in incremental.merged_metrics(spark, data, states, "OrderKey").collect()} == {0}
