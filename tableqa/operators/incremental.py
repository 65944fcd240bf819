"""Metrics of a growing folder of Parquet files from stored states of its files.

A run measures only files that no earlier run has measured and stores a state for each: its row count and nulls by
column, and for every watched key how often each of its values occurs in the file. States are exact and merge by sums,
so counts, duplicates and top values over all files come from the states alone.

A run writes its states first and lists its files last, in one file, so a run that failed half-way does not count and
can be repeated; so do runs at the same time, of which one counts for each file. A file is known by path, size and time:
a replaced file is measured again and a removed one drops out.

Edges: a folder without files has no metrics, one of empty files has zeros; NULL keys count as equal, as elsewhere; nested columns can be counted for nulls,
but not be watched; files must have the same columns and types. The value states of a unique key are as large as that
column: watch the columns that need it.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableqa.functions.names import DUPLICATES_CHECK, col_of, snake_name
from tableqa.operators.checks import TOP_VALUES
from tableqa.operators.metrics import NeededChecks, observed_metrics
from tableqa.schemas import METRIC

FILE = ("file_path", "file_size", "file_time")
_FILES = T.StructType([
    T.StructField("file_path", T.StringType()), T.StructField("file_size", T.LongType()),
    T.StructField("file_time", T.TimestampType()), T.StructField("run", T.StringType()),
])


def _names(key: str | list[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _values_folder(states: str, key: list[str]) -> str:
    return f"{states.rstrip('/')}/values_" + "__".join(snake_name(c) for c in key)


def list_files(spark: SparkSession, data: str) -> DataFrame:
    """file_path, file_size, file_time of the Parquet files of a folder; nothing of them is read."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(data)
    return listed.select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_modification_time").alias("file_time"),
    )


def measured_files(spark: SparkSession, states: str) -> DataFrame:
    """Files of finished runs, each with the run whose states count."""
    try:
        committed = spark.read.schema(_FILES).parquet(f"{states.rstrip('/')}/files")
    except AnalysisException:  # no run has finished
        committed = spark.createDataFrame([], _FILES)
    return committed.groupBy(*FILE).agg(F.min("run").alias("run"))


def measure_new_files(spark: SparkSession, data: str, states: str, watched: list[str | list[str]] = ()) -> list[str]:
    """Measures the files of `data` that `states` lacks; returns their paths.

    `watched` are the keys (a column or several) whose values are counted; it must be the same in all runs. The driver
    holds the list of new files, as Spark's own file index does.
    """
    new = list_files(spark, data).join(measured_files(spark, states), list(FILE), "left_anti").orderBy("file_path").collect()
    if not new:
        return []
    paths, run = [r.file_path for r in new], uuid.uuid4().hex
    table = spark.read.parquet(*paths)
    counts = observed_metrics(table, NeededChecks(count_total_rows=True, nulls="all"), per_file=True, exclude=())
    counts.withColumn("run", F.lit(run)).write.mode("append").parquet(f"{states.rstrip('/')}/counts")
    for key in map(_names, watched):
        columns = [col_of(c).alias(f"v{i}") for i, c in enumerate(key)]
        freq = table.groupBy(F.col("_metadata.file_path").alias("file_path"), *columns).agg(F.count(F.lit(1)).alias("freq"))
        freq.withColumn("run", F.lit(run)).write.mode("append").parquet(_values_folder(states, key))
    committed = spark.createDataFrame([(*r, run) for r in new], _FILES)
    committed.coalesce(1).write.mode("append").parquet(f"{states.rstrip('/')}/files")
    return paths


def _current(spark: SparkSession, data: str, states: str) -> DataFrame:
    """(file_path, run) of all files of the folder, which must have been measured."""
    files = list_files(spark, data).join(measured_files(spark, states), list(FILE), "left")
    missing = files.where("run IS NULL").count()
    if missing:
        raise ValueError(f"{missing} files of {data} have not been measured")
    return files.select("file_path", "run")


def _key_counts(spark: SparkSession, data: str, states: str, key: list[str]) -> DataFrame:
    """v0, v1, ..., freq over all files; sums combine map-side."""
    files = _current(spark, data, states)
    kept = spark.read.parquet(_values_folder(states, key)).join(files, ["file_path", "run"], "left_semi")
    return kept.groupBy(*[f"v{i}" for i in range(len(key))]).agg(F.sum("freq").alias("freq"))


def merged_metrics(spark: SparkSession, data: str, states: str, primary_key: str | list[str] | None = None) -> DataFrame:
    """Row count, nulls of all columns and, for a watched `primary_key`, duplicates, as `observed_metrics` gives them."""
    if list_files(spark, data).isEmpty():
        return spark.createDataFrame([], METRIC)
    counts = spark.read.parquet(f"{states.rstrip('/')}/counts").join(_current(spark, data, states), ["file_path", "run"], "left_semi")
    # files without rows have no counts, so every metric starts from the 0 of an empty table
    none = observed_metrics(spark.read.parquet(data).limit(0), NeededChecks(count_total_rows=True, nulls="all"), exclude=())
    merged = counts.select("key", "value").unionByName(none).groupBy("key").agg(F.sum("value").alias("value"))
    if primary_key is None:
        return merged
    excess = _key_counts(spark, data, states, _names(primary_key)).agg(F.coalesce(F.sum(F.col("freq") - 1), F.lit(0)).alias("value"))
    return merged.unionByName(excess.select(F.lit(DUPLICATES_CHECK).alias("key"), "value"))


def merged_top_values(spark: SparkSession, data: str, states: str, column: str, n: int = TOP_VALUES) -> DataFrame:
    """The most frequent values of a watched column with their frequency, as `value_distribution` gives them."""
    counted = _key_counts(spark, data, states, [column])
    return counted.orderBy(F.desc("freq"), F.col("v0").asc_nulls_first()).limit(n).withColumnRenamed("v0", column)
