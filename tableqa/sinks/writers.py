"""Writing extracts, plans, results and alerts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableqa.schemas import PLAN, QA_RESULTS

CHUNK_SIZE = 100_000
SINGLE_ROW_GROUP = 500_000  # rows of a row group of a single file at most, so that many tasks can read the file


def write_extract(df: DataFrame, path: str, chunk_size: int = CHUNK_SIZE, mode: str = "errorifexists") -> str:
    """Snappy Parquet files of at most `chunk_size` rows; returns the folder."""
    df.write.mode(mode).option("maxRecordsPerFile", chunk_size).option("compression", "snappy").parquet(path)
    return path


def write_single(
    df: DataFrame,
    path: str,
    run_ts: datetime,
    single: bool = True,
    mode: str = "errorifexists",
) -> str | None:
    """One Parquet file, written by one task; with `single=False` a folder of files written by all tasks, for tables
    that one task should not write. A path that ends in a slash gets a name of its own; an empty table leaves nothing
    behind. The table is computed once: its rows are counted in the written files."""
    if path.endswith("/"):
        path = f"{path}extract_{run_ts:%Y%m%d_%H%M%S}.snappy.parquet"
    spark = df.sparkSession
    writer = (df.coalesce(1) if single else df).write.mode(mode).option("compression", "snappy")
    (writer.option("parquet.block.row.count.limit", SINGLE_ROW_GROUP) if single else writer).parquet(path)
    if spark.read.schema(df.schema).parquet(path).isEmpty():
        remove_folder(spark, path)
        return None
    return path


def remove_folder(spark: SparkSession, path: str) -> None:
    """Removes a folder that a job of this library has written, in whatever store it lies."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """One JSON-lines file of a result or alert table, which has one row per check or metric."""
    df.coalesce(1).write.mode(mode).option("ignoreNullFields", "false").json(path)
    return path


def append_results(results: DataFrame, table: str | None = None, path: str | None = None) -> None:
    """Append to the results table (created when needed), in its fixed schema."""
    rows = results.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in QA_RESULTS])
    writer = rows.write.mode("append")
    if table is not None:
        writer.saveAsTable(table)
    else:
        writer.parquet(path)


def latest_results(results: DataFrame, n: int = 100) -> DataFrame:
    """Latest results, newest run first."""
    return results.orderBy(F.desc("run_ts"), F.asc("query_id")).limit(n)


def save_plan(plan: DataFrame, table: str | None = None, path: str | None = None) -> None:
    """Replace the plan table."""
    writer = plan.select(*PLAN.names).write.mode("overwrite")
    if table is not None:
        writer.saveAsTable(table)
    else:
        writer.parquet(path)


def run_prefix(base: str, kind: str, run_ts: datetime) -> str:
    """Folder of one run: base, kind of output, date and time."""
    return f"{base.rstrip('/')}/{kind}/{run_ts:%Y/%m/%d/%H%M%S}"


def written_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files of an extract."""
    return sorted(spark.read.parquet(path).inputFiles())
