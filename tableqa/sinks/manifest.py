"""Extracts with a manifest: a table of their files, committed last.

Files hold runs of `chunk_size` consecutive row numbers. The manifest lists each with its bytes, rows, and first and last
row number; a page of row numbers opens only the files that hold it. Readers see nothing but what a manifest lists, so
a write that failed half-way, or is still under way, does not exist for them, and the extract can be written again.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableqa.functions.names import col_of
from tableqa.schemas import EXTRACT_METADATA
from tableqa.sinks.writers import CHUNK_SIZE, remove_folder, write_extract

ROW_NUMBER = EXTRACT_METADATA[3]
MANIFEST = "manifest"


def _folder(path: str) -> str:
    return f"{path.rstrip('/')}/{MANIFEST}"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """file, bytes, row_count, first_rn, last_rn of every file of a finished extract."""
    try:
        return spark.read.parquet(_folder(path))
    except AnalysisException as error:
        raise ValueError(f"no finished extract in {path}") from error


def is_finished(spark: SparkSession, path: str) -> bool:
    try:
        return not read_manifest(spark, path).isEmpty()
    except ValueError:
        return False


def describe_files(spark: SparkSession, folder: str, row_number: str = ROW_NUMBER) -> DataFrame:
    """Manifest rows of written files: one pass over the row numbers alone."""
    number = col_of(row_number).cast("bigint")
    read = spark.read.parquet(folder).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"), number.alias("n")
    )
    return read.groupBy("file", "bytes").agg(F.count(F.lit(1)).alias("row_count"), F.min("n").alias("first_rn"), F.max("n").alias("last_rn"))


def write_numbered(df: DataFrame, path: str, chunk_size: int = CHUNK_SIZE, row_number: str = ROW_NUMBER) -> DataFrame:
    """Writes a numbered extract and its manifest; returns the manifest.

    Rows are dealt by the run of numbers they belong to and written in order, so every file but the last has exactly
    `chunk_size` rows. The row numbers must be 1 to the number of rows, which is checked on the files before the
    manifest is written. A folder with a manifest is not written again.
    """
    spark = df.sparkSession
    if is_finished(spark, path):
        raise ValueError(f"{path} already holds a finished extract")
    number = col_of(row_number).cast("bigint")
    data = f"{path.rstrip('/')}/data_{uuid.uuid4().hex}"
    dealt = df.repartition(F.call_function("div", number - 1, F.lit(chunk_size))).sortWithinPartitions(number)
    try:
        write_extract(dealt, data, chunk_size)
        files = describe_files(spark, data, row_number).orderBy("first_rn").coalesce(1)
        total = files.agg(F.sum("row_count").alias("n"), F.min("first_rn").alias("low"), F.max("last_rn").alias("high")).first()
        overlaps = files.where(F.col("last_rn") - F.col("first_rn") + 1 != F.col("row_count"))
        if total.n and ((total.low, total.high) != (1, total.n) or not overlaps.isEmpty()):
            raise ValueError(f"row numbers run from {total.low} to {total.high} for {total.n} rows")
        # one file, moved into place at the end: there is a whole manifest or none
        files.write.mode("overwrite").parquet(_folder(path))
    except Exception:
        remove_folder(spark, data)
        raise
    return read_manifest(spark, path)


def numbered_page(spark: SparkSession, path: str, start: int, end: int, row_number: str = ROW_NUMBER) -> DataFrame:
    """Rows number `start` to `end` of a finished extract, from the files that hold them."""
    listed = read_manifest(spark, path)
    held = listed.where((F.col("first_rn") <= end) & (F.col("last_rn") >= start)).orderBy("first_rn").collect()  # files of this page
    if not held:
        first = listed.orderBy("first_rn").limit(1).collect()
        if not first:
            raise ValueError(f"the extract in {path} has no rows")
        return spark.read.parquet(first[0]["file"]).where(F.lit(False))
    number = col_of(row_number).cast("bigint")
    return spark.read.parquet(*[r["file"] for r in held]).where(number.between(start, end))
