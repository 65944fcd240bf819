"""Extracts: every row as text with change metadata, a global row number and a batch number."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableqa.functions.names import col_of, snake_columns
from tableqa.functions.values import normalized_value, text_value
from tableqa.operators.changes import net_changes
from tableqa.operators.numbering import ROWS_PER_BUCKET, number_rows
from tableqa.schemas import EXTRACT_METADATA
from tableqa.sources.tables import stage

BATCH_SIZE = 50_000
BATCH_ID = "batch_id"
VERSION, OPERATION, INGESTED, ROW_NUMBER = EXTRACT_METADATA
INSERTED = "I"  # operation code that a full extract writes (fixed value)
MODES = ("full", "change_tracking")


def change_count(changes: DataFrame) -> DataFrame:
    return changes.agg(F.count(F.lit(1)).alias("total_rows"))


def high_water_mark(df: DataFrame | None, column: str = VERSION) -> int:
    """Highest change version of a table, 0 where there is no table, no column or no version.

    Extracts keep the version as text, so it is compared as a number.
    """
    if df is None or column not in df.columns:
        return 0
    return high_water_mark_row(df, column).first()[0]


def table_high_water_mark(spark: SparkSession, table: str, column: str = VERSION) -> int:
    """The same for a catalog table that may not exist yet."""
    return high_water_mark(spark.table(table), column) if spark.catalog.tableExists(table) else 0


def high_water_mark_row(df: DataFrame, column: str = VERSION) -> DataFrame:
    version = col_of(column).try_cast("bigint")
    return df.agg(F.coalesce(F.max(version), F.lit(0).cast("bigint")).alias("max_version"))


def target_name(database: str, schema: str, table: str) -> str:
    """Name of the table an extract is loaded to."""
    return "_".join((database, schema, table)).lower()


def batch_of(row_number: Column, batch_size: int) -> Column:
    """Batch of a row number, from 0."""
    return F.call_function("div", row_number - 1, F.lit(batch_size))


def batch_page(
    df: DataFrame, start: int, end: int, row_number: str = ROW_NUMBER, batch_size: int | None = None
) -> DataFrame:
    """Rows number `start` to `end` of an extract. The number is text there and compared as a number.

    `batch_size` is that of the extract: whole batches are then chosen by their number first, a filter that reaches the
    files of a written extract.
    """
    if batch_size is not None:
        df = df.filter(col_of(BATCH_ID).between((start - 1) // batch_size, (end - 1) // batch_size))
    return df.filter(col_of(row_number).cast("bigint").between(start, end))


def batch_sizes(df: DataFrame, batch_size: int = BATCH_SIZE, row_number: str = ROW_NUMBER) -> DataFrame:
    """Rows, first and last number of every batch."""
    number = col_of(row_number).cast("bigint")
    return (
        df.select(number.alias("n"))
        .groupBy(batch_of(F.col("n"), batch_size).alias(BATCH_ID))
        .agg(F.count(F.lit(1)).alias("row_count"), F.min("n").alias("first_rn"), F.max("n").alias("last_rn"))
    )


def _value(field: T.StructField, as_text: bool) -> Column:
    value = col_of(field.name)
    if as_text and not isinstance(field.dataType, T.BinaryType):
        return text_value(value, field.dataType)
    return normalized_value(value, field.dataType)


def _finish(df: DataFrame, run_ts: datetime, batch_size: int | None, as_text: bool) -> DataFrame:
    """Values, then the metadata columns as text, then the batch number; names in snake_case."""
    values = [_value(f, as_text).alias(f.name) for f in df.schema if f.name not in EXTRACT_METADATA]
    df = df.withColumn(INGESTED, F.lit(run_ts.isoformat()))
    metadata = [col_of(c).cast("string").alias(c) for c in EXTRACT_METADATA]
    batch = [] if batch_size is None else [batch_of(F.col(ROW_NUMBER), batch_size).alias(BATCH_ID)]
    return snake_columns(df.select(*values, *metadata, *batch))


def full_extract(
    df: DataFrame,
    primary_key: str,
    run_ts: datetime,
    version: int = 0,
    batch_size: int | None = BATCH_SIZE,
    as_text: bool = True,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Every row of a table, numbered in key order; `version` is the highest change version at the time."""
    numbered = number_rows(df, primary_key, ROW_NUMBER, rows_per_bucket)
    numbered = numbered.withColumn(VERSION, F.lit(version)).withColumn(OPERATION, F.lit(INSERTED))
    return _finish(numbered, run_ts, batch_size, as_text)


def changed_rows(
    changes: DataFrame, base: DataFrame, primary_key: str, min_version: int = 0, keep_null_pk: bool = False, net: bool = False
) -> DataFrame:
    """Changes newer than a version with the current row of their key; a deleted key has no row.

    The key is taken from the change, so it is known for deleted rows too; `keep_null_pk` takes it from the row. A raw
    feed, which may hold several changes of a key, is folded first with `net`: one row for each key, none for keys that
    came and went.

    The base is first reduced to the keys of the feed by a semi join, whose small side Spark may broadcast by its own
    size check, so a few changes do not shuffle the whole base.
    """
    newer = net_changes(changes, primary_key, min_version) if net else changes.filter(col_of(VERSION) > min_version)
    feed = newer.select(col_of(primary_key).alias("__feed_key"), VERSION, OPERATION)
    keys = feed.select(F.col("__feed_key").alias("__wanted_key")).distinct()
    reduced = base.join(keys, col_of(primary_key) == F.col("__wanted_key"), "left_semi")
    joined = feed.join(reduced, F.col("__feed_key") == col_of(primary_key), "left")
    key = col_of(primary_key) if keep_null_pk else F.col("__feed_key")
    columns = [key.alias(primary_key) if c == primary_key else col_of(c) for c in base.columns]
    return joined.select(*columns, VERSION, OPERATION)


def change_extract(
    changes: DataFrame,
    base: DataFrame,
    primary_key: str,
    run_ts: datetime,
    min_version: int = 0,
    batch_size: int | None = BATCH_SIZE,
    as_text: bool = True,
    keep_null_pk: bool = False,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    net: bool = False,
) -> DataFrame:
    """Changed rows, numbered in key order. The join is staged once, because numbering reads it several times."""
    joined = stage(changed_rows(changes, base, primary_key, min_version, keep_null_pk, net), "changes")
    return _finish(number_rows(joined, primary_key, ROW_NUMBER, rows_per_bucket), run_ts, batch_size, as_text)


def extract(
    df: DataFrame,
    primary_key: str,
    run_ts: datetime,
    mode: str = "full",
    reload: bool = False,
    changes: DataFrame | None = None,
    min_version: int = 0,
    **options,
) -> DataFrame:
    """Full extract, or the tracked changes since a version; `reload` always takes the whole table."""
    mode = mode.lower()
    if not reload and mode not in MODES:
        raise ValueError(f"unsupported extraction mode {mode!r}, use one of {MODES}")
    if reload or mode == "full":
        for option in ("keep_null_pk", "net"):
            options.pop(option, None)
        return full_extract(df, primary_key, run_ts, version=high_water_mark(changes), **options)
    if changes is None:
        raise ValueError("change tracking needs a change feed")
    return change_extract(changes, df, primary_key, run_ts, min_version, **options)
