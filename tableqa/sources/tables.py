"""Tables as DataFrames: catalog tables, SQL, Parquet, literal rows, column catalogs, staged tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableqa.functions.names import col_of
from tableqa.schemas import COLUMN_CATALOG


def read_source(spark: SparkSession, table: str | None = None, query: str | None = None) -> DataFrame:
    """A whole table, or the result of a query that overrides it."""
    if query:
        return spark.sql(query)
    if table:
        return spark.table(table)
    raise ValueError("give a table or a query")


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def rows_to_df(spark: SparkSession, rows: Iterable, schema: T.StructType | str) -> DataFrame:
    """Bounded in-memory rows."""
    return spark.createDataFrame(list(rows), schema)


def first_rows(df: DataFrame, n: int = 100, order_by: str | list[str] | None = None) -> DataFrame:
    """First rows of a table, of a defined order where one is given."""
    if order_by is not None:
        names = [order_by] if isinstance(order_by, str) else order_by
        df = df.orderBy(*[col_of(c) for c in names])
    return df.limit(n)


def column_metadata(
    spark: SparkSession, tables: dict[str, DataFrame], catalog: str = "spark_catalog", schema: str = "default",
    data_types: bool = False,
) -> DataFrame:
    """Column catalog of named DataFrames, read from their schemas, with the types of the columns if wanted."""
    rows = [
        (catalog, schema, table, name, position, kind)
        for table, df in tables.items()
        for position, (name, kind) in enumerate(df.dtypes, start=1)
    ]
    typed = spark.createDataFrame(rows, T.StructType([*COLUMN_CATALOG, T.StructField("data_type", T.StringType())]))
    return typed if data_types else typed.select(*COLUMN_CATALOG.names)


def column_types(catalog: DataFrame, table: str) -> dict[str, str]:
    """Types of one table's columns from a catalog that has them, as `cast_unsupported` takes them."""
    return {r.column_name: r.data_type for r in catalog.where(F.col("table_name") == table).select("column_name", "data_type").collect()}


def read_column_catalog(spark: SparkSession, table: str) -> DataFrame:
    """Column catalog kept as a table; the ordinal is taken along where the table has one."""
    df = spark.table(table)
    return df.select(*[c for c in (*COLUMN_CATALOG.names, "data_type") if c in df.columns])


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the folder of spark.checkpoint.dir, which all executors share, or where that is unset under
    the one that was given to setCheckpointDir."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root.rstrip('/')}/tableqa_{name}_{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "stage", path: str | None = None) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage, survives lost executors, and makes a live or
    costly input safe to read several times. Who gives the `path` may remove it afterwards."""
    path = path or staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
