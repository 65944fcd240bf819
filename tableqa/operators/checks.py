"""The checks as DataFrame operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableqa.functions.names import COUNT_CHECK, NULLS_ALIAS, NULLS_CHECK, col_of, snake_name

COLUMNS_PER_AGGREGATE = 200  # wider tables are counted in several aggregates, each reading its own columns
TOP_VALUES = 10


def count_total_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_rows"))


def null_count(column: str) -> Column:
    """NULLs of a column; 0 for an empty table."""
    return F.count_if(col_of(column).isNull())


def nulls_wide(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row with `nulls_<col>` for every column."""
    names = df.columns if columns is None else columns
    return df.agg(*[null_count(c).alias(NULLS_ALIAS + c) for c in names])


def nulls_one_column(df: DataFrame, column: str) -> DataFrame:
    return nulls_wide(df, [column])


def counts_long(
    df: DataFrame,
    columns: list[str],
    count_rows: bool,
    keys: list[Column] | None = None,
) -> DataFrame:
    """Row count and null counts as (key, value) rows, in one pass per group of columns."""
    groups = [columns[i : i + COLUMNS_PER_AGGREGATE] for i in range(0, len(columns), COLUMNS_PER_AGGREGATE)] or [[]]
    parts = []
    for i, group in enumerate(groups):
        metrics = [
            F.struct(F.lit(f"{NULLS_CHECK}|{snake_name(c)}").alias("key"), null_count(c).alias("value")) for c in group
        ]
        if count_rows and i == 0:
            metrics.insert(0, F.struct(F.lit(COUNT_CHECK).alias("key"), F.count(F.lit(1)).alias("value")))
        if metrics:
            grouped = df.groupBy(*(keys or [])).agg(F.array(*metrics).alias("metrics"))
            parts.append(grouped.select(*[c for c in grouped.columns if c != "metrics"], F.inline("metrics")))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def nulls_long(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One (key, value) row for every column."""
    return counts_long(df, df.columns if columns is None else columns, count_rows=False)


def _names(key: str | list[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def duplicate_keys(df: DataFrame, key: str | list[str]) -> DataFrame:
    """Keys of more than one row with their count; NULL keys count as equal."""
    return df.groupBy(*[col_of(c) for c in _names(key)]).agg(F.count(F.lit(1)).alias("cnt")).filter("cnt > 1")


def duplicate_excess(df: DataFrame, key: str | list[str], per: list[Column] | None = None) -> DataFrame:
    """Rows beyond the first of every key, over the whole table or (`per`) inside every file or other group.

    Counting per key combines map-side, so a key of very many rows costs one row per task in the shuffle.
    """
    per = per or []
    names = [f"__per_{i}" for i in range(len(per))]
    counted = (
        df.groupBy(*[p.alias(n) for p, n in zip(per, names)], *[col_of(c) for c in _names(key)])
        .agg(F.count(F.lit(1)).alias("__cnt"))
        .groupBy(*names)
        .agg(F.coalesce(F.sum(F.col("__cnt") - 1), F.lit(0)).cast("bigint").alias("excess_rows"))
    )
    return counted


def value_distribution(df: DataFrame, column: str, n: int = TOP_VALUES) -> DataFrame:
    """Most frequent values with their frequency, ties in value order."""
    value = col_of(column)
    counted = df.groupBy(value).agg(F.count(F.lit(1)).alias("freq"))
    return counted.orderBy(F.desc("freq"), value.asc_nulls_first()).limit(n)
