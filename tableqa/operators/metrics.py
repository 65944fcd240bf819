"""Metrics of both sides as (key, value) rows: expected from check results, observed from the written data."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors.exceptions.captured import CapturedException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableqa.functions.names import (
    COUNT_CHECK,
    DUPLICATES_CHECK,
    NULLS_CHECK,
    col_of,
    nulls_check_column,
    nulls_key,
    nulls_key_from_alias,
    snake_name,
)
from tableqa.functions.values import safe_int
from tableqa.operators.checks import counts_long, duplicate_excess
from tableqa.schemas import EXTRACT_METADATA, METRIC

log = logging.getLogger(__name__)

MISSING_STATISTICS = "aggregatePushdown"  # the setting that Spark's error names when a footer lacks statistics

# Result columns that may hold a row count (fixed values).
COUNT_NAMES = ("total_rows", "count", "cnt")


@dataclass(frozen=True)
class NeededChecks:
    """Which metrics to compute. `nulls` is None for none, "all", or a set of snake_case column names."""

    count_total_rows: bool = False
    nulls: str | frozenset[str] | None = None
    duplicates: bool = False
    primary_key: tuple[str, ...] = ()


def needed_checks(check_types: list[str], primary_key: str | list[str] | None = None) -> NeededChecks:
    """What a plan asks for, from its check types."""
    prefix = NULLS_CHECK + "|"
    kinds = {c.lower() for c in check_types}
    listed = frozenset(snake_name(c[len(prefix):]) for c in check_types if c.lower().startswith(prefix))
    names = [primary_key] if isinstance(primary_key, str) else list(primary_key or [])
    return NeededChecks(
        count_total_rows=COUNT_CHECK in kinds,
        nulls="all" if NULLS_CHECK in kinds else (listed or None),
        duplicates=DUPLICATES_CHECK in kinds and bool(names),
        primary_key=tuple(snake_name(n) for n in names),
    )


def counts_from_footers(spark: SparkSession, path: str, columns: list[str], count_rows: bool = True) -> DataFrame:
    """Row count and null counts of Parquet files from the statistics in their footers, without reading a column.

    The aggregate is pushed into the scan by the Parquet source of a session of its own, so the settings of the
    caller's session stay as they are. Files without statistics make the query fail.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    files = session.read.parquet(path)
    counts = files.agg(F.count(F.lit(1)), *[F.count(col_of(c)) for c in columns]).first()
    rows = [(f"{NULLS_CHECK}|{snake_name(c)}", counts[0] - n) for c, n in zip(columns, counts[1:])]
    if count_rows:
        rows.insert(0, (COUNT_CHECK, counts[0]))
    return spark.createDataFrame(rows, METRIC)


def _counts(df: DataFrame, columns: list[str], count_rows: bool, keys: list[Column], footers_of: str | None) -> DataFrame:
    if footers_of is not None:
        # Statistics count the values of a flat column; nested ones are read.
        flat = [f.name for f in df.schema if f.name in columns and isinstance(f.dataType, T.AtomicType)]
        nested = [c for c in columns if c not in flat]
        try:
            counts = counts_from_footers(df.sparkSession, footers_of, flat, count_rows)
            return counts.unionByName(counts_long(df, nested, False)) if nested else counts
        except (Py4JJavaError, CapturedException) as error:
            if MISSING_STATISTICS not in str(error):
                raise
            log.warning("no statistics in the footers of %s, reading the columns", footers_of)
    return counts_long(df, columns, count_rows, keys)


def observed_metrics(
    df: DataFrame,
    needed: NeededChecks,
    per_file: bool = False,
    exclude: tuple[str, ...] = (*EXTRACT_METADATA, "batch_id"),
    footers_of: str | None = None,
    per: tuple[str, ...] = (),
) -> DataFrame:
    """Metrics of a table, of every file it was read from, or of every part: the rows that agree in the columns `per`,
    which are not measured. The partition columns of a table tell its folders apart, however many files they hold.

    Wanted columns that the table lacks give no row. Counts need no shuffle; duplicates read the key alone.
    `footers_of` is the Parquet folder that `df` reads in full: counts then come from its footers.
    """
    if (per_file or per) and footers_of is not None:
        raise ValueError("footers give counts of the whole folder, not of every file or part")
    if per_file and per:
        raise ValueError("metrics are of every file or of every part, not both")
    shards = ("file_path",) if per_file else per
    keys = [F.col("_metadata.file_path").alias("file_path")] if per_file else [col_of(c) for c in per]
    present = [c for c in df.columns if c not in exclude and c not in per]
    if needed.nulls == "all":
        columns = present
    else:
        columns = [c for c in present if snake_name(c) in (needed.nulls or ())]
    parts = []
    if needed.count_total_rows or columns:
        parts.append(_counts(df, columns, needed.count_total_rows, keys, footers_of))
    key_columns = [c for k in needed.primary_key for c in df.columns if snake_name(c) == k]
    if needed.duplicates and len(key_columns) == len(needed.primary_key):
        excess = duplicate_excess(df, key_columns, keys)
        named = [F.col(f"__per_{i}").alias(n) for i, n in enumerate(shards)]
        parts.append(excess.select(*named, F.lit(DUPLICATES_CHECK).alias("key"), F.col("excess_rows").alias("value")))
    if not parts:
        named = [T.StructField("file_path", T.StringType())] if per_file else [df.schema[c] for c in per]
        return df.sparkSession.createDataFrame([], T.StructType([*named, *METRIC]))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def sum_metrics(metrics: DataFrame) -> DataFrame:
    """Sum per key over files or other parts; values may be text."""
    return metrics.groupBy("key").agg(F.sum(safe_int(F.col("value"))).alias("value"))


def metric_map(metrics: DataFrame) -> DataFrame:
    """All metrics as one map. Metric tables have a row per column of a table, not per row."""
    return metrics.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("key", "value")))).alias("metrics"))


def _records(value: Column) -> Column:
    """Rows of a tabular result from its JSON text, one map per row; NULL for a scalar."""
    is_list = F.ltrim(value).startswith("[")
    is_object = F.ltrim(value).startswith("{")
    text = F.when(is_list, value).when(is_object, F.concat(F.lit("["), value, F.lit("]")))
    return F.from_json(text, "array<map<string,string>>")


def _row_excess(record: Column) -> Column:
    """Rows beyond the first of one duplicate group."""
    return F.greatest(safe_int(F.coalesce(record["cnt"], record["count"])) - 1, F.lit(0))


def expected_metrics(results: DataFrame, keep: str = "first") -> DataFrame:
    """(key, value) rows of check results with columns query_id, check_type, status and value.

    `value` is a plain scalar or the JSON of the result rows. A failed check gives a NULL value. Where the results
    carry `excess_rows` (taken from all rows of a result), it is used for duplicates instead of the stored rows.
    Check types without a metric are left out. `keep` says which query wins where two give the same key.
    """
    kind = F.lower(F.col("check_type"))
    scalar = F.when(F.col("__records").isNull(), safe_int(F.col("value")))
    first = F.get(F.col("__records"), F.lit(0))

    total = F.coalesce(
        scalar,
        safe_int(F.get(F.map_values(F.map_filter(first, lambda k, _: F.lower(k).isin(*COUNT_NAMES))), F.lit(0))),
    )
    stored = F.aggregate(F.col("__records"), F.lit(0).cast("bigint"), lambda acc, r: acc + _row_excess(r))
    excess = F.coalesce(stored, scalar)
    if "excess_rows" in results.columns:
        excess = F.coalesce(F.col("excess_rows"), excess)

    def entry(key: Column, value: Column) -> Column:
        return F.array(F.struct(key.alias("key"), value.cast("bigint").alias("value")))

    wide = F.transform(
        F.filter(F.map_entries(first), lambda e: nulls_key_from_alias(e["key"]).isNotNull()),
        lambda e: F.struct(nulls_key_from_alias(e["key"]).alias("key"), safe_int(e["value"]).alias("value")),
    )
    named = nulls_check_column(F.col("check_type"))
    one = F.coalesce(scalar, safe_int(F.get(F.map_values(first), F.lit(0))))
    ok = F.col("status").isin("OK", "SUCCESS")
    metrics = (
        F.when(kind == COUNT_CHECK, entry(F.lit(COUNT_CHECK), F.when(ok, total)))
        .when(kind == DUPLICATES_CHECK, entry(F.lit(DUPLICATES_CHECK), F.when(ok, excess)))
        .when((kind == NULLS_CHECK) & ok, wide)
        .when(named.isNotNull(), entry(nulls_key(named), F.when(ok, one)))
    )
    long = results.withColumn("__records", _records(F.col("value"))).select("query_id", F.inline(metrics))
    pick = {"first": F.min_by, "last": F.max_by}[keep]
    return long.groupBy("key").agg(pick("value", "query_id").alias("value"))
