"""Comparing expected with observed metrics, and whole tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableqa.functions.hashing import row_digest, row_hash
from tableqa.functions.names import HASH_CHECK, VALUE_DIST_PREFIX, col_of, snake_name
from tableqa.functions.values import safe_int, text_value
from tableqa.operators.locate import compare_digests, compare_ordered, same_columns
from tableqa.schemas import EQUALITY


def compare_metrics(
    expected: DataFrame,
    observed: DataFrame,
    run_ts: datetime,
    tolerance: float = 0.0,
    lenient: bool = False,
    only_failures: bool = False,
) -> DataFrame:
    """One alert per key of either side.

    A missing or NULL value is MISSING_BOTH, MISSING_SQL (no expected) or MISSING_PARQUET (no observed). Numbers
    agree within an absolute tolerance, other values exactly; `lenient` reads text as numbers on both sides. Where one
    side has numbers and the other text, both are compared as text.
    """
    sides = {"expected": expected, "observed": observed}
    if lenient:
        value = F.when(F.col("value").isNotNull(), safe_int(F.col("value")))
        sides = {n: d.withColumn("value", value) for n, d in sides.items()}
    numeric = all(dict(d.dtypes)["value"] not in ("string", "boolean") for d in sides.values())
    if len({dict(d.dtypes)["value"] for d in sides.values()}) > 1 and not numeric:
        sides = {n: d.withColumn("value", F.col("value").cast("string")) for n, d in sides.items()}
    left, right = (d.select("key", F.col("value").alias(n)) for n, d in sides.items())
    exp, obs = F.col("expected"), F.col("observed")
    differs = F.abs(exp.cast("double") - obs.cast("double")) > tolerance if numeric and tolerance else exp != obs
    status = (
        F.when(exp.isNull() & obs.isNull(), "MISSING_BOTH")
        .when(exp.isNull(), "MISSING_SQL")
        .when(obs.isNull(), "MISSING_PARQUET")
        .when(differs, "MISMATCH")
        .otherwise("OK")
    )
    alerts = left.join(right, "key", "full_outer").select(
        "key", status.alias("status"), "expected", "observed", F.lit(run_ts).alias("evaluated_at_utc")
    )
    return alerts.filter("status <> 'OK'") if only_failures else alerts


def _totals() -> list[Column]:
    return [
        F.coalesce(F.sum("__sql"), F.lit(0)).alias("row_count_sql"),
        F.coalesce(F.sum("__bq"), F.lit(0)).alias("row_count_bq"),
    ]


def compare_tables(expected: DataFrame, observed: DataFrame, by: str = "digest", ordered_by: str | None = None) -> DataFrame:
    """One row: status PASS or FAIL, and the row count of both sides.

    Two tables are equal when names, types and order of their columns agree and every row occurs equally often in
    both; row order plays no part, NULL equals NULL and NaN equals NaN. Rows are counted per 128-bit digest of the
    whole row, so the shuffle moves four numbers per distinct row whatever the row width, and copies are combined
    before it. `by="columns"` groups by the columns themselves instead, for a result that rests on no hash.
    `by="sums"` compares one order-free digest of each table, which shuffles no row at all.

    With `ordered_by` the tables are compared in the order of that column on either side, position by position.
    """
    if ordered_by is not None:
        return compare_ordered(expected, observed, ordered_by).drop("first_difference")
    if by == "sums":
        return compare_digests(expected, observed)
    if not same_columns(expected, observed):
        sides = expected.select(F.lit(1).alias("__sql"), F.lit(0).alias("__bq"))
        totals = sides.union(observed.select(F.lit(0), F.lit(1))).agg(*_totals())
        return totals.select(F.lit("FAIL").alias("status"), "row_count_sql", "row_count_bq")

    if by not in ("digest", "columns"):
        raise ValueError(f"unknown comparison: {by!r}")
    if by == "digest":
        keys = [d.alias(f"__digest_{i}") for i, d in enumerate(row_digest(expected.schema))]
    else:
        keys = [col_of(c) for c in expected.columns]
    sides = expected.select(*keys, F.lit(1).alias("__sql"), F.lit(0).alias("__bq")).union(
        observed.select(*keys, F.lit(0), F.lit(1))
    )
    names = [c for c in sides.columns if c not in ("__sql", "__bq")]
    per_row = sides.groupBy(*[col_of(c) for c in names]).agg(F.sum("__sql").alias("__sql"), F.sum("__bq").alias("__bq"))
    totals = per_row.agg(*_totals(), F.count_if(F.col("__sql") != F.col("__bq")).alias("__unequal"))
    status = F.when(F.col("__unequal") == 0, "PASS").otherwise("FAIL")
    return totals.select(status.alias("status"), "row_count_sql", "row_count_bq")


def compare_content(source: DataFrame, landed: DataFrame, distributions: tuple[str, ...] = ()) -> DataFrame:
    """Whether an extract holds the rows of its source: one row for the row hashes, one for each listed column.

    Row hashes cover the columns of the source as text, in their order, and are compared with their counts; the values
    of a listed column are compared with their frequencies. `expected` and `observed` are the rows of either side,
    `differing` sums up by how much the counts of hashes or values differ. Names in the extract are in snake_case.
    """
    names = [snake_name(c) for c in source.columns]

    def counted(df: DataFrame, value: Column, side: str, kind: str) -> DataFrame:
        n = {s: F.count(F.lit(1)) if s == side else F.lit(0).cast("bigint") for s in ("expected", "observed")}
        return df.groupBy(value.alias("value")).agg(*[c.alias(s) for s, c in n.items()]).withColumn("key", F.lit(kind))

    def text(df: DataFrame, column: str) -> Column:
        return text_value(col_of(column), df.schema[column].dataType)

    parts = [
        counted(source, row_hash(source), "expected", HASH_CHECK), counted(landed, row_hash(landed, names), "observed", HASH_CHECK),
    ]
    for column in distributions:
        kind = VALUE_DIST_PREFIX + snake_name(column)
        parts += [
            counted(source, text(source, column), "expected", kind), counted(landed, text(landed, snake_name(column)), "observed", kind),
        ]
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part)
    values = both.groupBy("key", "value").agg(F.sum("expected").alias("expected"), F.sum("observed").alias("observed"))
    totals = values.groupBy("key").agg(
        F.sum("expected").alias("expected"), F.sum("observed").alias("observed"),
        F.sum(F.abs(F.col("expected") - F.col("observed"))).alias("differing"),
    )
    return totals.select("key", F.when(F.col("differing") == 0, "OK").otherwise("MISMATCH").alias("status"), "expected", "observed", "differing")


def equality_result(outcome: DataFrame, check: dict, output_path: str, error: str | None = None) -> DataFrame:
    """Outcome of a comparison with the identity of its check, in the fixed schema."""
    columns = {n: F.lit(check.get(n)) for n in EQUALITY.names} | {
        "status": F.col("status"),
        "row_count_sql": F.col("row_count_sql"),
        "row_count_bq": F.col("row_count_bq"),
        "output_path": F.lit(output_path),
        "error_message": F.lit(error),
    }
    return outcome.select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in EQUALITY])
