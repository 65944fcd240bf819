"""Running a plan: every check is a Spark query; what comes back to the driver is one small row per check."""

from __future__ import annotations

import logging
from collections import defaultdict
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableqa.functions.names import DUPLICATES_CHECK, col_of
from tableqa.functions.values import safe_int, text_value
from tableqa.operators.metrics import COUNT_NAMES
from tableqa.plans.build import SCALAR, TABLE
from tableqa.sources.tables import staging_path
from tableqa.schemas import CHECK_RESULTS, QA_RESULTS

log = logging.getLogger(__name__)

CONCURRENT_QUERIES = 4
FUSED_QUERIES = 100  # checks of one table that share a query
KEEP_NULLS = {"ignoreNullFields": "false"}


def _as_json(df: DataFrame):
    return F.to_json(F.struct(*[col_of(c) for c in df.columns]), KEEP_NULLS)


def run_check(result: DataFrame, check_type: str = "", scalar: bool = False, land: str | None = None) -> dict:
    """Value, row count and excess of one check. The result is computed once.

    Of a `scalar` check, one row of one column is kept as its text and one row of several columns as JSON. All rows of
    any other result are written as Parquet to `land` by the executors and counted there; the value is that folder.
    Without rows the value is NULL.
    """
    if scalar:
        text = text_value(col_of(result.columns[0]), result.schema[0].dataType)
        head = result.select(text.alias("t"), _as_json(result).alias("j")).limit(2).collect()
        if len(head) < 2:
            single = [r.t if len(result.columns) == 1 else f"[{r.j}]" for r in head]
            return {"value": single[0] if head else None, "rowcount": len(head), "excess_rows": None}
    land = land or staging_path(result.sparkSession, "result")
    result.write.parquet(land)
    landed = result.sparkSession.read.schema(result.schema).parquet(land)
    counts = [c for c in result.columns if c.lower() in COUNT_NAMES]
    is_duplicates = check_type.lower() == DUPLICATES_CHECK and bool(counts)
    beyond = F.greatest(safe_int(col_of(counts[0])) - 1, F.lit(0)) if is_duplicates else F.lit(0)
    rowcount, excess = landed.agg(F.count(F.lit(1)), F.coalesce(F.sum(beyond), F.lit(0))).first()
    return {"value": land if rowcount else None, "rowcount": rowcount, "excess_rows": excess if is_duplicates else None}


def _run_fused(spark: SparkSession, checks: list[Row]) -> list[dict]:
    """All single-row checks of one table as scalar subqueries, which the optimizer merges into one scan."""
    texts = [c.query_text.strip().rstrip(";") for c in checks]
    columns = [f"(SELECT struct(*) FROM ({t})) AS r{i}" for i, t in enumerate(texts)]
    fused = spark.sql("SELECT " + ", ".join(columns))

    def outcome(field: T.StructField) -> Column:
        row, inner = F.col(field.name), field.dataType.fields
        value = text_value(row.getField(inner[0].name), inner[0].dataType)
        if len(inner) > 1:
            value = F.concat(F.lit("["), F.to_json(row, KEEP_NULLS), F.lit("]"))
        return F.struct(value.alias("value"), row.isNotNull().cast("int").alias("rowcount")).alias(field.name)

    return [o.asDict() for o in fused.select(*[outcome(f) for f in fused.schema]).first()]


def run_plan(
    spark: SparkSession,
    plan: DataFrame | Iterable[Row],
    run_ts: datetime,
    runner: Callable[[str], DataFrame] | None = None,
    fuse: bool = True,
    results_folder: str | None = None,
) -> DataFrame:
    """Run the checks of a plan and return one result row each, status OK or ERROR.

    `runner` turns a query text into a DataFrame: Spark SQL by default, a JDBC read for texts in the dialect of a
    server. An error is kept in the row of its check and does not stop the others. Results of several rows are written
    below `results_folder`, by default a fresh folder of the shared one.
    """
    landing = results_folder or staging_path(spark, "results")
    checks = plan.orderBy("query_id").collect() if isinstance(plan, DataFrame) else list(plan)
    outcomes: dict[int, dict] = {}

    def run_one(i: int) -> tuple[int, dict]:
        try:
            result = (runner or spark.sql)(checks[i].query_text.strip().rstrip(";"))
            scalar = checks[i].expected_output_format == SCALAR
            return i, {"status": "OK", **run_check(result, checks[i].check_type, scalar, f"{landing}/{i}")}
        except Exception as error:  # any failure of a check is a result
            return i, {"status": "ERROR", "error": str(error)}

    def run_group(group: list[int]) -> list[tuple[int, dict]]:
        if len(group) > 1:
            try:
                fused = _run_fused(spark, [checks[i] for i in group])
                return [(i, {"status": "OK", **o}) for i, o in zip(group, fused)]
            except Exception as error:  # halve the group until the failing checks are alone
                log.info("checks run in halves after %s", type(error).__name__)
                middle = len(group) // 2
                return run_group(group[:middle]) + run_group(group[middle:])
        return [run_one(i) for i in group]

    tables = defaultdict(list)
    groups = []
    for i, check in enumerate(checks):
        if fuse and runner is None and check.expected_output_format == SCALAR:
            tables[tuple(check[c] for c in TABLE)].append(i)
        else:
            groups.append([i])
    groups += [g[n : n + FUSED_QUERIES] for g in tables.values() for n in range(0, len(g), FUSED_QUERIES)]
    with ThreadPoolExecutor(CONCURRENT_QUERIES) as pool:
        for done in pool.map(run_group, groups):
            outcomes.update(done)

    rows = [
        tuple(
            {**c.asDict(), **outcomes[i], "executed_at_utc": run_ts}.get(name) for name in CHECK_RESULTS.names
        )
        for i, c in enumerate(checks)
    ]
    return spark.createDataFrame(rows, CHECK_RESULTS)


def attach_path(rows: DataFrame, parquet_path: str | None) -> DataFrame:
    """The path of the written extract on every plan or result row; NULL where nothing was written."""
    return rows.withColumn("parquet_path", F.lit(parquet_path).cast("string"))


def qa_results(results: DataFrame, run_ts: datetime, parquet_path: str | None = None) -> DataFrame:
    """Check results in the schema of the results table, status SUCCESS or ERROR."""
    rows = attach_path(results, parquet_path).select(
        F.lit(run_ts).alias("run_ts"),
        *[c for c in QA_RESULTS.names if c in results.columns and c not in ("run_ts", "status", "parquet_path", "rowcount")],
        "parquet_path",
        F.coalesce("rowcount", F.lit(0)).alias("rowcount"),
        F.col("value").alias("result_value"),
        F.when(F.col("status") == "OK", "SUCCESS").otherwise(F.col("status")).alias("status"),
    )
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in QA_RESULTS])
