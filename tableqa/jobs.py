"""End-to-end jobs."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tableqa.functions.values import normalize_values
from tableqa.operators.compare import compare_content, compare_metrics, compare_tables, equality_result
from tableqa.operators.extract import BATCH_SIZE, extract, table_high_water_mark
from tableqa.operators.locate import locate_differences, same_columns
from tableqa.operators.metrics import expected_metrics, needed_checks, observed_metrics
from tableqa.operators.numbering import ROWS_PER_BUCKET
from tableqa.plans.build import generate_plan
from tableqa.plans.run import qa_results, run_plan
from tableqa.plans.select import CHECK_LIMIT, read_plan
from tableqa.sinks.writers import (
    CHUNK_SIZE,
    append_results,
    remove_folder,
    run_prefix,
    save_plan,
    write_extract,
    write_jsonl,
    write_single,
)
from tableqa.sources.tables import stage, staging_path


@dataclass(frozen=True)
class TableId:
    catalog: str
    schema: str
    table: str


def job_generate_plan(metadata: DataFrame, table: str | None = None, path: str | None = None, **options) -> DataFrame:
    """Column catalog to plan table."""
    plan = stage(generate_plan(metadata, **options), "plan")
    save_plan(plan, table=table, path=path)
    return plan


def job_extract(
    source: DataFrame,
    primary_key: str,
    output: str,
    run_ts: datetime,
    mode: str = "full",
    reload: bool = False,
    changes: DataFrame | None = None,
    min_version: int = 0,
    target_table: str | None = None,
    batch_size: int = BATCH_SIZE,
    chunk_size: int = CHUNK_SIZE,
    land_first: bool = True,
    net: bool = False,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Numbered extract to Parquet, returned as read back.

    With `target_table`, tracked changes start after the highest version that table holds. The source is staged first,
    so that a live one is read once and all passes see the same rows; what was staged is removed at the end. Sources
    that are files, which give the same rows each time, need no staging: say `land_first=False`. `net` folds a raw
    feed of changes to one net change for each key.
    """
    if target_table is not None:
        min_version = table_high_water_mark(source.sparkSession, target_table)
    spark, staged = source.sparkSession, []

    def landed(df: DataFrame | None) -> DataFrame | None:
        if df is None or not land_first:
            return df
        staged.append(staging_path(spark, "source"))
        return stage(df, path=staged[-1])

    try:
        rows = extract(
            landed(source), primary_key, run_ts, mode, reload, landed(changes), min_version, batch_size=batch_size,
            rows_per_bucket=rows_per_bucket, net=net,
        )
        written = write_extract(rows, output, chunk_size)
    finally:
        for path in staged:
            remove_folder(spark, path)
    return spark.read.schema(rows.schema).parquet(written)


def job_extract_reconcile(
    source: DataFrame,
    table: TableId,
    primary_key: str,
    plan: DataFrame,
    check_types: list[str],
    output: str,
    run_ts: datetime,
    runner: Callable[[str], DataFrame] | None = None,
    tolerance: float = 0.0,
    only_failures: bool = False,
    footers: bool = True,
    **options,
) -> DataFrame:
    """Extract to Parquet, run the plan on the source, measure the Parquet, compare, write results and alerts.

    Row and null counts of the Parquet come from its footers; `footers=False` reads every column instead. Data, results
    and alerts of a run lie in folders of its time, so the job can be repeated; alerts describe the run's own files.

    The plan states what is expected, so its queries must describe the rows that are extracted: for tracked changes
    give a plan over the changes, not over the whole table.
    """
    spark = source.sparkSession
    data = run_prefix(output, "data", run_ts)
    checks = read_plan(plan, table.catalog, table.schema, table.table, check_types).collect()
    with ThreadPoolExecutor(1) as pool:  # the checks of the source do not wait for the extract
        running = pool.submit(run_plan, spark, checks, run_ts, runner)
        landed = job_extract(source, primary_key, data, run_ts, **options)
        results = running.result()
    write_jsonl(results, run_prefix(output, "qa_results", run_ts))
    needed = needed_checks([c.check_type for c in checks], primary_key)
    observed = observed_metrics(landed, needed, footers_of=data if footers else None)
    alerts = compare_metrics(expected_metrics(results), observed, run_ts, tolerance, only_failures=only_failures)
    path = write_jsonl(alerts, run_prefix(output, "qa_alerts", run_ts))
    return spark.read.schema(alerts.schema).json(path)


def job_extract_compare(
    source: DataFrame, primary_key: str, output: str, run_ts: datetime, distributions: tuple[str, ...] = (), **options
) -> DataFrame:
    """Full extract to Parquet, then source and Parquet compared by row hashes and value distributions; writes alerts."""
    spark = source.sparkSession
    landed = job_extract(source, primary_key, run_prefix(output, "data", run_ts), run_ts, **options)
    alerts = compare_content(source, landed, distributions)
    path = write_jsonl(alerts, run_prefix(output, "qa_alerts", run_ts))
    return spark.read.schema(alerts.schema).json(path)


def job_extract_and_qa(
    source: DataFrame,
    table: TableId,
    plan: DataFrame,
    output: str,
    run_ts: datetime,
    results_table: str | None = None,
    results_path: str | None = None,
    check_types: list[str] | None = None,
    limit: int | None = CHECK_LIMIT,
    runner: Callable[[str], DataFrame] | None = None,
    single: bool = True,
) -> DataFrame:
    """Extract to Parquet as it is, run the first checks of the plan, append their results.

    The extract is one file, written by one task, or with `single=False` a folder that all tasks write.
    """
    path = write_single(normalize_values(source), output, run_ts, single)
    checks = read_plan(
        plan, table.catalog, table.schema, table.table, check_types, empty_means_all=True, exact=True, limit=limit
    )
    spark = source.sparkSession
    results = qa_results(run_plan(spark, checks, run_ts, runner), run_ts, path)
    append_results(results, results_table, results_path)
    return results


def job_query_compare(
    source: DataFrame,
    check: dict,
    output: str,
    run_ts: datetime,
    runner: Callable[[str], DataFrame] | None = None,
    single: bool = True,
    by: str = "digest",
    ordered_by: str | None = None,
    key: str | list[str] | None = None,
) -> DataFrame:
    """Query to Parquet, then compare the whole Parquet with the result of the check's query: PASS, FAIL or ERROR.

    `single`, `by` and `ordered_by` are those of `write_single` and `compare_tables`. With a `key`, a FAIL of tables of
    the same columns also writes the keys that differ as Parquet, into a folder of the run that the message names; the
    check's query is then read several times.
    """
    spark: SparkSession = source.sparkSession
    path = write_single(source, output, run_ts, single)
    try:
        landed = source if path is None else spark.read.schema(source.schema).parquet(path)
        queried = (runner or spark.sql)(check["query_text"])
        outcome = compare_tables(landed, queried, by, ordered_by).collect()
        result = spark.createDataFrame(outcome, "status string, row_count_sql bigint, row_count_bq bigint")
        message = None
        if key is not None and outcome[0]["status"] == "FAIL" and same_columns(landed, queried):
            folder = run_prefix(f"{output.rstrip('/')}_differences", str(check.get("query_id")), run_ts)
            locate_differences(landed, queried, key).write.parquet(folder)
            message = f"differences: {folder}"
        return equality_result(result, check, path, message)
    except Exception as error:  # a failing check is a result
        failed = spark.createDataFrame([("ERROR", None, None)], "status string, row_count_sql bigint, row_count_bq bigint")
        return equality_result(failed, check, path, str(error))
