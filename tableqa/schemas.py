"""Fixed schemas of the plan, result and alert tables."""

from pyspark.sql import types as T


def _schema(*fields):
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


_S, _L, _TS = T.StringType(), T.LongType(), T.TimestampType()

COLUMN_CATALOG = _schema(
    ("table_catalog", _S),
    ("table_schema", _S),
    ("table_name", _S),
    ("column_name", _S),
    ("ordinal_position", T.IntegerType()),
)

PLAN = _schema(
    ("query_id", _L),
    ("table_name", _S),
    ("table_catalog", _S),
    ("table_schema", _S),
    ("check_type", _S),
    ("query_text", _S),
    ("expected_output_format", _S),
)

# One row per executed check. `value` is the value of a scalar result, the row of a single-row result as JSON, or the
# Parquet folder that holds all rows of any other; `rowcount` and `excess_rows` describe the whole result.
CHECK_RESULTS = _schema(
    ("query_id", _L),
    ("table_catalog", _S),
    ("table_schema", _S),
    ("table_name", _S),
    ("check_type", _S),
    ("expected_output_format", _S),
    ("status", _S),
    ("value", _S),
    ("rowcount", _L),
    ("excess_rows", _L),
    ("error", _S),
    ("executed_at_utc", _TS),
)

QA_RESULTS = _schema(
    ("run_ts", _TS),
    ("query_id", _L),
    ("check_type", _S),
    ("table_catalog", _S),
    ("table_schema", _S),
    ("table_name", _S),
    ("parquet_path", _S),
    ("rowcount", _L),
    ("result_value", _S),
    ("status", _S),
    ("error", _S),
)

METRIC = _schema(("key", _S), ("value", _L))

ALERT = _schema(
    ("key", _S),
    ("status", _S),
    ("expected", _L),
    ("observed", _L),
    ("evaluated_at_utc", _TS),
)

EQUALITY = _schema(
    ("query_id", _L),
    ("table_catalog", _S),
    ("table_schema", _S),
    ("table_name", _S),
    ("check_type", _S),
    ("status", _S),
    ("row_count_sql", _L),
    ("row_count_bq", _L),
    ("output_path", _S),
    ("error_message", _S),
)

# Columns an extract adds to the source columns (fixed values).
EXTRACT_METADATA = ("sys_change_version", "sys_change_operation", "ingestion_datetime_utc", "rn")
