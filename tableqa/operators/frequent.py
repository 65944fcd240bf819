"""Most frequent values of a column of very many, without a shuffle of all of them.

Each task keeps a summary of at most `tracked` values; summaries merge. What they return are candidates, whose exact
counts take one more pass that only candidates leave. A value that is no candidate is known to occur at most
`unseen_bound` times, so if the n-th candidate occurs more often, the result is proven. Else all values are counted.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableqa.functions.names import col_of
from tableqa.operators.checks import TOP_VALUES, value_distribution

TRACKED = 12_288  # three quarters of a summary's table of 2^14 entries
BROADCAST_BYTES = 32 << 20
# Types whose values are equal for a summary where they are equal for a grouping; 0.0 and -0.0 are not.
SUMMARISED = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType)


def summarised(kind: T.DataType) -> bool:
    return isinstance(kind, SUMMARISED) or kind == T.StringType()


def unseen_bound(rows: int, tracked: int = TRACKED) -> int:
    """How often a value can occur that a merged summary does not return.

    A summary's table has the next power of two above tracked / 0.75 entries, and its counts are short by 3.5 rows in
    as many at most; a value is returned if even its short count exceeds that error.
    """
    table = 1 << math.ceil(math.log2(max(tracked, 1) / 0.75))
    return math.ceil(2 * 3.5 * rows / table)


def candidates(df: DataFrame, column: str, tracked: int = TRACKED) -> DataFrame:
    """(value, rows): the values that the merged summary returns, `tracked` at most, and the rows of the table."""
    summary = F.call_function("approx_top_k", col_of(column), F.lit(tracked), F.lit(tracked))
    found = df.agg(summary.alias("found"), F.count(F.lit(1)).alias("rows"))
    return found.select(F.explode_outer("found").alias("x"), "rows").select(F.col("x.item").alias("value"), "rows")


def proven_top_values(df: DataFrame, column: str, n: int = TOP_VALUES, tracked: int = TRACKED) -> list | None:
    """The `n` most frequent values with their frequency, ties in value order, or None where the bound proves nothing.

    The table is read twice and should be files or staged.
    """
    kind = df.schema[column].dataType
    if not summarised(kind):
        return None
    found = candidates(df, column, tracked).withColumn("value", F.col("value").cast(kind))
    # at most `tracked` rows, kept so that both passes see the same ones
    listed = found.collect()
    rows = listed[0]["rows"] if listed else 0
    values = df.sparkSession.createDataFrame([(r["value"],) for r in listed], T.StructType([T.StructField("__candidate", kind)]))
    size = sum(len(str(r["value"])) for r in listed)
    wanted = F.broadcast(values) if size <= BROADCAST_BYTES else values
    counted = df.select(col_of(column)).join(wanted, col_of(column).eqNullSafe(F.col("__candidate")), "left_semi").groupBy(col_of(column)).agg(
        F.count(F.lit(1)).alias("freq")
    )
    total, top = counted.agg(F.coalesce(F.sum("freq"), F.lit(0))).first()[0], None
    if total == rows:  # every value is a candidate
        top = counted.orderBy(F.desc("freq"), col_of(column).asc_nulls_first()).limit(n).collect()
    else:
        best = counted.orderBy(F.desc("freq"), col_of(column).asc_nulls_first()).limit(n).collect()
        if len(best) == n and best[-1]["freq"] > unseen_bound(rows, tracked):
            top = best
    return top


def top_values(df: DataFrame, column: str, n: int = TOP_VALUES, tracked: int = TRACKED) -> DataFrame:
    """As `value_distribution`: by summaries where they prove the result, by counting all values elsewhere."""
    proven = proven_top_values(df, column, n, tracked)
    if proven is None:
        return value_distribution(df, column, n)
    schema = T.StructType([df.schema[column], T.StructField("freq", T.LongType(), False)])
    return df.sparkSession.createDataFrame([tuple(r) for r in proven], schema).orderBy(F.desc("freq"), col_of(column).asc_nulls_first())
