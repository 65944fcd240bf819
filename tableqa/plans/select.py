"""Reading a plan: the checks of one table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableqa.functions.names import VALUE_DIST_PREFIX
from tableqa.schemas import PLAN

CHECK_LIMIT = 5


def read_plan(
    plan: DataFrame,
    catalog: str,
    schema: str,
    table: str,
    check_types: list[str] | None = None,
    empty_means_all: bool = False,
    exact: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """Plan rows of one table in query order.

    Check types match without regard to case, and a base type takes its per-column forms along
    (`nulls_per_column` takes `nulls_per_column|X`, `value_dist` takes `value_dist_X`); `exact` matches them as stored. No check types select nothing,
    or everything where `empty_means_all` says so.
    """
    rows = plan.filter(
        (F.col("table_catalog") == catalog) & (F.col("table_schema") == schema) & (F.col("table_name") == table)
    )
    if check_types and exact:
        rows = rows.filter(F.col("check_type").isin(check_types))
    elif check_types:
        wanted = [c.lower() for c in check_types]
        stored = F.lower("check_type")
        taken = stored.isin(wanted) | F.substring_index(stored, "|", 1).isin(wanted)
        if VALUE_DIST_PREFIX.rstrip("_") in wanted:
            taken = taken | stored.startswith(VALUE_DIST_PREFIX)
        rows = rows.filter(taken)
    elif not empty_means_all:
        rows = rows.filter(F.lit(False))
    rows = rows.select(*PLAN.names).orderBy("query_id")
    return rows if limit is None else rows.limit(limit)
