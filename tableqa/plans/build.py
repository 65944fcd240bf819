"""Generating the check plan: one row per (table, check) with its SQL text, as a DataFrame job over the column catalog."""

from __future__ import annotations

from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableqa.functions.names import (
    COUNT_CHECK,
    DUPLICATES_CHECK,
    HASH_CHECK,
    NULLS_ALIAS,
    NULLS_CHECK,
    VALUE_DIST_PREFIX,
    qualified_name,
    quote_ident,
)
from tableqa.operators.checks import TOP_VALUES
from tableqa.operators.numbering import running_totals
from tableqa.schemas import PLAN

TABLE = ("table_catalog", "table_schema", "table_name")
VALUE_DIST_CHECK = "value_dist"
CHECKS = (COUNT_CHECK, NULLS_CHECK, HASH_CHECK, DUPLICATES_CHECK)
ALL_CHECKS = (COUNT_CHECK, NULLS_CHECK, HASH_CHECK, VALUE_DIST_CHECK, DUPLICATES_CHECK)

# Expected shape of a result (fixed values).
SCALAR, PER_ROW, SUMMARY = "single_row_scalar", "row_level", "multi_row_summary"


class Check(NamedTuple):
    """A check as Spark columns."""

    check_type: Column
    query_text: Column
    expected_output_format: Column


@dataclass(frozen=True)
class Target:
    """What a check is built for: Spark columns, not values. `column` is the one column of a per-column check."""

    catalog: Column
    schema: Column
    table: Column
    columns: Column
    first: Column
    key: Column
    column: Column
    dialect: str = "spark"
    parts: int = 3

    @property
    def name(self) -> Column:
        return qualified_name(self.catalog, self.schema, self.table, self.dialect, self.parts)

    def quote(self, name: Column) -> Column:
        return quote_ident(name, self.dialect)


def _text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _null_sum(t: Target, column: Column) -> Column:
    name, alias = t.quote(column), t.quote(_text(NULLS_ALIAS, column))
    if t.dialect == "tsql":
        return _text("SUM(CASE WHEN ", name, " IS NULL THEN 1 ELSE 0 END) AS ", alias)
    return _text("count_if(", name, " IS NULL) AS ", alias)


def check_count(t: Target) -> Check:
    return Check(F.lit(COUNT_CHECK), _text("SELECT COUNT(*) AS total_rows FROM ", t.name), F.lit(SCALAR))


def check_nulls(t: Target, wide: bool = True) -> Check:
    """A count for every column in one query, or for one column."""
    if not wide:
        text = _text("SELECT ", _null_sum(t, t.column), " FROM ", t.name)
        return Check(_text(NULLS_CHECK + "|", t.column), text, F.lit(SCALAR))
    counts = F.concat_ws(", ", F.transform(t.columns, lambda c: _null_sum(t, c)))
    return Check(F.lit(NULLS_CHECK), _text("SELECT ", counts, " FROM ", t.name), F.lit(SCALAR))


def check_hash(t: Target, encoding: str | None = None, null_token: str | None = None) -> Check:
    """All columns of a row and the hash of their texts.

    The server hashes wide characters, which `encoding="UTF-16LE"` does in the Spark dialect, too. `null_token` stands
    for NULLs, which are skipped otherwise.
    """
    if t.dialect == "tsql":
        text_type, head, tail = "NVARCHAR(MAX)", "CONVERT(VARCHAR(64), HASHBYTES('SHA2_256', CONCAT_WS('|', ", ")), 2)"
    elif encoding:
        text_type, head, tail = "STRING", "upper(sha2(encode(concat_ws('|', ", f"), '{encoding}'), 256))"
    else:
        text_type, head, tail = "STRING", "upper(sha2(concat_ws('|', ", "), 256))"
    before, after = "CAST(", f" AS {text_type})"
    if null_token is not None:
        mark = null_token.replace("'", "''")
        before, after = "COALESCE(" + before, after + f", '{mark}')"
    casts = F.concat_ws(", ", F.transform(t.columns, lambda c: _text(before, t.quote(c), after)))
    text = _text("SELECT *, " + head, casts, tail + f" AS {HASH_CHECK} FROM ", t.name)
    return Check(F.lit(HASH_CHECK), text, F.lit(PER_ROW))


def check_duplicates(t: Target) -> Check:
    """Keys of more than one row."""
    key = t.quote(t.key)
    text = _text("SELECT ", key, " AS key_value, COUNT(*) AS cnt FROM ", t.name, " GROUP BY ", key, " HAVING COUNT(*) > 1")
    return Check(F.lit(DUPLICATES_CHECK), text, F.lit(SUMMARY))


def check_value_dist(t: Target) -> Check:
    """The most frequent values of the first column."""
    name = t.quote(t.first)
    top = f"OFFSET 0 ROWS FETCH NEXT {TOP_VALUES} ROWS ONLY" if t.dialect == "tsql" else f"LIMIT {TOP_VALUES}"
    text = _text(
        "SELECT ", name, ", COUNT(*) AS freq FROM ", t.name, " GROUP BY ", name, " ORDER BY freq DESC, ", name, " " + top
    )
    return Check(_text(VALUE_DIST_PREFIX, t.first), text, F.lit(SUMMARY))


def columns_per_table(metadata: DataFrame, by: tuple[str, ...] = TABLE) -> DataFrame:
    """Column names of every table in order, repeated catalog rows once; NULL names (no columns) leave it empty.

    `by=("table_schema", "table_name")` groups without the catalog.
    """
    position = F.col("ordinal_position") if "ordinal_position" in metadata.columns else F.lit(0)
    once = metadata.groupBy(*by, "column_name").agg(F.min(position).alias("position"))
    ordered = F.array_sort(
        F.collect_list(F.when(F.col("column_name").isNotNull(), F.struct("position", "column_name")))
    )
    return once.groupBy(*by).agg(F.transform(ordered, lambda c: c["column_name"]).alias("columns"))


def generate_plan(
    metadata: DataFrame,
    checks: tuple[str, ...] = CHECKS,
    nulls: str = "wide",
    pk: str | dict[str, str] | None = None,
    dialect: str = "spark",
    parts: int = 3,
    skip_empty: bool = True,
    hash_encoding: str | None = None,
    null_token: str | None = None,
) -> DataFrame:
    """The plan of all tables of a column catalog, numbered by table and check.

    `checks` chooses the checks and their order, `nulls` one null check per table ("wide") or per column ("narrow").
    `hash_encoding` and `null_token` are those of check_hash. `pk` names the key for all tables or by table name; otherwise the first column is the key.
    """
    unknown = set(checks) - set(ALL_CHECKS)
    if unknown or nulls not in ("wide", "narrow"):
        raise ValueError(f"unknown checks {sorted(unknown)} or null form {nulls!r}")
    tables = columns_per_table(metadata).withColumn("first", F.get("columns", F.lit(0)))
    if skip_empty:
        tables = tables.filter(F.size("columns") > 0)

    # One light row per check; the column list goes along where a text needs it.
    def rows_of(check: str) -> Column:
        one = F.array(F.struct(F.lit(check).alias("kind"), F.lit(None).cast("string").alias("column")))
        if check == COUNT_CHECK:
            return one
        if check == NULLS_CHECK and nulls == "narrow":
            return F.transform("columns", lambda c: F.struct(F.lit(check).alias("kind"), c.alias("column")))
        return F.when(F.size("columns") > 0, one).otherwise(F.slice(one, 1, 0))

    tables = tables.withColumn("checks", F.concat(*[rows_of(c) for c in checks]))
    # Tables are numbered by running totals of their checks, so only one row for each table is sorted.
    tables = running_totals(tables.withColumn("size", F.size("checks")), list(TABLE), "size", "before")
    rows = tables.select(*TABLE, "columns", "first", "before", F.posexplode("checks").alias("position", "row"))
    needs_columns = F.col("row.kind").isin(NULLS_CHECK, HASH_CHECK) & F.col("row.column").isNull()
    numbered = rows.select(
        (F.col("before") + F.col("position") + 1).alias("query_id"), *TABLE, "first", "row.*",
        F.when(needs_columns, F.col("columns")).alias("columns"),
    )

    key = F.col("first")
    if isinstance(pk, str):
        key = F.lit(pk)
    elif pk:
        by_table = F.create_map(*[F.lit(text) for item in pk.items() for text in item])
        key = F.coalesce(F.try_element_at(by_table, F.col("table_name")), key)
    target = Target(*[F.col(c) for c in (*TABLE, "columns", "first")], key, F.col("column"), dialect, parts)
    built = {
        COUNT_CHECK: check_count(target),
        NULLS_CHECK: check_nulls(target, wide=nulls == "wide"),
        HASH_CHECK: check_hash(target, hash_encoding, null_token),
        VALUE_DIST_CHECK: check_value_dist(target),
        DUPLICATES_CHECK: check_duplicates(target),
    }

    def of_kind(field: str) -> Column:
        return F.coalesce(*[F.when(F.col("kind") == c, getattr(built[c], field)) for c in checks])

    plan = numbered.select("query_id", *TABLE, *[of_kind(f).alias(f) for f in Check._fields])
    return plan.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in PLAN])


def merge_plans(*plans: DataFrame) -> DataFrame:
    """All checks of several plans, numbered on: each plan's numbers follow the highest of those before it."""
    merged, last = None, 0
    for i, plan in enumerate(plans, start=1):
        moved = plan.withColumn("query_id", F.col("query_id") + F.lit(last).cast("bigint"))
        merged = moved if merged is None else merged.unionByName(moved)
        if i < len(plans):
            last += plan.agg(F.coalesce(F.max("query_id"), F.lit(0))).first()[0]
    return merged
