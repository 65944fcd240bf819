"""Names: snake_case, identifier quoting, metric keys."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The two word boundaries and the prefixes used in check types and result aliases.
WORD_START = r"([^\n])([A-Z][a-z]+)"
WORD_END = r"([a-z0-9])([A-Z])"
NULLS_CHECK = "nulls_per_column"
NULLS_ALIAS = "nulls_"
COUNT_CHECK = "count_total_rows"
DUPLICATES_CHECK = "duplicates_primary_key"
HASH_CHECK = "hashcheck"
VALUE_DIST_PREFIX = "value_dist_"


def col_of(name: str) -> Column:
    """Column of this exact top-level name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def snake_case(value: Column) -> Column:
    """CamelCase text to snake_case."""
    words = F.regexp_replace(value, WORD_START, "$1_$2")
    words = F.regexp_replace(words, WORD_END, "$1_$2")
    return F.lower(F.replace(words, F.lit("__"), F.lit("_")))


def snake_name(name: str) -> str:
    """The same for one column name of a schema."""
    words = re.sub(WORD_START, r"\1_\2", name)
    return re.sub(WORD_END, r"\1_\2", words).replace("__", "_").lower()


def snake_columns(df: DataFrame) -> DataFrame:
    """Rename every column to snake_case; two names that would become one are an error."""
    origins: dict[str, list[str]] = {}
    for name in df.columns:
        origins.setdefault(snake_name(name), []).append(name)
    clashes = {new: old for new, old in origins.items() if len(old) > 1}
    if clashes:
        raise ValueError(f"columns with the same snake_case name: {clashes}")
    return df.toDF(*origins)


def quote_ident(name: Column, dialect: str) -> Column:
    """Quoted identifier, with a closing quote inside the name doubled."""
    if dialect == "tsql":
        return F.concat(F.lit("["), F.replace(name, F.lit("]"), F.lit("]]")), F.lit("]"))
    if dialect == "spark":
        return F.concat(F.lit("`"), F.replace(name, F.lit("`"), F.lit("``")), F.lit("`"))
    raise ValueError(f"unknown dialect: {dialect!r}")


def qualified_name(catalog: Column, schema: Column, table: Column, dialect: str, parts: int = 3) -> Column:
    """`catalog.schema.table`, `schema.table` or `table` with every part quoted."""
    if parts not in (1, 2, 3):
        raise ValueError("parts must be 1, 2 or 3")
    names = [catalog, schema, table][-parts:]
    return F.concat_ws(".", *[quote_ident(n, dialect) for n in names])


def display_name(schema: Column, table: Column) -> Column:
    return F.concat_ws(".", schema, table)


def nulls_key(column_name: Column) -> Column:
    """Metric key of the null count of a column."""
    return F.concat(F.lit(NULLS_CHECK + "|"), snake_case(column_name))


def nulls_key_from_alias(alias: Column) -> Column:
    """`nulls_<Col>` to the metric key; NULL for any other alias."""
    return F.when(
        F.lower(alias).startswith(NULLS_ALIAS),
        nulls_key(F.substring(alias, len(NULLS_ALIAS) + 1, 2**31 - 1)),
    )


def nulls_check_column(check_type: Column) -> Column:
    """The column part of `nulls_per_column|<Col>` in its own case; NULL for other check types."""
    prefix = NULLS_CHECK + "|"
    return F.when(
        F.lower(check_type).startswith(prefix),
        F.substring(check_type, len(prefix) + 1, 2**31 - 1),
    )
