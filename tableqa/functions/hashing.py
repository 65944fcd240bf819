"""Row hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableqa.functions.names import col_of
from tableqa.functions.values import text_value

SEPARATOR = "|"
DIGEST_SEEDS = (1, 2)


def row_hash(
    df: DataFrame,
    columns: list[str] | None = None,
    null_token: str | None = None,
    encoding: str = "UTF-8",
) -> Column:
    """Upper-case hex SHA-256 of the text of the columns joined by `|`.

    NULLs are skipped, so rows that differ only in where a NULL sits share a hash; `null_token` writes a mark
    instead. `encoding="UTF-16LE"` gives the bytes that a server hashing wide characters would hash.
    """
    names = df.columns if columns is None else columns
    types = {f.name: f.dataType for f in df.schema}
    texts = [text_value(col_of(n), types[n]) for n in names]
    if null_token is not None:
        texts = [F.coalesce(t, F.lit(null_token)) for t in texts]
    joined = F.concat_ws(SEPARATOR, *texts) if texts else F.lit("")
    return F.upper(F.sha2(F.encode(joined, encoding), 256))


def with_row_hash(df: DataFrame, columns: list[str] | None = None, name: str = "hashcheck", **options) -> DataFrame:
    """All columns of the table plus its row hash."""
    return df.withColumn(name, row_hash(df, columns, **options))


def _ordered_maps(value: Column, kind: T.DataType) -> Column:
    """The value with every map in it, at any depth, as its entries in order of their keys."""
    if isinstance(kind, T.MapType):
        entries = F.transform(F.map_entries(value), lambda e: F.struct(
            _ordered_maps(e["key"], kind.keyType).alias("key"), _ordered_maps(e["value"], kind.valueType).alias("value")
        ))
        return F.array_sort(entries, lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))
    if "map<" not in kind.simpleString():
        return value
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _ordered_maps(x, kind.elementType))
    if isinstance(kind, T.StructType):
        fields = [_ordered_maps(value[f.name], f.dataType).alias(f.name) for f in kind]
        return F.when(value.isNotNull(), F.struct(*fields))
    return value


def row_digest(schema: T.StructType) -> list[Column]:
    """Two 64-bit hashes that together tell rows apart: each covers every value and which values are NULL, from
    different seeds. 0.0 and -0.0 are alike, and NaN equals NaN."""

    def parts(field: T.StructField) -> list[Column]:
        value = _ordered_maps(col_of(field.name), field.dataType)
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            value = F.to_json(value, {"ignoreNullFields": "false"})
        return [value.isNull(), value]

    values = [p for f in schema for p in parts(f)]
    return [F.xxhash64(F.lit(seed), *values) for seed in DIGEST_SEEDS]
