"""Value functions: text forms, lenient numbers, list arguments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableqa.functions.names import col_of

# Source types that are carried as text of at most 100 characters.
UNSUPPORTED_TYPES = ("datetimeoffset", "sql_variant", "geometry", "hierarchyid", "geography", "timestamp")
UNSUPPORTED_LENGTH = 100

TRUE_TEXTS = ("true", "1", "yes")

_NUMBER = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def bytes_to_text(value: Column) -> Column:
    """UTF-8 text of a binary value; bytes that are not UTF-8 are dropped (and so is a genuine U+FFFD)."""
    return F.replace(F.make_valid_utf8(value.cast("string")), F.lit("�"), F.lit(""))


def iso_timestamp(value: Column) -> Column:
    """ISO text of a timestamp; the fraction is written only where it is not zero."""
    seconds = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(value, ".SSSSSS")
    return F.concat(seconds, F.when(fraction == ".000000", F.lit("")).otherwise(fraction))


def normalized_value(value: Column, dtype: T.DataType) -> Column:
    """Binary and timestamps become text, everything else passes unchanged."""
    if isinstance(dtype, T.BinaryType):
        return bytes_to_text(value)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return iso_timestamp(value)
    return value


def normalize_values(df: DataFrame) -> DataFrame:
    return df.select(*[normalized_value(col_of(f.name), f.dataType).alias(f.name) for f in df.schema])


def text_value(value: Column, dtype: T.DataType) -> Column:
    """Text of any value; nested values as JSON."""
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(value)
    return value.cast("string")


def text_columns(df: DataFrame) -> DataFrame:
    """Every column as text under its own name."""
    return df.select(*[text_value(col_of(f.name), f.dataType).alias(f.name) for f in df.schema])


def cast_unsupported(
    df: DataFrame,
    source_types: dict[str, str],
    unsupported: tuple[str, ...] = UNSUPPORTED_TYPES,
    length: int = UNSUPPORTED_LENGTH,
) -> DataFrame:
    """Carry columns whose source type is unsupported as text of `length` characters.

    `source_types` maps a column name to the type its source declares; a column that is not listed is judged by
    its Spark type.
    """

    def projected(field: T.StructField) -> Column:
        declared = source_types.get(field.name, field.dataType.simpleString()).lower()
        value = col_of(field.name)
        if declared in unsupported:
            value = F.substring(text_value(value, field.dataType), 1, length)
        return value.alias(field.name)

    return df.select(*[projected(f) for f in df.schema])


def safe_int(value: Column) -> Column:
    """Lenient integer: an integer, else a number cut towards zero, else 0 (also for NULL, NaN and infinity)."""
    text = F.regexp_replace(value.cast("string"), r"(?<=[0-9])_(?=[0-9])", "")
    number = F.when(text.rlike(_NUMBER), text)
    return F.coalesce(
        number.try_cast("bigint"),
        number.try_cast("double").try_cast("bigint"),
        F.lit(0).cast("bigint"),
    )


def int_or_zero(value: Column) -> Column:
    """Integer value of a text, 0 where it is not one."""
    return F.coalesce(value.try_cast("bigint"), F.lit(0).cast("bigint"))


def split_list(value: Column, separator: str = "|", lower: bool = True) -> Column:
    """Entries of a separated list: trimmed, without empties, lower-cased for the pipe form."""
    parts = F.transform(
        F.split(value, "\\Q" + separator + "\\E"),
        lambda p: F.lower(F.trim(p)) if lower else F.trim(p),
    )
    return F.filter(F.coalesce(parts, F.array().cast("array<string>")), lambda p: p != "")


def parse_check_types(text: str | None, separator: str = "|", lower: bool = True) -> list[str]:
    """The same for a job argument."""
    parts = [p.strip() for p in (text or "").split(separator)]
    return [p.lower() if lower else p for p in parts if p]


def parse_flag(text: str | bool | None) -> bool:
    """A yes/no job argument."""
    return str(text).strip().lower() in TRUE_TEXTS
