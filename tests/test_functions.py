import hashlib
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableqa.functions import hashing, names, values

NAMES = {
    "SalespersonID": "salesperson_id",
    "createdAt": "created_at",
    "AddressId": "address_id",
    "HTTPServerURL": "http_server_url",
    "Foo__Bar": "foo__bar",
    "A1B2": "a1_b2",
    "ABCDef9Gh": "abc_def9_gh",
    "plain": "plain",
}


def test_snake_case_of_values_and_of_names(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "name string")
    got = {r.name: r.s for r in df.select("name", names.snake_case(F.col("name")).alias("s")).collect()}
    assert got == NAMES
    assert {n: names.snake_name(n) for n in NAMES} == NAMES


def test_snake_columns_rejects_clashing_names(spark):
    df = spark.createDataFrame([(1, 2)], "AddressId int, Other int")
    assert names.snake_columns(df).columns == ["address_id", "other"]
    with pytest.raises(ValueError, match="address_id"):
        names.snake_columns(spark.createDataFrame([(1, 2)], "AddressId int, address_id int"))


def test_identifiers_are_quoted(spark):
    row = spark.range(1).select(
        names.quote_ident(F.lit("a]b"), "tsql").alias("t"),
        names.quote_ident(F.lit("a`b"), "spark").alias("s"),
        names.qualified_name(F.lit("c"), F.lit("s"), F.lit("t"), "tsql").alias("q3"),
        names.qualified_name(F.lit("c"), F.lit("s"), F.lit("t"), "spark", 1).alias("q1"),
        names.display_name(F.lit("s"), F.lit("t")).alias("d"),
    ).first()
    assert tuple(row) == ("[a]]b]", "`a``b`", "[c].[s].[t]", "`t`", "s.t")


def test_metric_keys(spark):
    row = spark.range(1).select(
        names.nulls_key_from_alias(F.lit("nulls_AddressId")).alias("a"),
        names.nulls_key_from_alias(F.lit("NULLS_x")).alias("b"),
        names.nulls_key_from_alias(F.lit("total")).alias("c"),
        names.nulls_check_column(F.lit("nulls_per_column|AddressId")).alias("d"),
        names.nulls_check_column(F.lit("hashcheck")).alias("e"),
    ).first()
    assert tuple(row) == ("nulls_per_column|address_id", "nulls_per_column|x", None, "AddressId", None)


@pytest.mark.parametrize(
    "text, number",
    [("12", 12), ("12.7", 12), ("-3.9", -3), (" 8 ", 8), ("1e3", 1000), ("nan", 0), ("inf", 0), ("abc", 0), (None, 0),
     ("1_000", 1000), ("12d", 0), ("", 0), (".5", 0), ("+4", 4)],
)
def test_safe_int(spark, text, number):
    df = spark.createDataFrame([(text,)], "v string")
    assert df.select(values.safe_int(F.col("v"))).first()[0] == number


def test_safe_int_of_numbers_and_int_or_zero(spark):
    df = spark.createDataFrame([(12.7, "5"), (float("nan"), "x"), (None, None)], "d double, s string")
    got = df.select(values.safe_int(F.col("d")), values.int_or_zero(F.col("s"))).collect()
    assert [tuple(r) for r in got] == [(12, 5), (0, 0), (0, 0)]


def test_bytes_to_text_drops_bad_bytes(spark):
    df = spark.createDataFrame([(bytearray(b"ab\xffcd\xc3\xa9"),), (None,)], "b binary")
    assert [r[0] for r in df.select(values.bytes_to_text(F.col("b"))).collect()] == ["abcdé", None]


def test_iso_timestamp(spark):
    times = [datetime(2024, 1, 1, 0, 0, 7, 179575), datetime(1998, 10, 3), datetime(2024, 1, 1, 1, 2, 3, 500000)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    assert [r[0] for r in df.select(values.iso_timestamp(F.col("t"))).collect()] == [t.isoformat() for t in times]


def test_text_columns_and_unsupported_types(spark):
    df = spark.createDataFrame([(1, [1, 2], "x" * 150)], "a int, b array<int>, c string")
    assert tuple(values.text_columns(df).first()) == ("1", "[1,2]", "x" * 150)
    cut = values.cast_unsupported(df, {"c": "Geography"})
    assert cut.first().c == "x" * 100 and cut.schema["a"].dataType == T.IntegerType()


def test_check_type_lists(spark):
    assert values.parse_check_types(" Count_Total_Rows || nulls_per_column |") == ["count_total_rows", "nulls_per_column"]
    assert values.parse_check_types("a, B,,", ",", lower=False) == ["a", "B"]
    assert values.parse_check_types(None) == []
    df = spark.createDataFrame([(" A||b |",), (None,)], "v string")
    assert [r[0] for r in df.select(values.split_list(F.col("v"))).collect()] == [["a", "b"], []]


def test_flags():
    assert [values.parse_flag(v) for v in (" TRUE ", "1", "yes", True)] == [True] * 4
    assert [values.parse_flag(v) for v in ("false", "0", "", None, False)] == [False] * 5


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="abzABZ09_ é-", max_size=12), min_size=30, max_size=60))
def test_snake_case_agrees_with_the_name_form(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", names.snake_case(F.col("t")).alias("s")).collect()
    assert [r.s for r in rows] == [names.snake_name(r.t) for r in rows]


def lenient_int(text):
    for convert in (int, lambda t: int(float(t))):
        try:
            return convert(text)
        except (ValueError, OverflowError):
            pass
    return 0


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="0123456789.eE+-_ dfxn", max_size=7), min_size=30, max_size=60))
def test_safe_int_agrees_with_a_plain_conversion(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in df.select("t", values.safe_int(F.col("t")).alias("n")).collect():
        expected = lenient_int(row.t)
        assert row.n == (expected if abs(expected) < 2**63 else 0), row.t


def test_row_hash_forms(spark):
    df = spark.createDataFrame([("a", None, "é"), ("a", "é", None)], "x string, y string, z string")
    sha = lambda b: hashlib.sha256(b).hexdigest().upper()
    assert [r.hashcheck for r in hashing.with_row_hash(df).collect()] == [sha("a|é".encode())] * 2
    assert [r.h for r in df.select(hashing.row_hash(df, null_token="~").alias("h")).collect()] == [
        sha("a|~|é".encode()), sha("a|é|~".encode())
    ]
    assert df.select(hashing.row_hash(df, encoding="UTF-16LE")).first()[0] == sha("a|é".encode("utf-16-le"))


def digests(df):
    return df.select(F.array(*hashing.row_digest(df.schema)).alias("d")).distinct().count()


def test_row_digest_tells_rows_apart(spark):
    rows = [("a|b", "c"), ("a", "b|c"), ("ab", "c"), (None, "x"), ("x", None), ("-", "x"), ("", "x"), (None, None)]
    assert digests(spark.createDataFrame(rows, "a string, b string")) == len(rows)
    assert digests(spark.createDataFrame([(0.0,), (-0.0,)], "a double")) == 1
    assert digests(spark.createDataFrame([(float("nan"),), (0.0 * float("inf"),)], "a double")) == 1
    assert digests(spark.createDataFrame([(bytearray(b"\xff"),), (bytearray(b"\xfe"),)], "a binary")) == 2
    assert digests(spark.createDataFrame([([1, None],), ([None, 1],), ([1],), (None,), ([],)], "a array<int>")) == 5
    assert digests(spark.createDataFrame([((None, 1),), ((1, None),), (None,)], "a struct<x:int,y:int>")) == 3
    maps = spark.createDataFrame([({"x": 1, "y": 2},), ({"y": 2, "x": 1},), ({"x": 1},)], "a map<string,int>")
    assert digests(maps) == 2
