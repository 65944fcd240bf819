"""Where two tables differ, and comparing them in order, without shuffling rows that agree.

A set of rows has an order-free digest: its count and the sums of the pieces of its rows' 128-bit hashes. Sums are
combined map-side, so the digest of a table costs one pass and no shuffle of rows. Tables that differ are cut into key
ranges whose digests are compared; only ranges that differ are read again, with their bounds pushed down to the scan,
and cut again. Once few rows are left (or cutting no longer helps, as below one hot key), these rows alone are grouped by key.

The driver holds the bounds and digests of at most RANGES ranges a level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableqa.functions.hashing import row_digest
from tableqa.functions.names import col_of
from tableqa.operators.numbering import ROWS_PER_BUCKET, number_rows, range_number, sampled_bounds

RANGES = 255
LEAF_ROWS = 1_000_000
LEVELS = 4
PIECES = ((0, 21), (21, 21), (42, 22))  # first bit and width; sums of so few bits hold for 2^41 rows
MISSING, EXTRA, CHANGED = "MISSING", "EXTRA", "CHANGED"

_SIDE, _RANGE, _POSITION = "__side", "__range", "__position"
_SUMS = [f"__sum_{i}" for i in range(2 * len(PIECES))]


def _pieces(hashes: list[Column]) -> list[Column]:
    return [F.shiftrightunsigned(h, first).bitwiseAND(F.lit((1 << width) - 1)) for h in hashes for first, width in PIECES]


def _summed(rows: DataFrame, hashes: list[Column], *keys: str) -> DataFrame:
    """Count and digest of the rows of each key."""
    named = [p.alias(n) for p, n in zip(_pieces(hashes), _SUMS)]
    sums = [F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in _SUMS]
    return rows.select(*[col_of(k) for k in keys], *named).groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"), *sums)


def table_digest(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: the row count of a table and the order-free digest of its rows."""
    fields = [df.schema[c] for c in (df.columns if columns is None else columns)]
    return _summed(df, row_digest(T.StructType(fields)))


def same_columns(expected: DataFrame, observed: DataFrame) -> bool:
    """Whether names, types and order of the columns agree."""
    return [(f.name, f.dataType) for f in expected.schema] == [(f.name, f.dataType) for f in observed.schema]


def compare_digests(expected: DataFrame, observed: DataFrame) -> DataFrame:
    """One row: PASS or FAIL and the row count of both sides, from two table digests. No row is shuffled."""
    return _side_by_side(
        [table_digest(d).select(F.struct("*").alias("digest")) for d in (expected, observed)],
        F.col("e") == F.col("o") if same_columns(expected, observed) else F.lit(False),
    )


def _side_by_side(digests: list[DataFrame], equal: Column) -> DataFrame:
    """Status and row counts from the digest row of each side."""
    both = digests[0].select(F.lit(0).alias(_SIDE), "digest").union(digests[1].select(F.lit(1), "digest"))
    found = both.agg(*[F.max(F.when(F.col(_SIDE) == i, F.col("digest"))).alias(n) for i, n in enumerate("eo")])
    return found.select(
        F.when(equal, "PASS").otherwise("FAIL").alias("status"), F.col("e.__rows").alias("row_count_sql"), F.col("o.__rows").alias("row_count_bq")
    )


def _within(key: str, kind: T.DataType, bounds: list[str], numbers: list[int]) -> Column:
    """Filter on the key for ranges by number: 0 is NULL, range i lies above bound i - 2 up to bound i - 1."""
    value, runs = col_of(key), []
    for n in sorted(n for n in numbers if n > 0):
        if runs and runs[-1][1] == n - 1:
            runs[-1][1] = n
        else:
            runs.append([n, n])
    found = value.isNull() if 0 in numbers else F.lit(False)
    for first, last in runs:
        above = value > F.lit(bounds[first - 2]).cast(kind) if first > 1 else value.isNotNull()
        found = found | (above & (value <= F.lit(bounds[last - 1]).cast(kind)) if last <= len(bounds) else above)
    return found


def _differing_ranges(sides: list[DataFrame], key: str, bounds: list[str]) -> tuple[list[int], int]:
    """Numbers of the ranges whose digests differ, and the rows in them."""
    hashes = [f"__hash_{i}" for i in range(2)]
    rows = [
        range_number(d, key, bounds, _RANGE).select(
            F.lit(side).alias(_SIDE), _RANGE, *[h.alias(n) for h, n in zip(row_digest(d.schema), hashes)]
        )
        for side, d in enumerate(sides)
    ]
    found: list[dict] = [{}, {}]
    for r in _summed(rows[0].union(rows[1]), [F.col(h) for h in hashes], _SIDE, _RANGE).collect():
        found[r[_SIDE]][r[_RANGE]] = tuple(r)[2:]
    numbers = [n for n in found[0].keys() | found[1].keys() if found[0].get(n) != found[1].get(n)]
    return numbers, sum(found[s][n][0] for s in (0, 1) for n in numbers if n in found[s])


def locate_differences(
    expected: DataFrame, observed: DataFrame, key: str | list[str], ranges: int = RANGES, leaf_rows: int = LEAF_ROWS, levels: int = LEVELS
) -> DataFrame:
    """One row for each key whose rows differ: the key, status, rows on either side, and how many of them have no equal
    row on the other (`lost` and `added`). No row where the tables are equal.

    A key is MISSING if only the expected side has it, EXTRA if only the observed side has it, else CHANGED. Rows are
    multisets, so a repeated row is a change of its key. NULL keys are one key; NaN equals NaN. Tables of the same
    columns are asked for. Ranges are cut by the first key column.

    Both sides are read several times, so they should be files or staged tables.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if not same_columns(expected, observed):
        raise ValueError("tables of different columns cannot be compared row by row")
    if not 1 <= ranges <= RANGES:
        raise ValueError(f"ranges must lie between 1 and {RANGES}")
    sides, kind = [expected, observed], expected.schema[keys[0]].dataType
    orderable = not isinstance(kind, (T.BinaryType, T.ArrayType, T.MapType, T.StructType))
    counted = compare_digests(expected, observed).first()
    left = counted.row_count_sql + counted.row_count_bq
    if counted.status == "PASS":
        sides = [d.filter(F.lit(False)) for d in sides]
    elif orderable:
        for _ in range(levels):
            if left <= leaf_rows:
                break
            first = [d.select(col_of(keys[0])) for d in sides]
            bounds = sampled_bounds(first[0].union(first[1]), keys[0], left, ranges)
            numbers, rows = _differing_ranges(sides, keys[0], bounds)
            wanted = _within(keys[0], kind, bounds, numbers)
            sides = [d.filter(wanted) for d in sides]
            if rows * 2 > left:  # cutting finer does not pay
                break
            left = rows
    return _by_key(sides, keys)


def _by_key(sides: list[DataFrame], keys: list[str]) -> DataFrame:
    hashes = [f"__hash_{i}" for i in range(2)]
    parts = [
        d.select(
            *[col_of(k) for k in keys], *[h.alias(n) for h, n in zip(row_digest(d.schema), hashes)],
            *[F.lit(int(side == s)).cast("bigint").alias(n) for s, n in enumerate(("__e", "__o"))],
        )
        for side, d in enumerate(sides)
    ]
    # copies are combined before the shuffle, so a key of many equal rows is one row a task
    rows = parts[0].union(parts[1]).groupBy(*[col_of(k) for k in keys], *hashes).agg(F.sum("__e").alias("__e"), F.sum("__o").alias("__o"))
    found = rows.groupBy(*[col_of(k) for k in keys]).agg(
        F.sum("__e").alias("expected_rows"), F.sum("__o").alias("observed_rows"),
        F.sum(F.greatest(F.col("__e") - F.col("__o"), F.lit(0))).alias("lost"), F.sum(F.greatest(F.col("__o") - F.col("__e"), F.lit(0))).alias("added"),
    ).filter("lost > 0 OR added > 0")
    status = F.when(F.col("observed_rows") == 0, MISSING).when(F.col("expected_rows") == 0, EXTRA).otherwise(CHANGED)
    return found.select(*[col_of(k) for k in keys], status.alias("status"), "expected_rows", "observed_rows", "lost", "added")


def changed_columns(expected: DataFrame, observed: DataFrame, key: str | list[str], located: DataFrame) -> DataFrame:
    """For each CHANGED key of a single row on both sides, the names of the columns that differ.

    Only the rows of such keys are joined; the located keys are joined null-safely.
    """
    keys = [key] if isinstance(key, str) else list(key)
    wanted = located.filter((F.col("status") == CHANGED) & (F.col("expected_rows") == 1) & (F.col("observed_rows") == 1))
    wanted = wanted.select(*[col_of(k).alias(f"__key_{i}") for i, k in enumerate(keys)])
    others = [c for c in expected.columns if c not in keys]

    def rows(df: DataFrame, side: str) -> DataFrame:
        same = [col_of(k).eqNullSafe(F.col(f"__key_{i}")) for i, k in enumerate(keys)]
        hashes = [row_digest(T.StructType([df.schema[c]]))[0].alias(f"__{side}_{i}") for i, c in enumerate(others)]
        return df.join(wanted, same, "left_semi").select(*[col_of(k).alias(f"__{side}_key_{i}") for i, k in enumerate(keys)], *hashes)

    left, right = rows(expected, "l"), rows(observed, "r")
    joined = left.join(right, [F.col(f"__l_key_{i}").eqNullSafe(F.col(f"__r_key_{i}")) for i in range(len(keys))])
    differ = [F.when(F.col(f"__l_{i}") != F.col(f"__r_{i}"), F.lit(c)) for i, c in enumerate(others)]
    return joined.select(*[F.col(f"__l_key_{i}").alias(k) for i, k in enumerate(keys)], F.array_compact(F.array(*differ)).alias("columns"))


def _in_order(df: DataFrame, ordered_by: str, numbered: bool, rows_per_bucket: int) -> DataFrame:
    """Position from 1 and two hashes of the other columns together with the position."""
    content = T.StructType([f for f in df.schema if f.name != ordered_by])
    rows = df.withColumn(_POSITION, col_of(ordered_by).cast("bigint")) if numbered else number_rows(df, ordered_by, _POSITION, rows_per_bucket)
    return rows.select(_POSITION, *[F.xxhash64(F.col(_POSITION), h).alias(f"__hash_{i}") for i, h in enumerate(row_digest(content))])


def compare_ordered(
    expected: DataFrame, observed: DataFrame, ordered_by: str, numbered: bool = False, rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """One row: PASS or FAIL, both row counts, and the first position (from 1) where the tables differ.

    Equal tables have the same columns and, put in the order of `ordered_by` on their own side, equal rows at every
    position; the order column itself only orders. Rows of equal order follow the hash of the whole row. With
    `numbered` the column is a gapless row number from 1, as extracts have it, and nothing is sorted.

    Each bucket of `rows_per_bucket` positions has a digest that its rows' positions are part of; these digests are
    joined bucket by bucket, and the rows of the first bucket that differs are looked at again.
    """
    if not same_columns(expected, observed):
        counts = [d.agg(F.struct(F.count(F.lit(1)).alias("__rows")).alias("digest")) for d in (expected, observed)]
        return _side_by_side(counts, F.lit(False)).withColumn("first_difference", F.lit(None).cast("bigint"))
    sides = [_in_order(d, ordered_by, numbered, rows_per_bucket) for d in (expected, observed)]
    bucket = F.call_function("div", F.col(_POSITION) - 1, F.lit(rows_per_bucket))
    digests = [
        _summed(d.withColumn(_RANGE, bucket), [F.col("__hash_0"), F.col("__hash_1")], _RANGE).select(F.col(_RANGE), F.struct("__rows", *_SUMS).alias(n))
        for d, n in zip(sides, "eo")
    ]
    spark, n_rows = expected.sparkSession, lambda side: F.coalesce(F.sum(F.col(f"{side}.__rows")), F.lit(0))
    found = digests[0].join(digests[1], _RANGE, "full_outer").agg(
        n_rows("e").alias("sql"), n_rows("o").alias("bq"), F.min(F.when(~F.col("e").eqNullSafe(F.col("o")), F.col(_RANGE))).alias("bucket")
    ).first()
    at = None
    if found.bucket is not None:
        low = found.bucket * rows_per_bucket
        near = [d.filter(F.col(_POSITION).between(low + 1, low + rows_per_bucket)) for d in sides]
        named = [d.select(F.col(_POSITION), F.struct("__hash_0", "__hash_1").alias(n)) for d, n in zip(near, "eo")]
        at = named[0].join(named[1], _POSITION, "full_outer").filter(~F.col("e").eqNullSafe(F.col("o"))).agg(F.min(_POSITION)).first()[0]
    outcome = [("PASS" if at is None else "FAIL", found.sql, found.bq, at)]
    return spark.createDataFrame(outcome, "status string, row_count_sql bigint, row_count_bq bigint, first_difference bigint")
