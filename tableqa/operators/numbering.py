"""Exact global row numbers without a window over the whole table.

`row_number() over (order by key)` moves every row to one task. Here the key range is cut into buckets of about
equal size; rows are numbered inside their bucket and shifted by the number of rows in the buckets before it. The
bucket of a row depends on nothing but its content, so the pass that counts and the pass that numbers agree, also
when a task is run again.

Keys are compared with the bucket bounds by a binary search in the scan stage. (No filter may use the bucket: pushing
it down would copy the search into itself.) Bounds come from a sample of the key column: they steer the balance, never
the result.

Heavy content is split in two steps, so that no task gets it whole:

* a key that fills several buckets (or a large share of NULL keys) is cut further by the hash of the full row,
  which is also the tie-break of the order;
* identical copies of one row share that hash too. They are collapsed to one row and a count before the shuffle
  and written out again in chunks.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableqa.functions.names import col_of
from tableqa.sources.tables import stage

ROWS_PER_BUCKET = 1_000_000
MIN_BUCKET_ROWS = 10_000
SAMPLES_PER_BUCKET = 20
MOST_BUCKETS = 1 << 20  # what a field of a bucket number holds
COMPILED_STEPS = 9  # steps of the bound search that Spark compiles; more are folded, with the same result

_BUCKET, _HASH, _POS, _COUNT, _CHUNK, _BASE = (
    "__bucket", "__row_hash", "__bound", "__copies", "__chunk", "__rows_before",
)


@dataclass
class Layout:
    """Where the buckets lie. `splits[i]` > 1 marks bounds[i] as a key with that many buckets of its own."""

    key_type: T.DataType
    bounds: list[str] = field(default_factory=list)
    splits: list[int] = field(default_factory=list)
    null_splits: int = 1
    heavy_rows: list[tuple[str | None, int]] = field(default_factory=list)  # (key, row hash) of many copies

    @property
    def hot_keys(self) -> list[str | None]:
        nulls = [None] if self.null_splits > 1 else []
        return nulls + [b for b, s in zip(self.bounds, self.splits) if s > 1]


def _order_key(df: DataFrame, key: str) -> tuple[Column, T.DataType]:
    dtype = df.schema[key].dataType
    if isinstance(dtype, T.BinaryType):  # hex text sorts like the bytes
        return F.hex(col_of(key)), T.StringType()
    return col_of(key), dtype


def _row_hash(df: DataFrame) -> Column:
    def value(field: T.StructField) -> Column:
        kind = field.dataType.simpleString()
        return F.to_json(col_of(field.name)) if "map<" in kind or "variant" in kind else col_of(field.name)

    return F.xxhash64(*[value(f) for f in df.schema])


def plan_layout(df: DataFrame, key: str, rows_per_bucket: int = ROWS_PER_BUCKET, seed: int = 7) -> Layout:
    """Choose the buckets from a row count and a sample of the key column: enough for `rows_per_bucket` and for all tasks,
    unless that left fewer than MIN_BUCKET_ROWS in each. A table of one bucket has no bounds."""
    order_key, key_type = _order_key(df, key)
    layout = Layout(key_type)
    total = df.count()
    # Some more buckets than shuffle partitions, so that hashing the bucket numbers spreads them evenly.
    spread = min(4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // MIN_BUCKET_ROWS)
    buckets = max(-(-total // rows_per_bucket), spread)
    if buckets < 2:
        return layout
    if buckets >= MOST_BUCKETS:
        raise ValueError(f"{buckets} buckets, but a table may have {MOST_BUCKETS - 1}: raise rows_per_bucket")

    fraction = min(1.0, buckets * SAMPLES_PER_BUCKET / total)
    sample = df.select(order_key.alias("k")).sample(fraction, seed=seed)
    # The sample has about buckets * SAMPLES_PER_BUCKET values, so one task may rank it.
    ranked = sample.select(
        "k",
        F.row_number().over(Window.orderBy("k")).cast("bigint").alias("i"),
        F.count(F.lit(1)).over(Window.partitionBy()).alias("n"),
    )
    is_bound = F.floor(F.col("i") * buckets / F.col("n")) > F.floor((F.col("i") - 1) * buckets / F.col("n"))
    picked = (
        ranked.filter(is_bound)
        .groupBy("k")
        .agg(F.count(F.lit(1)).alias("times"))
        .orderBy("k")
        .select(F.col("k").cast("string").alias("k"), "times")
        .collect()
    )
    for row in picked:
        if row.k is None:
            layout.null_splits = row.times
        else:
            layout.bounds.append(row.k)
            layout.splits.append(row.times)

    if layout.hot_keys:
        rows = df.select(order_key.alias("k"), _row_hash(df).alias("h")).sample(fraction, seed=seed)
        frequent = (
            rows.join(_key_rows(df, key_type, layout.hot_keys), F.col("k").eqNullSafe(F.col("hot_key")), "left_semi")
            .groupBy("k", "h")
            .count()
            .filter(F.col("count") >= SAMPLES_PER_BUCKET)  # so there are no more of them than buckets
            .select(F.col("k").cast("string").alias("k"), "h")
        )
        layout.heavy_rows = [(r.k, r.h) for r in frequent.collect()]
    return layout


def _key_rows(df: DataFrame, key_type: T.DataType, keys: list[str | None], hashes: list[int] | None = None) -> DataFrame:
    """Broadcast table of hot keys, at most one per bucket, or of heavy (key, row hash) pairs."""
    rows = [(k, h) for k, h in zip(keys, hashes or [0] * len(keys))]
    table = df.sparkSession.createDataFrame(rows, "k string, hot_hash bigint")
    return F.broadcast(table.select(F.col("k").cast(key_type).alias("hot_key"), "hot_hash"))


def _literal_array(values: list, element: str) -> Column:
    """One array literal, however long the list (folded from JSON text by the optimizer)."""
    texts = F.from_json(F.lit(json.dumps([str(v) for v in values])), "array<string>")
    return texts.cast(f"array<{element}>")


def _count_below(df: DataFrame, value: Column, bounds: Column, size: int, out: str) -> DataFrame:
    """Add the number of sorted `bounds` that are smaller than `value`, by binary search.

    A few steps are a chain of projections, which Spark compiles into the scan stage. A longer chain grows beyond
    what the JVM compiles, so with more bounds the steps are folded.
    """
    steps = [1 << i for i in reversed(range(size.bit_length()))]

    def probe(found: Column, step: Column) -> Column:
        return found + F.when(F.get(bounds, found + step - 1) < F.col("__value"), step).otherwise(F.lit(0))

    located = df.withColumn("__value", value).withColumn(out, F.lit(0))
    if len(steps) > COMPILED_STEPS:
        return located.withColumn(out, F.aggregate(F.lit(steps), F.lit(0), probe)).drop("__value")
    for step in steps:
        located = located.withColumn(out, probe(F.col(out), F.lit(step)))
    return located.drop("__value")


def sampled_bounds(df: DataFrame, key: str, total: int, ranges: int, seed: int = 7) -> list[str]:
    """At most `ranges - 1` rising values that cut the keys of a table of `total` rows into ranges of about equal size.

    They are texts of the key type. The sample has some SAMPLES_PER_BUCKET values for each range, whatever the table.
    """
    fraction = min(1.0, ranges * SAMPLES_PER_BUCKET / max(total, 1))
    sample = df.select(col_of(key).alias("k")).filter("k IS NOT NULL").sample(fraction, seed=seed)
    ranked = sample.select("k", F.ntile(ranges).over(Window.orderBy("k")).alias("range"))
    tops = ranked.groupBy("range").agg(F.max("k").alias("k")).groupBy("k").agg(F.min("range").alias("range")).orderBy("range")
    return [r.k for r in tops.select(F.col("k").cast("string").alias("k")).collect()][: ranges - 1]


def range_number(df: DataFrame, key: str, bounds: list[str], out: str) -> DataFrame:
    """Add the number of a key's range: 0 for NULL, else one more than the number of bounds below the key."""
    kind = df.schema[key].dataType.simpleString()
    if not bounds:
        return df.withColumn(out, F.when(col_of(key).isNull(), 0).otherwise(1))
    located = _count_below(df, col_of(key), _literal_array(bounds, kind), len(bounds), out)
    return located.withColumn(out, F.when(col_of(key).isNull(), 0).otherwise(F.col(out) + 1))


def _bounds(layout: Layout) -> Column:
    return _literal_array(layout.bounds, layout.key_type.simpleString())


def _splits_of_row(layout: Layout) -> Column:
    return F.when(F.col("__key").isNull(), F.lit(layout.null_splits)).when(
        F.get(_bounds(layout), F.col(_POS)) == F.col("__key"),
        F.coalesce(F.get(_literal_array(layout.splits, "int"), F.col(_POS)), F.lit(1)),
    ).otherwise(F.lit(1))


def _locate(df: DataFrame, key: str, layout: Layout) -> DataFrame:
    order_key, _ = _order_key(df, key)
    located = df.withColumn("__key", order_key)
    located = _count_below(located, F.col("__key"), _bounds(layout), len(layout.bounds), _POS)
    return located.withColumn("__splits", _splits_of_row(layout))


def _assign_buckets(df: DataFrame, key: str, layout: Layout) -> DataFrame:
    """Add the bucket number; buckets are ordered like (key with NULLs first, row hash)."""
    located = _locate(df, key, layout)
    # NULL keys 0; keys between two bounds odd; a key with buckets of its own the even number behind them.
    is_hot = F.col("__splits") > 1
    position = F.col(_POS).cast("bigint") * 2
    major = (
        F.when(F.col("__key").isNull(), F.lit(0))
        .when(is_hot, position + 2)
        .otherwise(position + 1)
    )
    if not layout.hot_keys:
        return located.withColumn(_BUCKET, major.cast("bigint")).drop("__key", _POS, "__splits")
    hashes = sorted({h for _, h in layout.heavy_rows})
    heavy = _literal_array(hashes, "bigint")
    located = _count_below(located, F.col(_HASH), heavy, len(hashes), "__heavy")
    # The upper 31 bits of the hash, from 0 up, cut into `splits` equal ranges.
    upper = F.shiftright(F.col(_HASH), 33) + F.lit(1 << 30)
    minor = F.shiftright(upper * F.col("__splits"), 31)
    single = F.col("__heavy") * 2 + F.coalesce(F.get(heavy, F.col("__heavy")) == F.col(_HASH), F.lit(False)).cast("int")
    # 21 bits for each part: half of that is the most buckets a layout may have here
    bucket = (major * (1 << 21) + F.when(is_hot, minor).otherwise(0)) * (1 << 21) + F.when(
        is_hot, single
    ).otherwise(0)
    return located.withColumn(_BUCKET, bucket.cast("bigint")).drop("__key", _POS, "__splits", "__heavy")


def bucketed(df: DataFrame, key: str, layout: Layout) -> DataFrame:
    """The rows with their bucket and row hash, in internal columns."""
    return _assign_buckets(df.withColumn(_HASH, _row_hash(df)), key, layout)


def number_rows(
    df: DataFrame,
    key: str,
    out: str = "rn",
    rows_per_bucket: int = ROWS_PER_BUCKET,
    layout: Layout | None = None,
) -> DataFrame:
    """Add `row_number() over (order by key)` as bigint: NULL keys first, ties by the hash of the row.

    The input is read more than once, so it should be files or a staged table, not a live query.
    """
    if layout is None:
        layout = plan_layout(df, key, rows_per_bucket)
    columns = [col_of(c) for c in df.columns]
    order_key = _order_key(df, key)[0].asc_nulls_first()
    if not layout.bounds and not layout.hot_keys:  # at most one bucket of rows, so one task sorts them
        number = F.row_number().over(Window.orderBy(order_key, _row_hash(df)))
        return df.withColumn(out, number.cast("bigint"))
    rows = bucketed(df, key, layout)

    # One row per bucket: the number of buckets bounds both the single-task prefix sum and the broadcast.
    sizes = rows.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias(_COUNT))
    before = Window.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = F.broadcast(
        sizes.select(_BUCKET, F.coalesce(F.sum(_COUNT).over(before), F.lit(0)).alias(_BASE))
    )

    in_bucket = Window.partitionBy(_BUCKET).orderBy(order_key, _HASH)
    if not layout.heavy_rows:
        numbered = rows.withColumn(out, F.row_number().over(in_bucket)).join(offsets, _BUCKET)
        return numbered.select(*columns, (F.col(_BASE) + F.col(out)).cast("bigint").alias(out))

    keys, hashes = zip(*layout.heavy_rows)
    heavy_rows = _key_rows(df, layout.key_type, list(keys), list(hashes))
    is_heavy = _order_key(df, key)[0].eqNullSafe(F.col("hot_key")) & (F.col(_HASH) == F.col("hot_hash"))

    light = rows.join(heavy_rows, is_heavy, "left_anti")
    light = light.withColumn(out, F.row_number().over(in_bucket)).join(offsets, _BUCKET)
    light = light.select(*columns, (F.col(_BASE) + F.col(out)).cast("bigint").alias(out))

    # Copies: counted map-side, numbered as a block, written out in chunks spread over the cluster.
    # Floats are grouped by their text, because grouping would turn -0.0 into 0.0.
    floats = {f.name: f.dataType for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    content = [col_of(c).cast("string").alias(c) if c in floats else col_of(c) for c in df.columns]
    copies = rows.join(heavy_rows, is_heavy, "left_semi")
    copies = copies.groupBy(_BUCKET, *content).agg(F.count(F.lit(1)).alias(_COUNT))
    blocks = Window.partitionBy(_BUCKET).orderBy(_COUNT).rowsBetween(Window.unboundedPreceding, -1)
    copies = copies.withColumn("__start", F.coalesce(F.sum(_COUNT).over(blocks), F.lit(0))).join(offsets, _BUCKET)
    copies = copies.withColumn("__start", F.col(_BASE) + F.col("__start"))
    chunk = F.lit(rows_per_bucket).cast("bigint")
    chunks = copies.withColumn(
        _CHUNK, F.explode(F.sequence(F.lit(0).cast("bigint"), F.call_function("div", F.col(_COUNT) - 1, chunk)))
    )
    # A fixed number of partitions: before they grow, chunks are too small for AQE to keep apart.
    chunks = chunks.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), _BUCKET, _CHUNK)
    first = F.col("__start") + F.col(_CHUNK) * chunk + 1
    last = F.least(first + chunk - 1, F.col("__start") + F.col(_COUNT))
    restored = [col_of(c).cast(floats[c]).alias(c) if c in floats else col_of(c) for c in df.columns]
    heavy = chunks.select(*restored, F.explode(F.sequence(first, last)).alias(out))
    return light.unionByName(heavy)


def running_totals(df: DataFrame, order: list[str], size: str, out: str) -> DataFrame:
    """Add the sum of `size` over all rows before, in `order` (NULLs first), which must tell the rows apart.

    The rows are staged once in ranges of that order, so the range of a row stays the same; one row for each range
    carries its total, which bounds the single-task sum and the broadcast.
    """
    sorting = [col_of(c).asc_nulls_first() for c in order]
    ranges = stage(df.repartitionByRange(*sorting).withColumn("__range", F.spark_partition_id()), "ranges")
    zero = F.lit(0).cast("bigint")
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranges.groupBy("__range").agg(F.sum(col_of(size)).alias("__total")).select(
        "__range", F.coalesce(F.sum("__total").over(before), zero).alias(_BASE)
    )
    inside = Window.partitionBy("__range").orderBy(*sorting).rowsBetween(Window.unboundedPreceding, -1)
    summed = ranges.withColumn(out, F.coalesce(F.sum(col_of(size)).over(inside), zero)).join(F.broadcast(totals), "__range")
    return summed.select(*[col_of(c) for c in df.columns], (F.col(_BASE) + F.col(out)).cast("bigint").alias(out))
