"""Helpers the operators share: tables, the shared folder, cut lineage, row identity, bounded broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What a table may measure to be broadcast by an operator. Larger tables are joined by shuffles.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 << 20  # of its rows as JSON
TASK_ROWS = 1 << 16  # rows of a few numbers that make a task
BATCH_BYTES = 2 << 20  # of rows that go to Python together


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """Folder of spark.checkpoint.dir. Only a local session may leave it unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return os.path.join(tempfile.gettempdir(), "tableqa_shared")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}_{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Eager checkpoint in the shared folder: the plan starts anew there and lost executors cost nothing."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def tasks(rows: int, each: int = TASK_ROWS) -> int:
    """Tasks that so many rows are worth."""
    return max(1, -(-rows // each))


def packed(df: DataFrame, each: int = TASK_ROWS) -> DataFrame:
    """`cut`, and no more partitions than its rows fill: every shuffle writes files for each of them, however few its rows."""
    done = cut(df)
    return done.coalesce(tasks(done.count(), each))


@contextmanager
def batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """What is computed inside goes to Python in batches of `rows` rows at most: a batch of long values is held whole there."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def light_batches(spark: SparkSession) -> None:
    """From here on the session sends Python BATCH_BYTES at once at most, unless it has a limit of its own.

    The JVM and Python hold a batch whole, in each task; Spark's default allows 64 MB. What an operator returns is computed
    only after it has returned, so the limit is not put back. It changes no result."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) == "67108864b":
        spark.conf.set(name, f"{BATCH_BYTES}b")


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, with as many underscores in front that `df` has no such column."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def only(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns of a table that may have others, whatever their names."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def fold(key: str | Column, folds: int) -> Column:
    """crc32 of the key as text modulo `folds`; a null key counts as empty text."""
    key = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """Marks `df` for broadcast if its rows and their size were measured to be few, else leaves the join to the optimizer."""
    columns = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    n, total = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(F.to_json(columns)).cast("long")), F.lit(0))).first()
    return F.broadcast(df) if n <= rows and total <= size else df


# Everything of ASCII but letters and digits.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: str | Column) -> Column:
    """Lower-cased words: runs of ASCII letters, digits and all other non-ASCII characters; null texts have none.

    lower() also changes non-ASCII letters, which no ASCII word can contain. The Kelvin sign is the one character that
    it would turn into an ASCII letter, so another letter takes its place first.
    """
    text = F.col(f"`{text}`") if isinstance(text, str) else text
    plain = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("ĸ")))
    return F.array_remove(F.split(plain, SEPARATORS), "")


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with `value` computed once, also where `use` names it inside a lambda."""
    return F.element_at(F.transform(F.array(value), use), 1)


def word_grams(words: Column, n: int) -> Column:
    """Hashes of all runs of n words, by their first word; the last n - 1 hashes are of shorter runs, to be ignored."""
    return bound(words, lambda all_: F.transform(
        all_, lambda w, i: F.xxhash64(w, *[F.get(all_, i + F.lit(k)) for k in range(1, n)])
    ))
