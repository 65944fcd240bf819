"""Net changes: what a raw feed of tracked changes comes to for each key.

A feed may hold many changes of one key. Only the first and the last of them decide what a reader has to do:

=============  ==================  =============================
first change   last change         net change
=============  ==================  =============================
insert         insert or update    insert
insert         delete              none: the row came and went
update/delete  insert or update    update
update/delete  delete              delete
=============  ==================  =============================

Version and operation make one number, so the fold of a key is the least and the greatest of its numbers: a map-side
aggregate without text in it, whatever the key. A key of millions of changes leaves each task as one row.

The fold is an algebra: net changes of two consecutive stretches, folded again, are the net changes of both, so stored
net changes can be carried on without the raw feed. For that they must hold the keys that came and went, too
(`keep_gone`, operation `ID`): such a key may have been there before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableqa.functions.names import col_of
from tableqa.schemas import EXTRACT_METADATA

VERSION, OPERATION = EXTRACT_METADATA[:2]
DELETE, INSERT, UPDATE = OPERATIONS = ("D", "I", "U")  # operation codes (fixed values), in their order within one version
GONE = INSERT + DELETE  # came and went; only in net changes that are to be merged
MOST_VERSIONS = 1 << 61


def _place(version: Column, operation: Column, gone: int) -> Column:
    """Version and operation as one number; an unknown operation or a version beyond 61 bits is an error.

    `gone` is the number of a key that came and went: an insert as the first change, a delete as the last.
    """
    code = F.when(operation == DELETE, 0).when(operation == INSERT, 1).when(operation == UPDATE, 2).when(operation == GONE, gone).otherwise(
        F.raise_error(F.concat(F.lit("unknown change operation "), F.coalesce(operation, F.lit("NULL")))).cast("int")
    )
    fits = version.between(-MOST_VERSIONS, MOST_VERSIONS - 1)
    shifted = F.when(fits, F.shiftleft(version, 2)).otherwise(F.raise_error(F.lit("change version beyond 61 bits")).cast("bigint"))
    return shifted + code


def net_changes(
    feed: DataFrame, key: str | list[str], min_version: int | None = None, version: str = VERSION, operation: str = OPERATION,
    keep_gone: bool = False,
) -> DataFrame:
    """One row for each key that has changed: the key, the version of its last change and the net operation.

    Changes newer than `min_version` are read; rows without a version are no changes. Within one version a delete comes
    before an insert, and that before an update. NULL keys are one key. Keys that came and went have no row unless
    `keep_gone`, so take the high-water mark from the raw feed. Versions may be text, as extracts write them.
    """
    keys = [key] if isinstance(key, str) else list(key)
    number = col_of(version).cast("bigint")
    newer = number.isNotNull() if min_version is None else number > min_version
    first, last = (_place(F.col("__version"), F.col("__operation"), gone) for gone in (1, 0))
    folded = (
        feed.filter(newer)
        .select(*[col_of(k) for k in keys], number.alias("__version"), col_of(operation).cast("string").alias("__operation"))
        .groupBy(*[col_of(k) for k in keys])
        .agg(F.min(first).alias("__first"), F.max(last).alias("__last"))
    )
    came = F.col("__first").bitwiseAND(F.lit(3)) == 1
    gone = F.col("__last").bitwiseAND(F.lit(3)) == 0
    net = F.when(came & gone, GONE).when(came, INSERT).when(gone, DELETE).otherwise(UPDATE)
    kept = folded if keep_gone else folded.filter(~(came & gone))
    return kept.select(*[col_of(k) for k in keys], F.shiftright("__last", 2).alias(version), net.alias(operation))


def merge_net_changes(earlier: DataFrame, later: DataFrame, key: str | list[str], **options) -> DataFrame:
    """Net changes of two consecutive stretches from the net changes of each, which were taken with `keep_gone`."""
    return net_changes(earlier.unionByName(later), key, **options)
