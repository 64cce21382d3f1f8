"""Surrogate keys (DML9, IDENTITY / ``MAX(id)+1``) without a single-partition window.

``row_number() OVER (ORDER BY k)`` with no PARTITION BY moves every row into
one task.  Instead the frame is range-partitioned and sorted once, the
result is checkpointed to the shared checkpoint directory (so partition
boundaries are fixed and survive executor loss), rows are counted per partition, and each row's index is
its partition's offset plus its position inside the partition.  The only
global step works on one row per partition.

:func:`with_row_index` does this to whole rows.  Where the order columns are a
key, :func:`with_key_index` numbers the keys alone and joins the ids back, so
that wide rows are neither sorted nor stored.  :func:`new_ids` numbers only
what a ledger doesn't hold yet: ids once given stay across appends.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.session import checkpoint_dir

_ROW_BITS = 33  # monotonically_increasing_id = partition index << 33 | row position


def with_row_index(df: DataFrame, order_cols: Sequence[str | Column], id_col: str = "row_index",
                   base: int | Column = 0) -> DataFrame:
    """Add ``id_col`` = ``base + 1, base + 2, ...`` in ``order_cols`` order.

    Ties in ``order_cols`` are numbered in an unspecified but stable order.
    ``base`` may be a literal or a scalar Column (e.g. ``df.select(max(id)).scalar()``).
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    # Persist first: the eager checkpoint counts the rows and then writes
    # them in a second job, which would otherwise recompute the lineage.
    # The row hash as last sort key lets the range partitioner split a run of
    # tied order keys (e.g. one hot value) across partitions.
    tiebreak = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    order = [F.col(f"`{c}`") if isinstance(c, str) else c for c in order_cols]
    sorted_df = df.orderBy(*order, tiebreak).persist(StorageLevel.MEMORY_AND_DISK)
    ordered = sorted_df.checkpoint(eager=True)
    sorted_df.unpersist()
    tagged = ordered.select(
        "*",
        F.spark_partition_id().alias("_pid"),
        (F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), _ROW_BITS)).alias("_pos"),
    )
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: a bounded frame, so the unpartitioned window
    # and the broadcast below are safe whatever the data size.
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    base_col = base if isinstance(base, Column) else F.lit(base)
    out = tagged.join(F.broadcast(offsets), "_pid")
    return out.withColumn(id_col, (base_col + F.col("_offset") + F.col("_pos") + 1).cast("long")) \
        .drop("_pid", "_pos", "_offset")


def _same_key(a: Sequence[str], b: Sequence[str]) -> list[Column]:
    """NULL is a key like any other."""
    return [F.col(f"`{x}`").eqNullSafe(F.col(f"`{y}`")) for x, y in zip(a, b)]


def attach_ids(df: DataFrame, ids: DataFrame, key_cols: Sequence[str], id_col: str) -> DataFrame:
    """``df`` with the ``id_col`` that ``ids`` (one row per key) has for its key."""
    named = [f"_key_{i}" for i in range(len(key_cols))]
    ids = ids.select(*[F.col(f"`{k}`").alias(n) for k, n in zip(key_cols, named)], id_col)
    return df.join(ids, _same_key(key_cols, named)).drop(*named)


def with_key_index(df: DataFrame, key_cols: Sequence[str], id_col: str = "row_index", base: int | Column = 0) -> DataFrame:
    """Add ``id_col`` = ``base + 1, base + 2, ...`` in the order of ``key_cols``, which tell the rows apart.

    Only the keys are sorted and checkpointed; the rows meet their ids in a join
    on the key (whose shuffle no hot key can skew, as a key has one row).  Two
    rows with one key are an error, raised when the ids are built.
    Both sides have as many rows as ``df``, so the join is always a merge join:
    Spark's size for either follows the compressed files, and by it millions of
    rows would pass for a table small enough to broadcast.
    """
    once = F.when(F.col("_n") == 1, F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit(f"two rows with one key ({', '.join(key_cols)}): "),
                               F.to_json(F.struct(*[F.col(f"`{k}`") for k in key_cols])))).cast("boolean"))
    keys = df.groupBy(*[F.col(f"`{k}`") for k in key_cols]).agg(F.count(F.lit(1)).alias("_n")).where(once).drop("_n")
    return attach_ids(df, with_row_index(keys, key_cols, id_col, base).hint("merge"), key_cols, id_col)


def new_ids(ledger: DataFrame | None, df: DataFrame, key_cols: Sequence[str], id_col: str = "id",
            base: int | Column = 0) -> DataFrame:
    """Ledger rows (``key_cols``, ``id_col``) for the keys of ``df`` that ``ledger`` doesn't hold, in key order.

    They continue after the highest id given so far (at least ``base``), so no
    id is given twice; a key keeps its id however often it comes back.  The
    distinct keys are combined before they are shuffled.
    """
    keys = df.select(*[F.col(f"`{k}`") for k in key_cols]).distinct()
    if ledger is not None:
        named = [f"_key_{i}" for i in range(len(key_cols))]
        held = ledger.select(*[F.col(f"`{k}`").alias(n) for k, n in zip(key_cols, named)])
        keys = keys.join(held, _same_key(key_cols, named), "left_anti")
        floor = base if isinstance(base, Column) else F.lit(base)
        base = F.greatest(floor, ledger.select(F.max(id_col)).scalar())  # greatest() skips the NULL of an empty ledger
    return with_row_index(keys, key_cols, id_col, base)
