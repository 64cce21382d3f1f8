"""Table mutation as DataFrame algebra (DML1-DML7, JN10, JN14).

Plain Parquet has no MERGE/UPDATE/DELETE, so each statement returns the
*new table state* as a DataFrame; the caller persists it with a staged
write (:mod:`ledgerline.sinks.writers`).  The statements keep the
reference's semantics:

* upsert: matched keys take every column from the batch, others are inserted;
* update-only merge: matched rows get the new status, nothing is inserted;
* delete: rows where the predicate is TRUE go, FALSE and NULL stay.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def latest_per_key(batch: DataFrame, keys: Sequence[str], latest: str | Column) -> DataFrame:
    """DML2: one source row per key, the one with the greatest ``latest`` (a column or an
    expression, e.g. text cast to a timestamp); ties go to the greatest remaining columns.

    ``MERGE`` fails when two source rows match one target row; the batch is
    made unique first.  ``max(struct)`` is a partial aggregate (skew-safe).
    """
    rest = [c for c in batch.columns if c not in keys]
    packed = F.max(F.struct(_c(latest).alias("_latest_by"), *[F.col(c) for c in rest])).alias("_latest")
    out = batch.groupBy(*keys).agg(packed)
    return out.select(*keys, *[F.col(f"_latest.{c}").alias(c) for c in rest]).select(*batch.columns)


def duplicate_keys(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once in a batch (reported, not silently merged)."""
    return batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def merge_upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """DML1: ``MERGE target USING batch ON keys WHEN MATCHED UPDATE * WHEN NOT MATCHED INSERT *``.

    New state = target rows whose key is not in the batch, plus the batch.
    Both sides are shuffled on the key once (anti join); the union is free.
    ``batch`` must have unique keys (see :func:`latest_per_key`).
    """
    batch = batch.select(*target.columns)
    kept = target.join(batch.select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(batch)


def delete_where(target: DataFrame, predicate: Column) -> DataFrame:
    """DML4: ``DELETE FROM target WHERE predicate`` (NULL predicate keeps the row)."""
    return target.where(~F.coalesce(predicate, F.lit(False)))


def update_matched(target: DataFrame, source: DataFrame, key: str, set_col: str, value=None,
                   source_col: str | None = None) -> DataFrame:
    """DML3/JN14: ``MERGE target USING source ON key WHEN MATCHED UPDATE SET set_col = ...``.

    The new value is either a constant (``value``) or a column of the
    source (``source_col``); the source must have one row per key.  Joined
    on ``(xxhash64(key), key)``: for long text keys the sort-merge join then
    compares 8-byte hashes first and the full text only on hash ties.
    Unmatched target rows are kept unchanged; nothing is inserted.
    """
    new_val = F.col(source_col) if source_col else (value if isinstance(value, Column) else F.lit(value))
    matches = (source.where(F.col(key).isNotNull())
               .select(F.col(key).alias("_mk"), new_val.alias("_mv"), F.lit(True).alias("_hit"))
               .withColumn("_mh", F.xxhash64("_mk")))
    t = target.withColumn("_th", F.xxhash64(key))
    j = t.join(matches, (F.col("_th") == F.col("_mh")) & (F.col(key) == F.col("_mk")), "left")
    return j.withColumn(set_col, F.when(F.col("_hit"), F.col("_mv")).otherwise(F.col(set_col))) \
        .select(*target.columns)


def exists(df: DataFrame) -> bool:
    """JN10: emptiness check that reads at most one row."""
    return df.limit(1).count() > 0


@dataclass
class LoadResult:
    state: DataFrame
    error_number: int | None = None
    error_message: str | None = None


def guarded_append(target: DataFrame, rows: DataFrame, date_col: str, date) -> LoadResult:
    """DML6: append ``rows`` for ``date`` unless ``target`` already has that date.

    All-or-nothing like the reference's transaction: on rejection the old
    state is returned untouched with the error as data (not raised).
    """
    if exists(target.where(F.col(date_col) == F.lit(date))):
        return LoadResult(target, 50000, "Stored procedure has already been executed with this date!")
    return LoadResult(target.unionByName(rows.select(*target.columns)))


def rolling_reload(target: DataFrame, rows: DataFrame, date_col: str, date, keys: Sequence[str]) -> DataFrame:
    """DML7: delete rows before ``date``; insert ``rows`` whose key is not present yet.

    The anti join on the key keeps re-runs idempotent (the reference's
    plain INSERT would violate the primary key on overlapping windows, S13).
    """
    kept = delete_where(target, F.col(date_col) < F.lit(date))
    fresh = rows.select(*target.columns).join(kept.select(*keys), list(keys), "left_anti")
    return kept.unionByName(fresh)
