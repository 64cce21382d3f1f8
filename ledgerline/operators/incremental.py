"""Watermark-bounded incremental loads (INC1-INC6, SRC8, DML5).

The control table is a small DataFrame ``(TableName, WatermarkValue)``.  A load is

    old = watermark(control, table)            # INC1
    new = max(source.wm_col), old if none      # INC2
    batch = source where old < wm_col <= new   # INC3, half-open (old, new]
    target = upsert(target, batch)             # DML1
    control = advance(control, table, new)     # INC4, only after the load

Both bounds are read once and passed on as literals, so the rows loaded and the
watermark stored always belong together, also when the source grows meanwhile.
Watermarks are compared as timestamps whatever their text form (S34).  Rows
whose watermark is NULL or no timestamp can't fall inside a bound; a load hands
them over as ``rejected`` (:func:`null_watermarks`).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType, TimestampType

from ledgerline.operators.mutation import latest_per_key, merge_upsert
from ledgerline.sources.files import first_value

CONTROL_SCHEMA = StructType([StructField("TableName", StringType()),
                             StructField("WatermarkValue", TimestampNTZType())])


def control_table(spark: SparkSession, seeds: dict) -> DataFrame:
    """The watermark table seeded with ``{table: timestamp}``."""
    return spark.createDataFrame(list(seeds.items()), CONTROL_SCHEMA)


def as_timestamp(col: str) -> Column:
    """The watermark column as a timestamp; NULL where its text is none."""
    return F.expr(f"try_cast(`{col}` AS timestamp_ntz)")


def watermark(control: DataFrame, table: str) -> dt.datetime | None:
    """INC1: the stored watermark for ``table`` (one row; SRC8)."""
    return first_value(control.where(F.col("TableName") == table), F.max("WatermarkValue"))


def new_watermark(source: DataFrame, wm_col: str, old: dt.datetime | None) -> dt.datetime | None:
    """INC2: ``SELECT MAX(wm_col)``; the old value where the source has none, so it never goes back or to NULL."""
    found = first_value(source, F.max(as_timestamp(wm_col)))
    return max((x for x in (found, old) if x is not None), default=None)


def bounded_extract(source: DataFrame, wm_col: str, old: dt.datetime | None, new: dt.datetime | None) -> DataFrame:
    """INC3: rows with ``old < wm_col <= new`` (all up to ``new`` without an old one).

    On a timestamp column the range reaches the scan; on a text column it is
    compared after the cast.
    """
    typed = isinstance(source.schema[wm_col].dataType, (TimestampNTZType, TimestampType))
    c = F.col(wm_col) if typed else as_timestamp(wm_col)
    if new is None:
        return source.limit(0)
    upto = source.where(c <= F.lit(new).cast("timestamp_ntz"))
    return upto if old is None else upto.where(c > F.lit(old).cast("timestamp_ntz"))


def null_watermarks(source: DataFrame, wm_col: str) -> DataFrame:
    """Rows that no load can ever pick up: the watermark is NULL or no timestamp."""
    return source.where(as_timestamp(wm_col).isNull())


def advance(control: DataFrame, table: str, value) -> DataFrame:
    """INC4/DML5: ``UPDATE control SET WatermarkValue = value WHERE TableName = table``."""
    v = value if isinstance(value, Column) else F.lit(value)
    return control.withColumn("WatermarkValue", F.when(F.col("TableName") == table, v.cast("timestamp_ntz"))
                              .otherwise(F.col("WatermarkValue")))


@dataclass
class TableSpec:
    """INC6: one entry of the configured table list."""
    name: str
    keys: Sequence[str]
    watermark_col: str
    columns: Sequence[str] = field(default_factory=list)


@dataclass
class LoadRound:
    """What one round gives: the new states and the rows it couldn't place."""
    target: DataFrame
    control: DataFrame
    batch: DataFrame
    rejected: DataFrame
    old: dt.datetime | None
    new: dt.datetime | None

    def __iter__(self):
        return iter((self.target, self.control))


def incremental_upsert(target: DataFrame, source: DataFrame, control: DataFrame, spec: TableSpec) -> LoadRound:
    """One watermark round for one table; unpacks to ``(new_target, new_control)``.

    Two one-row reads (actions) fix the bounds; the states are lazy.  The
    control table is only advanced in the returned state: persisting it after
    the target write gives "advance only after success".
    """
    old = watermark(control, spec.name)
    new = new_watermark(source, spec.watermark_col, old)
    batch = bounded_extract(source, spec.watermark_col, old, new)
    batch = latest_per_key(batch, spec.keys, as_timestamp(spec.watermark_col))
    return LoadRound(merge_upsert(target, batch, spec.keys), advance(control, spec.name, new) if new is not None else control,
                     batch, null_watermarks(source, spec.watermark_col), old, new)
