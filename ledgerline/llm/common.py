"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import checkpoint_dir

#: The bytes that separate words and that exact dedup ignores: [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back.

    Cuts the lineage: what follows survives lost executors without computing
    the step again, and a partition number written here stays as it was.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit(""))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_kept: dict[str, Callable[[], None]] = {}
_working = ""


def at_work(name: str, drop: Callable[[], None]) -> None:
    """Told by each operator that keeps a table in its worker process between tasks: the others drop theirs.

    A worker serves one stage after another; without this it would hold the
    tables of all of them.
    """
    global _working
    _kept[name] = drop
    if name != _working:
        for other, clear in _kept.items():
            if other != name:
                clear()
        _working = name
