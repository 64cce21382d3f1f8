"""Tables that change by publishing (SNK3, SNK4, SNK15, DML1).

New files go to a staged folder that no reader knows.  When they are complete,
the catalog is told where the table, or a partition of it, lies from now on.
A failure before that statement leaves the table as it was, and one after it
the table as it should be; nothing is deleted in between.  Where a commit
touches several partitions, each of them is old or new, and the same commit
may simply be repeated.  Folders that the catalog no longer names are garbage.

The catalog must outlive the session where the table has to: a metastore on a
cluster, the session's own catalog in tests.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import mutation as M
from ledgerline.operators import warehouse as W
from ledgerline.sinks import writers as WR

BUCKET = "bucket"


def _staged(df: DataFrame, base: str, partition_column: str | None = None) -> str:
    path = f"{base.rstrip('/')}/{uuid.uuid4().hex}"
    w = df.write.mode("error")
    (w.partitionBy(partition_column) if partition_column else w).parquet(path)
    return path


def table_or_none(spark: SparkSession, table: str) -> DataFrame | None:
    return spark.table(table) if spark.catalog.tableExists(table) else None


def publish(df: DataFrame, table: str, base: str) -> None:
    """SNK4: the whole table becomes ``df``, which may read the table itself."""
    spark = df.sparkSession
    path = _staged(df, base)
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
        spark.catalog.refreshTable(table)
    else:
        spark.catalog.createTable(table, path=path, source="parquet", schema=df.schema)


def _literal(value) -> str:
    if value is None or not re.fullmatch(r"[\w.+-]+", str(value)):
        raise ValueError(f"a partition's value must be of letters, digits, '_', '.', '+' and '-', not {value!r}")
    return f"'{value}'"


def publish_partitions(df: DataFrame, table: str, base: str, partition_column: str) -> list:
    """SNK3/SNK15: the partitions that rows of ``df`` lie in become these rows; the others keep their files.

    ``df`` may read the table itself.  Returns the values published; their
    number is the commit's size for the catalog.  Values are dates, numbers or
    plain names; null or anything that a folder's name would have to escape is
    refused before the table changes.
    """
    spark = df.sparkSession
    rest = [c for c in df.columns if c != partition_column]
    df = df.select(*[F.col(f"`{c}`") for c in rest], partition_column)
    path = _staged(df, base, partition_column)
    # Of the staged files, so that a second look at ``df`` can't differ; one row a partition.
    values = sorted((r[0] for r in spark.read.schema(df.schema).parquet(path).select(partition_column).distinct().collect()), key=str)
    place = {v: (f"PARTITION ({partition_column} = {_literal(v)})", f"LOCATION '{path}/{partition_column}={v}'") for v in values}
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY ({partition_column}) LOCATION '{base.rstrip('/')}/none'")
    known = {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    new = [v for v in values if f"{partition_column}={v}" not in known]
    if new:  # one statement for all of them
        spark.sql(f"ALTER TABLE {table} ADD " + " ".join(" ".join(place[v]) for v in new))
    for v in values:
        if v not in new:
            spark.sql(f"ALTER TABLE {table} {place[v][0]} SET {place[v][1]}")
    spark.catalog.refreshTable(table)
    return values


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def _touched(table: DataFrame | None, batch: DataFrame) -> DataFrame | None:
    """The rows of the buckets that ``batch`` has rows in; the scan is pruned to them."""
    if table is None:
        return None
    return table.where(F.col(BUCKET).isin([r[0] for r in batch.select(BUCKET).distinct().collect()]))  # at most all buckets


def upsert_buckets(batch: DataFrame, keys: Sequence[str], table: str, base: str, buckets: int) -> list[int]:
    """DML1/INC5: upsert into a table bucketed by a hash of its keys; only the buckets of the batch's keys are written again.

    ``batch`` has one row per key.  A key's bucket follows from the key, so
    ``buckets`` must stay the same for the life of the table; a repeated batch
    changes nothing.  Returns the buckets rewritten.
    """
    placed = batch.withColumn(BUCKET, bucket_of(keys, buckets))
    old = _touched(table_or_none(batch.sparkSession, table), placed)
    state = placed if old is None else M.merge_upsert(old.select(*placed.columns), placed, keys)
    return publish_partitions(state, table, base, BUCKET)


def update_dimension(changes: DataFrame, table: str, base: str, buckets: int) -> list[int]:
    """DIM2: merge new change times (CustomerKey, CreatedAt) into a published dimension, bucketed by customer.

    Only the buckets of the changed customers are read and written.
    """
    placed = changes.select("CustomerKey", "CreatedAt").distinct().withColumn(BUCKET, bucket_of(["CustomerKey"], buckets))
    old = _touched(table_or_none(changes.sparkSession, table), placed)
    if old is None:
        state = W.build_customer_dimension(placed)
    else:
        state = W.merge_customer_changes(old.drop(BUCKET), placed)
    return publish_partitions(state.withColumn(BUCKET, bucket_of(["CustomerKey"], buckets)), table, base, BUCKET)


def table_files(spark: SparkSession, table: str, partition_column: str) -> DataFrame:
    """``partition_column``, ``file_path`` and ``file_size`` of the files that hold rows of a published table.

    The scan reads no column, only the files' footers.
    """
    return spark.table(table).select(partition_column, "_metadata.file_path", "_metadata.file_size").distinct()


def crowded_partitions(spark: SparkSession, table: str, partition_column: str, target_bytes: int) -> DataFrame:
    """Partitions with at least twice the files that their bytes need (``n_files``, ``n_bytes``, ``needed``)."""
    per = table_files(spark, table, partition_column).groupBy(partition_column).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("file_size").alias("n_bytes"))
    needed = F.ceil(F.col("n_bytes") / F.lit(target_bytes))
    return per.withColumn("needed", needed).where(F.col("n_files") >= 2 * F.col("needed")).where(F.col("n_files") > 1)


def compact(spark: SparkSession, table: str, base: str, partition_column: str, target_bytes: int) -> list:
    """SNK9 for a published table: crowded partitions are written again in files of about ``target_bytes``.

    Readers see a partition's old or new files, never both (see
    :func:`publish_partitions`); the others keep theirs.  Rows go to tasks by
    Spark's rebalancing, which merges small and splits large partitions by the
    bytes really shuffled, so that a hot partition isn't one task's.  Returns the
    partitions rewritten; a second run finds none.
    """
    # Partition values, bounded by the catalog's list of them.
    crowded = [r[0] for r in crowded_partitions(spark, table, partition_column, target_bytes).select(partition_column).collect()]
    if not crowded:
        return []
    own = WR.sized_session(spark, **{"spark.sql.adaptive.enabled": "true",
                              "spark.sql.adaptive.advisoryPartitionSizeInBytes": target_bytes})
    rows = own.table(table).where(F.col(partition_column).isin(crowded))
    done = publish_partitions(rows.hint("rebalance", F.col(partition_column)), table, base, partition_column)
    spark.catalog.refreshTable(table)  # what this session knows of the files
    return done
