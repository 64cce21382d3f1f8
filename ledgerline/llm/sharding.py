"""Contiguous shards of near-equal bytes from global prefix sums.

Rows are range-partitioned into the order (id, checksum, size).  Each range
partition's total goes to the driver (one row a partition), the running sum of
these totals is every partition's offset, and a window inside each partition
adds the rows' own running sum.  A row whose middle byte lies in the k-th of
``shards`` equal parts of all bytes goes to shard k, so that shards are
contiguous and differ by less than one row's size from the target.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import shuffle_partitions, stored, text_or_empty

#: Bytes that a row takes beside its text.
ROW_BYTES = 16


def byte_shards(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text",
                row_bytes: int = ROW_BYTES, partitions: int | None = None) -> DataFrame:
    """One row per input row: id, size, text_crc32, shard, slot.

    Nulls: a null text has no bytes (its size is ``row_bytes``) and the checksum
    of an empty text; null ids come first.  Rows with equal ids are ordered by
    checksum, then size; rows equal in all three are interchangeable.  An empty
    table gives an empty result.  Other columns are ignored.  A row larger than
    a shard's target takes a shard (or several shards' places) by itself, so
    shards may then be empty.
    """
    spark = docs.sparkSession
    n = partitions or shuffle_partitions(spark)
    slim = stored(docs.select(
        F.col(id_col).alias("_id"),
        (F.octet_length(text_or_empty(text_col)).cast("long") + F.lit(row_bytes)).alias("size"),
        F.crc32(text_or_empty(text_col).cast("binary")).alias("text_crc32"),
    ), "shard-sizes")
    # The partition number is written with the row, so it can't change later.
    order = [F.col("_id").asc_nulls_first(), F.col("text_crc32"), F.col("size")]
    ranged = stored(slim.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()), "shard-ranges")

    totals = ranged.groupBy("_part").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()
    offsets, bytes_before, rows_before = [], 0, 0
    for r in sorted(totals, key=lambda r: r["_part"]):
        offsets.append((r["_part"], bytes_before, rows_before))
        bytes_before, rows_before = bytes_before + r["b"], rows_before + r["n"]
    schema = T.StructType([T.StructField("_part", T.IntegerType()), T.StructField("_bytes0", T.LongType()),
                           T.StructField("_rows0", T.LongType())])
    before = F.broadcast(spark.createDataFrame(offsets, schema))  # one row a partition

    w = Window.partitionBy("_part").orderBy(*order)
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = max(bytes_before, 1)
    placed = (
        ranged.join(before, "_part")
        .withColumn("_end", F.col("_bytes0") + F.sum("size").over(running))
        .withColumn("_row", F.col("_rows0") + F.row_number().over(w) - F.lit(1))
        .withColumn("shard", F.least(F.lit(shards - 1), F.expr(
            f"cast((cast(2 * _end - size as decimal(38,0)) * {shards}) div {2 * total} as int)")))
        .select("_id", "size", "text_crc32", "shard", "_row")
    )
    placed = stored(placed, "shard-places")
    first = F.broadcast(placed.groupBy("shard").agg(F.min("_row").alias("_first")))  # one row a shard
    return placed.join(first, "shard").select(
        F.col("_id").alias(id_col), "size", "text_crc32", "shard", (F.col("_row") - F.col("_first")).alias("slot"))
