"""Window operators that stay parallel when one partition key is hot.

``LEAD(x) OVER (PARTITION BY k ORDER BY x)`` puts every row of a key into
one task.  :func:`split_lead` gives the same multiset of rows while a hot
key is cut into ordered chunks that different tasks handle:

1. every row gets a chunk ``(k, bucket(x))`` where ``bucket`` is monotone in
   ``x`` (default: the calendar day of a timestamp);
2. inside a chunk ``lead`` is an ordinary window;
3. the last row of a chunk takes the first value of the key's next
   non-empty chunk, read from one summary row per chunk.

The chunking is a pure function of the row, so a re-executed task sees the
same chunks.  Rows of one key on one bucket stay together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def day_bucket(col: str) -> Column:
    return F.floor(F.unix_seconds(F.col(col).cast("timestamp")) / 86400)


def split_lead(df: DataFrame, key: str, order_col: str, out_col: str, bucket: Column | None = None) -> DataFrame:
    """``df`` plus ``out_col = LEAD(order_col) OVER (PARTITION BY key ORDER BY order_col)``.

    Rows with equal ``order_col`` inside a key are interchangeable, so the
    multiset of output rows equals the plain window's.  ``bucket`` must be
    non-decreasing in ``order_col`` (NULLs bucket first, as they sort first).
    """
    b = bucket if bucket is not None else day_bucket(order_col)
    x = df.withColumn("_bucket", b)
    w = Window.partitionBy(key, "_bucket").orderBy(order_col)
    local = x.withColumn("_has_next", F.lead(F.lit(True)).over(w)).withColumn("_lead", F.lead(order_col).over(w))
    firsts = x.groupBy(key, "_bucket").agg(F.min(order_col).alias("_first"))
    per_key = Window.partitionBy(key).orderBy(F.col("_bucket").asc_nulls_first())
    nxt = firsts.select(F.col(key).alias("_k"), F.col("_bucket").alias("_b"),
                        F.lead("_first").over(per_key).alias("_next_first"))
    j = local.join(nxt, F.col(key).eqNullSafe(F.col("_k")) & F.col("_bucket").eqNullSafe(F.col("_b")), "left")
    return (j.withColumn(out_col, F.when(F.col("_has_next"), F.col("_lead")).otherwise(F.col("_next_first")))
            .drop("_bucket", "_has_next", "_lead", "_k", "_b", "_next_first"))
