"""Row numbers for documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import stored


def numbered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(_row, _id, _text, ``keep``): _row is the id where ids are unique whole numbers, else a number written with the row."""
    slim = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"), *(keep or []))
    if isinstance(docs.schema[id_col].dataType, (T.LongType, T.IntegerType, T.ShortType)):
        twice = slim.groupBy("_id").count().where((F.col("count") > 1) | F.col("_id").isNull()).limit(1).count()
        if not twice:
            return slim.withColumn("_row", F.col("_id").cast("long"))
    return stored(slim.withColumn("_row", F.monotonically_increasing_id()), "numbered")
