"""New raw files only (P1, SRC1-SRC3): a file stream whose checkpoint is the ledger of files taken.

Every run takes the files that no earlier run has taken and ends.  A batch's
files, number and arrival time are fixed in the checkpoint before its first row
is written, so a batch that died is repeated alike, and a sink that replaces the
rows of that batch number holds each row once.  The checkpoint belongs to the
sinks: keep or remove them together.

A document is read once, whatever its fields: its text becomes one variant, so
that there is no pass to infer a schema, and fields that no schema names survive.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH = "p_batch"


def new_documents(spark: SparkSession, pattern: str, files_per_batch: int | None = None) -> DataFrame:
    """A stream of whole files: ``file``, ``text`` and the time at which their batch was planned (``arrived``)."""
    reader = spark.readStream.format("text").option("wholetext", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(pattern).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"),
                                       F.current_timestamp().alias("arrived"))


def with_items(docs: DataFrame, array_field: str) -> DataFrame:
    """The elements of each document's array as variants, ``items``; NULL if the text is no such document."""
    return docs.withColumn("items", F.try_variant_get(F.try_parse_json("text"), f"$.{array_field}", "array<variant>"))


def item_texts(shredded: DataFrame) -> DataFrame:
    """One row per element: its JSON text (``value``, keys in order, NULLs kept) and ``arrived``."""
    items = shredded.where(F.col("items").isNotNull()).select("arrived", F.explode("items").alias("item"))
    return items.select(F.to_json("item").alias("value"), "arrived")


def unreadable(shredded: DataFrame) -> DataFrame:
    """Files that are no document with the array, whole."""
    return shredded.where(F.col("items").isNull()).select("file", "text", "arrived")


def run_available(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Hand over what has come since the last run, batch by batch; raises what ``handle`` raises."""
    query = (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
