"""Sensor stream: 5-second tumbling-window averages per device (P6, ST1-ST5).

The same column logic serves the batch query and the Structured Streaming
job; the stream adds an event-time watermark so window state is bounded
and evicted.

Whole-number averages are exact sums divided once; ``average_uv`` is a plain
double average, whose last bits depend on the order of the sum.
"""

from __future__ import annotations

import datetime as dt

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampNTZType

from ledgerline.functions import dialect as D
from ledgerline.functions import json as J
from ledgerline.sinks import writers as WR
from ledgerline.streaming import ingest as IN

WINDOW = "5 seconds"
SWEATY_LIMIT = 85

EVENT_SCHEMA = StructType([
    StructField("event_id", LongType()), StructField("ts", TimestampNTZType()),
    StructField("user_id", LongType()), StructField("event_type", StringType()),
    StructField("value", DoubleType()), StructField("props", StringType()),
])


def sensor_readings(events: DataFrame) -> DataFrame:
    """Sensor view of the events table: device id, event time, uv, temperature, humidity."""
    return events.select(
        F.col("user_id").alias("id"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("uv"),
        J.json_path_text("props", "$.k").try_cast("int").alias("temperature"),
        F.floor("value").cast("int").alias("humidity"),
    )


def _exact_avg(col):
    """Average of a column of whole numbers, the same in whatever order they are summed."""
    n = F.count(col)
    return F.when(n > 0, F.sum(F.col(col).cast("long")).cast("double") / n)


def five_second_averages(readings: DataFrame, window: str = WINDOW) -> DataFrame:
    """ST2/ST3: per device and tumbling window: averages, sweaty flag, mean event time.

    Windows are ``[start, end)``.  The flag needs both averages strictly
    above the limit (an average of exactly 85 gives 0).
    """
    w = F.window("timestamp", window)
    g = readings.groupBy(F.col("id"), w.alias("w")).agg(
        F.avg("uv").alias("average_uv"),
        _exact_avg("temperature").alias("average_temperature"),
        _exact_avg("humidity").alias("average_humidity"),
        D.mean_instant("timestamp").alias("estimated_time"),
    )
    return g.select(
        "id",
        F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"),
        "average_uv", "average_temperature", "average_humidity",
        F.when((F.col("average_temperature") > SWEATY_LIMIT) & (F.col("average_humidity") > SWEATY_LIMIT), 1)
        .otherwise(0).alias("is_sweaty"),
        "estimated_time",
    )


def read_event_stream(spark: SparkSession, path: str, fmt: str = "parquet",
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """ST1 source: a file stream of events with a pinned schema."""
    r = spark.readStream.schema(EVENT_SCHEMA).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def streaming_averages(events: DataFrame, delay: str = "10 seconds") -> DataFrame:
    """ST1 + ST5: event time as a (zoned) timestamp with a lateness bound, then ST2/ST3.

    ``withWatermark`` rejects ``timestamp_ntz``; the session time zone is
    UTC, so the cast keeps the instant.  Events later than ``delay`` behind
    the maximum seen event time are dropped and window state is evicted.
    """
    r = sensor_readings(events).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    return five_second_averages(r.withWatermark("timestamp", delay))


def start_sink(result: DataFrame, checkpoint: str, mode: str = "append", fmt: str = "parquet",
               path: str | None = None, query_name: str | None = None,
               available_now: bool = False) -> StreamingQuery:
    """ST4/SNK12: continuous write with a checkpoint (recoverable after failure).

    ``append`` emits a window once the watermark passes its end; ``complete``
    (memory/console sinks) re-emits all windows every trigger.
    """
    w: DataStreamWriter = result.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    if available_now:
        w = w.trigger(availableNow=True)
    if fmt in ("memory", "console"):
        return w.format(fmt).start()
    return w.format(fmt).start(path)


def run_sensor_stream(spark: SparkSession, source: str, sink: str, checkpoint: str, delay: str = "10 seconds",
                      available_now: bool = False) -> StreamingQuery:
    """P6 as a running job: event files in ``source`` -> 5-second averages appended to ``sink``."""
    return start_sink(streaming_averages(read_event_stream(spark, source), delay), checkpoint,
                      mode="append", fmt="parquet", path=sink, available_now=available_now)


# Payload of one sensor message (FIXTURES 1.8).
MESSAGE_SCHEMA = StructType([
    StructField("id", StringType()), StructField("timestamp", StringType()),
    StructField("uv", DoubleType()), StructField("temperature", LongType()), StructField("humidity", LongType()),
])


def sensor_messages(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """ST1 for raw message bodies (e.g. a text/Kafka ``value`` column): parse the JSON
    payload and use its ``timestamp`` field as event time (``TIMESTAMP BY``).

    Messages without a readable event time belong to no window; they are left
    to :func:`rejected_messages`.
    """
    return _parsed(messages, value_col).where(F.col("timestamp").isNotNull()).drop("value")


def _parsed(messages: DataFrame, value_col: str) -> DataFrame:
    text = F.col(value_col).cast("string")
    return messages.select(text.alias("value"), F.inline_outer(F.array(F.from_json(text, MESSAGE_SCHEMA)))).select(
        "value", "id", F.try_to_timestamp("timestamp").cast("timestamp_ntz").alias("timestamp"),
        "uv", "temperature", "humidity")


def rejected_messages(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """Bodies that are no sensor message or carry no readable event time, as given."""
    return _parsed(messages, value_col).where(F.col("timestamp").isNull()).select("value")


def streaming_message_averages(messages: DataFrame, value_col: str = "value",
                               delay: str = "10 seconds") -> DataFrame:
    """P6 over a message stream: parse, bound lateness, 5-second windows."""
    r = sensor_messages(messages, value_col).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    return five_second_averages(r.withWatermark("timestamp", delay))


# --- every message in exactly one place (SRC11, SNK12, ST5) -------------------

def is_late(timestamp: str | Column, watermark: Column, window: str = WINDOW) -> Column:
    """ST5: the row's window had closed when it came, i.e. its end isn't after the watermark.

    A stream with that watermark drops such rows (Spark's operators judge a batch
    that follows another at once by the watermark before that, and so may still
    take some).  No watermark yet (NULL): nothing is late.  The end is computed, as ``window()`` would drop rows without a time.
    """
    time = F.col(timestamp) if isinstance(timestamp, str) else timestamp
    at = F.unix_micros(time.cast("timestamp"))
    width = F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"INTERVAL {window}"))
    end = F.timestamp_micros(at - F.pmod(at, width) + width).cast("timestamp_ntz")
    return F.coalesce(end <= watermark, F.lit(False))


def batch_watermarks(rows: DataFrame, batch_col: str, time_col: str, delay: str) -> DataFrame:
    """Per batch, ``watermark``: the latest event time of the batches before it less ``delay`` (NULL for the first).

    One row per batch, so the unpartitioned window is over a bounded frame as long as batches are
    (a row per trigger or day).
    """
    latest = rows.groupBy(batch_col).agg(F.max(time_col).alias("_latest"))
    before = Window.orderBy(batch_col).rowsBetween(Window.unboundedPreceding, -1)
    return latest.select(batch_col, (F.max("_latest").over(before) - F.expr(f"INTERVAL {delay}")).alias("watermark"))


def split_late(rows: DataFrame, batch_col: str, time_col: str = "timestamp", delay: str = "10 seconds",
               window: str = WINDOW) -> DataFrame:
    """``rows`` with ``late``: had their window closed, if they came ``batch_col`` by ``batch_col``."""
    marks = batch_watermarks(rows, batch_col, time_col, delay)
    named = marks.withColumnRenamed(batch_col, "_batch")
    out = rows.join(F.broadcast(named), F.col(batch_col).eqNullSafe(F.col("_batch")))  # one row a batch
    return out.withColumn("late", is_late(time_col, F.col("watermark"), window)).drop("_batch", "watermark")


class SensorSinks:
    """P6's messages by ``foreachBatch``, each in exactly one of three tables below ``base``:
    ``readings`` (on time), ``late`` and ``rejected``.

    Every table is partitioned by the batch's number and a batch replaces its own
    partition, so one that is repeated after a failure leaves each message once.
    ``progress`` holds the latest event time by batch; a batch is judged by the
    batches before it, so that a repeated batch is judged alike.  The checkpoint belongs to the tables.
    """

    def __init__(self, base: str, checkpoint: str, delay: dt.timedelta = dt.timedelta(seconds=10), window: str = WINDOW):
        self.base, self.checkpoint, self.delay, self.window = base, checkpoint, delay, window

    def table(self, name: str) -> str:
        return f"{self.base}/{name}"

    def watermark(self, spark: SparkSession, batch_id: int | None = None) -> dt.datetime | None:
        """After all batches, or the one that batch ``batch_id`` is judged by."""
        progress = WR.read_or_none(spark, self.table("progress"))
        if progress is None:
            return None
        if batch_id is not None:
            progress = progress.where(F.col(IN.BATCH) < batch_id)
        latest = progress.agg(F.max("latest")).first()[0]
        return None if latest is None else latest - self.delay

    def handle(self, batch: DataFrame, batch_id: int) -> None:
        spark, batch_id = batch.sparkSession, int(batch_id)
        mark = F.lit(self.watermark(spark, batch_id)).cast("timestamp_ntz")
        rows = _parsed(batch, "value").withColumn("late", is_late("timestamp", mark, self.window))
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)  # three sinks, one parse
        try:
            read = F.col("timestamp").isNotNull()
            for name, part in (("readings", rows.where(read & ~F.col("late")).drop("value", "late")),
                               ("late", rows.where(read & F.col("late")).drop("value", "late")),
                               ("rejected", rows.where(~read).select("value")),
                               ("progress", rows.agg(F.max("timestamp").alias("latest")))):
                WR.replace_partitions(part.withColumn(IN.BATCH, F.lit(batch_id)), self.table(name), IN.BATCH)
        finally:
            rows.unpersist()

    def run(self, messages: DataFrame) -> None:
        """Take what has come since the last run; ``messages`` is a stream with the bodies in ``value``."""
        IN.run_available(messages.select(F.col("value").cast("string").alias("value")), self.handle, self.checkpoint)

    def closed_windows(self, spark: SparkSession) -> DataFrame:
        """The averages of all windows that the watermark has passed; no later message changes them."""
        readings = spark.read.parquet(self.table("readings")).drop(IN.BATCH)
        mark = F.lit(self.watermark(spark)).cast("timestamp_ntz")
        return five_second_averages(readings, self.window).where(F.col("window_end") <= mark)
