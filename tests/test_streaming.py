"""Sensor stream (P6): file source, availableNow trigger, complete vs append, late data."""

import datetime as dt
import os

from ledgerline.streaming import sensor as S


def ev(i, ts, user, value, k):
    return (i, ts, user, "view", value, '{"k": %d}' % k)


def write_batch(spark, path, rows, name):
    spark.createDataFrame(rows, S.EVENT_SCHEMA).coalesce(1).write.mode("overwrite").parquet(os.path.join(path, name))


BASE = dt.datetime(2024, 1, 1, 0, 0, 0)
ROWS = [ev(1, BASE, 1, 0.5, 90), ev(2, BASE + dt.timedelta(seconds=4, microseconds=999999), 1, 0.25, 88),
        ev(3, BASE + dt.timedelta(seconds=5), 1, 0.1, 70),        # exactly on the edge: next window
        ev(4, BASE + dt.timedelta(seconds=2), 2, 0.2, 85),        # average exactly 85 -> not sweaty
        ev(5, BASE + dt.timedelta(seconds=61), 2, 0.9, 99)]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_complete_mode_equals_batch(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    write_batch(spark, src, ROWS, "b1")
    stream = S.read_event_stream(spark, os.path.join(src, "*"))
    q = S.start_sink(S.five_second_averages(S.sensor_readings(stream)), os.path.join(tmp_dir, "ck"),
                     mode="complete", fmt="memory", query_name="sensor_complete", available_now=True)
    q.awaitTermination(120)
    got = spark.table("sensor_complete")
    batch = S.five_second_averages(S.sensor_readings(spark.createDataFrame(ROWS, S.EVENT_SCHEMA)))
    assert rows(got) == rows(batch)
    edge = {(r.id, r.window_start): r for r in batch.collect()}
    assert edge[(1, BASE)].average_temperature == 89.0 and edge[(1, BASE)].is_sweaty == 0
    assert edge[(1, BASE + dt.timedelta(seconds=5))].average_uv == 0.1
    assert edge[(2, BASE)].is_sweaty == 0


def test_append_mode_watermark_drops_late(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    write_batch(spark, src, ROWS, "b1")
    stream = S.read_event_stream(spark, os.path.join(src, "*"), max_files_per_trigger=1)
    out = os.path.join(tmp_dir, "out")
    ck = os.path.join(tmp_dir, "ck")
    q = S.start_sink(S.streaming_averages(stream, delay="10 seconds"), ck, mode="append", fmt="parquet",
                     path=out, available_now=True)
    q.awaitTermination(120)
    # A late event for the first window arrives after the watermark moved past it.
    write_batch(spark, src, [ev(6, BASE + dt.timedelta(seconds=1), 1, 0.3, 50),
                             ev(7, BASE + dt.timedelta(seconds=200), 3, 0.3, 50)], "b2")
    q = S.start_sink(S.streaming_averages(S.read_event_stream(spark, os.path.join(src, "*"), max_files_per_trigger=1),
                                          delay="10 seconds"), ck, mode="append", fmt="parquet",
                     path=out, available_now=True)
    q.awaitTermination(120)
    res = spark.read.parquet(out)
    first = [r for r in res.collect() if r.id == 1 and r.window_start == BASE]
    assert len(first) == 1 and first[0].average_temperature == 89.0
    # Windows whose end is past the final watermark stay open (not emitted) in append mode.
    assert not [r for r in res.collect() if r.id == 3]


def test_json_message_stream(spark, tmp_dir):
    import json
    src = os.path.join(tmp_dir, "msgs")
    os.makedirs(src)
    msgs = [{"id": "dev1", "timestamp": "2024-01-01T00:00:01", "uv": 0.5, "temperature": 90, "humidity": 88},
            {"id": "dev1", "timestamp": "2024-01-01T00:00:03", "uv": 0.25, "temperature": 86, "humidity": 86},
            {"id": "dev2", "timestamp": "2024-01-01T00:00:02", "uv": 0.1, "temperature": 85, "humidity": 99}]
    with open(os.path.join(src, "m1.txt"), "w") as f:
        f.write("\n".join(json.dumps(m) for m in msgs) + "\n")
    stream = spark.readStream.format("text").load(src)
    q = S.start_sink(S.five_second_averages(S.sensor_messages(stream)), os.path.join(tmp_dir, "ck"),
                     mode="complete", fmt="memory", query_name="sensor_msgs", available_now=True)
    q.awaitTermination(120)
    got = {r.id: (r.average_uv, r.average_temperature, r.is_sweaty, r.estimated_time)
           for r in spark.table("sensor_msgs").collect()}
    assert got["dev1"] == (0.375, 88.0, 1, BASE + dt.timedelta(seconds=2))
    assert got["dev2"][2] == 0                # temperature average exactly 85 is not sweaty
    streaming = S.streaming_message_averages(spark.readStream.format("text").load(src))
    assert streaming.isStreaming


def test_many_digits_and_malformed_messages(spark):
    day = "2024-01-01 00:00:0"
    body = lambda i, t, uv: f'{{"id": "d{i}", "timestamp": "{t}", "uv": {uv}, "temperature": 90, "humidity": 90}}'
    messages = spark.createDataFrame([(x,) for x in (
        body(1, day + "1", 0.123456), body(1, day + "2", 0.004), body(2, "tomorrow", 0.5), "no json at all", '{"id": "d3"}', None)],
        "value string")
    out = S.five_second_averages(S.sensor_messages(messages)).collect()
    assert [(r.id, round(r.average_uv, 9), r.is_sweaty) for r in out] == [("d1", 0.063728, 1)]
    assert S.rejected_messages(messages).count() == 4
    odd = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), 1, "x", 2.5, '{"k": "warm"}')], S.EVENT_SCHEMA)
    assert S.sensor_readings(odd).first().temperature is None
