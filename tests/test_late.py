"""Rejected and late messages as outputs (SRC11, SNK12, ST5)."""

import datetime as dt
import json
import os
import time

import pytest

from ledgerline.sinks import writers as WR
from ledgerline.streaming import sensor as S

BASE = dt.datetime(2024, 1, 1)


def body(device, second, uv=0.5):
    return json.dumps({"id": device, "timestamp": (BASE + dt.timedelta(seconds=second)).isoformat(), "uv": uv,
                       "temperature": 90, "humidity": 88})


# "edge" and the reading at 46 s lie in windows that end exactly at the watermark (15 s, 50 s).
FILES = [[body("a", 1), body("a", 4), body("b", 25), "no json"],
         [body("late", 3), body("edge", 14), body("open", 15), '{"id": "c"}', body("a", 60)],
         [body("late", 44), body("a", 46), body("a", 90)]]


def put(tmp_dir, i):
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src, exist_ok=True)
    path = os.path.join(src, f"m{i}.txt")
    with open(path, "w") as f:
        f.write("\n".join(FILES[i]) + "\n")
    os.utime(path, (time.time() - 100 + i, time.time() - 100 + i))
    return src


def stream(spark, src):
    return spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(src)


def ids(spark, sinks, name):
    return sorted((r.id, r.timestamp.second + 60 * r.timestamp.minute) for r in spark.read.parquet(sinks.table(name)).collect())


def averages(df):
    return sorted((r.id, r.window_start, r.average_uv, r.estimated_time) for r in df.collect())


def test_every_message_in_one_place_as_the_watermark_has_it(spark, tmp_dir):
    out = os.path.join(tmp_dir, "own")
    for i in range(len(FILES)):
        src = put(tmp_dir, i)
        # Spark's own watermark; a run for each file, as it judges the second of two batches in a row by the first's watermark.
        S.start_sink(S.streaming_message_averages(stream(spark, src)), os.path.join(tmp_dir, "ck2"), path=out,
                     available_now=True).awaitTermination(120)
    sinks = S.SensorSinks(os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck"))
    sinks.run(stream(spark, src))
    assert ids(spark, sinks, "late") == [("a", 46), ("edge", 14), ("late", 3), ("late", 44)]
    assert sorted(r.value for r in spark.read.parquet(sinks.table("rejected")).collect()) == ["no json", '{"id": "c"}']
    total = sum(spark.read.parquet(sinks.table(n)).count() for n in ("readings", "late", "rejected"))
    assert total == sum(map(len, FILES))
    assert averages(sinks.closed_windows(spark)) == averages(spark.read.parquet(out))
    before = averages(sinks.closed_windows(spark))
    sinks.run(stream(spark, src))  # nothing new
    assert averages(sinks.closed_windows(spark)) == before


@pytest.mark.parametrize("sink", ["readings", "late", "rejected", "progress"])
def test_a_batch_that_died_leaves_each_message_once(spark, tmp_dir, monkeypatch, sink):
    sinks = S.SensorSinks(os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck"))
    sinks.run(stream(spark, put(tmp_dir, 0)))
    src = put(tmp_dir, 1)
    real, died = WR.replace_partitions, []

    def dies(rows, path, *columns):
        real(rows, path, *columns)
        if path == sinks.table(sink) and not died:
            died.append(path)
            raise OSError("executor gone")
    monkeypatch.setattr(WR, "replace_partitions", dies)
    with pytest.raises(Exception, match="executor gone"):
        sinks.run(stream(spark, src))
    sinks.run(stream(spark, src))
    assert died and ids(spark, sinks, "late") == [("edge", 14), ("late", 3)]
    assert ids(spark, sinks, "readings") == [("a", 1), ("a", 4), ("a", 60), ("b", 25), ("open", 15)]
    assert spark.read.parquet(sinks.table("rejected")).count() == 2


def test_split_late_of_no_rows_and_one_batch(spark):
    df = spark.createDataFrame([(1, BASE), (1, None)], "b int, timestamp timestamp_ntz")
    assert [r.late for r in S.split_late(df, "b").collect()] == [False, False]
    assert S.split_late(df.limit(0), "b").count() == 0
