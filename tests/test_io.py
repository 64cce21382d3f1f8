"""Sources and sinks on temporary directories (SRC1-SRC3, SRC9, SNK1-SNK3, SNK10, SNK11, SNK13)."""

import json
import os

import pytest

from pyspark.sql import functions as F

from ledgerline.sinks import writers as W
from ledgerline.sources import files as S

MOVIES = {"movie": [
    {"Id": 1, "Title": "A", "RunTime": -5, "Budget": 10.0, "UpdatedBy": None,
     "genres": [{"id": 1, "name": "Drama"}, {"id": 2, "name": ""}]},
    {"Id": 2, "Title": "B", "RunTime": 90, "Budget": 2e6, "genres": []},
    {"Id": 3, "Title": "C", "RunTime": None, "Budget": None, "genres": None},
]}


def test_multiline_json_wildcard(spark, tmp_dir):
    for i in (1, 2):
        with open(os.path.join(tmp_dir, f"movie_{i}.json"), "w") as f:
            json.dump(MOVIES, f, indent=4)
    raw = S.read_multiline_json_array(spark, os.path.join(tmp_dir, "movie_*.json"), "movie")
    vals = [r.value for r in raw.collect()]
    assert len(vals) == 6 and len(set(vals)) == 3
    assert all(v.startswith("{") for v in vals)


def test_replaced_partitions_of_own_input(spark, tmp_dir):
    base = os.path.join(tmp_dir, "bronze")
    W.append_rows(spark.createDataFrame([(1, "new", "a"), (2, "new", "a"), (3, "new", "b")], "k int, status string, d string"), base, "d")
    before = sorted(os.listdir(os.path.join(base, "d=b")))
    rows = spark.read.parquet(base).where("d = 'a'")
    W.replace_partitions(rows.withColumn("status", F.when(F.col("k") == 1, "loaded").otherwise(F.col("status"))), base, "d")
    assert sorted((r.k, r.status) for r in spark.read.parquet(base).collect()) == [(1, "loaded"), (2, "new"), (3, "new")]
    assert sorted(os.listdir(os.path.join(base, "d=b"))) == before


def test_only_a_missing_path_counts_as_no_table(spark, tmp_dir):
    assert W.read_or_none(spark, os.path.join(tmp_dir, "nothing")) is None
    broken = os.path.join(tmp_dir, "broken")
    os.makedirs(broken)
    with open(os.path.join(broken, "part-0.parquet"), "w") as f:
        f.write("this is no table")
    with pytest.raises(Exception):
        W.read_or_none(spark, broken).count()


def test_inserts_go_by_name(spark):
    spark.sql("DROP TABLE IF EXISTS ll_by_name")
    spark.sql("CREATE TABLE ll_by_name (a STRING, b STRING) USING parquet")
    W.write_table(spark.createDataFrame([("B", "A")], "b string, a string"), "ll_by_name")
    assert tuple(spark.table("ll_by_name").select("a", "b").first()) == ("A", "B")
    spark.sql("DROP TABLE ll_by_name")


def test_batch_writer_partitions_and_excludes(spark, tmp_dir):
    df = spark.createDataFrame([(1, "x", "2024-01-01"), (2, "y", "2024-01-02")], "k int, junk string, d string")
    path = os.path.join(tmp_dir, "out")
    W.batch_writer(df, partition_column="d", exclude_columns=["junk"], mode="overwrite").save(path)
    back = spark.read.parquet(path)
    assert sorted(back.columns) == ["d", "k"]
    assert sorted(p for p in os.listdir(path) if p.startswith("d=")) == ["d=2024-01-01", "d=2024-01-02"]


def test_people_files_with_any_header(spark, tmp_dir):
    from ledgerline.plans import flows as FL
    p1, p2 = (os.path.join(tmp_dir, f"people_{i}.txt") for i in (1, 2))
    with open(p1, "w") as f:
        f.write("first last middle phone address_no address\n")
        f.write("john  o'neil\tx 1234567890 123456 main street\n\ntoo short\n")
    with open(p2, "w") as f:
        f.write("Vorname,Name \"x\n")
        f.write("first last middle phone address_no address\n")
        f.write('ann "lee" y 0987654321 77 "side, road\nJOHN O\'NEIL x 1234567890 123456 main street\n')
    tokens = [r.tokens for r in S.read_people_text(spark, [p1]).collect()]
    assert ["john", "o'neil", "x", "1234567890", "123456", "main", "street"] in tokens and len(tokens) == 2
    out, bad = os.path.join(tmp_dir, "csv"), os.path.join(tmp_dir, "bad")
    assert FL.people_files_to_csv(spark, [p1, p2], out, bad) == 3
    lines = sorted(x for name in os.listdir(out) if name.startswith("part-") for x in open(os.path.join(out, name)).read().splitlines())
    assert lines == ['Ann,"Lee",y,098-765-4321,77,"side,,road', "First,Last,middle,phone,s_no,address", "John,O'Neil,x,123-456-7890,3456,main,street"]
    assert [r.value for r in spark.read.text(bad).collect()] == ["too short"]


def test_csv_and_split_json_sinks(spark, tmp_dir):
    df = spark.createDataFrame([(i, i % 3 + 1) for i in range(9)], "k int, split_id int")
    W.write_lines(df.select(F.concat_ws(",", "k", "split_id").alias("line")), os.path.join(tmp_dir, "csv"), single_file=True)
    parts = [p for p in os.listdir(os.path.join(tmp_dir, "csv")) if p.endswith(".txt")]
    assert len(parts) == 1
    assert open(os.path.join(tmp_dir, "csv", parts[0])).read().splitlines()[0] == "0,1"
    W.write_split_json(df, os.path.join(tmp_dir, "wrapped"), array_field="movie")
    lines = spark.read.json(os.path.join(tmp_dir, "wrapped")).select(F.explode("movie").alias("m"), "split_id")
    assert sorted((r.m.k, r.split_id) for r in lines.collect()) == [(i, i % 3 + 1) for i in range(9)]
    W.write_split_json(df, os.path.join(tmp_dir, "split"))
    assert sorted(p for p in os.listdir(os.path.join(tmp_dir, "split")) if p.startswith("split_id=")) == \
        ["split_id=1", "split_id=2", "split_id=3"]


def test_register_table(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    spark.range(3).write.parquet(path)
    W.register_table(spark, "ll_registered", path)
    assert spark.table("ll_registered").count() == 3
    spark.sql("DROP TABLE IF EXISTS ll_registered")


def test_json_lines_declared_schema_and_parquet_drift(spark, tmp_dir):
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    p = os.path.join(tmp_dir, "lines.json")
    with open(p, "w") as f:
        f.write('{"a": 1, "b": "x", "extra": true}\n{"a": 2}\n')
    schema = StructType([StructField("a", LongType()), StructField("b", StringType())])
    assert sorted(tuple(r) for r in S.read_json_lines(spark, p, schema).collect()) == [(1, "x"), (2, None)]
    d = os.path.join(tmp_dir, "drift")
    spark.createDataFrame([(1,)], "a long").write.parquet(os.path.join(d, "k=1"))
    spark.createDataFrame([(2, "y")], "a long, b string").write.parquet(os.path.join(d, "k=2"))
    merged = S.read_parquet_declared(spark, d, merge_schema=True)
    assert sorted(merged.columns) == ["a", "b", "k"]


def test_status_scan_first_value_truncate_and_merge(spark, tmp_dir):
    path = os.path.join(tmp_dir, "bronze_tbl")
    W.write_parquet_truncate(spark.createDataFrame([("v1", "new"), ("v2", "loaded")], "value string, status string"),
                             path)
    W.write_parquet_truncate(spark.createDataFrame([("v3", "new")], "value string, status string"), path)
    W.register_table(spark, "ll_bronze", path)
    assert [r.value for r in S.read_table_with_status(spark, "ll_bronze", "new").collect()] == ["v3"]
    spark.sql("DROP TABLE IF EXISTS ll_bronze")
    assert S.first_value(spark.range(5).agg(F.max("id").alias("m")), "m") == 4
    src = os.path.join(tmp_dir, "many")
    os.makedirs(src)
    for i in range(3):
        with open(os.path.join(src, f"part_{i}.json"), "w") as f:
            json.dump([{"i": i}], f)
    W.merge_files(spark, os.path.join(src, "part_*.json"), os.path.join(tmp_dir, "merged"), single_file=True)
    assert sorted(r.i for r in spark.read.json(os.path.join(tmp_dir, "merged")).collect()) == [0, 1, 2]


def test_union_by_name_fills_missing(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(2,)], "k int")
    assert sorted(tuple(r) for r in a.unionByName(b, allowMissingColumns=True).collect()) == [(1, "x"), (2, None)]


def test_people_and_split_file_jobs(spark, tmp_dir):
    from ledgerline.plans import flows as FL
    p1, p2 = os.path.join(tmp_dir, "people_1.txt"), os.path.join(tmp_dir, "people_2.txt")
    header = "first last middle phone address_no address\n"
    with open(p1, "w") as f:
        f.write(header + "john o'neil x 1234567890 123456 main street\nann lee x 5551234 99 elm\n")
    with open(p2, "w") as f:
        f.write(header + "JOHN  O'NEIL\tx 1234567890 123456 main street\n")
    out = os.path.join(tmp_dir, "people_csv")
    assert FL.people_files_to_csv(spark, [p1, p2], out) == 2
    assert FL.people_files_to_csv(spark, [p1, p2], out) == 2   # re-run does not double the output
    movies = {"movie": [{"Id": i, "Title": f"m{i}"} for i in range(19)]}
    mp = os.path.join(tmp_dir, "movie.json")
    with open(mp, "w") as f:
        json.dump(movies, f)
    counts = FL.split_json_file(spark, mp, os.path.join(tmp_dir, "splits"))
    assert counts == {1: 2, 2: 2, 3: 2, 4: 2, 5: 2, 6: 2, 7: 2, 8: 5}


def test_write_table_typed(spark):
    from pyspark.sql.types import DecimalType, IntegerType, StructField, StructType
    schema = StructType([StructField("OrderID", IntegerType(), False), StructField("OrderTotal", DecimalType(19, 4))])
    spark.sql("DROP TABLE IF EXISTS ll_ods_orders")
    W.write_table(spark.createDataFrame([(1, 2.5)], "OrderID long, OrderTotal double"), "ll_ods_orders", schema)
    W.write_table(spark.createDataFrame([(2, 1.0)], "OrderID long, OrderTotal double"), "ll_ods_orders", schema)
    rows = sorted((r.OrderID, str(r.OrderTotal)) for r in spark.table("ll_ods_orders").collect())
    assert rows == [(1, "2.5000"), (2, "1.0000")]
    spark.sql("DROP TABLE IF EXISTS ll_ods_orders")
