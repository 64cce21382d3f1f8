"""Row-level semantics of the dialect, text and JSON column functions."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.functions import dialect as D
from ledgerline.functions import json as J
from ledgerline.functions import text as T


def one(spark, col, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(col).collect()]


def test_datediff_days_counts_midnights(spark):
    rows = [(dt.datetime(2020, 1, 1, 23, 59), dt.datetime(2020, 1, 2, 0, 1)),
            (dt.datetime(2020, 1, 2, 0, 0), dt.datetime(2020, 1, 1, 23, 0))]
    out = one(spark, D.datediff_days("a", "b"), rows, "a timestamp_ntz, b timestamp_ntz")
    assert out == [1, -1]


def test_datediff_months_counts_boundaries(spark):
    rows = [(dt.date(2020, 1, 31), dt.date(2020, 3, 1)), (dt.date(2020, 3, 1), dt.date(2020, 3, 31)),
            (dt.date(2019, 12, 31), dt.date(2020, 1, 1))]
    out = one(spark, D.datediff_months("a", "b"), rows, "a date, b date")
    assert out == [2, 0, 1]


def test_tsql_len_ignores_trailing_blanks_only(spark):
    out = one(spark, D.tsql_len("s"), [("ab  ",), ("  ab",), ("a\t",), (None,)], "s string")
    assert out == [2, 4, 2, None]


def test_int_avg_truncates_toward_zero(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, -1), (2, -2), (3, None)], "g int, v int")
    out = dict(df.groupBy("g").agg(D.int_avg("v").alias("a")).collect())
    assert out == {1: 1, 2: -1, 3: None}


def test_mean_instant_truncates_seconds(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 0, 900000),), (dt.datetime(2024, 1, 1, 0, 0, 3),)],
                               "ts timestamp_ntz")
    assert df.agg(D.mean_instant("ts")).first()[0] == dt.datetime(2024, 1, 1, 0, 0, 1)


def test_plus_concat_propagates_null(spark):
    out = one(spark, D.plus_concat("a", F.lit(", "), "b"), [("x", "y"), ("x", None)], "a string, b string")
    assert out == ["x, y", None]


def test_pseudo_random_key_range_and_determinism(spark):
    df = spark.range(1000).select(D.pseudo_random_key("id", 13).alias("k"))
    vals = [r.k for r in df.collect()]
    assert min(vals) >= 1 and max(vals) <= 13
    assert vals == [r.k for r in df.collect()]


TITLE_CASES = ["o'neil", "mc-donald", "abc1def", "JOHN smith", "élodie d'arc", "", "x"]


def test_python_title_matches_str_title(spark):
    out = one(spark, T.python_title("s"), [(s,) for s in TITLE_CASES], "s string")
    assert out == [s.title() for s in TITLE_CASES]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="abcXYZ'- 19_é", max_size=12), min_size=1, max_size=8))
def test_python_title_property(spark, words):
    out = one(spark, T.python_title("s"), [(w,) for w in words], "s string")
    assert out == [w.title() for w in words]


def test_phone_last_chars_split(spark):
    df = spark.createDataFrame([("1234567890", "12345", "  a \t b  c ")], "p string, n string, s string")
    r = df.select(T.dash_phone("p"), T.dash_phone("n"), T.last_chars("n", 4), T.last_chars(F.lit("ab"), 4),
                  T.split_blanks("s")).first()
    assert tuple(r) == ("123-456-7890", "12345", "2345", "ab", ["a", "b", "c"])


def test_json_value_and_query(spark):
    doc = '{"a": 42, "s": "{x", "o": {"k": 1}, "arr": [1, 2], "q c": "v"}'
    df = spark.createDataFrame([(doc,)], "d string")
    r = df.select(J.json_value("d", "$.a"), J.json_value("d", "$.s"), J.json_value("d", "$.o"),
                  J.json_query("d", "$.o"), J.json_query("d", "$.a"), J.json_query("d", "$.arr"),
                  J.json_value("d", '$."q c"'), J.json_value("d", "$.missing")).first()
    assert tuple(r) == ("42", "{x", None, '{"k":1}', None, "[1,2]", "v", None)


def test_repeated_event_parses_instead_of_like(spark):
    docs = [('{"Events":[{"Event":"DeliveryAttempt"},{"Event":"DeliveryAttempt"}]}',),
            ('{"Events":[{"Event":"DeliveryAttempt"},{"Event":"Delivered","Comment":"DeliveryAttempt"}]}',),
            ('{"Events":[]}',)]
    df = spark.createDataFrame(docs, "d string")
    r = df.select(J.has_repeated_event("d", "DeliveryAttempt").alias("p"),
                  J.like_repeated("d", "DeliveryAttempt").alias("l")).collect()
    assert [x.p for x in r] == [True, False, False]
    assert [x.l for x in r] == [True, True, False]


def test_explode_rows_equals_explode(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, []), (3, None)], "k int, a array<int>")
    got = sorted(tuple(r) for r in J.explode_rows(df, "a", "x", "k").collect())
    want = sorted(tuple(r) for r in df.select("k", F.explode("a").alias("x")).collect())
    assert got == want


@pytest.mark.parametrize("year", [1996, 2000])
def test_in_year_matches_year_function(spark, year):
    rows = [(dt.datetime(year - 1, 12, 31, 23, 59, 59),), (dt.datetime(year, 1, 1),), (dt.datetime(year, 12, 31, 23),),
            (dt.datetime(year + 1, 1, 1),)]
    df = spark.createDataFrame(rows, "t timestamp_ntz")
    assert [r[0] for r in df.select(D.in_year("t", year)).collect()] == \
        [r[0] for r in df.select(F.year("t") == year).collect()]


def test_a_year_given_as_text_is_compared_as_a_number(spark):
    rows = spark.sql("SELECT TIMESTAMP_NTZ '2012-01-01 00:00:00' + make_interval(0, n) AS ts FROM (SELECT explode(sequence(0, 30)) AS n)")
    for year in ("2013", " 2013 ", 2013):
        want = rows.where(F.expr(f"year(ts) = '{year}'")).collect()
        assert rows.where(D.in_year("ts", year)).collect() == want and len(want) == 12
    assert rows.where(D.in_years("ts", "2012", "2013")).count() == rows.where("year(ts) BETWEEN 2012 AND 2013").count()
    with pytest.raises(ValueError):
        D.in_year("ts", "next")
