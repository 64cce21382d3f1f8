"""Quarantine split, repair and constraint checks (FLT9, QA1-QA5, S21, S22, S33)."""

import pytest

from ledgerline.operators import quality as Q

ROWS = [("ok", 10, 2e6), ("neg", -5, 2e6), ("cheap", 10, 5.0), ("both", -1, 1.0),
        ("nullrt", None, 2e6), ("nullbud", -3, None), ("nulls", None, None)]


def test_split_has_three_disjoint_buckets(spark):
    df = spark.createDataFrame(ROWS, "value string, runtime int, budget double")
    clean, quar, uncl = Q.split_clean_quarantine(df)
    c = {r.value for r in clean.collect()}
    q = {r.value for r in quar.collect()}
    u = {r.value for r in uncl.collect()}
    assert c == {"ok"} and q == {"neg", "cheap", "both", "nullbud"} and u == {"nullrt", "nulls"}
    assert c | q | u == {r[0] for r in ROWS}
    labels = {r.value: r.quality_status for r in Q.classify(df).collect()}
    assert labels["nullrt"] == Q.UNCLASSIFIED and labels["ok"] == Q.CLEAN


def test_repair_single_pass(spark):
    df = spark.createDataFrame(ROWS, "value string, runtime int, budget double")
    out = {r.value: (r.runtime, r.budget) for r in Q.repair(df).collect()}
    assert out["both"] == (1, 1e6)
    assert out["nullbud"] == (3, None)
    assert out["ok"] == (10, 2e6)


def test_defect_counts(spark):
    df = spark.createDataFrame(ROWS, "value string, runtime int, budget double")
    r = Q.defect_counts(df).first()
    assert (r.negative_runtime, r.low_budget) == (3, 2)


def test_lookup_genres_and_dispatch(spark):
    df = spark.createDataFrame([([(2, "b"), (1, "a"), (3, "")],), ([(1, "a")],), (None,), ([],)],
                               "genres array<struct<id:int,name:string>>")
    assert [tuple(r) for r in Q.lookup_table(df, "genres").collect()] == [(1, "a"), (2, "b")]
    assert [tuple(r) for r in Q.lookup_table(df, "original_languages").collect()] == [(1, "English")]
    with pytest.raises(ValueError):
        Q.lookup_table(df, "colours")


def test_constraints(spark):
    child = spark.createDataFrame([(1, 10), (1, 11), (2, 99), (None, 10)], "k int, fk int")
    parent = spark.createDataFrame([(10,), (11,)], "pk int")
    pk = {(r.key_value, r.n_rows) for r in Q.primary_key_violations(child, "c", ["k"]).collect()}
    assert pk == {("1", 2), ("", 1)} or pk == {("1", 2), (None, 1)}
    fk = [(r.key_value, r.n_rows) for r in Q.foreign_key_violations(child, "c", {"fk": (parent, "pk")}).collect()]
    assert fk == [("99", 1)]
    nn = [r.key_value for r in Q.not_null_violations(child, "c", ["k"], ["fk"]).collect()]
    assert nn == ["10"]
