import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import merkle, queries
from tests.llm.helpers import SMALL, documents

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, g string, i string, n string, leaf string, path string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(digests, fanout):
    """(root, path of each place): the path as (digit, others) from below."""
    level, paths = list(digests), [[] for _ in digests]
    at = list(range(len(digests)))
    while len(level) > 1:
        runs = [level[k: k + fanout] for k in range(0, len(level), fanout)]
        for k, p in enumerate(paths):
            digit, run = at[k] % fanout, runs[at[k] // fanout]
            p.append((digit, run[:digit] + run[digit + 1:]))
            at[k] //= fanout
        level = [h(*r) for r in runs]
    return level[0], paths


def up(leaf, path):
    for digit, others in path:
        leaf = h(*others[:digit], leaf, *others[digit:])
    return leaf


def brute(rows, fanout=16):
    """[(id, leaf, subroot, root, path)] of rows (doc_id, text, lang, source, n_chars)."""
    groups = defaultdict(list)
    for i, text, lang, source, n in rows:
        groups[source].append(((i is not None, i or 0), leaf_of([i, source, lang, n, text]), i))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        groups[s].sort(key=lambda x: x[:2])
        trees[s] = climb([leaf for _, leaf, _ in groups[s]], fanout)
    root, tops = climb([trees[s][0] for s in order], fanout)
    return [(i, leaf, trees[s][0], root, path + top)
            for s, top in zip(order, tops) for (_, leaf, i), path in zip(groups[s], trees[s][1])]


def got_rows(df):
    return [(r["_id"], r["leaf"], r["subroot"], r["root"], [(p["digit"], p["others"]) for p in r["path"]]) for r in df.collect()]


def key(r):
    return str(r)


ROWS = [(i, f"Text {i} é" * (i % 3), "en" if i % 4 else None, ["b", "B", "é", "", None][min(i % 7, 4)], i * 3 if i % 5 else None) for i in range(90)]
ROWS += [(None, None, None, None, None), (None, "x", "en", "b", 1), (7, "again", "de", "b", 5), (8, "same", "de", "lone", 5), (8, "same", "de", "two", 5),
         (8, "same", "de", "two", 5), (9, "w " * 30000, "en", "b", 60000)]


@pytest.mark.parametrize("fanout", [2, 3, 16])
def test_trees_and_proofs_against_brute_force(spark, fanout):
    docs = spark.createDataFrame([(*r, *"ginlp") for r in ROWS], SCHEMA)
    tree = merkle.manifest(docs, FIELDS, fanout=fanout)
    rows = got_rows(merkle.proofs(tree))
    assert sorted(rows, key=key) == sorted(brute(ROWS, fanout), key=key)
    assert all(up(leaf, path) == root == tree.root for _, leaf, _, root, path in rows)


@pytest.mark.parametrize("sources", [1, 20, 300])
def test_deep_and_wide_trees(spark, sources):
    rows = [(i, "t", "en", f"s{i % sources}", 1) for i in range(300)]
    tree = merkle.manifest(spark.createDataFrame([(*r, *"ginlp") for r in rows], SCHEMA), FIELDS)
    assert sorted(got_rows(merkle.proofs(tree)), key=key) == sorted(brute(rows), key=key)


def test_paths_are_not_broadcast(spark):
    """However small Spark takes requests to be before they are exploded."""
    rows = [(i, "t", "en", f"s{i % 40}", 1) for i in range(700)]
    tree = merkle.manifest(spark.createDataFrame([(*r, *"ginlp") for r in rows], SCHEMA), FIELDS, fanout=4)
    proved = merkle.proofs(tree)
    assert sorted(got_rows(proved), key=key) == sorted(brute(rows, 4), key=key)
    assert len(tree.levels) > 1 and len(tree.top_levels) > 1
    assert "Broadcast" not in proved._jdf.queryExecution().executedPlan().toString()


def test_proofs_of_some_leaves(spark):
    docs = spark.createDataFrame([(*r, *"ginlp") for r in ROWS], SCHEMA)
    tree = merkle.manifest(docs, FIELDS, fanout=2)
    some = spark.createDataFrame([(3,), (8,), (8,), (None,), (70,), (12345,)], "_id long")
    want = [r for r in brute(ROWS, 2) if r[0] in (3, 8, 70)]
    assert sorted(got_rows(merkle.proofs(tree, some)), key=key) == sorted(want, key=key)


def test_a_changed_leaf_does_not_fold_to_the_root(spark):
    docs = spark.createDataFrame([(*r, *"ginlp") for r in ROWS], SCHEMA)
    tree = merkle.manifest(docs, FIELDS, keep={"other": F.lit("0" * 64)})
    rows = merkle.proofs(tree).select(merkle.folded(F.col("leaf"), F.col("path")).alias("a"),
                                      merkle.folded(F.col("other"), F.col("path")).alias("b")).collect()
    assert {r["a"] for r in rows} == {tree.root} and tree.root not in {r["b"] for r in rows}


def test_one_row_and_no_row(spark):
    one = spark.createDataFrame([(5, "t", "en", "s", 1, *"ginlp")], SCHEMA)
    (row,) = merkle.proofs(merkle.manifest(one, FIELDS)).collect()
    assert row["leaf"] == row["subroot"] == row["root"] and row["path"] == []
    none = merkle.manifest(one.limit(0), FIELDS)
    assert none.root is None and merkle.proofs(none).count() == 0


def test_query_against_brute_force(spark):
    docs = [tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in documents(spark).collect()]
    rows = {r[0]: r for r in docs}
    want = []
    for i, leaf, subroot, root, path in brute(docs):
        _, text, lang, source, n = rows[i]
        if zlib.crc32(str(i).encode()) % 5 == 0 and text is not None:
            text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        fold = up(leaf_of([i, source, lang, n, text]), path)
        want.append((i, leaf, subroot, root, h(*[x for _, others in path for x in others]), fold, fold == root))
    got = queries.op12_merkle_manifest(spark, SMALL)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert 0 < sum(not w[-1] for w in want) < len(want)
