from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute
from tests.llm.helpers import SMALL, documents
from tests.llm.test_exact_and_shards import want_groups


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


@pytest.fixture(scope="module")
def results(spark):
    """The stages' results over the small documents, each written and read again."""
    from ledgerline.llm.common import stored
    docs, out = documents(spark), [documents(spark)]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SMALL), name)
        out.append(docs)
    return out


def test_stages_keep_the_columns_of_documents(results):
    for df in results[1:-1]:
        assert df.columns == results[0].columns
        assert [f.dataType for f in df.schema] == [f.dataType for f in results[0].schema]


def test_quality_drops_what_the_labels_call_bad(spark, results):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    kept = {i for i, _ in rows_of(results[1])}
    assert sum((i in kept) == (q == 1) for i, q in labels.items()) >= 0.95 * len(labels)


def test_exact_stage_against_brute_force(results):
    before = rows_of(results[1])
    assert {i for i, _ in rows_of(results[2])} == {k for k, _, _ in want_groups(before).values()}


def test_near_stage_against_brute_force(results):
    assert {i for i, _ in rows_of(results[3])} == {c for i, _, c in brute.linked(rows_of(results[2]))}


def test_substring_stage_against_brute_force(results):
    before = rows_of(results[3])
    texts = dict(before)
    want = {i: kept if gone else texts[i] for i, _, gone, kept in brute.without_repeats(before)}
    assert dict(rows_of(results[4])) == want


def test_packing_and_the_whole_run(spark, results):
    packed = results[5].collect()
    assert {r["doc_id"] for r in packed} == {i for i, _ in rows_of(results[4])}
    fill = defaultdict(int)
    for r in packed:
        fill[r["sequence_id"]] += r["length"]
    assert max(fill.values()) <= 2048
    columns = ("doc_id", "piece", "start", "length", "ids_crc32")
    again = corpus_pipeline.run(spark, SMALL).select(*columns).collect()
    assert Counter(tuple(r) for r in again) == Counter(tuple(r[c] for c in columns) for r in packed)


def test_exact_stage_leaves_one_of_repeated_rows(spark):
    rows = [(1, "same words", "en", "s", 10)] * 3 + [(2, "same  words", "en", "s", 11), (3, None, "en", "s", 0)]
    docs = spark.createDataFrame(rows, documents(spark).schema)
    assert sorted(rows_of(corpus_pipeline.exact_dedup(spark, docs, SMALL)), key=str) == [(2, "same  words"), (3, None)]


CLASHING = ("doc_id long, text string, lang string, source string, n_chars long, score string, predicted string, kept string, "
            "group_size string, keep_id string, text_sha256 string, _len string, _h string, n_words string, n_removed string, kept_text string, "
            "_row string, rest string, component_id string")
#: The last near copy has no id; id 4 has two texts, one of which is a near copy of 2; row 7 comes twice.
BASE = " ".join(f"w{i}" for i in range(80))
MESSY = [(1, None), (None, None), (2, BASE), (None, BASE + " tail"), (4, BASE + " other end"), (4, "another text of id four " * 3), (None, "alone without an id at all"),
         (7, "seven rows of one text"), (7, "seven rows of one text"), (8, ""), (9, " \t"), (10, BASE + " " + " ".join(f"x{i}" for i in range(9000))),
         (11, "tie of texts"), (12, "tie  of texts")]


def messy(spark, rows=MESSY):
    extra = [f"own {k}" for k in range(CLASHING.count(",") - 3)]
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), *extra[1:]) for i, t in rows], CLASHING)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_stages_keep_clashing_columns_and_take_every_row(spark, name, stage):
    docs = messy(spark)
    out = stage(spark, docs, SMALL)
    assert out.schema.simpleString() == docs.schema.simpleString()
    got = out.collect()
    assert all(r[c] == docs.first()[c] for r in got for c in docs.columns[5:])
    assert stage(spark, docs.limit(0), SMALL).count() == 0
    texts = sorted((str(r["doc_id"]), r["text"]) for r in got if r["text"] is not None)
    if name == "exact_dedup":
        assert len(got) == len({"".join((t or "").split()) for _, t in MESSY})
        assert ("12", "tie  of texts") in texts and texts.count(("7", "seven rows of one text")) == 1
        assert [r["doc_id"] for r in got if not (r["text"] or "").strip()] == [9]
    if name == "near_dedup":
        assert texts.count(("2", BASE)) == 1 and not any(t.startswith(BASE) and i != "2" and len(t) < 1000 for i, t in texts)
        assert ("4", "another text of id four " * 3) in texts and ("None", "alone without an id at all") in texts
        assert texts.count(("7", "seven rows of one text")) == 1 and sum(not (r["text"] or "").strip() for r in got) == 4
        assert sum(t == "tie of texts" or t == "tie  of texts" for _, t in texts) == 1
    if name == "substring_dedup":
        assert len(got) == len(MESSY)
        want = Counter((str(i), kept if gone else dict(enumerate(t for _, t in MESSY))[k])
                       for k, (i, _, gone, kept) in enumerate(brute.without_repeats(MESSY)))
        assert Counter((str(r["doc_id"]), r["text"]) for r in got) == want
        assert all(r["n_chars"] == len(r["text"]) for r in got if r["text"] is not None)


def test_packing_takes_every_row(spark):
    packed = corpus_pipeline.packing(spark, messy(spark), SMALL)
    assert packed.where("piece = 0").count() == len(MESSY)
    assert corpus_pipeline.packing(spark, messy(spark).limit(0), SMALL).count() == 0
