import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import elias_fano, kmeans_tree, ngram_lm, quality_rules
from tests.llm import brute
from tests.llm.helpers import EDGE, SMALL, documents, edge_docs, empty_docs, texts


def test_elias_fano_round_trip_and_search():
    rng = np.random.default_rng(0)
    for n, u in ((0, 10), (1, 1), (5, 5), (1000, 10**4), (20000, 1 << 64), (3000, 3000), (1000, 1 << 40)):
        v = np.unique(rng.integers(0, u, n, dtype=np.uint64)) if n else np.zeros(0, np.uint64)
        e = elias_fano.EliasFano.build(v, u)
        assert (e.get(np.arange(len(v))) == v).all()
        q = np.concatenate([v, rng.integers(0, u, 500, dtype=np.uint64)])
        where = {int(x): i for i, x in enumerate(v)}
        assert e.find(q).tolist() == [where.get(int(x), -1) for x in q]
    few = elias_fano.EliasFano.build(np.sort(rng.integers(0, 10**6, 50000, dtype=np.uint64)), 10**6)
    assert 8 * (few.low.nbytes + few.high.nbytes + few.ones.nbytes) / 50000 < 2 + np.log2(20) + 1.2


def test_trie_counts_probabilities_and_backoff():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    context = words[(rng.random(20000) ** 3 * 300).astype(int)]
    following = rng.integers(0, 1 << 12, 20000, dtype=np.uint64)
    trie = elias_fano.Trie.open(elias_fano.Trie.build(context, following, np.ones(20000)).pack())
    for w in np.unique(context)[:40]:
        at = trie.words.find(np.array([w]))
        own = following[context == w]
        assert trie.counts(at)[0] == len(own)
        kinds = np.unique(own)
        p, seen = trie.after(at, np.array([len(kinds)]), kinds)
        back, unseen = trie.after(at, np.array([1]), np.array([1 << 20], np.uint64))
        assert seen.all() and not unseen[0] and 0.93 < (10**p).sum() + 10 ** back[0] < 1.07
    assert trie.words.find(np.array([1], np.uint64))[0] == -1 and trie.counts(np.array([-1]))[0] == 0


def some_trie(n, words=400, kinds=5000):
    rng = np.random.default_rng(4)
    names = rng.integers(0, 1 << 63, words, dtype=np.uint64)
    context = names[(rng.random(n) ** 2 * words).astype(int)]
    following = rng.integers(0, kinds, n, dtype=np.uint64) * np.uint64(3331) & np.uint64((1 << 24) - 1)
    return names, context, following, elias_fano.Trie.build(context, following, np.ones(n))


def test_successors_are_found_only_within_the_range_of_their_context():
    names, context, following, trie = some_trie(30000)
    held = set(zip(context.tolist(), following.tolist()))
    rng = np.random.default_rng(5)
    asked = [(w, x) for w in np.unique(context).tolist()[:200] for x in rng.choice(following, 30).tolist()]
    at = trie.words.find(np.array([w for w, _ in asked], np.uint64))
    ones, wanted = np.ones(len(asked), np.int64), np.array([x for _, x in asked], np.uint64)
    assert trie.after(at, ones, wanted)[1].tolist() == [a in held for a in asked]
    # The same levels with pointers that name other ranges find other things.
    n = trie.pointers.n
    even = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(trie.successors.n // n)
    trie.pointers = elias_fano.EliasFano.build(even, int(even[-1]) + 1)
    assert trie.after(at, ones, wanted)[1].tolist() != [a in held for a in asked]


def test_a_search_unpacks_nothing():
    import tracemalloc
    names, _, following, trie = some_trie(2_000_000, 3000, 1 << 22)
    blob = trie.pack()
    trie = elias_fano.Trie.open(blob)
    tracemalloc.start()
    at = trie.words.find(names)
    trie.counts(at)
    trie.after(at, np.ones(len(at), np.int64), following[:len(at)])
    held = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held[0] < len(blob) / 10 and held[1] < len(blob) / 2


def test_bytes_of_successors_follow_the_corpus():
    assert [ngram_lm.successor_bytes(1 << k) for k in (0, 29, 30, 31, 38, 39, 46)] == [3, 3, 3, 4, 4, 5, 5]


@pytest.mark.parametrize("case", ["edge", "documents", "small batches", "wide successors", "nothing learnt"])
def test_language_model_against_brute_force(spark, monkeypatch, case):
    if case == "wide successors":
        monkeypatch.setattr(ngram_lm, "successor_bytes", lambda size: 5)
    if case == "small batches":
        monkeypatch.setattr(ngram_lm, "BATCH_TOKENS", 500)
        monkeypatch.setattr(ngram_lm, "SHARD_BYTES", 60_000)
    rows = texts(spark) if case in ("documents", "small batches") else EDGE
    df = documents(spark) if case in ("documents", "small batches") else edge_docs(spark)
    learn = F.col("doc_id") % 4 != 1 if case != "nothing learnt" else F.lit(None).cast("boolean")
    chosen = lambda i: i is not None and i % 4 != 1 and case != "nothing learnt"
    got = sorted(ngram_lm.score_documents(df, learn).collect(), key=lambda r: (str(r["doc_id"]), r["score"]))
    want = sorted(brute.language_model(rows, chosen), key=lambda r: (str(r[0]), r[5]))
    assert len(got) == len(want)
    for r, (i, n, known, n_all, base, score) in zip(got, want):
        assert (r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["learnt"]) == (i, n, known, n_all, chosen(i))
        assert r["base_score"] == pytest.approx(base, rel=1e-9, abs=1e-9)
        assert r["score"] == pytest.approx(score, rel=0.02, abs=0.03 * n)


def test_shards_are_asked_in_one_round(spark, monkeypatch):
    """No shard asks the others for what it doesn't have: such messages would grow with the square of the shards."""
    frames, stored = [], ngram_lm.stored
    monkeypatch.setattr(ngram_lm, "stored", lambda df, name: frames.append(df) or stored(df, name))
    monkeypatch.setattr(ngram_lm, "SHARD_BYTES", 60_000)
    frames.append(ngram_lm.score_documents(documents(spark), F.col("doc_id") % 7 != 2))
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in frames]
    assert sum(p.count("FlatMapCoGroupsInPandas") for p in plans) == 1


def test_a_word_that_two_batches_share_is_counted_once(spark, monkeypatch):
    """Where a long text is cut, the last token of a batch is no context in it."""
    monkeypatch.setattr(ngram_lm, "SHARD_BYTES", 100_000)
    learnt = [(0, "a " * 2000), (1, "rare"), (2, "rare"), (3, "rare")]
    n = ngram_lm.BATCH_TOKENS
    long = [(10 + k, "a " * at + "rare " + "a " * (n + 5 - at)) for k, at in enumerate((n - 4, n - 3, n - 2, n - 1, 1000))]
    df = spark.createDataFrame(learnt + long, "doc_id long, text string").repartition(4)
    *cut, whole = [r["score"] for r in ngram_lm.score_documents(df, F.col("doc_id") < 10).where("doc_id >= 10").orderBy("doc_id").collect()]
    assert cut == pytest.approx([whole] * 4, abs=0.01)


def test_counts_that_are_summed_piece_by_piece(spark, monkeypatch):
    """A shard never holds all messages of a very common word: small sums, summed again, give the same model."""
    monkeypatch.setattr(ngram_lm, "SHARD_BYTES", 60_000)
    docs = documents(spark).select("doc_id", "text").repartition(12, "doc_id")  # so many messages a shard
    want = sorted(map(tuple, ngram_lm.score_documents(docs, F.col("doc_id") % 7 != 2).collect()))
    monkeypatch.setattr(ngram_lm, "SUM_PAIRS", 50)
    got = sorted(map(tuple, ngram_lm.score_documents(docs, F.col("doc_id") % 7 != 2).collect()))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert [r[5:] for r in got] == [pytest.approx(r[5:], rel=1e-6) for r in want]


def test_language_model_of_an_empty_table_and_against_the_base(spark):
    assert ngram_lm.score_documents(empty_docs(spark), F.lit(True)).count() == 0
    scored = ngram_lm.score_documents(documents(spark), F.col("doc_id") % 7 != 2).where("not learnt").agg(F.sum("score"), F.sum("base_score")).first()
    assert scored[0] > scored[1]


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string, rank string")


def nearest_brute(rows, every, k):
    fine = []
    for i, v in dict.fromkeys((r[0], tuple(r[1]) if r[1] is not None else None) for r in rows):
        if i is not None and v and len(v) == 6 and all(x is not None and np.isfinite(x) for x in v) and any(v):
            fine.append((i, np.array(v, np.float32).astype(float)))
    out = set()
    for q, v in fine:
        if q % every == 0:
            near = sorted((-float(v @ w), j) for j, w in fine if j != q)[:k]
            out |= {(q, n + 1, j) for n, (_, j) in enumerate(near)}
    return out


def test_search_with_full_recall_against_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, [float(rng.randint(-4, 4)) for _ in range(6)], "s", "r") for i in range(300)]
    rows += [(300 + i, [1.0, 2.0, 0.0, 0.0, 1.0, 1.0], "s", "r") for i in range(90)]  # one vector many times
    rows += [rows[5], (None, [1.0] * 6, "", ""), (400, None, "", ""), (405, [0.0] * 6, "", ""), (410, [None] + [1.0] * 5, "", ""),
             (415, [float("nan")] * 6, "", ""), (420, [float("inf")] * 6, "", ""), (425, [1.0] * 4, "", ""), (430, [], "", "")]
    got = kmeans_tree.nearest(vectors(spark, rows), every=5, k=7, recall=1.0, calibration=1000, block=16).collect()
    assert {(r["query_id"], r["rank"], r["vec_id"]) for r in got} == nearest_brute(rows, 5, 7)
    by_id = {i: v for i, v, *_ in rows}
    assert all(abs(r["score"] - float(np.dot(by_id[r["query_id"]], by_id[r["vec_id"]]))) < 1e-9 for r in got)


def test_search_with_few_or_no_rows(spark):
    few = kmeans_tree.nearest(vectors(spark, [(0, [1.0, 0.0], "", ""), (1, [0.5, 0.5], "", "")]), every=20, k=20).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in few] == [(0, 1, 1, 0.5)]
    assert kmeans_tree.nearest(vectors(spark, [(0, [1.0, 0.0], "", "")])).count() == 0
    assert kmeans_tree.nearest(vectors(spark, [(0, None, "", "")])).count() == 0
    assert kmeans_tree.nearest(vectors(spark, [])).count() == 0


def test_recall_on_the_given_vectors(spark):
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    got = {(r["query_id"], r["vec_id"]) for r in kmeans_tree.nearest(df, every=20, k=20).collect()}
    data = df.select("vec_id", "embedding").collect()
    ids, x = np.array([r[0] for r in data]), np.array([r[1] for r in data], float)
    hits = total = 0
    for q in ids[ids % 20 == 0]:
        s = x @ x[ids == q][0]
        best = ids[np.lexsort((ids, -s))]
        best = best[best != q][:20]
        hits, total = hits + sum((q, v) in got for v in best), total + len(best)
    assert hits >= 0.9 * total


def test_quality_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    model = quality_rules.train(docs, labels.where(~held))
    assert model.rules
    scored = quality_rules.score_quality(docs, model).join(labels, "doc_id").where(held)
    r = scored.agg(F.avg((F.col("predicted") == F.col("quality")).cast("double")), F.min("score"), F.max("score")).first()
    assert r[0] >= 0.95 and 0 <= r[1] <= r[2] <= 1


def test_compiled_rules_equal_the_fitted_ones():
    rng = np.random.default_rng(0)
    x = rng.random((800, 3))
    y = ((x[:, 0] > 0.5) & (x[:, 2] < 0.7)).astype(float)
    names = ["a", "b", "c"]
    model = quality_rules.fit_rules(x, y, names, trees=20)
    margin = np.full(len(x), model.bias)
    for conditions, weight in model.rules:
        margin += weight * quality_rules._hold(x, names, conditions)
    assert (((margin > 0) == (y > 0.5)).mean()) > 0.97
    assert quality_rules.fit_rules(x[:0], y[:0], names).bias == 0.0
    assert quality_rules.fit_rules(x, np.ones(800), names).rules == []


def test_quality_of_edge_rows(spark):
    labels = spark.createDataFrame([(0, 1), (1, None), (None, 1), (999, 0), (4, 0), (4, 1), (9, 0), (9, 0)], "doc_id long, quality int")
    for few in (labels, labels.limit(0)):
        model = quality_rules.train(edge_docs(spark), few)
        got = quality_rules.score_quality(edge_docs(spark), model)
        assert got.columns.count("score") == 1 and got.count() == len(EDGE)
        assert got.where("score is null or score < 0 or score > 1 or predicted is null").count() == 0
        assert quality_rules.score_quality(empty_docs(spark), model).count() == 0


def plain_statistics(text):
    """The statistics of a text in plain Python."""
    import regex
    text = text or ""
    w, lines, chars = brute.words(text), text.split("\n"), float(len(text))

    def each(a, b):
        return a / max(b, 1.0)

    def share(pattern):
        return each(len(regex.findall(pattern, text)), chars)
    return {
        "chars": chars, "words": len(w), "word_length": each(chars, len(w)), "distinct_words": each(len(set(w)), len(w) ** 0.5),
        "distinct_word_share": each(len(set(w)), len(w)), "distinct_line_share": each(len(set(lines)), len(lines)),
        "line_length": each(chars, len(lines)), "symbol_share": share(r"[^\p{L}\p{N} \t\n\x0b\f\r.,;:'\"!?-]"),
        "digit_share": share("[0-9]"), "upper_share": share(r"\p{Lu}"), "stops_per_word": each(len(regex.findall("[.!?]", text)), len(w)),
        "commas_per_word": each(len(regex.findall("[,;:]", text)), len(w)),
        "repeat_share": each(sum(a == b for a, b in zip(w, w[1:])), len(w))}


def plain_score(model, stats):
    total = model.bias + sum(x for q, x in model.rules if all((stats[n] > at) == above for n, above, at in q))
    return 1 / (1 + np.exp(-total))


@pytest.mark.parametrize("case", ["documents", "edge"])
def test_spark_columns_score_like_plain_python(spark, case):
    model = quality_rules.train(documents(spark), spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", "quality"))
    assert len(model.rules) > 5
    # Rules on every statistic, so that each of them counts.
    for k, n in enumerate(plain_statistics("")):
        model.rules += [(((n, True, 0.02),), 0.1 + k / 50), (((n, False, 1.5), ("chars", True, 3.0)), -0.07 - k / 60)]
    rows = texts(spark) if case == "documents" else EDGE + [(30, "1 2 3 4, 5; 6: 7!"), (31, "\n\n\n"), (32, "Ä Ö\u00a0Ü ÇÀ #@$ — …"), (33, "x x x y y\x0bz\x0c z")]
    docs = documents(spark) if case == "documents" else edge_docs(spark, rows)
    got = sorted((str(r["doc_id"]), round(r["score"], 9), r["predicted"]) for r in quality_rules.score_quality(docs, model).collect())
    want = [(str(i), plain_score(model, plain_statistics(t))) for i, t in rows]
    assert got == sorted((i, round(x, 9), int(x >= 0.3)) for i, x in want)
