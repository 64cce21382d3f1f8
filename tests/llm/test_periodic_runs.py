import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import periodic_runs, queries
from tests.llm import brute
from tests.llm.helpers import EDGE, SMALL, documents, edge_docs, empty_docs, texts


def naive(w, least=6, times=4):
    """[(start, length, period)] by trying every period at every place."""
    n, spans = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            spans.setdefault((i, j + q), q)  # periods ascend, so the smallest stays
            i = j
    return sorted((s, e - s, q) for (s, e), q in spans.items() if e - s >= max(least, times * q))


def collapse(w, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(x for k, x in enumerate(w) if k not in gone)


def fast(texts, least, times):
    sizes = [len(t) for t in texts]
    ends = np.cumsum(sizes, dtype=np.int64)
    number = {}
    words = np.array([number.setdefault(x, len(number)) for t in texts for x in t], np.int64)
    start, length, period = periodic_runs.runs_of(words, np.repeat(ends, sizes), least, times)
    out = [[] for _ in texts]
    for s, n, q in zip(start.tolist(), length.tolist(), period.tolist()):
        d = int(np.searchsorted(ends, s, side="right"))
        out[d].append((s - int(ends[d] - sizes[d]), n, q))
    return out


@pytest.mark.parametrize("least,times", [(2, 2), (6, 4), (5, 3)])
def test_runs_against_every_period_at_every_place(least, times):
    rng = random.Random(1)
    texts = [[rng.choice("ab") for _ in range(rng.randint(0, 40))] for _ in range(400)]
    texts += [[rng.choice("abc") for _ in range(rng.randint(0, 9))] * rng.randint(1, 9) + ["c"] * rng.randint(0, 9) for _ in range(400)]
    texts += [list("a" * n) for n in (1, 2, 5, 6, 7, 64, 65, 300)]
    fib = ["a", "b"]
    for _ in range(10):
        fib.append(fib[-1] + fib[-2])
    texts += [list(fib[-1]), list("ab" * 50 + "aab" * 30), [str(k) for k in range(100)]]
    assert fast(texts, least, times) == [naive(t, least, times) for t in texts]
    assert [fast([t], least, times)[0] for t in texts[:200]] == [naive(t, least, times) for t in texts[:200]]


def test_two_periods_at_least(spark):
    with pytest.raises(ValueError):
        periodic_runs.find_runs(documents(spark), times=1)


def test_edge_documents(spark):
    rows = EDGE + [(20, "x " * 50000), (21, ("a b c " * 400 + "d ") * 8), (22, None), (None, "z z z z z z"), (None, "z z z z z z")]
    got = sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"])
                  for r in periodic_runs.find_runs(edge_docs(spark, rows)).collect()), key=str)
    want = []
    for i, t in rows:
        w = brute.words(t)
        runs = [(0, 50000, 1)] if i == 20 else naive(w)
        want.append((i, len(w), runs, collapse(w, runs)))
    assert got == sorted(want, key=str)


def test_batches_of_one_document(spark, monkeypatch):
    docs = edge_docs(spark, [(k, "p q " * k + "end") for k in range(40)])
    whole = sorted(map(str, periodic_runs.find_runs(docs).collect()))
    monkeypatch.setattr(periodic_runs, "BATCH_WORDS", 1)
    monkeypatch.setattr(periodic_runs, "KEPT_WORDS", 1)
    assert sorted(map(str, periodic_runs.find_runs(docs).collect())) == whole


def test_an_empty_table(spark):
    assert periodic_runs.find_runs(empty_docs(spark)).count() == 0


def planted(i, w):
    h = zlib.crc32(str(i).encode())
    if h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [x if k < a else w[a + (k - a) % p] for k, x in enumerate(w)]


def test_query_against_brute_force(spark):
    want = []
    for i, t in texts(spark):
        w = planted(i, brute.words(t))
        runs = naive(w)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
        want.append((i, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
                     brute.sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), brute.sha(collapse(w, runs))))
    got = sorted(map(tuple, queries.op13_periodic_runs(spark, SMALL).collect()))
    assert got == sorted(want, key=lambda r: r[0])
    assert sum(r[1] > 0 for r in got) >= 5
