"""Quality classifier: a sparse ensemble of conjunctive rules over text statistics.

Boosted shallow trees are grown on the statistics of a bounded sample of
labelled rows; every path from a root to a node is a rule (a conjunction of
thresholds).  A lasso-weighted logistic regression over the rules' 0/1 values
keeps few of them.  These are compiled into one Spark column expression, so
scoring is a projection over whole texts.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import text_or_empty

#: (statistic, is it above the threshold, threshold)
Condition = tuple[str, bool, float]


def text_statistics(text: Column) -> dict[str, Column]:
    """Statistics of a whole text; all are 0 for an empty one."""
    def count(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)).cast("double")

    def each(a: Column, b: Column) -> Column:
        return a / F.greatest(b, F.lit(1.0))

    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.split(text, "\n")
    chars = F.char_length(text).cast("double")
    n_words = F.size(words).cast("double")
    n_lines = F.size(lines).cast("double")
    return {
        "chars": chars,
        "words": n_words,
        "word_length": each(chars, n_words),
        "distinct_words": each(F.size(F.array_distinct(words)).cast("double"), F.sqrt(n_words)),
        "distinct_word_share": each(F.size(F.array_distinct(words)).cast("double"), n_words),
        "distinct_line_share": each(F.size(F.array_distinct(lines)).cast("double"), n_lines),
        "line_length": each(chars, n_lines),
        "symbol_share": each(count(r"[^\p{L}\p{N}\s.,;:'\"!?-]"), chars),
        "digit_share": each(count(r"[0-9]"), chars),
        "upper_share": each(count(r"\p{Lu}"), chars),
        "stops_per_word": each(count(r"[.!?]"), n_words),
        "commas_per_word": each(count(r"[,;:]"), n_words),
        "repeat_share": each(F.aggregate(
            words, F.struct(F.lit("").alias("w"), F.lit(0.0).alias("n")),
            lambda a, w: F.struct(w.alias("w"), (a["n"] + (a["w"] == w).cast("double")).alias("n")),
            lambda a: a["n"]), n_words),
    }


@dataclass
class RuleModel:
    """score = logistic(bias + sum of the weights of the rules that hold)"""

    bias: float
    rules: list[tuple[tuple[Condition, ...], float]] = field(default_factory=list)

    def statistics(self) -> set[str]:
        return {name for conditions, _ in self.rules for name, _, _ in conditions}

    def score(self, stats: dict[str, Column]) -> Column:
        total = F.lit(self.bias)
        for conditions, weight in self.rules:
            holds = F.lit(True)
            for name, above, at in conditions:
                holds = holds & ((stats[name] > at) if above else (stats[name] <= at))
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _tree(x: np.ndarray, bins: list[np.ndarray], residual: np.ndarray, hessian: np.ndarray, rows: np.ndarray,
          depth: int, least: int, path: tuple, out: list, names: list[str]) -> np.ndarray:
    """Grow one tree on binned statistics; its paths go to ``out``.  Returns the leaf value of each row in ``rows``."""
    value = residual[rows].sum() / (hessian[rows].sum() + 1.0)
    if path:
        out.append(path)
    best = None
    if depth and len(rows) >= 2 * least:
        g, h = residual[rows], hessian[rows]
        base = g.sum() ** 2 / (h.sum() + 1.0)
        for j, edges in enumerate(bins):
            if not len(edges):
                continue
            b = x[rows, j]
            gs, hs, ns = (np.cumsum(np.bincount(b, w, len(edges) + 1))[:-1] for w in (g, h, None))
            gain = gs**2 / (hs + 1.0) + (g.sum() - gs) ** 2 / (h.sum() - hs + 1.0) - base
            gain[(ns < least) | (len(rows) - ns < least)] = 0
            k = int(gain.argmax())
            if gain[k] > 1e-6 and (best is None or gain[k] > best[0]):
                best = gain[k], j, k
    if best is None:
        return np.full(len(rows), value)
    _, j, k = best
    left, result = x[rows, j] <= k, np.empty(len(rows))
    for side, above in ((left, False), (~left, True)):
        result[side] = _tree(x, bins, residual, hessian, rows[side], depth - 1, least,
                             (*path, (names[j], above, float(bins[j][k]))), out, names)
    return result


def _lasso(rules: np.ndarray, y: np.ndarray, penalty: float, steps: int) -> tuple[np.ndarray, float]:
    """Logistic regression with an L1 penalty on the weights (not the bias) by accelerated proximal gradient."""
    n, m = rules.shape
    w, b = np.zeros(m), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    vw, vb, t = w.copy(), b, 1.0
    v = np.ones(m) / np.sqrt(m)
    for _ in range(15):  # the largest eigenvalue gives the step
        v = rules.T @ (rules @ v)
        v /= np.linalg.norm(v) + 1e-12
    step = 1.0 / (0.25 * (float(v @ (rules.T @ (rules @ v))) / n + 1.0))
    for _ in range(steps):
        off = 1.0 / (1.0 + np.exp(-(rules @ vw + vb))) - y
        w2 = vw - step * (rules.T @ off) / n
        w2 = np.sign(w2) * np.maximum(np.abs(w2) - step * penalty, 0)
        b2 = vb - step * off.mean()
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        vw, vb = w2 + (t - 1) / t2 * (w2 - w), b2 + (t - 1) / t2 * (b2 - b)
        w, b, t = w2, b2, t2
    return w, float(b)


def fit_rules(stats: np.ndarray, y: np.ndarray, names: list[str], trees: int = 40, depth: int = 3, rate: float = 0.2,
              bins: int = 64, penalty: float = 3e-4, steps: int = 250, seed: int = 11) -> RuleModel:
    """Fit on a matrix of statistics and 0/1 labels.  Without rows the score is 0.5, with one class its share."""
    if not len(y):
        return RuleModel(0.0)
    share = float(np.clip(y.mean(), 0.001, 0.999))
    if y.min() == y.max():
        return RuleModel(float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    edges = [np.unique(np.quantile(stats[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(stats.shape[1])]
    binned = np.stack([np.searchsorted(e, stats[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    margin, paths = np.full(len(y), np.log(share / (1 - share))), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        rows = np.flatnonzero(rng.random(len(y)) < 0.6)
        found: list = []
        _tree(binned, edges, y - p, p * (1 - p), rows, depth, max(5, len(y) // 400), (), found, names)
        if not found:
            break
        paths += found
        # The tree's values on all rows: refit on the leaves that its paths describe.
        leaves = [q for q in found if not any(len(o) > len(q) and o[:len(q)] == q for o in found)]
        for q in leaves:
            held = _hold(stats, names, q)
            margin[held] += rate * (y - p)[held].sum() / ((p * (1 - p))[held].sum() + 1.0)
    kinds = list(dict.fromkeys(tuple(sorted(set(q))) for q in paths))
    matrix = np.stack([_hold(stats, names, q) for q in kinds], axis=1).astype(np.float64) if kinds else np.zeros((len(y), 0))
    if not kinds:
        return RuleModel(float(np.log(share / (1 - share))))
    w, b = _lasso(matrix, y.astype(np.float64), penalty, steps)
    return RuleModel(b, [(q, float(x)) for q, x in zip(kinds, w) if abs(x) > 1e-3])


def _hold(stats: np.ndarray, names: list[str], path: tuple[Condition, ...]) -> np.ndarray:
    held = np.ones(len(stats), bool)
    for name, above, at in path:
        column = stats[:, names.index(name)]
        held &= (column > at) if above else (column <= at)
    return held


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 12_000, label_col: str = "quality", **options) -> RuleModel:
    """Fit on at most ``max_rows`` labelled documents, those whose ids hash lowest.

    ``labels`` must hold only rows to learn from.  Labels of an id given more
    than once count by their mean (1 from 0.5 on); null labels and ids and
    labels without a document are ignored.  The bound keeps the fit, which runs
    in one process, at the same size for every corpus.
    """
    picked = (
        labels.where(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg((F.avg(label_col) >= 0.5).cast("double").alias("_y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    )
    stats = text_statistics(text_or_empty("text"))
    chosen = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")  # max_rows ids at most
    # One row an id, also where documents repeat an id.
    rows = chosen.select("doc_id", "_y", F.struct(*[c.alias(n) for n, c in stats.items()]).alias("s")) \
        .groupBy("doc_id").agg(F.min("_y").alias("_y"), F.min("s").alias("s")).select("doc_id", "_y", "s.*") \
        .toPandas().sort_values("doc_id")
    return fit_rules(rows[list(stats)].to_numpy(float), rows["_y"].to_numpy(float), list(stats), **options)


def score_quality(docs: DataFrame, model: RuleModel, threshold: float = 0.3) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on).

    Only the text is looked at; null counts as empty and gets the score of an
    empty text.  Repeated rows get equal scores.  Other columns stay, except
    those named like a result.
    """
    rows = docs.drop(*[c for c in ("score", "predicted") if c in docs.columns])
    used = model.statistics()
    named = {n: f"_stat_{n}" for n in used}
    stats = text_statistics(text_or_empty("text"))
    wide = rows.withColumns({named[n]: stats[n] for n in sorted(used)}) if used else rows
    return wide.withColumn("score", model.score({n: F.col(c) for n, c in named.items()})) \
        .withColumn("predicted", (F.col("score") >= threshold).cast("int")).drop(*named.values())
