"""Approximate nearest neighbours by inner product: a hierarchical k-means tree.

The tree is fitted on a bounded sample of distinct vectors; then every distinct
vector is put into the leaf that a greedy descent ends in.  A query walks the
tree best bin first: a priority queue holds the nodes met so far by the distance
of their centroids, the nearest is opened, and a leaf that comes up is visited.
How many leaves are visited is widened until, on a fixed number of calibration
queries with exact answers, the wanted recall is reached.

Inner products become distances by one more coordinate, sqrt(M^2 - |v|^2) with M
the largest norm, which makes all vectors equally long.

Equal vectors are one entry with their ``k`` + 1 smallest ids, which is all that
a top ``k`` can need of them.  Leaves are cut into blocks of bounded size, so
neither a crowded leaf nor a vector with a third of all rows meets in one task.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import stored


class KMeansTree:
    """Nodes 0..n-1 (0: the root); ``children[i]`` are the children of node i, none for a leaf."""

    def __init__(self, children: list[list[int]], centroids: np.ndarray):
        self.children = children
        self.centroids = centroids
        leaves = [i for i, c in enumerate(children) if not c]
        self.leaf_number = {node: k for k, node in enumerate(leaves)}
        self.leaves = len(leaves)

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Number of the leaf of each row: the nearest child's centroid at every step."""
        at = np.zeros(len(x), np.int64)
        todo = np.arange(len(x)) if self.children[0] else np.arange(0)
        while len(todo):
            for node in np.unique(at[todo]):
                rows, kids = todo[at[todo] == node], np.array(self.children[node])
                c = self.centroids[kids]
                at[rows] = kids[((c * c).sum(1) - 2 * (x[rows] @ c.T)).argmin(1)]
            todo = todo[[bool(self.children[n]) for n in at[todo]]]
        return np.array([self.leaf_number[n] for n in at], np.int64)

    def visit(self, q: np.ndarray, leaves: int) -> list[int]:
        """The first ``leaves`` leaves of a best-bin-first walk for one query."""
        queue, out = [(0.0, 0)], []
        while queue and len(out) < leaves:
            _, node = heapq.heappop(queue)
            kids = self.children[node]
            if not kids:
                out.append(self.leaf_number[node])
                continue
            off = self.centroids[kids] - q
            for d, kid in zip((off * off).sum(1).tolist(), kids):
                heapq.heappush(queue, (d, kid))
        return out


def fit_tree(x: np.ndarray, branches: int = 16, leaf_size: int = 100, rounds: int = 8, seed: int = 5) -> KMeansTree:
    """Split rows by k-means, again and again, until at most ``leaf_size`` rows or one distinct row are left."""
    rng = np.random.default_rng(seed)
    children: list[list[int]] = [[]]
    centroids = [x.mean(0) if len(x) else np.zeros(x.shape[1])]
    todo = [(0, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        if len(rows) <= leaf_size:
            continue
        part = x[rows]
        wanted = min(branches, -(-len(rows) // leaf_size))  # no smaller leaves than asked for
        centers = part[rng.choice(len(rows), wanted, replace=False)]
        for _ in range(rounds):
            near = ((centers * centers).sum(1) - 2 * (part @ centers.T)).argmin(1)
            sums = np.zeros_like(centers)
            np.add.at(sums, near, part)
            n = np.bincount(near, minlength=len(centers))
            centers = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centers)
        near = ((centers * centers).sum(1) - 2 * (part @ centers.T)).argmin(1)
        groups = [rows[near == k] for k in range(len(centers))]
        if sum(len(g) > 0 for g in groups) < 2:
            continue
        for k, g in enumerate(groups):
            if len(g):
                children[node].append(len(children))
                children.append([])
                centroids.append(centers[k])
                todo.append((len(children) - 1, g))
    return KMeansTree(children, np.array(centroids))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.frombuffer(b, "<f4") for b in column]).astype(np.float64) if len(column) else np.zeros((0, 1))


def usable_vectors(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v) of the vectors that take part: not null, not zero, all components finite, of the commonest length."""
    v = F.col(vec_col).cast("array<float>")
    fine = vectors.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(
        F.col("v").isNotNull()
        & F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
        & F.exists("v", lambda x: F.coalesce(x != 0, F.lit(False))))
    sizes = fine.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return fine.where(F.size("v") == (sizes[0]["d"] if sizes else 0))


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, recall: float = 0.95, id_col: str = "vec_id",
            vec_col: str = "embedding", sample: int = 30_000, calibration: int = 200, block: int = 4096) -> DataFrame:
    """query_id, rank, id, score: the ``k`` nearest of each query found, nearest first.

    Queries are the rows whose id is divisible by ``every``; candidates are all
    rows but the query's own.  The score is the inner product of the original
    vectors in double precision; equal scores are ordered by id.  Vectors that
    are null, zero, hold a null or a non-finite component, have a null id, or
    differ from the commonest length take no part.  A repeated row (equal id and
    vector) is one candidate.  Of an id with several vectors each is a query and
    a candidate, never for itself.  With fewer candidates than ``k`` all are
    returned; an empty table gives an empty result.  Other columns are ignored.

    ``sample`` bounds the vectors that the tree is fitted on, ``calibration`` the
    queries that the number of visited leaves is fitted on; all vectors are
    indexed.
    """
    spark = vectors.sparkSession
    schema = "query_id long, rank int, " + id_col + " long, score double"
    fine = usable_vectors(vectors, id_col, vec_col)
    same = Window.partitionBy("v").orderBy("id")
    # Filtering a rank lets Spark cut each group inside the map tasks already.
    groups = stored(
        fine.withColumn("_r", F.dense_rank().over(same)).where(F.col("_r") <= k + 1)
        .groupBy("v").agg(F.sort_array(F.collect_set("id")).alias("ids"))
        .withColumn("gid", F.monotonically_increasing_id()), "ann-groups")
    packed = groups.select("gid", "ids", "v").mapInPandas(_pack, "gid long, first long, vec binary")
    top = groups.agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)).alias("m"), F.count("*").alias("n")).first()
    if not top["n"]:
        return spark.createDataFrame([], schema)
    norm = float(np.sqrt(top["m"]))

    picked = packed.orderBy(F.xxhash64("gid"), "gid").limit(sample).toPandas()  # bounded by ``sample``
    tree = fit_tree(_longer(_matrix(picked["vec"]), norm))
    tree_b = spark.sparkContext.broadcast(tree)  # bounded by ``sample``

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                yield f.assign(leaf=tree_b.value.assign(_longer(_matrix(f["vec"]), norm)))

    index = stored(packed.mapInPandas(place, "gid long, first long, vec binary, leaf long"), "ann-index")

    # A distinct vector asks once for all query rows that hold it.
    asks = fine.where(F.col("id") % every == 0).distinct()
    asking = stored(asks.join(groups.select("v", "gid"), "v").select("id", "gid"), "ann-asking")
    queries = stored(asking.select("gid").distinct().join(index.select("gid", "vec"), "gid"), "ann-queries")

    visits = _calibrated(spark, queries, index, tree, norm, k, recall, calibration)
    sizes = {r["leaf"]: r["count"] for r in index.groupBy("leaf").count().collect()}  # one row a leaf
    blocks = {leaf: -(-n // block) for leaf, n in sizes.items()}
    # Queries of one leaf are dealt out too, so that each meeting stays small.
    deals = max(1, -(-queries.count() * visits // (max(1, len(sizes)) * 8192)))
    blocks_b = spark.sparkContext.broadcast(blocks)

    dims = tree.centroids.shape[1] - 1
    fitted = _matrix(picked["vec"])
    sample_b = spark.sparkContext.broadcast((fitted.astype("<f4"), tree.assign(_longer(fitted, norm))))  # bounded by ``sample``

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for lo in range(0, len(f), 128):
                part = f.iloc[lo: lo + 128]
                gids, v = part["gid"].to_numpy(), _matrix(part["vec"])
                known, known_leaf = v @ sample_b.value[0].T.astype(np.float64), sample_b.value[1]
                by_leaf: dict[int, list[int]] = {}
                for i, q in enumerate(_asking(v, norm)):
                    met = np.zeros(tree_b.value.leaves, bool)
                    for leaf in tree_b.value.visit(q, visits):
                        by_leaf.setdefault(leaf, []).append(i)
                        met[leaf] = True
                    known[i, ~met[known_leaf]] = -np.inf
                # The sample's rows in the visited leaves will be found there; worse ones need not come back.
                least = np.partition(known, -(k + 2), axis=1)[:, -(k + 2)] - 1e-9 if known.shape[1] > k + 1 else np.full(len(v), -np.inf)
                short = v.astype("<f4")
                yield pd.DataFrame(
                    [(leaf, b, int(gids[0] % deals), gids[at].tobytes(), least[at].tobytes(), short[at].tobytes())
                     for leaf, at in by_leaf.items() for b in range(blocks_b.value.get(leaf, 0))],
                    columns=["leaf", "block", "deal", "qgids", "least", "q"])

    asked = queries.mapInPandas(walk, "leaf long, block int, deal int, qgids binary, least binary, q binary")
    n_blocks = F.lit(0)
    many = [(int(a), int(n)) for a, n in blocks.items() if n > 1]
    if many:
        crowded = F.broadcast(spark.createDataFrame(many, "leaf long, blocks long"))  # one row a leaf at most
        held = index.join(crowded, "leaf", "left")
        n_blocks = F.pmod(F.xxhash64("gid"), F.coalesce("blocks", F.lit(1)))
    else:
        held = index
    held = held.select("leaf", n_blocks.cast("int").alias("block"),
                       F.explode(F.sequence(F.lit(0), F.lit(deals - 1))).alias("deal"), "gid", "first", "vec")

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"qgid": [], "gid": [], "first": [], "score": []})]
        if len(left) and len(right):
            c, gids, firsts = _matrix(right["vec"]), right["gid"].to_numpy(), right["first"].to_numpy()
            for qgids, least, q in zip(left["qgids"], left["least"], left["q"]):
                scores = np.frombuffer(q, "<f4").reshape(-1, dims).astype(np.float64) @ c.T
                out.append(_best(np.frombuffer(qgids, np.int64), scores, gids, firsts, k + 1, np.frombuffer(least, np.float64)))
        return pd.concat(out)

    keys = ["leaf", "block", "deal"]
    met = asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInPandas(meet, "qgid long, gid long, first long, score double")
    by_query = Window.partitionBy("qgid").orderBy(F.desc("score"), "first", "gid")
    best = met.withColumn("_r", F.row_number().over(by_query)).where(F.col("_r") <= k + 1) \
        .join(groups.select("gid", "ids"), "gid").select("qgid", "score", F.explode("ids").alias("id"))
    by_id = Window.partitionBy("qgid").orderBy(F.desc("score"), "id")
    lists = best.withColumn("_r", F.row_number().over(by_id)).where(F.col("_r") <= k + 1).groupBy("qgid").agg(
        F.sort_array(F.collect_list(F.struct("_r", "id", "score"))).alias("near"))  # k + 1 entries
    found = asking.withColumnRenamed("id", "query_id").join(lists.withColumnRenamed("qgid", "gid"), "gid")
    others = F.slice(F.filter("near", lambda x: x["id"] != F.col("query_id")), 1, k)
    return found.select("query_id", F.posexplode(others).alias("pos", "x")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("x.id").alias(id_col), "x.score")


def _pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        yield pd.DataFrame({"gid": f["gid"], "first": [x[0] for x in f["ids"]], "vec": [np.asarray(x, "<f4").tobytes() for x in f["v"]]})


def _longer(x: np.ndarray, norm: float) -> np.ndarray:
    return np.hstack([x, np.sqrt(np.maximum(norm**2 - (x * x).sum(1), 0))[:, None]])


def _asking(x: np.ndarray, norm: float) -> np.ndarray:
    """Queries at the vectors' common length; their added coordinate is 0."""
    return np.hstack([x * (norm / np.sqrt((x * x).sum(1)))[:, None], np.zeros((len(x), 1))])


def _best(qgids: np.ndarray, scores: np.ndarray, gids: np.ndarray, firsts: np.ndarray, k: int,
          least: np.ndarray | None = None) -> pd.DataFrame:
    """The k best columns of each row, with what ties with the last one, of those that reach ``least``."""
    floor = np.full(len(scores), -np.inf) if least is None else least
    if scores.shape[1] > k:
        floor = np.maximum(floor, np.partition(scores, scores.shape[1] - k, axis=1)[:, -k])
    rows, cols = np.nonzero(scores >= floor[:, None])
    return pd.DataFrame({"qgid": qgids[rows], "gid": gids[cols], "first": firsts[cols], "score": scores[rows, cols]})


def _calibrated(spark, queries: DataFrame, index: DataFrame, tree: KMeansTree, norm: float, k: int, recall: float, n: int) -> int:
    """The fewest visited leaves that reach ``recall`` on ``n`` queries, whose exact answers come from all vectors."""
    asked = queries.orderBy(F.xxhash64("gid"), "gid").limit(n).toPandas()
    if not len(asked):
        return 1
    asked_b = spark.sparkContext.broadcast((asked["gid"].to_numpy(), _matrix(asked["vec"])))  # n vectors

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        qgids, q = asked_b.value
        for f in frames:
            if len(f):
                found = _best(qgids, q @ _matrix(f["vec"]).T, f["gid"].to_numpy(), f["leaf"].to_numpy(), k + 1)
                yield found.rename(columns={"first": "leaf"})

    w = Window.partitionBy("qgid").orderBy(F.desc("score"), "gid")
    exact = index.mapInPandas(scan, "qgid long, gid long, leaf long, score double").where("gid != qgid") \
        .withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).select("qgid", "leaf").toPandas()
    places, total = np.zeros(tree.leaves, np.int64), 0
    wanted = {g: d["leaf"].to_numpy() for g, d in exact.groupby("qgid")}
    for gid, q in zip(asked["gid"], _asking(_matrix(asked["vec"]), norm)):
        order = {leaf: i for i, leaf in enumerate(tree.visit(q, tree.leaves))}
        for leaf in wanted.get(gid, ()):
            places[order[leaf]] += 1
            total += 1
    return int(np.searchsorted(np.cumsum(places), recall * total)) + 1 if total else 1
