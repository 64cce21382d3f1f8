"""Merkle manifest of a dataset, and proofs by descent through its content-addressed records.

Build: rows are range-partitioned into the order (group, id); counts per
partition and group give each row its place in its group, so no group has to
fit into one task.  Level by level, every ``fanout`` consecutive nodes become
one; each such node is a record digest -> children.  The groups' last nodes,
in the groups' order, are the leaves of one more tree, whose root names the
dataset.

Prove: a request names a leaf by its places (group's rank, rank in the group).
Requests for leaves below one node are one request as long as they go the same
way: from the root down, the digit of the rank picks a child, the record of its
digest is looked up, and the children not picked are collected.  A level's
records are read once, and no lookup has more than one request per node, so the
root's record isn't a hot key.  Reversed, the collected segments are the proof.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import shuffle_partitions, stored

FANOUT = 16


def digest(text: Column) -> Column:
    """SHA-256 of the UTF-8 bytes, in lowercase hex."""
    return F.sha2(text.cast("binary"), 256)


def field_text(col: Column) -> Column:
    """A field of a leaf: ``-`` for null, else its UTF-8 byte count, a colon and the value."""
    text = col.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(fields: list[Column]) -> Column:
    return digest(F.concat(*[field_text(c) for c in fields]))


def node_digest(children: Column) -> Column:
    return digest(F.array_join(children, ""))


@dataclass
class Manifest:
    """A stored tree.

    ``leaves``: (g, i, _id, leaf, kept columns), g: the group's rank, i: the
    leaf's rank in it.  ``groups``: (g, _group, n).  ``levels[h - 1]``: the
    records (g, i, n, digest, children) of height h of the groups' trees, n: the
    nodes of the group at that height; ``top_levels`` those of the tree of
    groups, as one group 0, over ``subroots``(g = 0, i: the group's rank, n:
    number of groups, digest).  ``root``: its digest, None without any leaf.
    """

    leaves: DataFrame
    groups: DataFrame
    group_count: int
    fanout: int
    root: str | None = None
    subroots: DataFrame | None = None
    levels: list[DataFrame] = field(default_factory=list)
    top_levels: list[DataFrame] = field(default_factory=list)


def _with_offsets(spark: SparkSession, parts: DataFrame) -> tuple[DataFrame, int]:
    """(_part, _before), the sum of all: from ``parts``(_part, n), of one row a partition."""
    rows, before = [], 0
    for r in sorted(parts.collect(), key=lambda r: r["_part"]):
        rows.append((r["_part"], before))
        before += r["n"]
    schema = T.StructType([T.StructField("_part", T.IntegerType()), T.StructField("_before", T.LongType())])
    return F.broadcast(spark.createDataFrame(rows, schema)), before


def _levels(nodes: DataFrame, most: int, fanout: int, name: str) -> list[DataFrame]:
    """The records above ``nodes``(g, i, n, digest), lowest level first; ``most``: the largest n."""
    out = []
    while most > 1:
        nodes = stored(
            nodes.where("n > 1").select("g", F.expr(f"i div {fanout}").alias("up"), F.struct("i", "digest").alias("node"), "n")
            .groupBy("g", "up").agg(F.sort_array(F.collect_list("node")).alias("nodes"), F.max("n").alias("n"))  # at most fanout nodes
            .select("g", F.col("up").alias("i"), F.expr(f"(n + {fanout - 1}) div {fanout}").alias("n"),
                    F.transform("nodes", lambda x: x["digest"]).alias("children"))
            .withColumn("digest", node_digest(F.col("children"))), name)
        out.append(nodes)
        most = -(-most // fanout)
    return out


def manifest(docs: DataFrame, fields: list[str], id_col: str = "doc_id", group_col: str = "source", fanout: int = FANOUT,
             keep: dict[str, Column] | None = None) -> Manifest:
    """Build and store the tree of all rows of ``docs``.

    A leaf is the digest of ``fields`` in this order (see :func:`field_text`).
    Leaves of a group ascend by id, null ids first, equal ids by their digest;
    repeated rows are leaves of their own, next to each other.  Groups ascend
    bytewise, null first.  A group of one leaf is that leaf.  ``keep`` are
    columns to be handed over with each leaf, by name.  Other columns, whatever
    their names, are ignored; an empty table has no root.
    """
    spark, keep = docs.sparkSession, keep or {}
    n = shuffle_partitions(spark)
    made = stored(docs.select(F.col(group_col).cast("string").alias("_group"), F.col(id_col).alias("_id"),
                              leaf_digest([F.col(f"`{c}`") for c in fields]).alias("leaf"),
                              F.monotonically_increasing_id().alias("_row"), *[c.alias(k) for k, c in keep.items()]), "merkle-leaves")
    order = [F.col("_id").asc_nulls_first(), F.col("leaf"), F.col("_row")]  # the row's number splits repeated rows
    ranged = stored(made.repartitionByRange(n, F.col("_group").asc_nulls_first(), *order)
                    .withColumn("_part", F.spark_partition_id()), "merkle-ranges")

    totals = stored(ranged.groupBy("_part", "_group").agg(F.count("*").alias("c")), "merkle-totals")
    groups = totals.groupBy("_group").agg(F.sum("c").alias("n"))
    by_group = stored(groups.repartitionByRange(n, F.col("_group").asc_nulls_first())
                      .withColumn("_part", F.spark_partition_id()), "merkle-groups")
    offsets, group_count = _with_offsets(spark, by_group.groupBy("_part").agg(F.count("*").alias("n")))
    in_part = Window.partitionBy("_part").orderBy(F.col("_group").asc_nulls_first())
    groups = stored(by_group.join(offsets, "_part").select(
        (F.col("_before") + F.row_number().over(in_part) - 1).alias("g"), "_group", "n"), "merkle-groups")

    # Rows of a group in earlier partitions; a group has at most one total per partition.
    earlier = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.withColumn("_before", F.coalesce(F.sum("c").over(earlier), F.lit(0)))
    named = groups.withColumnRenamed("_group", "_named")
    before = before.join(named, F.col("_group").eqNullSafe(F.col("_named"))).select(
        F.col("_part").alias("_p"), F.col("_group").alias("_named"), "_before", "g", "n")
    here = Window.partitionBy("_part", "_group").orderBy(*order)
    numbered = ranged.withColumn("_at", F.row_number().over(here) - 1)
    leaves = stored(
        numbered.join(before, (F.col("_part") == F.col("_p")) & F.col("_group").eqNullSafe(F.col("_named")))
        .select("g", (F.col("_before") + F.col("_at")).alias("i"), "n", "_id", "leaf", *keep), "merkle-places")

    out = Manifest(leaves, groups, group_count, fanout)
    if group_count:
        nodes = leaves.select("g", "i", "n", F.col("leaf").alias("digest"))
        out.levels = _levels(nodes, groups.agg(F.max("n")).first()[0], fanout, "merkle-level")
        tops = [x.where("n = 1").select(F.lit(0).cast("long").alias("g"), F.col("g").alias("i"), F.lit(group_count).cast("long").alias("n"), "digest")
                for x in [nodes, *out.levels]]
        subroots = tops[0]
        for t in tops[1:]:
            subroots = subroots.unionByName(t)
        out.top_levels = _levels(subroots, group_count, fanout, "merkle-top-level")
        out.subroots = subroots
        out.root = (out.top_levels[-1] if out.top_levels else subroots).first()["digest"]
    return out


def _picked(found: DataFrame, fanout: int, *more: str) -> DataFrame:
    """One request per child of the records found, each with the segment of the children not picked in front of its path."""
    others = F.concat(F.slice("children", F.lit(1), F.col("digit")),
                      F.slice("children", F.col("digit") + 2, F.lit(fanout)))
    return found.select("*", F.posexplode("children").alias("digit", "child")).select(
        "g", (F.col("i") * fanout + F.col("digit")).alias("i"), F.col("child").alias("digest"),
        F.concat(F.array(F.struct("digit", others.alias("others"))), F.col("path")).alias("path"), *more)


def _found(requests: DataFrame, level: DataFrame) -> DataFrame:
    """Requests with the children of their digest; equal digests have equal children.

    Spark takes exploded requests to be as large as the records they come from,
    and would broadcast a level's worth of paths; all joins of the descent merge.
    """
    return requests.hint("merge").join(level.select("digest", "children").dropDuplicates(["digest"]), "digest")


PATH = "array<struct<digit: int, others: array<string>>>"


def proofs(tree: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """(_id, leaf, subroot, root, path, kept columns) of each leaf, or of those whose id is in ``requests``(_id).

    ``path``: from the leaf's run up to the root's, the place among the children
    (``digit``) and the digests of the others.  ``requests`` may repeat ids and
    hold null or unknown ones; these find nothing.
    """
    fanout = tree.fanout
    asked = tree.leaves
    if requests is not None:
        asked = asked.join(requests.select("_id").distinct(), "_id", "left_semi")
    kept = [c for c in asked.columns if c not in ("g", "i", "n")]
    if tree.root is None:
        return asked.select(*kept, F.lit(None).cast("string").alias("subroot"), F.lit(None).cast("string").alias("root"),
                            F.lit(None).cast(PATH).alias("path"))

    # The nodes that lead to the leaves asked for, by height.
    runs = asked.groupBy("g", F.expr(f"i div {fanout}").alias("i")).agg(
        F.collect_list(F.struct(F.col("i"), *kept)).alias("asked"))  # at most fanout leaves
    if requests is not None:
        runs = stored(runs, "merkle-requests")
    wanted = {1: runs.select("g", "i")}
    for h in range(2, len(tree.levels) + 1):
        wanted[h] = wanted[h - 1].select("g", F.expr(f"i div {fanout}").alias("i")).distinct()

    # From the root to the groups' trees.
    top = tree.top_levels[-1] if tree.top_levels else tree.subroots  # its only node with n = 1
    open_ = top.where("n = 1").select("g", "i", "digest", F.array().cast(PATH).alias("path"))
    for level in reversed(tree.top_levels):
        open_ = _picked(_found(open_, level), fanout)
    height = sum((F.when(F.col("n") > fanout ** k, 1).otherwise(0) for k in range(len(tree.levels))), F.lit(0))
    groups = tree.groups.select("g", height.alias("height"))
    if requests is not None:
        groups = groups.join(runs.select("g").distinct(), "g", "left_semi")
    entries = stored(open_.select(F.col("i").alias("g"), F.lit(0).cast("long").alias("i"), "digest", "path", F.col("digest").alias("subroot"))
                     .hint("merge").join(groups, "g"), "merkle-entries")

    # Down the groups' trees, each entered at its own height.
    columns = ["g", "i", "digest", "path", "subroot"]
    at, found = None, None
    for h in range(len(tree.levels), 0, -1):
        begins = entries.where(F.col("height") == h).select(columns)
        at = begins if at is None else at.unionByName(begins)
        found = _found(at, tree.levels[h - 1])
        if h > 1:
            at = _picked(found, fanout, "subroot")
            if requests is not None:
                at = at.join(wanted[h - 1], ["g", "i"], "left_semi")
    lone = entries.where("height = 0").select(*columns, F.lit(None).cast("array<string>").alias("children"))
    nodes = lone if found is None else lone.unionByName(found.select(*columns, "children"))

    digit = F.expr(f"cast(r.i % {fanout} as int)")
    one = runs.join(nodes.hint("merge"), ["g", "i"]).select(F.explode("asked").alias("r"), "children", "digest", "path", "subroot")
    others = F.concat(F.slice("children", F.lit(1), digit), F.slice("children", digit + 2, F.lit(fanout)))
    path = F.when(F.col("children").isNull(), F.col("path")).otherwise(
        F.concat(F.array(F.struct(digit.alias("digit"), others.alias("others"))), F.col("path")))
    # The digest that the descent ends at, not the one that the request came with.
    leaf = F.when(F.col("children").isNull(), F.col("digest")).otherwise(F.element_at("children", digit + 1))
    return one.select(*[(leaf if c == "leaf" else F.col(f"r.{c}")).alias(c) for c in kept], "subroot",
                      F.lit(tree.root).alias("root"), path.alias("path"))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    def up(below, s):
        return digest(F.concat(F.array_join(F.slice(s["others"], F.lit(1), s["digit"]), ""), below,
                               F.array_join(F.slice(s["others"], s["digit"] + 1, F.size(s["others"])), "")))
    return F.aggregate(path, leaf, up)


def path_digest(path: Column) -> Column:
    """One digest of all others of a path, from the leaf up, left to right."""
    return digest(F.array_join(F.flatten(F.transform(path, lambda s: s["others"])), ""))
