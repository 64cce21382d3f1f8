"""Join operators that need a rewrite to scale (JN3, JN8, JN9, JN12).

Each function returns the same rows as the reference construct but keeps
the plan on equi-joins, so Spark can pick sort-merge / shuffled-hash /
broadcast joins and AQE can split skewed partitions.  No nested-loop or
cartesian join appears in any of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def or_join(left: DataFrame, right: DataFrame, left_key: str | Column,
            right_keys: Sequence[str], how: str = "left",
            key_name: str = "_or_key") -> DataFrame:
    """``left JOIN right ON left.k = right.a OR left.k = right.b`` (JN3).

    Every right row is expanded once per *distinct* non-null key in
    ``right_keys`` and joined on equality.  ``array_distinct`` keeps a right
    row whose keys coincide from matching the same left row twice, so the
    multiset of output rows equals the disjunctive join.
    """
    keys = F.array_distinct(F.array(*[F.col(k) for k in right_keys]))
    exploded = right.withColumn(key_name, F.explode(keys)).where(F.col(key_name).isNotNull())
    return left.join(exploded, _c(left_key) == F.col(key_name), how).drop(key_name)


def not_in(left: DataFrame, left_key: str, sub: DataFrame, sub_key: str) -> DataFrame:
    """``left WHERE left_key NOT IN (SELECT sub_key FROM sub)`` with SQL NULL rules (JN9).

    * empty subquery            -> every left row survives (NULL keys too);
    * any NULL in the subquery  -> no row survives;
    * otherwise                 -> rows with a non-NULL key absent from the subquery.

    The subquery is used through a plain ``left_anti`` equi-join, so it is
    never forced into a broadcast (a raw ``NOT IN`` plans a null-aware
    broadcast anti join regardless of its size).  The two facts about the
    subquery are uncorrelated scalar subqueries evaluated once.
    """
    k = F.col(sub_key)
    stats = sub.select(F.struct(F.count(F.lit(1)).alias("n"), F.count_if(k.isNull()).alias("nulls"))).scalar()
    n_rows, n_nulls = stats["n"], stats["nulls"]
    matches = sub.where(k.isNotNull()).select(k.alias("_nin_key"))
    kept = left.join(matches, F.col(left_key) == F.col("_nin_key"), "left_anti")
    return kept.where((n_rows == 0) | ((n_nulls == 0) & F.col(left_key).isNotNull()))


def lateral_total(parent: DataFrame, parent_key: str, lines: DataFrame, line_key: str,
                  total: Column, name: str) -> DataFrame:
    """``parent CROSS APPLY (SELECT f(parent.key) AS name)`` for a per-key scalar (JN12).

    The scalar function is computed for all keys at once by one aggregation
    of ``lines`` and attached with a left join; the parent row survives with
    NULL when the function finds no line, as the scalar call does.
    """
    per_key = lines.groupBy(F.col(line_key).alias("_lat_key")).agg(total.alias(name))
    return parent.join(per_key, F.col(parent_key) == F.col("_lat_key"), "left").drop("_lat_key")
