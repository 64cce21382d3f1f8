"""Aggregation operators (AGG3, AGG12-AGG18, WIN1, JN8 rewrite, SET1/SET2).

All of them are partial + final hash aggregates: a hot key is combined
map-side before the shuffle, so one key holding a large share of the rows
costs one row per map task on the wire, not its whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def per_key_sums(df: DataFrame, key: str, measure: str, prefix: str) -> DataFrame:
    """Sum, row count and non-null count of ``measure`` per ``key``."""
    m = F.col(measure)
    return df.groupBy(key).agg(
        F.sum(m).alias(f"{prefix}_sum"),
        F.count(F.lit(1)).alias(f"{prefix}_rows"),
        F.count(m).alias(f"{prefix}_nn"),
    )


def fanout_pair_sums(a: DataFrame, b: DataFrame, key: str, a_measure: str, b_measure: str) -> DataFrame:
    """Per-key sums over the inner join ``a JOIN b USING (key)`` without building it (JN8).

    For a key with rows ``a_1..a_m`` and ``b_1..b_n`` the join has ``m*n``
    rows, and over it

    * ``SUM(a.x)``         = ``sum(a.x) * n``
    * ``SUM(b.y)``         = ``sum(b.y) * m``
    * ``SUM(a.x - b.y)``   = ``sum(a.x) * nn(b.y) - sum(b.y) * nn(a.x)``

    where ``nn`` counts non-null values (the difference is NULL whenever one
    side is).  Two aggregates and a 1:1 join replace the quadratic fan-out.
    Results are returned as ``a_total``, ``b_total``, ``diff_total`` and are
    NULL where SUM over the join would be NULL.
    """
    pa = per_key_sums(a, key, a_measure, "a")
    pb = per_key_sums(b, key, b_measure, "b")
    j = pa.join(pb, key, "inner")
    wide = "decimal(38,0)"
    a_sum = F.col("a_sum").cast(wide)
    b_sum = F.col("b_sum").cast(wide)
    return j.select(
        key,
        (a_sum * F.col("b_rows")).alias("a_total"),
        (b_sum * F.col("a_rows")).alias("b_total"),
        F.when((F.col("a_nn") > 0) & (F.col("b_nn") > 0),
               a_sum * F.col("b_nn") - b_sum * F.col("a_nn")).alias("diff_total"),
    )


def top_per_group(df: DataFrame, group_cols: Sequence[str], order_col: str) -> DataFrame:
    """Rows whose ``order_col`` equals the group maximum: ``DENSE_RANK() ... DESC = 1`` (WIN1).

    Ties are all kept.  Written as aggregate + equi-join instead of a window
    so that no single task has to sort a whole (possibly hot) group: the
    maximum is a partial aggregate and the join back is a skew-splittable
    shuffle join.  A group whose values are all NULL keeps all its rows, as
    the rank does (NULLs sort last under DESC, so they rank first only then).
    """
    best = df.groupBy(*group_cols).agg(F.max(order_col).alias("_top_value"))
    cond = [df[g].eqNullSafe(best[g]) for g in group_cols]
    cond.append(df[order_col].eqNullSafe(best["_top_value"]))
    return df.join(best, cond, "left_semi")


def dedupe_first(df: DataFrame, key_cols: Sequence[str], order_cols: Sequence[str] | None = None) -> DataFrame:
    """One row per key, every other column taken from the first row (AGG12/AGG13).

    "First" is made deterministic: the row with the smallest
    ``(order_cols..., remaining columns...)`` tuple.  ``min(struct)`` is a
    partial aggregate, so duplicate-heavy keys are merged map-side.
    """
    order_cols = list(order_cols or [])
    rest = [c for c in df.columns if c not in key_cols and c not in order_cols]
    packed = F.min(F.struct(*[F.col(c) for c in order_cols + rest])).alias("_first")
    out = df.groupBy(*key_cols).agg(packed)
    return out.select(*key_cols, *[F.col(f"_first.{c}").alias(c) for c in order_cols + rest]).select(*df.columns)


def distinct_by_row_hash(df: DataFrame) -> DataFrame:
    """``groupBy(sha2(columns())) + first`` (AGG14) is exactly ``DISTINCT`` on the row."""
    return df.distinct()


def explode_distinct(df: DataFrame, array_col: str, alias: str) -> DataFrame:
    """Distinct elements of an array column (AGG15) without ``collect_set``.

    ``collect_set`` over the whole table builds one array on one task;
    ``explode`` + ``distinct`` is a shuffled hash aggregate instead.
    """
    return df.select(F.explode(array_col).alias(alias)).distinct()


def pivot_sum(df: DataFrame, group_cols: Sequence[str], pivot_col: str, values: Sequence,
              measure: Column, names: Sequence[str] | None = None) -> DataFrame:
    """``PIVOT (SUM(m) FOR col IN (v1, ...))`` with an explicit value list (AGG16-AGG18).

    The explicit list avoids the extra job Spark runs to discover the
    values and drops rows outside the list, as ``PIVOT`` does.  Columns
    are renamed to ``names`` when given.
    """
    out = df.groupBy(*group_cols).pivot(pivot_col, list(values)).agg(F.sum(measure))
    if names:
        for v, n in zip(values, names):
            out = out.withColumnRenamed(str(v), n)
    return out


def union_distinct(*frames: DataFrame) -> DataFrame:
    """``a UNION b UNION c`` (SET1/SET2): union by position, then one distinct."""
    out = frames[0]
    for f in frames[1:]:
        out = out.union(f)
    return out.distinct()
