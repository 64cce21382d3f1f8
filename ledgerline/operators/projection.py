"""Projection helpers (PRJ2, PRJ8, FN21, FN22, DML8, SNK5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def rename_map(df: DataFrame, mapping: Sequence[tuple[str, str]], skip_duplicate_inputs: bool = True,
               skip_duplicate_outputs: bool = True) -> DataFrame:
    """PRJ2 ``select(mapColumn(dst = src, ...))`` with the duplicate-mapping switches.

    A repeated input column is mapped once (first mapping wins) and a
    repeated output name is produced once (first mapping wins).
    """
    seen_in, seen_out, cols = set(), set(), []
    for src, dst in mapping:
        if skip_duplicate_inputs and src in seen_in:
            continue
        if skip_duplicate_outputs and dst in seen_out:
            continue
        seen_in.add(src)
        seen_out.add(dst)
        cols.append(F.col(src).alias(dst))
    return df.select(*cols)


def each_column(df: DataFrame, keys: Sequence[str], fn) -> list[Column]:
    """PRJ8 ``each(match(name != key), $$ = f($$))``: ``fn(col).alias(name)`` for every non-key column."""
    return [fn(F.col(c)).alias(c) for c in df.columns if c not in keys]


def row_sha256(*cols) -> Column:
    """FN22 ``sha2(256, columns())``: hash of the whole row (via its JSON text)."""
    return F.sha2(F.to_json(F.struct(*[F.col(c) if isinstance(c, str) else c for c in cols])), 256)


def array_text(col) -> Column:
    """FN21 ``toString(array)``: the array as JSON list text."""
    return F.to_json(F.col(col) if isinstance(col, str) else col)


def cast_to_schema(df: DataFrame, schema: StructType, check_not_null: bool = True) -> DataFrame:
    """SNK5/SNK7/DML8: project ``df`` onto a target table's typed columns.

    Columns are matched by name and cast to the declared types; missing
    nullable columns become NULL.  With ``check_not_null`` a NOT NULL column
    that receives a NULL fails the job with ``assert_true`` instead of being
    written.
    """
    out = []
    for f in schema.fields:
        c = F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)
        if check_not_null and not f.nullable:
            c = F.when(F.assert_true(c.isNotNull(), F.lit(f"NULL in NOT NULL column {f.name}")).isNull(), c)
        out.append(c.alias(f.name))
    return df.select(*out)
