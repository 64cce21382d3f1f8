"""Data-quality operators (FLT9, QA1-QA6, JN15).

The silver split keeps a third bucket: rows whose ``runtime`` or
``budget`` is NULL satisfy neither the clean nor the quarantine predicate
(S22) and would silently vanish; they are kept as ``unclassified``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ledgerline.functions.json import explode_rows

MIN_BUDGET = 1_000_000

CLEAN = "loaded"
QUARANTINED = "quarantined"
UNCLASSIFIED = "unclassified"


def clean_predicate() -> Column:
    return (F.col("runtime") >= 0) & (F.col("budget") >= MIN_BUDGET)


def quarantine_predicate() -> Column:
    return (F.col("runtime") < 0) | (F.col("budget") < MIN_BUDGET)


def classify(df: DataFrame, col: str = "quality_status") -> DataFrame:
    """Label each row clean / quarantined / unclassified in one pass (FLT9)."""
    return df.withColumn(col, F.when(clean_predicate(), CLEAN)
                         .when(quarantine_predicate(), QUARANTINED)
                         .otherwise(UNCLASSIFIED))


def split_clean_quarantine(df: DataFrame):
    """(clean, quarantine, unclassified) views of one frame; persist the input if reused."""
    return (df.where(clean_predicate()),
            df.where(quarantine_predicate()),
            df.where(~F.coalesce(clean_predicate(), F.lit(False)) & ~F.coalesce(quarantine_predicate(), F.lit(False))))


def defect_counts(df: DataFrame) -> DataFrame:
    """QA2: both defect counts in one scan."""
    return df.agg(F.count_if(F.col("runtime") < 0).alias("negative_runtime"),
                  F.count_if(F.col("budget") < MIN_BUDGET).alias("low_budget"))


METRICS = ("n_rows", "clean", "negative_runtime", "low_budget", "unclassified")


def defect_metrics() -> list[Column]:
    """QA2/QA4: the counts of :data:`METRICS` as aggregates for ``DataFrame.observe``."""
    fits = F.coalesce(clean_predicate(), F.lit(False)) | F.coalesce(quarantine_predicate(), F.lit(False))
    return [F.count(F.lit(1)).alias("n_rows"), F.count_if(clean_predicate()).alias("clean"),
            F.count_if(F.col("runtime") < 0).alias("negative_runtime"),
            F.count_if(F.col("budget") < MIN_BUDGET).alias("low_budget"), F.count_if(~fits).alias("unclassified")]


def repair(df: DataFrame) -> DataFrame:
    """QA3, single pass as in the data flow (S21): ``runtime = abs(runtime)``,
    ``budget`` floored to the minimum.  Runtime is repaired whatever the
    budget (S33); a NULL budget stays NULL (and stays unclassified).
    """
    return (df.withColumn("runtime", F.abs(F.col("runtime")))
            .withColumn("budget", F.when(F.col("budget") < MIN_BUDGET, F.lit(float(MIN_BUDGET)))
                        .otherwise(F.col("budget"))))


def lookup_genres(silver: DataFrame, genres_col: str = "genres") -> DataFrame:
    """QA5 genres: distinct ``(id, name)`` of all nested genres, empty names removed, by id.

    ``explode`` + ``distinct`` replaces ``collect_set`` into one array.
    """
    # explode_rows: a plain explode would re-parse the JSON behind ``genres``.
    g = (explode_rows(silver, genres_col, "g")
         .select(F.col("g.id").alias("id"), F.col("g.name").alias("name")).distinct())
    return g.where(F.col("name") != "").orderBy(F.col("id").asc_nulls_first())


def lookup_languages_constant(silver: DataFrame) -> DataFrame:
    """QA5 original languages, faithful (S32): the single row ``(1, 'English')``
    whenever silver is non-empty."""
    return silver.select(F.lit(1).alias("id"), F.lit("English").alias("language")).distinct()


def lookup_table(silver: DataFrame, table_type: str) -> DataFrame:
    """QA5 dispatcher; unknown types raise (the reference returned None)."""
    if table_type == "genres":
        return lookup_genres(silver)
    if table_type == "original_languages":
        return lookup_languages_constant(silver)
    raise ValueError(f"unknown lookup table type: {table_type!r}")


VIOLATION_SCHEMA = StructType([
    StructField("check_name", StringType()), StructField("table_name", StringType()),
    StructField("key_value", StringType()), StructField("n_rows", LongType()),
])


def _key_text(cols: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.col(c).cast("string") for c in cols])


def primary_key_violations(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """QA1 PRIMARY KEY: keys occurring more than once (or with a NULL part)."""
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | any_null)
    return dup.select(F.lit("primary_key").alias("check_name"), F.lit(table).alias("table_name"),
                      _key_text(keys).alias("key_value"), F.col("n").cast("bigint").alias("n_rows"))


def not_null_violations(df: DataFrame, table: str, cols: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """QA1 NOT NULL: one violation row per key and NULL column, counted in one scan for all columns."""
    nulls = F.explode(F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in cols]), lambda x: x.isNotNull()))
    found = df.select(*keys, nulls.alias("_column")).groupBy("_column", *keys).agg(F.count(F.lit(1)).alias("n"))
    return found.select(F.concat(F.lit("not_null:"), "_column").alias("check_name"), F.lit(table).alias("table_name"),
                        _key_text(keys).alias("key_value"), F.col("n").cast("bigint").alias("n_rows"))


def foreign_key_violations(child: DataFrame, table: str, parents: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """QA1 FOREIGN KEY (JN15): non-NULL child keys absent from their parent, for all keys in one scan.

    ``parents``: child column -> (parent, its key).  The child is counted per key
    before the anti join, so a hot key reaches the join as one row.
    """
    pair = lambda name, c: F.struct(F.lit(name).alias("fk"), F.col(c).cast("string").alias("key"))
    used = child.select(F.explode(F.array(*[pair(c, c) for c in parents])).alias("k")).select("k.fk", "k.key") \
        .where(F.col("key").isNotNull()).groupBy("fk", "key").agg(F.count(F.lit(1)).alias("n"))
    known = reduce(lambda a, b: a.unionByName(b), [
        p.select(F.lit(c).alias("fk"), F.col(k).cast("string").alias("key")) for c, (p, k) in parents.items()])
    return used.join(known, ["fk", "key"], "left_anti").select(
        F.concat(F.lit("foreign_key:"), "fk").alias("check_name"), F.lit(table).alias("table_name"),
        F.col("key").alias("key_value"), F.col("n").cast("bigint").alias("n_rows"))
