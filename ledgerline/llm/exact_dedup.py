"""Exact dedup by skew-safe combining, in DataFrame operations only.

Stage 1 groups by (salt, digest, content): Spark combines inside each map task
first, then merges what meets under one salt, so the copies of a hot text are
spread over ``salts`` reducers and each sends one row on.  Stage 2 groups these
winners by (digest, content).  Both stages compare the full normalised text.
The winners come back to the rows by digest, length and a second hash; if one
such key ever stood for two contents the job fails instead of mixing them up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import BLANKS, text_or_empty


def without_blanks(text: Column) -> Column:
    """The text without the characters [\\x20\\x09-\\x0D]."""
    return F.translate(text, BLANKS, "")


def dedup_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16) -> DataFrame:
    """Every input row with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal when identical without blanks; the row with the most code
    points in its original text stays, then the one with the smallest id.  Null
    and empty and blank texts are equal to each other.  A null id ranks behind
    every other id.  Repeated rows (equal id and text) count each; all of them
    are ``kept`` if their id stays, since nothing tells them apart.  Other
    columns of the input are kept, except those named like a result.
    """
    made = ["keep_id", "group_size", "kept", "text_sha256", "_len", "_h"]
    rows = docs.drop(*[c for c in made if c in docs.columns and c not in (id_col, text_col)])
    text = text_or_empty(text_col)

    keyed = rows.select(F.col(id_col).alias("_id"), text.alias("_text")).select(
        "_id", F.char_length("_text").alias("_chars"), without_blanks(F.col("_text")).alias("_norm"))
    first = F.struct((-F.col("_chars")).alias("c"), F.col("_id").isNull().alias("n"), F.col("_id").alias("id"))
    local = (
        keyed.withColumn("_digest", F.sha2(F.col("_norm").cast("binary"), 256))
        .withColumn("_salt", F.pmod(F.xxhash64("_id"), F.lit(salts)).cast("int"))
        .groupBy("_salt", "_digest", "_norm").agg(F.min(first).alias("_best"), F.count("*").alias("_n"))
    )
    winners = local.groupBy("_digest", "_norm").agg(F.min("_best").alias("_best"), F.sum("_n").alias("_n"))
    key = [F.col("_digest"), F.octet_length("_norm").alias("_len"), F.xxhash64("_norm").alias("_h")]
    kept = winners.select(*key, F.col("_best.id").alias("keep_id"), F.col("_best.c").alias("_c"),
                          F.col("_n").alias("group_size"))
    kept = kept.groupBy("_digest", "_len", "_h").agg(
        F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"), F.count("*").alias("_contents"))

    norm = without_blanks(text)
    marked = rows.withColumn("_digest", F.sha2(norm.cast("binary"), 256)) \
        .withColumn("_len", F.octet_length(norm)).withColumn("_h", F.xxhash64(norm))
    joined = marked.join(kept, ["_digest", "_len", "_h"], "left")
    one = F.when(F.col("_contents") == 1, F.col("keep_id")).otherwise(
        F.raise_error(F.lit("two contents under one digest, length and hash")).cast(rows.schema[id_col].dataType))
    return joined.select(
        *[F.col(f"`{c}`") for c in rows.columns], one.alias("keep_id"), F.col("group_size"),
        F.col(f"`{id_col}`").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("_digest").alias("text_sha256"))
