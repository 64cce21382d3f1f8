"""From raw documents to packed training sequences, stage by stage.

Each stage takes the documents that the one before kept, as a table, and gives
back documents in the same columns; the last one gives the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import stored
from ledgerline.llm.exact_dedup import dedup_groups
from ledgerline.llm.jaccard_join import without_linked
from ledgerline.llm.packing import pack_documents
from ledgerline.llm.quality_rules import score_quality, train
from ledgerline.llm.substring_dedup import remove_repeats

# In each stage the columns beside id and text travel as one, so that none of them can have the name of a result.


def _packed(docs: DataFrame) -> DataFrame:
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*others, F.lit(True).alias("_")).alias("rest"))


def _unpacked(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col(c) if c in ("doc_id", "text") else F.col("rest").getField(c).alias(c) for c in columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble predicts good, learnt from the labels whose crc32(doc_id) mod 5 is not 0.

    A null text is judged like an empty one, a null id has no label and is
    judged all the same; repeated rows have equal scores and stay or go
    together.  Whole texts of any length are judged.  An empty table, or one
    without labels, gives what the untrained model keeps.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    learnt = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(5)) != 0
    model = train(docs.select("doc_id", "text"), labels.where(learnt))
    return _unpacked(score_quality(_packed(docs), model).where("predicted = 1"), docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal without blanks: the longest, then the smallest id.

    Null, empty and blank texts are one group.  A null id ranks behind all
    others.  Of repeated rows, and of equal texts under one id, one stays.
    Texts are compared whole; an empty table stays empty.
    """
    kept = dedup_groups(_packed(docs)).where("kept")
    if docs.groupBy("doc_id").count().where("count > 1").limit(1).count():  # such rows can't be told apart by id
        kept = kept.dropDuplicates(["text_sha256"])
    return _unpacked(kept, docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of Jaccard similarity 0.8 on five-word shingles connect: the smallest id.

    Rows are told apart by themselves: of repeated rows, and of linked ones with
    equal or null ids, one stays, a known id before a null one.  Texts without
    words (null, empty, blank) link with nothing and stay.  Whole texts are
    compared; an empty table stays empty.
    """
    return _unpacked(without_linked(_packed(docs), size=5, percent=80, keep=["rest"]), docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their windows of 35 words that occur twice; untouched texts stay as they are.

    No row goes: a text that loses all words is empty.  Null, empty and short
    texts are untouched (null stays null).  Repeated rows and rows with equal or
    null ids are documents of their own, whose windows repeat each other.
    ``n_chars``, where there is one, follows the text.
    """
    out = remove_repeats(_packed(docs), length=35, keep=["rest"], untouched_as_is=True).withColumnRenamed("kept_text", "text")
    if "n_chars" not in docs.columns:
        return _unpacked(out, docs.columns)
    chars = F.when(F.col("n_removed") == 0, F.col("rest").getField("n_chars")).otherwise(F.char_length("text"))
    return _unpacked(out.withColumn("rest", F.col("rest").withField("n_chars", chars.cast(docs.schema["n_chars"].dataType))), docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of at most 2048 tokens.

    A null or empty text is one piece of the end token alone.  Repeated rows and
    equal or null ids are documents of their own; longer texts are cut into
    pieces, none is shortened.  An empty table gives no pieces.
    """
    return pack_documents(docs)


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("packing", packing),
]

#: The classifier and the packing can't be expressed in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written before the next stage reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
