"""File and database sources (SRC1-SRC3, SRC5-SRC10).

Readers take paths and options as parameters; connection secrets are never
stored in the library.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline.functions.text import split_blanks


def read_multiline_json_array(spark: SparkSession, path: str, array_field: str,
                              schema: StructType | None = None) -> DataFrame:
    """SRC1/SRC3: multi-line JSON documents ``{array_field: [..]}``, one element per row,
    each element re-serialised as one JSON string in ``value``.

    ``path`` may be a wildcard (``movie_*.json``).  Passing ``schema`` skips
    the inference pass over every file (the data-flow form, SRC2).
    """
    reader = spark.read.option("multiLine", True)
    if schema is not None:
        reader = reader.schema(schema)
    raw = reader.json(path)
    return raw.select(F.explode(F.col(array_field)).alias("value")).select(F.to_json("value").alias("value"))


def read_json_lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """SRC2: one JSON document per line with a declared (nested) schema."""
    return spark.read.schema(schema).json(path)


def read_parquet_declared(spark: SparkSession, path: str, schema: StructType | None = None,
                          merge_schema: bool = False) -> DataFrame:
    """SRC4: Parquet with declared columns; ``merge_schema`` tolerates drift across files."""
    reader = spark.read.option("mergeSchema", merge_schema)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def read_table_with_status(spark: SparkSession, table: str, status: str) -> DataFrame:
    """SRC5: catalog table restricted by status (``read_batch_bronze``)."""
    return spark.read.table(table).where(F.col("status") == status)


def read_jdbc(spark: SparkSession, url: str, table: str | None = None, query: str | None = None,
              properties: dict | None = None, split: tuple[str, object, object, int] | None = None) -> DataFrame:
    """SRC6/SRC7: database table or pushed-down query through Spark's JDBC source.

    ``split`` = (column, lower, upper, partitions) reads in parallel ranges; a
    query is then passed as a derived table.  Without it one task reads all.
    """
    reader = spark.read.format("jdbc").option("url", url)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if split is not None:
        column, lower, upper, n = split
        reader = reader.option("partitionColumn", column).option("lowerBound", str(lower)) \
            .option("upperBound", str(upper)).option("numPartitions", n)
    if query is not None and split is not None:
        reader = reader.option("dbtable", f"({query}) q")
    elif query is not None:
        reader = reader.option("query", query)
    else:
        reader = reader.option("dbtable", table)
    return reader.load()


def first_value(df: DataFrame, col: str | Column):
    """SRC8/SRT4: ``firstRow.<col>`` of a one-row control query (one row to the driver)."""
    row = df.select(col).limit(1).collect()
    return row[0][0] if row else None


def read_lines_after_header(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """SRC9: the lines of text files as ``value``, without the first line of each file, whatever it says.

    The CSV reader skips headers by position in every file; a separator that
    text doesn't hold and no quoting leave each line in one column.
    """
    return (spark.read.schema("value string").option("header", True).option("sep", "\u0001")
            .option("quote", "").option("escape", "").option("mode", "PERMISSIVE").csv(list(paths)))


def read_people_text(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """SRC9: ``line`` and its blank-separated ``tokens``; headers and blank lines are dropped.

    Files are read in parallel, so line order is not kept.
    """
    lines = read_lines_after_header(spark, paths)
    tokens = lines.select(F.col("value").alias("line"), split_blanks("value").alias("tokens"))
    return tokens.where(F.length(F.trim("line")) > 0)


def inline_json(spark: SparkSession, text: str) -> DataFrame:
    """SRC10 input: a JSON literal as a one-row ``doc`` column (tests and ad-hoc loads)."""
    return spark.createDataFrame([(0, text)], "doc_id long, doc string")
