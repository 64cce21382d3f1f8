"""Sinks (SNK1-SNK15): batch writers, replaced partitions of a table that is also
the input, text / split-JSON outputs, table registration.

New rows are appended.  Rows that change are written with Spark's dynamic
partition overwrite, which stages the new files and replaces only the partitions
that the rows lie in, so it may read the table that it writes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.keys import attach_ids, new_ids


def batch_writer(df: DataFrame, partition_column: str | None = None,
                 exclude_columns: Sequence[str] = (), mode: str = "append",
                 fmt: str = "parquet") -> DataFrameWriter:
    """SNK1: writer with dropped columns, a save mode and an optional partition column."""
    w = df.drop(*exclude_columns).write.format(fmt).mode(mode)
    if partition_column:
        w = w.partitionBy(partition_column)
    return w


def write_parquet_truncate(df: DataFrame, path: str, compression: str = "snappy") -> None:
    """SNK2: truncate-and-write Parquet."""
    df.write.mode("overwrite").option("compression", compression).parquet(path)


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, None if there is none yet; any other failure is raised.

    A folder without a data file is no table: a first write that died leaves one.
    """
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def append_rows(df: DataFrame, path: str, partition_column: str | None = None) -> None:
    """SNK1/SNK4: one append, which becomes visible when the whole job has succeeded."""
    batch_writer(df, partition_column).save(path)


def stable_ids(df: DataFrame, key_cols: Sequence[str], ledger_path: str, id_col: str = "id", base: int = 0) -> DataFrame:
    """DML9: ``df`` with ids that its keys keep across loads.

    The ledger at ``ledger_path`` holds one row per key ever seen; the keys that
    it lacks are appended with ids after its highest.  An append that died
    half-way has given some keys their ids; the next run gives the others later
    ones.  One writer at a time.
    """
    spark = df.sparkSession
    append_rows(new_ids(read_or_none(spark, ledger_path), df, key_cols, id_col, base), ledger_path)
    return attach_ids(df, spark.read.parquet(ledger_path), key_cols, id_col)


def replace_partitions(df: DataFrame, path: str, *partition_columns: str) -> None:
    """SNK3/SNK15: write ``df`` in place of the partitions that its rows lie in; the others stay untouched."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_columns).parquet(path)


def register_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> None:
    """SNK13: drop and re-register a catalog table over a path."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING {fmt} LOCATION '{path}'")


def write_lines(df: DataFrame, path: str, single_file: bool = False) -> None:
    """SNK10: a one-column frame as plain lines (no quoting); ``single_file`` for small outputs only."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").text(path)


def write_split_json(df: DataFrame, path: str, split_col: str = "split_id", array_field: str | None = None) -> None:
    """SNK11: one JSON output directory per split value.

    With ``array_field`` every line is a document ``{array_field: [item]}``, which
    the array reader takes like one document with all items, while no split has
    to fit into one row.
    """
    if array_field:
        item = F.struct(*[F.col(f"`{c}`") for c in df.columns if c != split_col])
        df = df.select(split_col, F.array(item).alias(array_field))
    df.write.mode("overwrite").partitionBy(split_col).json(path)


def sized_session(spark: SparkSession, **settings) -> SparkSession:
    """A session like ``spark`` (catalog, cached data and context are shared) with other settings of its own."""
    own = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled", "spark.sql.sources.partitionOverwriteMode"):
        own.conf.set(key, spark.conf.get(key))
    for key, value in settings.items():
        own.conf.set(key, value)
    own.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    return own


def merge_files(spark: SparkSession, pattern: str, out_path: str, fmt: str = "json",
                single_file: bool = False, target_bytes: int | None = None, schema=None) -> None:
    """SNK9 ``copyBehavior: MergeFiles``: many input files read as one dataset and
    written once (one file only when asked, for small outputs).

    With ``target_bytes`` files are merged by size: the scan packs whole small
    files into tasks of up to that many listed bytes (and cuts larger files, where
    the format allows), and each task writes one file.  Nothing is shuffled, and
    the files written are as many as the bytes need.  ``schema`` saves the pass
    that infers it.
    """
    reading = spark
    if target_bytes:
        # Without a smallest number of tasks or a price for opening a file, bytes alone decide.
        reading = sized_session(spark, **{"spark.sql.files.maxPartitionBytes": target_bytes, "spark.sql.files.openCostInBytes": 0,
                                   "spark.sql.files.minPartitionNum": 1})
    reader = reading.read.format(fmt).option("multiLine", fmt == "json")
    df = (reader.schema(schema) if schema is not None else reader).load(pattern)
    (df.coalesce(1) if single_file else df).write.mode("overwrite").format(fmt).save(out_path)


def write_table(df: DataFrame, table: str, schema=None, mode: str = "append") -> None:
    """SNK5/SNK7: insert into a catalog table, creating it when missing.

    With ``schema`` the rows are first projected and cast onto the target's
    declared columns (NOT NULL columns checked), as a typed INSERT does.
    """
    from ledgerline.operators.projection import cast_to_schema
    spark = df.sparkSession
    out = cast_to_schema(df, schema) if schema is not None else df
    if spark.catalog.tableExists(table):
        # insertInto goes by position; the target's names decide the order.
        out.select(*[F.col(f"`{c}`") for c in spark.table(table).columns]).write.mode(mode).insertInto(table)
    else:
        out.write.mode(mode).saveAsTable(table)
