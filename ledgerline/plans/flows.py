"""File-backed flows: the movie lake (P1-P3), the warehouse load (P4, P5, INC7) and
their sequencing (P9).

Every step can run again at any point.  Silver, lookups, ODS tables and watermarks
only grow by appends of rows that are not there yet; what changes in place is a
bronze row's status and the integration copy.  With a ``catalog`` prefix in the
configuration these two are published tables (``sinks/published.py``): a change
is staged, then one catalog statement per ingest date or key bucket puts it in
place, so that a failure at any point leaves old or new rows, never fewer.
Without, they are plain folders, whose ingest dates are rewritten by dynamic
partition overwrite.  A step that fails between two of its commits finds on the
next run what it has already written.  Configuration is plain dataclasses (UDF5).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import incremental as INC
from ledgerline.operators import mutation as M
from ledgerline.operators import quality as Q
from ledgerline.operators import warehouse as W
from ledgerline.plans import medallion as MD
from ledgerline.sinks import published as PB
from ledgerline.sinks import writers as WR
from ledgerline.sources import files as S
from ledgerline.streaming import ingest as IN


@dataclass
class MovieFlowConfig:
    raw_path: str                      # file or wildcard of ``{"movie": [...]}`` documents
    base: str                          # lake root
    datasource: str = "raw"
    as_of: dt.datetime | None = None   # pin the ingest time (tests); default: now
    catalog: str | None = None         # prefix of the catalog's table names; None: bronze is a folder
    new_files_only: bool = False       # raw files by a file stream: bronze is partitioned by its batches; fixed for life
    files_per_batch: int | None = None
    max_defect_share: float | None = None  # counts are kept; P2 stops before its status commit if more rows are defective

    @property
    def partition_column(self) -> str:
        return IN.BATCH if self.new_files_only else "p_ingestdate"

    @property
    def bronze(self) -> str:
        return f"{self.base}/bronze"

    @property
    def silver(self) -> str:
        return f"{self.base}/silver"

    def lookup(self, name: str) -> str:
        return f"{self.base}/lookups/{name}"

    @property
    def unreadable(self) -> str:
        return f"{self.base}/unreadable"

    @property
    def metrics(self) -> str:
        return f"{self.base}/metrics/silver"

    @property
    def checkpoint(self) -> str:
        return f"{self.base}/checkpoints/raw"


class DefectLimit(RuntimeError):
    """More rows of a run are defective than its configuration allows."""


VALUE_KEY = "value_sha256"


def _with_key(df: DataFrame) -> DataFrame:
    """A short key of the raw text, so that joins don't carry the text itself."""
    return df.withColumn(VALUE_KEY, F.sha2(F.col("value").cast("binary"), 256))


def _absent(df: DataFrame, present: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose keys (NULL equal to NULL) are not in ``present``."""
    if present is None:
        return df
    old = present.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    return df.join(old, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], "left_anti")


def read_bronze(spark: SparkSession, cfg: MovieFlowConfig) -> DataFrame | None:
    return PB.table_or_none(spark, f"{cfg.catalog}_bronze") if cfg.catalog else WR.read_or_none(spark, cfg.bronze)


def _replace_dates(rows: DataFrame, cfg: MovieFlowConfig) -> None:
    """SNK3/SNK15: the ingest dates (or batches) of ``rows`` become these rows."""
    if cfg.catalog:
        PB.publish_partitions(rows, f"{cfg.catalog}_bronze", cfg.bronze, cfg.partition_column)
    else:
        WR.replace_partitions(rows, cfg.bronze, cfg.partition_column)


def read_silver(spark: SparkSession, cfg: MovieFlowConfig) -> DataFrame:
    return spark.read.parquet(cfg.silver).select(*MD.SILVER_COLUMNS)


def raw_to_bronze(spark: SparkSession, cfg: MovieFlowConfig) -> None:
    """Raw documents -> bronze rows with status ``new``, appended by ingest date.

    Values already present in bronze are not ingested again, so re-running
    the same raw files leaves bronze unchanged (the reference appends them
    a second time).  Duplicates inside one batch are kept; silver dedupes.
    With ``new_files_only`` see :func:`new_files_to_bronze`.
    """
    if cfg.new_files_only:
        return new_files_to_bronze(spark, cfg)
    raw = S.read_multiline_json_array(spark, cfg.raw_path, "movie")
    # One time for the whole run: the ingest dates below are looked at twice.
    as_of = cfg.as_of or spark.range(1).select(F.current_timestamp()).first()[0]
    fresh = _with_key(MD.transform_raw(raw, cfg.datasource, as_of))
    current = read_bronze(spark, cfg)
    fresh = _absent(fresh, current, [VALUE_KEY])
    if cfg.catalog:  # the day's rows so far and the fresh ones
        if current is not None:
            days = [r[0] for r in fresh.select("p_ingestdate").distinct().collect()]  # the run's date
            fresh = fresh.unionByName(current.where(F.col("p_ingestdate").isin(days)))
        _replace_dates(fresh, cfg)
    else:
        WR.append_rows(fresh, cfg.bronze, "p_ingestdate")


def new_files_to_bronze(spark: SparkSession, cfg: MovieFlowConfig) -> None:
    """P1 over the files that no run has taken yet, each read once; bronze itself isn't read.

    A batch's rows replace those of its own number, so a batch that is repeated
    after a failure leaves every row once.  Files that are no document with the
    array go to ``unreadable`` in the same way.  A value that comes again in a
    later file is a further bronze row (silver has one row per value).
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        docs = IN.with_items(batch, "movie").persist(StorageLevel.MEMORY_AND_DISK)  # two sinks, one parse
        try:
            items = IN.item_texts(docs)
            at = F.lit(cfg.as_of).cast("timestamp_ntz") if cfg.as_of else F.col("arrived").cast("timestamp_ntz")
            rows = MD.transform_raw(items, cfg.datasource, at=at)
            _replace_dates(_with_key(rows).withColumn(IN.BATCH, F.lit(int(batch_id))), cfg)
            WR.replace_partitions(IN.unreadable(docs).withColumn(IN.BATCH, F.lit(int(batch_id))), cfg.unreadable, IN.BATCH)
        finally:
            docs.unpersist()
    IN.run_available(IN.new_documents(spark, cfg.raw_path, cfg.files_per_batch), handle, cfg.checkpoint)


def _merge_lookup(df: DataFrame, path: str, name: str) -> None:
    """QA5: add the rows that the lookup does not hold yet."""
    spark = df.sparkSession
    WR.append_rows(_absent(df, WR.read_or_none(spark, path), df.columns), path)
    spark.read.parquet(path).createOrReplaceTempView(name)


def _append_silver(rows: DataFrame, cfg: MovieFlowConfig) -> None:
    """One silver row per raw value, also when the step runs again after a failure."""
    keyed = _with_key(rows).select(VALUE_KEY, *MD.SILVER_COLUMNS)
    WR.append_rows(_absent(keyed, WR.read_or_none(rows.sparkSession, cfg.silver), [VALUE_KEY]), cfg.silver)


def _write_status(bronze: DataFrame, labels: DataFrame, status: str, cfg: MovieFlowConfig) -> None:
    """DML3/JN14: set the status of the matched rows, in the ingest dates (or batches) that hold rows of ``status``."""
    touched = bronze.where(F.col("status") == status).select(cfg.partition_column).distinct()
    rows = bronze.join(touched, cfg.partition_column, "left_semi")
    labels = _with_key(labels).select(VALUE_KEY, "new_status")  # the raw text isn't carried into the join
    out = M.update_matched(rows, labels, VALUE_KEY, "status", source_col="new_status")
    _replace_dates(out.select(*bronze.columns), cfg)


def _check_defects(spark: SparkSession, seen: dict, cfg: MovieFlowConfig) -> None:
    """QA2/QA4: with a limit set, keep the run's counts, and stop beyond it.  A run without rows counts nothing."""
    if cfg.max_defect_share is None or not seen.get("n_rows"):
        return
    row = {name: int(seen[name]) for name in Q.METRICS}
    WR.append_rows(spark.createDataFrame([tuple(row.values())], ", ".join(f"{n} long" for n in row))
                   .withColumn("counted_at", F.current_timestamp()), cfg.metrics)
    share = 1 - row["clean"] / row["n_rows"]
    if share > cfg.max_defect_share:
        raise DefectLimit(f"{share:.1%} of {row['n_rows']} new rows are defective, allowed are {cfg.max_defect_share:.1%}: {row}")


def bronze_to_silver(spark: SparkSession, cfg: MovieFlowConfig) -> None:
    """New bronze rows -> lookups, clean silver rows, bronze statuses (SNK4 multi-sink).

    The statuses come last: until they are written the rows count as new, and
    a repeated run adds to lookups and silver only what is missing there.
    The job that writes silver counts the defects on its way (QA2, QA4); with
    ``max_defect_share`` a run beyond it stops here, its rows still new.
    """
    bronze = read_bronze(spark, cfg)
    new = bronze.where(F.col("status") == "new").dropDuplicates([VALUE_KEY])
    shredded = MD.transform_bronze(new)
    _merge_lookup(Q.lookup_genres(new.select(F.inline_outer(F.array(F.from_json("value", MD.GENRES_ONLY))))),
                  cfg.lookup("genres"), "genres")
    _merge_lookup(Q.lookup_languages_constant(shredded), cfg.lookup("original_languages"), "original_languages")
    silver_rows = MD.refactor_silver(shredded, dedupe=False)
    seen = Observation()
    clean, _, _ = Q.split_clean_quarantine(silver_rows.observe(seen, *Q.defect_metrics()))
    _append_silver(clean, cfg)
    _check_defects(spark, seen.get, cfg)
    _write_status(bronze, Q.classify(silver_rows, "new_status").select("value", "new_status"), "new", cfg)


def silver_update(spark: SparkSession, cfg: MovieFlowConfig) -> None:
    """Quarantined bronze rows -> repaired -> appended to silver -> marked ``loaded``.

    Only rows that are actually written are marked loaded (S27); a row that
    is still defective after repair (NULL budget) becomes ``unclassified``.
    """
    bronze = read_bronze(spark, cfg)
    quarantined = bronze.where(F.col("status") == Q.QUARANTINED).dropDuplicates([VALUE_KEY])
    repaired = Q.classify(Q.repair(MD.refactor_silver(MD.transform_bronze(quarantined), dedupe=False)), "new_status")
    _append_silver(repaired.where(F.col("new_status") == Q.CLEAN), cfg)
    _write_status(bronze, repaired.select("value", "new_status"), Q.QUARANTINED, cfg)


def run_movie_flow(spark: SparkSession, cfg: MovieFlowConfig) -> dict:
    """P1 -> P2 -> P3, each step only after the previous one committed."""
    raw_to_bronze(spark, cfg)
    bronze_to_silver(spark, cfg)
    silver_update(spark, cfg)
    b = read_bronze(spark, cfg)
    return {"bronze": b.count(), "silver": read_silver(spark, cfg).count(),
            "status": {r.status: r["count"] for r in b.groupBy("status").count().collect()}}


@dataclass
class WarehouseConfig:
    base: str
    tables: Sequence[INC.TableSpec] = field(default_factory=list)
    seed: dt.datetime = dt.datetime(2013, 1, 1, 11, 0, 0)
    catalog: str | None = None  # prefix of the catalog's table names; None: the integration copies are folders
    buckets: int = 64           # key buckets of a published table; fixed for its life

    def path(self, layer: str, name: str) -> str:
        return f"{self.base}/{layer}/{name}"


def read_ods(spark: SparkSession, spec: INC.TableSpec, cfg: WarehouseConfig) -> DataFrame | None:
    """The ODS table: of every key the latest of the loaded versions."""
    loaded = WR.read_or_none(spark, cfg.path("ods", spec.name))
    return None if loaded is None else M.latest_per_key(loaded, spec.keys, INC.as_timestamp(spec.watermark_col))


def load_table(spark: SparkSession, source: DataFrame, spec: INC.TableSpec, cfg: WarehouseConfig) -> INC.LoadRound:
    """P4 for one table: watermark round into ODS, then the integration copy (INC5).

    The batch is appended, then the watermark (INC4); after a failure between
    the two the batch is loaded again, which leaves the latest version of
    every key as it was.  Rows without a usable watermark are written to
    ``rejected`` for inspection (S34).
    """
    ctl_path = cfg.path("control", "watermarks")
    control = WR.read_or_none(spark, ctl_path)
    seeds = INC.control_table(spark, {s.name: cfg.seed for s in cfg.tables})
    control = seeds if control is None else seeds.unionByName(control)
    ods = cfg.path("ods", spec.name)
    round_ = INC.incremental_upsert(source.limit(0), source, control, spec)
    if cfg.catalog:
        # The table is the ODS and its integration copy in one: only the batch's buckets are read and written.
        PB.upsert_buckets(round_.batch, spec.keys, f"{cfg.catalog}_{spec.name}", cfg.path("integration", spec.name), cfg.buckets)
        WR.append_rows(INC.control_table(spark, {spec.name: round_.new}), ctl_path)
        WR.write_parquet_truncate(round_.rejected, cfg.path("rejected", spec.name))
        return round_
    WR.append_rows(round_.batch, ods)
    WR.append_rows(INC.control_table(spark, {spec.name: round_.new}), ctl_path)
    WR.write_parquet_truncate(round_.rejected, cfg.path("rejected", spec.name))
    WR.write_parquet_truncate(read_ods(spark, spec, cfg), cfg.path("integration", spec.name))
    return round_


def read_integration(spark: SparkSession, name: str, cfg: WarehouseConfig) -> DataFrame:
    if cfg.catalog:
        return spark.table(f"{cfg.catalog}_{name}").drop(PB.BUCKET)
    return spark.read.parquet(cfg.path("integration", name))


def build_olap(spark: SparkSession, cfg: WarehouseConfig, orders: str = "orders_table",
               lines: str = "order_lines_table") -> None:
    """P5 + INC7: fact and dimension from the integration layer, copied to the OLAP store."""
    o, ol = read_integration(spark, orders, cfg), read_integration(spark, lines, cfg)
    fact = W.build_fact_orders(o, ol, with_key=True)
    WR.write_parquet_truncate(fact, cfg.path("olap", "fact_orders"))
    fact = spark.read.parquet(cfg.path("olap", "fact_orders"))
    if cfg.catalog:
        # Changes already known are no changes: only customers with new ones are read and written.
        known = PB.table_or_none(spark, f"{cfg.catalog}_dim_customers")
        changes = fact.select("CustomerKey", "CreatedAt").distinct()
        if known is not None:
            held = known.select("CustomerKey", F.col("ValidFrom").alias("CreatedAt"))
            changes = _absent(changes, held, ["CustomerKey", "CreatedAt"])
        PB.update_dimension(changes, f"{cfg.catalog}_dim_customers", cfg.path("olap", "dim_customers"), cfg.buckets)
    else:
        WR.write_parquet_truncate(W.build_customer_dimension(fact), cfg.path("olap", "dim_customers"))


def read_dimension(spark: SparkSession, cfg: WarehouseConfig) -> DataFrame:
    if cfg.catalog:
        return spark.table(f"{cfg.catalog}_dim_customers").drop(PB.BUCKET)
    return spark.read.parquet(cfg.path("olap", "dim_customers"))


def run_warehouse_flow(spark: SparkSession, sources: dict[str, DataFrame], cfg: WarehouseConfig) -> None:
    """P4 over the configured table list (INC6), then P5."""
    for spec in cfg.tables:
        load_table(spark, sources[spec.name], spec, cfg)
    build_olap(spark, cfg)


def run_all(spark: SparkSession, movie: MovieFlowConfig, sources: dict[str, DataFrame],
            warehouse: WarehouseConfig) -> dict:
    """The movie flow, then the warehouse flow; an exception stops the sequence."""
    summary = run_movie_flow(spark, movie)
    run_warehouse_flow(spark, sources, warehouse)
    return summary


def people_files_to_csv(spark: SparkSession, paths: Sequence[str], out_path: str, rejected_path: str | None = None,
                        single_file: bool = False) -> int:
    """P7 end to end: whitespace text files -> cleaned, de-duplicated comma lines (SRC9, SET4, SNK10).

    Overwrites the output (the reference appends, so a re-run doubled it, S30).
    Lines with too few fields go to ``rejected_path``, if it is given.
    """
    from ledgerline.plans.file_jobs import clean_people, short_lines
    lines = S.read_lines_after_header(spark, paths)
    WR.write_lines(clean_people(lines, header=None), out_path, single_file=single_file)
    if rejected_path:
        WR.write_lines(short_lines(lines), rejected_path)
    return spark.read.text(out_path).count()


def split_json_file(spark: SparkSession, path: str, out_path: str, array_field: str = "movie",
                    id_field: str = "Id", n_splits: int = 8) -> dict:
    """P8 end to end: one JSON array document -> ``n_splits`` JSON outputs in id order (SNK11, S29)."""
    from ledgerline.plans.file_jobs import assign_splits
    items = spark.read.option("multiLine", True).json(path).select(F.explode(array_field).alias("item"))
    items = items.select(F.col(f"item.{id_field}").alias("_order"), "item")
    split = assign_splits(items, ["_order"], n_splits).select("split_id", "item.*")
    WR.write_split_json(split, out_path, array_field=array_field)
    back = spark.read.json(out_path)
    return {r.split_id: r["count"] for r in back.groupBy("split_id").count().collect()}
