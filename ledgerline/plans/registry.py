"""Registry of named queries: key -> plan function over :class:`Tables`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.plans import checks, documents, file_jobs, loads, medallion, reports, sql_surface, warehouse_load
from ledgerline.sources.tables import Tables

PlanFn = Callable[[Tables], DataFrame]

PLANS: dict[str, PlanFn] = {
    "item_quantity_in_year": reports.item_quantity_in_year,
    "contact_or_join": reports.contact_or_join,
    "composite_key_join": reports.composite_key_join,
    "lapsed_customers": reports.lapsed_customers,
    "long_name_union": reports.long_name_union,
    "items_sold_outside": reports.items_sold_outside,
    "avg_processing_days": reports.avg_processing_days,
    "avg_processing_days_by_month": reports.avg_processing_days_by_month,
    "purchased_more_than_sold": reports.purchased_more_than_sold,
    "small_buyers_of_item": reports.small_buyers_of_item,
    "changed_after": reports.changed_after,
    "order_detail_for_day": reports.order_detail_for_day,
    "purchased_sold_by_group": reports.purchased_sold_by_group,
    "top_item_per_region": reports.top_item_per_region,
    "repeated_event_in_json": reports.repeated_event_in_json,
    "json_value_filter": reports.json_value_filter,
    "json_value_group": reports.json_value_group,
    "pivot_group_by_year": reports.pivot_group_by_year,
    "pivot_year_by_group": reports.pivot_year_by_group,
    "invoice_with_total": reports.invoice_with_total,
    "guarded_daily_load": loads.guarded_daily_load,
    "typed_migration": loads.typed_migration,
    "rolling_reload": loads.rolling_reload,
    "json_shred_load": loads.json_shred_load,
    "json_shred_purchase_orders": loads.json_shred_purchase_orders,
    "json_shred_quarantine": loads.json_shred_quarantine,
    "pivot_to_json": documents.pivot_to_json,
    "pivot_to_xml": documents.pivot_to_xml,
    "nested_invoice_json": documents.nested_invoice_json,
    "bronze_ingest": medallion.bronze,
    "silver_clean": medallion.silver_clean,
    "silver_quarantine": medallion.silver_quarantine,
    "silver_repaired": medallion.silver_repaired,
    "status_write_back": medallion.status_write_back,
    "status_merge": medallion.status_merge,
    "defect_counts": medallion.defect_counts,
    "defect_counts_on_the_way": medallion.defect_counts_on_the_way,
    "genre_lookup": medallion.genre_lookup,
    "genre_lookup_merge": medallion.genre_lookup_merge,
    "genre_texts": medallion.genre_texts,
    "language_lookup": medallion.language_lookup,
    "incremental_upsert": warehouse_load.incremental_upsert,
    "incremental_upsert_lines": warehouse_load.incremental_upsert_lines,
    "incremental_upsert_buckets": warehouse_load.incremental_upsert_buckets,
    "compacted_orders": warehouse_load.compacted_orders,
    "null_watermark_report": warehouse_load.null_watermark_report,
    "fact_orders": warehouse_load.fact_orders,
    "dim_customers": warehouse_load.dim_customers,
    "dim_customers_incremental": warehouse_load.dim_customers_incremental,
    "scan_filter_project": checks.scan_filter_project,
    "dedupe_first_by_key": checks.dedupe_first_by_key,
    "constraint_violations": checks.constraint_violations,
    "sensor_tumbling_avg": checks.sensor_tumbling_avg,
    "renamed_columns": checks.renamed_columns,
    "trimmed_columns": checks.trimmed_columns,
    "row_hashes": checks.row_hashes,
    "never_pending": checks.never_pending,
    "line_kinds": checks.line_kinds,
    "json_objects": checks.json_objects,
    "typed_target": checks.typed_target,
    "days_with_orders": checks.days_with_orders,
    "sql_order_totals": sql_surface.order_totals,
    "sql_orders_between": sql_surface.orders_between,
    "sql_sales_by_group": sql_surface.sales_by_group,
    "sql_sales_by_year": sql_surface.sales_by_year,
    "ledger_ids": checks.ledger_ids,
    "late_readings": checks.late_readings,
    "document_items": checks.document_items,
    "top_orders_in_order": checks.top_orders_in_order,
    "people_clean": file_jobs.people_clean,
    "json_split": file_jobs.json_split,
}


def run(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    return PLANS[key](Tables(spark, sf_dir))


def as_entry(key: str) -> Callable[[SparkSession, str], DataFrame]:
    def call(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(spark, sf_dir, key)
    call.__name__ = key
    return call
