"""Table access over a directory of Parquet files.

Tables are read lazily with ``spark.read.parquet``; Catalyst prunes columns
and pushes filters into the scan, so callers never project by hand.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


class Tables:
    """Named Parquet tables under one directory (``<dir>/<name>.parquet``)."""

    def __init__(self, spark: SparkSession, base: str, schemas: dict | None = None):
        self.spark = spark
        self.base = base.rstrip("/")
        self._schemas = schemas or {}
        self._cache: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.base}/{name}.parquet"

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            reader = self.spark.read
            if name in self._schemas:
                # A pinned schema skips footer inference across many files.
                reader = reader.schema(self._schemas[name])
            self._cache[name] = reader.parquet(self.path(name))
        return self._cache[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLE_NAMES:
            return self.table(name)
        raise AttributeError(name)

    def register_views(self) -> None:
        """Expose every table as a temp view for ``spark.sql`` callers."""
        for name in TABLE_NAMES:
            self.table(name).createOrReplaceTempView(name)

    @cached_property
    def names(self) -> tuple[str, ...]:
        return TABLE_NAMES
