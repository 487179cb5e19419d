"""Parquet table scans (S6): pruned reads of the landed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


_SCHEMAS: dict[str, StructType] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Scan one landed table; with ``columns`` only those reach the ReadSchema.

    The table's schema is resolved from its footer once per path and then
    given to the reader, so later plans skip schema inference.
    """
    path = table_path(sf_dir, name)
    schema = _SCHEMAS.get(path)
    if schema is None:
        schema = _SCHEMAS[path] = spark.read.parquet(path).schema
    df = spark.read.schema(schema).parquet(path)
    return df.select(*columns) if columns else df
