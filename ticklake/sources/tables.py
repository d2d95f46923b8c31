"""Reading the given Parquet tables.

``read_table`` only ever selects the columns it is asked for, so the scan's
``ReadSchema`` is pruned even before Catalyst's own column pruning runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


_SCHEMAS: dict[str, object] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Parquet scan of one table.  The footer schema is discovered once per
    path and passed explicitly afterwards (no repeated inference)."""
    path = table_path(sf_dir, name)
    schema = _SCHEMAS.get(path)
    if schema is None:
        df = spark.read.parquet(path)
        _SCHEMAS[path] = df.schema
    else:
        df = spark.read.schema(schema).parquet(path)
    return df.select(*columns) if columns else df
