"""Tables in: Parquet, JDBC, and required-column checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from shelfpair import constants as K


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    bounds: tuple[int, int],
    partitions: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Read a database table in ``partitions`` ranges of a numeric column; filters are pushed down."""
    return spark.read.jdbc(
        url,
        table,
        column=partition_column,
        lowerBound=bounds[0],
        upperBound=bounds[1],
        numPartitions=partitions,
        properties=properties or {},
    )


def require_columns(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    missing = [c for c in (columns or K.REQUIRED_COLUMNS) if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df
