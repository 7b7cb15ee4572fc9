"""Plain tables in folders, and a cache of answers keyed by a hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def write_table(df: DataFrame, path: str, partition_by: str | None = None, sort_by: str | None = None) -> None:
    """Write a table to the folder the caller names, which must not hold one yet."""
    rows = df.sortWithinPartitions(sort_by) if sort_by else df
    writer = rows.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table in a folder, with the columns of ``schema`` in its order."""
    return spark.read.schema(schema).parquet(path)


def cache_key(*parts: Column) -> Column:
    """Hash of the parts; a missing part differs from an empty one."""
    return F.sha2(F.to_json(F.array(*[p.cast("string") for p in parts])), 256)


def split_by_cache(requests: DataFrame, cache: DataFrame, key: str = "cache_key") -> tuple[DataFrame, DataFrame]:
    """(hits with the cached columns, misses). Keys are unique in the cache."""
    return requests.join(cache, key), requests.join(cache.select(key), key, "left_anti")


def add_to_cache(cache: DataFrame, fresh: DataFrame, key: str = "cache_key") -> DataFrame:
    """Fresh entries replace older ones of the same key."""
    return cache.join(fresh.select(key), key, "left_anti").unionByName(fresh)
