"""Running totals and row numbers inside groups of any size.

A plain window would sort a whole group in one task. Here rows are range-partitioned by (group, order), each
partition is numbered by itself, and the totals of earlier partitions are added, so a group may have any size. Row numbers
are made from the keys alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfpair.session import stored


def running_total(df: DataFrame, group: list[str], order: list[Column], value: Column, out: str) -> DataFrame:
    """Sum of ``value`` over the earlier rows of the group. ``order`` must end in a unique key."""
    before = (Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    # The partition number is data from here on, so it has to be stored, not computed twice.
    placed = stored(
        df.repartitionByRange(*[F.col(c).asc() for c in group], *order)
        .withColumn("_part", F.spark_partition_id())
    )
    inside = Window.partitionBy("_part", *group).orderBy(*order).rowsBetween(*before)
    totals = placed.groupBy(*group, "_part").agg(F.sum(value.cast("bigint")).alias("_sum"))
    if group:
        earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(*before)
        same = [F.col(f"o.{c}").eqNullSafe(F.col(f"r.{c}")) for c in group]
    else:
        # one row per partition: at most spark.sql.shuffle.partitions rows
        earlier = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(*before)
        same = []
    offsets = totals.withColumn("_base", F.coalesce(F.sum("_sum").over(earlier), zero)).drop("_sum")
    numbered = placed.withColumn("_own", F.coalesce(F.sum(value.cast("bigint")).over(inside), zero))
    condition = F.col("o._part") == F.col("r._part")
    for c in same:
        condition = condition & c
    return (
        numbered.alias("r")
        .join(offsets.alias("o"), condition)
        .select(*[F.col(f"r.{c}") for c in df.columns], (F.col("r._own") + F.col("o._base")).alias(out))
    )


def row_numbers(df: DataFrame, group: list[str], order: list[Column], out: str, key: tuple[str, ...] = ("id",)) -> DataFrame:
    """Zero-based position of each row in its group. ``order`` must end in a unique key, ``key`` names it, without nulls.

    Only keys, groups and what they are ordered by are sorted, and only keys, groups and places are stored; the rows
    themselves meet their numbers by ``key``. A place is that of the sorted partition, plus the rows of all earlier ones,
    less the place of the first row of the group.
    """
    names = list(dict.fromkeys([*key, *group]))
    by = [*[F.col(c).asc() for c in group], *order]
    placed = stored(
        df.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .select(*names, F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_row"))
    )
    # one row a partition
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    bases = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0).cast("bigint")).alias("_base"))
    numbered = placed.join(bases, "_part").withColumn("_place", F.col("_base") + F.col("_row"))
    if group:
        firsts = numbered.groupBy(*group).agg(F.min("_place").alias("_first"))
        same = [F.col(f"n.{c}").eqNullSafe(F.col(f"f.{c}")) for c in group]
        condition = same[0]
        for other in same[1:]:
            condition = condition & other
        numbered = numbered.alias("n").join(firsts.alias("f"), condition).select(*[F.col(f"n.{c}").alias(c) for c in key], (F.col("_place") - F.col("_first")).alias(out))
    else:
        numbered = numbered.select(*key, F.col("_place").alias(out))
    return df.join(numbered, list(key)).select(*df.columns, out)


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row per key by ``order``, as a partial aggregate, so copies shrink before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    )
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)


def top_per_group(df: DataFrame, group: list[str], order: list[Column], n: int, rank: str = "_rank") -> DataFrame:
    """First ``n`` rows per group; Spark limits every partition before the shuffle."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)
