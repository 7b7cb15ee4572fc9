"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from shelfpair.session import stored


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once a row, however often ``use`` refers to it."""
    return F.transform(F.array(value), use)[0]


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less the columns whose names an operator's own output needs (compared without case)."""
    taken = {name.lower() for name in names}
    return df.select(*[F.col(f"`{name}`") for name in df.columns if name.lower() not in taken])


def fresh(name: str, df: DataFrame) -> str:
    """``name``, with underscores added until no column of ``df`` bears it."""
    while name.lower() in {column.lower() for column in df.columns}:
        name += "_"
    return name


def set_aside(df: DataFrame, *names: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with columns of these names renamed, and what gives the same columns of a later table their names back."""
    taken = {name.lower() for name in names}
    before, renamed = df.columns, df
    new = {}
    for name in before:
        if name.lower() in taken:
            new[name] = fresh(f"own_{name}", renamed)
            renamed = renamed.withColumnRenamed(name, new[name])
    return renamed, lambda later: later.select(*[F.col(f"`{new.get(name, name)}`").alias(name) for name in before])


#: Rows of a batch that goes to a worker process, at most.
BATCH = 1_000


def small_batches(spark: SparkSession) -> None:
    """From now on rows go to the worker processes of this session in batches of at most BATCH rows.

    An executor holds a batch twice outside its heap (the vectors and what is sent), with room to grow, and the worker holds it
    once; that is for each of its tasks. A smaller number that the session has already stays.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH:  # none above 0: without bound
        spark.conf.set(key, str(BATCH))


#: Rows that a worker turns into Python objects at a time.
SLICE = 256


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in pieces of at most ``rows``: a worker then holds the Python objects of few texts, not of a batch."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        pa.default_memory_pool().release_unused()  # a worker outlives its task, so it would keep what its largest batch took


def plus(df: DataFrame, **added: DataType) -> StructType:
    """The schema of ``df`` with further columns."""
    return StructType([*df.schema.fields, *[StructField(name, kind) for name, kind in added.items()]])


def smallest_by_hash(rows: DataFrame, key: str, most: int, of: int) -> DataFrame:
    """The ``most`` rows with the smallest hashes of ``key``, stored: a bounded sample that does not depend on partitions.

    ``of``: about how many rows there are. Only a share of the hash range that should hold enough rows is sorted, so tasks
    hand on few rows however many tasks there are; the share grows until it holds enough.
    """
    place = F.shiftrightunsigned(F.xxhash64(key), 1)
    share = 4.0 * most / max(of, 1)
    while True:
        near = rows if share >= 1 else rows.where(place < F.lit(int(share * 2**63)))
        found = stored(near.orderBy(place, key).limit(most))
        if share >= 1 or found.count() == most:
            return found
        share *= 16


class Recent:
    """What a worker remembers between batches: the entries asked for most lately, at most twice ``most`` of them."""

    def __init__(self, most: int):
        self.most, self.now, self.before = most, {}, {}

    def turn(self) -> None:
        """Between batches: make room, if there are too many entries."""
        if len(self.now) > self.most:
            self.before, self.now = self.now, {}

    def known(self, keys: list) -> tuple[list, list[int]]:
        """Values of the keys, with None for unknown ones, and the places of those."""
        values = list(map(self.now.get, keys))
        unknown = []
        if None in values:
            for k in [k for k, value in enumerate(values) if value is None]:
                values[k] = value = self.before.get(keys[k])
                if value is None:
                    unknown.append(k)
                else:
                    self.now[keys[k]] = value
        return values, unknown
