"""Pairs of rows that share a key, with large key groups spread over a grid of tasks.

A group of n rows is cut into ``ceil(n / chunk_rows)`` chunks by a hash of the row id, and each pair
of chunks becomes its own join key. No task sees more than two chunks of a group, every unordered
pair meets exactly once, and groups below ``chunk_rows`` are joined without any replication.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfpair.session import shuffle_partitions

CHUNK_ROWS = 2048

# where(a, b): SQL condition on two rows; a and b turn a column name into that of the first or second row
PairCondition = Callable[[Callable[[str], str], Callable[[str], str]], str]


def _chunk_counts(df: DataFrame, keys: list[str], name: str, chunk_rows: int) -> DataFrame:
    """Number of chunks of each key with more than one; a partial count runs before the shuffle."""
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("_n"))
        .filter(f"_n > {chunk_rows}")
        .selectExpr(*keys, f"CAST(ceil(_n / {chunk_rows}) AS INT) AS {name}")
    )


def with_chunks(df: DataFrame, keys: list[str], id_col: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Add ``_chunks`` (number of chunks of the row's key) and ``_chunk`` (the row's own)."""
    large = _chunk_counts(df, keys, "_large", chunk_rows)
    return (
        df.join(large, keys, "left")
        .selectExpr(*df.columns, "coalesce(_large, 1) AS _chunks")
        .selectExpr("*", f"CAST(pmod(xxhash64({id_col}), _chunks) AS INT) AS _chunk")
    )


def _first(name: str) -> str:
    return f"{name}_1"


def _second(name: str) -> str:
    return f"{name}_2"


def _place(df: DataFrame, keys: list[str], i: str, j: str, columns: list[str], named: Callable[[str], str]) -> DataFrame:
    """Send rows to cell (i, j) of their key; one of the two may be a generator."""
    n = shuffle_partitions(df.sparkSession)
    renamed = [f"{c} AS {named(c)}" for c in columns]
    return df.selectExpr(*keys, f"{i} AS _i", f"{j} AS _j", *renamed).repartition(n, *keys, "_i", "_j")


def _lower_id_first(pairs: DataFrame, id_col: str, columns: list[str], keys: list[str]) -> DataFrame:
    ordered = f"{id_col}_1 < {id_col}_2"
    first = [f"IF({ordered}, {c}_1, {c}_2) AS {c}_1" for c in columns]
    second = [f"IF({ordered}, {c}_2, {c}_1) AS {c}_2" for c in columns]
    return pairs.selectExpr(*keys, *first, *second)


def pair_within(
    df: DataFrame,
    keys: list[str],
    id_col: str,
    where: PairCondition,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Unordered pairs of rows with equal (non-null) keys for which ``where`` holds.

    ``where`` must not depend on which row is which. Result: the keys and each other column as
    ``name_1`` and ``name_2``, lower id first.
    """
    columns = [c for c in df.columns if c not in keys]
    chunked = with_chunks(df, keys, id_col, chunk_rows)
    left = _place(chunked, keys, "_chunk", "explode(sequence(_chunk, _chunks - 1))", columns, _first)
    right = _place(chunked, keys, "explode(sequence(0, _chunk))", "_chunk", columns, _second)
    once = f"(_i < _j OR {id_col}_1 < {id_col}_2)"
    met = left.join(right, [*keys, "_i", "_j"]).filter(f"{once} AND {where(_first, _second)}")
    return _lower_id_first(met, id_col, columns, keys)


def pair_across(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    id_col: str,
    where: PairCondition,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Pairs of a left and a right row with equal keys for which ``where`` holds, lower id first.

    Both sides have the same columns. A pair must qualify one way round only: the sides are disjoint,
    as for two different brands, or ``where`` says which of two rows is the left one.
    """
    columns = [c for c in left.columns if c not in keys]
    rows = _chunk_counts(left, keys, "_rows", chunk_rows)
    cols = _chunk_counts(right, keys, "_cols", chunk_rows)
    grid = rows.join(cols, keys, "full")
    own = lambda n: f"CAST(pmod(xxhash64({id_col}), coalesce({n}, 1)) AS INT)"
    every = lambda n: f"explode(sequence(0, coalesce({n}, 1) - 1))"
    lhs = _place(left.join(grid, keys, "left"), keys, own("_rows"), every("_cols"), columns, _first)
    rhs = _place(right.join(grid, keys, "left"), keys, every("_rows"), own("_cols"), columns, _second)
    met = lhs.join(rhs, [*keys, "_i", "_j"]).filter(where(_first, _second))
    return _lower_id_first(met, id_col, columns, keys)
