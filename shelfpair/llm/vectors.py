"""Near-duplicate vectors by int8 tile products with rigorous error bounds."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfpair.llm.components import components
from shelfpair.session import stored

#: Dimensions whose int8 products sum exactly in float32: 1024 * 127 ** 2 < 2 ** 24.
EXACT_DIMS = 1024
#: Rows of a tile whose products are in memory together.
STRIP = 512
#: Covers the rounding of the bounds themselves, which are computed in double precision.
SLACK = 1e-9


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Int8 codes of unit vectors, their scales, the lengths of the coded vectors, and the lengths of what coding lost."""
    scale = np.abs(unit).max(axis=1) / 127.0
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    coded = codes * scale[:, None]
    return codes, scale, np.linalg.norm(coded, axis=1), np.linalg.norm(unit - coded, axis=1)


def linked_pairs(left: np.ndarray, right: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of all pairs of ``left`` and ``right`` with a cosine of at least ``threshold``.

    With u = c + e (coded part and loss) and unit lengths, |u.v - c.d| = |e.v + c.f| <= |e| + |c||f|. Only pairs whose coded
    product plus this bound reaches the threshold are computed again in double precision; no other pair can reach it.
    """
    lengths = [np.linalg.norm(side, axis=1) for side in (left, right)]
    (a, sa, ca, ea), (b, sb, _, eb) = (quantised(side / n[:, None]) for side, n in zip((left, right), lengths))
    found = []
    for at in range(0, len(a), STRIP):  # products of a strip at a time, so that a tile may be large
        rows = slice(at, at + STRIP)
        coded = np.zeros((len(a[rows]), len(b)))
        for k in range(0, a.shape[1], EXACT_DIMS):
            coded += a[rows, k : k + EXACT_DIMS].astype(np.float32) @ b[:, k : k + EXACT_DIMS].astype(np.float32).T
        coded *= sa[rows, None]
        coded *= sb[None, :]
        coded += ca[rows, None] * eb[None, :] + (ea[rows, None] + SLACK)
        near = np.nonzero(coded >= threshold)
        found.append((near[0] + at, near[1]))
    i, j = (np.concatenate([np.empty(0, np.int64), *part]) for part in zip(*found)) if found else (np.empty(0, np.int64),) * 2
    keep = np.zeros(len(i), dtype=bool)
    for start in range(0, len(i), 1 << 16):
        part = slice(start, start + (1 << 16))
        dots = np.einsum("nd,nd->n", left[i[part]], right[j[part]])
        keep[part] = dots / (lengths[0][i[part]] * lengths[1][j[part]]) >= threshold
    return i[keep], j[keep]


def _tile(key: tuple, rows: pa.Table, threshold: float) -> pa.Table:
    """Links within one pair of tiles: for each linked class its number of linked vectors, and its smallest class here."""
    first, second = key[2].as_py(), key[3].as_py()
    rows = rows.combine_chunks()
    if rows.num_rows == 0:
        return SCHEMA.empty_table()
    tile = rows["tile"].to_numpy()
    node, copies = rows["node"].to_numpy(), rows["copies"].to_numpy()
    vectors = _matrix(rows["embedding"].chunk(0), key[1].as_py())
    left = np.flatnonzero(tile == first)
    right = np.flatnonzero(tile == second)
    i, j = linked_pairs(vectors[left], vectors[right], threshold) if len(left) and len(right) else (left[:0], left[:0])
    i, j = left[i], right[j]
    if first == second:
        i, j = i[i < j], j[i < j]
    links = np.bincount(i, copies[j], len(node)).astype(np.int64) + np.bincount(j, copies[i], len(node)).astype(np.int64)
    low = node.copy()
    while True:  # the smallest node of each group of links in this pair of tiles
        before = low.copy()
        np.minimum.at(low, i, low[j])
        np.minimum.at(low, j, low[i])
        if (before == low).all():
            break
    hit = links > 0
    return pa.table([node[hit], links[hit], low[hit]], schema=SCHEMA)


SCHEMA = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("low", pa.int64())])


def usable(label: Column, vector: Column) -> Column:
    """True for a labelled vector with finite components that are not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(label.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_vectors(vectors: DataFrame, threshold: float = 0.98, tile_rows: int = 4096) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding: array<float>, label).

    Vectors of one label and length link if their cosine in double precision is at least ``threshold``. n_links counts the
    other rows linked directly, component_id is the smallest vec_id reachable, kept tells whether that is the row's own.
    Null, empty, zero or non-finite vectors and rows without label or vec_id link with nothing. Repeated rows count as
    further vectors. vec_id is meant to be unique; links of different vectors under one id are counted together.
    Further columns are ignored.

    Equal vectors are one node with a number of copies, so crowds of copies meet nothing but once; two 64-bit hashes stand
    for a vector wherever rows and nodes meet, so vectors themselves move to their node and to their tiles only. The nodes
    of a label fall into tiles of about ``tile_rows`` rows by hash; each pair of tiles is one group of bounded size, so a hot
    label spreads over many tasks. A pair of tiles returns one row a linked node: a count, and its smallest partner for
    the components.
    """
    mark = [F.xxhash64("label", "embedding").alias("mark"), F.xxhash64(F.reverse("embedding"), "label").alias("mark_2")]
    rows = vectors.select(F.col("vec_id").cast("long"), "label", "embedding")
    good = rows.where(usable(F.col("label"), F.col("embedding")) & F.col("vec_id").isNotNull()).select("vec_id", "label", "embedding", *mark)
    nodes = good.groupBy("label", "mark", "mark_2").agg(F.first("embedding").alias("embedding"), F.min("vec_id").alias("node"), F.count("*").alias("copies"))
    sized = stored(nodes.withColumn("dims", F.size("embedding")))
    tiles = stored(sized.groupBy("label", "dims").agg(F.ceil(F.count("*") / tile_rows).alias("tiles")))
    dealt = sized.join(tiles, ["label", "dims"]).withColumn("tile", F.pmod(F.xxhash64("mark", "mark_2"), F.col("tiles")))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))).select(
        "label", "dims", F.least("tile", "other").alias("first"), F.greatest("tile", "other").alias("second"), "tile", "node", "copies", "embedding"
    )

    def run(key, table):
        return _tile(key, table, threshold)

    found = stored(met.groupBy("label", "dims", "first", "second").applyInArrow(run, "node long, links long, low long"))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("node").alias("a"), F.col("low").alias("b")))
    slim = sized.select("mark", "mark_2", "node", "copies")
    known = stored(slim.join(counts, "node", "left").join(groups, "node", "left"))
    named = good.select("vec_id", "mark", "mark_2").join(known, ["mark", "mark_2"])
    component = F.coalesce("component", "node")
    linked = named.select(
        "vec_id",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("n_links"),
        component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )
    alone = rows.where(~(usable(F.col("label"), F.col("embedding")) & F.col("vec_id").isNotNull()))
    return linked.unionByName(alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept")))
