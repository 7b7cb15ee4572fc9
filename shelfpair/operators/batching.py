"""Batches of products for a language model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfpair import constants as K
from shelfpair.functions.text import brand_key
from shelfpair.operators.blocking import BLOCK, brand_title_order
from shelfpair.operators.ranking import row_numbers, running_total, top_per_group


def interleave(products: DataFrame) -> DataFrame:
    """Add ``position``: brand by brand, and inside a brand one product of each shop in turn.

    The place of a row follows from counts. It comes after all smaller brands of its block, after
    ``min(n, i)`` products of each shop with n products (i = its own place in its shop), and after
    the i-th product of the shops that come first. Only the place in the shop needs the rows in order.
    """
    shop_group = [*BLOCK, "_brand", "shop_type"]
    rows = products.withColumn("_brand", brand_key(F.col("brand")))
    first = F.min(F.struct(F.col("brand").isNull(), F.col("brand"), F.col("title").isNull(), "title", "id"))
    # one row per brand and shop of a block
    per_shop = rows.groupBy(*shop_group).agg(F.count("*").alias("n"), first.alias("first"))
    per_brand = per_shop.groupBy(*BLOCK, "_brand").agg(
        # one entry per shop
        F.array_sort(F.collect_list(F.struct("first", "shop_type", "n"))).alias("_shops"),
        F.sum("n").alias("_n"),
    )
    per_brand = running_total(per_brand, BLOCK, [F.col("_brand")], F.col("_n"), "_before")
    placed = row_numbers(rows, shop_group, brand_title_order(), "_i")

    def rows_ahead(total: Column, shop: Column, rank: Column) -> Column:
        tie = (rank < F.col("_rank")) & (shop["n"] > F.col("_i"))
        return total + F.least(shop["n"], F.col("_i")) + F.when(tie, F.lit(1)).otherwise(F.lit(0))

    ranked = F.transform(
        F.col("_shops"), lambda s, k: F.struct(s["n"].alias("n"), k.alias("k"))
    )
    return (
        placed.join(per_brand, [*BLOCK, "_brand"])
        .withColumn(
            "_rank", F.array_position(F.transform("_shops", lambda s: s["shop_type"]), F.col("shop_type")) - 1
        )
        .withColumn(
            "position",
            F.col("_before")
            + F.aggregate(ranked, F.lit(0).cast("bigint"), lambda t, s: rows_ahead(t, s, s["k"])),
        )
        .select(*products.columns, "position")
    )


def pair_batches(products: DataFrame, batch_size: int = K.PAIR_BATCH) -> DataFrame:
    """Add ``batch_id`` per block over the interleaved order."""
    return interleave(products).withColumn(
        "batch_id", F.floor(F.col("position") / batch_size).cast("bigint")
    )


def batches_with_ids(batched: DataFrame, ids: DataFrame) -> DataFrame:
    """Whole batches that hold at least one of the given products."""
    keys = [*BLOCK, "batch_id"]
    hit = batched.join(ids.select("id"), "id", "left_semi").select(*keys).distinct()
    return batched.join(hit, keys, "left_semi")


def id_batches(products: DataFrame, batch_size: int = K.LABEL_BATCH, group: str = "main_category") -> DataFrame:
    """Add ``position`` and ``batch_id`` per group in id order."""
    placed = row_numbers(products, [group], [F.col("id")], "position")
    return placed.withColumn("batch_id", F.floor(F.col("position") / batch_size).cast("bigint"))


def first_batches(products: DataFrame, batch_size: int = K.LABEL_BATCH, group: str = "main_category") -> DataFrame:
    """Batch 0 of each group as in :func:`id_batches`, by a top-n of each group: the other rows get no number."""
    first = top_per_group(products, [group], [F.col("id")], batch_size, "position")
    return first.withColumn("position", F.col("position").cast("bigint") - 1).withColumn("batch_id", F.lit(0).cast("bigint"))
