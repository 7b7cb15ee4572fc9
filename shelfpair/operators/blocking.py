"""Blocks (category and unit), eligibility, unmatched products and stale pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfpair import constants as K

BLOCK = ["main_category", "normalized_quantity_unit"]


def active(products: DataFrame) -> DataFrame:
    return products.filter("is_active")


def with_block(products: DataFrame) -> DataFrame:
    return products.filter(F.col(BLOCK[0]).isNotNull() & F.col(BLOCK[1]).isNotNull())


def with_defaults(products: DataFrame) -> DataFrame:
    """NULL brand and unit become empty, NULL amount and price become 0."""
    return products.fillna(
        {"brand": "", "normalized_quantity_unit": "", "normalized_quantity_amount": 0.0, "current_price": 0.0}
    )


def brand_title_order() -> list[Column]:
    return [F.col("brand").asc_nulls_last(), F.col("title").asc_nulls_last(), F.col("id").asc()]


def block_products(products: DataFrame, category: str, unit: str) -> DataFrame:
    """Active products of one block in brand, title order, with defaults for missing values."""
    rows = active(products).filter((F.col(BLOCK[0]) == category) & (F.col(BLOCK[1]) == unit))
    return with_defaults(rows.orderBy(*brand_title_order()))


def parse_block_argument(text: str) -> tuple[str, str]:
    """``category|unit`` -> (category, unit)."""
    parts = [part.strip() for part in text.split("|")]
    if len(parts) != 2:
        raise ValueError(f"expected 'category|unit', got: {text}")
    return parts[0], parts[1]


def block_inventory(products: DataFrame) -> DataFrame:
    """Products and distinct shops per block of active products."""
    return (
        with_block(active(products))
        .groupBy(F.col(BLOCK[0]).alias("category"), F.col(BLOCK[1]).alias("unit"))
        .agg(F.count("*").alias("product_count"), F.countDistinct("shop_type").alias("shop_count"))
    )


def restrict_to_ids(products: DataFrame, ids: DataFrame) -> DataFrame:
    return products.join(ids.select("id"), "id", "left_semi")


def inventory_of_ids(products: DataFrame, ids: DataFrame) -> DataFrame:
    """Block inventory that counts the given products only."""
    return block_inventory(restrict_to_ids(products, ids))


def eligible_blocks(products: DataFrame, min_products: int = 2, min_shops: int = 2) -> DataFrame:
    return block_inventory(products).filter(
        (F.col("product_count") >= min_products) & (F.col("shop_count") >= min_shops)
    )


def in_eligible_blocks(products: DataFrame, min_products: int = 2, min_shops: int = 2) -> DataFrame:
    """Active products of blocks that can hold a cross-shop match."""
    keys = eligible_blocks(products, min_products, min_shops).select(
        F.col("category").alias(BLOCK[0]), F.col("unit").alias(BLOCK[1])
    )
    return with_block(active(products)).join(keys, BLOCK, "left_semi")


def evaluation_blocks(products: DataFrame) -> DataFrame:
    """Blocks for model evaluation: several shops and at least five products, inactive ones included."""
    return (
        with_block(products)
        .groupBy(F.col(BLOCK[0]).alias("category"), F.col(BLOCK[1]).alias("unit"))
        .agg(F.count("*").alias("product_count"), F.countDistinct("shop_type").alias("shop_count"))
        .filter((F.col("shop_count") > 1) & (F.col("product_count") >= K.EVALUATION_MIN_PRODUCTS))
    )


def paired_ids(pairs: DataFrame) -> DataFrame:
    """Every product id that is an end of a pair; one hash anti join instead of an OR condition."""
    return pairs.select(F.explode(F.array("source_product_id", "target_product_id")).alias("id"))


def unmatched_ids(products: DataFrame, pairs: DataFrame) -> DataFrame:
    return with_block(active(products)).select("id").join(paired_ids(pairs), "id", "left_anti")


def live_pairs(pairs: DataFrame, products: DataFrame) -> DataFrame:
    """Pairs whose two ends are active products."""
    ids = active(products).select("id")
    return pairs.join(ids, pairs["source_product_id"] == ids["id"], "left_semi").join(
        ids, pairs["target_product_id"] == ids["id"], "left_semi"
    )


def pair_counts_by_block(products: DataFrame) -> DataFrame:
    """Comparisons per block by arithmetic: all pairs and cross-shop pairs. No pair is built."""
    shops = with_block(active(products)).groupBy(*BLOCK, "shop_type").agg(F.count("*").alias("n"))
    total = F.sum("n")
    return shops.groupBy(F.col(BLOCK[0]).alias("category"), F.col(BLOCK[1]).alias("unit")).agg(
        total.alias("product_count"),
        (total * (total - 1) / 2).cast("bigint").alias("pairs"),
        ((total * total - F.sum(F.col("n") * F.col("n"))) / 2).cast("bigint").alias("cross_shop_pairs"),
    )


def blocking_efficiency(products: DataFrame) -> DataFrame:
    """One row: pairs without blocking, pairs inside blocks and their ratio."""
    blocks = pair_counts_by_block(products)
    total = F.sum("product_count")
    return blocks.agg(
        (total * (total - 1) / 2).cast("bigint").alias("all_pairs"),
        F.sum("pairs").alias("block_pairs"),
        F.sum("cross_shop_pairs").alias("cross_shop_pairs"),
    ).withColumn("ratio", F.round(F.try_divide(F.col("all_pairs").cast("double"), F.col("block_pairs")), 6))
