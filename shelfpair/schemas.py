"""Explicit table schemas and data-quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRODUCTS = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("shop_type", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("main_category", T.StringType()),
        T.StructField("normalized_quantity_amount", T.DoubleType()),
        T.StructField("normalized_quantity_unit", T.StringType()),
        T.StructField("current_price", T.DoubleType()),
        T.StructField("is_active", T.BooleanType()),
    ]
)

PAIRS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("source_product_id", T.LongType(), False),
        T.StructField("target_product_id", T.LongType(), False),
        T.StructField("equivalence_type", T.StringType()),
        T.StructField("similarity_score", T.DecimalType(4, 3)),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

LABELS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("essence", T.StringType(), False),
        T.StructField("confidence", T.DecimalType(3, 2)),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("model_version", T.StringType()),
        T.StructField("processing_time_ms", T.IntegerType()),
        T.StructField("notes", T.StringType()),
    ]
)


def label_violations(labels: DataFrame, products: DataFrame) -> DataFrame:
    """Rows (check_name, violations) for the constraints of the label table."""
    per_row = labels.agg(
        F.count_if((F.col("confidence") < 0) | (F.col("confidence") > 1)).alias("confidence_range"),
        F.count_if(F.col("essence").isNull()).alias("essence_missing"),
        F.count_if(F.length("essence") > 100).alias("essence_too_long"),
        F.count_if(F.length("model_version") > 50).alias("model_version_too_long"),
    ).select(
        F.explode(
            F.create_map(
                F.lit("confidence_range"), F.col("confidence_range"),
                F.lit("essence_missing"), F.col("essence_missing"),
                F.lit("essence_too_long"), F.col("essence_too_long"),
                F.lit("model_version_too_long"), F.col("model_version_too_long"),
            )
        ).alias("check_name", "violations")
    )
    repeated = (
        labels.filter(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .count()
        .agg(F.count_if(F.col("count") > 1).alias("violations"))
        .select(F.lit("product_repeated").alias("check_name"), "violations")
    )
    unknown = (
        labels.filter(F.col("product_id").isNotNull())
        .join(products.select(F.col("id").alias("product_id")), "product_id", "left_anti")
        .agg(F.count("*").alias("violations"))
        .select(F.lit("product_unknown").alias("check_name"), "violations")
    )
    return per_row.unionByName(repeated).unionByName(unknown)


def repeated_pairs(pairs: DataFrame) -> DataFrame:
    """Unordered pairs stored more than once."""
    return (
        pairs.groupBy(
            F.least("source_product_id", "target_product_id").alias("lo"),
            F.greatest("source_product_id", "target_product_id").alias("hi"),
        )
        .agg(F.count("*").alias("copies"))
        .filter(F.col("copies") > 1)
    )
