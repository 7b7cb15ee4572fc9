"""Incremental runs over arriving product files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from shelfpair import constants as K
from shelfpair.functions.inference import TextFunction
from shelfpair.operators.blocking import BLOCK
from shelfpair.plans.runs import incremental_run
from shelfpair.schemas import PAIRS, PRODUCTS
from shelfpair.session import stored

PART, PARTS = "part", 64


def block_part(category: Column, unit: Column, parts: int) -> Column:
    """Part of a table that holds a block."""
    return F.pmod(F.xxhash64(category, unit), F.lit(parts)).cast("int")


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows of a table in parts, with their part."""
    rows = spark.read.schema(StructType([*schema.fields, StructField(PART, IntegerType())])).parquet(path)
    return rows.filter(F.col(_key(schema)).isNotNull())


def _key(schema: StructType) -> str:
    return "id" if schema == PRODUCTS else "source_product_id"


def write_parts(rows: DataFrame, path: str, parts: list[int]) -> None:
    """Replace these parts of a table; the others stay. A row without key keeps a part that has become empty in place."""
    marks = rows.sparkSession.createDataFrame([(p,) for p in parts], f"{PART} int")
    every = rows.unionByName(marks, allowMissingColumns=True).hint("rebalance", PART)
    every.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(path)


def load_pairs(pairs: DataFrame, table_folder: str, parts: int = PARTS) -> None:
    """Start with these pairs, spread over the parts. They move to the parts of their products once those arrive."""
    placed = F.pmod(F.xxhash64("source_product_id"), F.lit(parts)).cast("int")
    write_parts(pairs.select(*PAIRS.fieldNames()).withColumn(PART, placed), f"{table_folder}/pairs", list(range(parts)))


def upsert_products(known: DataFrame, arrived: DataFrame) -> DataFrame:
    """Known products with the arrived ones added or replaced by id."""
    return known.join(arrived.select("id"), "id", "left_anti").unionByName(arrived.select(*known.columns))


def start_incremental(
    spark: SparkSession,
    arriving: str,
    table_folder: str,
    checkpoint: str,
    answer: TextFunction,
    batch_size: int = K.PAIR_BATCH_RUN,
    parts_of_tables: int = PARTS,
) -> StreamingQuery:
    """Process all product files that have arrived, then stop.

    ``parts_of_tables``: how many parts the tables have; it must stay the same for a table, so choose it by the size the
    catalogue will have.

    Each micro-batch updates the product table and runs the incremental matcher. Both tables lie in parts by block, and
    only parts with something to do are read whole and written: those of the arrived products, of their earlier rows, and
    of pairs that name them. Of the rest, ids alone are read. Repeating a micro-batch gives the same tables, so a retry
    after a failure is safe.
    """
    products_path, pairs_path = f"{table_folder}/products", f"{table_folder}/pairs"
    for path, schema in ((products_path, PRODUCTS), (pairs_path, PAIRS)):
        empty = spark.createDataFrame([], StructType([*schema.fields, StructField(PART, IntegerType())]))
        empty.write.mode("ignore").partitionBy(PART).parquet(path)

    def process(arrived: DataFrame, _batch_id: int) -> None:
        session = arrived.sparkSession
        latest = arrived.groupBy("id").agg(F.max_by(F.struct(*arrived.columns), F.struct(*arrived.columns)).alias("r"))
        part = block_part(*[F.col(name) for name in BLOCK], parts_of_tables).alias(PART)
        new = stored(latest.select("r.*").select("*", part))
        ids = new.select("id")
        products, pairs = read_table(session, products_path, PRODUCTS), read_table(session, pairs_path, PAIRS)
        ends = pairs.select(PART, F.explode(F.array("source_product_id", "target_product_id")).alias("id"))
        to_do = new.select(PART).unionByName(products.join(ids, "id", "left_semi").select(PART))
        to_do = to_do.unionByName(ends.join(ids, "id", "left_semi").select(PART)).distinct()
        parts = sorted(r[0] for r in to_do.collect())  # at most parts_of_tables numbers
        if not parts:
            return

        here = stored(upsert_products(products.filter(F.col(PART).isin(parts)), new))
        stored_pairs = stored(pairs.filter(F.col(PART).isin(parts)).drop(PART))
        write_parts(here, products_path, parts)
        everywhere = read_table(session, products_path, PRODUCTS)
        merged = incremental_run(here.drop(PART), stored_pairs, answer, batch_size, catalogue=everywhere).merged
        rows = merged.withColumn("id", F.lit(None).cast("bigint")).select(*PAIRS.fieldNames())
        source = here.select(F.col("id").alias("source_product_id"), PART)
        spread = F.array(*map(F.lit, parts))[F.pmod(F.xxhash64("source_product_id"), F.lit(len(parts))).cast("int")]
        placed = rows.join(source, "source_product_id", "left").withColumn(PART, F.coalesce(PART, spread))
        write_parts(stored(placed.select(*rows.columns, PART)), pairs_path, parts)

    return (
        spark.readStream.schema(PRODUCTS)
        .parquet(arriving)
        .writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
