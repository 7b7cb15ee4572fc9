"""Views over the given tables, in SQL that Spark and DuckDB both run unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "products": """
SELECT id, shop_type,
  concat(shop_type, ' ', p_name, CASE p_size % 5 WHEN 0 THEN ' zero' WHEN 1 THEN ' biologisch' ELSE '' END) AS title,
  CASE p_brand WHEN 'Brand#1' THEN 'NIVEA' WHEN 'Brand#2' THEN 'Nivea ' WHEN 'Brand#3' THEN 'Dove'
    WHEN 'Brand#4' THEN 'Dr. Beckmann' WHEN 'Brand#5' THEN 'Dr Beckman' WHEN 'Brand#6' THEN 'Coca Cola'
    WHEN 'Brand#7' THEN 'Coca-Cola' WHEN 'Brand#8' THEN 'Oma''s' WHEN 'Brand#9' THEN NULL
    WHEN 'Brand#10' THEN '' ELSE p_brand END AS brand,
  CASE WHEN id % 49 = 0 THEN NULL ELSE p_type END AS main_category,
  CASE WHEN p_size = 50 THEN 0.0E0 ELSE p_size / 8.0E0 END AS normalized_quantity_amount,
  CASE p_size % 3 WHEN 0 THEN 'kg' WHEN 1 THEN 'l' ELSE 'stuk' END AS normalized_quantity_unit,
  p_retailprice / 64.0E0 + (id % 4) * (p_size % 8) / 16.0E0 AS current_price,
  id % 11 <> 0 AS is_active
FROM (SELECT p_partkey AS id,
        CASE p_partkey % 4 WHEN 0 THEN 'AH' WHEN 1 THEN 'JUMBO' WHEN 2 THEN 'PLUS' ELSE 'ALDI' END AS shop_type,
        p_name, p_brand, p_type, p_size, p_retailprice FROM part) x
""",
    "product_equivalence": """
SELECT p_partkey AS id, p_partkey AS source_product_id, p_partkey + 1 + p_size % 7 AS target_product_id,
  CASE p_size % 3 WHEN 0 THEN 'identical' WHEN 1 THEN 'similar' ELSE 'alternative' END AS equivalence_type,
  CAST(CASE p_size % 3 WHEN 0 THEN 0.95 WHEN 1 THEN 0.75 ELSE 0.55 END AS DECIMAL(4,3)) AS similarity_score,
  TIMESTAMP '2024-01-01 00:00:00' AS created_at, TIMESTAMP '2024-01-01 00:00:00' AS updated_at
FROM part WHERE p_partkey % 5 <> 0
""",
    "incoming_pairs": """
SELECT p_partkey + 1 + p_size % 7 AS src, p_partkey AS tgt,
  CASE p_partkey % 3 WHEN 0 THEN 'identical' WHEN 1 THEN 'similar' ELSE 'alternative' END AS equivalence_type,
  CAST(CASE p_partkey % 3 WHEN 0 THEN 0.95 WHEN 1 THEN 0.75 ELSE 0.55 END AS DECIMAL(4,3)) AS similarity_score
FROM part WHERE p_partkey % 2 = 0
""",
    "product_essences": """
SELECT p_partkey AS id, p_partkey AS product_id, split_part(p_name, ' ', 2) AS essence,
  CAST(CASE p_size % 4 WHEN 0 THEN 0.95 WHEN 1 THEN 0.85 WHEN 2 THEN 0.75 ELSE 0.30 END AS DECIMAL(3,2)) AS confidence,
  TIMESTAMP '2024-01-01 00:00:00' AS created_at, 'model-a' AS model_version,
  CAST(100 + p_size * 10 AS INT) AS processing_time_ms, CAST(NULL AS STRING) AS notes
FROM part WHERE p_partkey % 3 <> 0
""",
    "pair_responses": """
SELECT p_partkey AS response_id, concat(
  '[', CAST(p_partkey AS STRING), '] = [', CAST(p_partkey + 1 AS STRING), '] (Identiek)', chr(10),
  CAST(p_partkey AS STRING), '=', CAST(p_partkey + 2 AS STRING), ' (SIMILAR)', chr(10),
  CAST(p_partkey + 2 AS STRING), '=', CAST(p_partkey AS STRING), ' (alternatief)', chr(10), chr(10),
  CAST(p_partkey AS STRING), '=', CAST(p_partkey + 4 AS STRING), ' (alternative)', chr(10),
  CAST(p_partkey AS STRING), '=999999999 (identical)', chr(10),
  CAST(p_partkey AS STRING), '=', CAST(p_partkey + 3 AS STRING), ' (maybe)', chr(10),
  CAST(p_partkey AS STRING), '=', CAST(p_partkey AS STRING), ' (identical)', chr(10),
  'No further matches.') AS response_text
FROM part WHERE p_partkey % 3 = 0
""",
    "essence_responses": """
SELECT p_partkey AS response_id, concat('1. Shampoo', chr(10), '2 - Volle Melk', chr(10), chr(10),
    'this line is far too long', chr(10), '7up zero', chr(10), p_name, ' 250 ml') AS response_text,
  CASE p_partkey % 3 WHEN 0 THEN 2 WHEN 1 THEN 4 ELSE 6 END AS expected_count
FROM part
""",
    "model_predictions": """
SELECT concat('model-', CAST(k AS STRING)) AS model, p_type AS grp, p_partkey AS pair_id,
  CASE p_size % 4 WHEN 0 THEN 'identical' WHEN 1 THEN 'similar' WHEN 2 THEN 'alternative' ELSE 'no_match' END AS expected,
  CASE (p_size + k * (p_partkey % 3)) % 8 WHEN 0 THEN 'Identical.' WHEN 1 THEN ' similar' WHEN 2 THEN 'Alternative product'
    WHEN 3 THEN 'no_match' WHEN 4 THEN 'The same item' WHEN 5 THEN 'a variant' WHEN 6 THEN 'different brand'
    ELSE '???' END AS response,
  CASE WHEN k = 4 AND p_type = 'PROMO' THEN 'HTTP 503' END AS error
FROM part CROSS JOIN (VALUES (1), (2), (3), (4)) m(k)
""",
    "product_vectors": """
SELECT vec_id AS id, CASE vec_id % 4 WHEN 0 THEN 'AH' WHEN 1 THEN 'JUMBO' WHEN 2 THEN 'PLUS' ELSE 'ALDI' END AS shop_type,
  label AS block, embedding
FROM embeddings
""",
}

SOURCE = {name: "embeddings" if name == "product_vectors" else "part" for name in VIEWS}


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of :data:`VIEWS` as a DataFrame over ``folder``."""
    table = SOURCE[name]
    source = spark.read.parquet(f"{folder}/{table}.parquet")
    return spark.sql(VIEWS[name].replace(f"FROM {table}", "FROM {source}"), source=source)


def with_views(names: list[str], body: str, ctes: str = "") -> str:
    """The same views as leading common table expressions of a SQL text."""
    parts = [f"{name} AS ({VIEWS[name].strip()})" for name in names]
    if ctes:
        parts.append(ctes.strip())
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()
