"""Sources, filters, joins and reports."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfpair import schemas
from shelfpair.catalog import twins as S
from shelfpair.catalog.registry import Tables, query
from shelfpair.operators import blocking, merging, parsing
from shelfpair.operators.candidates import add_features, candidate_pairs, fill_missing, rounded
from shelfpair.operators.ranking import top_per_group
from shelfpair.operators.vectors import cross_shop_neighbours, pairs_above, top_neighbours
from shelfpair.plans import evaluation, matching, reports, siblings
from shelfpair.session import ensure_checkpoint_dir, stored
from shelfpair.sources import files, snapshots, tables

ANSWER_CLASS = """CASE WHEN r LIKE '%identical%' THEN 'identical' WHEN r LIKE '%similar%' THEN 'similar' WHEN r LIKE '%alternative%' THEN 'alternative'
      WHEN contains(r, 'no_match') THEN 'no_match' WHEN r LIKE '%ident%' OR r LIKE '%same%' THEN 'identical'
      WHEN r LIKE '%simil%' OR r LIKE '%variant%' THEN 'similar' WHEN r LIKE '%altern%' OR r LIKE '%different brand%' THEN 'alternative'
      WHEN r LIKE '%no%' THEN 'no_match' ELSE 'unknown' END"""
ACCURACY = f"""accuracy AS (SELECT model, grp, count(*) FILTER (predicted = expected) AS correct_count, count(*) AS total_pairs,
      avg(CASE WHEN predicted = expected THEN 1.0E0 ELSE 0.0E0 END) AS accuracy
    FROM (SELECT *, {ANSWER_CLASS} AS predicted FROM (SELECT *, lower(response) AS r FROM model_predictions WHERE error IS NULL) x) y GROUP BY 1, 2)"""
SUMMARY = ACCURACY + """, summary AS (SELECT model, round(avg(accuracy), 9) AS avg_accuracy, CAST(sum(correct_count) AS BIGINT) AS correct_count,
      CAST(sum(total_pairs) AS BIGINT) AS total_pairs, count(*) AS groups_tested FROM accuracy GROUP BY 1)"""
PRODUCT_COLUMNS = (
    "id, shop_type, title, brand, main_category, normalized_quantity_amount, normalized_quantity_unit, current_price, is_active"
)
PAIR_SQL = "source_product_id, target_product_id, equivalence_type, CAST(similarity_score AS DOUBLE) AS similarity_score"
SENT = 1_000_000  # rows of a list that is sent to all tasks, at most; longer lists are joined by a shuffle
LABELLED = "p JOIN product_essences e ON p.id = e.product_id"


def _folder(t: Tables, name: str) -> str:
    return f"{ensure_checkpoint_dir(t.spark)}/{name}-{uuid.uuid4().hex}"


def _pairs(df):
    return df.select(
        "source_product_id", "target_product_id", "equivalence_type", F.col("similarity_score").cast("double").alias("similarity_score")
    )


# sources and sinks


@query("s01_table_read", f"SELECT {PRODUCT_COLUMNS} FROM products WHERE is_active")
def _(t):
    return blocking.active(t.products)


@query(
    "s01_parquet_read",
    "SELECT id, title, main_category FROM products WHERE is_active AND main_category = 'PROMO'",
)
def _(t):
    """A catalogue table in a folder; the filters and the three columns reach the scan."""
    path = _folder(t, "catalogue-table")
    snapshots.write_table(t.products, path)
    rows = blocking.active(tables.read_parquet(t.spark, path, schemas.PRODUCTS))
    return rows.filter(F.col("main_category") == "PROMO").select("id", "title", "main_category")


@query("s02_csv_products", f"SELECT {PRODUCT_COLUMNS.replace('brand', 'nullif(brand, chr(0)) AS brand')} FROM products".replace("chr(0)", "''"))
def _(t):
    path = _folder(t, "products-csv")
    files.write_csv(t.products, path)
    return files.read_products_csv(t.spark, path).withColumn("brand", F.when(F.col("brand") != "", F.col("brand")))


QUARANTINE = "SELECT CASE WHEN id % 5 = 0 THEN concat('two', chr(10), 'lines ', title) ELSE title END AS title, id, brand, normalized_quantity_amount FROM products WHERE brand <> '' "


@query(
    "s02_rejected_lines",
    f"""SELECT id, title, normalized_quantity_amount AS amount, CAST(NULL AS VARCHAR) AS line FROM ({QUARANTINE}) q
    UNION ALL SELECT NULL, NULL, NULL, concat('broken,', id, ',x,much') FROM products WHERE id % 500 = 7
    UNION ALL SELECT NULL, NULL, NULL, concat(id, ',only two') FROM products WHERE id % 500 = 8""",
)
def _(t):
    """Quoted line breaks are read; lines with a wrong type or too few values are reported and not turned into NULLs."""
    path = _folder(t, "checked-csv")
    t.products.createOrReplaceTempView("s02_products")
    files.write_csv(t.spark.sql(QUARANTINE.replace("FROM products", "FROM s02_products")).select("id", "title", "brand", "normalized_quantity_amount"), path)
    bad = t.products.selectExpr("CASE id % 500 WHEN 7 THEN concat('broken,', id, ',x,much') WHEN 8 THEN concat(id, ',only two') END AS value").filter("value IS NOT NULL")
    header = t.spark.range(1).selectExpr("'id,title,brand,normalized_quantity_amount' AS value")
    header.unionByName(bad).coalesce(1).write.mode("append").text(path)
    schema = StructType.fromDDL("id bigint, title string, brand string, normalized_quantity_amount double")
    rows, rejected = files.read_checked_csv(t.spark, path, schema)
    none = lambda kind: F.lit(None).cast(kind)
    good = rows.select("id", "title", F.col("normalized_quantity_amount").alias("amount"), none("string").alias("line"))
    return good.unionByName(rejected.select(none("bigint").alias("id"), none("string").alias("title"), none("double").alias("amount"), "line"))


@query("s03_required_columns", "SELECT id, title, shop_type FROM products")
def _(t):
    return tables.require_columns(t.products).select("id", "title", "shop_type")


@query("s04_match_export", "SELECT * FROM matches", ctes=S.RULE_MATCHES)
def _(t):
    path = _folder(t, "matches-csv")
    files.export_matches(matching.rule_matches(t.products, ordered=True), path, ordered=True)
    schema = (
        "source_product_id bigint, target_product_id bigint, similarity_score double, equivalence_type string, method string, "
        "reasoning string, shop_1 string, shop_2 string, title_1 string, title_2 string, brand_1 string, brand_2 string, created_at string"
    )
    back = t.spark.read.schema(schema).options(**files.CSV).csv(path).drop("created_at")
    return back.fillna({"brand_1": "", "brand_2": ""})


@query(
    "s05_import_export",
    "SELECT source_product_id, target_product_id, equivalence_type, similarity_score FROM matches",
    ctes=S.RULE_MATCHES,
)
def _(t):
    path = _folder(t, "import-csv")
    files.export_for_import(matching.rule_matches(t.products, ordered=True), path, ordered=True)
    schema = "source_product_id bigint, target_product_id bigint, equivalence_type string, similarity_score double, created_at string"
    return t.spark.read.schema(schema).option("header", True).csv(path).drop("created_at")


@query("s06_copy_text", f"SELECT id, {PAIR_SQL} FROM product_equivalence", "product_equivalence")
def _(t):
    path = _folder(t, "pairs-copy")
    files.write_copy_text(t.pairs.select(*schemas.PAIRS.fieldNames()), path)
    back = files.read_copy_text(t.spark, path)
    return back.select("id", *_pairs(back).columns).withColumn("similarity_score", F.col("similarity_score").cast("double"))


AWKWARD = "SELECT id, CASE id % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN concat('a', chr(9), title) WHEN 3 THEN concat(title, chr(10), 'b', chr(13)) WHEN 4 THEN concat(chr(92), 'N') WHEN 5 THEN concat(chr(92), chr(92), 'n', title, chr(92)) ELSE title END AS title, brand FROM products"


@query("s06_awkward_text", AWKWARD)
def _(t):
    """Tabs, line ends, backslashes, empty texts and nulls through COPY text and back."""
    path = _folder(t, "awkward-copy")
    t.products.createOrReplaceTempView("s06_products")
    files.write_copy_text(t.spark.sql(AWKWARD.replace("FROM products", "FROM s06_products")), path)
    return files.read_copy_text(t.spark, path, StructType.fromDDL("id bigint, title string, brand string"))


@query(
    "s09_products_with_labels",
    "SELECT p.id, p.title, e.essence, CAST(e.confidence AS DOUBLE) AS confidence, e.model_version FROM products p LEFT JOIN product_essences e ON p.id = e.product_id",
    "products product_essences",
)
def _(t):
    rows = reports.products_with_labels(t.products, t.labels)
    return rows.select("id", "title", "essence", F.col("confidence").cast("double").alias("confidence"), "model_version")


@query("s10_snapshot", f"SELECT {PAIR_SQL} FROM product_equivalence", "product_equivalence")
def _(t):
    path = _folder(t, "pairs-table")
    snapshots.write_table(t.pairs, path, "equivalence_type", "source_product_id")
    return _pairs(snapshots.read_table(t.spark, path, schemas.PAIRS))


@query(
    "s11_cache_split",
    "SELECT id, fingerprint, count(*) OVER (PARTITION BY fingerprint) > 1 AS hit FROM fp",
    ctes=S.FINGERPRINTS,
)
def _(t):
    rows = matching.with_fingerprint(t.products).withColumn("cache_key", snapshots.cache_key(F.col("fingerprint")))
    cached = rows.groupBy("cache_key").agg(F.count("*").alias("n")).filter("n > 1")
    hits, misses = snapshots.split_by_cache(rows.select("id", "fingerprint", "cache_key"), cached)
    return (
        hits.select("id", "fingerprint", F.lit(True).alias("hit"))
        .unionByName(misses.select("id", "fingerprint", F.lit(False).alias("hit")))
    )


# filters and projections


@query("f01_active", "SELECT id FROM products WHERE is_active")
def _(t):
    return blocking.active(t.products).select("id")


@query("f02_block_keys_present", "SELECT id, main_category, normalized_quantity_unit FROM products WHERE main_category IS NOT NULL AND normalized_quantity_unit IS NOT NULL")
def _(t):
    return blocking.with_block(t.products).select("id", "main_category", "normalized_quantity_unit")


@query(
    "f03_one_block",
    "SELECT id, shop_type, title, coalesce(brand, '') AS brand, current_price FROM products WHERE is_active AND main_category = 'PROMO' AND normalized_quantity_unit = 'kg'",
)
def _(t):
    return blocking.block_products(t.products, "PROMO", "kg").select("id", "shop_type", "title", "brand", "current_price")


@query("f04_defaults", "SELECT id, coalesce(brand, '') AS brand, coalesce(normalized_quantity_amount, 0) AS amount, coalesce(normalized_quantity_unit, '') AS unit, coalesce(current_price, 0) AS price FROM products")
def _(t):
    return blocking.with_defaults(t.products).select(
        "id", "brand", F.col("normalized_quantity_amount").alias("amount"), F.col("normalized_quantity_unit").alias("unit"),
        F.col("current_price").alias("price"),
    )


@query("f05_fill_missing", "SELECT id, coalesce(brand, 'Unknown') AS brand, coalesce(title, 'Unknown Product') AS title FROM products")
def _(t):
    return fill_missing(t.products).select("id", "brand", "title")


@query("f06_ids_in_set", "SELECT id, title FROM products WHERE id IN (SELECT product_id FROM product_essences)", "products product_essences")
def _(t):
    return blocking.restrict_to_ids(t.products, t.labels.select(F.col("product_id").alias("id"))).select("id", "title")


@query("f07_eligible_blocks", "SELECT id FROM eligible_rows", ctes=f"{S.ACTIVE_ROWS}, {S.ELIGIBLE_ROWS}")
def _(t):
    return blocking.in_eligible_blocks(t.products).select("id")


@query(
    "f08_evaluation_blocks",
    "SELECT main_category AS category, normalized_quantity_unit AS unit, count(*) AS product_count, count(DISTINCT shop_type) AS shop_count FROM products WHERE main_category IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 5 AND count(DISTINCT shop_type) > 1",
)
def _(t):
    return blocking.evaluation_blocks(t.products)


@query(
    "f09_products_of_label",
    f"SELECT p.id, p.title, p.shop_type, p.current_price, e.essence FROM products {LABELLED} WHERE e.essence = 'ring' AND e.confidence > 0.8",
    "products product_essences",
)
def _(t):
    return reports.products_of_label(t.products, t.labels, "ring")


@query(
    "f10_low_confidence",
    f"SELECT p.id, p.title, e.essence, CAST(e.confidence AS DOUBLE) AS confidence, p.main_category FROM products {LABELLED} WHERE e.confidence < 0.7",
    "products product_essences",
)
def _(t):
    return reports.low_confidence(t.products, t.labels).withColumn("confidence", F.col("confidence").cast("double"))


@query("f11_pairs_from_source", f"SELECT {PAIR_SQL} FROM product_equivalence WHERE source_product_id IN (SELECT id FROM products WHERE is_active)", "products product_equivalence")
def _(t):
    return _pairs(reports.pairs_from_ids(t.pairs, blocking.active(t.products).select("id")))


@query("f12_pairs_of_type", f"SELECT {PAIR_SQL} FROM product_equivalence WHERE equivalence_type = 'identical'", "product_equivalence")
def _(t):
    return _pairs(reports.pairs_of_type(t.pairs, "identical"))


@query(
    "f13_pairs_both_directions",
    """SELECT x.product_id, x.partner_id, x.equivalence_type FROM (
      SELECT source_product_id AS product_id, target_product_id AS partner_id, equivalence_type FROM product_equivalence
      UNION ALL SELECT target_product_id, source_product_id, equivalence_type FROM product_equivalence) x
      JOIN products p ON p.id = x.product_id""",
    "products product_equivalence",
)
def _(t):
    return blocking.restrict_to_ids(reports.partners(t.pairs).withColumnRenamed("product_id", "id"), t.products).select(
        F.col("id").alias("product_id"), "partner_id", "equivalence_type"
    )


AGED = "aged AS (SELECT * REPLACE (TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(id % 97 AS INTEGER)) AS created_at) FROM product_equivalence)"


@query("f14_created_between", f"SELECT {PAIR_SQL} FROM aged WHERE created_at BETWEEN TIMESTAMP '2024-01-01 10:00:00' AND TIMESTAMP '2024-01-02 00:00:00'", "product_equivalence", AGED)
def _(t):
    aged = t.pairs.withColumn("created_at", F.timestamp_seconds(F.unix_timestamp("created_at") + F.col("id") % 97 * 3600))
    return _pairs(reports.pairs_created_between(aged, "2024-01-01 10:00:00", "2024-01-02 00:00:00"))


@query(
    "f15_distinct_ends",
    "SELECT least(src, tgt) AS lo, greatest(src, tgt) AS hi FROM (SELECT src, CASE WHEN src % 3 = 0 THEN src ELSE tgt END AS tgt FROM incoming_pairs) x WHERE src <> tgt",
    "incoming_pairs",
)
def _(t):
    folded = t.incoming.withColumn("tgt", F.expr("IF(src % 3 = 0, src, tgt)"))
    return parsing.distinct_ends(parsing.canonical(folded.select("src", "tgt"), "src", "tgt"))


@query("f16_classified_only", "SELECT source_product_id, target_product_id, equivalence_type FROM matches", ctes=S.RULE_MATCHES)
def _(t):
    return matching.rule_matches(t.products).select("source_product_id", "target_product_id", "equivalence_type")


@query("f17_first_of_shop", "SELECT id, title FROM products WHERE shop_type = 'AH' ORDER BY id LIMIT 200")
def _(t):
    return siblings.first_of_shop(t.products, "AH", 200).select("id", "title")


@query("f18_export_stamp", "SELECT source_product_id, target_product_id, TRUE AS stamped FROM matches", ctes=S.RULE_MATCHES)
def _(t):
    """Every exported row has a stamp of the given form, not in the future and not from before the run."""
    began = F.lit(time.strftime("%Y-%m-%dT%H:%M:%S", time.gmtime()))
    rows = files.export_rows(matching.rule_matches(t.products, ordered=True), ordered=True)
    form = F.col("created_at").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}$")
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    fresh = (F.col("created_at") >= began) & (F.col("created_at") <= now)
    return rows.select("source_product_id", "target_product_id", (form & fresh).alias("stamped"))


# joins


@query(
    "j01_candidate_pairs",
    """SELECT id_1, id_2, round(brand_sim, 9) AS brand_sim, round(term_sim, 9) AS term_sim, round(size_sim, 9) AS size_sim, round(rule_score, 9) AS rule_score
    FROM measured WHERE term_sim >= 0.3E0 OR (brand_sim >= 0.8E0 AND rule_score >= 0.6E0)""",
    ctes=S.RULE,
)
def _(t):
    measures = ["brand_sim", "term_sim", "size_sim", "rule_score"]
    pairs = candidate_pairs(add_features(fill_missing(t.products)), columns=[], each=rounded(measures))
    return pairs.select("id_1", "id_2", *measures)


UNMATCHED = f"SELECT p.id FROM products p WHERE {S.ACTIVE} AND NOT EXISTS (SELECT 1 FROM {{pairs}} e WHERE e.source_product_id = p.id OR e.target_product_id = p.id)"


@query("j02_unmatched", UNMATCHED.format(pairs="product_equivalence"), "products product_equivalence")
def _(t):
    return blocking.unmatched_ids(t.products, t.pairs)


@query("j03_unlabelled", "SELECT p.id FROM products p LEFT JOIN product_essences e ON p.id = e.product_id WHERE e.product_id IS NULL", "products product_essences")
def _(t):
    return reports.unlabelled(t.products, t.labels).select("id")


LIVE = "SELECT e.* FROM product_equivalence e WHERE EXISTS (SELECT 1 FROM products p WHERE p.id = e.source_product_id AND p.is_active) AND EXISTS (SELECT 1 FROM products p WHERE p.id = e.target_product_id AND p.is_active)"


@query("j04_live_pairs", f"SELECT {PAIR_SQL} FROM live", "products product_equivalence", f"live AS ({LIVE})")
def _(t):
    return _pairs(blocking.live_pairs(t.pairs, t.products))


@query("j05_optional_label", "SELECT p.id, e.essence FROM products p LEFT JOIN product_essences e ON p.id = e.product_id", "products product_essences")
def _(t):
    return reports.products_with_labels(t.products, t.labels).select("id", "essence")


@query("j06_with_label", f"SELECT p.id, p.shop_type, e.essence FROM products {LABELLED}", "products product_essences")
def _(t):
    return reports.labelled(t.products, t.labels).select("id", "shop_type", "essence")


@query(
    "j10_fingerprint_pairs",
    "SELECT a.id AS source_product_id, b.id AS target_product_id, 0.98E0 AS confidence, 'exact' AS equivalence_type FROM fp a JOIN fp b ON a.fingerprint = b.fingerprint AND a.id < b.id AND a.shop_type <> b.shop_type",
    ctes=S.FINGERPRINTS,
)
def _(t):
    return matching.exact_pairs(matching.with_fingerprint(t.products))


@query(
    "j10_fingerprint_groups",
    """SELECT fingerprint, id, shop_type FROM (SELECT *, count(*) OVER (PARTITION BY fingerprint) AS n FROM fp) f
    WHERE fingerprint IN (SELECT fingerprint FROM fp GROUP BY 1 HAVING count(DISTINCT shop_type) > 1)""",
    ctes=S.FINGERPRINTS,
)
def _(t):
    return matching.exact_members(matching.with_fingerprint(t.products)).select("fingerprint", "id", "shop_type")


COPIES = "copies AS (SELECT id, shop_type, CASE WHEN id % 5 = 0 THEN fingerprint ELSE 'one and the same' END AS fingerprint FROM fp)"


@query(
    "j10_crowded_group",
    """SELECT source_product_id, target_product_id, product_count, pair_count FROM (
      SELECT min(id) OVER (PARTITION BY fingerprint) AS source_product_id, id AS target_product_id,
        count(*) OVER (PARTITION BY fingerprint) AS product_count, pair_count
      FROM copies JOIN (SELECT a.fingerprint, count(*) AS pair_count FROM copies a JOIN copies b
        ON a.fingerprint = b.fingerprint AND a.id < b.id AND a.shop_type <> b.shop_type GROUP BY 1) g USING (fingerprint)) x
    WHERE source_product_id <> target_product_id""",
    ctes=S.FINGERPRINTS + ", " + COPIES,
)
def _(t):
    """Four of five listings are copies of one another."""
    rows = matching.with_fingerprint(t.products)
    crowd = rows.withColumn("fingerprint", F.when(F.col("id") % 5 == 0, F.col("fingerprint")).otherwise("one and the same"))
    return matching.exact_matches(crowd).drop("confidence", "equivalence_type")


@query(
    "j11_vector_neighbours",
    "SELECT id_1, id_2, score, rank FROM ranked WHERE rank <= 10 AND score > 0.15 AND shop_type_1 <> shop_type_2",
    "product_vectors",
    S.NEIGHBOURS.format(vectors="product_vectors", on="a.block = b.block"),
)
def _(t):
    found = cross_shop_neighbours(t.vectors, 10, 0.15, ["block"])
    return found.select("id_1", "id_2", "score", F.col("rank").cast("bigint").alias("rank"))


@query(
    "j11_vector_neighbours_wide",
    "SELECT id_1, id_2, score, rank FROM ranked WHERE rank <= 10 AND score > 0.2 AND shop_type_1 <> shop_type_2",
    "product_vectors",
    S.NEIGHBOURS.format(vectors="product_vectors", on="TRUE"),
)
def _(t):
    found = cross_shop_neighbours(t.vectors, 10, 0.2)
    return found.select("id_1", "id_2", "score", F.col("rank").cast("bigint").alias("rank"))


@query(
    "j11_vector_pairs",
    "SELECT id_1, id_2, score FROM scored WHERE id_1 < id_2 AND score >= 0.25 AND shop_type_1 <> shop_type_2",
    "product_vectors",
    S.NEIGHBOURS.format(vectors="product_vectors", on="a.block = b.block"),
)
def _(t):
    return pairs_above(t.vectors, 0.25, ["block"]).select("id_1", "id_2", "score")


@query(
    "w06_top_neighbours",
    "SELECT id_1, id_2, score, rank FROM ranked WHERE rank <= 10",
    "product_vectors",
    S.NEIGHBOURS.format(vectors="product_vectors", on="TRUE"),
)
def _(t):
    found = top_neighbours(t.vectors, 10)
    return found.select("id_1", "id_2", "score", F.col("rank").cast("bigint").alias("rank"))


@query(
    "j14_loose_candidates",
    """SELECT id_1, id_2, round(rule_score, 9) AS rule_score FROM measured
    WHERE (term_sim >= 0.3E0 OR brand_sim >= 0.8E0) AND rule_score >= 0.5E0""",
    "products product_equivalence",
    S.RULE.replace("FROM products)", "FROM products WHERE id NOT IN (SELECT source_product_id FROM product_equivalence) AND id NOT IN (SELECT target_product_id FROM product_equivalence))"),
)
def _(t):
    rest = t.products.join(blocking.paired_ids(t.pairs), "id", "left_anti")
    return matching.loose_candidates(rest).select("id_1", "id_2", F.round("rule_score", 9).alias("rule_score"))


@query(
    "j14_strict_candidates",
    """SELECT id_1, id_2, round(rule_score, 9) AS rule_score FROM measured
    WHERE (term_sim >= 0.5E0 OR brand_sim >= 0.7E0) AND rule_score >= 0.55E0""",
    ctes=S.RULE,
)
def _(t):
    pairs = matching.loose_candidates(t.products, threshold=0.55, min_terms=0.5, min_brand=0.7, columns=[], each=rounded(["rule_score"]))
    return pairs.select("id_1", "id_2", "rule_score")


@query(
    "j15_brand_blocks",
    f"""SELECT main_category AS category, normalized_quantity_unit AS unit, bn AS brand, count(*) AS product_count,
      count(DISTINCT shop_type) AS shop_count FROM (SELECT *, coalesce({S.BRAND_NORM}, 'unknown') AS bn FROM active_rows) x
      GROUP BY 1, 2, 3 HAVING count(DISTINCT shop_type) > 1""",
    ctes=S.ACTIVE_ROWS,
)
def _(t):
    return reports.brand_blocks(t.products)


@query(
    "j15_brand_block_pairs",
    f"""SELECT a.id AS id_1, b.id AS id_2 FROM branded a JOIN branded b ON a.main_category = b.main_category
      AND a.normalized_quantity_unit = b.normalized_quantity_unit AND a.bn = b.bn AND a.id < b.id AND a.shop_type <> b.shop_type""",
    ctes=f"{S.ACTIVE_ROWS}, branded AS (SELECT * FROM (SELECT *, {S.BRAND_NORM} AS bn FROM active_rows WHERE brand IS NOT NULL) x WHERE bn <> 'unknown')",
)
def _(t):
    return reports.brand_block_pairs(t.products)


# aggregates

INVENTORY = "SELECT main_category AS category, normalized_quantity_unit AS unit, count(*) AS product_count, count(DISTINCT shop_type) AS shop_count FROM active_rows GROUP BY 1, 2"


@query("a01_block_inventory", INVENTORY, ctes=S.ACTIVE_ROWS)
def _(t):
    return blocking.block_inventory(t.products)


@query(
    "a02_unmatched_inventory",
    INVENTORY.replace("active_rows", "active_rows WHERE id IN (SELECT id FROM unmatched)"),
    "products product_equivalence",
    f"{S.ACTIVE_ROWS}, unmatched AS ({UNMATCHED.format(pairs='product_equivalence')})",
)
def _(t):
    return blocking.inventory_of_ids(t.products, blocking.unmatched_ids(t.products, t.pairs))


@query("a03_pair_total", "SELECT count(*) AS total FROM product_equivalence", "product_equivalence")
def _(t):
    return reports.pair_total(t.pairs)


@query("a04_pairs_by_type", "SELECT equivalence_type, count(*) AS pair_count, round(CAST(sum(similarity_score) AS DOUBLE) / count(*), 3) AS avg_score FROM product_equivalence GROUP BY 1", "product_equivalence")
def _(t):
    return reports.pairs_by_type(t.pairs)


@query("a05_block_totals", "SELECT CAST(sum(n) AS BIGINT) AS products, count(*) AS blocks FROM (SELECT count(*) AS n FROM active_rows GROUP BY main_category, normalized_quantity_unit) g", ctes=S.ACTIVE_ROWS)
def _(t):
    return reports.block_totals(t.products)


PROGRESS = "FROM products p LEFT JOIN product_essences e ON p.id = e.product_id GROUP BY p.main_category"


@query("a06_label_progress", f"SELECT p.main_category, count(*) AS total_products, count(e.product_id) AS classified, count(*) - count(e.product_id) AS remaining {PROGRESS}", "products product_essences")
def _(t):
    return reports.label_progress(t.products, t.labels).select("main_category", "total_products", "classified", "remaining")


@query(
    "a07_label_progress_averages",
    f"SELECT p.main_category, count(*) AS total_products, count(e.product_id) AS classified, coalesce(round(CAST(sum(e.confidence) AS DOUBLE) / count(e.confidence), 6), 0) AS avg_confidence, coalesce(round(avg(CAST(e.processing_time_ms AS DOUBLE)), 6), 0) AS avg_processing_time {PROGRESS}",
    "products product_essences",
)
def _(t):
    return reports.label_progress(t.products, t.labels).drop("remaining")


@query(
    "a08_completion",
    f"SELECT p.main_category, count(*) AS total_products, count(e.product_id) AS classified, count(*) - count(e.product_id) AS remaining, round(count(e.product_id) * 100.0E0 / count(*), 1) AS completion_percentage, round(coalesce(CAST(sum(e.confidence) AS DOUBLE) / count(e.confidence), 0), 3) AS avg_confidence {PROGRESS}",
    "products product_essences",
)
def _(t):
    return reports.completion(t.products, t.labels)


SHOP_PRICES = f"shop_prices AS (SELECT e.essence, p.shop_type, avg(p.current_price) AS avg_price, count(*) AS product_count FROM products {LABELLED} WHERE e.confidence > 0.8 GROUP BY 1, 2 HAVING count(*) >= 2)"


@query("a09_shop_prices", "SELECT essence, shop_type, round(avg_price, 6) AS avg_price, product_count FROM shop_prices", "products product_essences", SHOP_PRICES)
def _(t):
    return reports.shop_prices(t.products, t.labels).withColumn("avg_price", F.round("avg_price", 6))


@query(
    "a10_savings",
    """SELECT essence, round(hi - lo, 2) AS savings_potential, round(lo, 2) AS cheapest_price, round(hi, 2) AS most_expensive_price,
      round((hi - lo) * 100 / lo, 1) AS savings_percentage
    FROM (SELECT essence, min(avg_price) AS lo, max(avg_price) AS hi FROM shop_prices GROUP BY 1 HAVING count(DISTINCT shop_type) >= 2) s
    WHERE hi - lo > 0.50""",
    "products product_essences",
    SHOP_PRICES,
)
def _(t):
    return reports.savings(t.products, t.labels)


@query(
    "a11_label_coverage",
    f"""SELECT e.essence, p.main_category, count(*) AS total_products, count(DISTINCT p.shop_type) AS shop_coverage,
      array_to_string(list_sort(list(DISTINCT p.shop_type)), ',') AS shops, round(CAST(sum(e.confidence) AS DOUBLE) / count(e.confidence), 3) AS avg_confidence,
      min(p.current_price) AS min_price, max(p.current_price) AS max_price
    FROM products {LABELLED} WHERE e.confidence > 0.8 GROUP BY 1, 2 HAVING count(*) >= 4 AND count(DISTINCT p.shop_type) >= 3""",
    "products product_essences",
)
def _(t):
    return reports.label_coverage(t.products, t.labels).withColumn("shops", F.array_join("shops", ","))


@query(
    "a12_score_bands",
    "SELECT CASE WHEN similarity_score >= 0.7E0 THEN 'high' WHEN similarity_score >= 0.5E0 THEN 'medium' ELSE 'low' END AS band, count(*) AS match_count FROM matches GROUP BY 1",
    ctes=S.RULE_MATCHES,
)
def _(t):
    return reports.score_bands(matching.rule_matches(t.products, counted=True))


@query("a13_matches_by_type", "SELECT equivalence_type, count(*) AS match_count FROM matches GROUP BY 1", ctes=S.RULE_MATCHES)
def _(t):
    return reports.matches_by_type(matching.rule_matches(t.products, counted=True))


@query("a14_rows_per_shop", "SELECT shop_type, count(*) AS product_count FROM products GROUP BY 1")
def _(t):
    return reports.rows_per_shop(t.products)


@query(
    "a15_comparisons",
    """SELECT a.main_category AS category, a.normalized_quantity_unit AS unit, count(*) AS cross_shop_pairs FROM active_rows a
    JOIN active_rows b USING (main_category, normalized_quantity_unit) WHERE a.id < b.id AND a.shop_type <> b.shop_type GROUP BY 1, 2""",
    ctes=S.ACTIVE_ROWS,
)
def _(t):
    return blocking.pair_counts_by_block(t.products).filter("cross_shop_pairs > 0").select("category", "unit", "cross_shop_pairs")


@query("a16_accuracy", "SELECT model, grp, correct_count, total_pairs, round(accuracy, 9) AS accuracy FROM accuracy", "model_predictions", ACCURACY)
def _(t):
    return evaluation.accuracy(t.predictions).withColumn("accuracy", F.round("accuracy", 9))


@query("a17_model_summary", "SELECT * FROM summary", "model_predictions", SUMMARY)
def _(t):
    return evaluation.model_summary(t.predictions)


@query("a18_best_model", "SELECT model, avg_accuracy FROM summary WHERE avg_accuracy > 0 ORDER BY avg_accuracy DESC, model LIMIT 1", "model_predictions", SUMMARY)
def _(t):
    return evaluation.best_model(t.predictions)


@query("a19_errors", "SELECT model, error, count(*) AS error_count FROM model_predictions WHERE error IS NOT NULL GROUP BY 1, 2", "model_predictions")
def _(t):
    return evaluation.errors(t.predictions)


@query(
    "a20_blocking_efficiency",
    """SELECT CAST(sum(n) * (sum(n) - 1) / 2 AS BIGINT) AS all_pairs, CAST(sum(n * (n - 1) / 2) AS BIGINT) AS block_pairs,
      CAST(sum((n * n - sq) / 2) AS BIGINT) AS cross_shop_pairs,
      round(CAST(sum(n) * (sum(n) - 1) / 2 AS DOUBLE) / sum(n * (n - 1) / 2), 6) AS ratio
    FROM (SELECT sum(m) AS n, sum(m * m) AS sq FROM (SELECT main_category, normalized_quantity_unit, shop_type, count(*) AS m
      FROM active_rows GROUP BY 1, 2, 3) s GROUP BY main_category, normalized_quantity_unit) b""",
    ctes=S.ACTIVE_ROWS,
)
def _(t):
    return blocking.blocking_efficiency(t.products)


@query(
    "a23_block_hierarchy",
    "SELECT category, unit, product_count AS size, product_count > 50 AS needs_clustering, CASE WHEN product_count > 50 THEN 'clustering' ELSE 'direct' END AS method, product_count AS priority FROM inventory",
    ctes=f"{S.ACTIVE_ROWS}, inventory AS ({INVENTORY})",
)
def _(t):
    return reports.block_hierarchy(t.products)


@query(
    "a24_brand_by_shop",
    """SELECT brand, shop_type, count(*) AS product_count, shops > 1 AS shared
    FROM (SELECT * REPLACE (CASE WHEN id % 10 = 0 THEN 'LIDL' ELSE shop_type END AS shop_type) FROM products) p
    JOIN (SELECT brand, count(DISTINCT CASE WHEN id % 10 = 0 THEN 'LIDL' ELSE shop_type END) AS shops FROM products GROUP BY 1) s USING (brand) GROUP BY 1, 2, shops""",
)
def _(t):
    """One listing in ten is of a shop that no list names."""
    rows = t.products.withColumn("shop_type", F.expr("IF(id % 10 = 0, 'LIDL', shop_type)"))
    return reports.brand_by_shop(rows)


@query(
    "a25_pair_brands",
    """SELECT s.brand, e.equivalence_type, count(*) AS pair_count, min(least(s.current_price, u.current_price)) AS min_price,
      max(greatest(s.current_price, u.current_price)) AS max_price
    FROM product_equivalence e JOIN products s ON s.id = e.source_product_id JOIN products u ON u.id = e.target_product_id GROUP BY 1, 2""",
    "products product_equivalence",
)
def _(t):
    return reports.pair_brands(t.pairs, t.products)


@query(
    "a26_match_coverage",
    """SELECT count(*) AS products, count(*) FILTER (matched) AS matched, round(CAST(count(*) FILTER (matched) AS DOUBLE) / count(*), 6) AS coverage
    FROM (SELECT EXISTS (SELECT 1 FROM product_equivalence e WHERE e.source_product_id = p.id OR e.target_product_id = p.id) AS matched FROM active_rows p) x""",
    "products product_equivalence",
    S.ACTIVE_ROWS,
)
def _(t):
    return reports.match_coverage(t.products, t.pairs)


@query("a28_confidence_bins", "SELECT equivalence_type, CAST(least(floor(CAST(similarity_score AS DOUBLE) * 10), 9) AS BIGINT) AS bin, count(*) AS pair_count FROM product_equivalence GROUP BY 1, 2", "product_equivalence")
def _(t):
    return reports.confidence_bins(t.pairs)


@query(
    "a28_confidence_outliers",
    """SELECT equivalence_type, id_1, id_2 FROM (SELECT r.*, round(abs(rule_score - med), 6) AS dev, mad FROM rounded r JOIN mids USING (equivalence_type)
      JOIN mads USING (equivalence_type)) x WHERE dev > 3 * mad""",
    ctes=S.RULE + """,
    rounded AS (SELECT id_1, id_2, CAST(printf('%.3f', rule_score) AS DOUBLE) AS rule_score, KIND AS equivalence_type FROM measured WHERE KIND <> 'no_match'),
    mids AS (SELECT equivalence_type, median(rule_score) AS med FROM rounded GROUP BY 1),
    mads AS (SELECT equivalence_type, median(round(abs(rule_score - med), 6)) AS mad FROM rounded JOIN mids USING (equivalence_type) GROUP BY 1)""".replace("KIND", S.kind("rule_score")),
)
def _(t):
    return matching.rule_matches(t.products, chosen=reports.confidence_outliers).select(
        "equivalence_type", F.col("source_product_id").alias("id_1"), F.col("target_product_id").alias("id_2")
    )


@query(
    "a28_fine_outliers",
    """SELECT equivalence_type, id_1, id_2 FROM (SELECT f.*, round(abs(score - med), 6) AS dev, mad FROM fine f JOIN mids USING (equivalence_type)
      JOIN mads USING (equivalence_type)) x WHERE dev > 2 * mad""",
    "product_vectors",
    S.NEIGHBOURS.format(vectors="product_vectors", on="a.block = b.block") + """,
    fine AS (SELECT CAST(v.block AS VARCHAR) AS equivalence_type, id_1, id_2, score FROM scored JOIN product_vectors v ON v.id = id_1 WHERE id_1 < id_2 AND shop_type_1 <> shop_type_2),
    mids AS (SELECT equivalence_type, median(score) AS med FROM fine GROUP BY 1),
    mads AS (SELECT equivalence_type, median(round(abs(score - med), 6)) AS mad FROM fine JOIN mids USING (equivalence_type) GROUP BY 1)""",
)
def _(t):
    """Scores of nine decimals: nearly every row of a class has a value of its own."""
    kinds = stored(t.vectors.select(F.col("id").alias("id_1"), F.col("block").cast("string").alias("equivalence_type")))
    kinds = F.broadcast(kinds) if kinds.count() <= SENT else kinds  # else all pairs are shuffled for their class
    scores = pairs_above(t.vectors, -2.0, ["block"]).join(kinds, "id_1")
    rows = scores.withColumnRenamed("score", "similarity_score")
    return reports.confidence_outliers(rows, width=2.0).select("equivalence_type", "id_1", "id_2")


@query(
    "a29_unknown_share",
    f"SELECT p.main_category, count(*) AS labelled, round(avg(CASE WHEN e.essence = 'ring' THEN 100.0E0 ELSE 0.0E0 END), 6) AS unknown_percentage FROM products {LABELLED} GROUP BY 1",
    "products product_essences",
)
def _(t):
    return reports.unknown_share(t.products, t.labels, unknown="ring")


@query("a30_label_group_sizes", "SELECT essence, count(*) AS product_count, CASE WHEN count(*) = 1 THEN 'single' WHEN count(*) > 100 THEN 'too_many' ELSE 'normal' END AS grouping FROM product_essences GROUP BY 1", "product_essences")
def _(t):
    return reports.label_group_sizes(t.labels)
