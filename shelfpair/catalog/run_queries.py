"""Batching, merges, model runs, staged matching and streaming."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from shelfpair.catalog import twins as S
from shelfpair.catalog.catalogue_queries import LIVE, PAIR_SQL, UNMATCHED, _folder, _pairs
from shelfpair.catalog.registry import query
from shelfpair.catalog.text_queries import LABEL_LINES
from shelfpair.functions import inference, text
from shelfpair.operators import batching, blocking, merging, parsing
from shelfpair.operators.blocking import BLOCK
from shelfpair.operators.ranking import top_per_group
from shelfpair.plans import labelling, matching, reports, runs
from shelfpair.schemas import PAIRS
from shelfpair.sources import files
from shelfpair.streaming.incremental import load_pairs, read_table, start_incremental

COL = F.col

# Deterministic stand-ins for a model.


def consecutive_pairs(prompts):
    """Claims that each listing is similar to the next one of its prompt."""

    def reply(prompt: str) -> str:
        ids = re.findall(r"^\[(\d+)\]", prompt, flags=re.M)
        return "\n".join(f"{a}={b} (similar)" for a, b in zip(ids, ids[1:]))

    return prompts.map(reply)


def third_words(prompts):
    """Labels each numbered title with its third word."""

    def reply(prompt: str) -> str:
        return "\n".join(title.split(" ")[2] for title in re.findall(r"^\d+\. (.*)$", prompt, flags=re.M))

    return prompts.map(reply)


def even_candidates(prompts):
    """Accepts the candidates with an even id."""

    def reply(prompt: str) -> str:
        ids = [int(i) for i in re.findall(r"^(\d+): ", prompt, flags=re.M)]
        found = ", ".join(f'{{"candidate_id": {i}, "confidence": 0.9, "reasoning": "even"}}' for i in ids if i % 2 == 0)
        return f'{{"matches": [{found}]}}'

    return prompts.map(reply)


# windows and batches

PLACED = f"{S.ACTIVE_ROWS}, {S.ELIGIBLE_ROWS}, {S.INTERLEAVED.format(source='eligible_rows')}"
BATCH = "CAST(floor(position / 10) AS BIGINT)"


@query("w01_interleaved_order", "SELECT id, position FROM placed", ctes=PLACED)
def _(t):
    return batching.interleave(blocking.in_eligible_blocks(t.products)).select("id", "position")


@query("w02_pair_batches", f"SELECT id, {BATCH} AS batch_id FROM placed", ctes=PLACED)
def _(t):
    return batching.pair_batches(blocking.in_eligible_blocks(t.products), 10).select("id", "batch_id")


ID_BATCHES = "SELECT id, CAST(floor((row_number() OVER (PARTITION BY main_category ORDER BY id) - 1) / {n}) AS BIGINT) AS batch_id FROM products"


@query("w03_id_batches", ID_BATCHES.format(n=15))
def _(t):
    return batching.id_batches(t.products, 15).select("id", "batch_id")


@query(
    "w04_first_per_pair",
    """SELECT response_id, lo, hi, equivalence_type FROM (SELECT *, row_number() OVER (PARTITION BY response_id, lo, hi ORDER BY line_no) AS r
      FROM (SELECT *, least(id_a, id_b) AS lo, greatest(id_a, id_b) AS hi FROM good_lines) x) y WHERE r = 1""",
    "pair_responses",
    S.PAIR_LINES,
)
def _(t):
    lines = parsing.canonical(parsing.pair_lines(t.pair_responses, ["response_id"]))
    return parsing.first_of_each_pair(lines, ["line_no"], ["response_id"]).select("response_id", "lo", "hi", "equivalence_type")


@query(
    "w05_first_per_shop",
    f"SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY main_category, normalized_quantity_unit, shop_type ORDER BY id) AS r FROM products WHERE main_category IS NOT NULL) x WHERE r <= 4",
)
def _(t):
    return top_per_group(blocking.with_block(t.products), [*BLOCK, "shop_type"], [COL("id")], 4).select("id")


LOG_BLOCKS = """
log_blocks AS (SELECT DISTINCT split_part(response_text, concat(chr(10), chr(10)), 1) AS response_text FROM pair_responses)"""


def _logs(t):
    """Run logs that hold every answer of the table; Spark writes them as several files."""
    path = _folder(t, "logs")
    entry = F.concat(
        F.lit("10:00:00 INFO    LLM response ("), F.length("response_text").cast("string"), F.lit(" chars): "),
        COL("response_text"), F.lit("\n10:00:01 INFO    Batch done"),
    )
    t.pair_responses.repartition(4, "response_id").select(entry.alias("value")).write.text(path)
    return files.read_logs(t.spark, path)


@query("s07_w07_log_answers", "SELECT response_text FROM log_blocks", "pair_responses", LOG_BLOCKS)
def _(t):
    return parsing.log_answers(_logs(t)).select("response_text")


@query(
    "u02_distinct_answers",
    "SELECT essence_text FROM (SELECT DISTINCT response_text AS essence_text FROM essence_responses) x",
    "essence_responses",
)
def _(t):
    from shelfpair.operators.ranking import first_per_key

    rows = t.essence_responses.select("response_text", "response_id")
    return first_per_key(rows, ["response_text"], ["response_id"]).select(COL("response_text").alias("essence_text"))


# order and limit


@query("t01_largest_blocks", "SELECT main_category AS category, normalized_quantity_unit AS unit, count(*) AS product_count, count(DISTINCT shop_type) AS shop_count FROM active_rows GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10", ctes=S.ACTIVE_ROWS)
def _(t):
    return reports.largest_blocks(t.products)


@query(
    "t02_best_matches",
    "SELECT source_product_id, target_product_id, similarity_score FROM matches ORDER BY similarity_score DESC, source_product_id, target_product_id LIMIT 10",
    ctes=S.RULE_MATCHES,
)
def _(t):
    return reports.best_matches(matching.rule_matches(t.products, lowest=10)).select("source_product_id", "target_product_id", "similarity_score")


@query("t03_page", "SELECT p.id FROM products p LEFT JOIN product_essences e ON p.id = e.product_id WHERE e.product_id IS NULL ORDER BY p.id LIMIT 50 OFFSET 20", "products product_essences")
def _(t):
    return reports.page(reports.unlabelled(t.products, t.labels), 50, 20).select("id")


@query(
    "t06_ordered_prices",
    "SELECT id, row_number() OVER (ORDER BY current_price, id) - 1 AS place FROM products WHERE is_active",
)
def _(t):
    from shelfpair.operators.ranking import row_numbers

    return row_numbers(blocking.active(t.products), [], [COL("current_price"), COL("id")], "place").select("id", "place")


@query("t07_preview_batch", "SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY main_category ORDER BY id) AS r FROM products) x WHERE r <= 15")
def _(t):
    return batching.first_batches(t.products, 15).select("id")


# set operations


@query("u01_union", "SELECT id FROM products WHERE shop_type = 'AH' UNION ALL SELECT id FROM products WHERE shop_type = 'PLUS'")
def _(t):
    return t.products.filter("shop_type = 'AH'").unionByName(t.products.filter("shop_type = 'PLUS'")).select("id")


@query("u03_stage_union", f"SELECT {PAIR_SQL} FROM product_equivalence UNION ALL SELECT least(src, tgt), greatest(src, tgt), equivalence_type, CAST(similarity_score AS DOUBLE) FROM incoming_pairs", "product_equivalence incoming_pairs")
def _(t):
    more = t.incoming.select(
        F.least("src", "tgt").alias("source_product_id"), F.greatest("src", "tgt").alias("target_product_id"), "equivalence_type", "similarity_score"
    )
    return _pairs(t.pairs).unionByName(_pairs(more))


@query(
    "u04_stage_remainder",
    "SELECT id FROM fp WHERE fingerprint NOT IN (SELECT fingerprint FROM fp GROUP BY 1 HAVING count(DISTINCT shop_type) > 1)",
    ctes=S.FINGERPRINTS,
)
def _(t):
    rows = matching.with_fingerprint(t.products)
    return rows.join(matching.exact_members(rows).select("id"), "id", "left_anti").select("id")


@query(
    "u05_token_overlap",
    "SELECT s.id AS id_1, u.id AS id_2, len(list_intersect(s.terms, u.terms)) AS common, len(list_distinct(list_concat(s.terms, u.terms))) AS in_any FROM product_equivalence e JOIN feats s ON s.id = e.source_product_id JOIN feats u ON u.id = e.target_product_id",
    "products product_equivalence",
    S.FEATS,
)
def _(t):
    terms = lambda key, name: t.products.select(COL("id").alias(key), text.title_terms(COL("title")).alias(name))
    pairs = t.pairs.select(COL("source_product_id").alias("id_1"), COL("target_product_id").alias("id_2"))
    both = pairs.join(terms("id_1", "a"), "id_1").join(terms("id_2", "b"), "id_2")
    return both.select(
        "id_1", "id_2", F.size(F.array_intersect("a", "b")).cast("bigint").alias("common"), F.size(F.array_union("a", "b")).cast("bigint").alias("in_any")
    )


# merges


def _incoming(t):
    return t.incoming.select(COL("src").alias("source_product_id"), COL("tgt").alias("target_product_id"), "equivalence_type", "similarity_score")


def merged_sql(base: str, new: str) -> str:
    """CTE ``merged``: pairs of ``base`` merged with unique pairs of ``new`` (lo, hi, kind, score)."""
    return f"""
merged AS (SELECT coalesce(s.source_product_id, n.lo) AS source_product_id, coalesce(s.target_product_id, n.hi) AS target_product_id,
    CASE WHEN s.source_product_id IS NULL OR n.score > CAST(s.similarity_score AS DOUBLE) THEN n.kind ELSE s.equivalence_type END AS equivalence_type,
    CASE WHEN s.source_product_id IS NULL OR n.score > CAST(s.similarity_score AS DOUBLE) THEN n.score ELSE CAST(s.similarity_score AS DOUBLE) END AS similarity_score,
    CASE WHEN s.source_product_id IS NULL THEN 'inserted' WHEN n.score > CAST(s.similarity_score AS DOUBLE) THEN 'updated' ELSE 'unchanged' END AS action
  FROM {base} s FULL JOIN {new} n ON s.source_product_id = n.lo AND s.target_product_id = n.hi)"""


MERGED = "SELECT source_product_id, target_product_id, equivalence_type, similarity_score, action FROM merged"


def _merged(df):
    return df.select(
        "source_product_id", "target_product_id", "equivalence_type", COL("similarity_score").cast("double").alias("similarity_score"), "action"
    )


NEW_PAIRS = "new_pairs AS (SELECT least(src, tgt) AS lo, greatest(src, tgt) AS hi, equivalence_type AS kind, CAST(similarity_score AS DOUBLE) AS score FROM incoming_pairs)"


@query("d01_merge_pairs", MERGED, "product_equivalence incoming_pairs", NEW_PAIRS + "," + merged_sql("product_equivalence", "new_pairs"))
def _(t):
    return _merged(merging.merge_pairs(t.pairs, _incoming(t), ["equivalence_type"]))


@query(
    "d01_written_counts",
    "SELECT action, CAST(count(*) AS BIGINT) AS rows FROM merged GROUP BY 1 UNION ALL SELECT 'read back', count(*) FROM merged",
    "product_equivalence incoming_pairs",
    NEW_PAIRS + "," + merged_sql("product_equivalence", "new_pairs"),
)
def _(t):
    """Counts that ride on the write of the merged table, and the rows found there."""
    path = _folder(t, "merged")
    counts = merging.write_counted(merging.merge_pairs(t.pairs, _incoming(t), ["equivalence_type"]), path)
    found = t.spark.createDataFrame([(k, n) for k, n in counts.items() if n], "action string, rows bigint")
    return found.unionByName(t.spark.read.parquet(path).agg(F.count("*").alias("rows")).selectExpr("'read back' AS action", "rows"))


@query(
    "d02_merge_labels",
    # one product in four comes a second time, and the later row wins
    """SELECT coalesce(e.product_id, n.product_id) AS product_id, coalesce(n.essence, e.essence) AS essence, coalesce(n.confidence, CAST(e.confidence AS DOUBLE)) AS confidence,
      CASE WHEN e.product_id IS NULL THEN 'inserted' WHEN n.product_id IS NOT NULL THEN 'updated' ELSE 'unchanged' END AS action
    FROM product_essences e FULL JOIN (SELECT id AS product_id, CASE WHEN id % 4 = 0 THEN 'later' ELSE lower(trim(brand)) END AS essence, CASE WHEN id % 4 = 0 THEN 0.7E0 ELSE 0.9E0 END AS confidence FROM products WHERE brand IS NOT NULL) n ON e.product_id = n.product_id""",
    "products product_essences",
)
def _(t):
    new = t.products.filter("brand IS NOT NULL").select(
        COL("id").alias("product_id"), COL("brand").alias("essence"), F.lit(0.9).cast("decimal(3,2)").alias("confidence"),
        F.lit("model-b").alias("model_version"), F.lit(1).alias("processing_time_ms"), F.lit(1).alias("place"),
    )
    later = new.filter("product_id % 4 = 0").withColumns(
        {"essence": F.lit(" Later "), "confidence": F.lit(0.7).cast("decimal(3,2)"), "place": F.lit(2)}
    )
    merged = merging.merge_labels(t.labels, later.unionByName(new), ["place"])
    return merged.select("product_id", "essence", COL("confidence").cast("double").alias("confidence"), "action")


@query("d03_clean_up", f"SELECT {PAIR_SQL} FROM live", "products product_equivalence", f"live AS ({LIVE})")
def _(t):
    return _pairs(merging.clean_up(t.pairs, t.products))


CLEAN_UP = "SELECT (SELECT count(*) FROM product_equivalence) AS before, (SELECT count(*) FROM live) AS kept, (SELECT count(*) FROM product_equivalence) - (SELECT count(*) FROM live) AS removed"


@query("m03_clean_up_counts", CLEAN_UP, "products product_equivalence", f"live AS ({LIVE})")
def _(t):
    return merging.clean_up_counts(t.pairs, t.products)


@query("m03_written_clean_up", CLEAN_UP, "products product_equivalence", f"live AS ({LIVE})")
def _(t):
    """The same numbers, taken while the table that stays is written."""
    counts = merging.write_cleaned(t.pairs, t.products, _folder(t, "cleaned"))
    return t.spark.createDataFrame([tuple(counts.values())], ", ".join(f"{name} bigint" for name in counts))


@query(
    "d04_review_decisions",
    """SELECT source_product_id, target_product_id, CASE decision WHEN 'approve' THEN 'approved' WHEN 'reject' THEN 'rejected' WHEN 'defer' THEN 'deferred' ELSE 'queued' END AS status
    FROM product_equivalence LEFT JOIN (SELECT least(src, tgt) AS lo, greatest(src, tgt) AS hi, CASE equivalence_type WHEN 'identical' THEN 'approve' WHEN 'similar' THEN 'defer' ELSE 'reject' END AS decision
      FROM incoming_pairs) d ON source_product_id = lo AND target_product_id = hi""",
    "product_equivalence incoming_pairs",
)
def _(t):
    decision = F.when(COL("equivalence_type") == "identical", "approve").when(COL("equivalence_type") == "similar", "defer").otherwise("reject")
    decisions = t.incoming.select(F.least("src", "tgt").alias("source_product_id"), F.greatest("src", "tgt").alias("target_product_id"), decision.alias("decision"))
    return merging.apply_decisions(t.pairs, decisions).select("source_product_id", "target_product_id", "status")


@query(
    "j08_valid_cross_shop",
    "SELECT g.response_id, CAST(g.line_no AS BIGINT) AS line_no, g.id_a, g.id_b FROM good_lines g JOIN active_rows a ON a.id = g.id_a JOIN active_rows b ON b.id = g.id_b AND b.shop_type <> a.shop_type",
    "products pair_responses",
    f"{S.ACTIVE_ROWS}, {S.PAIR_LINES}",
)
def _(t):
    lines = parsing.pair_lines(t.pair_responses, ["response_id"]).withColumn("grp", F.lit(0))
    members = blocking.with_block(blocking.active(t.products)).select(F.lit(0).alias("grp"), "id", "shop_type")
    return parsing.valid_cross_shop(lines, members, ["grp"]).select("response_id", "line_no", "id_a", "id_b")


# runs

CLAIMS = f"""
claims AS (SELECT main_category, normalized_quantity_unit, batch_id, id AS a, shop_type AS sa,
    lead(id) OVER w AS b, lead(shop_type) OVER w AS sb FROM (SELECT *, {BATCH} AS batch_id FROM placed) p
  WINDOW w AS (PARTITION BY main_category, normalized_quantity_unit, batch_id ORDER BY position)),
claimed AS (SELECT main_category, normalized_quantity_unit, batch_id, least(a, b) AS lo, greatest(a, b) AS hi, 'similar' AS kind, 0.75E0 AS score
  FROM claims WHERE b IS NOT NULL AND sa <> sb)"""
FULL = PLACED + "," + CLAIMS


@query("v01_pair_answers", "SELECT main_category, normalized_quantity_unit, batch_id, lo, hi FROM claimed", ctes=FULL)
def _(t):
    batched = batching.pair_batches(blocking.in_eligible_blocks(t.products), 10)
    found = runs.answered_pairs(batched, batched, consecutive_pairs)[0]
    return found.select(*BLOCK, "batch_id", COL("source_product_id").alias("lo"), COL("target_product_id").alias("hi"))


@query(
    "v02_embedded_texts",
    "SELECT id, length(title) AS size FROM products",
)
def _(t):
    texts = t.products.select("id", COL("title").alias("text"))
    vectors = inference.embed(texts, lambda s: s.map(lambda x: [float(len(x)), 1.0]))
    return vectors.select("id", COL("embedding")[0].cast("bigint").alias("size"))


@query("m01_full_run", MERGED, "products product_equivalence", FULL + "," + merged_sql("product_equivalence", "claimed"))
def _(t):
    return _merged(runs.full_run(t.products, t.pairs, consecutive_pairs).merged)


@query("a27_rows_written", "SELECT action, count(*) AS rows FROM merged GROUP BY 1", "products product_equivalence", FULL + "," + merged_sql("product_equivalence", "claimed"))
def _(t):
    return merging.written(runs.full_run(t.products, t.pairs, consecutive_pairs).merged)


@query(
    "m06_dry_run",
    "SELECT main_category, normalized_quantity_unit, count(*) AS pair_count FROM claimed GROUP BY 1, 2 UNION ALL SELECT NULL, NULL, count(*) FROM claimed",
    "products product_equivalence",
    FULL,
)
def _(t):
    return runs.pairs_per_block(runs.full_run(t.products, t.pairs, consecutive_pairs, dry_run=True).parsed)


INCREMENTAL = (
    f"live AS ({LIVE}), unmatched AS ({UNMATCHED.format(pairs='live')}), {FULL}, "
    f"hit AS (SELECT DISTINCT main_category, normalized_quantity_unit, {BATCH} AS batch_id FROM placed WHERE id IN (SELECT id FROM unmatched)), "
    "fresh AS (SELECT c.* FROM claimed c JOIN hit USING (main_category, normalized_quantity_unit, batch_id)), "
    + merged_sql("live", "fresh")
)


@query("m02_incremental_run", MERGED, "products product_equivalence", INCREMENTAL)
def _(t):
    return _merged(runs.incremental_run(t.products, t.pairs, consecutive_pairs).merged)


@query("r01_streaming_run", MERGED.replace(", action", ""), "products product_equivalence", INCREMENTAL)
def _(t):
    base = _folder(t, "stream")
    t.products.write.parquet(f"{base}/arriving")
    load_pairs(t.pairs, f"{base}/tables")
    run = start_incremental(t.spark, f"{base}/arriving", f"{base}/tables", f"{base}/state", consecutive_pairs)
    run.awaitTermination()
    return _pairs(read_table(t.spark, f"{base}/tables/pairs", PAIRS))


@query(
    "j07_affected_batches",
    "SELECT p.id FROM placed p JOIN hit h ON h.main_category = p.main_category AND h.normalized_quantity_unit = p.normalized_quantity_unit AND h.batch_id = CAST(floor(p.position / 10) AS BIGINT)",
    "products product_equivalence",
    INCREMENTAL,
)
def _(t):
    ids = blocking.unmatched_ids(t.products, blocking.live_pairs(t.pairs, t.products))
    batched = batching.pair_batches(blocking.in_eligible_blocks(t.products), 10)
    return batching.batches_with_ids(batched, ids).select("id")


@query(
    "m04_statistics",
    """SELECT 'products' AS name, count(*) AS n FROM active_rows UNION ALL SELECT 'blocks', count(*) FROM (SELECT DISTINCT main_category, normalized_quantity_unit FROM active_rows) b
    UNION ALL SELECT 'pairs', count(*) FROM product_equivalence UNION ALL SELECT equivalence_type, count(*) FROM product_equivalence GROUP BY 1""",
    "products product_equivalence",
    S.ACTIVE_ROWS,
)
def _(t):
    return reports.statistics(t.products, t.pairs)


@query("m04_class_scores", "SELECT equivalence_type, count(*) AS n, round(avg(CAST(similarity_score AS DOUBLE)), 3) AS avg_score FROM product_equivalence GROUP BY 1", "product_equivalence")
def _(t):
    return reports.class_scores(t.pairs)


@query(
    "m05_block_run",
    MERGED,
    "products product_equivalence",
    FULL + ", one AS (SELECT * FROM claimed WHERE main_category = 'PROMO' AND normalized_quantity_unit = 'kg')," + merged_sql("product_equivalence", "one"),
)
def _(t):
    return _merged(runs.block_run(t.products, t.pairs, " PROMO | kg ", consecutive_pairs).merged)


RECOVERED = f"""{S.PAIR_LINES.replace('FROM pair_responses', "FROM (SELECT response_id, split_part(response_text, concat(chr(10), chr(10)), 1) AS response_text FROM pair_responses) q")},
named AS (SELECT least(id_a, id_b) AS lo, greatest(id_a, id_b) AS hi, equivalence_type AS kind, score, response_id, line_no FROM good_lines WHERE id_a <> id_b),
recovered AS (SELECT lo, hi, kind, score FROM (SELECT *, row_number() OVER (PARTITION BY lo, hi ORDER BY response_id, line_no) AS r FROM named) x
  WHERE r = 1 AND lo IN (SELECT id FROM products WHERE is_active) AND hi IN (SELECT id FROM products WHERE is_active))"""


@query("j09_recovered_pairs", "SELECT lo, hi, kind, score FROM recovered", "products pair_responses", RECOVERED)
def _(t):
    parsed = runs.recover(_logs(t), t.products, t.pairs).parsed
    return parsed.select(
        COL("source_product_id").alias("lo"), COL("target_product_id").alias("hi"), COL("equivalence_type").alias("kind"),
        COL("similarity_score").cast("double").alias("score"),
    )


@query("m07_recovery", MERGED, "products product_equivalence pair_responses", RECOVERED + "," + merged_sql("product_equivalence", "recovered"))
def _(t):
    return _merged(runs.recover(_logs(t), t.products, t.pairs).merged)


@query("m08_rule_matches", "SELECT * FROM matches", ctes=S.RULE_MATCHES)
def _(t):
    return matching.rule_matches(t.products)


@query(
    "m08_class_links",
    """SELECT class_1, class_2, similarity_score, equivalence_type, count(*) AS pair_count FROM (
      SELECT least(a.class_id, b.class_id) AS class_1, greatest(a.class_id, b.class_id) AS class_2, similarity_score, equivalence_type
      FROM matches m JOIN grouped a ON a.id = m.source_product_id JOIN grouped b ON b.id = m.target_product_id) x GROUP BY ALL""",
    ctes=S.RULE_MATCHES + ", grouped AS (SELECT id, min(id) OVER (PARTITION BY category, unit, bn, list_sort(terms), amount, bio, diet) AS class_id FROM feats)",
)
def _(t):
    return matching.rule_match_links(t.products)[0]


VECTOR_SCORES = """
vec AS (SELECT id, list_append(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * 0.6E0), 0.8E0 + 0.1E0 * (id % 3)) AS v FROM product_vectors),
vector_measured AS (SELECT m.*, round(list_dot_product(a.v, b.v), 9) AS score FROM measured m JOIN vec a ON a.id = m.id_1 JOIN vec b ON b.id = m.id_2)"""


RULED = "by_rules AS (SELECT m.* FROM measured m WHERE m.id_1 NOT IN (SELECT id FROM vec) OR m.id_2 NOT IN (SELECT id FROM vec))"


@query(
    "m09_vector_matches",
    "SELECT * FROM near UNION ALL SELECT * FROM ruled",
    "products product_vectors",
    ",".join([S.RULE, VECTOR_SCORES, RULED, S.matches("score", "semantic", "vector_measured", "near"), S.matches("rule_score", "rule_based", "by_rules", "ruled")]),
)
def _(t):
    scaled = F.transform("embedding", lambda x: x.cast("double") * 0.6)
    vectors = t.vectors.select("id", F.concat(scaled, F.array(0.8 + 0.1 * (COL("id") % 3))).alias("embedding"))
    return matching.vector_matches(t.products, vectors)


LABEL_RUN = """
todo AS (SELECT p.id, p.main_category, string_split(p.title, ' ')[3] AS essence, CAST(floor((row_number() OVER (PARTITION BY main_category ORDER BY p.id) - 1) / 15) AS BIGINT) AS batch_id
  FROM products p LEFT JOIN product_essences e ON e.product_id = p.id WHERE e.product_id IS NULL AND p.main_category IS NOT NULL),
fresh_labels AS (SELECT *, CASE WHEN regexp_matches(essence, 'nivea|dove|ah|jumbo') THEN 0.75E0 WHEN regexp_matches(essence, 'ml|kg|gram|pack') THEN 0.8E0 ELSE 0.95E0 END AS confidence FROM todo)"""


@query(
    "m10_label_products",
    """SELECT product_id, essence, CAST(confidence AS DOUBLE) AS confidence, 'unchanged' AS action FROM product_essences
    UNION ALL SELECT id, essence, confidence, 'inserted' FROM fresh_labels""",
    "products product_essences",
    LABEL_RUN,
)
def _(t):
    merged = labelling.label_products(t.products, t.labels, third_words).merged
    return merged.select("product_id", "essence", COL("confidence").cast("double").alias("confidence"), "action")


@query("m10_label_preview", "SELECT id, essence FROM fresh_labels WHERE batch_id = 0", "products product_essences", LABEL_RUN)
def _(t):
    return labelling.label_products(t.products, t.labels, third_words, preview=True).rows.select("id", "essence")


@query(
    "a22_batch_quality",
    """SELECT main_category, batch_id, count(*) AS labels, round(avg(CASE id % 3 WHEN 0 THEN 1.0E0 WHEN 1 THEN 2.0E0 ELSE 3.0E0 END), 6) AS avg_words,
      count(*) FILTER (id % 3 = 0) AS unknown_count, round(avg(id % 8 / 8.0E0), 6) AS avg_confidence
    FROM (SELECT *, CAST(floor((row_number() OVER (PARTITION BY main_category ORDER BY id) - 1) / 15) AS BIGINT) AS batch_id FROM products) x GROUP BY 1, 2""",
)
def _(t):
    rows = batching.id_batches(t.products, 15).selectExpr(
        "main_category", "batch_id", "id % 8 / 8.0E0 AS confidence",
        "CASE id % 3 WHEN 0 THEN 'unknown' WHEN 1 THEN 'two words' ELSE 'three more words' END AS essence",
    )
    return reports.batch_quality(rows, ["main_category", "batch_id"])


@query(
    "a22_answer_quality",
    "SELECT response_id, count(*) AS labels, round(avg(len(string_split_regex(essence, '\\s+'))), 6) AS avg_words, count(*) FILTER (essence = 'unknown') AS unknown_count FROM slots GROUP BY 1",
    "essence_responses",
    LABEL_LINES,
)
def _(t):
    from shelfpair.catalog.text_queries import _slots

    rows = _slots(t).withColumn("confidence", F.lit(0.0))
    return reports.batch_quality(rows, ["response_id"]).drop("avg_confidence")


STAGED = (
    S.FINGERPRINTS
    + """,
exact AS (SELECT a.fingerprint, count(*) AS pairs FROM fp a JOIN fp b ON a.fingerprint = b.fingerprint AND a.id < b.id AND a.shop_type <> b.shop_type GROUP BY 1),
grouped AS (SELECT id, min(id) OVER (PARTITION BY fingerprint) AS lo, count(*) OVER (PARTITION BY fingerprint) AS n, pairs FROM fp JOIN exact USING (fingerprint)),
stage_1 AS (SELECT lo, id AS hi, 0.98E0 AS confidence, 'exact' AS kind, 1 AS stage, n, pairs FROM grouped WHERE id <> lo),
rest_1 AS (SELECT f.id, f.shop_type, f.main_category AS c, f.normalized_quantity_unit AS u, v.embedding FROM fp f JOIN product_vectors v ON v.id = f.id WHERE f.id NOT IN (SELECT id FROM grouped)),"""
    + S.NEIGHBOURS.format(vectors="rest_1", on="a.c IS NOT DISTINCT FROM b.c AND a.u = b.u")
    + """,
stage_2 AS (SELECT least(id_1, id_2) AS lo, greatest(id_1, id_2) AS hi, max(score) AS confidence, 'similar' AS kind, 2 AS stage, 2 AS n, 1 AS pairs FROM ranked WHERE rank <= 10 AND score > 0.3 AND shop_type_1 <> shop_type_2 GROUP BY 1, 2),"""
    + S.RULE.replace(
        "FROM products)",
        "FROM products WHERE id NOT IN (SELECT id FROM grouped UNION ALL SELECT lo FROM stage_2 UNION ALL SELECT hi FROM stage_2))",
    )
    + """,
stage_3 AS (SELECT id_1 AS lo, id_2 AS hi, 0.9E0 AS confidence, 'similar' AS kind, 3 AS stage, 2 AS n, 1 AS pairs FROM measured WHERE (term_sim >= 0.3E0 OR brand_sim >= 0.8E0) AND rule_score >= 0.5E0 AND id_2 % 2 = 0),
staged AS (SELECT * FROM stage_1 UNION ALL SELECT * FROM stage_2 UNION ALL SELECT * FROM stage_3)"""
)


@query(
    "m12_staged_matches",
    """SELECT lo AS source_product_id, hi AS target_product_id, confidence, kind AS equivalence_type, stage, n AS product_count, pairs AS pair_count,
      CASE WHEN confidence >= 0.95 THEN 'approve' WHEN confidence >= 0.85 THEN 'approve_log' WHEN confidence >= 0.70 THEN 'review' ELSE 'reject' END AS action FROM staged""",
    "products product_vectors",
    STAGED,
)
def _(t):
    return matching.staged_matches(t.products, t.vectors.select("id", "embedding"), even_candidates, threshold=0.3)


CLASS_STAGE = STAGED[: STAGED.index("stage_3 AS")] + """
grouped_rest AS (SELECT id, shop_type, min(id) OVER w AS class_id FROM feats WINDOW w AS (PARTITION BY category, unit, bn, list_sort(terms), amount, bio, diet)),
second AS (SELECT g.class_id, min(g.id) AS other FROM grouped_rest g JOIN grouped_rest f ON f.id = g.class_id WHERE g.shop_type <> f.shop_type GROUP BY 1),
stage_3 AS (SELECT id_1 AS lo, id_2 AS hi, 0.9E0 AS confidence, 'similar' AS kind, 3 AS stage, 2 AS n, 1 AS pairs
  FROM measured m JOIN grouped_rest a ON a.id = id_1 JOIN grouped_rest b ON b.id = id_2 LEFT JOIN second s ON s.class_id = a.class_id
  WHERE (term_sim >= 0.3E0 OR brand_sim >= 0.8E0) AND rule_score >= 0.5E0
    AND CASE WHEN a.class_id = b.class_id THEN s.other ELSE greatest(a.class_id, b.class_id) END % 2 = 0),
staged AS (SELECT * FROM stage_1 UNION ALL SELECT * FROM stage_2 UNION ALL SELECT * FROM stage_3)"""


@query(
    "m12_staged_by_class",
    "SELECT lo AS source_product_id, hi AS target_product_id, confidence, kind AS equivalence_type, stage, n AS product_count, pairs AS pair_count FROM staged",
    "products product_vectors",
    CLASS_STAGE,
)
def _(t):
    vectors = t.vectors.select("id", "embedding")
    return matching.staged_matches(t.products, vectors, even_candidates, threshold=0.3, by_class=True).drop("action")
