"""Common table expressions shared by the SQL twins."""

ACTIVE = "is_active AND main_category IS NOT NULL AND normalized_quantity_unit IS NOT NULL"

# brand spelling repairs as plain replacements, in order
BRAND_NORM = (
    "regexp_replace(replace(replace(replace(replace(lower(trim(brand)), 'dr. beckmann', 'dr-beckmann'), "
    "'dr beckmann', 'dr-beckmann'), 'dr beckman', 'dr-beckmann'), 'dr. beckman', 'dr-beckmann'), '[^a-z0-9]', '', 'g')"
)
TITLE_CLEAN = r"regexp_replace(lower(title), '\b(ah|plus|jumbo|aldi)\b', '', 'g')"
TERMS = (
    rf"list_distinct(list_filter(regexp_extract_all({TITLE_CLEAN}, '\b[a-z]{{2,}}\b'), "
    "lambda w: w NOT IN ('van', 'de', 'het', 'een', 'met', 'voor')))"
)
DIET = "regexp_matches(lower(title), 'zero|light|diet|sugarfree')"
BIO = "regexp_matches(lower(title), 'biologisch|bio|organic')"

FEATS = f"""
feats AS (SELECT id, shop_type, title, brand, main_category AS category, normalized_quantity_unit AS unit,
    normalized_quantity_amount AS amount, {BRAND_NORM} AS bn, {TERMS} AS terms, {BIO} AS bio, {DIET} AS diet
  FROM (SELECT id, shop_type, coalesce(title, 'Unknown Product') AS title, coalesce(brand, 'Unknown') AS brand,
    main_category, normalized_quantity_unit, normalized_quantity_amount FROM products) p)"""

LCS = (
    "list_last(list_reduce(range(1, length({a}) + 1), lambda prev, i: list_reduce(range(1, length({b}) + 1), "
    "lambda row, j: list_append(row, CASE WHEN substring({a}, i, 1) = substring({b}, j, 1) THEN prev[j] + 1 "
    "ELSE greatest(prev[j + 1], row[j]) END), [0::BIGINT]), list_resize([0::BIGINT], length({b}) + 1, 0::BIGINT)))"
)


def ratio(a: str, b: str) -> str:
    return (
        f"CASE WHEN {a} = 'unknown' OR {b} = 'unknown' THEN 0.0E0 WHEN {a} = {b} THEN 1.0E0 "
        f"WHEN length({a}) = 0 OR length({b}) = 0 THEN 0.0E0 "
        f"ELSE 2.0E0 * {LCS.format(a=a, b=b)} / (length({a}) + length({b})) END"
    )


BRANDSIM = f"""
brandsim AS (SELECT a, b, {ratio('a', 'b')} AS s
  FROM (SELECT x.bn AS a, y.bn AS b FROM (SELECT DISTINCT bn FROM feats) x CROSS JOIN (SELECT DISTINCT bn FROM feats) y) t)"""

# all cross-shop pairs of a block with their measures: brute force, no pruning
MEASURED = """
crossed AS (SELECT a.id AS id_1, b.id AS id_2, a.shop_type AS shop_1, b.shop_type AS shop_2, a.title AS title_1,
    b.title AS title_2, a.brand AS brand_1, b.brand AS brand_2, a.category AS cat_1, b.category AS cat_2,
    s.s AS brand_sim,
    len(list_intersect(a.terms, b.terms)) / greatest(CAST(len(list_distinct(list_concat(a.terms, b.terms))) AS DOUBLE), 1.0E0) AS term_sim,
    CASE WHEN a.amount = b.amount THEN 1.0E0 ELSE 1.0E0 - abs(a.amount - b.amount) / greatest(a.amount, b.amount) END AS size_sim,
    CASE WHEN a.bio = b.bio THEN 0.5E0 ELSE 0.0E0 END + CASE WHEN a.diet = b.diet THEN 0.5E0 ELSE 0.0E0 END AS feature_sim
  FROM feats a JOIN feats b ON a.category IS NOT DISTINCT FROM b.category AND a.unit = b.unit AND a.id < b.id
    AND a.shop_type <> b.shop_type
  JOIN brandsim s ON s.a = a.bn AND s.b = b.bn),
measured AS (SELECT *, brand_sim * 0.4E0 + term_sim * 0.3E0 + size_sim * 0.2E0 + feature_sim * 0.1E0 AS rule_score,
    coalesce(cat_1 = cat_2, FALSE) AS same_category FROM crossed)"""


def kind(score: str) -> str:
    return (
        f"CASE WHEN brand_sim >= 0.95E0 AND {score} >= 0.7E0 AND same_category AND size_sim >= 0.9E0 THEN 'identical' "
        f"WHEN (brand_sim >= 0.8E0 AND {score} >= 0.6E0) OR ({score} >= 0.8E0 AND same_category) THEN 'similar' "
        f"WHEN brand_sim < 0.8E0 AND same_category AND {score} >= 0.5E0 AND term_sim >= 0.3E0 THEN 'alternative' "
        "ELSE 'no_match' END"
    )


def reasoning(score: str) -> str:
    two = lambda x: f"printf('%.2f', {x})"
    truth = "CASE WHEN same_category THEN 'True' ELSE 'False' END"
    return (
        f"CASE equivalence_type WHEN 'identical' THEN concat('Brand:', {two('brand_sim')}, ', Sim:', {two(score)}, ', Terms:', {two('term_sim')}, ', Size:', {two('size_sim')}) "
        f"WHEN 'similar' THEN concat('Brand:', {two('brand_sim')}, ', Sim:', {two(score)}, ', Category:', {truth}, ', Size:', {two('size_sim')}) "
        f"WHEN 'alternative' THEN concat('DiffBrand, SameCat, Sim:', {two(score)}, ', Terms:', {two('term_sim')}, ', Size:', {two('size_sim')}) "
        f"ELSE concat('NoMatch: Brand:', {two('brand_sim')}, ', Sim:', {two(score)}, ', Category:', {truth}) END"
    )


def matches(score: str, method: str, source: str = "measured", name: str = "matches") -> str:
    return f"""
{name} AS (SELECT id_1 AS source_product_id, id_2 AS target_product_id, CAST(printf('%.3f', {score}) AS DOUBLE) AS similarity_score,
    equivalence_type, '{method}' AS method, {reasoning(score)} AS reasoning, shop_1, shop_2, title_1, title_2, brand_1, brand_2
  FROM (SELECT *, {kind(score)} AS equivalence_type FROM {source}) k WHERE equivalence_type <> 'no_match')"""


RULE = ",".join([FEATS, BRANDSIM, MEASURED])
RULE_MATCHES = RULE + "," + matches("rule_score", "rule_based")

INTERLEAVED = f"""
b1 AS (SELECT *, lower(trim(coalesce(brand, ''))) AS bk,
    row_number() OVER (PARTITION BY main_category, normalized_quantity_unit ORDER BY brand NULLS LAST, title NULLS LAST, id) AS ord
  FROM {{source}}),
b2 AS (SELECT *, row_number() OVER (PARTITION BY main_category, normalized_quantity_unit, bk, shop_type ORDER BY ord) AS i,
    min(ord) OVER (PARTITION BY main_category, normalized_quantity_unit, bk, shop_type) AS f FROM b1),
placed AS (SELECT id, main_category, normalized_quantity_unit, shop_type, brand, title, normalized_quantity_amount, current_price,
    row_number() OVER (PARTITION BY main_category, normalized_quantity_unit ORDER BY bk, i, f) - 1 AS position FROM b2)"""

ACTIVE_ROWS = f"active_rows AS (SELECT * FROM products WHERE {ACTIVE})"
ELIGIBLE_ROWS = (
    "eligible_rows AS (SELECT a.* FROM active_rows a JOIN (SELECT main_category, normalized_quantity_unit FROM active_rows "
    "GROUP BY 1, 2 HAVING count(*) >= 2 AND count(DISTINCT shop_type) >= 2) g USING (main_category, normalized_quantity_unit))"
)

# pair grammar on one line per row
PAIR_LINES = r"""
raw_lines AS (SELECT response_id, unnest(string_split(response_text, chr(10))) AS line,
    unnest(range(len(string_split(response_text, chr(10))))) AS line_no FROM pair_responses),
read_lines AS (SELECT response_id, line_no,
    try_cast(regexp_extract(line, '\[?(\d+)\]?\s*=\s*\[?(\d+)\]?\s*\((\w+)\)', 1) AS BIGINT) AS id_a,
    try_cast(regexp_extract(line, '\[?(\d+)\]?\s*=\s*\[?(\d+)\]?\s*\((\w+)\)', 2) AS BIGINT) AS id_b,
    CASE lower(regexp_extract(line, '\[?(\d+)\]?\s*=\s*\[?(\d+)\]?\s*\((\w+)\)', 3))
      WHEN 'identical' THEN 'identical' WHEN 'identiek' THEN 'identical' WHEN 'similar' THEN 'similar'
      WHEN 'vergelijkbaar' THEN 'similar' WHEN 'alternative' THEN 'alternative' WHEN 'alternatief' THEN 'alternative' END AS equivalence_type
  FROM raw_lines),
good_lines AS (SELECT *, CASE equivalence_type WHEN 'identical' THEN 0.95E0 WHEN 'similar' THEN 0.75E0 ELSE 0.55E0 END AS score
  FROM read_lines WHERE id_a IS NOT NULL AND id_b IS NOT NULL AND equivalence_type IS NOT NULL)"""

FINGERPRINTS = f"""
fp AS (SELECT id, shop_type, title, brand, main_category, normalized_quantity_unit, normalized_quantity_amount,
    concat(bn, '|', array_to_string(list_sort(list_filter(terms, lambda w: w <> bn)), '+'), '|', quantity) AS fingerprint
  FROM (SELECT *, coalesce({BRAND_NORM}, 'unknown') AS bn, {TERMS} AS terms,
    CASE normalized_quantity_unit WHEN 'kg' THEN concat(CAST(CAST(normalized_quantity_amount * 1000 AS BIGINT) AS VARCHAR), 'g')
      WHEN 'l' THEN concat(CAST(CAST(normalized_quantity_amount * 1000 AS BIGINT) AS VARCHAR), 'ml')
      ELSE concat(CASE WHEN normalized_quantity_amount = floor(normalized_quantity_amount)
        THEN CAST(CAST(normalized_quantity_amount AS BIGINT) AS VARCHAR) ELSE CAST(normalized_quantity_amount AS VARCHAR) END,
        normalized_quantity_unit) END AS quantity FROM products) q)"""

NEIGHBOURS = """
scored AS (SELECT a.id AS id_1, b.id AS id_2, a.shop_type AS shop_type_1, b.shop_type AS shop_type_2,
    round(list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 9) AS score
  FROM {vectors} a JOIN {vectors} b ON {on}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY id_1 ORDER BY score DESC, id_2) AS rank FROM scored)"""
