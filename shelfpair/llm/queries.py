"""The named queries of this package and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfpair.llm.bytebpe import round_trip
from shelfpair.llm.common import table
from shelfpair.llm.credentials import secret_report
from shelfpair.llm.html import main_text
from shelfpair.llm.language import held_out, identify, train
from shelfpair.llm.packing import pack
from shelfpair.llm.pii import checked_surrogates
from shelfpair.llm.quality import judge
from shelfpair.llm.ranking import search
from shelfpair.llm.simhash import simhash_groups
from shelfpair.llm.tokencounts import section_tokens
from shelfpair.llm.vectors import near_vectors
from shelfpair.llm.warc import BASE32, archive_and_index
from shelfpair.llm.whitening import whiten


def op1_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "lang", "text")
    found = identify(docs.select("doc_id", "text"), train(docs))
    return found.select("doc_id", held_out(found.doc_id).alias("held_out"), "lang_pred", "score")


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = pack(table(spark, folder, "documents"), given=("ids_crc32",))
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op3_vector_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(table(spark, folder, "embeddings"))


OP3_SQL = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
), grouped AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY 1),
counted AS (SELECT a AS vec_id, count(*) AS n FROM link GROUP BY 1)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, g.component_id, e.vec_id = g.component_id AS kept
FROM embeddings e JOIN grouped g USING (vec_id) LEFT JOIN counted c USING (vec_id)
"""


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return judge(docs, table(spark, folder, "labels")).drop("text")


def op5_simhash_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_groups(table(spark, folder, "documents"))


def op6_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return round_trip(table(spark, folder, "documents"))


def op7_html(spark: SparkSession, folder: str) -> DataFrame:
    return main_text(table(spark, folder, "pages"))


# The given pages have one <article> each, with headings, paragraphs, bold text and line breaks in it.
OP7_SQL = r"""
SELECT page_id, url, text, length(text) AS n_chars FROM (
  SELECT page_id, url, trim(regexp_replace(regexp_replace(replace(replace(replace(replace(
      regexp_replace(regexp_replace(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '<br>|</?(p|h1)>', ' ', 'g'), '</?b>', '', 'g'),
    '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', chr(39)), '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS text
  FROM pages) x
"""


def op8_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    found = checked_surrogates(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "text", F.size("entities").cast("long").alias("n_entities"), F.array_sort(F.array_distinct("entities.kind")).alias("kinds"))


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return section_tokens(table(spark, folder, "documents").select("doc_id", "text"))


_FIVE = [f"CAST(concat('0x', substring(hex, {5 * k + 1}, 5)) AS INTEGER)" for k in range(8)]
BASE32_SQL = "concat(" + ", ".join(f"substring('{BASE32}', ({five} >> {s} & 31) + 1, 1)" for five in _FIVE for s in (15, 10, 5, 0)) + ")"


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    captures = archive_and_index(table(spark, folder, "pages"))
    return captures.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP10_SQL = f"""
WITH plain AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
coded AS (SELECT page_id, payload_bytes, {BASE32_SQL} AS payload_digest FROM plain),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM coded)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to FROM firsts
"""


def op11_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_report(table(spark, folder, "documents"))


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(table(spark, folder, "embeddings"))


def op13_search(spark: SparkSession, folder: str) -> DataFrame:
    return search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


_TERMS = r"""unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term"""
OP13_SQL = f"""
WITH words AS (SELECT doc_id, {_TERMS} FROM documents),
tfs AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
lengths AS (SELECT doc_id, sum(tf) AS n FROM tfs GROUP BY ALL),
total AS (SELECT count(*) AS docs, sum(n) AS terms FROM lengths),
norms AS (SELECT doc_id, CAST(75 + (25 * n * docs) // terms AS BIGINT) AS m FROM lengths, total),
weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tfs, total GROUP BY term, docs),
asked AS (SELECT item_id, {_TERMS} FROM benchmark),
counted AS (SELECT item_id, term, count(*) AS times FROM asked GROUP BY ALL),
scored AS (
  SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM counted JOIN weights USING (term) JOIN tfs USING (term) JOIN norms USING (doc_id) GROUP BY ALL
), ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language": op1_language,
    "op2_packing": op2_packing,
    "op3_vector_duplicates": op3_vector_duplicates,
    "op4_quality": op4_quality,
    "op5_simhash_duplicates": op5_simhash_duplicates,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_html": op7_html,
    "op8_surrogates": op8_surrogates,
    "op9_token_counts": op9_token_counts,
    "op10_warc": op10_warc,
    "op11_secrets": op11_secrets,
    "op12_whitening": op12_whitening,
    "op13_search": op13_search,
}
ORACLES: dict[str, str] = {"op3_vector_duplicates": OP3_SQL, "op7_html": OP7_SQL, "op10_warc": OP10_SQL, "op13_search": OP13_SQL}
