"""Quality rules and a hashed n-gram log-likelihood ratio, in built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfpair.llm.common import fresh, let, set_aside, smallest_by_hash, without
from shelfpair.session import stored

GAP = r"[ \t\n\x0B\f\r]+"
WORD = r"[^ \t\n\x0B\f\r]"
SYMBOL = r"[#*$%&|<>]"
#: Number of hash buckets; it bounds the tables of counts and ratios, whatever the size of the corpus.
BUCKETS = 1 << 16
FACTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"]


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda word: word != "")


def ngrams(words: Column) -> Column:
    """Bucket numbers of the words and of the pairs of neighbouring words."""
    bucket = lambda *parts: F.pmod(F.xxhash64(*parts), F.lit(BUCKETS)).cast("int")
    pairs = F.zip_with(F.slice(words, F.lit(1), F.size(words) - 1), F.slice(words, F.lit(2), F.size(words)), lambda a, b: bucket(a, b))
    return F.concat(F.transform(words, lambda word: bucket(word)), F.when(F.size(words) > 1, pairs).otherwise(F.array().cast("array<int>")))


def repeated_words(words: Column, width: int = 8) -> Column:
    """Words that lie in a window of ``width`` words occurring twice or more, first occurrences included.

    Windows are compared by 64-bit hashes. Equal neighbours in sorted order are repeats; the lengths of the marked windows,
    less their overlaps, add up to the words covered. All of it stays within the row: no rows are made and nothing is
    shuffled.
    """

    def covered(hashes: Column) -> Column:
        marked = F.sort_array(F.transform(hashes, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))

        def union(windows: Column) -> Column:
            h = lambda k: F.get(windows, k)["h"]
            twin = lambda k: F.coalesce(h(k) == h(k - 1), F.lit(False)) | F.coalesce(h(k) == h(k + 1), F.lit(False))
            twice = F.filter(F.sequence(F.lit(0), F.size(windows) - 1), twin)
            starts = F.sort_array(F.transform(twice, lambda k: F.get(windows, k)["at"]))
            zero = F.struct(F.lit(-width).alias("last"), F.lit(0).cast("long").alias("total"))
            step = lambda state, at: F.struct(at.alias("last"), (state["total"] + F.least(F.lit(width), at - state["last"])).alias("total"))
            return F.aggregate(starts, zero, step, lambda state: state["total"])

        return let(marked, union)

    hashes = F.transform(F.sequence(F.lit(1), F.size(words) - (width - 1)), lambda i: F.xxhash64(F.slice(words, i, F.lit(width))))
    none = F.lit(0).cast("long")
    repeats = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(covered(h)))
    return F.when(F.size(words) < width, none).otherwise(repeats)


def trusted_ids(labels: DataFrame, most: int = 20_000) -> DataFrame:
    """(doc_id) of documents labelled good and not toxic: all of them up to ``most``, else those smallest by hash.

    The bound makes this the fitting sample of a classifier, which may be broadcast: ``most`` ids are 160 KB.
    """
    good = labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null")
    ids = good.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    return smallest_by_hash(ids, "doc_id", most, labels.count())


def ratios(docs: DataFrame, trusted: DataFrame, smoothing: float = 10.0) -> DataFrame:
    """(bucket, ratio) for all buckets: log of the n-gram's count in the trusted texts over what all ``docs`` let expect.

    The expected count is the raw count, scaled to as many n-grams as the trusted texts have; ``smoothing`` is added to
    both, so the two multinomials agree where little is known and a text is not marked down for rare words. Both multinomials come from one pass over whole texts. Every count covers all rows of ``docs``; rows are counted per
    task into at most BUCKETS sums before anything is shuffled.
    """
    marked = docs.select("doc_id", "text").join(F.broadcast(trusted.withColumn("trusted", F.lit(1))), "doc_id", "left")
    grams = marked.select("trusted", F.explode(let(words_of(F.col("text")), ngrams)).alias("bucket"))
    counts = stored(grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.count("trusted").alias("target")))
    totals = counts.agg(F.struct(F.sum("raw").alias("raw"), F.sum("target").alias("target"))).scalar()
    every = counts.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    scale = F.coalesce(totals["target"] / F.nullif(totals["raw"], F.lit(0)), F.lit(0.0))
    expected = F.coalesce("raw", F.lit(0)) * scale
    ratio = F.log((F.coalesce("target", F.lit(0)) + smoothing) / (expected + smoothing))
    return every.join(counts, "bucket", "left").select("bucket", ratio.alias("ratio"))


def judge(docs: DataFrame, labels: DataFrame, threshold: float = -0.1, most_trusted: int = 20_000) -> DataFrame:
    """``docs`` (doc_id, text, ...) with the columns FACTS; columns of those names that were there are replaced.

    Words are runs of characters other than ASCII white space; a null text has none. n_words, word_chars (code points in
    words), n_symbols, n_dup_lines (lines with a word that equal an earlier line) and n_repeat_words (see
    ``repeated_words``) are exact. base_failed: under 20 words, or over 30 % repeated words. score: mean log-likelihood
    ratio of the hashed words and word pairs between trusted texts (``labels``: quality 1, not toxic) and all of ``docs``,
    so texts of any length compare; null without words. kept: not base_failed and score >= ``threshold``.

    With no trusted text every score is 0, so the base rules decide; with no rows at all the result is empty.
    Repeated rows are counted and returned as often as they come. Ties in the score fall on the same side of the threshold.
    """
    base = without(docs, *FACTS)
    facts, looked_up = fresh("facts", base), fresh("ratio_of_bucket", base)
    trusted = trusted_ids(labels, most_trusted)
    learned = stored(ratios(docs, trusted))
    table = learned.agg(F.sort_array(F.collect_list(F.struct("bucket", "ratio"))).alias("t")).select(F.transform("t", lambda x: x["ratio"])).scalar()
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    zero = F.lit(0).cast("long")

    def measured(words: Column) -> Column:
        mean = let(ngrams(words), lambda g: F.aggregate(g, F.lit(0.0), lambda s, b: s + F.get(F.col(looked_up), b)) / F.size(g))
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.aggregate(words, zero, lambda s, w: s + F.length(w)).alias("word_chars"),
            F.regexp_count(text, F.lit(SYMBOL)).cast("long").alias("n_symbols"),
            let(lines, lambda kept: F.size(kept) - F.size(F.array_distinct(kept))).cast("long").alias("n_dup_lines"),
            repeated_words(words).alias("n_repeat_words"),
            F.when(F.size(words) > 0, mean).alias("score"),
        )

    own = [F.col(f"`{name}`") for name in base.columns]
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    found = base.withColumn(looked_up, table).withColumn(facts, let(words_of(F.col("text")), measured))
    # The optimiser does not look through a generator: a filter on the facts does not measure the text once more for each.
    measured_once = found.select(*own, F.inline(F.array(facts)))
    return measured_once.select(
        *own, *FACTS[:5], failed.alias("base_failed"), (~failed & (F.col("score") >= threshold)).alias("kept"), "score"
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = -0.1) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps; columns stay as they were."""
    own, restored = set_aside(docs, *FACTS)
    return restored(judge(own, labels, threshold).where("kept"))
