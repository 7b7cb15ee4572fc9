"""Column expressions that read answers of a language model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfpair import constants as K
from shelfpair.functions.text import strip

CANDIDATE_ANSWER = T.StructType(
    [
        T.StructField(
            "matches",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("candidate_id", T.LongType()),
                        T.StructField("confidence", T.DoubleType()),
                        T.StructField("reasoning", T.StringType()),
                    ]
                )
            ),
        )
    ]
)

CLUSTER_ANSWER = T.StructType(
    [
        T.StructField(
            "clusters",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("cluster_id", T.StringType()),
                        T.StructField("type", T.StringType()),
                        T.StructField("confidence", T.DoubleType()),
                        T.StructField("products", T.ArrayType(T.LongType())),
                        T.StructField("description", T.StringType()),
                    ]
                )
            ),
        )
    ]
)


def lines(text: Column) -> Column:
    """All lines, at any of the Unicode line boundaries."""
    return F.split(text, r"\R|[\x1c-\x1e]")


def pair_label(word: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in K.LABEL_SYNONYMS.items() for x in pair])
    return known[F.lower(strip(word))]


def pair_score(label: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in K.LABEL_SCORES.items() for x in pair])
    return F.coalesce(known[label], F.lit(0.5)).cast("decimal(4,3)")


def label_lines(text: Column) -> Column:
    """Cleaned label lines: numbering removed, empty and over-long lines dropped."""
    cleaned = F.transform(
        F.split(text, "\n"),
        lambda line: strip(F.regexp_replace(F.lower(strip(line)), r"^[0-9. \-]+", "")),
    )
    return F.filter(
        cleaned, lambda line: (line != "") & (F.size(F.split(line, r"(?U)\s+")) <= K.MAX_LABEL_WORDS)
    )


def align_labels(labels: Column, expected: Column) -> Column:
    """Exactly ``expected`` labels: surplus cut, the rest filled with ``unknown``."""
    return F.slice(F.concat(labels, F.array_repeat(F.lit("unknown"), expected)), F.lit(1), expected)


def label_confidence(label: Column) -> Column:
    """Only the first rule that applies lowers the base confidence."""
    def contains_any(words):
        return label.rlike("|".join(words))

    words = F.size(F.filter(F.split(label, r"(?U)\s+"), lambda w: w != ""))
    score = (
        F.when(label == "unknown", F.lit(K.LABEL_UNKNOWN_CONFIDENCE))
        .when(words > 3, F.lit(0.85))
        .when(contains_any(K.LEAKED_BRANDS), F.lit(0.75))
        .when(contains_any(K.LEAKED_UNITS), F.lit(0.80))
        .when(F.length(label) < 3, F.lit(0.85))
        .otherwise(F.lit(K.LABEL_BASE_CONFIDENCE))
    )
    return F.greatest(score, F.lit(K.LABEL_MIN_CONFIDENCE)).cast("decimal(3,2)")


def answer_class(text: Column) -> Column:
    """Class named in a free-text answer: a full label first, then a stem, else ``unknown``."""
    low = F.lower(text)

    def has(*parts: str) -> Column:
        return low.rlike("|".join(parts))

    return (
        F.when(has("identical"), "identical")
        .when(has("similar"), "similar")
        .when(has("alternative"), "alternative")
        .when(has("no_match"), "no_match")
        .when(has("ident", "same"), "identical")
        .when(has("simil", "variant"), "similar")
        .when(has("altern", "different brand"), "alternative")
        .when(has("no"), "no_match")
        .otherwise("unknown")
    )
