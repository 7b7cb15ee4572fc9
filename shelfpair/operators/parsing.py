"""Pairs and labels out of raw answers and run logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfpair import constants as K
from shelfpair.functions import answers
from shelfpair.functions.text import strip
from shelfpair.operators.ranking import first_per_key


def pair_lines(responses: DataFrame, keys: list[str], newline_only: bool = False) -> DataFrame:
    """One row per line that names two ids and a known class: keys, line_no, id_a, id_b, class, score."""
    text = F.col("response_text")
    split = F.split(text, "\n") if newline_only else answers.lines(text)
    lines = responses.select(*keys, F.posexplode(split).alias("line_no", "line"))
    part = lambda n: F.regexp_extract("line", K.PAIR_PATTERN, n)
    return (
        lines.select(
            *keys,
            F.col("line_no").cast("bigint").alias("line_no"),
            part(1).try_cast("bigint").alias("id_a"),
            part(2).try_cast("bigint").alias("id_b"),
            answers.pair_label(part(3)).alias("equivalence_type"),
        )
        .filter("id_a IS NOT NULL AND id_b IS NOT NULL AND equivalence_type IS NOT NULL")
        .withColumn("similarity_score", answers.pair_score(F.col("equivalence_type")))
    )


def canonical(pairs: DataFrame, a: str = "id_a", b: str = "id_b") -> DataFrame:
    """Replace the two ids by ``lo`` and ``hi``."""
    rest = [c for c in pairs.columns if c not in (a, b)]
    return pairs.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"), *rest)


def distinct_ends(pairs: DataFrame) -> DataFrame:
    """Pairs (lo, hi) of two different ids."""
    return pairs.filter(F.col("lo") != F.col("hi"))


def first_of_each_pair(pairs: DataFrame, order: list[str], within: list[str] | None = None) -> DataFrame:
    return first_per_key(pairs, [*(within or []), "lo", "hi"], order)


def valid_cross_shop(lines: DataFrame, members: DataFrame, group: list[str]) -> DataFrame:
    """Lines whose two ids belong to the group of the answer and to different shops.

    ``members``: the group columns, ``id`` and ``shop_type``; ids are unique in a group.
    """
    side = lambda name, shop: members.select(*group, F.col("id").alias(name), F.col("shop_type").alias(shop))
    return (
        lines.join(side("id_a", "_shop_a"), [*group, "id_a"])
        .join(side("id_b", "_shop_b"), [*group, "id_b"])
        .filter(~F.col("_shop_a").eqNullSafe(F.col("_shop_b")))
        .select(*lines.columns)
    )


def parse_pairs(responses: DataFrame, keys: list[str], members: DataFrame, group: list[str]) -> DataFrame:
    """Validated pairs, once per answer: keys, line_no, lo, hi, class, score."""
    valid = valid_cross_shop(pair_lines(responses, keys), members, group)
    return first_of_each_pair(canonical(valid), ["line_no"], keys)


def log_answers(logs: DataFrame) -> DataFrame:
    """Distinct answers kept in run logs (path, place, value: see ``read_logs``), at their first place.

    An answer ends before the first empty line and before the first line of the log itself. Its first line is not empty.
    """
    head = F.regexp_extract("value", K.LOG_HEAD, 0)
    lines = F.split(F.substr("value", F.length(head) + 1), "\n", -1)
    ends = F.transform("lines", lambda line, k: (k > 0) & ((line == "") | line.contains(K.LOG_LEVEL)))
    found = (
        logs.filter(head != "")
        .select("path", F.col("place").alias("block_no"), lines.alias("lines"))
        .withColumn("stop", F.array_position(ends, True))
        .filter(F.get("lines", F.lit(0)) != "")
    )
    kept = F.when(F.col("stop") > 0, F.slice("lines", F.lit(1), F.col("stop").cast("int") - 1)).otherwise(F.col("lines"))
    answers_only = found.select("path", "block_no", strip(F.array_join(kept, "\n")).alias("response_text"))
    return first_per_key(answers_only, ["response_text"], ["path", "block_no"])


def log_pairs(responses: DataFrame, order: list[str]) -> DataFrame:
    """Pairs named in logged answers, first mention of each; there is no shop check here."""
    found = pair_lines(responses, order, newline_only=True)
    return first_of_each_pair(canonical(found), [*order, "line_no"])


def label_rows(batches: DataFrame, responses: DataFrame, keys: list[str]) -> DataFrame:
    """A label and a confidence for every product of every batch.

    ``batches``: keys, id and slot (0-based place in the batch). A batch without an answer gets the
    default label; a dropped line moves the later lines up, as answers are aligned by position.
    """
    sizes = batches.groupBy(*keys).agg(F.count("*").cast("int").alias("_size"))
    labels = sizes.join(responses.select(*keys, "response_text"), keys, "left").select(
        *keys,
        F.posexplode(
            answers.align_labels(
                F.coalesce(answers.label_lines(F.col("response_text")), F.array().cast("array<string>")), F.col("_size")
            )
        ).alias("slot", "essence"),
    )
    return batches.join(labels, [*keys, "slot"]).select(
        *batches.columns, "essence", answers.label_confidence(F.col("essence")).alias("confidence")
    )
