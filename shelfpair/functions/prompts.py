"""Prompt texts. A prompt row holds one batch, so its size is bounded by the batch size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfpair.functions.text import quantity_text
from shelfpair.operators.blocking import BLOCK

PAIR_HEADER = 'Listings of "%s", sold by %s. Which of them belong together?'
PAIR_FOOTER = "Pairs of different stores:"

LABEL_EXAMPLES = (
    'Examples: "DOVE Deo Roller Original 50 ml" -> "deo roller"; "PLUS Bio Magere Yoghurt 1L" -> "magere yoghurt"'
)

PAIR_SYSTEM = """\
Find listings of different stores that a shopper would compare. Never pair two listings of one store.
Write one pair per line as ID=ID (class) and nothing else; write nothing when there is no pair.
Classes: identical (same brand, product and size), similar (same brand, other variant),
alternative (other brand, same kind of product)."""

GUIDANCE_DEFAULT = "Drogisterij"
GUIDANCE = {
    "Drogisterij": "Personal care and health: tell product forms apart, such as scheerschuim, haarlak, mondwater, wattenschijfjes.",
    "Zuivel": "Dairy: keep fat content and ripeness, such as karnemelk, magere kwark, belegen plakken.",
    "Vlees": "Meat and fish: keep the animal and the preparation, such as lamsbout, gerookte makreel, kalkoenreepjes.",
    "Brood & Gebak": "Bread and pastry: keep the grain or kind, such as roggebolletjes, krentenwegge.",
}


def product_line(product_id, shop, brand, title, amount, unit) -> Column:
    return F.format_string(
        "[%s] %s | %s | %s | %s", product_id.cast("string"), shop, brand, title, quantity_text(amount, unit)
    )


def _ordered_lines(line: Column) -> Column:
    """Lines of a batch in order; a batch is bounded by its size."""
    return F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("position", line.alias("line")))), lambda s: s["line"]), "\n"
    )


def pair_prompts(batched: DataFrame) -> DataFrame:
    """One prompt per batch of a block."""
    line = product_line(
        F.col("id"),
        F.col("shop_type"),
        F.coalesce("brand", F.lit("")),
        F.coalesce("title", F.lit("")),
        F.coalesce("normalized_quantity_amount", F.lit(0.0)),
        F.coalesce("normalized_quantity_unit", F.lit("")),
    )
    body = batched.groupBy(*BLOCK, "batch_id").agg(_ordered_lines(line).alias("lines"), F.count("*").alias("size"))
    header = F.format_string(PAIR_HEADER, BLOCK[0], BLOCK[1])
    return body.select(
        *BLOCK,
        "batch_id",
        "size",
        F.concat_ws("\n", header, F.col("lines"), F.lit(""), F.lit(PAIR_FOOTER)).alias("prompt"),
    )


def guidance(category: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in GUIDANCE.items() for x in pair])
    return F.coalesce(known[category], F.lit(GUIDANCE[GUIDANCE_DEFAULT]))


def label_prompts(batched: DataFrame, batch_size: int) -> DataFrame:
    """One prompt per label batch with the guidance of its category and numbered titles."""
    number = (F.col("position") % batch_size + 1).cast("string")
    line = F.concat(number, F.lit(". "), F.coalesce("title", F.lit("")))
    body = batched.groupBy("main_category", "batch_id").agg(
        _ordered_lines(line).alias("lines"), F.count("*").alias("size")
    )
    return body.select(
        "main_category",
        "batch_id",
        "size",
        F.format_string(
            "Name the core product of each Dutch %s listing in one to three lower-case words, "
            "without brand, quantity and advertising words.\n%s\n"
            "%s\n%s\n"
            "Return exactly %s lines, one per listing, without numbers:",
            F.coalesce("main_category", F.lit("")),
            guidance(F.col("main_category")),
            F.lit(LABEL_EXAMPLES),
            F.col("lines"),
            F.col("size").cast("string"),
        ).alias("prompt"),
    )


def match_prompt(title_a, shop_a, title_b, shop_b) -> Column:
    """Prompt about two listings; the answer is one class name."""
    return F.format_string(
        'Compare two supermarket products.\nA: "%s" (%s)\nB: "%s" (%s)\n'
        "Answer with one word: identical, similar, alternative or no_match.",
        F.coalesce(title_a, F.lit("Unknown")),
        F.coalesce(shop_a, F.lit("Unknown")),
        F.coalesce(title_b, F.lit("Unknown")),
        F.coalesce(shop_b, F.lit("Unknown")),
    )


def candidate_prompts(candidates: DataFrame, per_prompt: int = 20) -> DataFrame:
    """Prompts for (source, candidate) rows; each holds at most ``per_prompt`` candidates of a source.

    All candidates are asked about: a source with more of them gets several prompts.
    """
    line = F.concat(
        F.col("candidate_id").cast("string"), F.lit(": "), F.col("candidate_shop"), F.lit(" | "),
        F.coalesce("candidate_brand", F.lit("")), F.lit(" | "), F.coalesce("candidate_title", F.lit("")),
    )
    chunk = F.floor(F.col("position") / per_prompt).cast("bigint").alias("prompt_no")
    body = candidates.groupBy("source_id", chunk).agg(
        F.min("source_text").alias("source_text"), _ordered_lines(line).alias("lines")
    )
    return body.select(
        "source_id",
        "prompt_no",
        F.format_string(
            "Source: %s\nCandidates:\n%s\nWhich candidates would a shopper compare with the source? Answer in JSON: "
            '{"matches": [{"candidate_id": int, "confidence": float, "reasoning": str}]}',
            "source_text",
            "lines",
        ).alias("prompt"),
    )
