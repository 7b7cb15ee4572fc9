"""Runs that ask a model for pairs and keep the stored pairs up to date."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfpair import constants as K
from shelfpair.functions.inference import TextFunction, ask, ask_cached
from shelfpair.functions.prompts import PAIR_SYSTEM, pair_prompts
from shelfpair.operators import blocking, merging, parsing
from shelfpair.operators.batching import batches_with_ids, pair_batches
from shelfpair.operators.blocking import BLOCK
from shelfpair.session import stored

BATCH = [*BLOCK, "batch_id"]
PAIR_COLUMNS = ["source_product_id", "target_product_id", "equivalence_type", "similarity_score"]


@dataclass
class RunResult:
    parsed: DataFrame  # valid pairs per answer: block, batch_id, line_no, ids, class, score
    merged: DataFrame | None  # new pair table with an action column; None for a dry run
    cache: DataFrame | None = None  # answers by prompt, with the new ones; None if no cache was given


def answered_pairs(
    batched: DataFrame, members: DataFrame, answer: TextFunction, cache: DataFrame | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """Ask once per batch and read the pairs between ``members``; batches without an answer are skipped.

    The answers are stored before they are read, so no batch is asked twice. With a ``cache`` of earlier
    answers only new prompts are asked; the cache with the new answers comes back too.
    """
    prompts = pair_prompts(batched).select(*BATCH, "prompt")
    if cache is None:
        replies, renewed = stored(ask(prompts, answer, system=PAIR_SYSTEM).drop("prompt")), None
    else:
        replies, renewed = ask_cached(prompts, answer, cache, PAIR_SYSTEM)
    replies = replies.filter(F.col("response_text").isNotNull())
    pairs = parsing.parse_pairs(replies, BATCH, members.select(*BLOCK, "id", "shop_type"), BLOCK)
    return pairs.withColumnsRenamed({"lo": "source_product_id", "hi": "target_product_id"}), renewed


def _finish(parsed: DataFrame, renewed: DataFrame | None, stored_pairs: DataFrame, dry_run: bool) -> RunResult:
    merged = None if dry_run else merging.merge_pairs(stored_pairs, parsed, [*BATCH, "line_no"])
    return RunResult(parsed, merged, renewed)


def full_run(
    products: DataFrame,
    stored_pairs: DataFrame,
    answer: TextFunction,
    batch_size: int = K.PAIR_BATCH_RUN,
    dry_run: bool = False,
    cache: DataFrame | None = None,
) -> RunResult:
    """All blocks with at least two products and two shops, in one job."""
    batched = stored(pair_batches(blocking.in_eligible_blocks(products), batch_size))
    return _finish(*answered_pairs(batched, batched, answer, cache), stored_pairs, dry_run)


def block_run(
    products: DataFrame,
    stored_pairs: DataFrame,
    block: str,
    answer: TextFunction,
    batch_size: int = K.PAIR_BATCH_RUN,
    dry_run: bool = False,
    cache: DataFrame | None = None,
) -> RunResult:
    """One block, named ``category|unit``."""
    category, unit = blocking.parse_block_argument(block)
    rows = products.filter((F.col(BLOCK[0]) == category) & (F.col(BLOCK[1]) == unit))
    return full_run(rows, stored_pairs, answer, batch_size, dry_run, cache)


def incremental_run(
    products: DataFrame,
    stored_pairs: DataFrame,
    answer: TextFunction,
    batch_size: int = K.PAIR_BATCH_RUN,
    dry_run: bool = False,
    cache: DataFrame | None = None,
    catalogue: DataFrame | None = None,
) -> RunResult:
    """Clean up, then ask only about batches that hold a product without a pair.

    Batches are numbered over the whole block. A dry run changes nothing, not even the clean-up.
    ``catalogue``: all products, when ``products`` are those of some blocks; it tells which pairs are live.
    """
    live = blocking.live_pairs(stored_pairs, products if catalogue is None else catalogue)
    unmatched = stored(blocking.unmatched_ids(products, live))
    eligible = blocking.in_eligible_blocks(products)
    affected = eligible.join(unmatched, "id", "left_semi").select(*BLOCK).distinct()
    batched = stored(pair_batches(eligible.join(affected, BLOCK, "left_semi"), batch_size))
    # Ids of the whole block are valid answers, prompts go out for the affected batches only.
    parsed, renewed = answered_pairs(batches_with_ids(batched, unmatched), batched, answer, cache)
    return _finish(parsed, renewed, live, dry_run)


def pairs_per_block(parsed: DataFrame) -> DataFrame:
    """Pairs read per block, with the total of all blocks in a row without a block."""
    per_block = parsed.groupBy(*BLOCK).agg(F.count("*").alias("pair_count"))
    total = parsed.agg(F.count("*").alias("pair_count")).select(
        *[F.lit(None).cast("string").alias(c) for c in BLOCK], "pair_count"
    )
    return per_block.unionByName(total)


def recover(logs: DataFrame, products: DataFrame, stored_pairs: DataFrame) -> RunResult:
    """Pairs named in logged answers; both ends must be active, and different."""
    found = parsing.log_pairs(parsing.log_answers(logs), ["path", "block_no"])
    found = parsing.distinct_ends(found).withColumnsRenamed({"lo": "source_product_id", "hi": "target_product_id"})
    valid = blocking.live_pairs(found, products)
    return RunResult(valid, merging.merge_pairs(stored_pairs, valid, ["path", "block_no", "line_no"]))
