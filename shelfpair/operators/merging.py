"""Merges into and deletions from stored tables.

A merge returns the new table with an ``action`` column; the caller writes it as a new snapshot.
Where the table format has MERGE INTO, the same rules can be given to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from shelfpair.functions.text import strip
from shelfpair.operators.blocking import live_pairs

PAIR_KEY = ["source_product_id", "target_product_id"]
PAIR_VALUES = ["equivalence_type", "similarity_score"]


def best_incoming(pairs: DataFrame, order: list[str]) -> DataFrame:
    """One row per unordered pair: best score, then first by ``order``."""
    rank = F.struct((-F.col("similarity_score")).alias("neg"), *[F.col(c) for c in order])
    best = pairs.groupBy(
        F.least(*PAIR_KEY).alias(PAIR_KEY[0]), F.greatest(*PAIR_KEY).alias(PAIR_KEY[1])
    ).agg(F.min_by(F.struct(*PAIR_VALUES), rank).alias("_best"))
    return best.select(*PAIR_KEY, "_best.*")


def merge_pairs(stored_pairs: DataFrame, incoming: DataFrame, order: list[str], now: Column | None = None) -> DataFrame:
    """Insert new pairs; replace a stored pair only by a strictly better score."""
    now = F.current_timestamp() if now is None else now
    new = best_incoming(incoming, order)
    s, n = stored_pairs.alias("s"), new.alias("n")
    on = [F.col(f"s.{k}") == F.col(f"n.{k}") for k in PAIR_KEY]
    action = (
        F.when(F.col(f"s.{PAIR_KEY[0]}").isNull(), "inserted")
        .when(F.col("n.similarity_score") > F.col("s.similarity_score"), "updated")
        .otherwise("unchanged")
    )
    changed = F.col("action") != "unchanged"
    return (
        s.join(n, on, "full")
        .withColumn("action", action)
        .select(
            *[F.coalesce(f"s.{k}", f"n.{k}").alias(k) for k in PAIR_KEY],
            *[F.when(changed, F.col(f"n.{c}")).otherwise(F.col(f"s.{c}")).alias(c) for c in PAIR_VALUES],
            F.coalesce("s.created_at", now).alias("created_at"),
            F.when(changed, now).otherwise(F.col("s.updated_at")).alias("updated_at"),
            "action",
        )
    )


def write_counted(merged: DataFrame, path: str) -> dict[str, int]:
    """Writes a merged table without its ``action`` as Parquet and returns the rows of each action.

    The counts are taken from the rows as they are written, so the merge runs once.
    """
    watch = Observation()
    names = ("inserted", "updated", "unchanged")
    counts = [F.count_if(F.col("action") == name).alias(name) for name in names]
    merged.observe(watch, *counts).drop("action").write.parquet(path)
    return {name: watch.get[name] for name in names}


def written(merged: DataFrame) -> DataFrame:
    """Rows per action; inserted + updated is the number of rows written."""
    return merged.groupBy("action").agg(F.count("*").alias("rows"))


def merge_labels(stored_labels: DataFrame, incoming: DataFrame, order: list[str], now: Column | None = None) -> DataFrame:
    """Insert or replace labels by product; of several incoming rows the last by ``order`` wins."""
    now = F.current_timestamp() if now is None else now
    values = ["essence", "confidence", "model_version", "processing_time_ms"]
    cleaned = incoming.withColumn("essence", F.lower(strip(F.col("essence"))))
    last = cleaned.groupBy("product_id").agg(F.max_by(F.struct(*values), F.struct(*order)).alias("_last"))
    new = last.select("product_id", "_last.*", F.lit(True).alias("_new"))
    s, n = stored_labels.alias("s"), new.alias("n")
    is_new = F.col("n._new").isNotNull()
    action = (
        F.when(F.col("s.product_id").isNull(), "inserted").when(is_new, "updated").otherwise("unchanged")
    )
    return s.join(n, F.col("s.product_id") == F.col("n.product_id"), "full").select(
        F.coalesce("s.product_id", "n.product_id").alias("product_id"),
        *[F.when(is_new, F.col(f"n.{c}")).otherwise(F.col(f"s.{c}")).alias(c) for c in values],
        F.when(is_new, now).otherwise(F.col("s.created_at")).alias("created_at"),
        F.col("s.notes").alias("notes"),
        action.alias("action"),
    )


def clean_up(pairs: DataFrame, products: DataFrame) -> DataFrame:
    """Pairs that stay after removal of pairs with an inactive or unknown end."""
    return live_pairs(pairs, products)


def _with_live_ends(pairs: DataFrame, products: DataFrame) -> tuple[DataFrame, Column]:
    """The pairs with a mark for either active end, and the condition that both are."""
    ids = products.filter("is_active").select("id")
    left = ids.select(F.col("id").alias("source_product_id"), F.lit(True).alias("_s"))
    right = ids.select(F.col("id").alias("target_product_id"), F.lit(True).alias("_t"))
    marked = pairs.join(left, "source_product_id", "left").join(right, "target_product_id", "left")
    return marked, F.col("_s").isNotNull() & F.col("_t").isNotNull()


def _clean_up_totals(both: Column) -> list[Column]:
    return [F.count("*").alias("before"), F.count_if(both).alias("kept"), F.count_if(~both).alias("removed")]


def clean_up_counts(pairs: DataFrame, products: DataFrame) -> DataFrame:
    """One row: pairs before, kept and removed, in one pass over the pairs."""
    marked, both = _with_live_ends(pairs, products)
    return marked.agg(*_clean_up_totals(both))


def write_cleaned(pairs: DataFrame, products: DataFrame, path: str) -> dict[str, int]:
    """Writes the pairs that stay as Parquet and returns the numbers of :func:`clean_up_counts`, taken on the way."""
    marked, both = _with_live_ends(pairs, products)
    watch = Observation()
    marked.observe(watch, *_clean_up_totals(both)).filter(both).select(*pairs.columns).write.parquet(path)
    return {name: watch.get[name] for name in ("before", "kept", "removed")}


def apply_decisions(queue: DataFrame, decisions: DataFrame) -> DataFrame:
    """Status of queued matches after review; a match without a decision stays in the queue.

    ``decisions``: the pair key and ``decision`` (approve, reject or defer), one row per pair.
    """
    status = (
        F.when(F.col("decision") == "approve", "approved")
        .when(F.col("decision") == "reject", "rejected")
        .when(F.col("decision") == "defer", "deferred")
        .otherwise("queued")
    )
    return queue.join(decisions, PAIR_KEY, "left").withColumn("status", status).drop("decision")
