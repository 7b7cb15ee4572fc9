"""Labelling products with a model, category by category or all at once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfpair import constants as K
from shelfpair.functions.inference import TextFunction, ask
from shelfpair.functions.prompts import label_prompts
from shelfpair.operators import merging, parsing
from shelfpair.operators.batching import first_batches, id_batches
from shelfpair.plans import reports
from shelfpair.session import stored

BATCH = ["main_category", "batch_id"]


@dataclass
class LabelResult:
    rows: DataFrame  # product rows of the batches with label and confidence
    merged: DataFrame | None  # new label table with an action column; None for a preview


def label_products(
    products: DataFrame,
    labels: DataFrame,
    answer: TextFunction,
    category: str | None = None,
    limit: int = 0,
    offset: int = 0,
    preview: bool = False,
    model_version: str = "model",
    batch_size: int = K.LABEL_BATCH,
) -> LabelResult:
    """Label what has no label yet; a preview asks for the first batch only and stores nothing."""
    todo = reports.unlabelled(products.filter(F.col("main_category").isNotNull()), labels, category)
    if limit:
        todo = reports.page(todo, limit, offset)
    batched = first_batches(todo, batch_size) if preview else id_batches(todo, batch_size)
    batched = stored(batched.withColumn("slot", (F.col("position") % batch_size).cast("int")))
    prompts = label_prompts(batched, batch_size).select(*BATCH, "prompt")
    replies = stored(ask(prompts, answer, millis="processing_time_ms").drop("prompt"))
    rows = parsing.label_rows(batched, replies, BATCH)
    if preview:
        return LabelResult(rows, None)
    timed = rows.join(replies.select(*BATCH, "processing_time_ms"), BATCH)
    incoming = timed.select(
        F.col("id").alias("product_id"),
        "essence",
        "confidence",
        F.lit(model_version).alias("model_version"),
        "processing_time_ms",
    )
    return LabelResult(rows, merging.merge_labels(labels, incoming, ["product_id"]))
