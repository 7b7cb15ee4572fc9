"""Evaluation of models on sample pairs with a heuristic expectation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfpair import constants as K
from shelfpair.functions import answers, scoring, similarity, text
from shelfpair.functions.inference import TextFunction, ask
from shelfpair.functions.prompts import match_prompt
from shelfpair.operators.blocking import BLOCK, evaluation_blocks, with_block
from shelfpair.operators.ranking import top_per_group
from shelfpair.session import stored


def largest_evaluation_blocks(products: DataFrame, n: int = 2) -> DataFrame:
    return evaluation_blocks(products).orderBy(F.col("product_count").desc(), "category", "unit").limit(n)


def sample_pairs(products: DataFrame, blocks: DataFrame, per_shop: int = K.EVALUATION_PER_SHOP) -> DataFrame:
    """Pairs between the first ``per_shop`` products of every two shops of a block.

    Shops come in the order of their lowest product id.
    """
    keys = blocks.select(F.col("category").alias(BLOCK[0]), F.col("unit").alias(BLOCK[1]))
    rows = with_block(products).join(keys, BLOCK, "left_semi")
    first = top_per_group(rows, [*BLOCK, "shop_type"], [F.col("id")], per_shop, "place")
    shop_order = first.filter("place = 1").select(*BLOCK, "shop_type", F.col("id").alias("shop_place"))
    first = first.join(shop_order, [*BLOCK, "shop_type"])
    side = lambda n: first.select(
        *BLOCK,
        *[F.col(c).alias(f"{c}_{n}") for c in ("id", "title", "brand", "shop_type", "place", "shop_place")],
    )
    pairs = side("1").join(side("2"), BLOCK).filter(F.col("shop_place_1") < F.col("shop_place_2"))
    tokens = lambda n: text.white_space_tokens(text.remove_shop_prefixes(F.col(f"title_{n}")))
    return (
        pairs.withColumns({"_tokens_1": tokens("1"), "_tokens_2": tokens("2")})
        .withColumn("overlap", F.expr(similarity.text_similarity("_tokens_1", "_tokens_2")))
        .withColumn("expected", scoring.expected_class(F.col("overlap"), F.col("brand_1"), F.col("brand_2")))
        .drop("_tokens_1", "_tokens_2")
    )


def limit_pairs(
    pairs: DataFrame, most: int = K.EVALUATION_MAX_PAIRS, least: int = K.EVALUATION_MIN_PAIRS, fill: int = K.EVALUATION_FILL
) -> DataFrame:
    """At most ``most`` meaningful pairs per block; with fewer than ``least``, fill up to ``fill`` with non-matches.

    A block gives ``per_shop`` squared pairs for every two shops, so its window stays small.
    """
    empty = F.col("expected") == "no_match"
    order = [F.col(c) for c in ("shop_place_1", "shop_place_2", "place_1", "place_2")]
    rank = F.row_number().over(Window.partitionBy(*BLOCK).orderBy(empty, *order))
    meaningful = F.count_if(~empty).over(Window.partitionBy(*BLOCK))
    ranked = pairs.withColumns({"pair_rank": rank, "_meaningful": meaningful})
    few = F.col("_meaningful") < least
    keep = F.when(few, F.col("pair_rank") <= fill).otherwise(
        ~empty & (F.col("pair_rank") <= most)
    )
    return ranked.filter(keep).drop("_meaningful")


def predictions(pairs: DataFrame, models: dict[str, TextFunction]) -> DataFrame:
    """Answers of every model for every pair: model, grp, pair ids, expected, response, error.

    A model that fails is recorded with its message; the other models go on.
    """
    prompts = pairs.select(
        F.concat_ws("_", *BLOCK).alias("grp"), "id_1", "id_2", "expected",
        match_prompt(F.col("title_1"), F.col("shop_type_1"), F.col("title_2"), F.col("shop_type_2")).alias("prompt"),
    )
    parts = [
        ask(prompts, answer, out="response", error="error").drop("prompt").select(F.lit(name).alias("model"), "*")
        for name, answer in models.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def scored(answers_df: DataFrame) -> DataFrame:
    predicted = answers.answer_class(F.col("response"))
    return answers_df.withColumn("predicted", predicted).withColumn("correct", F.col("predicted") == F.col("expected"))


def accuracy(answers_df: DataFrame) -> DataFrame:
    """Per model and group: correct, total and their ratio; answers with an error are left out."""
    return (
        scored(answers_df)
        .filter(F.col("error").isNull())
        .groupBy("model", "grp")
        .agg(
            F.count_if("correct").alias("correct_count"),
            F.count("*").alias("total_pairs"),
            F.coalesce(F.avg(F.col("correct").cast("double")), F.lit(0.0)).alias("accuracy"),
        )
    )


def model_summary(answers_df: DataFrame) -> DataFrame:
    """Per model: mean of the group accuracies, totals and groups."""
    return (
        accuracy(answers_df)
        .groupBy("model")
        .agg(
            F.round(F.avg("accuracy"), 9).alias("avg_accuracy"),
            F.sum("correct_count").alias("correct_count"),
            F.sum("total_pairs").alias("total_pairs"),
            F.count("*").alias("groups_tested"),
        )
    )


def best_model(answers_df: DataFrame) -> DataFrame:
    """The model with the highest mean accuracy above 0, by name on ties."""
    return (
        model_summary(answers_df)
        .filter(F.col("avg_accuracy") > 0)
        .orderBy(F.col("avg_accuracy").desc(), "model")
        .limit(1)
        .select("model", "avg_accuracy")
    )


def errors(answers_df: DataFrame) -> DataFrame:
    return answers_df.filter(F.col("error").isNotNull()).groupBy("model", "error").agg(F.count("*").alias("error_count"))


def class_counts(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("expected").agg(F.count("*").alias("pair_count"))


def rejected_samples(pairs: DataFrame, n: int = 5) -> DataFrame:
    return pairs.filter(F.col("expected") == "no_match").orderBy("id_1", "id_2").limit(n)


def evaluate(
    products: DataFrame,
    models: dict[str, TextFunction],
    n_blocks: int = 2,
    per_shop: int = K.EVALUATION_PER_SHOP,
    most: int = K.EVALUATION_MAX_PAIRS,
) -> DataFrame:
    """Answers of all models on at most ``most`` sample pairs of each of the ``n_blocks`` largest blocks.

    Fails if the catalogue has fewer blocks that can be evaluated.
    """
    blocks = stored(largest_evaluation_blocks(products, n_blocks))
    found = blocks.count()  # at most n_blocks rows
    if found < n_blocks:
        raise ValueError(f"{n_blocks} blocks to evaluate are asked for, there are {found}")
    return predictions(limit_pairs(sample_pairs(products, blocks, per_shop), most), models)
