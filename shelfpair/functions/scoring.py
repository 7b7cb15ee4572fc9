"""Scores, classes and actions. Pair scores are SQL expressions, the rest are columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfpair import constants as K

def _holds(condition: Column) -> Column:
    """A comparison with a missing value does not hold."""
    return F.coalesce(condition, F.lit(False))


def rule_score(brand: str, terms: str, size: str, features: str) -> str:
    """Weighted sum as a SQL expression; the order of the additions is part of the result."""
    return (
        f"({brand} * {K.WEIGHT_BRAND}D + {terms} * {K.WEIGHT_TERMS}D + {size} * {K.WEIGHT_SIZE}D"
        f" + {features} * {K.WEIGHT_FEATURES}D)"
    )


def classify(brand: str, terms: str, size: str, score: str, same_category: str, same_unit: str) -> str:
    """Class of a pair as a SQL expression.

    The order of the branches matters and the unrounded score is compared. A comparison with a
    missing value does not hold, as CASE takes the next branch.
    """
    same_block = f"({same_category} AND {same_unit})"
    return f"""CASE
        WHEN {brand} >= {K.IDENTICAL_BRAND}D AND {score} >= {K.IDENTICAL_SCORE}D AND {same_block}
            AND {size} >= {K.IDENTICAL_SIZE}D THEN 'identical'
        WHEN ({brand} >= {K.SIMILAR_BRAND}D AND {score} >= {K.SIMILAR_SCORE}D)
            OR ({score} >= {K.SIMILAR_SCORE_ALONE}D AND {same_block}) THEN 'similar'
        WHEN {brand} < {K.SIMILAR_BRAND}D AND {same_block} AND {score} >= {K.ALTERNATIVE_SCORE}D
            AND {terms} >= {K.ALTERNATIVE_TERMS}D THEN 'alternative'
        ELSE 'no_match' END"""


def reason(kind: str, brand: str, terms: str, size: str, score: str, same_category: str) -> str:
    """Explanation of a class as a SQL expression: two decimals, truth values with a capital.

    format_number rounds the exact binary value, ties to even.
    """
    b, t, z, x = (f"format_number({v}, 2)" for v in (brand, terms, size, score))
    truth = f"initcap(CAST({same_category} AS STRING))"
    return f"""CASE {kind}
        WHEN 'identical' THEN format_string('Brand:%s, Sim:%s, Terms:%s, Size:%s', {b}, {x}, {t}, {z})
        WHEN 'similar' THEN format_string('Brand:%s, Sim:%s, Category:%s, Size:%s', {b}, {x}, {truth}, {z})
        WHEN 'alternative' THEN format_string('DiffBrand, SameCat, Sim:%s, Terms:%s, Size:%s', {x}, {t}, {z})
        ELSE format_string('NoMatch: Brand:%s, Sim:%s, Category:%s', {b}, {x}, {truth}) END"""


def title_class(same_brand: Column, same_title: Column, same_size: Column, overlap: Column, same_category: Column) -> Column:
    """Preset used for analysis by hand: thresholds on title overlap only."""
    return (
        F.when(_holds(same_brand & same_title & same_size), "identical")
        .when(_holds(same_brand & (overlap >= 0.7)), "similar")
        .when(_holds(~same_brand & (overlap >= 0.5) & same_category), "alternative")
        .otherwise("no_match")
    )


def expected_class(overlap: Column, brand_a: Column, brand_b: Column) -> Column:
    """Heuristic label of an evaluation pair from title overlap and raw brand."""
    a = F.lower(F.coalesce(brand_a, F.lit("")))
    b = F.lower(F.coalesce(brand_b, F.lit("")))
    return (
        F.when(overlap > K.EXPECTED_IDENTICAL, "identical")
        .when((a != "") & (a == b) & (overlap > K.EXPECTED_SIMILAR), "similar")
        .when(overlap > K.EXPECTED_ALTERNATIVE, "alternative")
        .otherwise("no_match")
    )


def confidence_action(confidence: Column) -> Column:
    return (
        F.when(confidence >= K.ACTION_APPROVE, "approve")
        .when(confidence >= K.ACTION_LOG, "approve_log")
        .when(confidence >= K.ACTION_REVIEW, "review")
        .otherwise("reject")
    )


def score_band(score: Column) -> Column:
    return F.when(score >= 0.7, "high").when(score >= 0.5, "medium").otherwise("low")


def price_coherent(price_a, amount_a, price_b, amount_b, spread: float = 3.0) -> Column:
    """Unit prices within a factor ``spread`` of each other; missing or zero amounts are not coherent."""
    ratio = F.try_divide(F.try_divide(price_a, amount_a), F.try_divide(price_b, amount_b))
    return _holds((ratio >= 1.0 / spread) & (ratio <= spread))


def size_in_range(amount_a, amount_b, ratio: float = 0.5) -> Column:
    small, large = F.least(amount_a, amount_b), F.greatest(amount_a, amount_b)
    return _holds((large == small) | (F.try_divide(small, large) >= ratio))
