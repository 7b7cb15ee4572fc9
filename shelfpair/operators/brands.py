"""Pairs of different brands with a high indel ratio, without comparing all brands.

A ratio of at least t means at least ``t/2 * (len a + len b)`` characters in common, counted with
repetition. Each brand is written as a set of numbered characters (``a1``, ``a2``, ...) in one fixed
order. Two sets with that much overlap share at least two members of their leading parts, so brands
meet only on a common two-member key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from shelfpair.functions.similarity import character_masks, indel_ratio
from shelfpair.operators.pairing import pair_within


def numbered_characters(text: str) -> str:
    """SQL expression for members such as ``2a`` (second a), repeated characters first as they are rarer."""
    seen = f"substring({text}, 1, i + 1)"
    nth = f"length({seen}) - length(replace({seen}, c, ''))"
    return (
        f"transform(array_sort(transform(split({text}, ''), (c, i) -> struct(-({nth}) AS o, c AS c))), "
        "m -> concat(CAST(-m.o AS STRING), m.c))"
    )


def leading_members(text: str, ratio: float) -> str:
    """SQL expression for the part of a brand that must hold two common members."""
    needed = f"CAST(ceil(length({text}) * {ratio / (2.0 - ratio)!r}D - 1e-9D) AS INT)"
    return f"slice({numbered_characters(text)}, 1, length({text}) - {needed} + 2)"


PAIRS_OF_LEAD = "flatten(transform(lead, (m, i) -> transform(slice(lead, i + 2, size(lead)), n -> concat(m, '+', n))))"


def near_brands(brands: DataFrame, ratio: float) -> DataFrame:
    """(brand_1, brand_2, ratio) of distinct brands, smaller text first. Input: one column ``brand``.

    A brand of one character cannot reach a ratio above 2/3 with another brand; ``ratio`` must be larger.
    """
    if ratio <= 2.0 / 3.0:
        raise ValueError("the pruning holds for ratios above 2/3")
    keyed = (
        brands.filter("brand <> 'unknown' AND length(brand) >= 2")
        .selectExpr("brand", f"{character_masks('brand')} AS masks", f"{leading_members('brand', ratio)} AS lead")
        .selectExpr("brand", "masks", f"{PAIRS_OF_LEAD} AS keys")
        .selectExpr("*", "explode(keys) AS key")
    )

    def near(a, b) -> str:
        x, y = a("brand"), b("brand")
        longest = f"2D * least(length({x}), length({y})) / (length({x}) + length({y}))"
        first_common = f"get(array_intersect({a('keys')}, {b('keys')}), 0) = key"
        return f"{longest} >= {ratio}D AND {first_common} AND {indel_ratio(x, y, a('masks'))} >= {ratio}D"

    pairs = pair_within(keyed, ["key"], "brand", near)
    return pairs.selectExpr("brand_1", "brand_2", f"{indel_ratio('brand_1', 'brand_2', 'masks_1')} AS ratio")
