"""Synthetic sibling listings of another shop, for trial runs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Words that a varied title says differently.
VARIANTS = [("zero", "suikervrij"), ("biologisch", "bio"), ("small", "mini"), ("large", "maxi"), ("blue", "blauw")]
ID_OFFSET = 10_000_000


def first_of_shop(products: DataFrame, shop: str, n: int) -> DataFrame:
    return products.filter(F.col("shop_type") == shop).orderBy("id").limit(n)


def make_siblings(products: DataFrame, shop: str, sibling_shop: str) -> DataFrame:
    """The same listings under another shop: new id, shop name swapped, 3 in 10 titles varied, price +-10 %.

    The choice depends on the id only, so a repeated run gives the same rows.
    """
    swapped = F.replace(F.col("title"), F.lit(f"{shop} "), F.lit(f"{sibling_shop} "))
    variant = F.pmod(F.floor(F.col("id") / 10), F.lit(len(VARIANTS)))
    varied = reduce(
        lambda expr, item: F.when(variant == item[0], F.replace(swapped, F.lit(item[1][0]), F.lit(item[1][1]))).otherwise(expr),
        enumerate(VARIANTS),
        swapped,
    )
    factor = (F.pmod(F.col("id") * 37, F.lit(201)) + 900) / 1000.0
    return products.withColumns(
        {
            "title": F.when(F.pmod(F.col("id"), F.lit(10)) < 3, varied).otherwise(swapped),
            "shop_type": F.lit(sibling_shop),
            "current_price": F.round(F.col("current_price") * factor, 2),
            "id": F.col("id") + ID_OFFSET,
        }
    )


def shop_sample(catalogue: DataFrame, shop: str, n: int = 5) -> DataFrame:
    """The first listings of a shop with title and price, for a look at the trial rows."""
    return first_of_shop(catalogue, shop, n).select("id", "title", "current_price")


def sibling_catalogue(products: DataFrame, shop: str = "AH", sibling_shop: str = "PLUS", take: int = 200, copies: int = 50) -> DataFrame:
    """The first listings of a shop together with siblings of some of them."""
    own = first_of_shop(products, shop, take)
    return own.unionByName(make_siblings(first_of_shop(own, shop, copies), shop, sibling_shop))
