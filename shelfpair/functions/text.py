"""Column expressions over brands, titles and quantities."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfpair import constants as K


def _any_word(words: list[str]) -> str:
    return "|".join(words)


def strip(text: Column) -> Column:
    """Remove all leading and trailing white space, not only blanks."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def brand_key(brand: Column) -> Column:
    return F.lower(strip(F.coalesce(brand, F.lit(""))))


def normalize_brand(brand: Column) -> Column:
    """Lower-case letters and digits only; NULL becomes ``unknown``.

    One spelling repair survives the removal of punctuation: a missing final n in the
    two-word form of one brand.
    """
    repaired = F.regexp_replace(F.lower(brand), r"dr\.? beckmann?", "drbeckmann")
    return F.when(brand.isNull(), F.lit("unknown")).otherwise(F.regexp_replace(repaired, "[^a-z0-9]", ""))


def title_without_shops(title: Column) -> Column:
    pattern = rf"(?U)\b({_any_word(K.SHOP_WORDS)})\b"
    return F.regexp_replace(F.lower(F.coalesce(title, F.lit(""))), pattern, "")


def title_terms(title: Column) -> Column:
    """Distinct words of two or more letters a-z, without shop names and stop words."""
    words = F.regexp_extract_all(title_without_shops(title), F.lit(r"(?U)\b[a-z]{2,}\b"), F.lit(0))
    return F.array_distinct(F.filter(words, lambda w: ~w.isin(K.STOP_WORDS)))


def is_diet(title: Column) -> Column:
    return F.coalesce(F.lower(title), F.lit("")).rlike(_any_word(K.DIET_WORDS))


def is_bio(title: Column) -> Column:
    return F.coalesce(F.lower(title), F.lit("")).rlike(_any_word(K.BIO_WORDS))


def remove_shop_prefixes(title: Column) -> Column:
    """Delete ``shop + blank`` anywhere in the lower-case title, shop by shop."""
    return reduce(
        lambda text, shop: F.replace(text, F.lit(f"{shop} "), F.lit("")),
        K.SHOP_WORDS,
        F.lower(F.coalesce(title, F.lit(""))),
    )


def white_space_tokens(text: Column) -> Column:
    """Distinct tokens between runs of white space."""
    return F.array_distinct(F.filter(F.split(text, r"(?U)\s+"), lambda w: w != ""))


def quantity_text(amount: Column, unit: Column) -> Column:
    return F.concat(amount.cast("string"), unit)


def embedding_text(brand_norm, title_clean, category, amount, unit, bio, diet) -> Column:
    """Description to embed, built from normalised features; missing parts are skipped."""
    return F.concat_ws(
        " ",
        brand_norm,
        F.when(strip(title_clean) != "", title_clean),
        category,
        quantity_text(amount, unit),
        F.when(bio, F.lit("biologisch")),
        F.when(diet, F.lit("zero diet")),
    )


def embedding_text_plain(brand, title, category, amount, unit) -> Column:
    """Description to embed, built from the raw listing."""
    return F.concat_ws(" ", brand, title, category, quantity_text(amount, unit))


def normal_quantity(amount: Column, unit: Column) -> Column:
    """``1.5 l`` and ``1500 ml`` both become ``1500ml``; unknown units stay as they are."""
    key = F.lower(unit)
    base = F.create_map(*[F.lit(x) for u, (b, _) in K.UNIT_BASE.items() for x in (u, b)])
    factor = F.create_map(*[F.lit(x) for u, (_, f) in K.UNIT_BASE.items() for x in (u, f)])
    value = F.round(amount * F.coalesce(factor[key], F.lit(1.0)), 3)
    whole = value == F.floor(value)
    number = F.when(whole, value.cast("bigint").cast("string")).otherwise(value.cast("string"))
    return F.concat(number, F.coalesce(base[key], key))


def fingerprint(brand: Column, title: Column, amount: Column, unit: Column) -> Column:
    """``brand|sorted terms joined by +|quantity``, with the brand's own words left out of the terms."""
    brand_norm = normalize_brand(brand)
    terms = F.filter(title_terms(title), lambda w: w != brand_norm)
    return F.concat_ws(
        "|",
        brand_norm,
        F.array_join(F.array_sort(terms), "+"),
        F.coalesce(normal_quantity(amount, unit), F.lit("")),
    )


def short_title(title: Column, limit: int = 50, keep: int = 47) -> Column:
    return F.when(F.length(title) > limit, F.concat(F.substring(title, 1, keep), F.lit("..."))).otherwise(title)


def block_key(category: Column, unit: Column) -> Column:
    """One non-null key per (category, unit), NULLs included, without collisions."""
    return F.to_json(F.array(category, unit))


def exact_round(value: Column, digits: int) -> Column:
    """Round the exact binary value, ties to even, for values above the last kept digit."""
    return F.replace(F.format_number(value, digits), F.lit(","), F.lit("")).cast("double")

