"""Similarity measures as Spark SQL expressions.

Every function takes SQL expressions (usually column names) and returns one, for use in
``F.expr``, ``filter`` or ``selectExpr``: a long expression costs a single parse, and the same text
serves as a join condition and as a column.
"""

from __future__ import annotations

MASK_BITS = 62  # longest text handled by one BIGINT; longer texts use the table method


def token_overlap(a: str, b: str) -> str:
    """Jaccard overlap of two distinct-token arrays; two empty arrays give 0."""
    common = f"size(array_intersect({a}, {b}))"
    return f"({common} / CAST(greatest(size({a}) + size({b}) - {common}, 1) AS DOUBLE))"


def overlap_at_least(a: str, b: str, tenths: int) -> str:
    """Condition ``token_overlap >= tenths / 10`` in whole numbers, for non-empty arrays."""
    return f"({10 + tenths} * size(array_intersect({a}, {b})) >= {tenths} * (size({a}) + size({b})))"


def size_similarity(a: str, b: str) -> str:
    """``1 - |a-b| / max(a,b)``; equal amounts give 1, also when both are 0."""
    return f"(CASE WHEN {a} = {b} THEN 1D ELSE 1D - try_divide(abs({a} - {b}), greatest({a}, {b})) END)"


def feature_agreement(bio_a: str, bio_b: str, diet_a: str, diet_b: str) -> str:
    return f"(IF({bio_a} = {bio_b}, 0.5D, 0D) + IF({diet_a} = {diet_b}, 0.5D, 0D))"


def character_masks(text: str) -> str:
    """Map character -> bit mask of its positions; precompute it once per distinct text."""
    chars = f"IF(length({text}) BETWEEN 1 AND {MASK_BITS}, split({text}, ''), NULL)"
    mask = f"aggregate(transform({chars}, (x, i) -> IF(x = c, shiftleft(1L, i), 0L)), 0L, (m, x) -> m | x)"
    return f"map_from_entries(transform(array_distinct({chars}), c -> struct(c, {mask})))"


def common_length(a: str, b: str, masks_a: str | None = None) -> str:
    """Length of the longest common subsequence.

    Short texts: bit-parallel row updates, one step per character of ``b``. Long texts: one row of
    the comparison table at a time.
    """
    masks = masks_a or character_masks(a)
    full = f"(shiftleft(1L, length({a})) - 1L)"
    steps = f"transform(split({b}, ''), c -> coalesce(try_element_at({masks}, c), 0L))"
    by_masks = f"length({a}) - bit_count(aggregate({steps}, {full}, (v, m) -> ((v + (v & m)) | (v & ~m)) & {full}))"
    next_row = (
        f"aggregate(sequence(1, length({b})), array(0), (r, j) -> concat(r, array("
        f"IF(substring({b}, j, 1) = ca, get(p, j - 1) + 1, greatest(get(p, j), get(r, j - 1))))))"
    )
    by_table = f"element_at(aggregate(split({a}, ''), array_repeat(0, length({b}) + 1), (p, ca) -> {next_row}), -1)"
    return (
        f"(CASE WHEN length({a}) = 0 OR length({b}) = 0 THEN 0 "
        f"WHEN length({a}) <= {MASK_BITS} THEN {by_masks} ELSE {by_table} END)"
    )


def indel_ratio(a: str, b: str, masks_a: str | None = None) -> str:
    """``2 * LCS / (len a + len b)``, 1 for equal texts."""
    return f"(CASE WHEN {a} = {b} THEN 1D ELSE 2D * {common_length(a, b, masks_a)} / (length({a}) + length({b})) END)"


def brand_similarity(a: str, b: str, masks_a: str | None = None) -> str:
    """0 if either normalised brand is unknown, else the indel ratio."""
    return f"(CASE WHEN {a} = 'unknown' OR {b} = 'unknown' THEN 0D ELSE {indel_ratio(a, b, masks_a)} END)"


def text_similarity(tokens_a: str, tokens_b: str) -> str:
    """White-space token overlap; 0 when either side has no token."""
    return f"IF(size({tokens_a}) = 0 OR size({tokens_b}) = 0, 0D, {token_overlap(tokens_a, tokens_b)})"


def dot(a: str, b: str) -> str:
    """Inner product in DOUBLE."""
    return f"aggregate(zip_with({a}, {b}, (x, y) -> CAST(x AS DOUBLE) * CAST(y AS DOUBLE)), 0D, (s, x) -> s + x)"
