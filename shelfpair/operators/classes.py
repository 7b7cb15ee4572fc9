"""Listings that a pair comparison cannot tell apart, as one class with members.

Measures of a pair depend on the block, brand, terms, amount and flags of its two listings only. Listings equal in all of
these are one class; classes are paired and scored, and a match of listings is a link of their classes. So copies of a
listing cost one row each, and not one for each pair; all pairs are listed only for whoever asks for them (``expand``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfpair.operators.pairing import with_chunks
from shelfpair.session import shuffle_partitions, stored

#: Ids in one row of :func:`packs_of`, about.
PACK = 256

#: Pairs that a task of :func:`expand_in_order` sorts, about.
SORTED = 4_000_000

CLASS_KEY = ["block", "brand_norm", "terms", "amount", "bio", "diet"]


def class_members(features: DataFrame) -> DataFrame:
    """The columns of ``features`` and ``class_id``, the lowest id of the class; terms in alphabetical order. Stored.

    A listing without shop is in no pair and left out. Counts per class are combined before they are shuffled, and the
    class is told to its members by a join on a digest of the key, so a class may have any number of members.
    """
    sorted_terms = features.filter("shop_type IS NOT NULL").withColumn("terms", F.array_sort("terms")).withColumn("amount", F.col("amount") + F.lit(0.0))
    keyed = stored(sorted_terms.withColumn("class_key", F.md5(F.to_json(F.struct(*CLASS_KEY)))))  # read twice, made once
    lowest = keyed.groupBy("class_key").agg(F.min("id").alias("class_id"))
    return stored(keyed.join(lowest, "class_key").drop("class_key"))


def classes_of(members: DataFrame) -> DataFrame:
    """One row a class: its id, key columns, category, unit, and ``shops`` with the number of members in each, by name."""
    per_shop = members.groupBy("class_id", "shop_type").agg(F.count("*").alias("n"))
    shops = per_shop.groupBy("class_id").agg(F.array_sort(F.collect_list(F.struct("shop_type", "n"))).alias("shops"))  # one entry a shop
    first = members.filter("id = class_id").select(F.col("id"), "category", "unit", *CLASS_KEY)
    return first.join(shops.withColumnRenamed("class_id", "id"), "id")


def other_shop(a, b) -> str:
    """SQL condition: some member of one class is sold by another shop than some member of the other."""
    return f"(size({a('shops')}) > 1 OR size({b('shops')}) > 1 OR {a('shops')}[0].shop_type <> {b('shops')}[0].shop_type)"


def with_pair_counts(links: DataFrame, classes: DataFrame) -> DataFrame:
    """Adds ``pair_count``: cross-shop pairs of the members of class_1 and class_2, by arithmetic from the shop counts."""
    for end in ("1", "2"):
        links = links.join(classes.select(F.col("id").alias(f"class_{end}"), F.col("shops").alias(f"shops_{end}")), f"class_{end}")
    total = lambda shops: F.aggregate(shops, F.lit(0).cast("bigint"), lambda s, x: s + x["n"])
    theirs = lambda shop: F.aggregate(
        F.filter("shops_2", lambda y: y["shop_type"] == shop["shop_type"]), F.lit(0).cast("bigint"), lambda s, y: s + y["n"]
    )
    same = F.aggregate("shops_1", F.lit(0).cast("bigint"), lambda s, x: s + x["n"] * theirs(x))
    pairs = total(F.col("shops_1")) * total(F.col("shops_2")) - same
    own = F.col("class_1") == F.col("class_2")
    return links.withColumn("pair_count", F.when(own, (pairs / 2).cast("bigint")).otherwise(pairs)).drop("shops_1", "shops_2")


def packs_of(members: DataFrame, columns: list[str]) -> DataFrame:
    """(class_id, pack, shop_type, ``columns``, ids): members of a class that are equal in shop and ``columns``, in one row. Stored.

    A large class is dealt to packs by a hash of the id, so a row holds about PACK ids at most.
    """
    dealt = with_chunks(members.select("class_id", "id", "shop_type", *columns), ["class_id", "shop_type"], "id", PACK)
    missing = F.array_repeat(F.lit(None).cast("bigint"), F.count_if(F.col("id").isNull()).cast("int"))
    grouped = dealt.withColumnRenamed("_chunk", "pack").groupBy("class_id", "pack", "shop_type", *columns)
    return stored(grouped.agg(F.concat(F.collect_list("id"), missing).alias("ids")))


def expand(links: DataFrame, members: DataFrame, columns: list[str], where: str = "true") -> DataFrame:
    """The cross-shop pairs of the members of linked classes, lower id first, with the links' columns.

    ``where``: an SQL condition on name_1 and name_2 that does not depend on which is which; only pairs for which it holds are listed.

    ``columns`` of the members come as name_1 and name_2, beside id and shop_type. The number of rows is that of the pairs, but
    what is joined and shuffled are links with packs of ids (``packs_of``); pairs are made after the last shuffle.
    """
    packs = packs_of(members, columns)
    copies = 2 * packs.count() <= members.count()
    wanted = ["id", "shop_type", *columns]
    rest = [c for c in links.columns if c not in ("class_1", "class_2")]
    for end in ("1", "2"):
        renamed = [F.col(c).alias(f"{c}_{end}") for c in ("pack", "ids", "shop_type", *columns)]
        links = links.join(packs.select(F.col("class_id").alias(f"class_{end}"), *renamed), f"class_{end}")
    links = links.filter("shop_type_1 <> shop_type_2").filter(where)
    if copies:  # a row is many pairs: deal rows evenly, whatever their size in bytes
        links = links.repartition(shuffle_partitions(links.sparkSession), "class_1", "class_2", "pack_1", "pack_2", "shop_type_1", "shop_type_2")
    pairs = links.withColumn("id_1", F.explode("ids_1")).withColumn("id_2", F.explode("ids_2")).filter("class_1 <> class_2 OR id_1 < id_2")
    first = [f"IF(id_1 < id_2, {c}_1, {c}_2) AS {c}_1" for c in wanted]
    second = [f"IF(id_1 < id_2, {c}_2, {c}_1) AS {c}_2" for c in wanted]
    return pairs.selectExpr(*rest, *first, *second)


def _pieces(counts: list[tuple[float | None, int]], cuts: list[float], least: int) -> list[tuple]:
    """(value, part, low, high, split) in the order of the parts, from ``counts``: (value, number of pairs), highest value first.

    A value with many pairs has parts of its own, each with the lower ids from ``low`` to below ``high``; values with few share
    one. ``cuts``: quantiles of the ids. The share of a range as lower ids falls along it, which the ranges make up for.
    """
    most = min(SORTED, max(1, -(-sum(n for _, n in counts) // least)))
    out, part, held = [], 0, 0
    for value, n in counts:
        pieces = -(-n // most)
        if held and (pieces > 1 or held + n > most):
            part, held = part + 1, 0
        if pieces == 1:
            out.append((value, part, None, None, False))
            held += n
            continue
        shares = [1 - (1 - k / pieces) ** 0.5 for k in range(1, pieces)]
        bounds = [None, *sorted({int(cuts[int(share * (len(cuts) - 1))]) for share in shares} if cuts else ()), None]
        for low, high in zip(bounds, bounds[1:]):
            out.append((value, part, low, high, True))
            part += 1
    return out


def expand_in_order(links: DataFrame, members: DataFrame, columns: list[str], first: str) -> DataFrame:
    """The pairs of :func:`expand` by ``first``, highest first, then by the lower and then by the higher id.

    ``first`` is a column of few different values, such as a score of three digits, and ``links`` have a ``pair_count``. From
    these follow the parts of the order before any pair is made: links with packs of ids go to the parts that their lower
    ids belong to, and a part lists and sorts its own pairs. So pairs are not shuffled, nor made once more to find the parts.
    """
    spark, links = links.sparkSession, stored(links)
    packs = packs_of(members, columns)
    counts = [(r[0], r[1] or 1) for r in links.groupBy(first).agg(F.sum("pair_count")).orderBy(F.col(first).desc()).collect()]
    cuts = members.approxQuantile("id", [k / 1000 for k in range(1001)], 0.0005)
    pieces = _pieces(counts, cuts, shuffle_partitions(spark))
    parts = spark.createDataFrame(pieces, f"_value {dict(links.dtypes)[first]}, _part int, _low long, _high long, _split boolean")
    rest = [c for c in links.columns if c not in ("class_1", "class_2", "pair_count")]
    wanted = ["shop_type", *columns]
    for end in ("1", "2"):
        renamed = [F.col(c).alias(f"{c}_{end}") for c in ("ids", *wanted)]
        links = links.join(packs.select(F.col("class_id").alias(f"class_{end}"), *renamed), f"class_{end}")
    links = links.filter("shop_type_1 <> shop_type_2").join(F.broadcast(parts), F.col(first).eqNullSafe(F.col("_value")))
    # As in expand: of two ids the lower comes first; if neither is lower, that of the second end does. Missing ids are in the first range.
    inside = "((x IS NULL AND _low IS NULL) OR ((_low IS NULL OR x >= _low) AND (_high IS NULL OR x < _high)))"
    links = links.withColumn("_own", F.col("class_1") == F.col("class_2")).filter(f"exists(ids_1, x -> {inside}) OR (NOT _own AND exists(ids_2, x -> {inside}))")
    for end in ("1", "2"):  # ids below the range are neither lower nor higher ids of its pairs
        links = links.withColumn(f"ids_{end}", F.expr(f"filter(ids_{end}, x -> x IS NULL OR _low IS NULL OR x >= _low)"))
    names = [f"{c}_{end}" for c in ("ids", *wanted) for end in ("1", "2")]
    links = links.select(*rest, *names, "_part", "_low", "_high", "_split", "_own").repartitionById(max(p[1] for p in pieces) + 1 if pieces else 1, F.col("_part"))
    sources = [f"transform(filter(ids_{end}, x -> {cond}{inside}), x -> struct(x AS id, {end} AS end))" for end, cond in (("1", ""), ("2", "NOT _own AND "))]
    lower = links.selectExpr("*", f"inline(concat({sources[0]}, {sources[1]})) AS (id_1, _end)")
    others = "IF(_end = 1, filter(ids_2, y -> y > id_1), filter(ids_1, y -> coalesce(y >= id_1, TRUE))) AS _others"
    sides = [f"IF(_end = 1, {c}_{a}, {c}_{b}) AS {c}_{a}" for c in wanted for a, b in (("1", "2"), ("2", "1"))]
    lower = lower.selectExpr(*rest, *sides, "id_1", others, "IF(_split, id_1, NULL) AS _alone")
    pairs = lower.selectExpr("*", "explode(_others) AS id_2")
    # a part of a range holds one value of ``first``, so its order begins with the id, on which most comparisons end
    pairs = pairs.sortWithinPartitions(F.col("_alone"), F.col(first).desc(), "id_1", "id_2")
    return pairs.select(*rest, *[f"{c}_{end}" for end in ("1", "2") for c in ("id", *wanted)])
