"""Reports over the catalogue, the stored pairs and the labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfpair import constants as K
from shelfpair.functions import scoring, text
from shelfpair.operators.blocking import BLOCK, active, block_inventory, paired_ids, with_block
from shelfpair.operators.pairing import pair_within
from shelfpair.operators.ranking import running_total
from shelfpair.session import stored


def mean(column: str, digits: int) -> Column:
    """Rounded average as DOUBLE; averages of DECIMAL columns are exact before they are rounded."""
    return F.round(F.avg(column), digits).cast("double")


# stored pairs


def pair_total(pairs: DataFrame) -> DataFrame:
    return pairs.agg(F.count("*").alias("total"))


def pairs_by_type(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("equivalence_type").agg(
        F.count("*").alias("pair_count"), mean("similarity_score", 3).alias("avg_score")
    )


def block_totals(products: DataFrame) -> DataFrame:
    """One row: active products over all blocks, and the number of blocks."""
    return block_inventory(products).agg(
        F.sum("product_count").alias("products"), F.count("*").alias("blocks")
    )


def largest_blocks(products: DataFrame, n: int = 10) -> DataFrame:
    return block_inventory(products).orderBy(F.col("product_count").desc(), "category", "unit").limit(n)


def statistics(products: DataFrame, pairs: DataFrame) -> DataFrame:
    """Report rows (name, n): active products and blocks, stored pairs in all and per class."""
    blocks = block_totals(products).select(
        F.explode(F.create_map(F.lit("products"), F.col("products"), F.lit("blocks"), F.col("blocks"))).alias("name", "n")
    )
    total = pair_total(pairs).select(F.lit("pairs").alias("name"), F.col("total").alias("n"))
    by_type = pairs.groupBy(F.col("equivalence_type").alias("name")).agg(F.count("*").alias("n"))
    return blocks.unionByName(total).unionByName(by_type)


def class_scores(pairs: DataFrame) -> DataFrame:
    """Stored pairs and their average score per class."""
    return pairs.groupBy("equivalence_type").agg(F.count("*").alias("n"), mean("similarity_score", 3).alias("avg_score"))


def pairs_from(pairs: DataFrame, product_id: int) -> DataFrame:
    return pairs.filter(F.col("source_product_id") == product_id).select(
        "target_product_id", "equivalence_type", "similarity_score"
    )


def pairs_from_ids(pairs: DataFrame, ids: DataFrame) -> DataFrame:
    """The same lookup for many products at once."""
    return pairs.join(ids.select(F.col("id").alias("source_product_id")), "source_product_id", "left_semi")


def pairs_of_type(pairs: DataFrame, kind: str) -> DataFrame:
    return pairs.filter(F.col("equivalence_type") == kind).orderBy(
        F.col("similarity_score").desc(), "source_product_id", "target_product_id"
    )


def pairs_touching(pairs: DataFrame, product_id: int) -> DataFrame:
    return pairs.filter((F.col("source_product_id") == product_id) | (F.col("target_product_id") == product_id))


def partners(pairs: DataFrame) -> DataFrame:
    """Both directions of every pair: product_id, partner_id, class, score."""
    ends = F.explode(
        F.array(
            F.struct(F.col("source_product_id").alias("product_id"), F.col("target_product_id").alias("partner_id")),
            F.struct(F.col("target_product_id").alias("product_id"), F.col("source_product_id").alias("partner_id")),
        )
    )
    return pairs.select(ends.alias("e"), "equivalence_type", "similarity_score").select(
        "e.product_id", "e.partner_id", "equivalence_type", "similarity_score"
    )


def pairs_created_between(pairs: DataFrame, start: str, end: str) -> DataFrame:
    return pairs.filter(F.col("created_at").between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))


def match_coverage(products: DataFrame, pairs: DataFrame) -> DataFrame:
    """Share of active products in blocks that are an end of at least one pair."""
    matched = paired_ids(pairs).distinct().withColumn("_matched", F.lit(1))
    return (
        with_block(active(products))
        .select("id")
        .join(matched, "id", "left")
        .agg(F.count("*").alias("products"), F.count("_matched").alias("matched"))
        .withColumn("coverage", F.round(F.try_divide(F.col("matched").cast("double"), F.col("products")), 6))
    )


def pair_brands(pairs: DataFrame, products: DataFrame) -> DataFrame:
    """Pairs per source brand and class, with the price range over both ends."""
    side = lambda key, p: products.select(F.col("id").alias(key), F.col("brand").alias(f"brand_{p}"), F.col("current_price").alias(f"price_{p}"))
    both = pairs.join(side("source_product_id", "s"), "source_product_id").join(
        side("target_product_id", "t"), "target_product_id"
    )
    return both.groupBy(F.col("brand_s").alias("brand"), "equivalence_type").agg(
        F.count("*").alias("pair_count"),
        F.min(F.least("price_s", "price_t")).alias("min_price"),
        F.max(F.greatest("price_s", "price_t")).alias("max_price"),
    )


def confidence_bins(pairs: DataFrame) -> DataFrame:
    """Histogram of scores in ten bins of [0, 1] per class."""
    score = F.col("similarity_score").cast("double")
    return pairs.groupBy(
        "equivalence_type", F.least(F.floor(score * 10), F.lit(9)).cast("bigint").alias("bin")
    ).agg(F.count("*").alias("pair_count"))


def _weight(rows: DataFrame) -> Column:
    """The pairs that rows stand for: their ``pair_count``, if they have one."""
    return F.sum("pair_count") if "pair_count" in rows.columns else F.count("*")


def exact_medians(rows: DataFrame, group: str, value: str, out: str, digits: int = 3) -> DataFrame:
    """(group, out): the exact median of ``value`` in each group, from counts of its different values. Stored.

    First the values rounded to ``digits`` are counted, which tells in what bin each of the two middle places is; then only values of
    these bins are counted as they are, and a running count tells the place. So no task holds the values of a group, and of many different
    values few are shuffled. The bins decide the work, not the result. Nulls do not count; a row with a ``pair_count`` counts as so many; an even
    number of rows gives the mean of the two middle values.
    """
    known = rows.filter(F.col(value).isNotNull()).withColumn("_bin", F.round(F.col(value), digits))
    low, high = F.expr("(_total - 1) DIV 2"), F.expr("_total DIV 2")
    holds = lambda place: (F.col("_before") <= place) & (place < F.col("_before") + F.col("_n"))


    def meet(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
        same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in keys]
        kept = ["l.*"] if how == "left_semi" else ["l.*", *[f"r.{c}" for c in right.columns if c not in keys]]
        return left.alias("l").join(right.alias("r"), same, how).select(*kept)

    bins = stored(known.groupBy(group, "_bin").agg(_weight(rows).alias("_n")))
    totals = bins.groupBy(group).agg(F.sum("_n").alias("_total"))
    placed = running_total(bins, [group], [F.col("_bin")], F.col("_n"), "_before")
    placed = meet(placed, totals, [group])
    middle = stored(placed.filter(holds(low) | holds(high)).select(group, "_bin", F.col("_before").alias("_earlier"), "_total"))  # at most two a group

    counts = meet(known, middle.select(group, "_bin"), [group, "_bin"], "left_semi").groupBy(group, "_bin", value).agg(_weight(rows).alias("_n"))
    running = meet(running_total(counts, [group, "_bin"], [F.col(value)], F.col("_n"), "_within"), middle, [group, "_bin"])
    running = running.withColumn("_before", F.col("_earlier") + F.col("_within"))
    first, second = F.max(F.when(holds(low), F.col(value))), F.max(F.when(holds(high), F.col(value)))
    return stored(running.groupBy(group).agg((first + (second - first) * 0.5).alias(out)))


def confidence_outliers(pairs: DataFrame, width: float = 3.0) -> DataFrame:
    """Pairs outside median +- ``width`` times the median absolute deviation of their class, both exact.

    ``pairs`` may be links with a ``pair_count``, which then stand for so many pairs each. Both medians are stored before the pairs are read for the
    result, so that the pairs are not shuffled for two numbers a class.
    """
    rows = pairs.withColumn("_score", F.col("similarity_score").cast("double"))
    with_middle = rows.join(exact_medians(rows, "equivalence_type", "_score", "median"), "equivalence_type")
    measured = with_middle.withColumn("_deviation", F.round(F.abs(F.col("_score") - F.col("median")), 6))
    spread = exact_medians(measured, "equivalence_type", "_deviation", "mad")
    return (
        measured.join(spread, "equivalence_type")
        .filter(F.col("_deviation") > F.lit(width) * F.col("mad"))
        .drop("_score", "_deviation")
    )


# matches of a run


def score_bands(matches: DataFrame) -> DataFrame:
    """Matches per band; links count as their ``pair_count``."""
    return matches.groupBy(scoring.score_band(F.col("similarity_score")).alias("band")).agg(
        _weight(matches).alias("match_count")
    )


def matches_by_type(matches: DataFrame) -> DataFrame:
    """Matches per class; links count as their ``pair_count``."""
    return matches.groupBy("equivalence_type").agg(_weight(matches).alias("match_count"))


def best_matches(matches: DataFrame, n: int = 10) -> DataFrame:
    return matches.orderBy(F.col("similarity_score").desc(), "source_product_id", "target_product_id").limit(n)


def rows_per_shop(products: DataFrame) -> DataFrame:
    return products.groupBy("shop_type").agg(F.count("*").alias("product_count"))


# blocks and brands


def block_hierarchy(products: DataFrame) -> DataFrame:
    """Size, method and priority per block; large blocks first."""
    size = F.col("product_count")
    return (
        block_inventory(products)
        .select(
            "category",
            "unit",
            size.alias("size"),
            (size > K.CLUSTERING_SIZE).alias("needs_clustering"),
            F.when(size > K.CLUSTERING_SIZE, "clustering").otherwise("direct").alias("method"),
            size.alias("priority"),
        )
        .orderBy(F.col("priority").desc(), "category", "unit")
    )


def brand_blocks(products: DataFrame) -> DataFrame:
    """Third blocking level: brands inside a block that are sold by several shops."""
    return (
        with_block(active(products))
        .groupBy(
            F.col(BLOCK[0]).alias("category"), F.col(BLOCK[1]).alias("unit"),
            text.normalize_brand(F.col("brand")).alias("brand"),
        )
        .agg(F.count("*").alias("product_count"), F.countDistinct("shop_type").alias("shop_count"))
        .filter(F.col("shop_count") > 1)
    )


def brand_block_pairs(products: DataFrame) -> DataFrame:
    """Cross-shop pairs of one category, unit and known brand: the third blocking level as a join."""
    rows = with_block(active(products)).select(
        *BLOCK, text.normalize_brand(F.coalesce("brand", F.lit("Unknown"))).alias("brand_norm"), "id", "shop_type"
    )
    known = rows.filter(F.col("brand_norm") != "unknown")
    pairs = pair_within(known, [*BLOCK, "brand_norm"], "id", lambda a, b: f"{a('shop_type')} <> {b('shop_type')}")
    return pairs.select("id_1", "id_2")


def brand_by_shop(products: DataFrame) -> DataFrame:
    """Products per brand and shop, one row each, and whether the brand is sold in several shops."""
    counts = products.filter(F.col("brand").isNotNull()).groupBy("brand", "shop_type").agg(F.count("*").alias("product_count"))
    shared = counts.groupBy("brand").agg((F.countDistinct("shop_type") > 1).alias("shared"))
    return counts.join(shared, "brand")


# labels


def products_with_labels(products: DataFrame, labels: DataFrame) -> DataFrame:
    """Every product with its optional label."""
    return products.join(
        labels.select(
            F.col("product_id").alias("id"), "essence", "confidence",
            F.col("created_at").alias("essence_created_at"), "model_version",
        ),
        "id",
        "left",
    )


def labelled(products: DataFrame, labels: DataFrame) -> DataFrame:
    return products.join(labels.select(F.col("product_id").alias("id"), "essence", "confidence"), "id")


def batch_listing(labelled_rows: DataFrame, category: str, batch_id: int) -> DataFrame:
    """The products of one label batch as a reader sees them: short title, label, confidence, shop and price."""
    rows = labelled_rows.filter((F.col("main_category") == category) & (F.col("batch_id") == batch_id))
    return rows.select("id", text.short_title(F.col("title")).alias("title"), "essence", "confidence", "shop_type", "current_price")


def products_of_label(products: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """Trusted products of one label, cheapest first."""
    return (
        labelled(products, labels)
        .filter((F.col("essence") == label) & (F.col("confidence") > 0.8))
        .select("id", "title", "shop_type", "current_price", "essence")
        .orderBy("current_price", "id")
    )


def low_confidence(products: DataFrame, labels: DataFrame) -> DataFrame:
    return (
        labelled(products, labels)
        .filter(F.col("confidence") < 0.7)
        .select("id", "title", "essence", "confidence", "main_category")
        .orderBy("confidence", F.col("main_category").asc_nulls_last(), "id")
    )


def unlabelled(products: DataFrame, labels: DataFrame, category: str | None = None) -> DataFrame:
    rows = products if category is None else products.filter(F.col("main_category") == category)
    return rows.join(labels.select(F.col("product_id").alias("id")), "id", "left_anti")


def page(rows: DataFrame, limit: int = 0, offset: int = 0) -> DataFrame:
    """Rows in id order; the offset counts only together with a limit, 0 means all."""
    ordered = rows.orderBy("id")
    return ordered.offset(offset).limit(limit) if limit else ordered


def label_progress(products: DataFrame, labels: DataFrame) -> DataFrame:
    """Total, classified and remaining products per category, with averages."""
    known = labels.select(F.col("product_id").alias("id"), F.lit(1).alias("_known"), "confidence", "processing_time_ms")
    total, done = F.count("*"), F.count("_known")
    return (
        products.select("id", "main_category")
        .join(known, "id", "left")
        .groupBy("main_category")
        .agg(
            total.alias("total_products"),
            done.alias("classified"),
            (total - done).alias("remaining"),
            F.coalesce(mean("confidence", 6), F.lit(0.0)).alias("avg_confidence"),
            F.coalesce(mean("processing_time_ms", 6), F.lit(0.0)).alias("avg_processing_time"),
        )
    )


def completion(products: DataFrame, labels: DataFrame) -> DataFrame:
    """Completion percentage per category, best first."""
    return (
        label_progress(products, labels)
        .withColumn(
            "completion_percentage",
            F.round(F.try_divide(F.col("classified") * 100.0, F.col("total_products")), 1),
        )
        .select(
            "main_category", "total_products", "classified", "remaining", "completion_percentage",
            F.round("avg_confidence", 3).alias("avg_confidence"),
        )
        .orderBy(F.col("completion_percentage").desc(), F.col("main_category").asc_nulls_last())
    )


def shop_prices(products: DataFrame, labels: DataFrame) -> DataFrame:
    """Average price and count per trusted label and shop, at least two products."""
    return (
        labelled(products, labels)
        .filter(F.col("confidence") > 0.8)
        .groupBy("essence", "shop_type")
        .agg(F.avg("current_price").alias("avg_price"), F.count("*").alias("product_count"))
        .filter(F.col("product_count") >= 2)
    )


def savings(products: DataFrame, labels: DataFrame) -> DataFrame:
    """Spread between the dearest and the cheapest shop average per label, above 0.50."""
    low, high = F.min("avg_price"), F.max("avg_price")
    return (
        shop_prices(products, labels)
        .groupBy("essence")
        .agg(
            (high - low).alias("_spread"), low.alias("_low"), high.alias("_high"),
            F.countDistinct("shop_type").alias("_shops"),
        )
        .filter((F.col("_shops") >= 2) & (F.col("_spread") > 0.50))
        .select(
            "essence",
            F.round("_spread", 2).alias("savings_potential"),
            F.round("_low", 2).alias("cheapest_price"),
            F.round("_high", 2).alias("most_expensive_price"),
            F.round(F.try_divide(F.col("_spread") * 100, F.col("_low")), 1).alias("savings_percentage"),
        )
        .orderBy(F.col("savings_percentage").desc(), "essence")
    )


def label_coverage(products: DataFrame, labels: DataFrame) -> DataFrame:
    """Trusted labels with at least four products in at least three shops."""
    return (
        labelled(products, labels)
        .filter(F.col("confidence") > 0.8)
        .groupBy("essence", "main_category")
        .agg(
            F.count("*").alias("total_products"),
            F.countDistinct("shop_type").alias("shop_coverage"),
            F.sort_array(F.collect_set("shop_type")).alias("shops"),
            mean("confidence", 3).alias("avg_confidence"),
            F.min("current_price").alias("min_price"),
            F.max("current_price").alias("max_price"),
        )
        .filter((F.col("total_products") >= 4) & (F.col("shop_coverage") >= 3))
        .orderBy(F.col("shop_coverage").desc(), F.col("total_products").desc(), "essence", "main_category")
    )


def unknown_share(products: DataFrame, labels: DataFrame, unknown: str = "unknown") -> DataFrame:
    """Percentage of labelled products per category whose label is ``unknown``."""
    return labelled(products, labels).groupBy("main_category").agg(
        F.count("*").alias("labelled"),
        F.round(F.avg(F.when(F.col("essence") == unknown, 100.0).otherwise(0.0)), 6).alias("unknown_percentage"),
    )


def label_group_sizes(labels: DataFrame, too_many: int = 100) -> DataFrame:
    """Products per label, flagged when a label is used once or for too many products."""
    n = F.col("product_count")
    return labels.groupBy("essence").agg(F.count("*").alias("product_count")).withColumn(
        "grouping", F.when(n == 1, "single").when(n > too_many, "too_many").otherwise("normal")
    )


def batch_quality(labelled_rows: DataFrame, keys: list[str]) -> DataFrame:
    """Per batch: products, average words, unknown labels and average confidence."""
    words = F.size(F.split("essence", r"(?U)\s+"))
    return labelled_rows.groupBy(*keys).agg(
        F.count("*").alias("labels"),
        F.round(F.avg(words), 6).alias("avg_words"),
        F.count_if(F.col("essence") == "unknown").alias("unknown_count"),
        mean("confidence", 6).alias("avg_confidence"),
    )
