"""Pairing, ranking, batching, parsing and merging on small tables, also on the paths for hot groups."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfpair.functions.inference import ask
from shelfpair.operators import batching, blocking, merging, parsing
from shelfpair.operators.candidates import add_features, candidate_pairs, class_links, classified
from shelfpair.operators.pairing import pair_across, pair_within
from shelfpair.operators import candidates, pivots
from shelfpair.operators.classes import PACK, class_members, classes_of, expand, packs_of, with_pair_counts
from shelfpair.operators.ranking import row_numbers, running_total
from shelfpair.operators.vectors import pairs_above, scored_pairs, top_neighbours
from shelfpair.plans import evaluation, labelling, matching, reports, runs
from shelfpair.schemas import LABELS, PAIRS, PRODUCTS
from shelfpair.sources import files


def products(spark, n=120, seed=1, blocks=2):
    """A catalogue with one hot block, one hot brand and repeated titles."""
    rng = random.Random(seed)
    words = ["melk", "kaas", "chips", "cola", "zero", "bio", "naturel", "paprika"]
    rows = []
    for i in range(n):
        rows.append(
            (
                i, rng.choice(["AH", "JUMBO", "PLUS", "ALDI"]), " ".join(rng.sample(words, rng.randint(0, 6))),
                rng.choice(["huis", "huis", "huis", "huisje", "lays", "Lay's", None, ""]),
                None if i % 17 == 0 else ("hot" if i % 3 else f"c{i % blocks}"),
                rng.choice([0.0, 1.0, 1.5, 2.0, 2.2, float("nan"), None]), rng.choice(["kg", "kg", "l"]), 1.0 + i % 5, i % 7 != 0,
            )
        )
    return spark.createDataFrame(rows, PRODUCTS)


@pytest.mark.parametrize("chunk_rows", [1, 3, 1000])
def test_pair_within_gives_each_pair_once(spark, chunk_rows):
    rows = [(i, "hot" if i % 4 else f"k{i % 3}", i % 5) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, k string, v int")
    got = pair_within(df, ["k"], "id", lambda a, b: f"{a('v')} <> {b('v')}", chunk_rows)
    pairs = [(r.k, r.id_1, r.id_2, r.v_1, r.v_2) for r in got.collect()]
    expected = {
        (k, i, j, v, w) for i, k, v in rows for j, m, w in rows if i < j and k == m and v != w
    }
    assert len(pairs) == len(expected) and set(pairs) == expected


@pytest.mark.parametrize("chunk_rows", [2, 1000])
def test_pair_across(spark, chunk_rows):
    left = spark.createDataFrame([(i, "a") for i in range(0, 20, 2)] + [(100, "b")], "id long, k string")
    right = spark.createDataFrame([(i, "a") for i in range(1, 12, 2)], "id long, k string")
    got = [(r.id_1, r.id_2) for r in pair_across(left, right, ["k"], "id", lambda a, b: "TRUE", chunk_rows).collect()]
    expected = {(min(i, j), max(i, j)) for i in range(0, 20, 2) for j in range(1, 12, 2)}
    assert len(got) == len(expected) and set(got) == expected


@pytest.mark.parametrize("chunk_rows", [4, 2048])
def test_candidates_do_not_depend_on_chunks(spark, chunk_rows):
    feats = add_features(products(spark))
    got = candidate_pairs(feats, chunk_rows=chunk_rows).selectExpr("id_1", "id_2", "round(rule_score, 9) AS s").collect()
    # brute force over all pairs of a block
    f = feats.selectExpr("*", "coalesce(category, '?') AS c").toPandas().to_dict("records")
    from tests.test_functions import ratio

    expected = set()
    for a in f:
        for b in f:
            if a["id"] >= b["id"] or a["block"] != b["block"] or a["shop_type"] == b["shop_type"]:
                continue
            x, y = set(a["terms"]), set(b["terms"])
            terms = len(x & y) / max(len(x | y), 1)
            known = "unknown" not in (a["brand_norm"], b["brand_norm"])
            brand = ratio(a["brand_norm"], b["brand_norm"]) if known else 0.0
            missing = any(v is None or v != v for v in (a["amount"], b["amount"]))
            if missing:
                score = None
            else:
                top = max(a["amount"], b["amount"])
                size = 1.0 if a["amount"] == b["amount"] else 1.0 - abs(a["amount"] - b["amount"]) / top
                feat = 0.5 * (a["bio"] == b["bio"]) + 0.5 * (a["diet"] == b["diet"])
                score = brand * 0.4 + terms * 0.3 + size * 0.2 + feat * 0.1
            if terms >= 0.3 or (brand >= 0.8 and score is not None and score >= 0.6):
                expected.add((a["id"], b["id"], None if score is None else round(score, 9)))
    assert len(got) == len(expected) and {tuple(r) for r in got} == expected and expected


@pytest.mark.parametrize("group", [["g"], []])
def test_groups_are_numbered_over_partitions(spark, group):
    rng = random.Random(5)
    rows = [(i, None if i % 9 == 0 else ("hot" if i % 3 else "cold"), rng.choice(["a", "b", "c", None])) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, g string, t string").repartition(5)
    order = [F.col("t").asc_nulls_last(), F.col("id")]
    got = {r.id: r.n for r in row_numbers(df, group, order, "n").collect()}
    expected, seen = {}, {}
    for i, g, t in sorted(rows, key=lambda r: (r[2] is None, r[2] or "", r[0])):
        key = g if group else 0
        expected[i] = seen.get(key, 0)
        seen[key] = expected[i] + 1
    assert got == expected
    total = {r.id: r.n for r in running_total(df, group, order, F.lit(2), "n").collect()}
    assert total == {i: 2 * n for i, n in expected.items()}


def test_batches_partition_the_block(spark):
    rows = blocking.with_block(products(spark, 200))
    got = batching.pair_batches(rows, 7).toPandas()
    assert sorted(got["id"]) == sorted(r.id for r in rows.select("id").collect())
    for _, block in got.groupby(["main_category", "normalized_quantity_unit"]):
        assert sorted(block["position"]) == list(range(len(block)))
        assert block.groupby("batch_id").size().max() <= 7
        # round robin, recomputed row by row
        block = block.assign(b=block["brand"].fillna("").str.strip().str.lower())
        order = block.assign(nb=block["brand"].isna()).sort_values(["nb", "brand", "title", "id"])
        expected = []
        for brand in sorted(set(order["b"])):
            shops = {}
            for r in order[order["b"] == brand].itertuples():
                shops.setdefault(r.shop_type, []).append(r.id)
            for i in range(max(map(len, shops.values()))):
                expected += [ids[i] for ids in shops.values() if i < len(ids)]
        assert list(block.sort_values("position")["id"]) == expected


def test_pair_answer_grammar(spark):
    reply = "\r\n".join(
        ["100=200 (identical)", "[100] = [300] (Alternatief)", "300 = 100 (similar)", "1=2 (idéntiek)", "99999999999999999999=1 (similar)", "see 100=400 (vergelijkbaar) ok"]
    )
    df = spark.createDataFrame([(1, reply)], "r int, response_text string")
    got = [(x.line_no, x.id_a, x.id_b, x.equivalence_type, float(x.similarity_score)) for x in parsing.pair_lines(df, ["r"]).orderBy("line_no").collect()]
    assert got == [(0, 100, 200, "identical", 0.95), (1, 100, 300, "alternative", 0.55), (2, 300, 100, "similar", 0.75), (5, 100, 400, "similar", 0.75)]


def test_chips_triple(spark):
    members = spark.createDataFrame([("c", 100, "AH"), ("c", 200, "JUMBO"), ("c", 300, "PLUS"), ("d", 400, "AH")], "g string, id long, shop_type string")
    replies = spark.createDataFrame([("c", "100=200 (identical)\n100=300 (alternative)\n300=100 (similar)\n100=400 (similar)\n\n100=100 (identical)")], "g string, response_text string")
    got = parsing.parse_pairs(replies, ["g"], members, ["g"]).orderBy("lo", "hi").collect()
    assert [(r.lo, r.hi, r.equivalence_type) for r in got] == [(100, 200, "identical"), (100, 300, "alternative")]


def test_log_segmentation(spark, tmp_path):
    log = (
        "10:00:00 INFO    LLM response (20 chars): 1=2 (identical)\n3=4 (similar)\n10:00:01 INFO    Batch 1\n"
        "10:00:02 INFO    LLM response (20 chars): 5=6 (similar)\n\n7=8 (similar)\n"
        "10:00:03 INFO    LLM response (20 chars): 1=2 (identical)\n3=4 (similar)\n10:00:04 INFO end\n"
        "10:00:05 INFO    LLM response (9 chars): 2=1 (alternative)\n9=9 (identical)"
    )
    (tmp_path / "a.log").write_text(log)
    logs = files.read_logs(spark, str(tmp_path))
    answers = parsing.log_answers(logs)
    assert {r.response_text for r in answers.collect()} == {"1=2 (identical)\n3=4 (similar)", "5=6 (similar)", "2=1 (alternative)\n9=9 (identical)"}
    pairs = {(r.lo, r.hi): r.equivalence_type for r in parsing.log_pairs(answers, ["path", "block_no"]).collect()}
    assert pairs == {(1, 2): "identical", (3, 4): "similar", (5, 6): "similar", (9, 9): "identical"}


def pair_table(spark, rows):
    df = spark.createDataFrame(rows, "source_product_id long, target_product_id long, equivalence_type string, s double")
    stamp = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return df.select(
        F.lit(None).cast("bigint").alias("id"), "source_product_id", "target_product_id", "equivalence_type",
        F.col("s").cast("decimal(4,3)").alias("similarity_score"), stamp.alias("created_at"), stamp.alias("updated_at"),
    ).select(*PAIRS.fieldNames())


def test_merge_never_lowers_a_score_and_is_idempotent(spark):
    old = pair_table(spark, [(1, 2, "similar", 0.75), (3, 4, "identical", 0.95), (5, 6, "similar", 0.75)])
    new = pair_table(spark, [(2, 1, "identical", 0.95), (3, 4, "similar", 0.75), (6, 5, "alternative", 0.75), (8, 7, "similar", 0.75), (7, 8, "identical", 0.95)])
    merged = merging.merge_pairs(old, new, ["equivalence_type"])
    rows = {(r.source_product_id, r.target_product_id): (r.equivalence_type, float(r.similarity_score), r.action) for r in merged.collect()}
    assert rows == {
        (1, 2): ("identical", 0.95, "updated"), (3, 4): ("identical", 0.95, "unchanged"),
        (5, 6): ("similar", 0.75, "unchanged"), (7, 8): ("identical", 0.95, "inserted"),
    }
    again = merging.merge_pairs(merged.drop("action"), new, ["equivalence_type"])
    assert {r.action for r in again.select("action").distinct().collect()} == {"unchanged"}
    stamps = merged.filter("action = 'updated'").select("created_at", "updated_at").first()
    assert stamps.created_at.year == 2024 and stamps.updated_at > stamps.created_at


def test_clean_up_is_idempotent(spark):
    p = products(spark)
    pairs = pair_table(spark, [(i, i + 1, "similar", 0.75) for i in range(0, 130, 3)])
    once = merging.clean_up(pairs, p)
    kept = {(r.source_product_id, r.target_product_id) for r in once.collect()}
    active = {r.id for r in p.filter("is_active").collect()}
    assert kept == {(i, i + 1) for i in range(0, 130, 3) if i in active and i + 1 in active}
    assert merging.clean_up(once, p).count() == len(kept)


@pytest.mark.parametrize("chunk_rows", [5, 1000])
def test_vector_search_does_not_depend_on_chunks(spark, chunk_rows):
    import numpy as np

    rng = np.random.default_rng(2)
    matrix = rng.normal(size=(40, 6)).round(2)
    matrix[7] = matrix[3]
    rows = [(i, "AH" if i % 2 else "PLUS", "b" if i < 30 else "c", [float(x) for x in v]) for i, v in enumerate(matrix)]
    df = spark.createDataFrame(rows, "id long, shop_type string, block string, embedding array<double>")
    scores = (matrix @ matrix.T).round(9)
    for block in (None, ["block"]):
        ok = lambda i, j: block is None or rows[i][2] == rows[j][2]
        expected = set()
        for i in range(40):
            best = sorted((j for j in range(40) if ok(i, j)), key=lambda j: (-scores[i, j], j))[:4]
            expected |= {(i, j, r) for r, j in enumerate(best, 1)}
        got = {(r.id_1, r.id_2, r["rank"]) for r in top_neighbours(df, 4, block, chunk_rows).collect()}
        assert got == expected
        above = {(r.id_1, r.id_2) for r in pairs_above(df, 2.0, block, chunk_rows).collect()}
        assert above == {(i, j) for i in range(40) for j in range(i + 1, 40) if ok(i, j) and scores[i, j] >= 2.0 and rows[i][1] != rows[j][1]}


def test_large_exact_groups_stay_whole(spark):
    rows = [(i, "AH" if i % 2 else "PLUS", "same title", "b", "c", 1.0, "kg", 1.0, True) for i in range(30)]
    rows += [(100, "AH", "other", "b", "c", 1.0, "kg", 1.0, True), (101, "PLUS", "other", "b", "c", 1.0, "kg", 1.0, True)]
    fp = matching.with_fingerprint(spark.createDataFrame(rows, PRODUCTS))
    linked = {(r.source_product_id, r.target_product_id) for r in matching.exact_matches(fp).collect()}
    assert linked == {(0, i) for i in range(1, 30)} | {(100, 101)}
    groups = {r.product_count: r.pair_count for r in matching.exact_groups(fp).collect()}
    assert groups == {30: 225, 2: 1}
    assert matching.exact_members(fp).filter("product_count > 10").count() == 30
    pairs = {(r.source_product_id, r.target_product_id) for r in matching.exact_pairs(fp, chunk_rows=4).collect()}
    assert pairs == {(a, b) for a in range(30) for b in range(a + 1, 30) if (a + b) % 2} | {(100, 101)}


def test_crowded_exact_group_reaches_every_stage_once(spark):
    rows = [(i, ["AH", "PLUS", "ALDI"][i % 3], "same title", "b", "c", 1.0, "kg", 1.0, True) for i in range(3000)]
    rows += [(9000 + i, ["AH", "PLUS"][i % 2], f"{'abcd'[i] * 3} thing", "b", "c", 1.0, "kg", 1.0, True) for i in range(4)]
    frame = spark.createDataFrame(rows, PRODUCTS)
    vectors = spark.createDataFrame([], "id long, embedding array<float>")
    found = matching.staged_matches(frame, vectors, lambda prompts: prompts.map(lambda _: None)).collect()
    assert {r.target_product_id for r in found} == set(range(1, 3000)) and {r.source_product_id for r in found} == {0}
    assert {(r.stage, r.product_count, r.pair_count) for r in found} == {(1, 3000, 3_000_000)}
    assert matching.exact_pairs(matching.with_fingerprint(frame)).count() == 3_000_000


def test_products_without_vector_are_scored_by_rules(spark):
    rows = [(i, "AH" if i % 2 else "PLUS", f"{'AH' if i % 2 else 'PLUS'} cola zero", "b", "c", 1.0, "kg", 1.0, True) for i in range(3)]
    vectors = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0])], "id long, embedding array<float>")
    found = matching.vector_matches(spark.createDataFrame(rows, PRODUCTS), vectors).collect()
    assert {(r.source_product_id, r.target_product_id, r.method) for r in found} == {(0, 1, "semantic"), (1, 2, "rule_based")}


def test_pairs_without_two_vectors_are_listed_from_links(spark, monkeypatch):
    """Twenty copies, vectors for the products of one: only their pairs go to the cells, one by one."""
    frame = copied(spark, 60, 20)
    vectors = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(60)], "id long, embedding array<float>")
    sent, score = [], matching.scored_pairs
    monkeypatch.setattr(matching, "scored_pairs", lambda rows, listed, *rest: sent.append({(r.id_1, r.id_2) for r in listed.collect()}) or score(rows, listed, *rest))
    matches = matching.vector_matches(frame, vectors)
    assert sent[0] and all(a < 60 and b < 60 for a, b in sent[0])
    above, _, below = plan_of(matches.filter("method = 'rule_based'")).rpartition("Generate explode(ids_2")
    assert below
    found = matches.collect()
    by_rules = [tuple(r) for r in found if r.method == "rule_based"]
    want = [tuple(r) for r in matching.rule_matches(frame).collect() if r.source_product_id >= 60 or r.target_product_id >= 60]
    assert sorted(by_rules, key=str) == sorted(want, key=str) and len(want) > 1000
    assert all(r.source_product_id < 60 and r.target_product_id < 60 for r in found if r.method == "semantic")


def test_skipped_batches_and_dry_run(spark):
    p = products(spark)
    empty = spark.createDataFrame([], PAIRS)
    silent = runs.full_run(p, empty, lambda prompts: prompts.map(lambda _: None), 5)
    assert silent.parsed.count() == 0 and silent.merged.count() == 0
    dry = runs.full_run(p, empty, lambda prompts: prompts.map(lambda _: "x"), 5, dry_run=True)
    assert dry.merged is None


def test_incremental_run_without_new_products_asks_nothing(spark):
    asked = spark.sparkContext.accumulator(0)
    p = spark.createDataFrame([(1, "AH", "t", "b", "c", 1.0, "kg", 1.0, True), (2, "PLUS", "t", "b", "c", 1.0, "kg", 1.0, True)], PRODUCTS)
    stored = pair_table(spark, [(1, 2, "identical", 0.95)])

    def answer(prompts):
        asked.add(len(prompts))
        return prompts.map(lambda _: "")

    merged = runs.incremental_run(p, stored, answer).merged
    assert merged.count() == 1 and asked.value == 0


def test_ask_keeps_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, prompt string")
    got = {r.n: r.response_text for r in ask(df, lambda s: s.str.upper()).collect()}
    assert got == {1: "A", 2: "B"}


def test_failed_calls_are_recorded(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, prompt string").coalesce(1)

    def broken(prompts):
        raise RuntimeError("no quota")

    rows = ask(df, broken, error="error", millis="ms").collect()
    assert [(r.response_text, r.error) for r in rows] == [(None, "RuntimeError: no quota")] * 2
    with pytest.raises(Exception, match="no quota"):
        ask(df, broken).collect()
    assert [r.response_text for r in ask(df, lambda s: s, system="rules").orderBy("n").collect()] == ["rules\n\na", "rules\n\nb"]


def test_one_failing_model_does_not_stop_the_others(spark):
    def broken(prompts):
        raise RuntimeError("down")

    rows = products(spark, 200)
    answers = evaluation.evaluate(rows, {"good": lambda p: p.map(lambda _: "identical"), "bad": broken}).cache()
    assert {r.model for r in evaluation.accuracy(answers).collect()} == {"good"}
    assert [(r.model, r.error) for r in evaluation.errors(answers).collect()] == [("bad", "RuntimeError: down")]
    with pytest.raises(ValueError, match="blocks"):
        evaluation.evaluate(rows, {"good": broken}, n_blocks=50)


def test_a_second_run_asks_nothing(spark):
    asked = spark.sparkContext.accumulator(0)
    p, empty = products(spark), spark.createDataFrame([], PAIRS)

    def answer(prompts):
        asked.add(len(prompts))
        return prompts.map(lambda _: "1=2 (identical)")

    cache = spark.createDataFrame([], "cache_key string, response_text string")
    first = runs.full_run(p, empty, answer, 5, cache=cache)
    once, n = first.merged.count(), asked.value
    again = runs.full_run(p, empty, answer, 5, cache=first.cache)
    assert again.merged.count() == once and asked.value == n > 0


def test_labels_have_a_processing_time(spark):
    def slow(prompts):
        time.sleep(0.3)
        return prompts.map(lambda _: "shampoo")

    labels = spark.createDataFrame([], LABELS)
    merged = labelling.label_products(products(spark, 20), labels, slow).merged
    assert merged.agg(F.avg("processing_time_ms")).first()[0] > 0


def test_block_argument():
    assert blocking.parse_block_argument(" Zuivel | l ") == ("Zuivel", "l")
    with pytest.raises(ValueError):
        blocking.parse_block_argument("Zuivel")


# classes of listings


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_copies_of_the_catalogue_add_no_links(spark):
    once = products(spark, 60)
    copies = once.crossJoin(spark.range(100).withColumnRenamed("id", "copy")).withColumn("id", F.col("id") + 1000 * F.col("copy")).drop("copy")
    links, members = matching.rule_match_links(once)
    many, all_members = matching.rule_match_links(copies)
    key = lambda df: {(r.class_1, r.class_2): (r.equivalence_type, r.pair_count) for r in df.collect()}
    few, crowd = key(links), key(many)
    assert few.keys() == crowd.keys() and all_members.count() == 100 * members.count()
    assert all(crowd[k] == (kind, 10_000 * n) for k, (kind, n) in few.items() if k[0] != k[1])
    assert sum(n for _, n in few.values()) == matching.rule_matches(once).count()


def test_expanded_links_are_the_pairs_they_count(spark):
    members = class_members(add_features(products(spark, 150, seed=3)))
    classes = classes_of(members)
    every = classes.select("block", F.col("id").alias("class_1")).join(classes.select("block", F.col("id").alias("class_2")), "block").filter("class_1 <= class_2")
    counted = with_pair_counts(every, classes)
    rows = expand(every.withColumn("link", F.struct("class_1", "class_2")), members, ["title"]).collect()
    seen = {}
    for r in rows:
        assert r.id_1 < r.id_2 and r.shop_type_1 != r.shop_type_2
        seen[tuple(r.link)] = seen.get(tuple(r.link), 0) + 1
    assert {(r.class_1, r.class_2): r.pair_count for r in counted.collect() if r.pair_count} == seen


def test_brands_are_compared_once_for_each_two_that_meet(spark):
    matches = matching.rule_matches(products(spark, 60))
    assert "aggregate(" not in plan_of(matches)


def copied(spark, n, times):
    rows = spark.range(times).withColumnRenamed("id", "copy")
    return products(spark, n).crossJoin(rows).withColumn("id", F.col("id") + 1000 * F.col("copy")).drop("copy")


def test_matches_are_listed_after_the_last_shuffle_and_described_once_a_link(spark):
    matches = matching.rule_matches(copied(spark, 60, 20))
    above, _, below = plan_of(matches).partition("Generate explode(ids_2")
    assert below and "Exchange" not in above and "format_number" not in above
    described = classified(candidate_pairs(add_features(copied(spark, 60, 20))))
    above, _, below = plan_of(described).partition("Generate explode(ids_2")
    assert below and "Exchange" not in above and "format_number" not in above


def test_packs_hold_a_bounded_number_of_ids(spark):
    members = class_members(add_features(copied(spark, 3, 1500)))
    packs = packs_of(members, ["title"]).collect()
    assert sorted(i for r in packs for i in r.ids) == sorted(r.id for r in members.collect())
    assert len(packs) < 40 and max(len(r.ids) for r in packs) < 2 * PACK


def test_terms_are_compared_once_for_each_two_sets(spark, monkeypatch):
    """Forty classes, but two sets of terms."""
    rows = [(i, "AH" if i % 2 else "PLUS", f"volle melk {'vers' if i < 20 else 'houdbaar'}", f"merk{i}", float(i)) for i in range(40)]
    frame = spark.createDataFrame(rows, "id long, shop_type string, title string, brand string, normalized_quantity_amount double")
    frame = frame.withColumns({"main_category": F.lit("zuivel"), "normalized_quantity_unit": F.lit("l")})
    compared, pairing = [], candidates._term_pairing
    monkeypatch.setattr(candidates, "_term_pairing", lambda rows, *rest: compared.append(rows.count()) or pairing(rows, *rest))
    found = class_links(classes_of(class_members(add_features(frame))))
    assert compared == [2]
    assert found.count() == 400  # all cross-shop pairs: 2 of 3 or 4 terms in common


def test_counted_chosen_and_lowest_matches_agree_with_the_listing(spark):
    rows = copied(spark, 60, 5)
    listed = matching.rule_matches(rows)
    for report in (reports.matches_by_type, reports.score_bands):
        assert sorted(report(matching.rule_matches(rows, counted=True)).collect()) == sorted(report(listed).collect())
    assert reports.best_matches(matching.rule_matches(rows, lowest=7), 7).collect() == reports.best_matches(listed, 7).collect()
    pair = ["source_product_id", "target_product_id"]
    chosen = matching.rule_matches(rows, chosen=lambda links: reports.confidence_outliers(links, 1.0))
    want = reports.confidence_outliers(listed, 1.0).select(*pair).collect()
    assert want and sorted(chosen.select(*pair).collect()) == sorted(want)


def test_medians_of_rows_that_stand_for_several(spark):
    rows = [("a", 0.1, 5), ("a", 0.1004, 1), ("a", 0.9, 5), ("b", 3.0, 2), ("b", 4.0, 2)]
    got = {r.g: r.m for r in reports.exact_medians(spark.createDataFrame(rows, "g string, v double, pair_count long"), "g", "v", "m").collect()}
    assert got == {"a": 0.1004, "b": 3.5}


# vectors


def vector_rows(spark, matrix, blocks=1):
    rows = [(i, "AH" if i % 2 else "PLUS", f"b{i % blocks}", [float(x) for x in v]) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, "id long, shop_type string, block string, embedding array<double>")


@pytest.mark.parametrize("chunk_rows", [4, 1000])
def test_scores_out_of_the_cells(spark, chunk_rows):
    import numpy as np

    rng = np.random.default_rng(3)
    matrix = rng.normal(size=(40, 5))
    matrix /= np.linalg.norm(matrix, axis=1)[:, None]
    vectors = vector_rows(spark, matrix, 2).filter("id % 9 <> 0")
    listed = [(f"b{i % 2}", i, j, i + j) for i in range(40) for j in range(i + 2, 40, 4)]
    got = scored_pairs(vectors, spark.createDataFrame(listed, "block string, id_1 long, id_2 long, mark int"), 0.6, 0.1, ["block"], chunk_rows).collect()
    scores = (matrix @ matrix.T).round(9)
    want = {}
    for i in range(40):
        for j in range(i + 2, 40, 2):
            known = (f"b{i % 2}", i, j, i + j) in listed
            if i % 9 == 0 or j % 9 == 0:
                want.update({(i, j): (None, True, i + j)} if known else {})
            elif known and scores[i, j] >= 0.1 or not known and scores[i, j] >= 0.6 and i % 2 != j % 2:
                want[i, j] = (scores[i, j], known, i + j if known else None)
    assert {(r.id_1, r.id_2): (r.score, r.listed, r.mark) for r in got} == want and len(got) == len(want)


@pytest.mark.parametrize("clustered", [True, False])
def test_search_without_blocks_leaves_out_chunks_and_loses_nothing(spark, clustered):
    import numpy as np

    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 8)) * (5 if clustered else 0)
    matrix = (centres[rng.integers(0, 6, 600)] + rng.normal(size=(600, 8)) * (0.3 if clustered else 1)).round(3)
    matrix[:3] = 0
    matrix[5] = matrix[4]
    vectors = vector_rows(spark, matrix)
    scores = (matrix @ matrix.T).round(9)
    got = {(r.id_1, r.id_2, r["rank"]) for r in top_neighbours(vectors, 5, chunk_rows=20).collect()}
    assert got == {(i, j, n + 1) for i in range(600) for n, j in enumerate(sorted(range(600), key=lambda j: (-scores[i, j], j))[:5])}
    threshold = float(np.quantile(scores, 0.995))
    above = [(r.id_1, r.id_2) for r in pairs_above(vectors, threshold, chunk_rows=20).collect()]
    assert sorted(above) == [(i, j) for i in range(600) for j in range(i + 1, 600) if scores[i, j] >= threshold and i % 2 != j % 2]
    placed = pivots.place(vectors, 20)
    cells = sum(c[2] for c in placed.cells)
    met = pivots.visits(placed, pivots.reached(placed, 5)).count()
    assert met <= 600 * cells
    if clustered:  # most rows meet the cells of their own cluster only
        assert met < 0.5 * 600 * cells


def test_visits_are_not_sent_to_all_tasks(spark):
    """Visits are far more rows than the size of their file tells."""
    rng = np.random.default_rng(4)
    placed = pivots.place(vector_rows(spark, rng.normal(size=(600, 8))), 16)
    found = pivots.neighbours(placed, pivots.visits(placed, pivots.reached(placed, 5)), 5)
    assert plan_of(found).count("SortMergeJoin") >= 2


@pytest.mark.parametrize("chunk_rows", [4, 16])
def test_neighbours_in_strips_of_large_cells(spark, chunk_rows):
    rng = np.random.default_rng(5)
    matrix = np.round(np.repeat(rng.normal(size=(60, 4)), 5, axis=0), 1)  # five copies of each, so ties
    scores = np.round(matrix @ matrix.T, 9)
    want = {i: [int(j) for j in np.lexsort((np.arange(300), -scores[i]))[:7]] for i in range(300)}
    rows = top_neighbours(vector_rows(spark, matrix), 7, chunk_rows=chunk_rows).orderBy("id_1", "rank").collect()
    got = {i: [r.id_2 for r in rows if r.id_1 == i] for i in range(300)}
    assert got == want
    cells = pivots.place(vector_rows(spark, matrix), chunk_rows, 8 * chunk_rows).cells
    assert len(cells) < len(pivots.place(vector_rows(spark, matrix), chunk_rows).cells)


def test_exact_medians(spark):
    rng = random.Random(8)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, round(rng.random(), 9), 0.5])) for _ in range(201)] + [("c", 1.0), ("c", 2.0), ("d", None)]
    got = {r.g: r.m for r in reports.exact_medians(spark.createDataFrame(rows, "g string, v double"), "g", "v", "m").collect()}
    import statistics

    want = {g: statistics.median([v for h, v in rows if h == g and v is not None]) for g in ("a", "b", None, "c")}
    assert got == pytest.approx(want)


def test_numbers_are_made_from_keys_alone(spark):
    rows = products(spark, 50).repartition(3)
    numbered = row_numbers(rows, ["shop_type"], blocking.brand_title_order(), "n")
    files_read = [line for line in plan_of(numbered).splitlines() if "stored-" in line]
    assert files_read and not any("title" in line for line in files_read)


def test_classes_are_asked_about_once(spark):
    """Copies inside one shop have one fingerprint and no exact match, so they reach the third stage."""
    from shelfpair.functions.prompts import candidate_prompts

    once = products(spark, 40).filter("shop_type IN ('AH', 'PLUS')").withColumn("title", F.concat("title", F.when(F.col("shop_type") == "AH", " melk").otherwise(" kaas")))
    copies = once.crossJoin(spark.range(5).withColumnRenamed("id", "copy")).withColumn("id", F.col("id") + 1000 * F.col("copy")).drop("copy")

    def prompts(rows):
        members = class_members(add_features(rows))
        return candidate_prompts(matching.candidate_questions(matching.class_candidates(members))).count()

    assert prompts(copies) == prompts(once) > 0
    yes = lambda texts: texts.map(lambda p: '{"matches": [' + ", ".join(f'{{"candidate_id": {line.split(":")[0]}, "confidence": 0.9, "reasoning": ""}}' for line in p.splitlines() if line[:1].isdigit()) + "]}")
    none = spark.createDataFrame([], "id long, embedding array<double>")
    by_class = matching.staged_matches(copies, none, yes, by_class=True).filter("stage = 3")
    each = matching.staged_matches(copies, none, yes).filter("stage = 3")
    key = lambda df: sorted((r.source_product_id, r.target_product_id, r.confidence) for r in df.collect())
    assert key(by_class) == key(each)


def test_small_files_are_dealt_out_before_features(spark, tmp_path):
    products(spark, 20).coalesce(1).write.parquet(str(tmp_path / "p"))
    assert add_features(spark.read.parquet(str(tmp_path / "p"))).rdd.getNumPartitions() == 8


@pytest.mark.parametrize("name", ["j01_candidate_pairs", "x06_x10_measures", "x45_title_class", "j14_strict_candidates"])
def test_measures_are_rounded_once_a_link(spark, name):
    """Before pairs are made: the listing itself (the top of the plan) holds no more than ids and ready columns."""
    from shelfpair.catalog import catalogue_queries, text_queries  # noqa: F401
    from shelfpair.catalog.registry import QUERIES
    from tests.conftest import SMALL

    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    listing = plan[: plan.index("Generate")]
    assert "round(" not in listing and "CASE" not in listing and "array_sort" not in listing


def test_links_are_made_once_for_chosen_matches(spark, monkeypatch):
    """A choice that reads its rows several times (two medians) must not find all links again each time."""
    plans = []

    def choose(rows):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return reports.confidence_outliers(rows, width=0.5)

    found = matching.rule_matches(products(spark, 80, seed=2), chosen=choose)
    assert found.count() and "Join" not in plans[0]


def test_ordered_matches_are_the_sorted_listing_without_a_shuffle_of_pairs(spark, monkeypatch):
    """Ids that are missing or come twice are listed as without the order; parts of a range of ids are used."""
    from shelfpair.operators import classes

    rows = products(spark, 120, seed=3).unionByName(products(spark, 30, seed=5))
    rows = rows.unionByName(rows.limit(4).withColumn("id", F.lit(None).cast("long")))
    monkeypatch.setattr(classes, "SORTED", 40)
    ordered = matching.rule_matches(rows, ordered=True)
    got, listed = ordered.collect(), matching.rule_matches(rows).collect()
    assert got and sorted(map(str, got)) == sorted(map(str, listed))
    place = lambda r: (-r.similarity_score, r.source_product_id is not None, r.source_product_id or 0, r.target_product_id is not None, r.target_product_id or 0)
    assert [place(r) for r in got] == sorted(map(place, got))
    assert ordered.rdd.getNumPartitions() > 8  # more than one part a score
    plan = files.export_rows(ordered, ordered=True)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and plan.index("Generate") < plan.index("Exchange")


def test_parts_of_an_order_hold_a_bounded_number_of_pairs():
    from shelfpair.operators import classes

    pieces = classes._pieces([(0.9, 3), (0.8, 2), (0.7, 4 * classes.SORTED), (None, 1)], list(range(1001)), 1)
    assert [p[1] for p in pieces] == [0, 0, 1, 2, 3, 4, 5] and [p[4] for p in pieces] == [False, False, True, True, True, True, False]
    assert pieces[2][2] is None and pieces[5][3] is None and all(a[3] == b[2] for a, b in zip(pieces[2:5], pieces[3:6]))
