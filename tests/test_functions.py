"""Goldens and properties of the column expressions."""

import random
import string

from pyspark.sql import Row
from pyspark.sql import functions as F

from shelfpair.functions import answers, scoring, similarity, text
from shelfpair.operators.brands import near_brands


def lcs(a: str, b: str) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        previous = row[:]
        for j, y in enumerate(b, 1):
            row[j] = previous[j - 1] + 1 if x == y else max(previous[j], row[j - 1])
    return row[-1]


def ratio(a: str, b: str) -> float:
    return 1.0 if a == b else 2 * lcs(a, b) / (len(a) + len(b))


def column(spark, values, expr, kind="string"):
    """Evaluate ``expr`` over rows (n, x) and return the results in order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"n int, x {kind}").repartition(3)
    return [r.y for r in df.select("n", expr.alias("y")).orderBy("n").collect()]


def test_brand_normalisation(spark):
    x = F.col("x")
    brands = ["Dr. Beckmann", "Dr Beckman", "dr. beckman", "DR.BECKMANN", "Oma's Soep", "Coca-Cola", "cocacola", " Nivea ", None, ""]
    expected = ["drbeckmann"] * 4 + ["omassoep", "cocacola", "cocacola", "nivea", "unknown", ""]
    assert column(spark, brands, text.normalize_brand(x)) == expected
    assert column(spark, [" \tNivea  ", None], text.brand_key(x)) == ["nivea", ""]


def test_terms_use_unicode_boundaries(spark):
    titles = ["crème 225g melk au-bain", "AH Plus melk van de koe", "7up zero", None]
    got = column(spark, titles, text.title_terms(F.col("x")))
    assert got == [["melk", "au", "bain"], ["melk", "koe"], ["zero"], []]


def test_flags_are_substring_tests(spark):
    assert column(spark, ["Turks delight", "BIOgarde", "melk"], text.is_diet(F.col("x"))) == [True, False, False]
    assert column(spark, ["Turks delight", "BIOgarde", "melk"], text.is_bio(F.col("x"))) == [False, True, False]


def test_shop_prefixes(spark):
    assert column(spark, ["AH Oebah koek", "PLUS melk"], text.remove_shop_prefixes(F.col("x"))) == ["oebkoek", "melk"]


def test_fingerprints(spark):
    rows = [
        Row(brand="Pepsi", title="Pepsi Zero sugar cherry 1.5l", amount=1.5, unit="l"),
        Row(brand="PEPSI", title="Pepsi Cola zero cherry 1500ml", amount=1500.0, unit="ml"),
        Row(brand="Lay's", title="chips", amount=2.5, unit="stuk"),
    ]
    df = spark.createDataFrame(rows)
    got = [r.f for r in df.select(text.fingerprint(df.brand, df.title, df.amount, df.unit).alias("f")).collect()]
    assert got == ["pepsi|cherry+sugar+zero|1500ml", "pepsi|cherry+cola+zero|1500ml", "lays|chips|2.5stuk"]


def test_rounding_follows_the_binary_value(spark):
    values = [0.125, 0.375, 0.625, 2.675, 0.0145, 0.5775, 1234.5675, 1 / 3]
    assert column(spark, values, text.exact_round(F.col("x"), 2), "double") == [round(v, 2) for v in values]
    assert column(spark, values, text.exact_round(F.col("x"), 3), "double") == [round(v, 3) for v in values]


def test_indel_ratio_matches_brute_force(spark):
    rng = random.Random(7)
    words = ["", "a", "abcd", "bcda", "nivea", "nivae"]
    words += ["".join(rng.choices("abc1", k=rng.randint(0, 12))) for _ in range(60)]
    words += ["".join(rng.choices("abz", k=k)) for k in (61, 62, 63, 70, 90)]
    pairs = [(a, b) for a in words for b in words if rng.random() < 0.4]
    df = spark.createDataFrame(pairs, "a string, b string").repartition(4)
    got = df.selectExpr("a", "b", f"{similarity.indel_ratio('a', 'b')} AS r", f"{similarity.common_length('a', 'b')} AS l").collect()
    assert len(got) == len(pairs)
    for row in got:
        assert row.l == lcs(row.a, row.b)
        assert abs(row.r - ratio(row.a, row.b)) < 1e-12


def test_near_brands_matches_brute_force(spark):
    rng = random.Random(3)
    base = ["".join(rng.choices(string.ascii_lowercase[:6] + "12", k=rng.randint(1, 14))) for _ in range(150)]
    variants = [w[: len(w) // 2] + rng.choice("abx") + w[len(w) // 2 :] for w in base]
    words = sorted({*base, *variants, "unknown", "a" * 70, "a" * 69 + "b"} - {""})
    expected = {
        (a, b) for a in words for b in words if a < b and "unknown" not in (a, b) and ratio(a, b) >= 0.8
    }
    df = spark.createDataFrame([(w,) for w in words], "brand string")
    got = [(r.brand_1, r.brand_2) for r in near_brands(df, 0.8).collect()]
    assert len(got) == len(set(got))
    assert set(got) == expected and expected


def test_overlap_size_and_dot(spark):
    df = spark.createDataFrame(
        [(["a", "b"], ["b", "c"], 0.0, 0.0), ([], [], 1.0, 2.0), (["a"], ["a"], 0.0, 3.0)], "a array<string>, b array<string>, x double, y double"
    )
    rows = df.selectExpr(
        f"{similarity.token_overlap('a', 'b')} AS t", f"{similarity.token_overlap('b', 'a')} AS u",
        f"{similarity.size_similarity('x', 'y')} AS s", f"{similarity.dot('array(x, y)', 'array(2, x)')} AS d",
    ).collect()
    assert [r.t for r in rows] == [1 / 3, 0.0, 1.0] and [r.u for r in rows] == [1 / 3, 0.0, 1.0]
    assert [r.s for r in rows] == [1.0, 0.5, 0.0] and [r.d for r in rows] == [0.0, 4.0, 0.0]


def test_missing_score_is_no_match(spark):
    kind = scoring.classify("1D", "1D", "CAST(NULL AS DOUBLE)", "CAST(NULL AS DOUBLE)", "TRUE", "TRUE")
    assert spark.range(1).selectExpr(f"{kind} AS k").first().k == "no_match"


def test_label_lines(spark):
    reply = "1. Shampoo\n2 - Volle Melk\n\nthis line is far too long\n7up zero\n- - \n NIVEA  creme "
    got = column(spark, [reply], answers.label_lines(F.col("x")))
    assert got == [["shampoo", "volle melk", "up zero", "nivea  creme"]]
    aligned = column(spark, ["a\nb\nc", "a", ""], answers.align_labels(answers.label_lines(F.col("x")), F.lit(2)))
    assert aligned == [["a", "b"], ["a", "unknown"], ["unknown", "unknown"]]


def test_label_confidence(spark):
    labels = ["unknown", "een twee drie vier", "nivea creme", "250 ml melk", "up", "shampoo"]
    got = column(spark, labels, answers.label_confidence(F.col("x")))
    assert [float(v) for v in got] == [0.3, 0.85, 0.75, 0.8, 0.85, 0.95]


def test_answer_class(spark):
    replies = ["IDENTICAL!", "these are the same", "a variant", "Different brand", "none of them", "???"]
    got = column(spark, replies, answers.answer_class(F.col("x")))
    assert got == ["identical", "identical", "similar", "alternative", "no_match", "unknown"]


def test_bands(spark):
    assert column(spark, [0.95, 0.949, 0.85, 0.7, 0.69], scoring.confidence_action(F.col("x")), "double") == [
        "approve", "approve_log", "approve_log", "review", "reject",
    ]


def test_short_titles(spark):
    long = "x" * 51
    assert column(spark, [long, "x" * 50], text.short_title(F.col("x"))) == ["x" * 47 + "...", "x" * 50]
