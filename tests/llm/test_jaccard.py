"""Near copies by Jaccard similarity against brute force over all pairs."""

import itertools
import random

import numpy as np
import pytest

from shelfpair.llm import jaccard, simhash
from shelfpair.llm.jaccard import counters_of, jaccard_groups, may_share, shingles_of, sketch_of
from shelfpair.llm.simhash import drop_near_copies
from tests.conftest import SMALL
from tests.llm.test_duplicates import brute_components


def brute_jaccard(rows, width=5, similarity=0.8):
    """doc_id to the smallest doc_id reachable by pairs of that similarity."""
    sets = {}
    for d, t in rows:
        words = "".join(c.lower() if c.isascii() else c for c in t or "").encode().split()
        sets[d] = {b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)} or ({b" ".join(words)} if words else set())
    like = lambda a, b: a == b or bool(a | b) and len(a & b) / len(a | b) >= similarity
    return brute_components(sets, [(a, b) for a, b in itertools.combinations(sets, 2) if like(sets[a], sets[b])])


def test_small_table(spark, duck):
    rows = duck.execute("select doc_id, text from documents").fetchall()
    want = brute_jaccard(rows)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert dict(map(tuple, jaccard_groups(docs).collect())) == want
    assert sorted(r.doc_id for r in drop_near_copies(docs).collect()) == sorted(set(want.values()))


@pytest.mark.parametrize("crowd", [2, 100])
def test_edited_copies_crowds_and_stock_passages(spark, crowd):
    draw = random.Random(4)
    vocabulary = [f"w{k}" for k in range(3000)]
    stock, base = draw.choices(vocabulary, k=40), draw.choices(vocabulary, k=120)
    texts = [None, "", "one two", "One  two", "one two three"]
    for _ in range(60):  # edits of one text, of all degrees
        words = list(base)
        for _ in range(draw.randrange(7)):
            words[draw.randrange(len(words))] = draw.choice(vocabulary)
        texts.append(" ".join(words))
    for _ in range(40):  # a common passage in texts of their own, and edited copies of some
        words = [*stock, *draw.choices(vocabulary, k=draw.choice([3, 9, 60]))]
        texts.append(" ".join(words))
        words[draw.randrange(len(words))] = "edited"
        texts.append(" ".join(words))
    rows = list(enumerate(texts))
    want = brute_jaccard(rows)
    got = jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), crowd=crowd)
    assert dict(map(tuple, got.collect())) == want
    assert 20 < len(set(want.values())) < len(rows) - 20


def test_sketches_bound_what_sets_share():
    draw = np.random.default_rng(6)
    for _ in range(200):
        a, b = (np.unique(draw.integers(0, 4000, draw.integers(0, 3000)) * 0x9E3779B97F4A7C1) for _ in range(2))
        shared = len(np.intersect1d(a, b))
        assert may_share(sketch_of(a), sketch_of(b)) >= shared
        x, y = counters_of(a), counters_of(b)
        assert (x is None) == (len(a) > jaccard.SMALL) and (x is None or y is None or np.minimum(x, y).sum() >= shared)
    unlike = [np.unique(draw.integers(-(2**62), 2**62, 5000)) for _ in range(2)]
    most = may_share(*map(sketch_of, unlike))
    assert most / (10_000 - most) < 0.7  # also for long texts
    assert sketch_of(np.arange(300) << 20) is None and may_share(None, sketch_of(unlike[0])) is None


def test_texts_under_one_id_repeated_rows_and_clashing_names(spark):
    draw = random.Random(9)
    a, b, c = (" ".join(draw.choices([f"w{k}" for k in range(500)], k=60)) for _ in range(3))
    near = " ".join([*a.split()[:-1], "edited"])
    rows = [(1, a), (1, b), (2, c), (3, near), (3, near), (4, b), (5, None), (6, ""), (None, a), (7, "word " * 200_000), (7, "x " + "word " * 150_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as mark", "2 as row", "3 as component").repartition(3)
    got = drop_near_copies(docs)
    assert got.columns == docs.columns
    assert sorted(((r.doc_id or 0), (r.text or "")[:40]) for r in got.collect()) == sorted([(0, a[:40]), (1, a[:40]), (1, b[:40]), (2, c[:40]), (5, ""), (7, ("word " * 9)[:40]), (7, ("x " + "word " * 9)[:40])])
    assert drop_near_copies(docs.limit(0)).count() == 0


def test_lists_too_long_to_send_and_split_hubs(spark, monkeypatch):
    draw = random.Random(10)
    base = draw.choices([f"w{k}" for k in range(2000)], k=80)
    texts = []
    for _ in range(40):
        words = list(base)
        words[draw.randrange(80)] = draw.choice(base)
        texts.append(" ".join(words))
    rows = list(enumerate(texts))
    monkeypatch.setattr(jaccard, "SENT", 1)
    monkeypatch.setattr(jaccard, "TOGETHER", 200)
    monkeypatch.setattr(jaccard, "KNOWN", 3)
    got = jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    assert dict(map(tuple, got.collect())) == brute_jaccard(rows)
    assert len(shingles_of(texts[0])) > 60


def edited(count, seed=9):
    draw = random.Random(seed)
    base = [f"w{k}" for k in draw.choices(range(3000), k=150)]
    texts = [None, "", "one two", "One  two"]
    for k in range(count):
        words = list(base)
        for _ in range(k % 6):
            words[draw.randrange(len(words))] = f"edit{draw.randrange(3000)}"
        texts.append(" ".join(words))
    return list(enumerate(texts))


def test_near_copies_are_sought_by_fingerprints_first(spark, monkeypatch):
    rows, asked = edited(40), []
    plain = simhash.close_pairs
    monkeypatch.setattr(simhash, "close_pairs", lambda prints, *rest: asked.append(prints.count()) or plain(prints, *rest))
    monkeypatch.setattr(simhash, "fingerprint_of", lambda text: 7)  # candidates that are no near copies are told by the exact check
    got = drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in got.collect()) == sorted(set(brute_jaccard(rows).values())) and asked == [1]


def test_first_candidates_are_stars_and_close_fingerprints(spark):
    nodes = spark.createDataFrame([(5, 0), (3, 0), (9, 0), (4, 3), (8, 3), (6, 7), (7, -1), (2, -2)], "node long, fingerprint long")
    got = sorted((min(r), max(r)) for r in simhash.like_first(nodes).collect())
    assert got == [(2, 7), (3, 4), (3, 5), (3, 9), (4, 6), (4, 8)]


def test_links_already_joined_are_not_passed_through_again(spark, monkeypatch):
    passed, components = [], jaccard.components
    monkeypatch.setattr(jaccard, "components", lambda links: passed.append(links.count()) or components(links))
    links = lambda *pairs: spark.createDataFrame(pairs, "a long, b long")
    joined = jaccard._joined(jaccard._joined(None, links((1, 2), (2, 3))), links((3, 4), (1, 4), (1, 3)))
    assert {tuple(r) for r in joined.collect()} == {(node, 1) for node in (1, 2, 3, 4)}
    assert passed == [2, 1]


def test_long_heads_meet_once_a_run(spark):
    shared = [(h, node, place) for node in (1, 2) for place, h in enumerate(range(100, 180))]
    rest = jaccard._with_earlier(spark.createDataFrame(shared, "h long, node long, place int"))
    pairs = rest.alias("x").join(rest.alias("y"), "h").where("x.node < y.node and not arrays_overlap(x.earlier, y.earlier)")
    assert [r.h for r in pairs.select("h").collect()] == [100]
