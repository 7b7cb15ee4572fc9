"""Ranked search against scoring everything, and bounds that never fall short."""

import math
import random
import re
from collections import Counter

import numpy as np

from shelfpair.llm import queries, ranking
from shelfpair.llm.ranking import Question, search, signature_blocks, sliced, terms_of
from tests.conftest import SMALL
from tests.oracle import compare

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_search(docs, items, top=20):
    held = [(d, Counter(brute_terms(t))) for d, t in docs if d is not None]
    held = [(d, c, sum(c.values())) for d, c in held if c]
    n, total = len(held), sum(x[2] for x in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item_id, text in items:
        scores = []
        for d, c, length in held:
            m = 75 + (25 * length * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t in brute_terms(text) if c[t])
            if score:
                scores.append((-score, d))
        out += [(item_id, k + 1, d, -s) for k, (s, d) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=repr)


def got(frame):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in frame.collect()), key=repr)


def test_terms():
    draw = random.Random(1)
    parts = ["A", "Zz", "9", " ", "\t", "é", "İ", "日本", "🎉", "_", "{", "`", "\x7f", "\x00", "-", " "]
    for _ in range(500):
        text = "".join(draw.choices(parts, k=12))
        assert [t.decode() for t in terms_of(text.encode())] == brute_terms(text)


def test_sql_twin_and_brute_force(spark, duck):
    ok, note = compare(spark, duck, "op13_search", queries.op13_search, queries.OP13_SQL, SMALL)
    assert ok, note
    docs = duck.execute("select doc_id, text from documents").fetchall()
    items = duck.execute("select item_id, text from benchmark").fetchall()
    assert got(queries.op13_search(spark, SMALL)) == brute_search(docs, items)


def test_bounds_never_fall_short():
    draw = random.Random(2)
    vocabulary = [f"w{k}".encode() for k in range(200)]
    counts = [Counter(draw.choices(vocabulary[: draw.randrange(1, 200)], k=draw.choice([1, 5, 80, 700]))) for _ in range(90)]
    question = Question([b" ".join(draw.choices(vocabulary, k=draw.randrange(12))) for _ in range(20)])
    lengths = np.array([sum(c.values()) for c in counts])
    question.weigh(90, int(lengths.sum()), {k: sum(t in c for c in counts) for k, t in enumerate(question.terms) if any(t in c for c in counts)})
    for width in (64, 1024, 1 << 14):
        slices, levels = sliced([(ranking._hashes(c), np.fromiter(c.values(), np.int64)) for c in counts], width)
        bounds = question.bounds(lengths, width, levels, slices.tobytes())
        exact = np.array([[question.score(i, c, int(n)) for c, n in zip(counts, lengths)] for i in range(20)])
        assert (bounds >= exact).all()
    few = exact[exact > 0] / bounds[exact > 0]
    assert np.median(few) > 0.7  # and are close where signatures have room


def test_odd_rows_ties_and_parts(spark, monkeypatch):
    draw = random.Random(3)
    words = [f"w{k}" for k in range(60)] + ["the"] * 30
    docs = [(k, " ".join(draw.choices(words, k=draw.choice([0, 3, 40])))) for k in range(150)]
    docs += [(200, "Same words here"), (201, "same WORDS here"), (202, "same, words; here"), (3, docs[3][1]), (7, None), (8, ""), (None, "w1 w2"), (9, "w5 " * 100_000)]
    items = [(1, "w1 w2 w2 the"), (2, "same words"), (2, "same words"), (3, None), (4, ""), (5, "unknown term"), (None, "w5 here"), (6, "the the the")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as rank", "'x' as score", "2 as item").repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "0 as copies", "0 as part")
    want = brute_search(docs, items)
    assert got(search(frame, asked)) == want and {r[0] for r in want} == {1, 2, 6, None}
    for name, value in (("BLOCK_DOCS", 7), ("SEEDS", 20), ("ITEMS", 2), ("SENT", 1)):
        monkeypatch.setattr(ranking, name, value)
    assert got(search(frame, asked)) == want
    assert got(search(frame, asked, top=2)) == brute_search(docs, items, 2)
    assert got(search(frame.limit(0), asked)) == got(search(frame, asked.limit(0))) == []


def test_most_documents_are_excluded(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    blocks = signature_blocks(docs).collect()
    assert sum(len(b.doc_ids) for b in blocks) == len({d for b in blocks for d in b.doc_ids})
    assert all(len(b.slices) == b.width * -(-len(b.doc_ids) // 8) for b in blocks)
