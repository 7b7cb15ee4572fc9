"""SimHash groups and near vectors against brute force, with the awkward cases of both."""

import itertools

import numpy as np
import pytest
import xxhash

from shelfpair.llm import queries
from shelfpair.llm.simhash import close_pairs, drop_near_copies, fingerprint_of, simhash_groups
from shelfpair.llm.vectors import linked_pairs, near_vectors
from shelfpair.session import stored
from tests.conftest import SMALL
from tests.oracle import compare


def brute_components(nodes, links):
    low = {n: n for n in nodes}
    moved = True
    while moved:
        moved = False
        for a, b in links:
            m = min(low[a], low[b])
            moved |= low[a] != m or low[b] != m
            low[a] = low[b] = m
    return low


def brute_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", lowered) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def test_fingerprints_follow_the_definition():
    texts = [None, "", " \t\n", "One", "one two", "A b\x0bC d d d d d", "Ünï Ü x y z w", "a b c " * 70_000]
    for text in texts:
        assert fingerprint_of(text) & (2**64 - 1) == brute_fingerprint(text)


def test_every_close_pair_is_found_once(spark):
    rng = np.random.default_rng(3)
    base = [int(x) for x in rng.integers(-(2**63), 2**63 - 1, 30)] + [0, -1]
    values = set(base)
    for value in base:
        for bits in itertools.chain([(0,), (63,), (0, 63)], (tuple(rng.integers(0, 64, 3)) for _ in range(20))):
            for bit in bits:
                value ^= -(1 << 63) if bit == 63 else 1 << int(bit)
            values.add(value)
    pairs = close_pairs(spark.createDataFrame([(v,) for v in values], "fingerprint long"))
    want = {(a, b) for a, b in itertools.combinations(sorted(values), 2) if ((a ^ b) & (2**64 - 1)).bit_count() <= 2}
    got = [(r.a, r.b) for r in pairs.collect()]
    assert len(got) == len(set(got)) and set(got) == want


def brute_groups(rows):
    prints = {d: brute_fingerprint(t) for d, t in rows}
    links = [(a, b) for a, b in itertools.combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 2]
    low = brute_components(prints, links)
    return {(d, f"{prints[d]:016x}", low[d]) for d in prints}


def test_simhash_query_on_a_whole_table(spark, duck):
    rows = duck.execute("select doc_id, text from documents").fetchall()
    got = {tuple(r) for r in queries.op5_simhash_duplicates(spark, SMALL).select("doc_id", "fingerprint", "component_id").collect()}
    assert got == brute_groups(rows)
    assert len({c for _, _, c in got}) < len(got)


def test_simhash_odd_rows(spark):
    schema = "doc_id long, text string, component_id string, kept_id int, fingerprint int"
    rows = [(3, None, "x", 1, 1), (1, "", "y", 1, 1), (7, "w", "z", 1, 1), (7, "w", "z", 1, 1), (9, "W", None, 1, 1), (None, "w", "n", 1, 1)]
    docs = spark.createDataFrame(rows, schema)
    got = sorted((r.doc_id or -1, r.component_id) for r in simhash_groups(docs).collect())
    assert got == [(-1, 7), (1, 1), (3, 1), (7, 7), (7, 7), (9, 7)]
    left = drop_near_copies(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id or -1, r.component_id) for r in left.collect()) == [(-1, "n"), (1, "y"), (7, "z")]
    assert simhash_groups(docs.limit(0)).count() == 0 and drop_near_copies(docs.limit(0)).count() == 0


def cosine(x, y):
    return np.dot(x, y) / (np.linalg.norm(x) * np.linalg.norm(y))


@pytest.mark.parametrize("dims", [3, 64, 2500])
def test_bounds_lose_no_link(dims):
    rng = np.random.default_rng(dims)
    base = rng.normal(size=(12, dims))
    crowd = np.concatenate([base + s * rng.normal(size=base.shape) for s in (0, 0.15, 0.19, 0.2, 0.205, 0.25)])
    i, j = linked_pairs(crowd, crowd, 0.98)
    got = set(zip(i.tolist(), j.tolist()))
    # pairs whose cosine equals the threshold to the last bits are left to the order of summation
    for a, b in itertools.product(range(len(crowd)), repeat=2):
        c = cosine(crowd[a], crowd[b])
        assert abs(c - 0.98) < 1e-13 or ((a, b) in got) == (c >= 0.98)


def brute_vectors(rows, threshold=0.98):
    def fit(v):
        return v and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)

    good = [(i, n, lab, np.array(v, dtype=float)) for n, (i, v, lab) in enumerate(rows) if fit(v) and lab is not None]
    links = [(a, b) for a, b in itertools.combinations(good, 2) if a[2] == b[2] and len(a[3]) == len(b[3]) and cosine(a[3], b[3]) >= threshold]
    low = brute_components({i for i, _, _ in rows}, [(a[0], b[0]) for a, b in links])
    count = [0] * len(rows)
    for a, b in links:
        count[a[1]] += 1
        count[b[1]] += 1
    return sorted((i, count[n], low[i], low[i] == i) for n, (i, _, _) in enumerate(rows))


@pytest.mark.parametrize("tile_rows", [7, 1024])
def test_near_vectors_with_crowds_and_odd_rows(spark, tile_rows):
    rng = np.random.default_rng(5)
    rows = []
    for label in (0, 1):
        base = rng.normal(size=(6, 8))
        for k in range(60):
            v = base[k % 6] + rng.normal(size=8) * (0.0 if k % 5 == 0 else 0.08)
            rows.append((len(rows) + 10, v.astype(np.float32).tolist(), label))
    v = rows[0][1]
    rows += [(1, None, 0), (2, [0.0] * 8, 0), (3, [float("nan")] + v[1:], 0), (4, [None] + v[1:], 0), (5, v, None)]
    rows += [(6, [float("inf")] + v[1:], 0), (7, [], 0), (8, v[:5], 0), (9, [2 * x for x in v], 0), (rows[1][0], rows[1][1], rows[1][2])]
    frame = spark.createDataFrame([(*r, 0, 0) for r in rows], "vec_id long, embedding array<float>, label int, node int, tile int")
    got = sorted(tuple(r) for r in near_vectors(frame, tile_rows=tile_rows).collect())
    assert got == brute_vectors(rows)
    assert max(r[1] for r in got) > 5


def test_near_vectors_empty_and_without_id(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert near_vectors(spark.createDataFrame([], schema)).count() == 0
    got = near_vectors(spark.createDataFrame([(None, [1.0, 0.0], 1), (4, [1.0, 0.0], 1)], schema)).collect()
    assert sorted((r.vec_id or -1, r.n_links, r.component_id, r.kept) for r in got) == [(-1, 0, None, False), (4, 0, 4, True)]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_against_its_twin(spark, duck, name):
    ok, note = compare(spark, duck, name, queries.QUERIES[name], queries.ORACLES[name], SMALL)
    assert ok, note


def test_exploded_keys_are_not_sent_to_all_tasks(spark):
    """Spark sizes a table before an explode, so a table under its threshold could become a row a key on the driver."""
    prints = stored(spark.createDataFrame([(v * v,) for v in range(50)], "fingerprint long"))
    plan = close_pairs(prints)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
