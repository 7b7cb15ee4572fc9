"""Groups of texts by the exact Jaccard similarity of their word shingles: prefix filter, then verification."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfpair.llm.common import slices
from shelfpair.llm.components import components
from shelfpair.session import stored

WIDTH, SIMILARITY = 5, 0.8


def shingles_of(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted different 64-bit hashes of the word shingles; one for a text of fewer words, none without a word."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z are lowered, only ASCII white space splits
    n = max(min(1, len(words)), len(words) - width + 1)
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + width])) for i in range(n)]
    return np.unique(np.array(hashes, "<u8").view("<i8"))


def head_length(size: int, similarity: float) -> int:
    """How many shingles, first in any common order, two sets of this similarity cannot both have without a common one."""
    return size - ceil(similarity * size - 1e-9) + 1 if size else 0


def sketch_of(shingles: np.ndarray) -> bytes | None:
    """How many shingles fall into each of a power of two of buckets, a quarter of their number or more; None beyond a byte."""
    buckets = max(32, 1 << max(0, (len(shingles) - 1) // 4).bit_length())
    counts = np.bincount(shingles & (buckets - 1), minlength=buckets)
    return counts.astype(np.uint8).tobytes() if counts.max() < 256 else None


#: Counters and largest set of the sketches that the last turn compares within its join.
COUNTERS, SMALL = 64, 256


def counters_of(shingles: np.ndarray) -> list[int] | None:
    """How many shingles fall into each of COUNTERS buckets; None for a set of more than SMALL."""
    return np.bincount(shingles & (COUNTERS - 1), minlength=COUNTERS).tolist() if len(shingles) <= SMALL else None


def may_share(a: bytes | None, b: bytes | None) -> int | None:
    """What two sets share at most, by their sketches, the larger one folded to the smaller; None if a sketch is missing."""
    if a is None or b is None:
        return None
    a, b = (np.frombuffer(x, np.uint8).astype(np.int64) for x in (a, b))
    size = min(len(a), len(b))
    return int(np.minimum(a.reshape(-1, size).sum(axis=0), b.reshape(-1, size).sum(axis=0)).sum())


def _marked(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, text) of the rows with a doc_id; doc_id and mark tell texts apart, also under one doc_id."""
    return docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), "text")


def _heads(docs: DataFrame, width: int, part: Callable[[np.ndarray], np.ndarray], fingerprint: Callable[[str | None], int] | None = None) -> DataFrame:
    """(row, doc_id, mark, digest, size, sketch, counters, head, fingerprint) of every row; head is ``part`` of the whole set."""

    def run(batches):
        for batch in slices(batches):
            texts = batch.column(2).to_pylist()
            sets = [shingles_of(text, width) for text in texts]
            heads = [part(s) for s in sets]
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in heads])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int32()),
                    pa.array([sketch_of(s) for s in sets], pa.binary()),
                    pa.array([counters_of(s) for s in sets], pa.list_(pa.int16())),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.empty(0, "<i8"), *heads]), pa.int64())),
                    pa.array([fingerprint(text) if fingerprint else None for text in texts], pa.int64()),
                ],
                ["doc_id", "mark", "digest", "size", "sketch", "counters", "head", "fingerprint"],
            )

    kinds = "doc_id long, mark long, digest binary, size int, sketch binary, counters array<short>, head array<long>, fingerprint long"
    rows = _marked(docs).mapInArrow(run, kinds)
    return rows.withColumn("row", F.monotonically_increasing_id())


#: Shingles put last, at most; the sample of documents that tells them.
LATE, SAMPLE = 50_000, 20_000
#: Rows of a list that is sent to all tasks, at most; longer lists are joined by a shuffle. Shingles verified together.
SENT, TOGETHER = 1_000_000, 1_000_000


def _frequent(docs: DataFrame, width: int, similarity: float, crowd: int) -> np.ndarray:
    """Sorted shingles in the heads of more than ``crowd`` documents, as told by a sample; at most LATE of them.

    They only set the order of the shingles, so they decide the work and never the result.
    """
    total = docs.count()
    share = min(1.0, SAMPLE / max(1, total))
    sampled = docs if share == 1 else docs.where(F.shiftrightunsigned(F.xxhash64("doc_id"), 1) < F.lit(int(share * 2**63)))
    heads = _heads(sampled, width, lambda s: s[: head_length(len(s), similarity)]).select(F.explode("head").alias("h"))
    counts = heads.groupBy("h").count().where(F.col("count") > max(3 if share < 1 else 0, crowd * share))
    return np.sort(np.array([r.h for r in counts.orderBy(F.desc("count"), "h").limit(LATE).collect()], "<i8"))


def _listed(rows: DataFrame) -> DataFrame:
    """A stored list to join with: sent to all tasks, if it is short."""
    return F.broadcast(rows) if rows.count() <= SENT else rows


def _short(h: Column) -> Column:
    return F.hash(h)


#: Shingles of a head that are compared as a whole in the last turn, at most.
KNOWN = 64


def _known_heads(shared: DataFrame) -> DataFrame:
    """(node, tokens): sorted 32-bit hashes of those shingles of each head that other heads have too.

    tokens is null if there are more than KNOWN, or if two of them have the same hash, so the hashes two nodes share are
    never fewer than the shingles. At most KNOWN + 1 are gathered a node.
    """
    counted = shared.groupBy("node").agg(F.count("*").alias("n"), F.count_distinct(_short(F.col("h"))).alias("different"))
    few = counted.where((F.col("n") <= KNOWN) & (F.col("n") == F.col("different"))).select("node")
    tokens = shared.join(few, "node").groupBy("node").agg(F.sort_array(F.collect_list(_short(F.col("h")))).alias("tokens"))
    return stored(counted.select("node").join(tokens, "node", "left"))


#: Nodes that the shingles of a crowd may choose to be compared with in the second turn.
HUBS = 16
#: Shingles before each one of a head that travel with it in the last turn.
BEFORE = 4


def _with_earlier(rest: DataFrame) -> DataFrame:
    """Adds ``earlier``: the up to BEFORE shingles that stand before this one among the rows of its node, by ``place``.

    Two nodes that meet at a shingle and have one of these in common have met there before, so a pair that shares many
    shingles leaves the join about once a run of them. The first shingle that two nodes share has none in common before it,
    and it leaves most behind it, so no pair is lost.
    """
    before = Window.partitionBy("node").orderBy("place").rowsBetween(-BEFORE, -1)  # the head of one text
    return rest.withColumn("earlier", F.collect_list("h").over(before))


def _joined(component: DataFrame | None, found: DataFrame) -> DataFrame:
    """(node, component) after the links ``found`` (a, b), from (node, component) before them, stored.

    Links are between components by then, once each, so what was linked before is not passed through again.
    """
    if component is None:
        return components(found)
    for end in ("a", "b"):
        known = component.select(F.col("node").alias(end), F.col("component").alias(f"{end}_component"))
        found = found.join(known, end, "left").withColumn(end, F.coalesce(f"{end}_component", end)).drop(f"{end}_component")
    links = found.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    merged = components(stored(links))
    whole = merged.select(F.col("node").alias("component"), F.col("component").alias("whole"))
    before = component.join(whole, "component", "left").select("node", F.coalesce("whole", "component").alias("component"))
    return stored(before.unionByName(merged.join(component, "node", "left_anti")))


#: One in so many pairs of the last turn is settled before the others.
SOONER = 4


def _apart(pairs: DataFrame, component: DataFrame) -> DataFrame:
    """The pairs (a, b) whose ends are not in one component yet."""
    columns = pairs.columns
    for end in ("a", "b"):
        known = component.select(F.col("node").alias(end), F.col("component").alias(f"{end}_component"))
        pairs = pairs.join(known, end, "left")
    return pairs.where(F.coalesce("a_component", "a") != F.coalesce("b_component", "b")).select(*columns)


def _possible(pairs: DataFrame, sketches: DataFrame, similarity: float) -> DataFrame:
    """The pairs (node, hub) whose sketches leave room for the similarity, with the size of node."""
    for end in ("node", "hub"):
        pairs = pairs.join(sketches.select(F.col("node").alias(end), F.col("size").alias(f"{end}_size"), F.col("sketch").alias(f"{end}_sketch")), end)

    def run(batches):
        for batch in batches:
            keep = []
            for m, n, a, b in zip(*[batch.column(k).to_pylist() for k in (2, 3, 4, 5)]):
                most = may_share(a, b)
                keep.append(most is None or most >= similarity * (m + n - most) - 1e-9)
            yield batch.select([0, 1, 2]).filter(pa.array(keep, pa.bool_()))

    rows = pairs.select("node", "hub", "node_size", "hub_size", "node_sketch", "hub_sketch")
    return rows.mapInArrow(run, "node long, hub long, node_size int")


def _similar(pairs: DataFrame, texts: DataFrame, names: DataFrame, width: int, similarity: float) -> DataFrame:
    """(a, b) of the stored pairs (node, hub, node_size) that reach the similarity, by their whole sets.

    A hub's set goes once to each group of pairs; a hub with many pairs has several groups, each of about TOGETHER shingles.
    """
    wanted = stored(pairs.select(F.explode(F.array("node", "hub")).alias("node")).distinct().join(names.select("node", "doc_id", "mark"), "node"))

    def sets_of(batches):
        for batch in slices(batches):
            sets = [shingles_of(text, width).tobytes() for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["node", "shingles"])

    sets = stored(texts.join(_listed(wanted), ["doc_id", "mark"]).select("node", "text").mapInArrow(sets_of, "node long, shingles binary"))
    groups = pairs.groupBy("hub").agg(F.ceil(F.sum("node_size") / TOGETHER).alias("groups"))
    dealt = pairs.join(groups, "hub").select("node", "hub", F.pmod(F.xxhash64("node"), F.greatest("groups", F.lit(1))).alias("part"))
    others = dealt.join(sets, "node").select("hub", "part", "node", "shingles")
    hubs = dealt.select("hub", "part").distinct().join(sets.withColumnRenamed("node", "hub"), "hub").select("hub", "part", F.lit(None).cast("long").alias("node"), "shingles")

    def verify(rows: pa.Table) -> pa.Table:
        hub, nodes = rows["hub"][0].as_py() if rows.num_rows else None, rows["node"].to_pylist()
        sets = [np.frombuffer(x, "<i8") for x in rows["shingles"].to_pylist()]
        own = next((s for s, node in zip(sets, nodes) if node is None), None)
        found = []
        for s, node in zip(sets, nodes):
            if node is not None and own is not None and len(s) and len(own):
                places = np.searchsorted(own, s)
                both = int((own[np.minimum(places, len(own) - 1)] == s).sum())
                if both / (len(s) + len(own) - both) >= similarity:
                    found.append(node)
        low = [min(hub, node) for node in found]
        return pa.table([pa.array(low, pa.int64()), pa.array([max(hub, node) for node in found], pa.int64())], ["a", "b"])

    return others.unionByName(hubs).groupBy("hub", "part").applyInArrow(verify, "a long, b long").distinct()


def jaccard_rows(docs: DataFrame, width: int = WIDTH, similarity: float = SIMILARITY, crowd: int = 100, first: tuple[Callable, Callable] | None = None) -> DataFrame:
    """(doc_id, mark, digest, component) for every row of ``docs`` (doc_id, text) that has a doc_id, stored.

    Documents link if the Jaccard similarity of their shingle sets is at least ``similarity``; component tells the groups of
    linked ones apart. mark is a hash of the text: rows of one doc_id with different texts are documents of their own.
    Null and empty texts are one group. Every such pair ends in one group: none is sampled or capped. Repeated rows and
    texts with equal sets are one node; very long texts have sketches and heads in proportion. Further columns are ignored.

    Shingles are ordered by their hash, frequent ones last (``_frequent``); two similar sets share a shingle among the first
    ones (``head_length``), and the first they share leaves enough behind it in both. Documents that share one are compared
    with one of them first, twice, the second time with up to HUBS in a crowd, so that most of one whose texts are alike,
    but seldom enough, fall together there; then all pairs that are still in different components are, unless their whole heads
    tell that they share too little. So a crowd of near copies costs about a pair a document. A pair is looked at once: sizes, places, then sketches, then whole sets. ``crowd`` changes
    the work, not the result.

    ``first``: a function from a text to a fingerprint (long), and one from (node, fingerprint) of the different sets to pairs (node, hub).
    These pairs are compared before all others, by the same sketches and whole sets, so they set the work and never the result.
    """
    fingerprint, close = first or (None, None)
    late = _frequent(docs, width, similarity, crowd)

    def head(values: np.ndarray) -> np.ndarray:
        last = np.isin(values, late)
        return np.concatenate([values[~last], values[last]])[: head_length(len(values), similarity)]

    rows = stored(_heads(docs, width, head, fingerprint))
    names = stored(rows.groupBy("digest").agg(F.min("row").alias("node")))
    own = stored(rows.join(_listed(names.select(F.col("node").alias("row"))), "row", "left_semi").withColumnRenamed("row", "node"))
    entries = own.select("node", "size", F.posexplode("head").alias("place", "h"))
    crowded = entries.groupBy("h").count().where("count > 1").select("h")
    shared = stored(entries.join(crowded, "h"))
    sketches, texts = own.select("node", "size", "sketch"), _marked(docs)

    component = tried = None

    def compare(met: DataFrame, sooner: bool = False) -> None:
        """Settles the pairs (node, hub) that were not tried before, once a pair, whichever end is the hub.

        ``sooner``: one in SOONER of them first, then those of the others that this has not brought into one component.
        """
        nonlocal component, tried
        met = met.groupBy(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).agg(F.min("hub").alias("hub"))
        met = stored(met if tried is None else met.join(tried, ["a", "b"], "left_anti"))
        tried = met.select("a", "b") if tried is None else tried.unionByName(met.select("a", "b"))
        chance = F.pmod(F.xxhash64("a", "b"), F.lit(SOONER))
        for some in (met.where(chance == 0), met.where(chance > 0)) if sooner else (met,):
            if sooner and component is not None:
                some = _apart(some, component)
            pairs = some.select(F.when(F.col("hub") == F.col("a"), F.col("b")).otherwise(F.col("a")).alias("node"), "hub")
            found = _similar(stored(_possible(pairs, sketches, similarity)), texts, rows.select(F.col("row").alias("node"), "doc_id", "mark"), width, similarity)
            component = _joined(component, stored(found))

    if close:
        compare(close(own.select("node", "fingerprint")))
    length = lambda n: n - F.ceil(similarity * n - 1e-9) + 1  # noqa: E731  as head_length
    for turn in (0, 1, None):
        known = F.lit(None).cast("long") if component is None else F.col("component")
        named = (shared if component is None else shared.join(component, "node", "left")).withColumn("part", F.coalesce(known, "node"))
        mixed = named.groupBy("h").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high").select("h")
        rest = stored(named.join(mixed, "h", "left_semi").select("h", "node", "size", "place", "part"))
        if turn is None:
            rest = _with_earlier(rest.join(_known_heads(shared), "node").join(own.select("node", "counters"), "node"))
        other = rest.select("h", *[F.col(c).alias("hub" if c == "node" else f"hub_{c}") for c in rest.columns if c != "h"])
        if turn is not None:
            chance = F.pmod("h", F.lit(HUBS)) if turn else F.lit(0)
            lowest = F.min(F.struct(F.xxhash64("hub", chance, F.lit(turn)).alias("order"), "hub", "hub_size", "hub_place", "hub_part")).alias("first")
            other = other.groupBy("h").agg(lowest).select("h", "first.*")
        needed = similarity / (1 + similarity) * (F.col("size") + F.col("hub_size")) - 1e-9
        left = F.least(F.col("size") - F.col("place"), F.col("hub_size") - F.col("hub_place"))
        apart = (F.col("part") != F.col("hub_part")) & (F.least("size", "hub_size") >= similarity * F.greatest("size", "hub_size") - 1e-9)
        enough = left >= needed
        if turn is None:
            # What two heads share and what stands behind the one that ends first bound what the sets share. Where both
            # heads are known, that tells more than the place of one shingle, and one of the shared ones meets each pair.
            # Small sets are then compared by their counters, so that pairs that share less do not leave the join.
            behind = F.greatest(F.col("size") - length(F.col("size")), F.col("hub_size") - length(F.col("hub_size")))
            both = F.array_intersect("tokens", "hub_tokens")
            some = F.least(F.size("tokens"), F.size("hub_tokens")) + behind >= needed
            shared_enough = some & (F.size(both) + behind >= needed) & (F.get(both, F.lit(0)) == _short(F.col("h")))
            most = F.aggregate(F.zip_with("counters", "hub_counters", lambda x, y: F.least(x, y)), F.lit(0), lambda total, x: total + x)
            shared_enough &= F.coalesce(most >= needed, F.lit(True))  # null for large sets
            enough &= ~F.arrays_overlap("earlier", "hub_earlier")
            enough = F.when(F.col("tokens").isNull() | F.col("hub_tokens").isNull(), enough).otherwise(shared_enough)
            apart &= F.col("node") < F.col("hub")
        compare(rest.join(other, "h").where(apart & enough).select("node", "hub"), turn is None)
    grouped = names.join(component, "node", "left").select("digest", F.coalesce("component", "node").alias("component"))
    return stored(rows.select("doc_id", "mark", "digest").join(grouped, "digest"))


def jaccard_groups(docs: DataFrame, width: int = WIDTH, similarity: float = SIMILARITY, crowd: int = 100) -> DataFrame:
    """(doc_id, component_id) for every row of ``docs`` that has a doc_id; component_id is the smallest doc_id of the group.

    See ``jaccard_rows`` for what links, and for null, empty, repeated and very long texts.
    """
    rows = jaccard_rows(docs, width, similarity, crowd)
    lowest = rows.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return rows.join(lowest, "component").select("doc_id", "component_id")
