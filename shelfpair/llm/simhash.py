"""SimHash near-duplicates by pigeonhole blocks."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfpair.llm.common import fresh, slices
from shelfpair.llm.components import components
from shelfpair.llm.jaccard import SENT, SIMILARITY, WIDTH, jaccard_rows
from shelfpair.session import stored

BITS, SHINGLE, SEED = 64, 3, 42


def fingerprint_of(text: str | None) -> int:
    """Signed 64-bit SimHash of the word shingles; zero if there is no word.

    A bit is set if it is set in over half of the shingle hashes, repeats included. Hashes are summed in slices, so a
    very long text needs little memory beside its words.
    """
    words = (text or "").encode().lower().split()  # bytes: only A-Z are lowered, only ASCII white space splits
    if not words:
        return 0
    n = max(1, len(words) - SHINGLE + 1)
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, dtype=np.int64)
    for start in range(0, n, 1 << 16):
        stop = min(n, start + (1 << 16))
        if len(words) < SHINGLE:
            hashes = [digest(b" ".join(words), SEED)]
        else:
            shingles = zip(words[start:stop], words[start + 1 : stop + 1], words[start + 2 : stop + 2], strict=True)
            hashes = [digest(b"%b %b %b" % s, SEED) for s in shingles]
        octets = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits((2 * ones > n).astype(np.uint8), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint: long) of every row of ``docs`` (doc_id, text; further columns are ignored)."""

    def run(batches):
        for batch in slices(batches):
            values = [fingerprint_of(text) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.int64())], ["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fingerprint long")


def _masks(blocks: int, distance: int) -> tuple[list[int], list[int]]:
    """Bits of each block, and for each choice of ``distance`` blocks the bits of all the others."""
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    own = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(cuts, cuts[1:])]
    keys = [((1 << BITS) - 1) ^ sum(own[i] for i in left_out) for left_out in combinations(range(blocks), distance)]
    return own, keys


def _signed(value: int) -> Column:
    return F.lit(value - (1 << BITS) if value >> (BITS - 1) else value).cast("long")


def close_pairs(prints: DataFrame, distance: int = 2, blocks: int = 8) -> DataFrame:
    """(a, b) once for each two values of ``prints`` (fingerprint: long, distinct) that differ in 1 to ``distance`` bits.

    Pigeonhole: fingerprints cut into ``blocks`` blocks that differ in at most ``distance`` bits agree on some choice of
    ``blocks - distance`` blocks. Each choice is a join key, and the join verifies the Hamming distance. A key leaves
    ``distance`` blocks open (16 bits by default), so even a crowd of near copies falls apart into groups of at most 2**16
    distinct values, whatever the size of the table; copies were merged before.
    A pair agrees under several keys if its differing bits lie in fewer blocks; only the first such key reports it.

    Both sides are shuffled: Spark sizes them before the ``explode`` and would send a row a key and fingerprint to the driver.
    """
    own, keys = _masks(blocks, distance)
    choices = list(combinations(range(blocks), distance))
    keyed = prints.select(
        "fingerprint",
        F.posexplode(F.array(*[F.col("fingerprint").bitwiseAND(_signed(mask)) for mask in keys])).alias("choice", "key"),
    )
    left = keyed.withColumnRenamed("fingerprint", "a").hint("merge")
    right = keyed.withColumnRenamed("fingerprint", "b")
    mixed = F.col("a").bitwiseXOR(F.col("b"))
    # the first choice that contains every block with a differing bit
    differs = [mixed.bitwiseAND(_signed(mask)) != 0 for mask in own]
    first = F.lit(None).cast("int")
    for number, left_out in reversed(list(enumerate(choices))):
        others = [differs[i] for i in range(blocks) if i not in left_out]
        covered = ~F.greatest(*others) if len(others) > 1 else ~others[0]
        first = F.when(covered, number).otherwise(first)
    found = left.join(right, ["choice", "key"]).where((F.col("a") < F.col("b")) & (F.bit_count(mixed) <= distance))
    return found.where(F.col("choice") == first).select("a", "b")


def simhash_groups(docs: DataFrame, distance: int = 2, blocks: int = 8) -> DataFrame:
    """(doc_id, fingerprint: 16 hex digits, component_id) for every row of ``docs`` (doc_id, text).

    Documents link if their fingerprints differ in at most ``distance`` bits; component_id is the smallest doc_id
    reachable, itself included. Null and empty texts have fingerprint zero, which links like any other. Equal fingerprints
    are one node, named by their smallest doc_id, so a crowd of copies costs one row. Repeated rows each come back. A row
    without doc_id comes back with the group of its fingerprint, but names none (component_id is null if no id is there).
    """
    rows = stored(fingerprints(docs))
    nodes = stored(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("node")))
    pairs = stored(close_pairs(nodes.select("fingerprint"), distance, blocks))
    ends = [nodes.select(F.col("fingerprint").alias(end), F.col("node").alias(f"{end}_node")) for end in ("a", "b")]
    links = pairs.join(ends[0], "a").join(ends[1], "b").select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))
    grouped = stored(
        nodes.join(components(links), "node", "left").select("fingerprint", F.coalesce("component", "node").alias("component_id"))
    )
    return rows.join(grouped, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def like_first(nodes: DataFrame, distance: int = 2, blocks: int = 8) -> DataFrame:
    """(node, hub) for ``nodes`` (node, fingerprint; node distinct): texts whose fingerprints differ in at most ``distance`` bits.

    Nodes of one fingerprint meet the smallest of them, and these meet for each close pair of fingerprints: a crowd costs a pair a node.
    """
    named = stored(nodes.groupBy("fingerprint").agg(F.min("node").alias("hub")))
    equal = nodes.join(named, "fingerprint").where("node <> hub").select("node", "hub")
    pairs = stored(close_pairs(named.select("fingerprint"), distance, blocks))
    ends = [named.select(F.col("fingerprint").alias(end), F.col("hub").alias(name)) for end, name in (("a", "hub"), ("b", "node"))]
    return equal.unionByName(pairs.join(ends[0], "a").join(ends[1], "b").select("node", "hub"))


def drop_near_copies(docs: DataFrame, width: int = WIDTH, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` less all but one document of each group of near copies, with their own columns.

    Near copies have a Jaccard similarity of at least ``similarity`` of their shingles of ``width`` words (see
    ``jaccard_rows``). SimHash finds the first candidates, by the pigeonhole blocks of ``simhash_groups``; the exact similarity
    is checked for each. Two fingerprint bits find hardly more than exact copies, and pairs at 0.8 differ in a dozen bits, so
    the turns of ``jaccard_rows`` then find all that are left.
    The smallest doc_id stays. Different texts under one doc_id are documents of their own: each stays unless it is a near
    copy of another; of near copies under the smallest doc_id the one with the smallest hash stays. Of rows with the
    same doc_id and text one stays. Rows without doc_id stay, as no group can name them.
    """
    rows = jaccard_rows(docs, width, similarity, first=(fingerprint_of, like_first))
    first = F.min(F.struct("doc_id", "mark"))
    kept = rows.groupBy("component").agg(first.alias("first")).select("first.*")
    counted = stored(rows.groupBy("doc_id", "mark").agg(F.count("*").alias("copies")).join(kept, ["doc_id", "mark"], "left_semi"))
    mark, copies = fresh("mark_of_text", docs), fresh("copies_of_row", docs)
    listed = counted.select(F.col("doc_id"), F.col("mark").alias(mark), F.col("copies").alias(copies))
    short = counted.count() <= SENT
    named = docs.withColumn(mark, F.xxhash64("text")).join(F.broadcast(listed) if short else listed, ["doc_id", mark])
    columns = [F.col(f"`{name}`") for name in docs.columns]
    once = named.where(F.col(copies) == 1).select(*columns)
    again = named.where(F.col(copies) > 1).dropDuplicates(["doc_id", mark]).select(*columns)
    return once.unionByName(again).unionByName(docs.where("doc_id is null"))
