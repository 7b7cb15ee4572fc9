"""Ranked lexical search over bit-sliced Bloom signatures: upper bounds from slices, exact scores for all not excluded."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfpair.session import stored

TOP = 20
#: Documents an item is scored on first, to learn what the TOP-th best reaches; this sets the work and not the result.
SEEDS = 40
#: Bits that an entry gets at least, hash functions, documents and bits of a block at most.
BITS, HASHES, BLOCK_DOCS, BLOCK_BITS = 8, 3, 4096, 1 << 24
#: Items and characters of their texts that are searched for together; links broadcast at most.
ITEMS, ITEM_CHARS, SENT = 1000, 4_000_000, 1_000_000
#: A term that occurs at least so often in a document has a further entry; beyond, levels double.
LEVELS = np.array([1, 2, 3, *[(1 << k) + 1 for k in range(2, 40)]], np.int64)
#: Bytes of terms: letters and digits, A-Z lowered, and everything beyond ASCII; all others part terms.
BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(BYTES).split() if text else []


def _hashes(terms) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(t) for t in terms], np.uint64)


def _places(hashes: np.ndarray, level: np.ndarray | int, width: int) -> np.ndarray:
    """(HASHES, entries): slices of entries of these terms and levels, in signatures of ``width`` bits."""
    mixed = hashes + np.asarray(level).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    step = (mixed >> np.uint64(32)) | np.uint64(1)
    return ((mixed[None, :] + np.arange(HASHES, dtype=np.uint64)[:, None] * step[None, :]) & np.uint64(width - 1)).astype(np.int64)


def sliced(docs: list[tuple[np.ndarray, np.ndarray]], width: int) -> tuple[np.ndarray, int]:
    """(width, bytes) bit slices of documents given as term hashes and their counts, and the number of levels used.

    Row s holds one bit a document: whether any of its entries falls on s.
    """
    bits = np.zeros((width, -(-len(docs) // 8) * 8), np.bool_)
    most = 0
    for column, (hashes, counts) in enumerate(docs):
        levels = np.searchsorted(LEVELS, counts, "right")
        most = max(most, int(levels.max()))
        for level in range(int(levels.max())):
            bits[_places(hashes[levels > level], level, width).ravel(), column] = True
    return np.packbits(bits, axis=1), most


def signature_blocks(docs: DataFrame) -> DataFrame:
    """(doc_ids, lengths, width, levels, slices): blocks of bit-sliced Bloom signatures of ``docs`` (doc_id, text).

    A document's signature has an entry for each of its terms and one for each level of LEVELS that the number of its
    occurrences reaches. Documents of about equal size share a block, so signatures are as wide as their documents need:
    ``width`` is the power of two of BITS bits an entry, and a block holds at most BLOCK_BITS bits (one document, if it
    is larger). lengths: all terms of each document, repeats included. Rows without doc_id or any term are in no block.
    """
    out = "doc_ids array<long>, lengths array<long>, width int, levels int, slices binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_blocks: dict[int, list] = {}

        def block(width: int) -> pa.RecordBatch:
            rows = open_blocks.pop(width)
            slices, levels = sliced([(hashes, counts) for _, _, hashes, counts in rows], width)
            columns = [[[r[0] for r in rows]], [[r[1] for r in rows]], [width], [levels], [slices.tobytes()]]
            kinds = [pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int32(), pa.int32(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_ids", "lengths", "width", "levels", "slices"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts = Counter(terms_of(text.as_py()))
                if not counts:
                    continue
                numbers = np.fromiter(counts.values(), np.int64, len(counts))
                entries = int(np.searchsorted(LEVELS, numbers, "right").sum())
                width = max(64, 1 << (BITS * entries - 1).bit_length())
                rows = open_blocks.setdefault(width, [])
                rows.append((doc_id, int(numbers.sum()), _hashes(counts), numbers))
                if len(rows) >= min(BLOCK_DOCS, max(1, BLOCK_BITS // width)):
                    yield block(width)
        for width in list(open_blocks):
            yield block(width)

    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return rows.mapInArrow(run, out)


class Question:
    """Items to search for, as numbers of terms with weights, and what all documents have of them."""

    def __init__(self, texts: list[bytes | None]):
        counts = [Counter(terms_of(text)) for text in texts]
        self.terms = sorted(set().union(*counts))
        number = {term: k for k, term in enumerate(self.terms)}
        self.items = [{number[term]: n for term, n in count.items()} for count in counts]

    def weigh(self, documents: int, total: int, holding: dict[int, int]) -> None:
        """documents with a term, their terms with repeats, and in how many documents each term is."""
        self.documents, self.total = documents, total
        self.weights = [math.floor(1000 * math.log((2 * documents + 2) / (2 * holding[k] + 1))) if k in holding else 0 for k in range(len(self.terms))]
        self.items = [{k: n for k, n in item.items() if self.weights[k]} for item in self.items]
        used = sorted(set().union(*self.items))
        self.hashes, row = _hashes([self.terms[k] for k in used]), {k: r for r, k in enumerate(used)}
        self.rows = [np.array([row[k] for k in item], np.int64) for item in self.items]
        self.shares = [np.array([n * self.weights[k] for k, n in item.items()], np.float64) for item in self.items]

    def norm(self, length):
        return 75 + (25 * length * self.documents) // self.total

    def score(self, item: int, counts: Counter, length: int) -> int:
        m, sum_ = self.norm(length), 0
        for k, n in self.items[item].items():
            if tf := counts.get(self.terms[k]):
                sum_ += n * self.weights[k] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))
        return sum_

    def bounds(self, lengths: np.ndarray, width: int, levels: int, slices: bytes) -> np.ndarray:
        """(items, documents of a block): no document's score is above its bound.

        A term without an entry of a level occurs less often than that level asks; with it, it may occur as often as the
        next level leaves open. So each level's presence bits, weighted by the terms' shares and summed over an item, are
        worth what the score can grow between the two.
        """
        columns = len(lengths)
        table = np.frombuffer(slices, np.uint8).reshape(width, -1)
        m = np.array([self.norm(int(n)) for n in lengths], np.int64)
        out = np.zeros((len(self.items), columns))
        below, before = np.zeros(columns), None
        for level in range(levels):
            most = int(LEVELS[level + 1]) - 1
            above = ((1_000_000_000 * most) // (1000 * most + 12 * m)).astype(np.float64)
            places = _places(self.hashes, level, width)
            bits = table[places[0]]
            for other in places[1:]:
                bits &= table[other]
            if before is not None:
                bits &= before
            before = bits
            present = np.unpackbits(bits, axis=1, count=columns) if len(bits) else np.zeros((0, columns), np.uint8)
            some = bits.any(axis=1)
            worth = above - below
            for item, rows in enumerate(self.rows):
                held = some[rows]
                if held.any():
                    out[item] += (self.shares[item][held] @ present[rows[held]]) * worth
            below = above
            if not some.any():
                break
        return out


def _count(docs: DataFrame, question: Question) -> None:
    """Weighs the terms of ``question`` by all documents."""
    terms = {term: k for k, term in enumerate(question.terms)}

    def run(batches):
        held, documents, total = Counter(), 0, 0
        for batch in batches:
            for text in batch.column(0):
                words = terms_of(text.as_py())
                documents += bool(words)
                total += len(words)
                held.update(terms.keys() & words)
        found = [(-2, documents), (-1, total), *((terms[t], n) for t, n in held.items())]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["term", "n"])

    rows = docs.where("doc_id is not null").select(F.col("text").cast("binary")).mapInArrow(run, "term long, n long")
    counts = {r.term: r.n for r in rows.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    question.weigh(counts.pop(-2, 0), counts.pop(-1, 0), counts)


def _bounded(blocks: DataFrame, question: Question, least: list[int] | None, top: int) -> DataFrame:
    """(item, doc_id, bound): all with a bound of at least ``least`` of their item, or the ``top`` highest of each task."""

    def run(batches):
        best = [(np.empty(0), np.empty(0, np.int64)) for _ in question.items]
        for batch in batches:
            for ids, lengths, width, levels, slices in zip(*[column.to_pylist() for column in batch.columns]):
                ids, bounds = np.array(ids, np.int64), question.bounds(np.array(lengths, np.int64), width, levels, slices)
                if least is not None:
                    item, column = np.nonzero(bounds >= np.maximum(1, np.array(least))[:, None])
                    yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(ids[column]), pa.array(bounds[item, column].astype(np.int64))], names)
                    continue
                for item, row in enumerate(bounds):
                    have, known = best[item]
                    row = np.concatenate([have, row])
                    places = np.argpartition(-row, top - 1)[:top] if len(row) > top else np.arange(len(row))
                    best[item] = row[places], np.concatenate([known, ids])[places]
        for item, (row, ids) in enumerate(best):
            some = row > 0
            yield pa.RecordBatch.from_arrays([pa.array(np.full(some.sum(), item)), pa.array(ids[some]), pa.array(row[some].astype(np.int64))], names)

    names = ["item", "doc_id", "bound"]
    return blocks.mapInArrow(run, "item long, doc_id long, bound long")


def _scored(docs: DataFrame, question: Question, wanted: DataFrame) -> DataFrame:
    """(item, doc_id, score) of the documents in ``wanted`` (item, doc_id), by their whole texts; scores above 0 only.

    Texts are read again and joined with the list of what is wanted, which is sent to all tasks if it holds at most SENT
    links, and dealt out by doc_id otherwise.
    """
    wanted = stored(wanted.select("item", "doc_id").distinct())
    listed = wanted.groupBy("doc_id").agg(F.collect_list("item").alias("items"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    joined = rows.join(F.broadcast(listed) if wanted.count() <= SENT else listed, "doc_id").select("doc_id", "text", "items")

    def run(batches):
        for batch in batches:
            found = []
            for doc_id, text, items in zip(*[column.to_pylist() for column in batch.columns]):
                words = terms_of(text)
                counts, length = Counter(words), len(words)
                found += [(item, doc_id, score) for item in items if (score := question.score(item, counts, length))]
            columns = list(zip(*found)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item", "doc_id", "score"])

    return joined.mapInArrow(run, "item long, doc_id long, score long")


def _ranked(rows: DataFrame, value: str, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc(value), "doc_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search(docs: DataFrame, items: DataFrame, top: int = TOP, blocks: DataFrame | None = None) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of highest score above 0 for each row of ``items``.

    ``docs`` (doc_id, text) are whole texts, ``items`` (item_id, text) the questions; ``blocks`` is a stored result of
    ``signature_blocks`` for the same documents. Equal scores rank by ascending doc_id. Rows of ``docs`` without doc_id are
    no documents; repeated rows are documents of their own, and repeated items each get their rows. Null and empty texts
    have no terms. Further columns are ignored.

    All blocks give upper bounds. The SEEDS documents of the highest bounds are scored first; the ``top``-th best of them
    is a score that the result reaches at least, so only documents whose bound is not below it are scored after that.
    Bounds never fall short, so the result is that of scoring everything.
    """
    blocks = stored(signature_blocks(docs)) if blocks is None else blocks
    each = items.select("item_id", F.col("text").cast("binary").alias("text")).groupBy("item_id", "text").agg(F.count("*").alias("copies"))
    n, chars = each.agg(F.count("*"), F.sum(F.length("text"))).first()
    parts = max(1, -(-n // ITEMS), -(-(chars or 0) // ITEM_CHARS))
    each = stored(each.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))))
    out = None
    for part in range(parts):
        asked = each.where(F.col("part") == part).collect()
        question = Question([r.text for r in asked])
        _count(docs, question)
        first = _scored(docs, question, _ranked(_bounded(blocks, question, None, max(SEEDS, top)), "bound", max(SEEDS, top)))
        reached = {r.item: r.score for r in _ranked(first, "score", top).where(F.col("rank") == top).collect()}
        near = _bounded(blocks, question, [reached.get(item, 1) for item in range(len(asked))], top)
        best = _ranked(_scored(docs, question, near), "score", top)
        ids = docs.sparkSession.createDataFrame([(k, r.item_id, r.copies) for k, r in enumerate(asked)], f"item long, item_id {each.schema['item_id'].dataType.simpleString()}, copies long")
        rows = best.join(ids, "item").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
        rows = rows.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        out = rows if out is None else out.unionByName(rows)
    return out
