"""Byte-level BPE with a segment tree over byte positions."""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType

from shelfpair.llm.common import Recent, plus, without

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
IDS = "<i4"
#: Longest match whose merges are worked off together with others; longer ones have a tree of their own.
TOGETHER = 64


class Merger:
    """Merges by rank. The key of a tree leaf is rank * leaves + position, so a minimum is the leftmost of the least rank."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        self.pairs = pairs
        self.keys = np.array(sorted(pairs), np.int64)
        self.values = np.array([pairs[k] for k in self.keys.tolist()], np.int64)
        single = self.single.tolist()
        self.of_bytes = np.array([pairs.get(a << 32 | b, -1) for a in single for b in single], np.int64)

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids, -1 for pairs that do not merge."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], -1)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece as little-endian bytes. A piece that is itself a token is that token."""
        out: list[bytes] = [b""] * len(pieces)
        by_size: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            rank = self.ranks.get(piece)
            if rank is not None:
                out[i] = rank.to_bytes(4, "little")
            elif len(piece) <= TOGETHER:
                by_size.setdefault(1 << (len(piece) - 1).bit_length(), []).append(i)
            elif piece:
                out[i] = np.array(self.merge_long(piece), IDS).tobytes()
        for leaves, members in by_size.items():
            for start in range(0, len(members), 8192):
                part = members[start : start + 8192]
                for i, ids in zip(part, self._merge_together([pieces[i] for i in part], leaves)):
                    out[i] = ids
        return out

    def _merge_together(self, pieces: list[bytes], leaves: int) -> list[bytes]:
        """The same merges as ``merge_long`` on many short pieces at once: a round merges one pair in each of them."""
        m, never = len(pieces), np.int64(1 << 40)
        raw = np.frombuffer(b"".join([p.ljust(leaves, b"\0") for p in pieces]), np.uint8).reshape(m, leaves)
        size = np.array([len(p) for p in pieces])[:, None]
        place = np.arange(leaves)
        ids = np.where(place < size, self.single[raw], -1)
        after = np.where(place + 1 < size, place + 1, -1)  # next live position, or -1
        before = np.where(place < size, place - 1, -1)
        tree = np.full((m, 2 * leaves), never, np.int64)
        ranks = self.of_bytes[raw[:, :-1].astype(np.int64) << 8 | raw[:, 1:]]
        tree[:, leaves:-1] = np.where((ranks >= 0) & (place[1:] < size), ranks * leaves + place[:-1], never)
        for node in range(leaves - 1, 0, -1):
            tree[:, node] = np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1])
        # everything below goes by places in the flat arrays
        ids, after, before, tree = ids.reshape(-1), after.reshape(-1), before.reshape(-1), tree.reshape(-1)

        def put(rows, at, ranks):
            tree[rows * (2 * leaves) + leaves + at] = np.where(ranks >= 0, ranks * leaves + at, never)

        def climb(rows, at):
            base, node = rows * (2 * leaves), (leaves + at) >> 1
            while len(node) and node[0]:
                left = base + 2 * node
                tree[base + node] = np.minimum(tree[left], tree[left + 1])
                node = node >> 1

        rows = np.arange(m)
        while True:
            best = tree[rows * (2 * leaves) + 1]
            open_ = best < never
            if not open_.any():
                break
            rows, best = rows[open_], best[open_]
            at, new, own = best % leaves, best // leaves, rows * leaves
            gone = after[own + at]
            right, left = after[own + gone], before[own + at]
            ids[own + at], ids[own + gone] = new, -1
            after[own + at] = right
            has_right, has_left = right >= 0, left >= 0
            before[(own + right)[has_right]] = at[has_right]
            put(rows, gone, np.full(len(rows), -1))
            put(rows, at, np.where(has_right, self._rank(new, ids[own + np.maximum(right, 0)]), -1))
            some, behind = rows[has_left], left[has_left]
            put(some, behind, self._rank(ids[own[has_left] + behind], new[has_left]))
            climb(np.concatenate([rows, rows, some]), np.concatenate([gone, at, behind]))
        kept = ids.reshape(m, leaves) >= 0
        flat = ids[kept.reshape(-1)].astype(IDS).tobytes()
        stops = (4 * np.cumsum(kept.sum(axis=1))).tolist()
        return [flat[a:b] for a, b in zip([0, *stops], stops)]

    def merge_long(self, piece: bytes) -> list[int]:
        """Merges of one piece of any length, each with three point updates of logarithmic cost."""
        n = len(piece)
        leaves = 1 << (n - 1).bit_length() if n > 1 else 1
        ids = [int(self.single[b]) for b in piece]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        none = 1 << 62
        find = self.pairs.get
        tree = [none] * (2 * leaves)
        for i in range(n - 1):
            rank = find(ids[i] << 32 | ids[i + 1])
            if rank is not None:
                tree[leaves + i] = rank * leaves + i
        for node in range(leaves - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(at: int, key: int) -> None:
            node = at + leaves
            tree[node] = key
            while node > 1:
                node >>= 1
                least = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == least:
                    return
                tree[node] = least

        def pair(at: int) -> int:
            rank = find(ids[at] << 32 | ids[after[at]]) if after[at] < n else None
            return none if rank is None else rank * leaves + at

        while tree[1] < none:
            new, at = divmod(tree[1], leaves)
            gone = after[at]
            ids[at], ids[gone] = new, -1
            after[at] = after[gone]
            if after[at] < n:
                before[after[at]] = at
            put(gone, none)
            put(at, pair(at))
            if before[at] >= 0:
                put(before[at], pair(before[at]))
        return [i for i in ids if i >= 0]


class ByteEncoder:
    """Ids of whole texts. Chunks between single spaces repeat, so a bounded number of them is remembered."""

    #: A space beside other white space: there the pattern's matches may cross a cut before that space.
    CROSSING = re.compile(r" (?:(?=\s)|(?<=\s ))")

    def __init__(self, path: str, pattern: str, most: int = 300_000, longest: int = 48):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.merger = Merger(ranks)
        words = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            words[rank] = token
        self.lengths = np.array([len(w) for w in words])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.letters = np.frombuffer(b"".join(words), np.uint8)
        self.find = regex.compile(pattern).findall
        self.words_are_matches = r"| ?\p{L}+|" in pattern
        self.longest, self.known, self.merged = longest, Recent(most), Recent(most // 2)

    def _units(self, text: str) -> list[str | tuple[str]]:
        """The text cut before each single space: every match of the pattern lies within one unit.

        A string stands for itself with a space before it, a tuple for the text in it.
        """
        if self.CROSSING.search(text):
            return [(match,) for match in self.find(text)]
        units: list = text.split(" ")
        units[0] = (units[0],)
        return units

    def encode(self, texts: list[str | None]) -> list[bytes]:
        self.known.turn()
        split = [self._units(text) if text else [] for text in texts]
        found = [self.known.known(units) for units in split]
        new = list({units[k] for units, (_, unknown) in zip(split, found) for k in unknown})
        whole = [" " + unit if isinstance(unit, str) else unit[0] for unit in new]
        matches = [self._matches(text) for text in whole]
        ids = self._pieces(list(dict.fromkeys(m for each in matches for m in each)))
        learnt = {unit: b"".join(map(ids.__getitem__, each)) for unit, each in zip(new, matches)}
        self.known.now.update((unit, learnt[unit]) for unit, text in zip(new, whole) if len(text) <= self.longest)
        for units, (values, unknown) in zip(split, found):
            for k in unknown:
                values[k] = learnt[units[k]]
        return [b"".join(values) for values, _ in found]

    def _matches(self, text: str) -> list[bytes]:
        """Matches of the pattern. Letters after a space are one, whatever pattern of this family is given."""
        if text[:1] == " " and text[1:].isalpha() and self.words_are_matches:
            return [text.encode()]
        return [m.encode("utf-8", "replace") for m in self.find(text)]

    def _pieces(self, pieces: list[bytes]) -> dict[bytes, bytes]:
        """Ids of matches of the pattern; those seen lately are not merged again."""
        self.merged.turn()
        values, unknown = self.merged.known(pieces)
        new = [pieces[k] for k in unknown]
        ids = dict(zip(new, self.merger.merge(new)))
        self.merged.now.update((piece, ids[piece]) for piece in new if len(piece) <= self.longest)
        return {piece: ids[piece] if value is None else value for piece, value in zip(pieces, values)}

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of the ids, one after the other, and where those of each id end."""
        lengths = self.lengths[ids]
        stops = np.cumsum(lengths)
        total = int(stops[-1]) if len(stops) else 0
        return self.letters[np.arange(total) + np.repeat(self.starts[ids] - stops + lengths, lengths)], stops


_ENCODERS: dict[tuple[str, str], ByteEncoder] = {}


def encoder(path: str, pattern: str) -> ByteEncoder:
    """One encoder a worker process."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = ByteEncoder(path, pattern)
    return _ENCODERS[path, pattern]


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``docs`` (text, ...) with ids: array<int> in place of text; a column `ids` that was there is replaced.

    Each match of ``pattern`` in the whole text is encoded separately by the ranks in ``path``, without special tokens. A
    null or empty text has no ids. Other columns, also null ones, pass through; repeated rows are encoded each.
    """
    path, pattern = path or public_tokenizers.path(VOCABULARY), pattern or public_tokenizers.PATTERN
    base = without(docs, "ids")
    at = base.columns.index("text")
    rest = [name for name in base.columns if name != "text"]
    schema = plus(base.drop("text"), ids=ArrayType(IntegerType()))

    def run(batches):
        own = encoder(path, pattern)
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                coded = own.encode(batch.column(at).to_pylist())
                offsets = np.concatenate([[0], np.cumsum([len(c) // 4 for c in coded])]).astype(np.int32)
                values = pa.array(np.frombuffer(b"".join(coded), IDS))
                ids = pa.ListArray.from_arrays(pa.array(offsets), values)
                yield pa.RecordBatch.from_arrays([*[batch.column(name) for name in rest], ids], [*rest, "ids"])

    return base.mapInArrow(run, schema)


def decode(coded: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``coded`` (ids: array<int>, ...) with decoded: the bytes of the ids (null ids: none)."""
    path, pattern = path or public_tokenizers.path(VOCABULARY), pattern or public_tokenizers.PATTERN
    base = without(coded, "decoded")
    at, names = base.columns.index("ids"), [*base.columns, "decoded"]
    schema = plus(base, decoded=BinaryType())

    def run(batches):
        own = encoder(path, pattern)
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                ids = batch.column(at)
                data, stops = own.decode(ids.flatten().to_numpy())
                ends = np.cumsum(np.diff(ids.offsets.to_numpy()) if ids.null_count == 0 else [len(x or ()) for x in ids.to_pylist()])
                offsets = np.concatenate([[0], np.concatenate([[0], stops])[ends]]).astype(np.int32)
                decoded = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])
                yield pa.RecordBatch.from_arrays([*batch.columns, decoded], names)

    return base.mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row of ``docs`` (doc_id, text), encoded and decoded again."""
    back = decode(encode(docs.select("doc_id", "text"), path, pattern), path, pattern)
    return back.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
