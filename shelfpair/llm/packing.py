"""Packing by power-of-two decomposition: no sequence crosses documents, and none is padded."""

from __future__ import annotations

import re
import zlib
from array import array
from itertools import pairwise

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType
from tokenizers import Tokenizer

from shelfpair.llm.common import plus, slices, without

VOCABULARY = "word_bpe_49k.json"
LENGTH, END = 2048, 1
IDS = "<u4"
#: Parts that the sequences of one length are dealt to.
SALTS = 1024
#: Bytes that byte-level vocabularies show as themselves; the others are shown as the characters from 256 on.
SHOWN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
CHARACTERS = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in SHOWN)}


class WordEncoder(dict):
    """Token ids of whole texts as little-endian bytes; as a dictionary, the ids of chunks.

    The tokenizer drops white space and lets nothing pass over it, so the ids of a text are those of its chunks between
    ASCII white space. Chunks repeat, so the latest are remembered, at most twice ``most`` of them.
    A new chunk of printable Latin characters is lowered and split here, by the tokenizer's own pattern, and only merged by
    the tokenizer: in that range its normal form, lower case and classes are plain. Any other new chunk goes through the
    whole tokenizer.
    """

    PLAIN = re.compile(r"[\x21-\x7e\xa1-\u024f]+").fullmatch
    SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall

    def __init__(self, path: str, most: int = 500_000, longest: int = 48):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        special = [re.escape(token.content) for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(special) or r"(?!)").search
        self.most, self.longest, self.before = most, longest, {}

    def __missing__(self, chunk: bytes) -> bytes:
        ids = self.before.get(chunk)
        if ids is None:
            text = chunk.decode()
            if self.PLAIN(text) and not self.special(text):
                words = self.SPLIT(text.lower())
                if not text.isascii():
                    words = [word.encode().decode("latin-1").translate(CHARACTERS) for word in words]
                ids = array("I", [token.id for word in words for token in self.merge(word)]).tobytes()
            else:
                ids = array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        if len(chunk) <= self.longest:
            self[chunk] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        if len(self) > self.most:
            self.before = dict(self)
            self.clear()
        return b"".join(map(self.__getitem__, (text or "").encode().split()))


def cut(n: int, longest: int = LENGTH) -> list[int]:
    """Lengths of the pieces of ``n`` tokens, longest first: full ones, then the binary digits of the rest."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


#: Chunks that a worker process remembers, twice at most; a million take about 200 MB.
REMEMBERED = 500_000
_ENCODERS: dict[tuple[str, int], WordEncoder] = {}


def _encoder(path: str, remembered: int) -> WordEncoder:
    """One encoder a worker process, so that later batches profit from what it remembers."""
    if (path, remembered) not in _ENCODERS:
        _ENCODERS[path, remembered] = WordEncoder(path, remembered)
    return _ENCODERS[path, remembered]


def pieces(docs: DataFrame, path: str, end: int = END, longest: int = LENGTH, remembered: int = REMEMBERED, given: tuple[str, ...] = ("ids",)) -> DataFrame:
    """(doc_id, start, length, doc_tokens, and what ``given`` names) of every piece of every row of ``docs`` (doc_id, text).

    ``given``: ids, and ids_crc32, their CRC-32 as little-endian unsigned 32-bit numbers.

    A document is the ids of its whole text (null: none) and ``end``. Its pieces are powers of two of at most ``longest``
    (itself one), follow each other without gap, and hold each id once. Repeated rows are cut each; further columns
    are ignored; doc_id may be null.
    """

    def run(batches):
        encoder = _encoder(path, remembered)
        tail = np.array([end], IDS).tobytes()
        for batch in slices(batches):
            coded = [encoder.encode(text) + tail for text in batch.column(1).to_pylist()]
            tokens = [len(ids) // 4 for ids in coded]
            lengths = [cut(n, longest) for n in tokens]
            flat = np.array([n for row in lengths for n in row], np.int64)
            count = np.array([len(row) for row in lengths])
            owner = np.repeat(np.arange(len(count)), count)
            offsets = np.concatenate([[0], np.cumsum(flat)])
            doc_start = np.concatenate([[0], np.cumsum(tokens)])[:-1]
            data = b"".join(coded)
            columns = [batch.column(0).take(pa.array(owner)), pa.array(offsets[:-1] - doc_start[owner]), pa.array(flat), pa.array(np.array(tokens, np.int64)[owner])]
            for name in given:
                if name == "ids":
                    columns.append(pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(np.frombuffer(data, IDS).astype(np.int32))))
                else:
                    ends = (4 * offsets).tolist()
                    columns.append(pa.array([zlib.crc32(data[a:b]) for a, b in pairwise(ends)], pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "doc_tokens", *given])

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    kinds = {"ids": "array<int>", "ids_crc32": "long"}
    return rows.mapInArrow(run, "doc_id long, start long, length long, doc_tokens long" + "".join(f", {name} {kinds[name]}" for name in given))


def pack(docs: DataFrame, path: str | None = None, end: int = END, longest: int = LENGTH, remembered: int = REMEMBERED, given: tuple[str, ...] = ("ids",)) -> DataFrame:
    """The pieces of ``docs`` as sequences: what ``pieces`` returns, with sequence_id and offset.

    A piece is a sequence of its own, so no sequence crosses documents, offset is always 0, and every length is a power of
    two: nothing is padded. Sequences of one length form a bucket (the length names it), from which batches of equal
    shape are drawn; ``write_buckets`` lays them out so. sequence_id is unique; its numbers follow the partitions of a run.
    ``remembered`` bounds the memory of the worker processes; the result does not depend on it. ``given``: see ``pieces``.
    """
    placed = pieces(docs, path or public_tokenizers.path(VOCABULARY), end, longest, remembered, given)
    return placed.withColumn("sequence_id", F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))


def write_buckets(packed: DataFrame, folder: str) -> None:
    """Write one Parquet folder for each bucket of equal length; nothing is shuffled."""
    packed.withColumn("bucket", F.col("length")).write.partitionBy("bucket").parquet(folder)


def bucketed(packed: DataFrame) -> DataFrame:
    """``packed`` with bucket (the length), its rows dealt by bucket and piece, sorted by bucket within a partition.

    Files written from it hold runs of equal length. A hash of the piece is the salt: a frequent length spreads over partitions.
    """
    base = without(packed, "bucket").withColumn("bucket", F.col("length"))
    salt = F.pmod(F.xxhash64("doc_id", "start"), F.lit(SALTS))
    return base.repartition("bucket", salt).sortWithinPartitions("bucket")


def with_checksums(packed: DataFrame, keep: bool = False) -> DataFrame:
    """``packed`` with ids_crc32 (CRC-32 of the ids as little-endian unsigned 32-bit numbers) in place of the ids.

    ``keep``: beside the ids.
    """
    base = without(packed, "ids_crc32")
    at = base.columns.index("ids")
    rest = [name for name in base.columns if keep or name != "ids"]
    schema = plus(base if keep else base.drop("ids"), ids_crc32=LongType())

    def run(batches):
        for batch in batches:
            ids = batch.column(at)
            values = ids.flatten().to_numpy().astype(IDS).tobytes()
            sizes = np.diff(ids.offsets.to_numpy())
            ends = np.cumsum(sizes).tolist()
            sums = [zlib.crc32(values[4 * (e - n) : 4 * e]) for e, n in zip(ends, sizes.tolist())]
            yield pa.RecordBatch.from_arrays([*[batch.column(name) for name in rest], pa.array(sums, pa.int64())], [*rest, "ids_crc32"])

    return base.mapInArrow(run, schema)
