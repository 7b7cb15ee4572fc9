"""Token counts of fields and sections, from one encoding of each whole document."""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from shelfpair.llm.common import fresh, plus, without

VOCABULARY = "byte_bpe_50k.tiktoken"


class Tokens:
    """Token ids of whole texts, with the characters that each token touches."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the tokens in characters; a token that holds part of a character touches it."""
        ids = np.asarray(self.encoding.encode_ordinary(text), dtype=np.int64)
        stops = np.cumsum(self.lengths[ids])
        data = np.frombuffer(text.encode(), np.uint8)
        character = np.cumsum((data & 0xC0) != 0x80) - 1
        return character[stops - self.lengths[ids]], character[stops - 1] + 1


def attributed(starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For tokens with these spans: the section of each, and whether it crosses a boundary.

    ``bounds`` are the sorted starts of the sections, which follow one another. A token that crosses goes to the section
    with most of its characters, and to the earlier one of equals.
    """
    first = np.searchsorted(bounds, starts, "right") - 1
    last = np.searchsorted(bounds, ends - 1, "right") - 1
    crosses = first != last
    for k in np.flatnonzero(crosses):
        edges = np.concatenate([[starts[k]], bounds[first[k] + 1 : last[k] + 1], [ends[k]]])
        first[k] += int(np.diff(edges).argmax())
    return first, crosses


_TOKENS: dict[tuple[str, str], Tokens] = {}


def _tokens(path: str, pattern: str) -> Tokens:
    if (path, pattern) not in _TOKENS:
        _TOKENS[path, pattern] = Tokens(path, pattern)
    return _TOKENS[path, pattern]


def line_starts(text: str) -> list[int]:
    """Lines as sections: each keeps the line end that closes it."""
    return [0, *[m.end() for m in re.finditer("\n", text) if m.end() < len(text)]]


SECTION = StructType([StructField(name, LongType()) for name in ("section", "start", "end", "n_tokens", "n_crossing")])


def section_tokens(docs: DataFrame, starts: str | None = None, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """One row a section: the columns of ``docs`` less text, then section, start, end, n_tokens, n_crossing, doc_tokens.

    ``docs`` has text, and a column named by ``starts`` (array<int>: ascending places in characters, the first one 0) where
    sections begin; without it, sections are lines. A document is encoded once, whole. Its tokens' spans are joined with
    the sections' intervals: both are sorted, so each token looks its interval up by bisection.
    A token that crosses a boundary counts once, for the section with most of its characters, the earlier of equals;
    n_crossing tells how many of n_tokens did so. n_tokens of a document's sections add up to doc_tokens.

    A null or empty text is one section without tokens. Columns with the names of the output are replaced.
    """
    path, pattern = path or public_tokenizers.path(VOCABULARY), pattern or public_tokenizers.PATTERN
    outputs = [*SECTION.names, "doc_tokens"]
    base = without(docs.withColumnRenamed(starts, "start") if starts and starts.lower() in outputs else docs, *[n for n in outputs if n != starts])
    at = base.columns.index("text")
    where = base.columns.index(starts) if starts else None
    rest = [name for name in base.columns if name not in ("text", starts)]
    found = fresh("sections", base.select(*rest)) if rest else "sections"
    kinds = pa.list_(pa.struct([(name, pa.int64()) for name in SECTION.names]))
    schema = plus(base.select(*rest), **{found: ArrayType(SECTION), "doc_tokens": LongType()})

    def count(tokens: Tokens, text: str, bounds: np.ndarray) -> tuple[list[dict], int]:
        begin, end = tokens.spans(text) if text else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        section, crosses = attributed(begin, end, bounds)
        n = np.bincount(section, minlength=len(bounds))
        crossing = np.bincount(section[crosses], minlength=len(bounds))
        stops = np.append(bounds[1:], len(text))
        values = zip(range(len(bounds)), bounds.tolist(), stops.tolist(), n.tolist(), crossing.tolist())
        return [dict(zip(SECTION.names, row)) for row in values], len(begin)

    def run(batches):
        tokens = _tokens(path, pattern)
        for whole in batches:
            for part in range(0, whole.num_rows, 256):
                batch = whole.slice(part, 256)
                texts = [text or "" for text in batch.column(at).to_pylist()]
                bounds = [line_starts(t) for t in texts] if where is None else [b or [0] for b in batch.column(where).to_pylist()]
                done = [count(tokens, t, np.array(b, np.int64)) for t, b in zip(texts, bounds)]
                columns = [pa.array([x for x, _ in done], kinds), pa.array([n for _, n in done], pa.int64())]
                yield pa.RecordBatch.from_arrays([*[batch.column(name) for name in rest], *columns], [*rest, found, "doc_tokens"])

    counted = base.mapInArrow(run, schema)
    own: list[Column] = [F.col(f"`{name}`") for name in rest]
    return counted.select(*own, F.inline(found), "doc_tokens")


def field_tokens(docs: DataFrame, fields: list[str], separator: str = "\n", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Token counts of text columns that a model reads as one text, joined by ``separator`` (nulls count as empty).

    One row a row of ``docs`` and field: its other columns, field, and what ``section_tokens`` returns. A separator
    belongs to the field before it.
    """
    texts = [F.coalesce(F.col(f"`{name}`"), F.lit("")) for name in fields]
    closed = [F.concat(t, F.lit(separator)) for t in texts[:-1]] + texts[-1:]
    begins, at = [], F.lit(0)
    for text in closed:
        begins.append(at)
        at = at + F.length(text)
    keep = [F.col(f"`{name}`") for name in docs.columns if name not in (*fields, "text", "field_starts")]
    joined = docs.select(*keep, F.concat(*closed).alias("text"), F.array(*begins).alias("field_starts"))
    counted = section_tokens(joined, "field_starts", path, pattern)
    return counted.withColumn("field", F.element_at(F.array(*[F.lit(n) for n in fields]), (F.col("section") + 1).cast("int")))
