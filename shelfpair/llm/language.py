"""Language identification by a small byte convolutional network, trained in numpy."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from shelfpair.llm.common import plus, set_aside, slices, without
from shelfpair.session import stored

WINDOW, DIMS, WIDTHS, FILTERS = 256, 8, (2, 3, 4), 12
WIDEST = max(WIDTHS)
SPAN = WINDOW - WIDEST + 1
UNKNOWN = "und"
#: Windows in one matrix product, so that its intermediate results stay within the processor's cache.
BLOCK = 32


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _patches(embedded: np.ndarray) -> np.ndarray:
    """(windows, positions, WIDEST * DIMS): the embedded bytes that the widest filter sees at each position."""
    n, _, dims = embedded.shape
    s = embedded.strides
    return np.lib.stride_tricks.as_strided(embedded, (n, SPAN, WIDEST * dims), (s[0], s[1], s[2]))


def _filter_mask() -> np.ndarray:
    """Narrow filters see only the first bytes of what the widest one sees."""
    mask = np.zeros((WIDEST * DIMS, len(WIDTHS) * FILTERS), np.float32)
    for k, width in enumerate(WIDTHS):
        mask[: width * DIMS, k * FILTERS : (k + 1) * FILTERS] = 1
    return mask


def windows_of(text: str) -> np.ndarray:
    """Bytes of the whole text as rows of WINDOW bytes, the last one filled up with zeros."""
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    rows = max(1, -(-len(data) // WINDOW))
    out = np.zeros(rows * WINDOW, np.uint8)
    out[: len(data)] = data
    return out.reshape(rows, WINDOW)


class Network:
    """Byte embedding, filters of several widths, max pooling over positions, softmax over ``classes``."""

    #: Windows after which the texts collected so far are worked off.
    TOGETHER = 2048

    def __init__(self, classes: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        n = len(WIDTHS) * FILTERS
        self.classes = classes
        self.mask = _filter_mask()
        self.p = {
            "embedding": rng.normal(0, 0.5, (256, DIMS)).astype(np.float32),
            "filters": (rng.normal(0, 0.25, (WIDEST * DIMS, n)) * self.mask).astype(np.float32),
            "bias": np.zeros(n, np.float32),
            "out": rng.normal(0, 0.2, (n, len(classes))).astype(np.float32),
            "shift": np.zeros(len(classes), np.float32),
        }

    def _pool(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        patches = _patches(self.p["embedding"][windows])
        found = patches.reshape(-1, patches.shape[2]) @ self.p["filters"]
        return found.reshape(len(windows), SPAN, -1), patches

    def _head(self, pooled: np.ndarray) -> np.ndarray:
        logits = pooled @ self.p["out"] + self.p["shift"]
        odds = np.exp(logits - logits.max(axis=1, keepdims=True))
        return odds / odds.sum(axis=1, keepdims=True)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        pooled = [self._pool(windows[k : k + BLOCK])[0].max(axis=1) for k in range(0, len(windows), BLOCK)]
        return self._head(np.maximum(np.concatenate(pooled) + self.p["bias"], 0))

    def _gradients(self, windows: np.ndarray, target: np.ndarray) -> dict[str, np.ndarray]:
        found, patches = self._pool(windows)
        at = found.argmax(axis=1)
        best = np.take_along_axis(found, at[:, None, :], axis=1)[:, 0] + self.p["bias"]
        pooled = np.maximum(best, 0)
        error = self._head(pooled)
        error[np.arange(len(target)), target] -= 1
        error /= len(target)
        back = (error @ self.p["out"].T) * (best > 0)
        rows = np.arange(len(windows))[:, None]
        seen = patches[rows, at]  # only the positions that won the pooling pass anything back
        inward = (back[:, :, None] * self.p["filters"].T[None]).reshape(*back.shape, WIDEST, DIMS)
        embedding = np.zeros_like(self.p["embedding"])
        np.add.at(embedding, windows[rows[:, :, None], at[:, :, None] + np.arange(WIDEST)], inward)
        filters = np.einsum("nf,nfd->df", back, seen) * self.mask
        return {"embedding": embedding, "filters": filters, "bias": back.sum(0), "out": pooled.T @ error, "shift": error.sum(0)}

    def fit(self, windows: np.ndarray, target: np.ndarray, epochs: int, batch: int = 128, rate: float = 0.01, seed: int = 11) -> None:
        """Adam on shuffled batches; part of the windows is cut short, as short texts occur too."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        steps = 0
        for _ in range(epochs):
            order = rng.permutation(len(windows))
            for start in range(0, len(order), batch):
                pick = order[start : start + batch]
                x = windows[pick].copy()
                lengths = np.where(rng.random(len(x)) < 0.3, rng.integers(8, WINDOW, len(x)), WINDOW)
                x[np.arange(WINDOW)[None] >= lengths[:, None]] = 0
                steps += 1
                for k, g in self._gradients(x, target[pick]).items():
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.01 * (g * g - second[k])
                    step = first[k] / (1 - 0.9**steps) / (np.sqrt(second[k] / (1 - 0.99**steps)) + 1e-8)
                    self.p[k] -= (rate * step).astype(np.float32)

    def predict(self, texts: Iterable[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of whole texts: the windows' probabilities, averaged by their number of bytes.

        Texts are taken one by one, and only the windows of those not yet worked off are held.
        """
        langs, scores, part, cut = [], [], [], []

        def work_off() -> None:
            for k, row in zip(part, self._sums(cut)):
                best = int(row.argmax())
                langs[k], scores[k] = self.classes[best], round(min(1.0, float(row[best])), 6)
            part.clear(), cut.clear()

        for i, text in enumerate(texts):
            langs.append(UNKNOWN)
            scores.append(0.0)
            if text and self.classes and any(map(str.isalpha, text)):
                part.append(i)
                cut.append(windows_of(text))
                if sum(map(len, cut)) >= self.TOGETHER:
                    work_off()
        if part:
            work_off()
        return langs, scores

    def _sums(self, cut: list[np.ndarray]) -> list[np.ndarray]:
        odds = self.probabilities(np.concatenate(cut))
        out, at = [], 0
        for windows in cut:
            weight = np.full(len(windows), WINDOW, np.float64)
            weight[-1] = max(1, np.count_nonzero(windows[-1]))
            out.append((odds[at : at + len(windows)] * weight[:, None]).sum(0) / weight.sum())
            at += len(windows)
        return out


def training_windows(docs: DataFrame, per_lang: int, per_doc: int) -> DataFrame:
    """(lang, text) of up to ``per_lang`` labelled documents of each language outside the held-out fold: ``per_doc`` cuts of each.

    Cuts start at hashed places of the whole text. The documents are those smallest by hash in their language, so the
    sample is the same whatever the partitions, a rare language has all its documents in it, and it grows with the number
    of languages alone. The id only picks the fold and the sample; no prediction sees it.
    """
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    starts = [F.pmod(F.xxhash64("doc_id", F.lit(k)), F.greatest(F.length("text") - WINDOW, F.lit(1))).cast("int") + 1 for k in range(per_doc)]
    cuts = F.array(*[F.substring(F.col("text"), start, F.lit(WINDOW)) for start in starts])
    counts = stored(usable.groupBy("lang").agg(F.count("*").alias("documents")))
    place = F.shiftrightunsigned(F.xxhash64("doc_id"), 1)
    # a share of the hash range that holds four times the rows wanted: tasks hand on few rows however many tasks there are
    share = F.lit(4.0 * per_lang) / F.col("documents")
    near = (share >= 1) | (F.col("place") < (share * 2.0**63).cast("long"))
    first = Window.partitionBy("lang").orderBy("place", "doc_id", "cuts")
    placed = usable.select("doc_id", "lang", cuts.alias("cuts"), place.alias("place")).join(counts, "lang").where(near)
    picked = placed.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= per_lang)
    return picked.orderBy("doc_id", "lang", "cuts").select("lang", F.explode("cuts").alias("text"))


def train(docs: DataFrame, per_lang: int = 1000, per_doc: int = 2, epochs: int = 6) -> Network:
    """A network fitted on a bounded sample of labelled documents (``per_lang`` * ``per_doc`` windows of 256 bytes a language)."""
    rows = training_windows(docs, per_lang, per_doc).collect()
    rows = [(r["lang"], r["text"]) for r in rows if any(map(str.isalpha, r["text"]))]
    network = Network(sorted({lang for lang, _ in rows}))
    if rows:
        number = {lang: k for k, lang in enumerate(network.classes)}
        windows = np.concatenate([windows_of(text)[:1] for _, text in rows])
        network.fit(windows, np.array([number[lang] for lang, _ in rows]), epochs)
    return network


def identify(docs: DataFrame, network: Network) -> DataFrame:
    """``docs`` (text, ...) with lang_pred and score; columns of these names that were there are replaced.

    lang_pred is a learned language, or `und` with score 0 for a null text, a text without letter, or an untrained network.
    Only the text decides. Whole texts are cut into fixed windows, whose probabilities are averaged by bytes.
    """
    base = without(docs, "lang_pred", "score")
    at, names = base.columns.index("text"), [*base.columns, "lang_pred", "score"]
    schema = plus(base, lang_pred=StringType(), score=DoubleType())

    def run(batches):
        for batch in batches:
            langs, scores = network.predict(text for piece in slices([batch]) for text in piece.column(at).to_pylist())
            columns = [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names)

    return base.mapInArrow(run, schema)


def keep_known(docs: DataFrame, least: float = 0.4) -> DataFrame:
    """The rows of ``docs`` whose language is identified with a score of at least ``least``; columns stay as they were."""
    own, restored = set_aside(docs, "lang_pred", "score")
    found = identify(own, train(own))
    return restored(found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)))
