"""Whitening of vectors: eigenvalues in intervals by contour integration, counted by inertia."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfpair.session import stored

#: Entries become whole numbers: floor(SCALE * entry) + SHIFT.
SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Entries of at least this size count as not finite: their squares would not sum in 38 digits.
LARGEST = 2.0**40
#: Points on the upper half of a contour, refinements, and eigenvalues looked for together.
POINTS, TURNS, TOGETHER = 16, 60, 16


# eigenvalues on the driver: one matrix as large as a vector is long, whatever the number of vectors


def count_above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix lie above ``shift``.

    By Sylvester's law they are the positive ones of D in L D L' = matrix - shift, whose blocks of one or two rows are
    chosen as pivots as large as their rows ask.
    """
    a = matrix - shift * np.eye(len(matrix))
    limit, above = (1 + 17**0.5) / 8, 0
    tiny = np.finfo(float).eps * max(np.abs(a).max(initial=0), np.finfo(float).tiny)
    while len(a):
        column = np.abs(a[1:, 0])
        r = int(column.argmax()) + 1 if len(column) else 0
        size = 1
        if len(a) > 1 and abs(a[0, 0]) < limit * column[r - 1]:
            off = np.abs(np.delete(a[:, r], r)).max()
            if abs(a[0, 0]) * off < limit * column[r - 1] ** 2:
                first = [r] if abs(a[r, r]) >= limit * off else [0, r]
                order = first + [k for k in range(len(a)) if k not in first]
                a, size = a[np.ix_(order, order)], len(first)
        if size == 1:
            pivot = a[0, 0] if abs(a[0, 0]) > tiny else -tiny
            above += pivot > 0
            a = a[1:, 1:] - np.outer(a[1:, 0], a[1:, 0] / pivot)
        else:  # a block of two rows: one eigenvalue of each sign if its determinant is negative
            block, rest = a[:2, :2], a[2:, :2]
            det = block[0, 0] * block[1, 1] - block[0, 1] ** 2
            above += 1 if det < 0 else 2 * (block[0, 0] > 0)
            a = a[2:, 2:] - rest @ np.linalg.solve(block, rest.T)
    return int(above)


def projected(matrix: np.ndarray, low: float, high: float, start: np.ndarray) -> np.ndarray:
    """``start`` projected onto the eigenvectors of the interval: the resolvent integrated along a circle around it.

    Gauss-Legendre points on the upper half are enough, as matrix and start are real.
    """
    centre, radius = (low + high) / 2, (high - low) / 2
    nodes, weights = np.polynomial.legendre.leggauss(POINTS)
    out = np.zeros_like(start)
    for node, weight in zip(nodes, weights):
        turn = radius * np.exp(0.5j * np.pi * (1 + node))
        out += 0.5 * weight * (turn * np.linalg.solve((centre + turn) * np.eye(len(matrix)) - matrix, start.astype(complex))).real
    return out


def between(matrix: np.ndarray, low: float, high: float, number: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``number`` eigenvalues in (low, high], falling, and their unit eigenvectors as columns.

    Rayleigh-Ritz in the projected space, refined until every residual is at rounding size. ``number`` comes from the
    inertia, so a missing one would not go unnoticed: the search goes on with a wider start and fails at last.
    """
    d, norm = len(matrix), np.abs(matrix).sum(axis=1).max()
    width = min(d, number + max(4, number // 2))
    drawn = np.random.default_rng(12)
    space = drawn.standard_normal((d, width))
    error, before = np.inf, np.inf
    for turn in range(TURNS):
        space, _ = np.linalg.qr(projected(matrix, low, high, space))
        values, inner = np.linalg.eigh(space.T @ matrix @ space)
        space = space @ inner
        inside = np.flatnonzero((values > low) & (values <= high))[::-1]
        if len(inside) == number:
            found = space[:, inside]
            error = np.linalg.norm(matrix @ found - found * values[inside], axis=0).max(initial=0)
            if error <= 4 * np.finfo(float).eps * norm or error <= 1e-13 * norm and error > before / 4:
                return values[inside], found
            before = error
        elif turn % 10 == 9 and width < d:  # too few: the start missed some
            width = min(d, 2 * width)
            space = np.hstack([space, drawn.standard_normal((d, width - space.shape[1]))])
    raise ArithmeticError(f"{number} eigenvalues in ({low}, {high}], {len(inside)} found, residual {error}")


def largest_eigenpairs(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues of a positive semidefinite matrix, falling, and unit eigenvectors as columns.

    Eigenvalues at rounding size count as zero and are left out, so there may be fewer. Bisection by inertia finds an edge
    below the ones wanted, then halves the range until no interval holds more than TOGETHER, unless they are as good as
    equal; each interval is then solved on its own. The largest entry of each vector is positive.
    """
    norm = np.abs(matrix).sum(axis=1).max(initial=0)
    if not norm > 0:
        return np.empty(0), np.empty((len(matrix), 0))
    top, zero = norm * (1 + 1e-9), 8 * len(matrix) * np.finfo(float).eps * norm
    most = min(most, count_above(matrix, zero))
    low, high, count = zero, top, count_above(matrix, zero)
    for _ in range(60):  # the edge: at least ``most`` above it, and not many more
        if count <= most + 4:
            break
        middle = (low + high) / 2
        here = count_above(matrix, middle)
        low, high, count = (middle, high, here) if here >= most else (low, middle, count)
    values, vectors, todo = [], [], [(low, top, count, 0)]
    while todo:
        low, high, count, halved = todo.pop()
        middle = (low + high) / 2
        if not count:
            continue
        if count > TOGETHER and halved < 40:
            above = count_above(matrix, middle) - (count_above(matrix, high) if high < top else 0)
            todo += [(low, middle, count - above, halved + 1), (middle, high, above, halved + 1)]
            continue
        some, columns = between(matrix, low, high, count)
        values.append(some)
        vectors.append(columns)
    values, vectors = np.concatenate(values), np.hstack(vectors)
    order = np.argsort(-values, kind="stable")[:most]
    vectors = vectors[:, order]
    return values[order], vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])


# sums over all vectors


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LARGEST))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


def whole(column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each length: the rows with vectors of it, and these as a matrix of whole numbers."""
    lengths = np.diff(column.offsets.to_numpy())
    entries = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE).astype(np.int64) + SHIFT
    starts = column.offsets.to_numpy()[:-1] - column.offsets[0].as_py()
    return {int(d): (rows := np.flatnonzero(lengths == d), entries[starts[rows][:, None] + np.arange(d)]) for d in np.unique(lengths)}


def products(rows: np.ndarray) -> np.ndarray:
    """Exact sums of products of columns, as Python's numbers: in double precision where that is exact, by parts else."""
    if not len(rows):
        return np.zeros((rows.shape[1],) * 2, object)
    most = int(np.abs(rows).max())
    step = 2**53 // max(1, most * most)
    if step == 0:  # numbers too large for a product: upper and lower halves
        low = rows & ((1 << 25) - 1)
        high = rows >> 25
        mixed = products(np.hstack([high, low]))
        d = rows.shape[1]
        return mixed[:d, :d] * (1 << 50) + (mixed[:d, d:] + mixed[d:, :d]) * (1 << 25) + mixed[d:, d:]
    out = np.zeros((rows.shape[1],) * 2, object)
    for k in range(0, len(rows), step):
        part = rows[k : k + step].astype(np.float64)
        out = out + (part.T @ part).astype(np.int64).astype(object)
    return out


def _sums(good: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """For each length of vectors: their number, and the sum of each entry."""

    def run(batches):
        kept: dict[int, list] = {}
        for batch in batches:
            for d, (rows, x) in whole(batch.column(0)).items():
                have = kept.setdefault(d, [0, [0] * d])
                have[0] += len(rows)
                have[1] = [a + int(b) for a, b in zip(have[1], x.astype(object).sum(axis=0))]
        found = [(d, -1, Decimal(n)) for d, (n, _) in kept.items()] + [(d, i, Decimal(s)) for d, (_, sums) in kept.items() for i, s in enumerate(sums)]
        columns = list(zip(*found)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.decimal128(38, 0))], ["d", "i", "s"])

    rows = good.select("embedding").mapInArrow(run, "d int, i int, s decimal(38,0)").groupBy("d", "i").agg(F.sum("s").alias("s")).collect()
    found = {r.d: (int(r.s), [0] * r.d) for r in rows if r.i == -1}
    for r in rows:
        if r.i >= 0:
            found[r.d][1][r.i] = int(r.s)
    return found


def _covariances(good: DataFrame, sums: dict[int, tuple[int, list[int]]]) -> dict[int, tuple[np.ndarray, float]]:
    """For each length: covariance and trace, each entry correctly rounded from an exact fraction.

    Entries are centred at the nearest whole number to their mean before they are multiplied; the rest is taken off exactly.
    """
    centres = {d: [(2 * s + n) // (2 * n) for s in total] for d, (n, total) in sums.items()}

    def run(batches):
        kept: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, (_, x) in whole(batch.column(0)).items():
                kept[d] = kept.get(d, 0) + products(x - np.array(centres[d], np.int64))
        for d, matrix in kept.items():
            i, j = np.triu_indices(d)
            values = [Decimal(int(v)) for v in matrix[i, j]]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), d), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(values, pa.decimal128(38, 0))], ["d", "i", "j", "s"])

    rows = good.select("embedding").mapInArrow(run, "d int, i int, j int, s decimal(38,0)").groupBy("d", "i", "j").agg(F.sum("s").alias("s")).collect()
    out = {d: (np.zeros((d, d)), 0.0) for d in sums}
    traces = dict.fromkeys(sums, 0)
    for r in rows:
        n, total = sums[r.d]
        rest = [total[k] - n * centres[r.d][k] for k in (r.i, r.j)]
        exact = n * int(r.s) - rest[0] * rest[1]  # n * n times the covariance
        out[r.d][0][r.i, r.j] = out[r.d][0][r.j, r.i] = exact / (n * n)
        traces[r.d] += exact if r.i == r.j else 0
    return {d: (matrix, traces[d] / sums[d][0] ** 2) for d, (matrix, _) in out.items()}


@dataclass(frozen=True)
class Whitening:
    """What vectors of one length are whitened by: their number, sums of entries, eigenvalues, eigenvectors as columns, trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def apply(self, x: np.ndarray) -> tuple[np.ndarray, list[int | None]]:
        """Whitened rows, and for each its sum of (n * x - S) ** 2: exact, or None beyond 64 bits."""
        centres = np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)
        rest = np.array([(s - self.n * int(c)) / self.n for s, c in zip(self.sums, centres)])
        whitened = ((x - centres) - rest) @ self.vectors / np.sqrt(self.values)
        most = self.n * max(1, int(np.abs(x - centres).max(initial=0)) + 1)
        if most * most * x.shape[1] < 2**63:
            far = self.n * (x - centres) - np.array([s - self.n * int(c) for s, c in zip(self.sums, centres)], np.int64)
            return whitened, (far * far).sum(axis=1).tolist()
        exact = [sum((self.n * int(v) - s) ** 2 for v, s in zip(row, self.sums)) for row in x]
        return whitened, [v if v < 2**63 else None for v in exact]


def fit(vectors: DataFrame, components: int = COMPONENTS) -> dict[int, Whitening]:
    """A whitening for each length of vector in ``vectors`` (embedding), over all its usable rows."""
    good = vectors.where(usable(F.col("embedding")))
    sums = _sums(good)
    found = {}
    for d, (matrix, trace) in _covariances(good, sums).items():
        found[d] = Whitening(*sums[d], *largest_eigenpairs(matrix, components), trace)
    return found


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for ``vectors`` (vec_id, embedding).

    One row for each usable vector and component, which are numbered from 1 by falling eigenvalue. Null and empty vectors, and
    those with null, non-finite or very large entries (LARGEST), are dropped. Vectors of one length are whitened together; a
    table should hold one length, or few. Components without variance are left out, so equal vectors give no row. Repeated
    rows count and come back each. deviation is null beyond 64 bits. Further columns are ignored.

    Two passes of sums make an exact covariance, whatever the partitions; only sums, as many as a vector has pairs of
    entries, reach the driver. identity_error comes from the whitened rows themselves.
    """
    models = fit(vectors, components)
    good = vectors.where(usable(F.col("embedding"))).select(F.col("vec_id").cast("long"), "embedding")

    def run(batches):
        for batch in batches:
            for d, (rows, x) in whole(batch.column(1)).items():
                model = models[d]
                whitened, deviations = model.apply(x)
                k = len(model.values)
                offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * k)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(rows)),
                        pa.array(np.full(len(rows), d), pa.int32()),
                        pa.array(deviations, pa.int64()),
                        pa.ListArray.from_arrays(offsets, pa.array(whitened.ravel(), pa.float64())),
                    ],
                    ["vec_id", "d", "deviation", "whitened"],
                )

    done = stored(good.mapInArrow(run, "vec_id long, d int, deviation long, whitened array<double>"))
    out = None
    for d, model in sorted(models.items()):
        k = len(model.values)
        if not k:
            continue
        rows = done.where(F.col("d") == d)
        means = rows.agg(*[F.avg(F.col("whitened")[i]) for i in range(k)]).first()
        pairs = [(i, j) for i in range(k) for j in range(i, k)]
        middle = [F.col("whitened")[i] - float(means[i]) for i in range(k)]
        spread = rows.agg(*[F.avg(middle[i] * middle[j]) for i, j in pairs]).first()
        error = max(abs(v - (i == j)) for v, (i, j) in zip(spread, pairs))
        shares = F.array(*[F.lit(float(v / model.trace)) for v in model.values])
        rows = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")).select(
            "vec_id",
            (F.col("place") + 1).cast("int").alias("component"),
            F.lit(model.n).cast("long").alias("n"),
            "deviation",
            "whitened",
            shares[F.col("place")].alias("explained"),
            F.lit(float(error)).alias("identity_error"),
        )
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return vectors.sparkSession.createDataFrame([], schema)
    return out
