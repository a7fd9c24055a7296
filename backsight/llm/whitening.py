"""Whitening of embeddings by an incremental eigendecomposition.

Every entry c becomes the integer x = floor(``scale`` * c) + ``shift``. A task keeps the spectrum (eigenvalues and vectors) of
the scatter of the rows it has read around their running mean. A row enters as one centred rank-one update: its projection
is deflated (negligible components, and equal eigenvalues, which a rotation joins into one), the secular equation
1 + sum(u[j]**2 / (d[j] - root)) = 0 is solved for all roots at once, and the vectors follow from weights that are
recomputed from the roots, which keeps them orthogonal. The tasks' spectra are combined in rounds, ``together`` of them
in a task: each eigenpair of one is a rank-one update of the other, and so is the distance of the means. Each round is
a written table. The leading vectors are then refined by Rayleigh and Ritz over all rows: the block is multiplied with the
covariance, the small projected matrix is solved, and the residual of the wanted pairs is measured; where it is not
negligible the block grows, at most to all dimensions, where the result is exact. What reaches the driver is the
spectrum: one row for each length of vectors, its size given by the dimensions alone.

Sums, means and deviations are exact integers; rows are centred before anything is multiplied.

Cases: rows whose vector is null, or holds null or non-finite entries, are dropped; rows with a null key, repeated keys and
repeated rows stay, all of them. Vectors of different lengths are fitted apart, each length as a list of its own; empty
vectors have no component. x saturates at 64 bits. There are min(``components``, length) components; one whose
eigenvalue is zero up to rounding (constant tables, one row) has a null ``whitened``, and ``explained`` is null where no row
differs. ``deviation`` is null where it exceeds 64 bits. Equal eigenvalues have some orthonormal basis. Empty tables give
none. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from backsight.llm.components import write

EPS = np.finfo(float).eps
SPECTRUM = "length int, n long, sums array<string>, eigenvalues array<double>, vectors array<double>"
OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double"


def usable(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v) of the rows that take part."""
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v")).where("v is not null")
    return rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))


def _integers(lists: pa.Array, length: int, scale: int, shift: int) -> np.ndarray:
    """The x of rows of one length; saturated where 64 bits end."""
    with np.errstate(over="ignore"):
        x = np.floor(lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), length) * float(scale))
    edge = 2.0**62
    return np.where(np.abs(x) < edge, x, 0).astype(np.int64) + shift + np.where(x >= edge, 2**62, np.where(x <= -edge, -(2**62), 0))


def _by_length(batch: pa.RecordBatch, scale: int, shift: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, x) for each length in a batch of (key, vector)."""
    lists = batch.column(1)
    lengths = lists.value_lengths().to_numpy()
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        yield int(length), rows, _integers(lists.take(pa.array(rows)), int(length), scale, shift)


def _secular_roots(d: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum(w / (d - root)), one above each of the ascending poles ``d``, and the table root[i] - d[j].

    Each root is searched as a distance from the nearer of its two poles, so that differences keep their digits.
    """
    m, total = len(d), w.sum()
    if m == 1:
        return d + w, w[:, None].copy()
    upper = np.append(d[1:], d[-1] + total)
    half = (upper - d) / 2
    at_middle = 1 + (w / (d - (d + half)[:, None])).sum(axis=1)
    near_left = at_middle >= 0
    near_left[-1] = True
    origin = np.where(near_left, d, upper)
    low, high = np.where(near_left, 0.0, -half), np.where(near_left, half, 0.0)
    if at_middle[-1] < 0:
        low[-1], high[-1] = half[-1], total
    poles = d - origin[:, None]
    own = np.arange(m)
    first = np.minimum(own, m - 2)
    left, right = poles[own, first], poles[own, first + 1]
    below = own[None, :] <= first[:, None]
    # the first guess takes all but the two neighbouring poles from the middle of the interval
    own_w, next_w, gap = w[:-1], w[1:], 2 * half[:-1]
    rest = at_middle[:-1] - (next_w - own_w) / half[:-1]
    side = np.where(near_left[:-1], 1.0, -1.0)
    p, q = side * rest * gap + own_w + next_w, np.where(near_left[:-1], own_w, next_w) * gap
    with np.errstate(all="ignore"):
        width = np.sqrt(np.abs(p * p - 4 * side * q * rest))
        guess = side * np.where(p > 0, 2 * q / (p + width), (p - width) / (2 * side * rest))
    root = (low + high) / 2
    fine = (guess > low[:-1]) & (guess < high[:-1])
    root[:-1][fine] = guess[fine]
    open_ = np.arange(m)
    for _ in range(100):
        gap = poles[open_] - root[open_, None]
        share = w / gap
        value = 1 + share.sum(axis=1)
        going = np.abs(value) > 16 * EPS * (1 + np.abs(share).sum(axis=1))
        if not going.any():
            break
        open_, value, share, gap = open_[going], value[going], share[going], gap[going]
        at = root[open_]
        positive = value > 0
        high[open_[positive]], low[open_[~positive]] = at[positive], at[~positive]
        # one step of the rational model with the two neighbouring poles
        steep = share / gap
        a, b = left[open_] - at, right[open_] - at
        rise = steep.sum(axis=1)
        rise_left = (steep * below[open_]).sum(axis=1)
        c = value - a * rise_left - b * (rise - rise_left)
        p, q = (a + b) * value - a * b * rise, a * b * value
        with np.errstate(all="ignore"):
            width = np.sqrt(np.abs(p * p - 4 * q * c))
            width[open_ == m - 1] *= -1
            step = np.where((p > 0) == (width >= 0), 2 * q / (p + width), (p - width) / (2 * c))
            step = np.where(step * value < 0, step, -value / rise)
            after = at + step
        after = np.where((after > low[open_]) & (after < high[open_]), after, (low[open_] + high[open_]) / 2)
        root[open_] = after
        open_ = open_[after != at]
        if not len(open_):
            break
    return origin + root, root[:, None] - poles


@dataclass
class Spectrum:
    """The scatter of ``n`` rows around their mean as ascending eigenvalues and a matrix of column vectors."""

    length: int
    n: int = 0
    sums: list[int] = field(default_factory=list)
    values: np.ndarray = None
    vectors: np.ndarray = None

    def __post_init__(self):
        if self.values is None:
            self.sums, self.values, self.vectors = [0] * self.length, np.zeros(self.length), np.eye(self.length)

    def update(self, z: np.ndarray) -> None:
        """Add the outer product of ``z`` with itself."""
        d, u = self.values, z @ self.vectors
        norm = float(u @ u)
        if not norm:
            return
        negligible = 8 * EPS * max(d[-1], norm)
        active = np.flatnonzero(np.abs(u) * np.sqrt(norm) > negligible)
        if len(active) > 1 and (np.diff(d[active]) <= negligible).any():
            active = self._join_equal(active, u, negligible)
        if not len(active):
            return
        whole = len(active) == self.length
        poles, weights = (d, u) if whole else (d[active], u[active])
        roots, gaps = _secular_roots(poles, weights * weights)
        m = len(poles)
        # weights that make the computed roots exact
        below = poles[:, None] - poles[None, :]
        shifted = np.vstack((below[1:], np.ones((1, m))))
        ratio = gaps / np.where(np.tri(m, dtype=bool), shifted, below + np.eye(m))
        exact = np.sqrt(np.abs(ratio.prod(axis=0)))
        turn = np.copysign(exact, weights)[None, :] / gaps
        turn /= np.sqrt((turn * turn).sum(axis=1))[:, None]
        if whole:
            self.values, self.vectors = roots, self.vectors @ turn.T
            return
        self.values[active], self.vectors[:, active] = roots, self.vectors[:, active] @ turn.T
        order = np.argsort(self.values, kind="stable")
        self.values, self.vectors = self.values[order], self.vectors[:, order]

    def _join_equal(self, active: np.ndarray, u: np.ndarray, negligible: float) -> np.ndarray:
        """Rotate pairs with (nearly) equal eigenvalues so that only the later one keeps a component."""
        d, kept, last = self.values, [], active[0]
        for j in active[1:]:
            r = np.hypot(u[last], u[j])
            c, s = u[j] / r, u[last] / r
            if abs((d[j] - d[last]) * c * s) <= negligible:
                a, b = self.vectors[:, last].copy(), self.vectors[:, j]
                self.vectors[:, last], self.vectors[:, j] = c * a - s * b, s * a + c * b
                d[last], d[j] = d[last] * c * c + d[j] * s * s, d[last] * s * s + d[j] * c * c
                u[last], u[j] = 0.0, r
            else:
                kept.append(last)
            last = j
        return np.array([*kept, last])

    def add_rows(self, x: np.ndarray) -> None:
        start = np.array(self.sums, object) if self.n else None
        base = x[0]
        # sums relative to the first row of the batch stay small; Python integers where they might not
        wide = np.abs(x - base).max(initial=0) > 2**62 // (len(x) + 1) or np.abs(x).max(initial=0) >= 2**61
        rows = x.astype(object) - base.astype(object) if wide else x - base
        before = np.zeros(self.length) if start is None else np.array([(s - self.n * int(b)) / self.n for s, b in zip(start, base, strict=True)])
        running = np.cumsum(rows, axis=0)
        known = self.n
        for i in range(len(x)):
            count = known + i
            if count:
                mean = (before * known + (running[i - 1].astype(float) if i else 0.0)) / count
                self.update((rows[i].astype(float) - mean) * np.sqrt(count / (count + 1)))
        self.sums = [s + int(t) + len(x) * int(b) for s, t, b in zip(self.sums, running[-1], base, strict=True)]
        self.n += len(x)

    def add(self, other: Spectrum) -> None:
        """Each eigenpair of ``other`` is a rank-one update, and so is the distance of the two means."""
        if self.n and other.n:
            apart = np.array([(a * other.n - b * self.n) / (self.n * other.n) for a, b in zip(self.sums, other.sums, strict=True)])
            self.update(apart * np.sqrt(self.n * other.n / (self.n + other.n)))
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            if value > 0:
                self.update(np.sqrt(value) * vector)
        self.sums = [a + b for a, b in zip(self.sums, other.sums, strict=True)]
        self.n += other.n

    def row(self) -> dict:
        return {"length": self.length, "n": self.n, "sums": [str(s) for s in self.sums], "eigenvalues": self.values, "vectors": self.vectors.ravel()}

    @classmethod
    def of(cls, row: dict) -> Spectrum:
        length = row["length"]
        return cls(length, row["n"], [int(s) for s in row["sums"]], np.array(row["eigenvalues"]), np.array(row["vectors"]).reshape(length, length))


_SCHEMA = pa.schema([("length", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.string())), ("eigenvalues", pa.list_(pa.float64())), ("vectors", pa.list_(pa.float64()))])


def _rows_of(spectra: dict[int, Spectrum]) -> Iterator[pa.RecordBatch]:
    for spectrum in spectra.values():
        yield pa.RecordBatch.from_pylist([spectrum.row()], _SCHEMA)


def spectra(rows: DataFrame, scale: int, shift: int, together: int) -> dict[int, Spectrum]:
    """The spectrum of each length, combined over all tasks."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, Spectrum] = {}
        for batch in batches:
            for length, _, x in _by_length(batch, scale, shift):
                if length:
                    for at in range(0, len(x), 8192):
                        found.setdefault(length, Spectrum(length)).add_rows(x[at : at + 8192])
        yield from _rows_of(found)

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, Spectrum] = {}
        for batch in batches:
            for row in batch.to_pylist():
                spectrum = Spectrum.of(row)
                if spectrum.length in found:
                    found[spectrum.length].add(spectrum)
                else:
                    found[spectrum.length] = spectrum
        yield from _rows_of(found)

    parts = rows.sparkSession.sparkContext.defaultParallelism
    spread = rows if rows.rdd.getNumPartitions() >= parts else rows.repartition(parts)
    table, _ = write(spread.mapInArrow(read, SPECTRUM), "spectra")
    while True:
        most = table.groupBy("length").count().agg(F.max("count")).first()[0] or 0
        if most <= 1:
            return {row["length"]: Spectrum.of(row.asDict()) for row in table.collect()}
        # salted by their content, so that a length's spectra meet in groups of about ``together``
        numbered = table.withColumn("salt", F.pmod(F.xxhash64("vectors"), F.lit(-(-most // together))))
        table, _ = write(numbered.repartition("length", "salt").drop("salt").mapInArrow(combine, SPECTRUM), "spectra")


@dataclass
class Whitener:
    """What ``apply`` needs: n and the sums, and the leading components as columns with their eigenvalues."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float | None = None

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(n * x - sums as exact integers, the same over n as doubles)."""
        sums = np.array(self.sums, object)
        largest = max(int(np.abs(x.astype(float)).max(initial=0)) * self.n, max(map(abs, self.sums)))
        if largest < 2**61:
            exact = self.n * x - sums.astype(np.int64)
        else:
            exact = self.n * x.astype(object) - sums
        return exact, (exact / self.n).astype(float)

    @property
    def real(self) -> np.ndarray:
        """Which components have an eigenvalue above rounding."""
        return self.values > 64 * EPS * max(self.trace, 0.0)


def _summed(rows: DataFrame, scale: int, shift: int, shapes: dict, terms) -> dict[int, np.ndarray]:
    """For each length the sum of ``terms(length, x)``, a flat array, over all rows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for length, _, x in _by_length(batch, scale, shift):
                if length:
                    found = terms(length, x)
                    sums[length] = sums[length] + found if length in sums else found
        for length, flat in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(flat), length, np.int32)), pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], ["length", "cell", "s"])

    cells = rows.mapInArrow(work, "length int, cell int, s double").groupBy("length", "cell").agg(F.sum("s").alias("s")).collect()
    out = {length: np.zeros(size) for length, size in shapes.items()}
    for length, cell, s in cells:
        out[length][cell] = s
    return out


def fit(vectors: DataFrame, components: int = 8, key: str = "vec_id", vector: str = "embedding", scale: int = 1024, shift: int = 100_000, together: int = 16) -> dict[int, Whitener]:
    """The whitener of each length of vectors."""
    rows = usable(vectors, key, vector)
    found = spectra(rows, scale, shift, together)
    blocks = {length: min(length, 3 * components) for length in found}
    done: dict[int, Whitener] = {}
    while len(done) < len(found):
        trial = {}
        for length in found.keys() - done.keys():
            s = found[length]
            basis = np.linalg.qr(s.vectors[:, ::-1][:, : blocks[length]])[0]
            trial[length] = Whitener(s.n, s.sums, None, basis, 0.0)

        def product(length: int, x: np.ndarray, trial=trial) -> np.ndarray:
            """The covariance times the block, and the trace."""
            if length not in trial:
                return np.zeros(1)
            z = trial[length].centred(x)[1]
            return np.append((z.T @ (z @ trial[length].vectors)).ravel(), (z * z).sum())

        sums = _summed(rows, scale, shift, {length: length * blocks[length] + 1 if length in trial else 1 for length in found}, product)
        for length, t in trial.items():
            image, trace = sums[length][:-1].reshape(length, -1) / t.n, sums[length][-1] / t.n
            small = t.vectors.T @ image
            values, turn = np.linalg.eigh((small + small.T) / 2)
            values, turn = values[::-1][:components], turn[:, ::-1][:, :components]
            best = t.vectors @ turn
            residual = np.abs(image @ turn - best * values).max(initial=0)
            if blocks[length] == length or residual <= 1e-13 * max(trace, 0):
                done[length] = Whitener(t.n, t.sums, np.maximum(values, 0), best, trace)
            else:
                blocks[length] = min(length, 4 * blocks[length])
    _measure(rows, done, scale, shift)
    return done


def _whitened(w: Whitener, centred: np.ndarray) -> np.ndarray:
    with np.errstate(all="ignore"):
        return np.where(w.real, (centred @ w.vectors) / np.sqrt(w.values), np.nan)


def _measure(rows: DataFrame, found: dict[int, Whitener], scale: int, shift: int) -> None:
    """The largest entry of the covariance of what ``apply`` returns, minus the identity, over all rows."""

    def gram(length: int, x: np.ndarray) -> np.ndarray:
        y = _whitened(found[length], found[length].centred(x)[1])[:, found[length].real]
        return np.append((y.T @ y).ravel(), y.sum(axis=0))

    sizes = {length: int(w.real.sum()) for length, w in found.items()}
    sums = _summed(rows, scale, shift, {length: k * k + k for length, k in sizes.items()}, gram)
    for length, w in found.items():
        k = sizes[length]
        mean = sums[length][k * k :] / w.n  # zero up to rounding, as rows are centred
        covariance = sums[length][: k * k].reshape(k, k) / w.n - np.outer(mean, mean)
        w.identity_error = float(np.abs(covariance - np.eye(k)).max()) if k else None


def apply(vectors: DataFrame, whiteners: dict[int, Whitener], key: str = "vec_id", vector: str = "embedding", scale: int = 1024, shift: int = 100_000) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row per usable row and component."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, rows, x in _by_length(batch, scale, shift):
                if length not in whiteners:
                    continue
                w = whiteners[length]
                exact, centred = w.centred(x)
                if exact.dtype != object and float(np.abs(exact).max(initial=0)) ** 2 * length >= 2.0**62:
                    exact = exact.astype(object)
                deviation = [int(s) if s < 2**63 else None for s in (exact * exact).sum(axis=1).tolist()]
                y, k = _whitened(w, centred), len(w.values)
                explained = w.values / w.trace if w.trace > 0 else np.full(k, np.nan)
                for at in range(0, len(rows), 4096):
                    part = slice(at, at + 4096)
                    size = len(rows[part])
                    keys = batch.column(0).take(pa.array(np.repeat(rows[part], k)))
                    flat = y[part].ravel()
                    columns = [
                        keys, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), size)), pa.array(np.full(size * k, w.n)),
                        pa.array([s for s in deviation[part] for _ in range(k)], pa.int64()), pa.array(flat, mask=np.isnan(flat)),
                        pa.array(np.tile(explained, size), mask=np.tile(np.isnan(explained), size)),
                        pa.array([w.identity_error] * (size * k), pa.float64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return usable(vectors, key, vector).mapInArrow(work, OUT + ", identity_error double")


def whiten(vectors: DataFrame, components: int = 8, key: str = "vec_id", vector: str = "embedding", scale: int = 1024, shift: int = 100_000) -> DataFrame:
    return apply(vectors, fit(vectors, components, key, vector, scale, shift), key, vector, scale, shift)
