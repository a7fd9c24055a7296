"""Exact top-k search by inner product, with segment statistics as bounds, from coarse to fine.

Vectors become integers, floor(``scale`` * x). A vector's segments have a mean m and a deviation s. For one segment of
length n the squared distance of q and x is at least n * ((mq - mx)**2 + (sq - sx)**2); with the lengths of both vectors
known this lower bound on the distance is the upper bound sum(n * (mq * mx + sq * sx)) on the inner product, and finer
segments tighten it. Each task keeps, per query, the best k exact scores that it has seen; a batch of candidates is
bounded at one segment, then more, and only survivors that may still enter the best k get exact scores.

Queries are the rows whose id is divisible by ``every``. They go over the candidates in blocks of at most ``block``
queries, each broadcast, so what a task holds is bounded. Tasks return k rows per query; these are ranked by a window
whose groups hold k rows per task, after a first ranking within groups of tasks.

Cases: a null id, a null vector and a vector with a null or non-finite component take no part; vectors are compared with
vectors of the same length only; an empty vector scores 0 with others; rows with the query's id are its own and no
candidates; ties go to the smaller id, and repeated rows of one id each count. Doubles sum products exactly in any order
while the product of both lengths is below 2**53; pairs beyond that get whole numbers of any size, and are ranked by
them. A score beyond 64 bits is returned as the largest or smallest long; a component whose product with ``scale``
is beyond all doubles counts as the largest double of its sign.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEVELS = (1, 4, 16)
#: Sums of products below this are exact in doubles.
EXACT = 2.0**53


def sortable(score: int) -> str:
    """A text that sorts as the whole number does: sign, number of digits, digits; complements where it is negative."""
    digits = str(abs(score))
    if score >= 0:
        return f"p{len(digits):04d}{digits}"
    return f"n{9999 - len(digits):04d}{digits.translate(_NINES)}"


_NINES = str.maketrans("0123456789", "9876543210")


def usable(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = 1024) -> DataFrame:
    """(vec_id, v): integer vectors as doubles, of the rows that take part."""
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v")).where("vec_id is not null and v is not null")
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    largest = float(np.finfo(float).max)

    def whole(x: Column) -> Column:
        y = x * F.lit(float(scale))
        # From 2**53 on every double is whole, and floor would stop at 64 bits.
        return F.when(F.abs(y) < EXACT, F.floor(y).cast("double")).otherwise(F.greatest(F.least(y, F.lit(largest)), F.lit(-largest)))

    return rows.where(sound).select("vec_id", F.transform("v", whole).alias("v"))


def _statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """sqrt(n) * mean and sqrt(n) * deviation of each segment: their products with another row's bound the score."""
    width = vectors.shape[1]
    edges = np.unique(np.linspace(0, width, min(segments, max(width, 1)) + 1).astype(int))
    out = []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        part = vectors[:, a:b]
        out += [part.mean(axis=1) * np.sqrt(b - a), part.std(axis=1) * np.sqrt(b - a)]
    return np.stack(out, axis=1) if out else np.zeros((len(vectors), 1))


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, vectors) of each length in the batch."""
    ids, lists = batch.column(0).to_numpy(), batch.column(1)
    lengths = lists.value_lengths().to_numpy()
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        yield ids[rows], lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), n)


class _Best:
    """The best k (score, id) of each query seen so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        with np.errstate(all="ignore"):
            self.levels = [_statistics(vectors, n) for n in LEVELS if n == 1 or n <= vectors.shape[1]]
        with np.errstate(over="ignore"):
            self.length = np.sqrt((vectors**2).sum(axis=1))
        self.score, self.who = np.full((len(ids), k), -np.inf), np.full((len(ids), k), np.iinfo(np.int64).max)
        self.large: dict[int, list[tuple[int, int]]] = {}
        self.large_least = np.full(len(ids), -np.inf)

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        # Lengths and bounds of huge vectors may be infinite or not a number; such pairs stay alive.
        with np.errstate(all="ignore"):
            length = np.sqrt((vectors**2).sum(axis=1))
            # A little above the bound, so that rounding of means and deviations cannot lose a candidate.
            slack = 1e-9 * np.outer(self.length, length) + 1e-6
            bounds = self.levels[0] @ _statistics(vectors, LEVELS[0]).T + slack
            fresh = np.ones(len(ids), bool)
            if np.isneginf(self.least()).any() and len(ids):
                first = np.argsort(-bounds.max(axis=0), kind="stable")[: 4 * self.k]
                self._pairs(np.repeat(np.arange(len(self.ids)), len(first)), np.tile(first, len(self.ids)), ids, vectors, length)
                fresh[first] = False
            alive = ~(bounds < self.least()[:, None]) & fresh[None, :]
            for number, own in enumerate(self.levels[1:], 1):
                some_q, some_x = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
                if not len(some_q):
                    return
                fine = own[some_q] @ _statistics(vectors[some_x], LEVELS[number]).T + slack[np.ix_(some_q, some_x)]
                alive[np.ix_(some_q, some_x)] &= ~(fine < self.least()[some_q, None])
            self._pairs(*np.nonzero(alive), ids, vectors, length)

    def least(self) -> np.ndarray:
        """What a score has to reach to be among the best of its query."""
        return np.maximum(self.score[:, -1], self.large_least)

    def _pairs(self, q: np.ndarray, x: np.ndarray, ids: np.ndarray, vectors: np.ndarray, length: np.ndarray) -> None:
        small = self.length[q] * length[x] < EXACT
        self._exact(q[small], x[small], ids, vectors)
        own: dict[int, list[int]] = {}
        for a, b in zip(q[~small].tolist(), x[~small].tolist(), strict=True):
            if self.ids[a] == ids[b]:
                continue
            if a not in own:
                own[a] = [int(c) for c in self.vectors[a].tolist()]
            score = sum(c * int(d) for c, d in zip(own[a], vectors[b].tolist(), strict=True))
            best = self.large.setdefault(a, [])
            best.append((-score, int(ids[b])))
            if len(best) > 4 * self.k:
                self._settle(a)
        for a in self.large:
            self._settle(a)

    def _settle(self, a: int) -> None:
        best = self.large[a] = sorted(self.large[a])[: self.k]
        if len(best) == self.k:
            try:
                # Below the score in any case: bounds are compared with it in doubles.
                last = float(-best[-1][0])
                self.large_least[a] = last - abs(last) * 1e-9
            except OverflowError:
                self.large_least[a] = np.finfo(float).max if best[-1][0] < 0 else -np.inf

    def found(self) -> Iterator[tuple[int, int, int]]:
        """(query, candidate, score) of the best of both kinds."""
        for a, query in enumerate(self.ids.tolist()):
            some = [(-int(s), int(w)) for s, w in zip(self.score[a].tolist(), self.who[a].tolist(), strict=True) if s != -np.inf]
            for score, who in sorted(some + self.large.get(a, []))[: self.k]:
                yield query, who, -score

    def _exact(self, q: np.ndarray, x: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        own = self.ids[q] == ids[x]
        q, x = q[~own], x[~own]
        for a in range(0, len(q), 1 << 17):
            some_q, some_x = q[a : a + (1 << 17)], x[a : a + (1 << 17)]
            score = np.einsum("ij,ij->i", self.vectors[some_q], vectors[some_x])
            better = score >= self.score[some_q, -1]
            some_q, score, who = some_q[better], score[better], ids[some_x[better]]
            touched = np.unique(some_q)
            all_q = np.concatenate((np.repeat(touched, self.k), some_q))
            all_s = np.concatenate((self.score[touched].ravel(), score))
            all_w = np.concatenate((self.who[touched].ravel(), who))
            order = np.lexsort((all_w, -all_s, all_q))
            all_q, all_s, all_w = all_q[order], all_s[order], all_w[order]
            start = np.searchsorted(all_q, touched)
            keep = (start[:, None] + np.arange(self.k)).ravel()
            self.score[touched], self.who[touched] = all_s[keep].reshape(-1, self.k), all_w[keep].reshape(-1, self.k)


def search(vectors: DataFrame, k: int = 10, every: int = 100, key: str = "vec_id", vector: str = "embedding", scale: int = 1024, block: int = 2048) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` best candidates, all of them if there are fewer."""
    rows = usable(vectors, key, vector, scale)
    queries = rows.where(F.col("vec_id") % every == 0).dropDuplicates()
    size = queries.count()
    blocks = max(1, -(-size // block))
    found = None
    for number in range(blocks):
        # Hash blocks are uneven by a little; each holds about ``block`` queries, and no row is left out.
        part = queries if blocks == 1 else queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == number)
        part = part.toPandas()
        made = rows.mapInArrow(_scan(part["vec_id"].to_numpy(np.int64), part["v"].tolist(), k), "query_id long, vec_id long, score long, place string, task long")
        found = made if found is None else found.unionByName(made)
    order = [F.desc("place"), F.asc("vec_id")]
    near = Window.partitionBy("query_id", F.col("task") % 16).orderBy(*order)
    found = found.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= k)
    last = Window.partitionBy("query_id").orderBy(*order)
    found = found.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")


def _scan(ids: np.ndarray, vectors: list, k: int):
    lengths = np.array([len(v) for v in vectors], int)
    groups = {int(n): (ids[lengths == n], np.array([vectors[i] for i in np.flatnonzero(lengths == n)], float).reshape(int((lengths == n).sum()), n)) for n in np.unique(lengths)}
    shared = SparkContext._active_spark_context.broadcast(groups)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        best = {n: _Best(*group, k) for n, group in shared.value.items()}
        for batch in batches:
            for found, matrix in _matrices(batch):
                if matrix.shape[1] in best:
                    for a in range(0, len(found), 4096):
                        best[matrix.shape[1]].add(found[a : a + 4096], matrix[a : a + 4096])
        out = [row for group in best.values() for row in group.found()]
        query, who, score = zip(*out, strict=True) if out else ((), (), ())
        most = 2**63 - 1
        columns = [
            pa.array(query, pa.int64()),
            pa.array(who, pa.int64()),
            pa.array([max(-most - 1, min(most, s)) for s in score], pa.int64()),
            pa.array(map(sortable, score), pa.string()),
            pa.array([TaskContext.get().partitionId()] * len(out), pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score", "place", "task"])

    return work
