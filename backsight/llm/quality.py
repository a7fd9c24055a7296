"""Quality classifier: overlapping labellers, their accuracies by expectation-maximisation, and a hashed linear scorer.

Two questions are asked of every text: is it of low quality, and is it toxic. Labellers vote reject (1), keep (-1) or
abstain (0); some are heuristics on the text, one is the annotation of the labels table where there is one. The votes
of all rows are counted by pattern, and expectation-maximisation on the patterns estimates how often each labeller gives
each vote in either class, without any vote being taken for the truth. The posteriors of the patterns are soft labels.

The scorer sees the text alone: its distinct words and the binned heuristic measures, hashed to 64 bits. It is a logistic
regression on the posteriors of a bounded sample of rows, ``most_rows``, annotated rows first, over the ``most_features``
features that occur in six sample rows or more and differ most between the classes. A text is rejected if either
probability reaches one half. Only the sample is bounded; votes, patterns and scores cover all rows.

Cases: a null or empty text has no words, gets no votes and is kept; rows with a null id are scored and teach nothing;
several labels of one id count as their worst; rows that repeat an id are scored alone; without labels the heuristics
vote alone; without any votes nothing is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from backsight.llm.buffers import BYTE_CODES, WHITE, chunks, mixed, run_hashes, text_bytes, words_of
from backsight.llm.components import write

#: English insults, as a heuristic; further words are learned from the votes.
INSULTS = "clown disgusting dumb idiot idiotic loser moron pathetic scum stupid trash vermin worthless".split()

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_BREAK = np.ones(256, bool)
_BREAK[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[b for b in range(0x21, 0x7F) if not chr(b).isalnum() and chr(b) not in ".,;:'\"?()-"]] = True
_CAPITAL, _SMALL = (np.isin(np.arange(256), range(a, a + 26)) for a in (0x41, 0x61))

MEASURES = ("symbols", "capitals", "repeats", "bars", "variety", "insults")
QUALITY = ("symbols", "capitals", "repeats", "bars", "variety", "annotation")
TOXIC = ("insults", "many insults", "annotation")


def _hash_of(words: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    _, starts, ends, _ = words_of(data, np.array([0, len(data)]))
    return run_hashes_of(np.append(data, np.uint8(32)), starts, ends)


def run_hashes_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return run_hashes(BYTE_CODES[data], starts, ends)


class Texts:
    """Measures and hashed features of a chunk of texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        padded, starts, ends, first = words_of(data, offsets, WHITE)
        self.rows = len(offsets) - 1
        self.n = np.diff(first)
        row = np.repeat(np.arange(self.rows), self.n)
        size = ends - starts
        tail = padded[ends - 1], padded[np.maximum(ends - 2, 0)]
        symbols = _SYMBOL[tail[0]] & ((size == 1) | _SYMBOL[tail[1]])
        capitals = self._in(_CAPITAL, padded, starts, ends) >= 2
        capitals &= self._in(_SMALL, padded, starts, ends) == 0
        hashes = run_hashes_of(padded, starts, ends)
        repeats = np.concatenate(([False], (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])))[: len(hashes)]
        bars = (size == 1) & (padded[starts] == ord("|")) if len(starts) else np.zeros(0, bool)
        fresh = _first_of_each(row, hashes)
        most = np.maximum(self.n, 1)
        share = lambda marked: np.bincount(row[marked], minlength=self.rows) / most
        low = _LOWER[padded]
        _, starts, ends, first = words_of(_LOWER[data], offsets, _BREAK)
        self.word_row = np.repeat(np.arange(self.rows), np.diff(first))
        self.word_hash = run_hashes_of(low, starts, ends)
        insult = np.isin(self.word_hash, _hash_of(INSULTS))
        hits = np.bincount(self.word_row[insult], minlength=self.rows)
        variety = np.bincount(row[fresh], minlength=self.rows) / most
        self.measures = np.stack([share(symbols), share(capitals), share(repeats), share(bars), variety, hits], axis=1)

    @staticmethod
    def _in(table: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(table[data], dtype=np.int32)))
        return total[ends] - total[starts]

    def votes(self) -> np.ndarray:
        """The heuristic labellers' votes: quality first, then toxicity, without the annotations."""
        symbols, capitals, repeats, bars, variety, hits = self.measures.T
        vote = lambda reject, keep: np.where(reject, 1, np.where(keep, -1, 0))
        some = self.n > 0
        out = [
            vote(symbols > 0.1, symbols < 0.02),
            vote(capitals > 0.3, capitals < 0.1),
            vote(repeats > 0.15, repeats < 0.05),
            vote(bars > 0.1, np.zeros(len(bars), bool)),
            vote((variety < 0.2) & (self.n >= 30), (variety > 0.6) & (self.n >= 30)),
            vote(hits >= 1, hits == 0),
            vote(hits >= 3, hits == 1),
        ]
        return np.where(some[:, None], np.stack(out, axis=1), 0).astype(np.int8)

    def occurrences(self) -> tuple[np.ndarray, np.ndarray]:
        """(row, hash) of every word and of the binned measures."""
        bins = np.floor(np.minimum(self.measures[:, :4], 0.999) * 10)
        rows, hashes = [self.word_row], [self.word_hash]
        for k in range(4):
            marked = np.flatnonzero(bins[:, k] > 0)
            names = _hash_of([f"{MEASURES[k]}:{b}" for b in range(10)])
            rows.append(marked)
            hashes.append(names[bins[marked, k].astype(int)])
        few = np.flatnonzero((self.measures[:, 4] < 0.2) & (self.n >= 30))
        rows.append(few)
        hashes.append(np.repeat(_hash_of(["variety:low"]), len(few)))
        return np.concatenate(rows), np.concatenate(hashes)

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """(row, hash) of each distinct feature of each row."""
        rows, hashes = self.occurrences()
        fresh = _first_of_each(rows, hashes)
        return rows[fresh], hashes[fresh]


def _first_of_each(rows: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Where each pair of row and hash stands first; pairs are told apart by a 64-bit hash of both."""
    return np.unique(mixed(hashes + mixed(rows.astype(np.uint64) + np.uint64(1))), return_index=True)[1]


def _each(column: pa.Array) -> Iterator[tuple[int, int, Texts]]:
    data, offsets = text_bytes(column)
    for a, b in chunks(offsets):
        yield a, b, Texts(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])


def votes(docs: DataFrame, labels: DataFrame | None, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, quality, toxic, annotated): the votes of all labellers on each row with an id, as strings of r, k and -."""
    rows = docs.where(F.col(doc).isNotNull()).select(F.col(doc).alias("doc_id"), F.col(text).cast("string").alias("text"))
    signs = np.array(["-", "r", "k"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words: list[list[str]] = [[], []]
            for _, _, texts in _each(batch.column(1)):
                found = signs[texts.votes()]
                split = len(QUALITY) - 1
                words[0] += ["".join(x) for x in found[:, :split]]
                words[1] += ["".join(x) for x in found[:, split:]]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(w, pa.string()) for w in words)], ["doc_id", "quality", "toxic"])

    found = rows.mapInArrow(work, f"doc_id {dict(rows.dtypes)['doc_id']}, quality string, toxic string")
    if labels is None:
        return found.select("doc_id", F.concat("quality", F.lit("-")).alias("quality"), F.concat("toxic", F.lit("-")).alias("toxic"), F.lit(False).alias("annotated"))
    known = labels.groupBy(F.col("doc_id").alias("doc_id")).agg(F.min(F.col("quality") != 0).alias("good"), F.max(F.col("toxic") != 0).alias("bad"))
    sign = lambda reject: F.when(reject, "r").when(~reject, "k").otherwise("-")
    return found.join(known, "doc_id", "left").select(
        "doc_id",
        F.concat("quality", sign(~F.col("good"))).alias("quality"),
        F.concat("toxic", sign(F.col("bad"))).alias("toxic"),
        (F.col("good").isNotNull() | F.col("bad").isNotNull()).alias("annotated"),
    )


def estimate(patterns: dict[str, int], rounds: int = 200) -> tuple[dict[str, float], np.ndarray]:
    """Posterior P(reject) of each vote pattern, and each labeller's accuracy as [class keep or reject, labeller].

    An abstaining labeller says nothing, so heuristics that abstain together do not outvote the one that speaks. The
    last labeller, the annotation, is believed to be right, with the weight of half the rows that it votes on.
    """
    voted = {p: n for p, n in patterns.items() if p.strip("-")}
    if not voted:
        return {}, np.zeros((2, 0))
    names = sorted(voted)
    count = np.array([voted[p] for p in names], float)
    reject, keep = (np.array([[c == v for c in p] for p in names], float) for v in "rk")
    right = np.stack([np.full(reject.shape[1], 0.95), np.full(reject.shape[1], 0.7)])
    belief, weight = right.copy(), np.ones(reject.shape[1])
    belief[:, -1], weight[-1] = 0.998, 1 + 0.5 * float(count @ (reject + keep)[:, -1])
    prior = 0.1
    for _ in range(rounds):
        good = keep @ np.log(right[0]) + reject @ np.log(1 - right[0]) + np.log(1 - prior)
        bad = reject @ np.log(right[1]) + keep @ np.log(1 - right[1]) + np.log(prior)
        bad = 1 / (1 + np.exp(np.clip(good - bad, -500, 500)))
        weights = np.stack([count * (1 - bad), count * bad])
        agree, differ = np.stack([weights[0] @ keep, weights[1] @ reject]), np.stack([weights[0] @ reject, weights[1] @ keep])
        right = (agree + belief * weight) / (agree + differ + weight)
        prior = (weights[1].sum() + 0.1) / (count.sum() + 1)
    return dict(zip(names, bad.tolist(), strict=True)), right


class Scorer:
    """Linear scores over sorted feature hashes, for both questions."""

    def __init__(self, hashes: np.ndarray, weights: np.ndarray, bias: np.ndarray):
        self.hashes, self.weights, self.bias = hashes, weights, bias

    def probabilities(self, texts: Texts) -> np.ndarray:
        scores = np.tile(self.bias, (texts.rows, 1))
        if len(self.hashes):
            rows, at = self.find(texts)
            for k in range(2):
                scores[:, k] += np.bincount(rows, self.weights[at, k], minlength=texts.rows)
        out = 1 / (1 + np.exp(-np.clip(scores, -500, 500)))
        return np.where((texts.n > 0)[:, None], out, 0.0)

    def find(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """(row, place of the feature) of each distinct feature that the scorer knows."""
        rows, hashes = texts.occurrences()
        if not len(self.hashes):
            return rows[:0], rows[:0]
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        hit = np.flatnonzero(self.hashes[at] == hashes)
        code = np.unique(rows[hit] * len(self.hashes) + at[hit])
        return code // len(self.hashes), code % len(self.hashes)


def _regression(rows: np.ndarray, at: np.ndarray, n: int, width: int, target: np.ndarray, shrink: float = 0.1, rounds: int = 25) -> tuple[np.ndarray, float]:
    """Logistic regression on sparse 0/1 features with soft targets: Newton steps, each solved by conjugate gradients.

    The last number of a solution is the bias, which is hardly shrunk.
    """
    rows, at = np.concatenate((rows, np.arange(n))), np.concatenate((at, np.full(n, width)))
    penalty = np.full(width + 1, shrink)
    penalty[-1] = 1e-6
    times = lambda x: np.bincount(rows, x[at], minlength=n)
    back = lambda y: np.bincount(at, y[rows], minlength=width + 1)
    solution = np.zeros(width + 1)
    solution[-1] = np.log((target.sum() + 0.5) / (n - target.sum() + 0.5))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(times(solution), -500, 500)))
        curve = np.maximum(p * (1 - p), 1e-6)
        left = back(target - p) - penalty * solution
        scale = 1 / (back(curve) + penalty)
        step, direction = np.zeros(width + 1), scale * left
        energy = start = float(left @ (scale * left))
        for _ in range(40):
            if energy <= 1e-6 * start or energy <= 1e-14:
                break
            image = back(curve * times(direction)) + penalty * direction
            length = energy / float(direction @ image)
            step, left = step + length * direction, left - length * image
            last, energy = energy, float(left @ (scale * left))
            direction = scale * left + energy / last * direction
        largest = float(np.abs(step).max())
        solution = solution + step * min(1.0, 5.0 / max(largest, 1e-12))
        if largest < 1e-4:
            break
    return solution[:-1], float(solution[-1])


def train(docs: DataFrame, labels: DataFrame | None, doc: str = "doc_id", text: str = "text", most_rows: int = 30_000, most_features: int = 20_000) -> Scorer:
    """The scorer for ``docs``; ``most_rows`` bounds the sample it is fitted on, ``most_features`` the model."""
    spark = docs.sparkSession
    voted, _ = write(votes(docs, labels, doc, text), "votes")
    posterior = [estimate({r[0]: r[1] for r in voted.groupBy(c).count().collect()})[0] for c in ("quality", "toxic")]
    # A pattern is one of 3**labellers at most, so both tables have a fixed bound.
    known = [spark.createDataFrame([(k, v) for k, v in p.items()] or [("", 0.0)], f"{c} string, p_{c} double") for c, p in zip(("quality", "toxic"), posterior, strict=True)]
    labelled = voted.join(F.broadcast(known[0]), "quality").join(F.broadcast(known[1]), "toxic", "left")
    sample = labelled.select("doc_id", "p_quality", F.coalesce("p_toxic", F.lit(0.0)).alias("p_toxic"), "annotated")
    sample = sample.orderBy(F.desc("annotated"), F.xxhash64("doc_id"), "doc_id").limit(most_rows).drop("annotated")
    sample, _ = write(sample, "labelled-sample")
    rows = docs.select(F.col(doc).alias("doc_id"), F.col(text).cast("string").alias("text")).join(F.broadcast(sample), "doc_id")
    rows, _ = write(rows, "sample-texts")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = np.stack([batch.column(2).to_numpy(), batch.column(3).to_numpy()], axis=1)
            for a, _, texts in _each(batch.column(1)):
                row, hashes = texts.features()
                distinct, at = np.unique(hashes, return_inverse=True)
                sums = [np.bincount(at, p[a + row, k], minlength=len(distinct)) for k in range(2)]
                yield pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), pa.array(np.bincount(at, minlength=len(distinct))), *(pa.array(x) for x in sums)], ["feature", "n", "q", "t"])

    n, q, t = (float(x or 0) for x in rows.agg(F.count("*"), F.sum("p_quality"), F.sum("p_toxic")).first())
    if not n:
        return Scorer(np.zeros(0, np.uint64), np.zeros((0, 2)), np.array([-500.0, -500.0]))
    counts = rows.mapInArrow(count, "feature long, n long, q double, t double").groupBy("feature").agg(*(F.sum(c).alias(c) for c in ("n", "q", "t")))
    distance = [(F.col(c) - F.col("n") * (s / n)) / F.sqrt(F.col("n") * max(s / n * (1 - s / n), 1e-9)) for c, s in (("q", q), ("t", t))]
    chosen = counts.where("n >= 6").select("feature", F.greatest(*distance).alias("z")).where("z >= 5").orderBy(F.desc("z"), "feature").limit(most_features)
    hashes = np.sort(np.array([r[0] for r in chosen.select("feature").collect()], np.int64).view(np.uint64))
    empty = Scorer(hashes, np.zeros((len(hashes), 2)), np.zeros(2))
    shared = SparkContext._active_spark_context.broadcast(empty)

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[int]] = [[] for _ in range(len(batch))]
            for a, _, texts in _each(batch.column(1)):
                for row, at in zip(*(x.tolist() for x in shared.value.find(texts)), strict=True):
                    out[a + row].append(at)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.int32())), batch.column(2), batch.column(3)], ["doc_id", "at", "q", "t"])

    made = rows.mapInArrow(present, f"doc_id {dict(rows.dtypes)['doc_id']}, at array<int>, q double, t double")
    made = made.dropDuplicates(["doc_id"]).orderBy("doc_id").toArrow().combine_chunks()
    lists, n = made["at"].combine_chunks(), len(made)
    row, at = np.repeat(np.arange(n), lists.value_lengths().to_numpy()), lists.flatten().to_numpy()
    fits = [_regression(row, at, n, len(hashes), made[c].to_numpy()) for c in ("q", "t")]
    return Scorer(hashes, np.stack([w for w, _ in fits], axis=1), np.array([b for _, b in fits]))


def score(docs: DataFrame, scorer: Scorer, text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` as ``row``, with n_words, p_low_quality, p_toxic and rejected."""
    shared = SparkContext._active_spark_context.broadcast(scorer)
    rows = docs.select(F.struct("*").alias("row"), F.col(text).cast("string").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, p = np.zeros(len(batch), np.int64), np.zeros((len(batch), 2))
            for a, b, texts in _each(batch.column(1)):
                n[a:b], p[a:b] = texts.n, shared.value.probabilities(texts)
            columns = [batch.column(0), pa.array(n), pa.array(p[:, 0]), pa.array(p[:, 1]), pa.array((p >= least).any(axis=1))]
            yield pa.RecordBatch.from_arrays(columns, ["row", "n_words", "p_low_quality", "p_toxic", "rejected"])

    schema = rows.select("row").schema.add("n_words", "long").add("p_low_quality", "double").add("p_toxic", "double").add("rejected", "boolean")
    return rows.mapInArrow(work, schema)


def accepted(docs: DataFrame, labels: DataFrame | None, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that are not rejected."""
    return score(docs, train(docs, labels, doc, text), text).where(~F.col("rejected")).select("row.*")
