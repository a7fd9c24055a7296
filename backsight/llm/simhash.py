"""SimHash near-duplicates: 64-bit fingerprints linked at two or fewer differing bits, by a generalised pigeonhole.

The bits are grouped into parts by correlation, measured over all distinct fingerprints. Part i gets a threshold T(i) of
-1 (unused) or more. If the thresholds add up to 2 - parts + 1, a linked pair differs by at most T(i) bits in some part i.
Dynamic programming picks thresholds, and the number of parts, by the candidates and probes they are estimated to cost.
Each fingerprint then probes the parts with its own bits and their variants within T(i), and what meets is verified.

A probe key that many fingerprints share is not compared pair by pair: two fingerprints differ by two bits or fewer
exactly if some value is within one bit of both, so grouping the 65 values near each one finds the same links in linear
work. That is done inside the task for keys of up to ``most_together`` fingerprints and as a shuffle beyond that.

Cases: a null or empty text has fingerprint zero and is linked like any other; fewer than three words are one shingle;
copies and repeated rows share one fingerprint and are compared once; a null doc_id gets the component's smallest known
id (null if there is none) and is nobody's representative. Other columns are ignored by ``near_duplicates``.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from backsight.llm.buffers import give_back
from backsight.llm.components import components, write

SEED, SHINGLE, BITS, LINK = 42, 3, 64, 2
#: Up to this many fingerprints of one key are compared pair by pair.
PAIRWISE = 48
_BIT_TABLE = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: bytes | None, size: int = SHINGLE) -> int:
    """A bit is set if it is set in more than half of the XXH64 hashes of the word shingles, repeats included."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) <= size:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    first = np.concatenate(([0], ends[:-size] + 1)).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(first, ends[size - 1 :].tolist(), strict=True)), np.uint64, len(first))
    octets = hashes.view(np.uint8).reshape(-1, 8)
    if len(first) < 400:
        set_in = np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)
    else:
        set_in = np.concatenate([np.bincount(octets[:, k], minlength=256) @ _BIT_TABLE for k in range(8)])
    return int(np.packbits(2 * set_in > len(first), bitorder="little").view(np.uint64)[0])


def with_fingerprints(rows: DataFrame) -> DataFrame:
    """``rows`` holds a column to keep and then a text; the text is replaced by fp, the fingerprint as a signed long."""
    kept = rows.select(rows.columns[0]).schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(x.as_py()) for x in batch.column(1).cast(pa.binary())], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], [kept[0].name, "fp"])
            give_back()

    return rows.mapInArrow(work, kept.add("fp", "long"))


def fingerprints(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    return with_fingerprints(docs.select(F.col(doc).alias("doc_id"), F.col(text).cast("string").alias("text")))


def bit_statistics(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """The number of fingerprints, and in how many of them bits i and j are both set, over all rows."""

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros((BITS, BITS)), 0
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint8).reshape(-1, 8)
            for at in range(0, len(values), 65536):
                bits = np.unpackbits(values[at : at + 65536], axis=1, bitorder="little").astype(np.float32)
                total, rows = total + bits.T @ bits, rows + len(bits)
        flat = np.concatenate((total.ravel(), [rows])).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], ["cell", "n"])

    cells = distinct.select("fp").mapInArrow(gram, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    flat = np.zeros(BITS * BITS + 1)
    for cell, n in cells:
        flat[cell] = n
    return int(flat[-1]), flat[:-1].reshape(BITS, BITS)


def grouped_bits(rows: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """``parts`` groups of about equal size; each grows by the bit most correlated with what it holds."""
    p = np.diag(both) / max(rows, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    strength = np.abs((both / max(rows, 1) - np.outer(p, p)) / np.outer(spread, spread))
    free, groups = set(range(BITS)), []
    for k in range(parts):
        size = (BITS - sum(map(len, groups))) // (parts - k)
        group = [max(free, key=lambda i: (strength[i, sorted(free)].sum(), -i))]
        free.remove(group[0])
        while len(group) < size:
            group.append(max(free, key=lambda i: (strength[i, group].sum(), -i)))
            free.remove(group[-1])
        groups.append(sorted(group))
    return groups


def close_share(rows: int, both: np.ndarray, bits: list[int], most: int) -> float:
    """The estimated share of pairs that differ by at most ``most`` of ``bits``.

    Mean and variance of the distance between two rows follow exactly from the pairwise statistics; a beta-binomial
    with these two moments stands for its distribution, so correlated bits raise the share.
    """
    n, w = max(rows, 1), len(bits)
    p11 = both[np.ix_(bits, bits)] / n
    p = np.diag(p11)
    p10, p01 = p[:, None] - p11, p[None, :] - p11
    p00 = 1 - p11 - p10 - p01
    joint = 2 * (p11 * p00 + p10 * p01)
    mean = float(np.diag(joint).sum())
    variance = float(joint.sum()) - mean**2
    rate = min(max(mean / w, 1e-9), 1 - 1e-9)
    excess = (variance / (w * rate * (1 - rate)) - 1) / max(w - 1, 1)
    if excess <= 1e-6:
        return sum(math.comb(w, k) * rate**k * (1 - rate) ** (w - k) for k in range(most + 1))
    scale = 1 / min(excess, 0.999) - 1
    x, y = rate * scale, (1 - rate) * scale
    beta = lambda u, v: math.lgamma(u) + math.lgamma(v) - math.lgamma(u + v)
    return sum(math.comb(w, k) * math.exp(beta(k + x, w - k + y) - beta(x, y)) for k in range(most + 1))


def allocation(rows: int, both: np.ndarray) -> list[tuple[list[int], int]]:
    """Parts with their thresholds, least estimated candidates plus probes; dynamic programming over the parts."""
    best: tuple[float, list[tuple[list[int], int]]] = (math.inf, [])
    for parts in range(1, LINK + 2):
        groups, target = grouped_bits(rows, both, parts), LINK - parts + 1
        states: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for group in groups:
            after: dict[int, tuple[float, list[int]]] = {}
            for used, (cost, chosen) in states.items():
                for t in range(-1, LINK + 1):
                    probes = sum(math.comb(len(group), k) for k in range(t + 1))
                    extra = rows * probes + rows * rows / 2 * close_share(rows, both, group, t) if t >= 0 else 0.0
                    if cost + extra < after.get(used + t, (math.inf,))[0]:
                        after[used + t] = (cost + extra, [*chosen, t])
            states = after
        if target in states and states[target][0] < best[0]:
            best = (states[target][0], list(zip(groups, states[target][1], strict=True)))
    return [(bits, t) for bits, t in best[1] if t >= 0]


def probes(distinct: DataFrame, parts: list[tuple[list[int], int]]) -> DataFrame:
    """(part, key, fp): each fingerprint under its own bits of a part and under their variants within the threshold."""
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows = []
    for number, (bits, most) in enumerate(parts):
        mask = signed(sum(1 << b for b in bits))
        flips = [signed(sum(1 << b for b in chosen)) for k in range(most + 1) for chosen in itertools.combinations(bits, k)]
        own = F.col("fp").bitwiseAND(F.lit(mask))
        keys = F.array(own) if flips == [0] else F.transform(F.array(*map(F.lit, flips)), lambda x, own=own: own.bitwiseXOR(x))
        rows.append(F.transform(keys, lambda k, number=number: F.struct(F.lit(number).alias("part"), k.alias("key"))))
    return distinct.select("fp", F.explode(F.concat(*rows)).alias("at")).select("at.part", "at.key", "fp")


def spanning(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is connected at two or fewer differing bits among distinct ``values``; linear work."""
    flips = np.concatenate(([np.uint64(0)], np.uint64(1) << np.arange(BITS, dtype=np.uint64)))
    label = np.arange(len(values))
    slices = max(1, len(values) * len(flips) // (2 << 20))
    for part in range(slices):
        near, owner = [], []
        for flip in flips:
            z = values ^ flip
            chosen = np.flatnonzero(z % np.uint64(slices) == part) if slices > 1 else np.arange(len(z))
            near.append(z[chosen])
            owner.append(chosen)
        near, owner = np.concatenate(near), np.concatenate(owner)
        order = np.argsort(near, kind="stable")
        near, owner = near[order], owner[order]
        same = np.flatnonzero(near[1:] == near[:-1])
        a, b = owner[same], owner[same + 1]
        while len(a):
            x, y = label[a], label[b]
            apart = x != y
            if not apart.any():
                break
            a, b, low, high = a[apart], b[apart], np.minimum(x, y)[apart], np.maximum(x, y)[apart]
            np.minimum.at(label, high, low)
            while (label[label] != label).any():
                label = label[label]
    moved = np.flatnonzero(label != np.arange(len(values)))
    return values[moved], values[label[moved]]


def _verify(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links among the rows of each run of equal keys."""
    edges = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1), [True])))
    size = np.repeat(np.diff(edges), np.diff(edges))
    few = np.flatnonzero((size > 1) & (size <= PAIRWISE))
    run = np.repeat(np.arange(len(edges) - 1), np.diff(edges))[few]
    found_a, found_b = [], []
    for step in range(1, PAIRWISE):
        near = np.flatnonzero(run[step:] == run[:-step]) if len(run) > step else run[:0]
        if not len(near):
            break
        x, y = values[few[near]], values[few[near + step]]
        close = np.bitwise_count(x ^ y) <= LINK
        found_a.append(x[close])
        found_b.append(y[close])
    for k in np.flatnonzero(np.diff(edges) > PAIRWISE):
        a, b = spanning(np.unique(values[edges[k] : edges[k + 1]]))
        found_a.append(a)
        found_b.append(b)
    if not found_a:
        return values[:0], values[:0]
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    return a[a != b], b[a != b]


def _link_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (part, key); a key's rows may go over several batches."""
    keys, values = np.zeros((0, 2), np.int64), np.zeros(0, np.uint64)

    def out(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    for batch in batches:
        more = np.stack([batch.column(0).to_numpy().astype(np.int64), batch.column(1).to_numpy()], axis=1)
        keys, values = np.concatenate((keys, more)), np.concatenate((values, batch.column(2).to_numpy().view(np.uint64)))
        open_from = len(keys) - int((keys[::-1] == keys[-1]).all(axis=1).cumprod().sum()) if len(keys) else 0
        if open_from:
            yield out(*_verify(keys[:open_from], values[:open_from]))
            keys, values = keys[open_from:], values[open_from:]
    if len(keys):
        yield out(*_verify(keys, values))


def links(distinct: DataFrame, most_together: int = 1_000_000) -> DataFrame:
    """(a, b): links that connect all fingerprints within two bits of each other; not every such pair is listed."""
    parts = allocation(*bit_statistics(distinct))
    rows = probes(distinct, parts) if parts else distinct.select(F.lit(0).alias("part"), F.col("fp").alias("key"), "fp")
    counts = rows.groupBy("part", "key").count().where(F.col("count") > 1)
    counts, _ = write(counts, "shared-keys")
    shared = rows.join(counts.where(F.col("count") <= most_together).select("part", "key"), ["part", "key"])
    found = shared.repartition("part", "key").sortWithinPartitions("part", "key").mapInArrow(_link_groups, "a long, b long")
    crowded = counts.where(F.col("count") > most_together).select("part", "key")
    if crowded.isEmpty():
        return found
    flips = [0, *(1 << b for b in range(63)), -(1 << 63)]
    near = rows.join(crowded, ["part", "key"], "left_semi").select("fp").distinct().select("fp", F.explode(F.array(*map(F.lit, flips))).alias("flip"))
    near = near.groupBy(F.col("fp").bitwiseXOR(F.col("flip")).alias("z")).agg(F.min("fp").alias("b"), F.collect_list("fp").alias("all"))
    return found.union(near.where(F.size("all") > 1).select(F.explode("all").alias("a"), "b").where("a <> b"))


def named_components(docs: DataFrame, doc: str, text: str, most_together: int) -> tuple[DataFrame, DataFrame]:
    """The fingerprint of each row, and the component of each fingerprint: (doc_id, fp) and (fp, root, component_id)."""
    marked, _ = write(fingerprints(docs, doc, text), "fingerprints")
    distinct, _ = write(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    linked, _ = write(links(distinct, most_together), "fingerprint-links")
    rooted = distinct.join(components(linked).withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named, _ = write(rooted.join(smallest, "root").select("fp", "root", "component_id"), "components")
    return marked, named


def near_duplicates(docs: DataFrame, doc: str = "doc_id", text: str = "text", most_together: int = 1_000_000) -> DataFrame:
    """(doc_id, fp, fingerprint, component_id): one row per row of ``docs``."""
    marked, named = named_components(docs, doc, text, most_together)
    return marked.join(named, "fp").select("doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, doc: str = "doc_id", text: str = "text", most_together: int = 1_000_000) -> DataFrame:
    """The rows of ``docs``, all columns, that stand for their component: the row with its smallest id.

    Of rows that repeat this id one stays. A component without any id keeps one of its rows.
    """
    marked, named = named_components(docs, doc, text, most_together)
    ids = named.where("component_id is not null").select(F.col("component_id").alias("_kept")).distinct()
    kept = docs.join(ids, docs[doc] == ids["_kept"], "left_semi")
    rows, known, different = marked.agg(F.count("*"), F.count("doc_id"), F.count_distinct("doc_id")).first()
    if known > different:
        kept = kept.dropDuplicates([doc])
    if rows > known:
        unnamed = with_fingerprints(docs.where(F.col(doc).isNull()).select(F.struct("*").alias("row"), F.col(text).cast("string")))
        unnamed = unnamed.join(named.where("component_id is null"), "fp").dropDuplicates(["root"])
        kept = kept.unionByName(unnamed.select("row.*"))
    return kept
