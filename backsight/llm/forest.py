"""MinHash near-duplicates by an LSH forest: documents link if their sets of word shingles have a Jaccard similarity of
``percent`` hundredths or more.

A document's set holds 64-bit hashes of its distinct runs of ``shingle`` words; equal sets are one node from there on. A
node's signature has 96 MinHash bytes. The forest is 16 sorted orders of the nodes, each by another order of the same
bytes, dealt by ranges, so that no group of like signatures is tied to one task. In an order, the nodes that share a
prefix are a region, and the depth of a region adapts to how crowded it is: a node is compared with the neighbours whose
longest common prefix with it is longest, ``near`` on either side, and never with less than two bytes in common. Pairs whose signatures
lie six deviations below a similarity of ``percent`` go no further (1 in 10**9 of those just similar enough); all others are confirmed on their full sets. First come the most similar neighbours of the nodes; once these links are
components, the orders are read again for all pairs between different components. These pairs are never rows: a node comes
with its set once for each order in which it has such a neighbour, and the task that has both compares them.

Regions that stay crowded at a depth of 12 bytes are the ones where neighbours are not all there is. Where such a region still holds
several components, its nodes outside the largest one are compared with all its nodes, in blocks, on full sets; a task
returns only links that join components. So a crowd of near copies costs linear work, and no link is lost to the limit on neighbours.

Recall is that of the orders: a pair of similarity s lies in one region of depth k with probability 1 - (1 - s**k)**16.
Neighbours on two sides of a border between tasks are left to the other orders.

Cases: a null or empty text, or one without words, has the empty set and links with nothing; fewer words than a shingle
are one shingle; equal texts and repeated rows share a node; a null key takes the smallest known key of its component (null
if there is none) and is never kept. A text is read in slices of about 2 MB, so a long one needs 8 bytes for each of its
shingles. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from backsight.llm.buffers import BYTE_CODES, CHUNK_BYTES, WHITE, mixed, run_hashes, text_bytes, words_of
from backsight.llm.components import components, write

HASHES, ORDERS, FULL, LEAST_DEPTH = 96, 16, 12, 2
SHINGLE, PERCENT, NEAR, BLOCK = 5, 80, 8, 512
_RANDOM = np.random.default_rng(20_240)
_FACTORS = _RANDOM.integers(1, 2**63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEP = np.uint64(0xD1342543DE82EF95)


def _orders() -> np.ndarray:
    """Permutations of the bytes; the first ``FULL`` bytes of eight successive orders are disjoint."""
    out, per = [], HASHES // FULL
    for _ in range(-(-ORDERS // per)):
        shuffled = _RANDOM.permutation(HASHES)
        for k in range(per):
            first = shuffled[k * FULL : (k + 1) * FULL]
            out.append(np.concatenate((first, _RANDOM.permutation(np.setdiff1d(shuffled, first)))))
    return np.array(out[:ORDERS])


_ORDER_TABLE = _orders()


def least_agreement(percent: int) -> int:
    """Bytes that two signatures must share to stay: six deviations below what the similarity lets expect."""
    s = percent / 100
    return max(0, int(HASHES * s - 6 * np.sqrt(HASHES * s * (1 - s))))


def _slices(data: np.ndarray) -> Iterator[np.ndarray]:
    """A long text in pieces of about ``CHUNK_BYTES`` that end after white space or the text."""
    at = 0
    while at < len(data):
        end = min(at + CHUNK_BYTES, len(data))
        while end < len(data):
            white = np.flatnonzero(WHITE[data[end : end + CHUNK_BYTES]])
            if len(white):
                end += int(white[0]) + 1
                break
            end = min(end + CHUNK_BYTES, len(data))
        yield data[at:end]
        at = end


def _shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` word hashes; of the whole sequence if it is shorter."""
    size = min(size, len(words))
    if not size:
        return words
    with np.errstate(over="ignore"):
        found = np.full(len(words) - size + 1, size, np.uint64)
        for k in range(size):
            found = found * _STEP + words[k : len(words) - size + 1 + k]
    return mixed(found)


def _texts(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The ascending distinct shingle hashes of each text of a column."""
    data, offsets = text_bytes(column)
    row = 0
    while row < len(offsets) - 1:
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, "right")) - 1)
        part = data[offsets[row] : offsets[last]]
        if len(part) > CHUNK_BYTES:  # one long text
            words = [run_hashes(BYTE_CODES[_LOWER[p]], starts, ends) for p, starts, ends, _ in (words_of(x, np.array([0, len(x)])) for x in _slices(part))]
            yield np.unique(_shingles(np.concatenate(words), size))
        else:
            padded, starts, ends, first = words_of(part, offsets[row : last + 1] - offsets[row])
            words = run_hashes(BYTE_CODES[_LOWER[padded]], starts, ends)
            for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                yield np.unique(_shingles(words[a:b], size))
        row = last


def _signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of ``HASHES`` bytes for each non-empty set."""
    out = np.zeros((len(sets), HASHES), np.uint8)
    filled = [i for i, s in enumerate(sets) if len(s)]
    if filled:
        values = np.concatenate([sets[i] for i in filled])
        starts = np.concatenate(([0], np.cumsum([len(sets[i]) for i in filled])[:-1]))
        least = np.empty((len(filled), HASHES), np.uint64)
        with np.errstate(over="ignore"):
            for k, factor in enumerate(_FACTORS):
                least[:, k] = np.minimum.reduceat(values * factor, starts)
        out[filled] = mixed(least) >> np.uint64(56)
    return out


def _digests(sets: list[np.ndarray]) -> np.ndarray:
    """Two 64-bit sums over the members of each set."""
    with np.errstate(over="ignore"):
        return np.array([(mixed(s ^ _STEP).sum(dtype=np.uint64), mixed(s * _STEP + np.uint64(1)).sum(dtype=np.uint64)) for s in sets], np.uint64).reshape(-1, 2).view(np.int64)


def marked(docs: DataFrame, doc: str, text: str, shingle: int) -> DataFrame:
    """(doc_id, n_shingles, hi, lo, signature): one row per document."""
    rows = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, prints, held, room = [], [], [], [], 0

            def close(sizes=sizes, digests=digests, prints=prints, held=held) -> None:
                sizes.extend(map(len, held))
                digests.append(_digests(held))
                prints.append(_signatures(held))
                held.clear()

            for found in _texts(batch.column(1), shingle):
                held.append(found)
                room += len(found)
                if room > 500_000:
                    close()
                    room = 0
            close()
            both = np.concatenate(digests)
            flat = np.concatenate(prints)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array([r.tobytes() for r in flat], pa.binary())],
                ["doc_id", "n_shingles", "hi", "lo", "signature"],
            )

    return rows.mapInArrow(work, "doc_id long, n_shingles long, hi long, lo long, signature binary")


def sets_of(docs: DataFrame, nodes: DataFrame, doc: str, text: str, shingle: int) -> DataFrame:
    """(node, members): the full sets of ``nodes`` (node, first_id, n_shingles, hi, lo), read from their documents again."""
    rows = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    ids = nodes.select(F.col("first_id").alias("doc_id")).distinct()
    wanted = rows.join(ids, rows["doc_id"].eqNullSafe(ids["doc_id"]), "left_semi")

    def out(held: list[np.ndarray]) -> pa.RecordBatch:
        digests = _digests(held)
        columns = [pa.array([len(x) for x in held], pa.int64()), pa.array(digests[:, 0]), pa.array(digests[:, 1]), pa.array([x.tobytes() for x in held], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["n_shingles", "hi", "lo", "members"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, room = [], 0
        for batch in batches:
            for found in _texts(batch.column(0), shingle):
                held.append(found)
                room += len(found)
                if room > 500_000:
                    yield out(held)
                    held, room = [], 0
        if held:
            yield out(held)

    found = wanted.select("text").mapInArrow(work, "n_shingles long, hi long, lo long, members binary")
    return found.join(nodes, ["n_shingles", "hi", "lo"]).select("node", "members").dropDuplicates(["node"])


def forest(nodes: DataFrame, near: int, out: str, scan) -> DataFrame:
    """The orders of ``nodes`` (node, n_shingles, signature, root), each row ``scan``ned together with its neighbours.

    ``scan(rows, start, end, first, last)`` gets the columns tree, key, node, n and root of some rows in order, and which
    rows to compare with those that follow them; ``first`` and ``last`` say whether the task's rows begin or end here.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(-1, HASHES)
            for number, order in enumerate(_ORDER_TABLE):
                keys = [k.tobytes() for k in np.ascontiguousarray(prints[:, order])]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(prints), number, np.int32)), pa.array(keys, pa.binary()), *batch.columns[:3]], ["tree", "key", "node", "n", "root"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [np.zeros(0, np.int32), np.zeros((0, HASHES), np.uint8), *(np.zeros(0, np.int64) for _ in range(3))]
        done, first = 0, True  # rows before ``done`` were compared with all that follow them
        for batch, last in _with_last(batches):
            more = [batch.column(k).to_numpy() if k != 1 else np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, HASHES) for k in range(5)]
            rows = [np.concatenate(pair) for pair in zip(rows, more, strict=True)]
            size = len(rows[0])
            end = size if last else max(size - near, done)
            yield from scan(rows, done, end, first, last)
            keep = max(0, size - 2 * near)
            rows, done, first = [column[keep:] for column in rows], end - keep, False

    order = ["tree", "key", "node"]
    dealt = nodes.select("node", F.col("n_shingles").alias("n"), "root", "signature").mapInArrow(deal, "tree int, key binary, node long, n long, root long")
    count = nodes.count() * ORDERS
    parts = max(1, -(-count // 100_000), min(nodes.sparkSession.sparkContext.defaultParallelism, count // 2_000))
    return dealt.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(work, out)


def nearest(nodes: DataFrame, near: int, percent: int) -> DataFrame:
    """(a, b): for each node that has a candidate of another root the most similar one, by signature."""
    agreement = least_agreement(percent)

    def scan(rows, start, end, first, last) -> Iterator[pa.RecordBatch]:
        found = list(_compare(rows, start, end, near, agreement, percent))
        if found:
            a, b, agree = (np.concatenate(x) for x in zip(*found, strict=True))
            node, other, agree = rows[2][np.concatenate((a, b))], rows[2][np.concatenate((b, a))], np.concatenate((agree, agree))
            order = np.lexsort((other, -agree, node))
            best = order[np.concatenate(([True], np.diff(node[order]) != 0))] if len(order) else order
            yield pa.RecordBatch.from_arrays([pa.array(x[best]) for x in (node, other, agree.astype(np.int32))], ["node", "other", "agree"])

    rows = forest(nodes, near, "node long, other long, agree int", scan)
    best = rows.groupBy("node").agg(F.max_by("other", F.struct("agree", -F.col("other"))).alias("other"))
    return best.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


_FOUND = "block long, place int, tree int, node long, root long, region binary"


def between(nodes: DataFrame, near: int, percent: int) -> DataFrame:
    """(block, place, tree, node, root, null) of nodes that have a candidate of another root in an order, and rows
    (null, null, null, node, root, region) of crowded regions with several roots.

    A block is what a task compares at once; both nodes of a candidate pair are in one block, at most ``near`` places apart.
    """
    agreement = least_agreement(percent)

    def scan(rows, start, end, first, last) -> Iterator[pa.RecordBatch]:
        pairs = [np.concatenate((a, b)) for a, b, _ in _compare(rows, start, end, near, agreement, percent)]
        if pairs:
            some = np.unique(np.concatenate(pairs))
            block = int(rows[2][start]) * ORDERS + int(rows[0][start])  # the first row's own key names the block
            columns = [np.full(len(some), block, np.int64), some.astype(np.int32), *(rows[k][some] for k in (0, 2, 4))]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.nulls(len(some), pa.binary())], ["block", "place", "tree", "node", "root", "region"])
        yield from _crowded(rows, first, last, near)

    return forest(nodes, near, _FOUND, scan)


def joined_in_blocks(found: DataFrame, nodes: DataFrame, sets: DataFrame, near: int, percent: int) -> DataFrame:
    """Links (a, b) of roots: the candidates in the blocks of ``found``, confirmed on their full sets.

    A task streams the nodes of its blocks in order and holds ``near`` of them besides a batch; it returns only links that
    join components, so pairs are never rows.
    """
    agreement = least_agreement(percent)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, top = None, _Tops()
        for batch in batches:
            more = [column.to_numpy(zero_copy_only=False) for column in batch.columns]
            old = 0 if rows is None else len(rows[0])
            rows = more if rows is None else [np.concatenate(pair) for pair in zip(rows, more, strict=True)]
            block, place, tree, root, n, signature, members = rows
            prints = np.frombuffer(b"".join(signature), np.uint8).reshape(-1, HASHES)
            starts = np.take_along_axis(prints, _ORDER_TABLE[tree, :LEAST_DEPTH], axis=1)
            pairs = []
            for step in range(1, near + 1):
                at = np.arange(max(0, old - step), len(block) - step)
                at = at[(block[at] == block[at + step]) & (place[at + step] - place[at] <= near) & (tree[at] == tree[at + step]) & (root[at] != root[at + step])]
                at = at[_alike(n, at, step, percent) & (starts[at] == starts[at + step]).all(axis=1)]
                agree = (prints[at] == prints[at + step]).sum(axis=1)
                pairs += [(-g, a, a + step) for g, a in zip(agree.tolist(), at.tolist(), strict=True) if g >= agreement]
            out = []
            for _, a, b in sorted(pairs):  # the most similar first, so that fewer have to be looked at
                x, y = int(root[a]), int(root[b])
                if top.of(x) != top.of(y) and _linked(np.frombuffer(members[a], np.uint64), np.frombuffer(members[b], np.uint64), percent):
                    top.join(x, y)
                    out.append((x, y))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int64()) for i in range(2)], ["a", "b"])
            rows = [column[max(0, len(block) - near) :] for column in rows]

    full = found.join(nodes.select("node", F.col("n_shingles").alias("n"), "signature"), "node").join(sets, "node")
    size = found.join(nodes, "node").agg(F.count("*"), F.sum("n_shingles")).first()
    parts = max(1, -(-size[0] // 20_000), (size[1] or 0) >> 20, min(nodes.sparkSession.sparkContext.defaultParallelism, size[0] // 500))
    dealt = full.select("block", "place", "tree", "root", "n", "signature", "members").repartition(parts, "block").sortWithinPartitions("block", "place")
    return dealt.mapInArrow(work, "a long, b long")


class _Tops:
    """Which roots are joined so far."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def of(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = x = self.up.get(y, y)
        return x

    def join(self, x: int, y: int) -> None:
        self.up[self.of(x)] = self.of(y)


def _with_last(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, bool]]:
    held = None
    for batch in batches:
        if len(batch):
            if held is not None:
                yield held, False
            held = batch
    if held is not None:
        yield held, True


def _compare(rows, start, end, near, agreement, percent) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(place, place, agreeing bytes) of rows start..end with neighbours of another root after them."""
    tree, key, node, n, root = rows
    at, common = np.arange(start, end), None
    for step in range(1, near + 1):
        at = at[at + step < len(node)]
        link = _common_prefix(tree, key, at + step - 1)
        common = link if common is None else np.minimum(common[: len(at)], link)
        at, common = at[common >= LEAST_DEPTH], common[common >= LEAST_DEPTH]
        if not len(at):
            return
        some = at[_alike(n, at, step, percent) & (root[at] != root[at + step])]
        agree = (key[some] == key[some + step]).sum(axis=1)
        close = agree >= agreement
        if close.any():
            yield some[close], some[close] + step, agree[close]


def _alike(n, at, step, percent) -> np.ndarray:
    """Whether the sizes of two sets allow the similarity."""
    return 100 * np.minimum(n[at], n[at + step]) >= percent * np.maximum(n[at], n[at + step])


def _common_prefix(tree, key, rows) -> np.ndarray:
    """The bytes that rows and the rows after them have in common from the start; none across trees."""
    differ = key[rows] != key[rows + 1]
    length = np.where(differ.any(axis=1), differ.argmax(axis=1), HASHES)
    return np.where(tree[rows] == tree[rows + 1], length, 0)


def _crowded(rows, first, last, near) -> Iterator[pa.RecordBatch]:
    """Rows in runs of one full prefix of more than ``near`` rows that hold several roots, as far as these rows tell.

    Runs at the ends of what is seen here may go on elsewhere, and stay whatever their length and roots.
    """
    tree, key, node, _, root = rows
    run = np.concatenate(([0], np.cumsum(_common_prefix(tree, key, np.arange(len(node) - 1)) < FULL)))
    starts = np.flatnonzero(np.concatenate(([True], np.diff(run) > 0)))
    sizes = np.diff(np.append(starts, len(run)))
    chosen = (sizes > near) & (np.minimum.reduceat(root, starts) != np.maximum.reduceat(root, starts))
    for end, open_ in ((0, first), (-1, last)):
        chosen[end] |= open_ or sizes[end] > near
    some = np.flatnonzero(chosen[run])
    region = [bytes([t]) + k.tobytes() for t, k in zip(tree[some].tolist(), key[some, :FULL], strict=True)]
    none = [pa.nulls(len(some), kind) for kind in (pa.int64(), pa.int32(), pa.int32())]
    yield pa.RecordBatch.from_arrays([*none, pa.array(node[some]), pa.array(root[some]), pa.array(region, pa.binary())], ["block", "place", "tree", "node", "root", "region"])


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    common = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = batch.column(2), batch.column(3)
            good = [_linked(np.frombuffer(one[i].as_buffer(), np.uint64), np.frombuffer(two[i].as_buffer(), np.uint64), percent) for i in range(len(batch))]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("members").alias("one")), "a")
    both = left.join(sets.select(F.col("node").alias("b"), F.col("members").alias("two")), "b")
    return both.select("a", "b", "one", "two").mapInArrow(work, "a long, b long")


def across(region_rows: DataFrame, sets: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of roots inside crowded regions: the nodes outside the largest component against all, in blocks.

    ``region_rows`` has (region, node, root). A task holds one block of nodes and streams the others past it.
    """
    agreement = least_agreement(percent)
    sizes = region_rows.groupBy("region", "root").agg(F.count("*").alias("size"))
    main = sizes.groupBy("region").agg(F.max_by("root", F.struct("size", "root")).alias("main"), F.sum("size").alias("total"), F.max("size").alias("most"))
    main = main.withColumn("loose_blocks", F.ceil((F.col("total") - F.col("most")) / BLOCK)).withColumn("all_blocks", F.ceil(F.col("total") / (16 * BLOCK)))
    rows = region_rows.join(main, "region").join(sets, "node").join(nodes.select("node", "signature"), "node")
    block = lambda n: F.pmod(F.xxhash64("node"), F.col(n))
    columns = ["node", "root", "members", "signature"]
    held = rows.where("root <> main").select("region", block("loose_blocks").alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("all_blocks") - 1)).alias("other"), F.lit(0).alias("side"), *columns)
    passing = rows.select("region", F.explode(F.sequence(F.lit(0).cast("long"), F.col("loose_blocks") - 1)).alias("own"), block("all_blocks").alias("other"), F.lit(1).alias("side"), *columns)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own, prints, top, out = None, [], None, _Tops(), []

        for batch in batches:
            for region, mine, other, side, node, root, members, signature in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (region, mine, other) != now:
                    now, own, prints, top = (region, mine, other), [], None, _Tops()
                values, mark = np.frombuffer(members, np.uint64), np.frombuffer(signature, np.uint8)
                if side == 0:
                    own.append((node, root, values, mark))
                    continue
                if prints is None:
                    prints = np.array([o[3] for o in own], np.uint8).reshape(-1, HASHES)
                for k in np.flatnonzero((prints == mark).sum(axis=1) >= agreement).tolist():
                    if top.of(own[k][1]) != top.of(root) and _linked(own[k][2], values, percent):
                        top.join(own[k][1], root)
                        out.append((own[k][1], root))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int64()) for i in range(2)], ["a", "b"])
            out = []

    keys = ["region", "own", "other"]
    return held.unionByName(passing).repartition(*keys).sortWithinPartitions(*keys, "side").mapInArrow(work, "a long, b long")


def links(docs: DataFrame, nodes: DataFrame, doc: str, text: str, shingle: int, percent: int, near: int) -> DataFrame:
    """(node, root): the component of each node that has a link."""
    total = nodes.count()
    first, _ = write(nearest(nodes.withColumn("root", F.col("node")), near, percent), "nearest", total)
    # every node that has a candidate at all is in these pairs
    some = first.select(F.col("a").alias("node")).union(first.select("b")).distinct()
    sets, _ = write(sets_of(docs, nodes.join(some, "node", "left_semi"), doc, text, shingle), "sets")
    known, _ = write(confirmed(first, sets, percent), "links")
    rooted, _ = write(components(known), "components", total)

    labelled = nodes.join(rooted, "node", "left").withColumn("root", F.coalesce("root", "node"))
    found, _ = write(between(labelled, near, percent), "between")
    blocks = found.where("block is not null").drop("region")
    sets = _with_lone(docs, nodes, blocks, sets, doc, text, shingle)
    # from here on links are between roots, so that a crowd counts once
    more, _ = write(joined_in_blocks(blocks, nodes, sets, near, percent), "links")
    crowds = found.where("region is not null").select("region", "node", "root").distinct()
    rooted = labelled.select("node", "root")
    if not more.isEmpty():
        joined = components(more)
        crowds, rooted = _again(crowds, joined), _again(rooted, joined)
    several = crowds.groupBy("region").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("n")).where((F.col("x") < F.col("y")) & (F.col("n") > near + 1))
    rows, _ = write(crowds.join(several.select("region"), "region", "left_semi"), "mixed-regions", found.count())
    if not rows.isEmpty():
        sets = _with_lone(docs, nodes, rows, sets, doc, text, shingle)
        last, _ = write(across(rows, sets, nodes, percent), "links")
        if not last.isEmpty():
            rooted = _again(rooted, components(last))
    return rooted


def _with_lone(docs: DataFrame, nodes: DataFrame, rows: DataFrame, sets: DataFrame, doc: str, text: str, shingle: int) -> DataFrame:
    """``sets``, and those of nodes in ``rows`` that are not among them: without a candidate when the first ones were read."""
    lone = nodes.join(rows.select("node").distinct(), "node", "left_semi").join(sets, "node", "left_anti")
    return sets if lone.isEmpty() else sets.union(write(sets_of(docs, lone, doc, text, shingle), "sets")[0])


def _again(rows: DataFrame, joined: DataFrame) -> DataFrame:
    """``rows`` with roots replaced by the root of what they are joined with."""
    to = joined.select(F.col("node").alias("root"), F.col("root").alias("_to"))
    return rows.join(to, "root", "left").withColumn("root", F.coalesce("_to", "root")).drop("_to")


def near_duplicates(docs: DataFrame, doc: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT, near: int = NEAR) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): one row per row of ``docs``."""
    rows, _ = write(marked(docs, doc, text, shingle), "marked")
    keys = ["n_shingles", "hi", "lo"]
    nodes = rows.where("n_shingles > 0").groupBy(*keys).agg(F.min("doc_id").alias("first_id"), F.first("signature").alias("signature"))
    nodes, _ = write(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes", rows.count())
    rooted = links(docs, nodes, doc, text, shingle, percent, near)
    named = nodes.join(rooted, "node", "left").withColumn("root", F.coalesce("root", "node")).select(*keys, "root", "first_id")
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named, _ = write(named.join(least, "root").select(*keys, "component_id"), "named", rows.count())
    found = rows.drop("signature").join(named, keys, "left")
    return found.select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
