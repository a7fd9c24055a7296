"""Substring dedup: words of long passages that also occur in a document with a smaller id are removed.

A window is ``window`` consecutive words. A word goes if some window that covers it has a word sequence that starts in a
document with a smaller id, too. First pass: a count-min sketch. Each window is represented by the least hash among its
runs of ``run`` words; equal windows have equal representatives, and neighbouring windows mostly share one, so about one
word in fourteen is counted. A task counts, for each of its documents, each representative once, in two rows of cells;
the cells of all tasks are merged by block, and a cell only has to tell 'two or more' apart. Estimates are never too low.
Second pass: windows whose representative is estimated in two documents or more get a 128-bit digest of their words and
are grouped exactly, once within tasks and once by a shuffle of what is left: all but the smallest document of a digest
lose the words that its window covers.

The merged sketch is broadcast: 2 x 2**``most_bits`` bits at most (64 MB for 28). With more text than that serves, more
cells are full and more windows go into the exact pass; the result is the same.

Cases: a null or empty text has no words; a document shorter than a window keeps all; rows with a null id keep all and
remove nothing from others; rows that repeat an id are judged alone, all of them; clashing column names do not matter.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import SparkContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from backsight.llm.buffers import chunks, mixed, run_hashes, text_bytes, words_of
from backsight.llm.components import write

WINDOW, RUN = 50, 25
_BLOCK_BITS = 16
_ROWS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = np.minimum(values[:-step], values[step:])
        done += step
    return values


def _representatives(padded, starts, ends, first, window, run):
    """For each window of a chunk of texts: its text, its first word, and its representative."""
    words = run_hashes(padded, starts, ends)
    at = np.arange(len(words) + 1)
    grams = run_hashes(words, at[: max(0, len(words) - run + 1)], at[run:])
    least = _sliding_least(grams, window - run + 1) if len(grams) > window - run else grams[:0]
    count = np.diff(first)
    row = np.repeat(np.arange(len(count)), np.maximum(count - window + 1, 0))
    begin = np.cumsum(np.maximum(count - window + 1, 0)) - np.maximum(count - window + 1, 0)
    position = first[row] + np.arange(len(row)) - begin[row]
    return row, position, least[position]


def _cells(values: np.ndarray, bits: int) -> list[np.ndarray]:
    with np.errstate(over="ignore"):
        return [mixed(values * odd) >> np.uint64(64 - bits) for odd in _ROWS]


def sketch(docs: DataFrame, bits: int, window: int, run: int, text: str = "text") -> np.ndarray:
    """Merged over all tasks: for both rows of 2**bits cells, whether a cell counts two documents or more, packed."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[list[np.ndarray]] = [[], []]
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            for a, b in chunks(offsets):
                found = words_of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                row, _, least = _representatives(*found, window, run)
                fresh = np.concatenate(([True], (least[1:] != least[:-1]) | (row[1:] != row[:-1])))[: len(row)]
                row, least = row[fresh], least[fresh]
                order = np.lexsort((least, row))
                row, least = row[order], least[order]
                fresh = np.concatenate(([True], (least[1:] != least[:-1]) | (row[1:] != row[:-1])))[: len(row)]
                for part, cells in zip(parts, _cells(least[fresh], bits), strict=True):
                    part.append(cells.astype(np.uint32))
        blocks, once, twice = [], [], []
        for number, part in enumerate(parts):
            cells, counts = np.unique(np.concatenate(part) if part else np.zeros(0, np.uint32), return_counts=True)
            block = cells >> np.uint32(_BLOCK_BITS)
            edges = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1], [True]))) if len(cells) else [0]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                low = (cells[a:b] & np.uint32((1 << _BLOCK_BITS) - 1)).astype(np.uint16)
                blocks.append((number << 32) | int(block[a]))
                once.append(low[counts[a:b] == 1].tobytes())
                twice.append(low[counts[a:b] > 1].tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(once, pa.binary()), pa.array(twice, pa.binary())], ["block", "once", "twice"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by block; a block may go over several batches."""
        current, counts = None, np.zeros(1 << _BLOCK_BITS, np.uint8)
        out: list[tuple[int, bytes]] = []
        for batch in batches:
            for block, once, twice in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if block != current:
                    if current is not None:
                        out.append((current, np.packbits(counts > 1).tobytes()))
                    current, counts[:] = block, 0
                seen = np.frombuffer(once, np.uint16)
                counts[seen] = np.minimum(counts[seen], 1) + 1
                counts[np.frombuffer(twice, np.uint16)] = 2
        if current is not None:
            out.append((current, np.packbits(counts > 1).tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.binary())], ["block", "full"])

    counted = docs.select(F.col(text).cast("string")).mapInArrow(count, "block long, once binary, twice binary")
    merged = counted.repartition("block").sortWithinPartitions("block").mapInArrow(merge, "block long, full binary")
    merged, _ = write(merged, "sketch")
    full = np.zeros((2, max(1, 1 << bits >> _BLOCK_BITS), (1 << _BLOCK_BITS) // 8), np.uint8)
    for block, packed in merged.toLocalIterator():
        full[block >> 32, block & 0xFFFFFFFF] = np.frombuffer(packed, np.uint8)
    return full.reshape(2, -1)


_FIELDS = "d1 long, d2 long, doc_id long, mark long, at int, done array<int>"


def candidates(docs: DataFrame, full: np.ndarray, bits: int, window: int, run: int, doc: str, text: str, together: int = 1 << 20) -> DataFrame:
    """Windows estimated in two documents or more: the digest of their words, document, first word.

    ``mark`` is the hash of the whole text, which tells rows with the same id apart. A task compares the windows it
    finds, ``together`` at a time: all but those of the smallest document are decided, whatever other tasks hold, so of
    a passage in very many documents a task sends few rows on to the exact pass. What is decided goes as one row a text.
    """
    shared = SparkContext._active_spark_context.broadcast(full)
    rows = docs.where(F.col(doc).isNotNull()).select(F.col(doc).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def resolved(held: list[tuple]) -> pa.RecordBatch:
        d1, d2, ids, marks, at = (np.concatenate([h[k] for h in held]) for k in range(5))
        order = np.lexsort((ids, d1))
        d1, d2, ids, marks, at = d1[order], d2[order], ids[order], marks[order], at[order]
        fresh = np.concatenate(([True], (d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1])))
        least = ids[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
        gone = ids > least
        left = ~gone
        ids_gone, marks_gone, ats = _by_text(ids[gone], marks[gone], at[gone])
        none, zero = pa.nulls(int(left.sum()), pa.list_(pa.int32())), np.zeros(len(ids_gone), np.int64)
        # What is decided needs no company; its text's hash spreads it.
        columns = [
            pa.array(np.concatenate((d1[left], mixed(marks_gone.view(np.uint64)).view(np.int64)))),
            pa.array(np.concatenate((d2[left], zero))),
            pa.array(np.concatenate((ids[left], ids_gone))),
            pa.array(np.concatenate((marks[left], marks_gone))),
            pa.array(np.concatenate((at[left], zero)).astype(np.int32)),
            pa.concat_arrays([none, ats]),
        ]
        return pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in _FIELDS.split(", ")])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            keys = batch.column(0).to_numpy()
            for a, b in chunks(offsets):
                padded, starts, ends, first = words_of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                row, position, least = _representatives(padded, starts, ends, first, window, run)
                fresh = np.concatenate(([True], least[1:] != least[:-1]))[: len(least)]
                tested, which = least[fresh], np.cumsum(fresh) - 1
                hit = np.ones(len(tested), bool)
                for number, cells in enumerate(_cells(tested, bits)):
                    hit &= (shared.value[number][(cells >> np.uint64(3)).astype(np.int64)] >> (7 - (cells & np.uint64(7))).astype(np.uint8)) & 1 > 0
                chosen = np.flatnonzero(hit[which]) if len(which) else which
                if not len(chosen):
                    continue
                digests = _digests(padded, starts, ends, row[chosen], position[chosen], first, window)
                row, at = row[chosen], position[chosen] - first[row[chosen]]
                marks = np.zeros(b - a, np.uint64)
                for k in np.unique(row):
                    marks[k] = xxhash.xxh64_intdigest(data[offsets[a + k] : offsets[a + k + 1]].tobytes(), 42)
                held.append((digests[:, 0], digests[:, 1], keys[a + row], marks[row].view(np.int64), at.astype(np.int32)))
                if sum(len(h[0]) for h in held) >= together:
                    yield resolved(held)
                    held = []
        if held:
            yield resolved(held)

    return rows.mapInArrow(find, _FIELDS)


def _by_text(ids: np.ndarray, marks: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Ids, marks and lists of positions, one of each for every text."""
    order = np.lexsort((at, marks, ids))
    ids, marks, at = ids[order], marks[order], at[order]
    first = np.flatnonzero(np.concatenate(([True], (ids[1:] != ids[:-1]) | (marks[1:] != marks[:-1])))[: len(ids)])
    edges = np.concatenate((first, [len(ids)])).astype(np.int32)
    return ids[first], marks[first], pa.ListArray.from_arrays(pa.array(edges), pa.array(at.astype(np.int32)))


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, mark, at) of the windows that go. Rows are sorted by digest and document: a digest's first row has its smallest document."""
    last = (None, None, None)
    for batch in batches:
        decided = batch.column(5).is_valid()
        lists = batch.filter(decided)
        at = lists.column(5)
        size = at.value_lengths().to_numpy()
        parts = [[np.repeat(lists.column(k).to_numpy(), size) for k in (2, 3)] + [at.flatten().to_numpy()]]
        batch = batch.filter(pc.invert(decided))
        if len(batch):
            d1, d2, ids, marks, at = (batch.column(k).to_numpy() for k in range(5))
            fresh = np.concatenate(([(d1[0], d2[0]) != last[:2]], (d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1])))
            least = np.concatenate(([ids[0] if last[2] is None else last[2]], ids[fresh]))[np.cumsum(fresh)]
            last = (d1[-1], d2[-1], least[-1])
            gone = ids > least
            parts.append([ids[gone], marks[gone], at[gone]])
        columns = [np.concatenate([p[k] for p in parts]) for k in range(3)]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0]), pa.array(columns[1]), pa.array(columns[2].astype(np.int32))], ["doc_id", "mark", "at"])


def _digests(padded, starts, ends, row, position, first, window) -> np.ndarray:
    """XXH3-128 of the words of each chosen window, joined by one space."""
    out = []
    edges = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1], [True])))
    raw = padded.tobytes()
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        low, high = int(first[row[a]]), int(first[row[a] + 1])
        joined = b" ".join(raw[starts[low] : ends[high - 1]].split())
        stop = np.cumsum(ends[low:high] - starts[low:high] + 1) - 1
        begin = (stop - (ends[low:high] - starts[low:high])).tolist()
        stop, chosen, digest = stop.tolist(), (position[a:b] - low).tolist(), xxhash.xxh3_128_digest
        out.append(b"".join([digest(joined[begin[i] : stop[i + window - 1]]) for i in chosen]))
    return np.frombuffer(b"".join(out), np.int64).reshape(-1, 2)


def repeated(docs: DataFrame, window: int = WINDOW, run: int = RUN, doc: str = "doc_id", text: str = "text", most_bits: int = 28) -> DataFrame:
    """(doc_id, mark, ats): the first words of each text's windows that also start in a document with a smaller id."""
    size = docs.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0
    bits = min(most_bits, max(_BLOCK_BITS, math.ceil(math.log2(size / 20 + 1))))
    full = sketch(docs, bits, window, run, text)
    found = candidates(docs, full, bits, window, run, doc, text)
    found = found.repartition("d1", "d2").sortWithinPartitions("d1", "d2", "doc_id")
    found = found.mapInArrow(_judge, "doc_id long, mark long, at int")
    return found.groupBy("doc_id", "mark").agg(F.collect_list("at").alias("ats"))


def _kept_words(words: list[bytes], ats: list[int] | None, window: int) -> list[bytes]:
    if not ats:
        return words
    steps = np.zeros(len(words) + 1 + window, np.int64)
    np.add.at(steps, ats, 1)
    np.add.at(steps, np.asarray(ats) + window, -1)
    gone = np.cumsum(steps)
    return [w for w, g in zip(words, gone.tolist(), strict=False) if not g]


def without_repeats(docs: DataFrame, window: int = WINDOW, run: int = RUN, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns; texts that lose words become their kept words, joined by one space."""
    found = deduplicate(docs, window, run, doc, text)
    whole = [F.coalesce("kept", F.col("row")[c]).alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns]
    return found.select(*whole)


def deduplicate(docs: DataFrame, window: int = WINDOW, run: int = RUN, doc: str = "doc_id", text: str = "text", most_bits: int = 28) -> DataFrame:
    """The rows of ``docs`` as ``row``, and kept (the kept words by one space, null where all are kept), n_words, n_removed, kept_sha256."""
    marks = repeated(docs, window, run, doc, text, most_bits)
    rows = docs.select(F.struct("*").alias("row"), F.col(doc).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = rows.withColumn("mark", F.xxhash64("text")).join(marks, ["doc_id", "mark"], "left").select("row", "text", "ats")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for value, ats in zip(batch.column(1).cast(pa.binary()), batch.column(2).to_pylist(), strict=True):
                words = (value.as_py() or b"").split()
                kept = _kept_words(words, ats, window)
                joined = b" ".join(kept)
                facts = (joined.decode() if len(kept) < len(words) else None, len(words), len(words) - len(kept), hashlib.sha256(joined).hexdigest())
                for column, x in zip(out, facts, strict=True):
                    column.append(x)
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))], ["row", "kept", "n_words", "n_removed", "kept_sha256"])

    schema = rows.select("row").schema
    for name, kind in (("kept", "string"), ("n_words", "long"), ("n_removed", "long"), ("kept_sha256", "string")):
        schema = schema.add(name, kind)
    return rows.mapInArrow(cut, schema)
