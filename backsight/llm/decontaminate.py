"""Benchmark decontamination: one Aho-Corasick automaton over the normalised windows of all test items.

Normalising lower-cases A-Z and makes every other ASCII character that is not a letter or digit a space; what is left
are words, joined by single spaces. Items are cut into windows of ``window`` words (a shorter item is one window). The
windows of all items form one automaton, and each text is scanned once, whatever the number of windows. Matches are
mapped back to words, and through the bytes of the normalised text to character offsets of the original.

Cases: a null or empty text has no words; items with a null id or no words are ignored; repeated items and repeated
documents give what each row gives; an empty benchmark hits nothing. Other columns of the inputs are ignored by
``scan`` and kept by ``without_contaminated``, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The word characters of the contract in bytes; bytes from 0x80 on belong to characters beyond ASCII.
NORMAL = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)
WINDOW = 13
SPAN = "struct<start:int,end:int,item_ids:array<string>>"


def windows_of(benchmark: DataFrame, window: int = WINDOW, item: str = "item_id", text: str = "text") -> DataFrame:
    """The distinct windows (normalised, words joined by one space) and the sorted ids of the items that hold them."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = [], []
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                words = (value or b"").translate(NORMAL).split()
                if key is not None and words:
                    made = {b" ".join(words[i : i + window]) for i in range(max(1, len(words) - window + 1))}
                    ids += [key] * len(made)
                    found += made
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(found, pa.binary())], ["item", "words"])

    cuts = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).cast("string").alias("text"))
    return cuts.mapInArrow(cut, "item string, words binary").groupBy("words").agg(F.sort_array(F.collect_set("item")).alias("items"))


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    share: int = 20,
    doc: str = "doc_id",
    text: str = "text",
    most_bytes: int = 32 << 20,
) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans: one row per row of ``docs``.

    ``contaminated``: n_hit > 0 and ``share`` * n_hit >= n_words. ``spans``: the maximal runs of hit words as character
    offsets [start, end) of the original text, with the items whose windows lie in them. The windows are broadcast in
    shares of at most about ``most_bytes``; with more windows the texts are scanned once per share, and no row is shuffled.
    """
    rows = docs.select(F.col(doc).alias("doc_id"), F.col(text).cast("string").alias("text"), F.lit(None).cast("array<struct<first:int,last:int,items:array<string>>>").alias("hits"))
    kind = dict(rows.dtypes)["doc_id"]
    return _scanned(
        rows,
        _shares(windows_of(benchmark, window), most_bytes),
        _summary(share),
        f"doc_id {kind}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, spans array<{SPAN}>",
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20, text: str = "text", most_bytes: int = 32 << 20) -> DataFrame:
    """The rows of ``docs``, all columns, that are not contaminated."""
    whole = docs.select(F.struct("*").alias("row"), F.col(text).cast("string").alias("text"), F.lit(None).cast("array<struct<first:int,last:int,items:array<string>>>").alias("hits"))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bad = [f[2] > 0 and share * f[2] >= f[1] for f in (_facts(*x) for x in _texts_and_hits(batch))]
            yield batch.select(["row"]).filter(pa.array([not x for x in bad], pa.bool_()))

    return _scanned(whole, _shares(windows_of(benchmark, window), most_bytes), clean, whole.select("row").schema).select("row.*")


def _scanned(rows: DataFrame, shares: Iterator[list[tuple[bytes, list[str]]]], then, schema) -> DataFrame:
    """The rows scanned once per share, then through ``then`` in the worker of the last scan: a second one would stay."""
    *scans, last = [_scanner(patterns) for patterns in shares] or [iter]
    for each in scans:
        rows = rows.mapInArrow(each, rows.schema)
    return rows.mapInArrow(lambda batches: then(last(batches)), schema)


def _shares(windows: DataFrame, most_bytes: int) -> Iterator[list[tuple[bytes, list[str]]]]:
    """All windows in lists whose texts and ids take about ``most_bytes`` at most: the proven bound of the broadcast."""
    size = F.length("words") + F.aggregate("items", F.lit(0), lambda n, x: n + F.length(x) + 8)
    total = windows.agg(F.sum(size)).first()[0] or 0
    count = -(-total // most_bytes)
    for share in range(count):
        part = windows if count == 1 else windows.where(F.pmod(F.xxhash64("words"), F.lit(count)) == share)
        if found := [(bytes(r[0]), list(r[1])) for r in part.collect()]:
            yield found


_AUTOMATA: dict[int, ahocorasick.Automaton] = {}


def _automaton(number: int, patterns: list[tuple[bytes, list[str]]]) -> ahocorasick.Automaton:
    """Built once per worker. Latin-1 maps bytes to characters one to one, so matches are matches of bytes."""
    if number not in _AUTOMATA:
        found = ahocorasick.Automaton()
        for words, items in patterns:
            found.add_word(f" {words.decode('latin-1')} ", (len(words), items))
        found.make_automaton()
        _AUTOMATA.clear()
        _AUTOMATA[number] = found
    return _AUTOMATA[number]


def _scanner(patterns: list[tuple[bytes, list[str]]]):
    from pyspark import SparkContext

    shared = SparkContext._active_spark_context.broadcast(patterns)
    number = shared._jbroadcast.id()

    def scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(number, shared.value)
        for batch in batches:
            hits = []
            for value, before in _texts_and_hits(batch):
                joined = b" %b " % b" ".join(value.translate(NORMAL).split())
                found = list(automaton.iter(joined.decode("latin-1")))
                if found:
                    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
                    last = np.searchsorted(spaces, [end for end, _ in found]) - 1
                    first = np.searchsorted(spaces, [end - size - 1 for end, (size, _) in found])
                    before = [*before, *({"first": int(a), "last": int(b), "items": items} for a, b, (_, (_, items)) in zip(first, last, found, strict=True))]
                hits.append(before or None)
            at = batch.schema.get_field_index("hits")
            yield batch.set_column(at, batch.schema.field(at), pa.array(hits, batch.schema.field(at).type))

    return scan_batches


def _texts_and_hits(batch: pa.RecordBatch) -> Iterator[tuple[bytes, list[dict]]]:
    hits = batch.column(batch.schema.get_field_index("hits"))
    hits = [None] * len(batch) if hits.null_count == len(batch) else hits.to_pylist()
    for value, found in zip(batch.column(batch.schema.get_field_index("text")).cast(pa.binary()).to_pylist(), hits, strict=True):
        yield value or b"", found or []


def _facts(value: bytes, hits: list[dict]) -> tuple[bytes, int, int, np.ndarray | None]:
    """The normalised text, its words, its hit words, and which words are hit."""
    plain = value.translate(NORMAL)
    words = len(plain.split())
    if not hits:
        return plain, words, 0, None
    steps = np.zeros(words + 1, np.int64)
    np.add.at(steps, [h["first"] for h in hits], 1)
    np.add.at(steps, [h["last"] + 1 for h in hits], -1)
    hit = np.cumsum(steps[:-1]) > 0
    return plain, words, int(hit.sum()), hit


def _spans(value: bytes, plain: bytes, hits: list[dict], hit: np.ndarray) -> list[dict]:
    dark = np.zeros(len(plain) + 2, np.int8)
    dark[1:-1] = np.frombuffer(plain, np.uint8) != 32
    edges = np.diff(dark)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    chars = np.concatenate(([0], np.cumsum((np.frombuffer(value, np.uint8) & 0xC0) != 0x80)))
    runs = np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))
    first, last = np.flatnonzero(runs == 1), np.flatnonzero(runs == -1) - 1
    items: list[set] = [set() for _ in first]
    for h in hits:
        items[int(np.searchsorted(first, h["first"], "right")) - 1].update(h["items"])
    return [
        {"start": int(chars[starts[a]]), "end": int(chars[ends[b]]), "item_ids": sorted(found)}
        for a, b, found in zip(first, last, items, strict=True)
    ]


def _summary(share: int):
    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for value, hits in _texts_and_hits(batch):
                plain, words, n_hit, hit = _facts(value, hits)
                items = sorted({i for h in hits for i in h["items"]})
                row = (words, n_hit, len(items), hashlib.sha256(",".join(items).encode()).hexdigest(), n_hit > 0 and share * n_hit >= words, _spans(value, plain, hits, hit) if hits else [])
                for column, x in zip(out, row, strict=True):
                    column.append(x)
            span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("item_ids", pa.list_(pa.string()))]))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), span]
            names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))], names)

    return summarise
