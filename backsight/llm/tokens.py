"""Token ids in binary files: independent zstandard frames with a trailing seek table and a checksum for each frame.

A file is (1) frames of ``FRAME`` ids each (the last is shorter), 32-bit little-endian, each compressed on its own;
(2) a skippable frame with the directory: how many documents, their ids and numbers of tokens; (3) a skippable frame
with the seek table of the seekable zstandard format: compressed size, decompressed size and the lower half of XXH64
for every frame, then the footer. A reader finds a document's ids by the directory's running sum and decompresses the
frames that hold them. Plain zstandard readers see one stream of ids.

Cases: a null or empty text is the end id alone; documents are in ascending id order, null ids first, rows with one id
by their text; an empty table makes no files; other columns are ignored.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from backsight.llm import files
from backsight.llm.components import write

FRAME = 1 << 18
END = 2
#: Fixed values of the seekable format: the skippable frames' magic numbers and the footer's.
SEEK_MAGIC, DIRECTORY_MAGIC, FOOTER_MAGIC, CHECKSUMS = 0x184D2A5E, 0x184D2A50, 0x8F92EAB1, 0x80
_NULL = -(1 << 63)


class Encoder:
    """Encodes whole texts; where the tokenizer's rules allow it, what stands between single spaces is encoded once.

    A byte-level tokenizer without normaliser starts a new word at each space that is not inside a run of white space.
    Texts with other white space around a space, or with the text of a special token, are encoded in one piece.
    """

    def __init__(self, path: str, most_known: int = 1_200_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.most_known = Tokenizer.from_file(path), most_known
        with open(path, encoding="utf-8") as f:
            rules = json.load(f)
        before = rules.get("pre_tokenizer") or {}
        self.by_space = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") and not rules.get("normalizer")
        self.special = [t["content"] for t in rules.get("added_tokens", [])]
        self.before_space = [f"{c} " for c in map(chr, range(0x3001)) if c.isspace()]
        self.first: dict[str, bytes] = {}
        self.rest: dict[str, bytes] = {}
        # A byte-level token has one character for each byte.
        self.width = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.width[i] = len(token)

    def _in_one_piece(self, text: str) -> bool:
        if any(x in text for x in self.special):
            return True
        # Plain searches first: a space after white space is rare.
        return (text.startswith(" ") or any(x in text for x in self.before_space)) and bool(re.search(r"(?:\s|^) (?:\s|$)", text))

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _ids_after_spaces(self, parts: list[str]) -> list[bytes]:
        """Each part's ids after a space: many are encoded in one text and told apart by the bytes of their tokens."""
        out: list[bytes] = []
        for a in range(0, len(parts), 2000):
            some = parts[a : a + 2000]
            # Parts that begin or end with white space could join their neighbours.
            alone = [x for x in some if not x or x[0].isspace() or x[-1].isspace()]
            known = dict(zip(alone, self._ids([f" {x}" for x in alone]), strict=True))
            joined = [x for x in some if x not in known]
            raw = self._ids(["".join(f" {x}" for x in joined)])[0]
            ends = np.cumsum(self.width[np.frombuffer(raw, "<u4")])
            stops = np.searchsorted(ends, np.cumsum([len(x.encode()) + 1 for x in joined])) + 1
            edges = [0, *(4 * stops).tolist()]
            known.update(zip(joined, (raw[p:q] for p, q in zip(edges[:-1], edges[1:], strict=True)), strict=True))
            out += [known[x] for x in some]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as 32-bit little-endian numbers."""
        if len(self.rest) + len(self.first) > self.most_known:
            self.first, self.rest = {}, {}
        pieces = [x.split(" ") if self.by_space and not self._in_one_piece(x) else None for x in texts]
        found: list[tuple[list, list]] = []  # ids of the words so far, and which words are new
        new_first, new = {}, {}
        for p in pieces:
            if p is None:
                found.append(([], []))
                continue
            ids = list(map(self.rest.get, p))
            ids[0] = self.first.get(p[0])
            missing = [k for k, x in enumerate(ids) if x is None]
            for k in missing:
                (new if k else new_first)[p[k]] = None
            found.append((ids, missing))
        self.first.update(zip(new_first, self._ids(list(new_first)), strict=True))
        self.rest.update(zip(new, self._ids_after_spaces(list(new)), strict=True))
        whole = iter(self._ids([x for x, p in zip(texts, pieces, strict=True) if p is None]))
        out = []
        for p, (ids, missing) in zip(pieces, found, strict=True):
            if p is None:
                out.append(next(whole))
                continue
            for k in missing:  # only these are looked up again
                ids[k] = self.rest[p[k]] if k else self.first[p[0]]
            out.append(b"".join(ids))
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for all tasks of a worker, so that what it knows serves them all."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class FileWriter:
    def __init__(self, address: str):
        self.out, self.open = files.writer(address), bytearray()
        self.frames: list[tuple[int, int, int]] = []
        self.keys: list[int] = []
        self.sizes: list[int] = []
        self.compressor = zstandard.ZstdCompressor(level=3)

    def add(self, key: int | None, ids: bytes) -> None:
        self.keys.append(_NULL if key is None else key)
        self.sizes.append(len(ids) // 4)
        self.open += ids
        while len(self.open) >= 4 * FRAME:
            self._frame(bytes(self.open[: 4 * FRAME]))
            del self.open[: 4 * FRAME]

    def _frame(self, data: bytes) -> None:
        packed = self.compressor.compress(data)
        self.out.write(packed)
        self.frames.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))

    def close(self) -> None:
        if self.open:
            self._frame(bytes(self.open))
        directory = struct.pack("<Q", len(self.keys)) + np.array(self.keys, "<i8").tobytes() + np.array(self.sizes, "<u8").tobytes()
        directory = self.compressor.compress(directory)
        self.out.write(struct.pack("<II", DIRECTORY_MAGIC, len(directory)) + directory)
        table = np.array(self.frames, "<u4").tobytes() + struct.pack("<IBI", len(self.frames), CHECKSUMS, FOOTER_MAGIC)
        self.out.write(struct.pack("<II", SEEK_MAGIC, len(table)) + table)
        self.out.close()


class FileReader:
    def __init__(self, address: str):
        self.file = files.reader(address)
        size = self.file.size()
        count, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != FOOTER_MAGIC or not flags & CHECKSUMS:
            raise ValueError(f"no seek table: {address}")
        table = size - 9 - 12 * count
        if struct.unpack("<II", self._at(table - 8, 8)) != (SEEK_MAGIC, 12 * count + 9):
            raise ValueError(f"broken seek table: {address}")
        self.frames = np.frombuffer(self._at(table, 12 * count), "<u4").reshape(-1, 3)
        self.offsets = np.concatenate(([0], np.cumsum(self.frames[:, 0], dtype=np.int64)))
        magic, length = struct.unpack("<II", self._at(int(self.offsets[-1]), 8))
        if magic != DIRECTORY_MAGIC:
            raise ValueError(f"no directory: {address}")
        directory = zstandard.ZstdDecompressor().decompress(self._at(int(self.offsets[-1]) + 8, length))
        (documents,) = struct.unpack_from("<Q", directory)
        keys = np.frombuffer(directory, "<i8", documents, 8)
        self.keys = [None if k == _NULL else int(k) for k in keys]
        self.sizes = np.frombuffer(directory, "<u8", documents, 8 + 8 * documents).astype(np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)))
        self.kept: tuple[int, bytes] = (-1, b"")

    def _at(self, offset: int, size: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(size)

    def frame(self, number: int) -> bytes:
        if self.kept[0] != number:
            packed, size, checksum = map(int, self.frames[number])
            data = zstandard.ZstdDecompressor().decompress(self._at(int(self.offsets[number]), packed), max_output_size=size)
            if len(data) != size or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != checksum:
                raise ValueError(f"frame {number} is damaged")
            self.kept = (number, data)
        return self.kept[1]

    def ids(self, document: int) -> bytes:
        """The ids of the n-th document; only the frames that hold them are decompressed."""
        a, b = 4 * int(self.starts[document]), 4 * int(self.starts[document + 1])
        out = [self.frame(n)[max(a - 4 * FRAME * n, 0) : b - 4 * FRAME * n] for n in range(a // (4 * FRAME), -(-b // (4 * FRAME)))]
        return b"".join(out)


def write_ids(docs: DataFrame, tokenizer: str, end: int = END, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Encodes and writes; (part, file, n_docs, n_tokens) of each file, in the order of the documents."""
    spark = docs.sparkSession
    folder = files.new_folder(spark, "token-files")
    rows = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    last = np.array([end], "<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        out = address = None
        for batch in batches:
            if not len(batch):
                continue
            if out is None:
                address = files.new_file(folder, ".ids.zst")
                out = FileWriter(address)
            for a in range(0, len(batch), 256):
                part = batch.slice(a, 256)
                for key, ids in zip(part.column(0).to_pylist(), encoder(tokenizer).encode([x or "" for x in part.column(1).to_pylist()]), strict=True):
                    out.add(key, ids + last)
        if out is not None:
            out.close()
            row = ([TaskContext.get().partitionId()], [address], [len(out.keys)], [sum(out.sizes)])
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, (pa.int64(), pa.string(), pa.int64(), pa.int64()), strict=True)], ["part", "file", "n_docs", "n_tokens"])

    written, _ = write(rows.mapInArrow(work, "part long, file string, n_docs long, n_tokens long"), "token-file-list")
    return written


def read_ids(written: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids): all documents of the files; ``start`` counts the ids of all documents before."""
    # One row per file: the running sum is over as many rows as there are files.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    listed = written.select("part", "file", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    count = max(1, written.count())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for address, base in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                found = FileReader(address)
                for a in range(0, len(found.keys), 512):
                    b = min(a + 512, len(found.keys))
                    columns = [
                        pa.array(found.keys[a:b], pa.int64()),
                        pa.array(base + found.starts[a:b]),
                        pa.array(found.sizes[a:b]),
                        pa.array([found.ids(k) for k in range(a, b)], pa.binary()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids"])

    listed = listed.repartitionByRange(count, "part")
    return listed.mapInArrow(work, "doc_id long, start long, n_tokens long, ids binary")


def checked(read: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of what ``read_ids`` gives."""
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


