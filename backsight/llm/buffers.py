"""The texts of an Arrow batch as one byte array: words and hashes of words without a Python object per word.

Hashes are polynomials modulo 2**64 over mixed byte codes: prefix sums make the hash of any word, and of any run of
words, a subtraction and a product. They serve filters, sketches and feature spaces; where equality has to be exact
the callers use 128-bit digests or the bytes themselves.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Arrow keeps what its own pool once took; the system's allocator can give it back.
pa.set_memory_pool(pa.system_memory_pool())

CHUNK_BYTES = 1 << 19
#: Powers that a worker keeps; longer texts make their own and drop them.
KEPT_POWERS = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: list[np.ndarray] = []


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return values ^ (values >> np.uint64(31))


BYTE_CODES = mixed((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(_BASE))
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _POWERS and len(_POWERS[0]) >= n:
        return _POWERS[0], _POWERS[1]
    made = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        column = np.full(-(-n >> 16) << 16, base, np.uint64)
        column[0] = 1
        made.append(np.multiply.accumulate(column))
    if len(made[0]) <= KEPT_POWERS:
        _POWERS[:] = made
    return made[0], made[1]


def run_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of each run ``codes[starts[i]:ends[i]]``; equal runs have equal hashes wherever they stand."""
    up, down = _powers(len(codes) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * up[: len(codes)], out=sums[1:])
        return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def give_back() -> None:
    """Free memory goes back to the system: workers outlive a task, and the next stage may need the room elsewhere."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not the GNU library
        return


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column, nulls as empty texts, and the offsets of its rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole rows of about ``size`` bytes; a longer text is a range of its own. Then free memory goes back."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield first, last
        first = last
    give_back()


def words_of(data: np.ndarray, offsets: np.ndarray, white: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes with a space after each text, word starts, word ends, first word of each row and the total)."""
    padded = np.insert(data, offsets[1:], 32)
    dark = np.zeros(len(padded) + 2, np.int8)
    dark[1:-1] = ~white[padded]
    edges = np.diff(dark)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    return padded, starts, ends, np.searchsorted(starts, offsets + np.arange(len(offsets)))
