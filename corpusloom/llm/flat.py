"""Text columns as flat byte arrays inside tasks: words, rolling hashes and sliding minima with numpy."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are handled in slices of about so many bytes; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20

#: White space between words: blank and \x09 to \x0D.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: A-Z to a-z, all other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BYTE_CODES = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def give_back() -> None:
    """Return freed memory to the system: a Python worker lives on from stage to stage and keeps what its largest task needed."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and where each begins (one more at the end). Null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    where = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    content = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return content[where[0] : where[-1]], where - where[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of rows with up to ``limit`` bytes of text, at least one row: the rows, their bytes, where each begins."""
    if not batch.num_rows:
        return
    data, where = flat(batch.column(batch.schema.names.index(column)))
    row = 0
    while row < batch.num_rows:
        end = max(row + 1, int(np.searchsorted(where, where[row] + limit, "right")) - 1)
        yield batch.slice(row, end - row), data[where[row] : where[end]], where[row : end + 1] - where[row]
        row = end


def words(data: np.ndarray, where: np.ndarray, between: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every word, and for each text the number of words before it (one more at the end)."""
    inside = ~between[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    borders = np.unique(where[(where > 0) & (where < len(data))])
    first[borders] = inside[borders]
    last[borders - 1] = inside[borders - 1]
    begins, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return begins, ends, np.searchsorted(begins, where)


class _Kept(list):
    """A list that stays where it is: it travels to the tasks without its items."""

    def __reduce__(self):
        return _Kept, ()


_powers: list[np.ndarray] = _Kept()


def powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n``; those of the last call are kept."""
    if _powers and len(_powers[0]) >= n:
        return _powers
    n = 1 << max(16, int(n).bit_length())
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    _powers.clear()
    for base in (_BASE, inverse):
        steps = np.full(n, base, np.uint64)
        steps[:1] = 1
        _powers.append(np.multiply.accumulate(steps))
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer: every bit of the input reaches every bit of the result."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Weighted running sums: the hash of any range follows from two of them."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values))[0][: len(values)], out=sums[1:])
    return sums


def range_hash(sums: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of ranges; equal ranges have equal hashes wherever they stand."""
    back = powers(len(sums))[1]
    return mix((sums[ends] - sums[begins]) * back[begins] + (ends - begins).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def byte_sums(data: np.ndarray) -> np.ndarray:
    return prefix_sums(_BYTE_CODES[data])


def word_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return range_hash(byte_sums(data), begins, ends)


def gram_hashes(values: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of ``n`` values, by its first position; empty if there are fewer."""
    count = max(0, len(values) - n + 1)
    at = np.arange(count)
    return range_hash(prefix_sums(values), at, at + n)


def leftmost_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest of each run of ``width`` values, the first one among equals."""
    count = len(values) - width + 1
    if count <= 0:
        return np.zeros(0, np.int64)
    best, at, span = values, np.arange(len(values), dtype=np.int32), 1
    while span < width:
        step = min(span, width - span)
        later = best[step:] < best[:-step]
        at = np.where(later, at[step:], at[:-step])
        best = np.minimum(best[step:], best[:-step])
        span += step
    return at.astype(np.int64)


def ranges(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions of many ranges, one range after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    starts = np.cumsum(lengths) - lengths
    return np.arange(total) - np.repeat(starts, lengths) + np.repeat(begins, lengths)
