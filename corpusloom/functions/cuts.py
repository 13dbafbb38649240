"""Chunks of many texts at once, as arrays: where a chunk begins depends on the kinds of a few neighbours only.

It is shipped with the functions that call it, like the other loops of the workers.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

from corpusloom.functions.tasks import Remembered, merge_by_rank

# Kinds of characters, as numbers; the white ones come last. END stands after every text.
END, LETTER, NUMBER, OTHER, SPACE, BLANK, BREAK = range(7)
APOSTROPHE, LONG_S = 0x27, 0x17F
# Characters that are looked at together; longer texts are cut before a space that follows no white space.
BLOCK = 1 << 20
SAFE = r"\S "
# Rows that are returned together.
ROWS = 1 << 10
# Stands after each chunk while symbols are merged; rules use lower numbers only.
BETWEEN = 0xFFFD
# Each of so few rules is one pass over the symbols; with more, chunks are merged one at a time and remembered.
PASSES = 64


def kind_numbers(kinds: bytes) -> np.ndarray:
    """The kind of every code point, from the compressed string of kinds."""
    numbers = np.full(LONG_S + 1, OTHER, np.uint8)
    numbers[[*range(65, 91), *range(97, 123), LONG_S]] = LETTER
    for chars, number in (("0", NUMBER), (" ", SPACE), ("\t", BLANK), ("\r\n", BREAK)):
        numbers[[ord(char) for char in chars]] = number
    return numbers[np.frombuffer(zlib.decompress(kinds).decode().encode("utf-32-le"), "<u4")]


def chunk_starts(points: np.ndarray, kind: np.ndarray, digits: int) -> np.ndarray:
    """Where chunks begin, by the patterns that take up to ``digits`` numbers and any one character before letters.

    ``points`` are the characters of texts with one more after each text, whose kind is END.
    """
    n = len(kind)
    before, before2 = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    before[1:], before2[2:] = kind[:-1], kind[:-2]
    letter, blank = kind == LETTER, kind >= SPACE
    start = kind != before
    # Letters take one character before them, unless that ends others or has a space.
    start &= ~(letter & ((before == SPACE) | (before == BLANK)))
    start &= ~(letter & (before == OTHER) & (before2 != OTHER) & (before2 != SPACE))
    start &= ~((kind == OTHER) & (before == SPACE))
    start[kind == END] = True
    numbers = np.flatnonzero(kind == NUMBER)
    if len(numbers):
        first = np.maximum.accumulate(np.where(before[numbers] != NUMBER, numbers, 0))
        start[numbers] = (numbers - first) % digits == 0
    # White space: line breaks go to other characters before them; then up to the last line break; then all but the last one.
    later = np.zeros(n, np.uint8)
    later[:-1] = kind[1:]
    start &= ~(blank & (before >= SPACE))
    start &= ~((kind == BREAK) & (before == OTHER))
    a = np.flatnonzero(blank & (before < SPACE) & (later >= SPACE))
    if len(a):
        b = np.flatnonzero(blank & (before >= SPACE) & (later < SPACE)) + 1
        breaks = np.flatnonzero(kind == BREAK)
        first, end = a.copy(), a
        if len(breaks):
            follows = np.flatnonzero(np.diff(breaks) != 1)
            group_ends = breaks[np.concatenate((follows, [len(breaks) - 1]))] + 1
            taken = (before[a] == OTHER) & (kind[a] == BREAK)
            first[taken] = group_ends[np.searchsorted(group_ends, a[taken], "right")]
            last = breaks[np.maximum(np.searchsorted(breaks, b) - 1, 0)]
            end = np.where((last >= first) & (last < b), last + 1, first)
        start[first[first < b]] = True
        left = end < b
        start[end[left]] = True
        start[b[left & (kind[b] != END)] - 1] = True
    marks = np.flatnonzero((points == APOSTROPHE) & start)
    marks = marks[letter[marks + 1]]
    if len(marks):
        lower = lambda at: np.where(points[at] < 128, points[at] | 32, points[at])
        one, two = lower(marks + 1), lower(marks + 2)
        short = np.isin(one, [*map(ord, "sdmt"), LONG_S])
        long = ((one == ord("l")) & (two == ord("l"))) | (((one == ord("v")) | (one == ord("r"))) & (two == ord("e")))
        rest = np.concatenate((marks[short] + 2, marks[long & ~short & letter[marks + 2]] + 3))
        start[rest[letter[rest]]] = True
    return start


def blocks(texts: pa.Array) -> Iterator[tuple[list[str], np.ndarray]]:
    """Texts or their parts, some at a time, with the row of each."""
    safe = re.compile(SAFE)
    held, rows, size = [], [], 0
    for at in range(0, len(texts), 256):
        for row, text in enumerate(texts.slice(at, 256).to_pylist(), at):
            begin = 0
            while text and begin < len(text):
                found = safe.search(text, begin + BLOCK) if len(text) - begin > BLOCK else None
                end = found.start() + 1 if found else len(text)
                held.append(text if end - begin == len(text) else text[begin:end])
                rows.append(row)
                size += end - begin
                begin = end
                if size >= BLOCK:
                    yield held, np.array(rows)
                    held, rows, size = [], [], 0
    if held:
        yield held, np.array(rows)


def cut_block(parts: list[str], kinds: np.ndarray, digits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """UTF-8 bytes of the parts with one byte after each, where these bytes are, and where chunks begin; each such byte is a chunk."""
    joined = "\0".join(parts) + "\0"
    raw = joined.encode()
    points = np.frombuffer(raw, np.uint8) if len(raw) == len(joined) else np.frombuffer(joined.encode("utf-32-le"), "<u4")
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    kind = kinds[points]
    kind[ends] = END
    begins = np.flatnonzero(chunk_starts(points, kind, digits))
    if len(raw) != len(joined):
        places = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
        begins, ends = places[begins], places[ends]
    return np.frombuffer(raw, np.uint8), ends, begins


def block_chunks(parts: list[str], kinds: np.ndarray, digits: int) -> tuple[pa.Array, np.ndarray]:
    """Chunks of the parts in order, and how many there are up to the end of each part."""
    raw, ends, begins = cut_block(parts, kinds, digits)
    chunks = pa.Array.from_buffers(pa.string(), len(begins), [None, pa.py_buffer(np.append(begins, len(raw)).astype(np.int32)), pa.py_buffer(raw)])
    marks = np.searchsorted(begins, ends)
    real = np.ones(len(begins), bool)
    real[marks] = False
    return chunks.filter(pa.array(real)), marks - np.arange(len(marks))


def replaced(chunks: pa.Array, rules: Mapping[str, str], of_bytes: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all chunks, and the number of each one's, by one replacement for each rule."""
    offsets = np.frombuffer(chunks.buffers()[1], np.int32)[chunks.offset : chunks.offset + len(chunks) + 1]
    raw = np.frombuffer(chunks.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    symbols = np.full(len(raw) + len(chunks), BETWEEN, "<u2")
    is_byte = np.ones(len(symbols), bool)
    is_byte[offsets[1:] - offsets[0] + np.arange(len(chunks))] = False
    symbols[is_byte] = raw if of_bytes is None else of_bytes[raw]
    seq = symbols.tobytes().decode("utf-16-le")
    for pair, new in rules.items():
        seq = seq.replace(pair, new)
    merged = np.frombuffer(seq.encode("utf-16-le"), "<u2")
    between = merged == BETWEEN
    return merged[~between], np.diff(np.flatnonzero(between), prepend=-1) - 1


def encode_blocks(
    batches: Iterator[pa.Array], rules: Mapping[str, str], kinds: bytes, digits: int, byte_symbols: str | None, surrogates: int, gap: int
) -> Iterator[pa.Array]:
    """Token ids of texts, by rules that merge symbols below their own; distinct chunks of a block are merged once."""
    table = kind_numbers(kinds)
    of_bytes = None if byte_symbols is None else np.frombuffer(byte_symbols.encode("utf-16-le"), "<u2")
    few = len(rules) <= PASSES and all(ord(new) < surrogates for new in rules.values())

    def merged(chunk: str) -> bytes:
        seq = chunk.encode().decode("iso-8859-1")
        return merge_by_rank(seq if byte_symbols is None else seq.translate(byte_symbols), rules).encode("utf-32-le")

    known = Remembered(merged)
    for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, len(whole), ROWS)):
        sizes = np.zeros(len(batch), np.int64)
        found = [np.zeros(0, np.int32)]
        for parts, rows in blocks(batch):
            chunks, upto = block_chunks(parts, table, digits)
            coded = chunks.dictionary_encode()
            if few:
                symbols, lengths = replaced(coded.dictionary, rules, of_bytes)
            else:
                each = list(map(known.__getitem__, coded.dictionary.to_pylist()))
                symbols = np.frombuffer(b"".join(each), "<i4")
                symbols = np.where(symbols < surrogates, symbols, symbols - gap)
                lengths = np.fromiter(map(len, each), np.int64, len(each)) >> 2
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths)), pa.int32()), pa.array(symbols.astype(np.int32)))
            found.append(lists.take(coded.indices).flatten().to_numpy())
            held = np.append(0, np.cumsum(lengths[coded.indices.to_numpy()]))
            np.add.at(sizes, rows, np.diff(held[upto], prepend=0))
        mask = batch.is_null() if batch.null_count else None
        yield pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(np.concatenate(found)), mask=mask)


# Distinct chunks and their bytes that a task counts before it passes them on.
COUNTED_CHUNKS, COUNTED_BYTES = 1 << 20, 1 << 25


def count_blocks(batches: Iterator[pa.RecordBatch], kinds: bytes, digits: int) -> Iterator[pa.RecordBatch]:
    """Chunks ``(chunk, n)`` of the texts in the first column; a chunk may come again."""
    table = kind_numbers(kinds)
    held: list[pa.Table] = []
    rows = least = 0

    def summed() -> pa.Table:
        return pa.concat_tables(held).group_by("chunk").aggregate([("n", "sum")]).select(["chunk", "n_sum"]).rename_columns(["chunk", "n"])

    for batch in batches:
        for parts, _ in blocks(batch.column(0)):
            counts = block_chunks(parts, table, digits)[0].value_counts()
            held.append(pa.table({"chunk": counts.field("values"), "n": counts.field("counts")}))
            rows += len(counts)
            if rows > COUNTED_CHUNKS + 2 * least:
                held[:] = [summed()]
                rows = least = held[0].num_rows
                if rows > COUNTED_CHUNKS or held[0].nbytes > COUNTED_BYTES:
                    yield from held[0].combine_chunks().to_batches(1 << 16)
                    held.clear()
                    rows = least = 0
    if held:
        yield from summed().combine_chunks().to_batches(1 << 16)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
