"""The small loops that run in Python workers.

They are shipped with the functions that call them, so that workers need not
have this package installed.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator, Mapping
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle


def merge_chunk(seq: str, rules: Mapping[str, str]) -> str:
    """Apply the lowest-ranked rule present, at its first place, until none is.

    ``rules`` maps two symbols to one and is in rank order; new symbols sort by
    rank. Places are taken from a queue and neighbours are linked, so the work
    grows with the length times its logarithm.
    """
    n = len(seq)
    symbols: list[str] = list(seq)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    queue = [(new, i) for i in range(n - 1) if (new := rules.get(seq[i : i + 2])) is not None]
    heapify(queue)
    while queue:
        new, i = heappop(queue)
        j = after[i]
        # Places whose symbols have changed meanwhile no longer make this symbol.
        if j >= n or not symbols[i] or rules.get(symbols[i] + symbols[j]) != new:
            continue
        symbols[i], symbols[j] = new, ""
        after[i] = right = after[j]
        left = before[i]
        if right < n:
            before[right] = i
            if (found := rules.get(new + symbols[right])) is not None:
                heappush(queue, (found, i))
        if left >= 0 and (found := rules.get(symbols[left] + new)) is not None:
            heappush(queue, (found, left))
    return "".join(symbols)


def symbol_ids(seq: str, surrogates: int, gap: int) -> np.ndarray:
    """Token ids of a sequence of symbols: code points, less the gap above the surrogates."""
    points = np.frombuffer(seq.encode("utf-32-le"), dtype="<u4").astype("int32")
    return np.where(points < surrogates, points, points - gap).astype("int32")


def split_at_rank(token: bytes, ranks: Mapping[bytes, int], limit: int) -> list[bytes]:
    """Merge neighbours of ``token`` by lowest rank, using only ranks below ``limit``."""
    cuts = list(range(len(token) + 1))
    while len(cuts) > 2:
        options = [(ranks.get(token[cuts[i - 1] : cuts[i + 1]], limit), i) for i in range(1, len(cuts) - 1)]
        rank, cut = min(options)
        if rank >= limit:
            break
        del cuts[cut]
    return [token[i:j] for i, j in zip(cuts, cuts[1:])]


# A sequence is merged by one replacement for each rule, if there are no more rules than this in all and for each of its symbols.
FOLDED_RULES = 1 << 10
FOLDED_RULES_PER_SYMBOL = 1 << 5


def merge_by_rank(seq: str, rules: Mapping[str, str]) -> str:
    """What :func:`merge_chunk` gives, where every rule merges symbols that sort before its own."""
    if len(rules) > min(FOLDED_RULES, FOLDED_RULES_PER_SYMBOL * len(seq)):
        return merge_chunk(seq, rules)
    for pair, new in rules.items():
        if pair in seq:
            seq = seq.replace(pair, new)
    return seq


# Pieces of a text, cut before each space that follows no white space. White space is what Python takes for it, which includes what
# patterns take for it: there are fewer cuts, not more. At the end of a text an empty piece may follow.
PIECES = r"\s*+\S*+(?:[^\S ]\s*+\S*+)*+"
# Characters of pieces, with some for each piece, that a task remembers; beyond it the memory starts afresh.
REMEMBERED = 1 << 24
PER_PIECE = 32
# Longer pieces are not remembered.
REMEMBERED_LENGTH = 1 << 8
# Rows that are looked at together.
SLICE = 1 << 8


class Remembered(dict):
    """Results of a function by piece, for a bounded number of characters."""

    def __init__(self, function):
        self.function, self.held = function, 0

    def __missing__(self, piece: str) -> bytes:
        found = self.function(piece)
        if len(piece) <= REMEMBERED_LENGTH:
            self.held += len(piece) + PER_PIECE
            if self.held > REMEMBERED:
                self.clear()
                self.held = len(piece) + PER_PIECE
            self[piece] = found
        return found


def count_chunks(batches: Iterator[pa.RecordBatch], cut: str, kinds: bytes) -> Iterator[pa.RecordBatch]:
    """Chunks ``(chunk, n)`` of the texts in the first column; a chunk comes again when the memory starts afresh."""
    kinds_of, find, pieces = zlib.decompress(kinds).decode(), re.compile(cut).finditer, re.compile(PIECES).findall
    counts: Counter[str] = Counter()
    seen = 0

    def counted() -> pa.RecordBatch:
        found: dict[str, int] = defaultdict(int)
        for piece, n in counts.items():
            for m in find(piece.translate(kinds_of)):
                found[piece[m.start() : m.end()]] += n
        return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["chunk", "n"])

    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            for text in batch.column(0).slice(at, SLICE).to_pylist():
                known = len(counts)
                counts.update(pieces(text))
                # A text's new pieces are no longer than the text.
                seen += min(len(text), (len(counts) - known) * REMEMBERED_LENGTH) + (len(counts) - known) * PER_PIECE
                if seen > 2 * REMEMBERED:
                    yield counted()
                    counts.clear()
                    seen = 0
    yield counted()


def encode_texts(
    batches: Iterator[pa.Array], rules: Mapping[str, str], cut: str | None, kinds: bytes, byte_symbols: str | None, surrogates: int, gap: int
) -> Iterator[pa.Array]:
    """Token ids of texts. ``cut`` is a pattern over the kinds of characters, or None where a text is one chunk."""
    kinds_of, find = (None, None) if cut is None else (zlib.decompress(kinds).decode(), re.compile(cut).finditer)
    pieces = re.compile(PIECES).findall

    def merged(chunk: str) -> bytes:
        seq = chunk.encode().decode("iso-8859-1")
        return merge_by_rank(seq if byte_symbols is None else seq.translate(byte_symbols), rules).encode("utf-32-le")

    chunks = Remembered(merged)
    known = Remembered(lambda piece: b"".join([chunks[piece[m.start() : m.end()]] for m in find(piece.translate(kinds_of))]))
    for batch in batches:
        parts, ends = [], np.zeros(len(batch) + 1, np.int64)
        for at in range(0, len(batch), SLICE):
            for i, text in enumerate(batch.slice(at, SLICE).to_pylist(), at + 1):
                if text:
                    parts.append(merged(text) if find is None else b"".join(map(known.__getitem__, pieces(text))))
                    ends[i] = len(parts[-1]) >> 2
        symbols = np.frombuffer(b"".join(parts), "<i4")
        del parts
        if len(symbols) and symbols.max() >= surrogates:
            symbols = np.where(symbols < surrogates, symbols, symbols - gap).astype("int32")
        mask = batch.is_null() if batch.null_count else None
        yield pa.ListArray.from_arrays(pa.array(np.cumsum(ends), pa.int32()), pa.array(symbols, pa.int32()), mask=mask)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
