"""SentencePiece encoding and decoding.

Encoding finds the split with the largest sum of piece scores, as a unigram model does. White space belongs to the
word after it and no piece reaches over a word's end, so words are split one by one, each distinct word once.
Words of equal length advance together through the Viterbi search: the hash of every substring is looked up among the
sorted piece keys, and the best predecessor of each position is a maximum over the possible piece lengths. Of equally
good splits the one with the longest last piece wins, at each position. Code points without a piece become byte pieces.

Null texts and null id lists stay null, an empty text has no pieces. Decoding returns the text that was encoded, but
that the word mark U+2581 is read as a blank. An id outside the vocabulary fails the job.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StructType

from corpusloom.llm.flat import give_back, mix, ranges

MARK = "▁"
WORD = re.compile(r" *[^ ]+| +")
#: Distinct words a task remembers, and the code points of those it searches at once.
CACHE_WORDS = 300_000
SEARCH_POINTS = 1 << 17
#: Code points of the texts that are encoded together.
PART_POINTS = 1 << 21
UNKNOWN_PENALTY = 10.0
SEEN_SHIFT = np.uint64(43)
_STEP = np.uint64(0x9E3779B97F4A7C15)


class PieceModel:
    """Pieces, scores and byte pieces of a SentencePiece model file; small enough to travel with the tasks."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        normal = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.bytes = [b"" if model.is_control(i) else " ⁇ ".encode() if model.is_unknown(i) else bytes([int(n[3:5], 16)]) if model.is_byte(i) else n.replace(MARK, " ").encode() for i, n in enumerate(names)]
        self.byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        self.ids = np.array(normal, np.int32)
        self.scores = np.array([model.get_score(i) for i in normal])
        self.unknown = self.scores.min() - UNKNOWN_PENALTY
        pieces = [names[i].replace(MARK, " ") for i in normal]
        if any(" " in p.lstrip(" ") for p in pieces):
            raise ValueError("a piece reaches over the end of a word")
        self.longest = max(map(len, pieces))
        self.points = np.zeros((len(pieces), self.longest), np.uint32)
        for row, piece in zip(self.points, pieces, strict=True):
            row[: len(piece)] = [ord(c) for c in piece]
        lengths = np.array([len(p) for p in pieces])
        keys = np.zeros(len(pieces), np.uint64)
        for n in np.unique(lengths):
            keys[lengths == n] = whole_keys(self.points[lengths == n, :n].astype(np.uint64))
        order = np.argsort(keys)
        if (np.diff(keys[order]) == 0).any():
            raise ValueError("two pieces share a key")
        self.keys, self.ids, self.scores, self.points = keys[order], self.ids[order], self.scores[order], self.points[order]
        # Most substrings are no piece: the upper bits of their keys tell.
        self.seen = np.zeros(1 << (64 - int(SEEN_SHIFT)), bool)
        self.seen[self.keys >> SEEN_SHIFT] = True

    def hits(self, sums: np.ndarray, points: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which substrings of ``size`` code points are pieces: rows and pieces by begin, and where each begin starts."""
        keys = mix(sums[size:] - sums[:-size] * np.uint64(pow(int(_STEP), size, 1 << 64))).ravel()
        spots = np.flatnonzero(self.seen[keys >> SEEN_SHIFT])
        at = np.minimum(np.searchsorted(self.keys, keys[spots]), len(self.keys) - 1)
        same = self.keys[at] == keys[spots]
        begins, rows = np.divmod(spots[same], len(points))
        at = at[same]
        exact = np.ones(len(at), bool)
        for j in range(size):
            exact &= self.points[at, j] == points[rows, begins + j]
        begins, rows, at = begins[exact], rows[exact], at[exact]
        return np.searchsorted(begins, np.arange(len(sums) - size + 1)), rows, at

    def search(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and lengths of the best splits of equally long words, given as rows of code points; ids run backwards."""
        n, length = points.shape
        best = np.full((length + 1, n), -np.inf)
        best[0] = 0
        taken, index = np.ones((length + 1, n), np.int8), np.full((length + 1, n), -1, np.int32)
        sums, every = prefix_keys(points.astype(np.uint64)), np.arange(n)
        hits = [self.hits(sums, points, size) for size in range(1, min(self.longest, length) + 1)]
        for end in range(1, length + 1):
            best[end] = best[end - 1] + self.unknown
            for size, (borders, rows, pieces) in enumerate(hits[:end], 1):
                some = slice(borders[end - size], borders[end - size + 1])
                row, piece = rows[some], pieces[some]
                score = best[end - size, row] + self.scores[piece]
                # A code point with a piece of its own is never unknown; a longer piece wins if it is as good.
                better = slice(None) if size == 1 else score >= best[end, row]
                row = row[better]
                best[end, row], taken[end, row], index[end, row] = score[better], size, piece[better]
        out, owner, where = [], [], np.full(n, length)
        while len(every):
            ends = where[every]
            piece = index[ends, every]
            known = piece >= 0
            out.append(np.where(known, self.ids[np.maximum(piece, 0)], -points[every, ends - 1].astype(np.int64) - 1))
            owner.append(every)
            where[every] = ends - taken[ends, every]
            every = every[where[every] > 0]
        return np.concatenate(out), np.concatenate(owner)

    def split(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in their order, and how many each has."""
        by_length: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            by_length.setdefault(len(word), []).append(i)
        found, owners = [], []
        for length, members in by_length.items():
            step = max(1, SEARCH_POINTS // length)
            for first in range(0, len(members), step):
                some = members[first : first + step]
                points = np.frombuffer("".join(words[i] for i in some).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(some), length)
                ids, rows = self.search(points)
                found.append(ids)
                owners.append(np.array(some)[rows])
        ids, owner = np.concatenate(found), np.concatenate(owners)
        # The search returns a word's last piece first.
        order = np.argsort(owner[::-1], kind="stable")
        ids, owner = ids[::-1][order], owner[::-1][order]
        lengths = np.ones(len(ids), np.int64)
        unknown = np.flatnonzero(ids < 0)
        if len(unknown):
            spelled = {int(p): self.byte_ids[list(chr(-p - 1).encode("utf-8", "replace"))] for p in np.unique(ids[unknown])}
            lengths[unknown] = [len(spelled[int(p)]) for p in ids[unknown]]
            wide = np.repeat(ids, lengths)
            wide[ranges(np.cumsum(lengths)[unknown] - lengths[unknown], lengths[unknown])] = np.concatenate([spelled[int(p)] for p in ids[unknown]])
            ids = wide
        return ids.astype(np.int32), np.bincount(np.repeat(owner, lengths), minlength=len(words))


def prefix_keys(points: np.ndarray) -> np.ndarray:
    """Polynomial sums over the columns; column j covers the first j code points."""
    sums = np.zeros((points.shape[1] + 1, len(points)), np.uint64)
    for j in range(points.shape[1]):
        sums[j + 1] = sums[j] * _STEP + mix(points[:, j] + np.uint64(1))
    return sums


def whole_keys(points: np.ndarray) -> np.ndarray:
    """The keys of whole rows."""
    return mix(prefix_keys(points)[-1])


class Encoder:
    """Splits texts with the words seen so far at hand."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.clear()

    def __getstate__(self):
        return {"model": self.model}

    def __setstate__(self, state):
        self.__init__(state["model"])

    def clear(self) -> None:
        # A new word gets the next number.
        self.index: dict[str, int] = defaultdict(count().__next__)
        self.ids, self.begins, self.counts = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode(self, texts: list[str | None]) -> pa.Array:
        rows, first, index = [], len(self.index), self.index
        sizes = np.zeros(len(texts) + 1, np.int64)
        for i, text in enumerate(texts):
            if text:
                words = WORD.findall(" " + text.replace(MARK, " "))
                rows.append(np.fromiter(map(index.__getitem__, words), np.int64, len(words)))
                sizes[i + 1] = len(words)
        if len(index) > first:
            new = list(index)[first:]
            ids, counts = self.model.split(new)
            self.begins = np.concatenate([self.begins, len(self.ids) + np.cumsum(counts) - counts])
            self.counts, self.ids = np.concatenate([self.counts, counts]), np.concatenate([self.ids, ids])
        words = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        counts = self.counts[words]
        ids = self.ids[ranges(self.begins[words], counts)]
        ends = np.concatenate([[0], np.cumsum(counts)])[np.cumsum(sizes)]
        if len(index) > CACHE_WORDS:
            self.clear()
        missing = pa.array([t is None for t in texts], pa.bool_())
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()), mask=missing)


class Decoder:
    """Joins pieces to texts; bytes that are no UTF-8 become U+FFFD."""

    def __init__(self, model: PieceModel):
        self.sizes = np.array([len(b) for b in model.bytes])
        self.content, self.begins = np.frombuffer(b"".join(model.bytes), np.uint8), np.cumsum(self.sizes) - self.sizes

    def text(self, row: pa.ListScalar) -> str | None:
        if not row.is_valid:
            return None
        found = row.values.to_numpy(zero_copy_only=False)
        if len(found) and not (0 <= found.min() and found.max() < len(self.sizes)):
            raise ValueError("an id is outside the vocabulary")
        said = self.content[ranges(self.begins[found], self.sizes[found])].tobytes().decode("utf-8", "replace")
        return said.removeprefix(" ")


def text_parts(texts: pa.Array, limit: int = PART_POINTS):
    """The texts in lists of about ``limit`` code points."""
    part, size = [], 0
    for text in texts:
        part.append(text.as_py())
        size += len(part[-1] or "")
        if size >= limit:
            yield part
            part, size = [], 0
    if part:
        yield part


def encode(text: Column | str, model: PieceModel) -> Column:
    """The piece ids of a text. Spark evaluates it anew within ``decode``: :func:`round_trips` does both at once."""
    encoder = Encoder(model)

    def encoded(texts: pa.Array) -> pa.Array:
        found = pa.concat_arrays([pa.array([], pa.list_(pa.int32())), *map(encoder.encode, text_parts(texts))])
        give_back()
        return found

    return F.arrow_udf(encoded, "array<int>")(text)


def decode(ids: Column | str, model: PieceModel) -> Column:
    """The text of piece ids; bytes that are no UTF-8 become U+FFFD."""
    decoder = Decoder(model)

    def decoded(rows: pa.Array) -> pa.Array:
        return pa.array(map(decoder.text, rows), pa.string())

    return F.arrow_udf(decoded, "string")(ids)


def round_trips(docs: DataFrame, model: PieceModel, text_column: str = "text", part_points: int = PART_POINTS) -> DataFrame:
    """All rows with ``ids`` and ``round_trip`` in place of the text: its piece ids, and whether they decode to it.

    Each text is encoded once, and rows leave the task with the ids of about ``part_points`` code points at a time.
    """
    kept = [field for field in docs.schema if field.name != text_column]
    names, encoder, decoder = [field.name for field in kept], Encoder(model), Decoder(model)

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for texts in text_parts(batch.column(len(names)), part_points):
                ids = encoder.encode(texts)
                same = pa.array([decoder.text(row) == text for row, text in zip(ids, texts, strict=True)], pa.bool_())
                others = [batch.column(i).slice(done, len(texts)) for i in range(len(names))]
                done += len(texts)
                yield pa.RecordBatch.from_arrays([*others, ids, same], [*names, "ids", "round_trip"])
                del ids, same, others
                give_back()

    found = StructType(kept).add("ids", ArrayType(IntegerType())).add("round_trip", BooleanType())
    return docs.select(*names, text_column).mapInArrow(both, found)
