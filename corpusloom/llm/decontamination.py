"""Benchmark decontamination: test items found in documents within an edit distance.

An item of m code points may differ by ``int(m * error_rate)`` edits from a passage of a document. It is cut
into one piece more than that, so at least one piece stands unchanged in any such passage. All pieces are found
in one pass over a text, and the surroundings of each hit are verified with the bit-parallel distance of Myers.

Items and texts are compared as they stand and folded: without letter case, and with each run of white space as one
blank (none at the ends). The smaller of the two distances counts, so a passage in capitals or wrapped anew costs no edit;
places always refer to the text as it stands.

Null and empty texts hold nothing; null items, empty ones and those of white space are found nowhere. An item shorter
than ``MIN_CHARS`` says too little to be searched for inside a text: it counts where it is the whole text, folded.
Repeated rows are searched one by one; equal items are each reported under their own id.
"""

from __future__ import annotations

from collections import defaultdict

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Share of an item's code points that may be edited.
ERROR_RATE = 0.05
MIN_CHARS = 16
#: Code points of items that travel with the tasks at once; more items take one more pass for each so many.
BLOCK_CHARS = 4_000_000

LEAK = pa.struct([("item_id", pa.int64()), ("distance", pa.int64()), ("begin", pa.int64()), ("end", pa.int64())])
LEAK_TYPE = "array<struct<item_id:bigint,distance:bigint,begin:bigint,end:bigint>>"


def pieces(text: str, count: int) -> list[tuple[int, str]]:
    """``count`` parts of nearly equal length with their offsets."""
    cuts = [len(text) * i // count for i in range(count + 1)]
    return [(a, text[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Pattern:
    """Bit-parallel edit distance of one string to the substrings of a text."""

    def __init__(self, text: str):
        self.size = len(text)
        self.masks: dict[str, int] = defaultdict(int)
        for i, c in enumerate(text):
            self.masks[c] |= 1 << i

    def distances(self, text: str, anchored: bool = False):
        """The distance after each code point: to the best substring that ends there, or to the whole beginning."""
        full, top, masks = (1 << self.size) - 1, 1 << (self.size - 1), self.masks
        up, down, score = full, 0, self.size
        for c in text:
            same = masks.get(c, 0)
            diagonal = (((same & up) + up) ^ up) | same
            rise = down | (~(diagonal | up) & full)
            fall = up & diagonal
            if rise & top:
                score += 1
            elif fall & top:
                score -= 1
            rise = ((rise << 1) | anchored) & full
            fall = (fall << 1) & full
            level = same | down
            up = fall | (~(level | rise) & full)
            down = rise & level
            yield score


def folded(text: str) -> str:
    """The text without letter case and with single blanks."""
    return " ".join(text.casefold().split())


def origins(text: str) -> list[int]:
    """Where each code point of the folded text stands in the text."""
    out: list[int] = []
    blank = -1
    for i, c in enumerate(text):
        if c.isspace():
            blank = i if blank < 0 else blank
            continue
        if blank >= 0 and out:
            out.append(blank)
        blank = -1
        out += [i] * len(c.casefold())
    return out


class Index:
    """The pieces of items in one form, as they stand or folded."""

    def __init__(self, items: dict[int, str], error_rate: float):
        self.items, self.error_rate = items, error_rate
        self.automaton, self.patterns = ahocorasick.Automaton(), {}
        found = defaultdict(list)
        for i, text in items.items():
            for offset, piece in pieces(text, int(len(text) * error_rate) + 1):
                found[piece].append((i, offset))
        for piece, places in found.items():
            self.automaton.add_word(piece, (len(piece), places))
        self.automaton.make_automaton()

    def pattern(self, i: int) -> tuple[Pattern, Pattern]:
        if i not in self.patterns:
            text = self.items[i]
            self.patterns[i] = Pattern(text), Pattern(text[::-1])
        return self.patterns[i]

    def windows(self, text: str) -> dict[int, list[list[int]]]:
        """For each item, the merged stretches of the text that a piece hit allows for."""
        spots = defaultdict(set)
        if len(self.automaton):
            for last, (size, places) in self.automaton.iter(text):
                for i, offset in places:
                    spots[i].add(last + 1 - size - offset)
        merged = {}
        for i, begins in spots.items():
            size = len(self.items[i])
            slack = int(size * self.error_rate)
            stretches: list[list[int]] = []
            for begin in sorted(begins):
                low, high = max(0, begin - slack), min(len(text), begin + size + slack)
                if stretches and low <= stretches[-1][1]:
                    stretches[-1][1] = max(high, stretches[-1][1])
                else:
                    stretches.append([low, high])
            merged[i] = stretches
        return merged

    def best(self, text: str) -> dict[int, tuple[int, int, int]]:
        """Distance, begin and end of the best passage for each item that the text holds, the first one among equals."""
        out = {}
        for i, stretches in self.windows(text).items():
            forward, backward = self.pattern(i)
            best, end = int(forward.size * self.error_rate) + 1, -1
            for low, high in stretches:
                for at, distance in enumerate(forward.distances(text[low:high]), low + 1):
                    if distance < best:
                        best, end = distance, at
            if end >= 0:
                before = text[max(0, end - forward.size - best) : end][::-1]
                length = next(n for n, d in enumerate(backward.distances(before, anchored=True), 1) if d == best)
                out[i] = best, end - length, end
        return out


class Items:
    """A block of items, ready to be searched for in texts."""

    def __init__(self, rows: list[tuple[int, str]], error_rate: float, min_chars: int):
        self.rows, self.error_rate, self.min_chars = rows, error_rate, min_chars
        self.plain = None

    def build(self) -> None:
        plain, fold, self.whole = {}, {}, defaultdict(list)
        for i, (_, text) in enumerate(self.rows):
            short = folded(text)
            if not short:
                continue
            if len(text) >= self.min_chars:
                plain[i] = text
            if min(len(text), len(short)) < self.min_chars:
                self.whole[short].append(i)
            else:
                fold[i] = short
        self.plain, self.folded = Index(plain, self.error_rate), Index(fold, self.error_rate)

    def leaks(self, text: str | None) -> list[dict]:
        """The best passage for each item that the text holds, as it stands or folded."""
        if not text:
            return []
        if self.plain is None:
            self.build()
        best, short, places = self.plain.best(text), folded(text), None
        for i, (distance, begin, end) in self.folded.best(short).items():
            if i not in best or distance < best[i][0]:
                places = places or origins(text)
                best[i] = distance, places[begin], places[end - 1] + 1
        best |= {i: (0, 0, len(text)) for i in self.whole.get(short, ())}
        names = ("distance", "begin", "end")
        return sorted(({"item_id": self.rows[i][0]} | dict(zip(names, found, strict=True)) for i, found in best.items()), key=lambda leak: leak["item_id"])


def item_blocks(items: DataFrame, item_id: str, item_text: str, block_chars: int) -> list[list[tuple[int, str]]]:
    """The items in blocks of bounded size; one block at a time is fetched and shipped."""
    rows = items.select(F.col(item_id).cast("long").alias("id"), F.col(item_text).alias("text")).where("id is not null and trim(text) != ''")
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    count = -(-total // block_chars)
    for block in range(count):
        yield [tuple(r) for r in rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(count)) == block).distinct().sort("id", "text").collect()]


def searched(text: Column | str, index: Items) -> Column:
    """The leaks of one block of items."""

    def search(texts: pa.Array) -> pa.Array:
        return pa.array([index.leaks(t.as_py()) for t in texts], pa.list_(LEAK))

    return F.arrow_udf(search, LEAK_TYPE)(text)


def leaks(
    items: DataFrame,
    text: Column | str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    error_rate: float = ERROR_RATE,
    min_chars: int = MIN_CHARS,
    block_chars: int = BLOCK_CHARS,
) -> Column:
    """For a text: the items it holds, each with its distance and place (code points, end exclusive)."""
    found = [searched(text, Items(block, error_rate, min_chars)) for block in item_blocks(items, item_id, item_text, block_chars)]
    empty = F.array().cast(LEAK_TYPE)
    return F.concat(empty, *found) if found else empty


def find_leaks(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """One row for each document and item it holds: id, item_id, distance, begin, end."""
    return docs.select(F.col(id_column), F.explode(leaks(items, F.col(text_column), **options)).alias("leak")).select(id_column, "leak.*")


def without_leaks(docs: DataFrame, items: DataFrame, text_column: str = "text", **options) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    return docs.where(F.size(leaks(items, F.col(text_column), **options)) == 0)
