"""Substring dedup over bytes with suffix arrays by linear grouping.

The text of a bucket is read as a sequence of phrases, cut where its content says so, so that equal stretches of text have
equal phrases but for their ends. Their suffix array is built in two linear phases without recursion or renaming. The
first sorts suffixes into groups with the same Lyndon prefix: groups are taken from the highest down, and the suffixes
that the previous-smaller pointers of a group lead to move into groups of their own, just above the one they leave. The
second phase goes through the array once and places, for each suffix, those before it by following the pointers.

Suffixes with enough phrases in common are neighbours in the array; together with the bytes before the first and after
the last common phrase they tell which windows are equal.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.flat import byte_sums, gram_hashes, leftmost_minima, mix, range_hash
from corpusloom.llm.repeats import Windows, without_repeats

#: Bytes of a window, and of the grams that may be its anchor.
WINDOW, GRAM = 100, 40
#: A phrase begins at the smallest hash of ``CUT_GRAM`` bytes among ``CUT_WIDTH`` places in a row.
CUT_GRAM, CUT_WIDTH = 8, 25


def lyndon_groups(symbols: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Groups of suffixes with the same Lyndon prefix, as the array index where each begins, and previous-smaller pointers.

    The last symbol must be the only smallest one. Returns group and pointer of each suffix, and the size by group.
    """
    n = len(symbols)
    order = sorted(range(n), key=symbols.__getitem__)
    place, group, size = [0] * n, [0] * n, [0] * n
    begin = 0
    for i, s in enumerate(order):
        if symbols[s] != symbols[order[begin]]:
            begin = i
        place[s], group[s] = i, begin
        size[begin] += 1
    back = [-1] * n
    top = n
    while top:
        current = group[order[top - 1]]
        members = order[current:top] if top - current == 1 else sorted(order[current:top])
        top = current
        reached: dict[int, int] = {}
        for s in members:
            p = s - 1
            while p >= 0 and group[p] >= current:
                p = back[p]
            back[s] = p
            if p >= 0:
                reached[p] = reached.get(p, 0) + 1
        if len(reached) == 1:
            ((p, _),) = reached.items()
            batches = [[p]]
        else:
            # Suffixes followed by more copies of this group's prefix rank higher, so they move first.
            by_count: dict[int, list[int]] = {}
            for p, count in reached.items():
                by_count.setdefault(count, []).append(p)
            batches = [by_count[count] for count in sorted(by_count, reverse=True)]
        for batch in batches:
            moved: dict[int, list[int]] = {}
            for p in batch:
                moved.setdefault(group[p], []).append(p)
            for old, some in moved.items():
                if len(some) == size[old]:
                    continue
                end = old + size[old]
                for p in some:
                    end -= 1
                    other, at = order[end], place[p]
                    order[at], order[end], place[other], place[p] = other, p, at, end
                size[old] -= len(some)
                size[end] = len(some)
                for p in some:
                    group[p] = end
    return group, back, size


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Begins of all suffixes in order. The last symbol must be the only smallest one."""
    group, back, _ = lyndon_groups(symbols.tolist())
    n = len(group)
    free, out, placed = list(range(n)), [-1] * n, bytearray(n)
    out[0], placed[n - 1] = n - 1, 1
    for i in range(n):
        s = out[i] - 1
        while s >= 0 and not placed[s]:
            g = group[s]
            out[free[g]], placed[s] = s, 1
            free[g] += 1
            s = back[s]
    return np.array(out, np.int64)


def common_phrases(symbols: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Length of the prefix that each suffix shares with the one before it in the array, ``most`` at most."""
    shared = np.zeros(len(order), np.int64)
    left = np.arange(1, len(order))
    for depth in range(most):
        a, b = order[left - 1] + depth, order[left] + depth
        inside = (a < len(symbols)) & (b < len(symbols))
        left = left[inside][symbols[a[inside]] == symbols[b[inside]]]
        if not len(left):
            break
        shared[left] += 1
    return shared


def equal_windows(windows: Windows, text: np.ndarray, edges: np.ndarray, values: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Equal numbers for the windows in ``at`` with equal bytes."""
    if not len(at):
        return np.zeros(0, np.int64)
    reach = windows.size - CUT_GRAM - CUT_WIDTH + 1
    lowest = leftmost_minima(gram_hashes(values, CUT_GRAM), CUT_WIDTH)
    # First and last cut that the window's own bytes decide on.
    first, last = lowest[at], lowest[at + reach]
    cuts = np.unique(np.concatenate([lowest[low : high - CUT_GRAM - CUT_WIDTH + 2] for low, high in zip(edges, edges[1:], strict=False)]))
    owner = np.searchsorted(edges, cuts, "right") - 1
    ends = np.append(cuts[1:], edges[-1])
    closing = np.append(owner[1:] != owner[:-1], True)
    sums = byte_sums(text)
    names = range_hash(sums, cuts, np.where(closing, edges[owner + 1], ends))
    _, symbols = np.unique(names, return_inverse=True)
    # The last phrase of a stretch is unlike all others, so no common prefix reaches beyond it.
    symbols = symbols + 1
    symbols[closing] = symbols.max() + 1 + np.arange(int(closing.sum()))
    order = suffix_array(np.append(symbols, 0))
    rank = np.zeros(len(order), np.int64)
    rank[order] = np.arange(len(order))
    begin, phrases = np.searchsorted(cuts, first), np.searchsorted(cuts, last)
    phrases -= begin
    shared = common_phrases(symbols, order, int(phrases.max()))
    node = np.zeros(len(at), np.int64)
    for count in np.unique(phrases):
        some = phrases == count
        node[some] = np.cumsum(shared < count)[rank[begin[some]]]
    edge = mix(range_hash(sums, at, first) ^ mix(range_hash(sums, last, at + windows.size)))
    keys = mix(edge ^ mix((node << 16 | phrases).view(np.uint64)))
    return np.unique(keys, return_inverse=True)[1]


def without_repeated_bytes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """For each row: id, n_bytes, n_removed, n_spans, and kept, the bytes left.

    A byte goes if a window of ``window`` bytes covers it that also begins earlier: in a row with a smaller id, or before
    it in the same row. Windows must have at least ``CUT_GRAM + CUT_WIDTH`` bytes.
    """
    found = without_repeats(docs, Windows(window, gram, by_words=False), equal_windows, id_column, text_column)
    return found.select(id_column, F.col("n_units").alias("n_bytes"), "n_removed", "n_spans", "kept")
