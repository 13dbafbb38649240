"""Substring dedup over words with prefix-partitioned suffix trees.

The suffixes of a bucket are split by prefixes of growing length: groups of suffixes that share a prefix are refined by
prefixes twice as long, while a suffix that is alone in its group is a leaf and goes no further. What is still together
at the window's length hangs below one deep internal node of the suffix tree: a repeat, with all the places where it
stands. Every group fits in memory, as buckets of the corpus do (see ``repeats``).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.repeats import Windows, without_repeats

#: Words of a window, and of the grams that may be its anchor.
WINDOW, GRAM = 50, 20


def refined(group: np.ndarray, step: int) -> np.ndarray:
    """Groups of suffixes by prefixes longer by those of the suffixes ``step`` further on. Leaves keep their number."""
    size = np.bincount(group)
    wide = np.flatnonzero(size[group] > 1)
    after = group[np.minimum(wide + step, len(group) - 1)]
    _, parts = np.unique(group[wide] * len(size) + after, return_inverse=True)
    out = group.copy()
    out[wide] = len(size) + parts
    return np.unique(out, return_inverse=True)[1]


def deep_nodes(windows: Windows, text: np.ndarray, edges: np.ndarray, values: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The node at the window's depth for each suffix in ``at``; equal numbers share the whole window."""
    group = np.unique(values, return_inverse=True)[1]
    found, depth, offset = np.zeros(len(at), np.int64), 1, windows.size
    while depth <= windows.size:
        if windows.size & depth:
            # The window is made of prefixes of the lengths of its binary digits, shortest last.
            offset -= depth
            pair = found * (int(group.max()) + 1) + group[at + offset]
            found = np.unique(pair, return_inverse=True)[1]
        if 2 * depth <= windows.size:
            group = refined(group, depth)
        depth *= 2
    return found


def without_repeated_words(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """For each row: id, n_words, n_removed, n_spans, and kept, the words left joined by blanks.

    A word goes if a window of ``window`` words covers it whose words also stand in a row with a smaller id.
    """
    found = without_repeats(docs, Windows(window, gram, by_words=True), deep_nodes, id_column, text_column)
    return found.select(id_column, F.col("n_units").alias("n_words"), "n_removed", "n_spans", F.col("kept").cast("string").alias("kept"))
