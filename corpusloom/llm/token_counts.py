"""Word-piece counts of texts by linear longest match, without building the pieces.

The vocabulary is a trie with failure links. A node keeps how many pieces are cut off when its link is followed and
where the search goes on, so each byte of a word is read once: a word takes the longest piece that it begins with, then
the rest does the same. All distinct words of a slice advance together, byte by byte.

A word is a run of bytes other than blanks and \\x09 to \\x0D; it is matched with ``mark`` before it. A word with a part
that no piece covers counts as one unknown piece. Null and empty texts have no words.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.flat import slices, word_hashes, words

MARK = b" "


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as file:
        return [base64.b64decode(line.split()[0]) for line in file if line.strip()]


class Automaton:
    """Trie over bytes with failure links and the pieces that following them cuts off."""

    def __init__(self, pieces: Iterable[bytes], mark: bytes = MARK):
        children: list[dict[int, int]] = [{}]
        final = [False]
        for piece in pieces:
            at = 0
            for byte in piece:
                if byte not in children[at]:
                    children[at][byte] = len(children)
                    children.append({})
                    final.append(False)
                at = children[at][byte]
            final[at] = at > 0
        link, popped = [-1] * len(children), [0] * len(children)
        level = [0]
        while level:
            deeper = []
            for at in level:
                for byte, child in children[at].items():
                    deeper.append(child)
                    if final[child]:
                        link[child], popped[child] = 0, 1
                        continue
                    back, count = link[at], popped[at]
                    while back >= 0 and byte not in children[back]:
                        count += popped[back]
                        back = link[back]
                    if back >= 0:
                        link[child], popped[child] = children[back][byte], count
            level = deeper
        edges = sorted((at << 8 | byte, child) for at, found in enumerate(children) for byte, child in found.items())
        self.keys, self.children = np.array([k for k, _ in edges], np.int64), np.array([c for _, c in edges], np.int32)
        self.link, self.popped = np.array(link, np.int32), np.array(popped, np.int32)
        self.mark = mark

    def step(self, states: np.ndarray, byte: np.ndarray | int) -> np.ndarray:
        """The child by that byte, -1 where there is none."""
        if not len(self.keys):
            return np.full(len(states), -1, np.int32)
        keys = states.astype(np.int64) << 8 | byte
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.children[at], -1)

    def counts(self, data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Number of pieces of each word, which a range of bytes."""
        order = np.argsort(begins - ends, kind="stable")
        begins, lengths = begins[order], (ends - begins)[order]
        states, total = np.zeros(len(begins), np.int32), np.zeros(len(begins), np.int64)
        alive = np.arange(len(begins))
        for byte in self.mark:
            alive = self.advance(states, total, alive, np.full(len(alive), byte))
        at = 0
        while len(alive):
            alive = alive[: np.searchsorted(-lengths[alive], -at)]
            alive = self.advance(states, total, alive, data[begins[alive] + at])
            at += 1
        rest = np.flatnonzero(states > 0)
        while len(rest):
            total[rest] += self.popped[states[rest]]
            states[rest] = self.link[states[rest]]
            rest = rest[states[rest] > 0]
        total[states < 0] = 1
        out = np.zeros(len(order), np.int64)
        out[order] = total
        return out

    def advance(self, states: np.ndarray, total: np.ndarray, alive: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Reads one byte of each word; returns the words that can go on. A word that cannot ends in state -1."""
        todo, said = alive, byte
        while len(todo):
            found = self.step(states[todo], said)
            hit = found >= 0
            states[todo[hit]] = found[hit]
            todo, said = todo[~hit], said[~hit]
            total[todo] += self.popped[states[todo]]
            states[todo] = self.link[states[todo]]
            going = states[todo] >= 0
            todo, said = todo[going], said[going]
        return alive[states[alive] >= 0]


def token_counts(docs: DataFrame, automaton: Automaton, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """For each row: id, n_words, n_tokens."""

    def count(batches):
        for batch in batches:
            for some, data, where in slices(batch, "text"):
                begins, ends, before = words(data, where)
                _, first, place = np.unique(word_hashes(data, begins, ends), return_index=True, return_inverse=True)
                tokens = automaton.counts(data, begins[first], ends[first])[place]
                total = np.concatenate([[0], np.cumsum(tokens)])
                yield pa.record_batch([some.column("id"), pa.array(np.diff(before)), pa.array(total[before[1:]] - total[before[:-1]])], ["id", "n_words", "n_tokens"])

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(count, f"id {kind}, n_words long, n_tokens long").withColumnRenamed("id", id_column)
