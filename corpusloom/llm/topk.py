"""Exact top-k search by inner product with the threshold algorithm.

Each block of vectors keeps one list per dimension, sorted by component. A query reads the lists from the end that its
own component favours, some positions of all lists at a time and more with every turn, scores every vector it meets there in
full, and stops when no vector further down could beat its k-th best score. The best of all blocks are merged. Rows are dealt to
blocks by their number, so that rows that repeat one id or vector fill no block more than others.

Vectors that are null or hold a null or a component that is not finite take no part, nor do rows without id. Where
lengths differ, a missing component counts as 0; a vector without components scores 0 with all. Rows that repeat an id
are candidates each for itself; a query is never its own candidate under any row of its id, and a repeated query counts
once, with its first vector in order. Where a sum could pass 2**53, a block is computed in Python's integers; a score beyond
64 bits fails the job.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import materialize

#: Vectors and queries of a block.
BLOCK, QUERIES = 8_192, 4_096
#: Positions of every list that are read first, and how many times more with each turn.
DEPTH, DEEPER = 16, 4
#: Sums of doubles are exact up to here.
EXACT = 1 << 53


def integer_vectors(vectors: DataFrame, id_column: str, vector_column: str, scale: float) -> DataFrame:
    """Rows that take part, with components as floor(scale * x)."""
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("parts"))
    finite = F.forall("parts", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("parts").isNotNull()).where(finite)
    return rows.select("vec_id", F.transform("parts", lambda x: F.floor(x * F.lit(float(scale))).cast("double")).alias("parts"))


def matrix(column: pa.ChunkedArray, size: int | None = None) -> np.ndarray:
    """Lists of numbers as rows, filled up with 0."""
    lists = [row.values.to_numpy() for row in column]
    size = max([len(x) for x in lists] + [1]) if size is None else size
    out = np.zeros((len(lists), size))
    for row, values in zip(out, lists, strict=True):
        row[: len(values)] = values[:size]
    return out


def whole_numbers(values: np.ndarray) -> np.ndarray:
    """The same numbers as Python's integers."""
    return np.array([int(x) for x in values.ravel()], dtype=object).reshape(values.shape)


class SortedLists:
    """A block of vectors with a list per dimension, largest components first."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        self.ids, self.values = ids, values
        self.order = np.argsort(-values, axis=0, kind="stable").astype(np.int32)
        self.ranked = np.take_along_axis(values, self.order, axis=0)
        self.largest = float(np.abs(values).max()) if values.size else 0.0

    def exact(self, query: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Vectors, ranked components and query as doubles, or as integers if sums of doubles may not be exact."""
        if self.largest * float(np.abs(query).max()) * len(query) < EXACT:
            return self.values, self.ranked, query
        if not hasattr(self, "whole"):
            self.whole = whole_numbers(self.values), whole_numbers(self.ranked)
        return *self.whole, whole_numbers(query)

    def best(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best candidates of the block, best first, equal scores by id."""
        n = len(self.ids)
        used = np.flatnonzero(query)
        if not len(used):
            # Every score is 0: the smallest ids.
            ids = np.sort(self.ids[self.ids != query_id])[:k]
            return ids, np.zeros(len(ids))
        up = query[used] > 0
        values, ranked, query = self.exact(query)
        met = self.ids == query_id
        ids, scores = np.zeros(0, np.int64), np.zeros(0, values.dtype)
        every, done, depth = None, 0, DEPTH
        while done < n:
            at = np.arange(done, min(done + depth, n))
            new = np.zeros(n, bool)
            new[self.order[np.where(up, at[:, None], n - 1 - at[:, None]), used]] = True
            new &= ~met
            met |= new
            rows = np.flatnonzero(new)
            # Reading single rows costs more than computing with all of them when there are many.
            if every is None and len(rows) * 8 > n:
                every = values @ query
            found = values[rows] @ query if every is None else every[rows]
            if len(ids) == k:
                good = found >= scores[-1]
                rows, found = rows[good], found[good]
            ids, scores = first_k(np.concatenate([ids, self.ids[rows]]), np.concatenate([scores, found]), k)
            # What a vector below these positions can reach at most.
            bound = ranked[np.where(up, at[-1], n - 1 - at[-1]), used] @ query[used]
            if len(ids) == k and scores[-1] > bound:
                break
            done, depth = done + depth, depth * DEEPER
        return ids, scores


def first_k(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best scores, equal ones by id."""
    if scores.dtype == object:
        order = np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k], np.int64)
    else:
        if len(ids) > 4 * k:
            # All that reach the k-th score, however many share it.
            kept = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
            ids, scores = ids[kept], scores[kept]
        order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: float = 256.0,
) -> DataFrame:
    """For each query: query_id, rank (from 1), vec_id and score of its k best candidates."""
    numbered = integer_vectors(vectors, id_column, vector_column, scale).withColumn("number", F.monotonically_increasing_id())
    # Written with their numbers: lost executors change no block.
    rows = materialize(numbered, "vectors")
    asked = integer_vectors(queries, id_column, vector_column, scale).groupBy("vec_id").agg(F.min("parts").alias("parts"))
    asked = materialize(asked, "queries")
    row_blocks, query_blocks = -(-rows.count() // BLOCK) or 1, -(-asked.count() // QUERIES) or 1
    blocks = lambda n: F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))
    # Every block of queries meets every block of rows once; the key is the pair of blocks.
    of_rows = rows.withColumn("rows", F.pmod(F.xxhash64("number"), F.lit(row_blocks))).withColumn("asked", F.explode(blocks(query_blocks)))
    of_queries = asked.withColumn("asked", F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks))).withColumn("rows", F.explode(blocks(row_blocks)))

    def search(block: pa.Table, wanted: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], []]
        if block.num_rows and wanted.num_rows:
            values = matrix(block.column("parts"))
            lists = SortedLists(block.column("vec_id").to_numpy(), values)
            for query_id, query in zip(wanted.column("vec_id").to_pylist(), matrix(wanted.column("parts"), values.shape[1]), strict=True):
                ids, scores = lists.best(query_id, query, k)
                out[0].append(np.full(len(ids), query_id))
                out[1].append(ids)
                out[2].append(np.array([int(x) for x in scores], np.int64))
        columns = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))

    found = of_rows.groupBy("rows", "asked").cogroup(of_queries.groupBy("rows", "asked")).applyInArrow(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
