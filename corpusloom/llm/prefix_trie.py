"""Trie of conversations: every distinct beginning is a node with its members, children, leaves and shared text.

Conversations become sequences of turn hashes, cut into blocks of ``BLOCK`` turns: a block is keyed by the hash of all
turns before it, so a conversation of any length is many short rows. Equal blocks are counted once, then sorted by key
ranges. A task holds a run of sorted blocks; the common prefixes of neighbours go into a sparse table for range minima, and
each new prefix searches the left and right end of its interval by halving, on its own: no stack, no order among them. Sums and minima
over intervals come from running sums and a second sparse table. A node that several runs share is put together by its hash.

Subtree figures are sums over members: each node is owned by its smallest member, and what a member owns lies below every
node that it does not own. So one pass finds the owners, a second one adds up what the members own.

Nulls: turns without ``conv_id`` take no part; null role or text is empty; a null turn stands before all others. Turns with
equal numbers (also repeated rows) follow by role, then by the MD5 of the text, and all count. An empty table has no
nodes, not even a root. Other columns are ignored. Texts are read once, where they lie; only hashes and lengths move.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.prefix import exclusive_prefix_sum
from corpusloom.session import materialize, width

#: Turns of a block, and turns that a task holds at a time.
BLOCK = 256
TURNS_AT_A_TIME = 1 << 18

NODE = ["node1", "node2"]
PARENT = ["parent1", "parent2"]


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, pos, role, digest, n_bytes)``: each turn's place in its conversation, from 0, and the MD5 of its text."""
    text = F.coalesce("text", F.lit(""))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.unhex(F.md5(text)).alias("digest")).alias("place"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.lit(1).cast("long").alias("one"),
    )
    placed = exclusive_prefix_sum(turns, "place", "one", "pos", ["conv_id"])
    return placed.select("conv_id", "pos", "place.role", "place.digest", "n_bytes")


def with_heads_of(turns: DataFrame, group: Column, borrowed: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like another: the first ``borrowed`` turns of conversation ``group``, then their own after as many.

    ``turns`` come from :func:`numbered_turns`; both columns are made from ``conv_id`` alone, and ``borrowed`` is at most
    ``most``. A shorter conversation lends all its turns, an absent one none. Returns the new turns and all
    ``conv_id``: some may have no turns left.
    """
    turns = materialize(turns, "turns")
    said = F.struct("pos", "role", "digest", "n_bytes")
    heads = turns.where(F.col("pos") < most).groupBy(F.col("conv_id").alias("lender")).agg(F.sort_array(F.collect_list(said)).alias("head"))
    convs = turns.select("conv_id").distinct().select("conv_id", group.alias("lender"), borrowed.cast("int").alias("h"))
    lent = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.array().cast("array<struct<pos:bigint,role:string,digest:binary,n_bytes:bigint>>"))
    convs = materialize(convs.join(heads, "lender", "left").select("conv_id", "h", lent.alias("head")), "heads")
    own = turns.where(F.col("pos") >= borrowed).join(convs.select("conv_id", F.size("head").alias("k"), "h"), "conv_id")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("k")).alias("pos"), "role", "digest", "n_bytes")
    return own.unionByName(convs.select("conv_id", F.inline("head"))), convs.select("conv_id")


def trie(turns: DataFrame, all_ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes of the trie, and the node at which each conversation ends.

    ``turns`` has unique ``(conv_id, pos)`` from 0 without gaps, ``all_ids`` every conv_id once. Nodes: ``node1, node2`` (hash),
    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` (bytes that the members of the subtree share). Ends: ``node1, node2, conv_id``.
    """
    blocks = materialize(_blocks(turns, all_ids), "blocks")
    ends = blocks.where("last").select(F.col("end1").alias("node1"), F.col("end2").alias("node2"), "conv_id")

    key = ["block", "before1", "before2", "path"]
    classes = blocks.groupBy(*key).agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id"), F.min("bytes_before").alias("bytes_before"))
    found = _nodes_of_runs(classes.withColumns({name: F.lit(0).cast("long") for name in SUMMED[1:]} | {"total": F.lit(0).cast("long"), "owned": F.lit(0).cast("long")}))
    nodes = materialize(found.select(*NODE, *PARENT, "depth", "n_bytes", F.col("least.conv_id").alias("conv_id")), "nodes")

    children = nodes.where("depth > 0").groupBy(F.col("parent1").alias("node1"), F.col("parent2").alias("node2")).agg(F.count("*").alias("n_children"))
    leaf = F.when(F.col("n_children").isNull(), 1).otherwise(0)
    owned = nodes.join(children, NODE, "left").groupBy("conv_id").agg(F.sum("n_bytes").alias("owned"), F.sum(leaf).alias("leaves"))

    shares = blocks.join(owned, "conv_id", "left").withColumns({name: F.coalesce(name, F.lit(0)) for name in ("owned", "leaves")})
    classes = shares.groupBy(*key).agg(
        F.count("*").alias("n"),
        F.min(F.struct("conv_id", "total", "owned")).alias("least"),
        F.sum("total").alias("totals"),
        F.sum("owned").alias("owneds"),
        F.sum("leaves").alias("leaves"),
        F.min("bytes_before").alias("bytes_before"),
    )
    found = _nodes_of_runs(classes.select("*", "least.*").drop("least"))
    shared = F.expr("totals - n * bytes_above - (owneds - least.owned) - (least.total - bytes_above)")
    figures = found.select(*NODE, *PARENT, "depth", F.col("least.conv_id").alias("conv_id"), F.col("n").alias("n_convs"), F.col("leaves").alias("n_leaves"), shared.alias("saved_tokens"))
    figures = figures.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    # A node with very many children is one key of this join: its skew handling splits them.
    parents = nodes.select(F.col("node1").alias("parent1"), F.col("node2").alias("parent2"), F.col("conv_id").alias("parent_conv_id"))
    joined = figures.join(parents, PARENT, "left").withColumn("parent_conv_id", F.when(F.col("depth") > 0, F.col("parent_conv_id")))
    return joined.select(*NODE, "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"), ends


def _blocks(turns: DataFrame, all_ids: DataFrame) -> DataFrame:
    """Blocks of each conversation: hash of what stands before and at the end, bytes before and in all, and the block's path.

    A prefix is hashed as the exclusive or of its turns' hashes, which contain their places.
    """
    hashed = turns.select(
        "conv_id",
        "pos",
        F.xxhash64("pos", "role", "digest").alias("h1"),
        F.xxhash64("digest", F.lit(1), "role", "pos").alias("h2"),
        F.col("n_bytes").alias("b"),
    )
    some = hashed.groupBy("conv_id", F.expr(f"pos div {BLOCK}").alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "h1", "h2", "b"))).alias("path"),
        F.expr("bit_xor(h1)").alias("x1"),
        F.expr("bit_xor(h2)").alias("x2"),
        F.sum("b").alias("bytes"),
    )
    some = some.withColumn("path", F.transform("path", lambda x: F.struct(x["h1"].alias("h1"), x["h2"].alias("h2"), x["b"].alias("b"))))
    whole = Window.partitionBy("conv_id")
    until = whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda column: F.coalesce(column, F.lit(0).cast("long"))
    some = some.select(
        "conv_id",
        "block",
        "path",
        zero(F.expr("bit_xor(x1)").over(until)).alias("before1"),
        zero(F.expr("bit_xor(x2)").over(until)).alias("before2"),
        zero(F.sum("bytes").over(until)).alias("bytes_before"),
        F.expr("bit_xor(x1)").over(whole).alias("end1"),
        F.expr("bit_xor(x2)").over(whole).alias("end2"),
        F.sum("bytes").over(whole).alias("total"),
        (F.col("block") == F.max("block").over(whole)).alias("last"),
    )
    none = all_ids.join(turns.select("conv_id").distinct(), "conv_id", "left_anti")
    zeros = {name: F.lit(0).cast("long") for name in ("block", "before1", "before2", "bytes_before", "end1", "end2", "total")}
    empty = none.withColumns(zeros | {"path": F.array().cast("array<struct<h1:bigint,h2:bigint,b:bigint>>"), "last": F.lit(True)})
    return some.unionByName(empty)


SUMMED = ["n", "totals", "owneds", "leaves"]
RUN_COLUMNS = ["block", "before1", "before2", "path", "bytes_before", "conv_id", "total", "owned", *SUMMED]
PARTIAL = ", ".join(f"{name} long" for name in [*NODE, *PARENT, "depth", "n_bytes", "bytes_above", "conv_id", "total", "owned", *SUMMED])


def _nodes_of_runs(classes: DataFrame) -> DataFrame:
    """Nodes of distinct blocks: partial figures of sorted runs, put together by hash."""
    order = ["before1", "before2", "path"]
    runs = classes.select(*RUN_COLUMNS).repartitionByRange(width(classes.sparkSession), *order).sortWithinPartitions(*order)
    partial = runs.mapInArrow(_figures_of_runs, PARTIAL)
    same = [F.first(name).alias(name) for name in (*PARENT, "depth", "n_bytes", "bytes_above")]
    return partial.groupBy(*NODE).agg(*same, F.min(F.struct("conv_id", "total", "owned")).alias("least"), *(F.sum(name).alias(name) for name in SUMMED))


def _figures_of_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, turns = [], 0
    for batch in batches:
        # Blocks are short, so a slice of BLOCK rows stays far below the limit.
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            held.append(part)
            turns += pc.sum(pc.list_value_length(part.column("path"))).as_py() + part.num_rows
            if turns >= TURNS_AT_A_TIME:
                yield node_figures(pa.Table.from_batches(held))
                held, turns = [], 0
    if held:
        yield node_figures(pa.Table.from_batches(held))


def node_figures(run: pa.Table) -> pa.RecordBatch:
    """Partial figures of all nodes in a run of sorted, distinct blocks."""
    run = run.combine_chunks()
    get = {name: run.column(name).to_numpy() for name in RUN_COLUMNS if name != "path"}
    path = run.column("path").combine_chunks()
    path = path.chunk(0) if isinstance(path, pa.ChunkedArray) else path
    h1, h2, b = (x.to_numpy(zero_copy_only=False) for x in path.flatten().flatten())
    size = pc.list_value_length(path).to_numpy(zero_copy_only=False).astype(np.int64)
    start = np.concatenate(([0], np.cumsum(size)))
    lcp = common_prefixes(np.stack([h1, h2]), start, (get["before1"], get["before2"]))

    # Each distinct prefix once: those that a block does not share with the block before it.
    fresh = size - lcp
    row = np.repeat(np.arange(len(size)), fresh)
    depth = np.arange(len(row)) - np.repeat(np.cumsum(fresh) - fresh, fresh) + lcp[row] + 1
    left, right = extents(lcp, row, depth)
    at = start[row] + depth - 1

    hashes = []
    for h, before in ((h1, get["before1"]), (h2, get["before2"])):
        seen = np.concatenate(([0], np.bitwise_xor.accumulate(h))) if len(h) else np.zeros(1, np.int64)
        hashes.append(before[row] ^ seen[at + 1] ^ seen[start[row]])
    seen = np.concatenate(([0], np.cumsum(b)))
    least = smallest(get["conv_id"], left, right)
    out = {
        "node1": hashes[0],
        "node2": hashes[1],
        "parent1": hashes[0] ^ h1[at],
        "parent2": hashes[1] ^ h2[at],
        "depth": get["block"][row] * BLOCK + depth,
        "n_bytes": b[at],
        "bytes_above": get["bytes_before"][row] + seen[at] - seen[start[row]],
        "conv_id": get["conv_id"][least],
        "total": get["total"][least],
        "owned": get["owned"][least],
    }
    for name in SUMMED:
        sums = np.concatenate(([0], np.cumsum(get[name])))
        out[name] = sums[right] - sums[left]
    # The root belongs to no block: all first blocks are below it.
    first = np.flatnonzero(get["block"] == 0)
    if len(first):
        best = first[np.argmin(get["conv_id"][first])]
        root = {name: 0 for name in out} | {name: get[name][best] for name in ("conv_id", "total", "owned")} | {name: get[name][first].sum() for name in SUMMED}
        out = {name: np.append(values, root[name]) for name, values in out.items()}
    return pa.RecordBatch.from_arrays([pa.array(values, pa.int64()) for values in out.values()], names=list(out))


def common_prefixes(items: np.ndarray, start: np.ndarray, keys: tuple[np.ndarray, ...]) -> np.ndarray:
    """Items that each sequence shares with the one before it; none across keys, none for the first.

    ``items`` has one column per item, ``start`` tells where each sequence begins (one more at the end).
    """
    size = np.diff(start)
    both = np.zeros(len(size), np.int64)
    both[1:] = np.minimum(size[1:], size[:-1])
    for key in keys:
        both[1:][key[1:] != key[:-1]] = 0
    row = np.repeat(np.arange(len(size)), both)
    place = np.arange(len(row)) - np.repeat(np.cumsum(both) - both, both)
    differs = (items[:, start[row] + place] != items[:, start[row - 1] + place]).any(axis=0)
    shared = both.copy()
    where = np.flatnonzero(differs)
    # The first difference of a row is the last one written when taken backwards.
    shared[row[where[::-1]]] = place[where[::-1]]
    return shared


def sparse_table(values: np.ndarray) -> list[np.ndarray]:
    """Minima of all runs of 1, 2, 4, ... values, by where they begin."""
    table = [values]
    while (step := 1 << (len(table) - 1)) * 2 <= len(values):
        table.append(np.minimum(table[-1][:-step], table[-1][step:]))
    return table


def extents(lcp: np.ndarray, row: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each (row, depth) the interval of rows that share that prefix, by two searches in range minima."""
    table = sparse_table(lcp)
    left, right = row.copy(), row + 1
    for level in range(len(table) - 1, -1, -1):
        step, minima = 1 << level, table[level]
        begin = left - step + 1
        fits = begin >= 0
        left -= step * (fits & (minima[np.where(fits, begin, 0)] >= depth))
        fits = right + step <= len(lcp)
        right += step * (fits & (minima[np.where(fits, right, 0)] >= depth))
    return left, right


def smallest(values: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Where the smallest value of each interval stands; values are unique within an interval."""
    order = np.argsort(values, kind="stable")
    rank = np.empty(len(values), np.int64)
    rank[order] = np.arange(len(values))
    table = sparse_table(rank)
    level = np.frexp((right - left).astype(float))[1] - 1
    best = np.zeros(len(left), np.int64)
    for k, minima in enumerate(table):
        mine = np.flatnonzero(level == k)
        best[mine] = np.minimum(minima[left[mine]], minima[right[mine] - (1 << k)])
    return order[best] if len(best) else best


def joined_ids(ends: DataFrame) -> DataFrame:
    """``(node1, node2, sha256)``: of each node's decimal conv_ids in ascending order, joined by commas.

    Ids are sorted by ranges and joined there; the texts of a node then pass one task one after the other, never all at once.
    """
    order = [*NODE, "conv_id"]
    ranged = ends.select(*order).repartitionByRange(width(ends.sparkSession), *order).sortWithinPartitions(*order)
    texts = ranged.mapInArrow(_joined, "node1 long, node2 long, conv_id long, ids string")
    return texts.repartition(*NODE).sortWithinPartitions(*order).mapInArrow(_hashed, "node1 long, node2 long, sha256 string")


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            a, b, ids = (batch.column(name) for name in (*NODE, "conv_id"))
            keys = np.stack([a.to_numpy(), b.to_numpy()])
            first = np.concatenate(([0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1))
            lists = pa.ListArray.from_arrays(pa.array(np.append(first, batch.num_rows), pa.int32()), ids.cast(pa.string()))
            at = pa.array(first)
            yield pa.RecordBatch.from_arrays([a.take(at), b.take(at), ids.take(at), pc.binary_join(lists, ",")], names=[*NODE, "conv_id", "ids"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    node, state, done = None, None, []

    def finished() -> pa.RecordBatch:
        columns = list(zip(*done))
        done.clear()
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2])], names=[*NODE, "sha256"])

    for batch in batches:
        for a, b, ids in zip(*(batch.column(name).to_pylist() for name in (*NODE, "ids"))):
            if node == (a, b):
                state.update(b"," + ids.encode())
                continue
            if node is not None:
                done.append((*node, state.hexdigest()))
            node, state = (a, b), hashlib.sha256(ids.encode())
        if done:
            yield finished()
    if node is not None:
        done.append((*node, state.hexdigest()))
        yield finished()

