"""Running totals over an ordered table: one sort by key ranges, offsets from one small table."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

from corpusloom.session import materialize, width

Adder = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

# Rows that a task adds up at a time.
BUCKET = 1 << 12
# The range of a row; whether its group may have begun in an earlier one; the first and the last row of a range.
MARKS = {"_part": IntegerType(), "_open": BooleanType(), "_head": BooleanType(), "_tail": BooleanType()}


def exclusive_prefix_sum(
    df: DataFrame,
    key: str,
    value: str,
    out: str,
    within: list[str] | None = None,
    bucket: int = BUCKET,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    around: tuple[Callable[[Adder], Adder], StructType, int] | None = None,
) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows before, by ``key``, per group ``within``.

    Rows are dealt by ranges of (group, key) and sorted there; each range adds up
    its rows, ``bucket`` at a time, and is written to the shared folder. A group
    that began in an earlier range gets what that one holds of it: an offset per
    range, from its first and last row. No task sees more than its range,
    whatever share of the rows a group has. Null values count as 0; rows with equal keys are
    taken in any order. The result is read in the order of the ranges.

    The rows are read twice, to find the ranges and to deal them out. What is costly to compute belongs in
    ``prepare``: it is applied to the dealt and sorted rows, once, and must not move them. ``around`` does more in the
    same pass: it gets the function that adds up, may compute columns before it, and after it join neighbouring rows of a group,
    whose ``value`` is the sum and whose marks ``MARKS`` are those of the first and last row. With it stand the columns that it gives besides
    ``out`` and the marks, and how many of its rows make a row group.
    """
    within = within or []
    order = [*within, key]
    ranged = df.repartitionByRange(width(df.sparkSession), *order).sortWithinPartitions(*order)
    ranged = prepare(ranged) if prepare else ranged
    added = [StructField(name, kind) for name, kind in [(out, LongType()), *MARKS.items()]]
    wrapped, columns, rows_per_group = around or (lambda adds: adds, ranged.schema, None)
    schema = StructType([field for field in columns.fields if field.name != out] + added)
    stored = materialize(ranged.mapInArrow(wrapped(_adder(within, value, out, bucket)), schema), "running", rows_per_group)
    edges = stored.where(F.col("_head") | F.col("_tail"))
    heads = edges.where("_head").select(*within, "_part", F.lit(0).cast("long").alias("_total"), F.lit(True).alias("_asks"))
    held = F.col(out) + F.coalesce(F.col(value), F.lit(0))
    tails = edges.where("_tail").select(*within, "_part", held.alias("_total"), F.lit(False).alias("_asks"))
    # At most two rows per range.
    earlier = Window.partitionBy(*(within or [F.lit(0)])).orderBy("_part", F.desc("_asks")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = heads.unionByName(tails).withColumn("_offset", F.sum("_total").over(earlier)).where("_asks").select("_part", "_offset")
    joined = stored.join(F.broadcast(offsets), "_part", "left")
    begun = F.when(F.col("_open"), F.coalesce("_offset", F.lit(0))).otherwise(0)
    return joined.withColumn(out, F.col(out) + begun).select(*(field.name for field in schema.fields[: -len(MARKS)]))


def _adder(within: list[str], value: str, out: str, bucket: int):
    """The running sums of one sorted range, and marks for its first group, first row and last row."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        group, total, opened, held = None, 0, True, None
        for batch in batches:
            for at in range(0, batch.num_rows, bucket):
                piece = batch.slice(at, bucket)
                keys = [piece.column(name) for name in within]
                first = tuple(column[0].as_py() for column in keys)
                starts = _changes(keys, piece.num_rows)
                begins = held is not None and first != group
                opened = opened and not begins
                total = 0 if begins else total
                amounts = pc.fill_null(piece.column(value).cast(pa.int64()), 0).to_numpy(zero_copy_only=False)
                sums = np.concatenate(([0], np.cumsum(amounts)))
                # What had been added up where the row's group began; the first group goes on from the piece before.
                base = np.maximum.accumulate(np.where(starts, np.arange(len(starts)), 0))
                before = sums[:-1] - sums[base] + np.where(base == 0, total, 0)
                places = np.flatnonzero(starts)
                open_rows = np.arange(len(starts)) < (places[0] if len(places) else len(starts))
                head = np.zeros(len(starts), bool)
                if held is not None:
                    yield _marked(*held)
                else:
                    head[0] = True
                held = (piece, out, before, part, open_rows & opened, head)
                opened = opened and not len(places)
                group = tuple(column[-1].as_py() for column in keys)
                total = int(before[-1] + amounts[-1])
        if held is not None:
            yield _marked(*held, last=True)

    return add


def _changes(keys: list[pa.Array], rows: int) -> np.ndarray:
    """Where a row's group differs from that of the row before; the first row counts as no change."""
    changed = np.zeros(rows, bool)
    for column in keys:
        a, b = column.slice(1), column.slice(0, rows - 1)
        differs = pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.xor(pc.is_null(a), pc.is_null(b)))
        changed[1:] |= differs.to_numpy(zero_copy_only=False)
    return changed


def _marked(piece, out, before, part, open_rows, head, last=False) -> pa.RecordBatch:
    tail = np.zeros(len(before), bool)
    tail[-1] = last
    columns = {name: column for name, column in zip(piece.schema.names, piece.columns) if name != out}
    columns |= {out: pa.array(before), "_part": pa.array(np.full(len(before), part, "int32"))}
    columns |= {"_open": pa.array(open_rows), "_head": pa.array(head), "_tail": pa.array(tail)}
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def within_budget(docs: DataFrame, key: str, size: str, budget: int) -> DataFrame:
    """Leading documents until their total size exceeds ``budget``; the crossing one is kept."""
    return exclusive_prefix_sum(docs, key, size, "_before").where(F.col("_before") <= budget).drop("_before")


cloudpickle.register_pickle_by_value(sys.modules[__name__])
