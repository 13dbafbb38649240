"""Uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

Rows are numbered where they lie, in units of up to ``UNIT`` rows of one input partition. How many rows of each unit go to each shard is
drawn exactly: first for groups of about ``GROUP`` units, on the driver, then within each group by a task, from what the group got. A unit
deals out its rows by a random permutation of the labels it drew; the exchange brings the rows of a shard together, and a
random order within the shard gives each its slot. Every assignment of rows to the slots of all shards is equally likely, up
to the quality of the pseudo-random numbers.

The driver holds one row per group, so one for some 67 million rows. Rows move once; no task holds more than a unit's labels, or
sorts more than its range of a shard. The draw depends on the seed and on how the input is divided into partitions; it is fixed once
the numbered rows are written, so that lost executors change nothing.

Any row takes part, null or repeated ones too; equal texts are placed independently. An empty table gives no rows. All columns are
kept, whatever their names, but for ``shard`` and ``slot``, which are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.prefix import exclusive_prefix_sum
from corpusloom.session import materialize, width

UNIT = 1 << 16
GROUP = 1 << 10
#: Larger populations are beyond the library's hypergeometric draw.
LIBRARY_LIMIT = 10**9


def hypergeometric(pick: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """Good ones among ``drawn`` of ``good + bad``.

    Beyond the library's limit by inversion: ratios of neighbouring probabilities are multiplied up on both
    sides of the mode, so far that what is left out is below 1e-30.
    """
    if good + bad < LIBRARY_LIMIT:
        return int(pick.hypergeometric(good, bad, drawn))
    total = good + bad
    lowest, highest = max(0, drawn - bad), min(good, drawn)
    mode = min(max((drawn + 1) * (good + 1) // (total + 2), lowest), highest)
    share = good / total
    spread = math.sqrt(max(drawn * share * (1 - share) * (total - drawn) / max(total - 1, 1), 1.0))
    reach = int(13 * spread) + 60
    first, last = max(lowest, mode - reach), min(highest, mode + reach)
    k = np.arange(first, last, dtype=np.float64)
    steps = np.log(good - k) + np.log(drawn - k) - np.log(k + 1) - np.log(bad - drawn + k + 1)
    logs = np.concatenate(([0.0], np.cumsum(steps)))
    chances = np.exp(logs - logs.max())
    sums = np.cumsum(chances)
    return first + int(np.searchsorted(sums, pick.random() * sums[-1], "right"))


def communication_matrix(pick: np.random.Generator, sizes: list[int], shards: list[int]) -> list[list[int]]:
    """How many rows of each part go to each shard: exact row and column sums, drawn as by a uniform shuffle."""
    left, out = list(shards), []
    for size in sizes:
        rest, row, others = size, [], sum(left)
        for capacity in left:
            others -= capacity
            row.append(hypergeometric(pick, capacity, others, rest) if rest else 0)
            rest -= row[-1]
        left = [a - b for a, b in zip(left, row)]
        out.append(row)
    return out


def dealt_labels(seed: int, part: int, unit: int, counts: np.ndarray) -> np.ndarray:
    """The shard of each row of a unit: its labels in random order."""
    return np.random.default_rng([seed, 2, part, unit]).permutation(np.repeat(np.arange(len(counts)), counts))


def shard_sizes(rows: int, shards: int) -> list[int]:
    """Sizes at most one apart."""
    return [rows // shards + (i < rows % shards) for i in range(shards)]


def uniform_shards(df: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """``df`` with ``shard`` (from 0) and ``slot`` (from 0 without gaps in each shard)."""
    spark = df.sparkSession
    kept = [name for name in df.columns if name not in ("shard", "slot")]
    numbered = df.select(F.struct(*kept).alias("row"), F.monotonically_increasing_id().alias("at"))
    rows = materialize(numbered, "numbered")
    # The upper bits are the partition, the lower 33 the place in it.
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    rows = rows.select("row", "at", part.alias("part"), F.expr(f"(at & {(1 << 33) - 1}) div {UNIT}").alias("unit"), (place % UNIT).cast("int").alias("i"))
    drawn = _drawn_units(rows.groupBy("part", "unit").agg(F.count("*").alias("n")), shards, seed)

    @F.pandas_udf("int")
    def dealt(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        known, labels = None, None
        for parts, units, places, counts in batches:
            out = np.zeros(len(parts), np.int32)
            # Rows of a unit stand together, as they were written or as the join sorted them.
            changes = (np.diff(parts.to_numpy()) != 0) | (np.diff(units.to_numpy()) != 0)
            edges = [0, *(np.flatnonzero(changes) + 1), len(parts)]
            for begin, end in zip(edges, edges[1:]):
                if begin < end:
                    unit = int(parts.iloc[begin]), int(units.iloc[begin])
                    if unit != known:
                        known, labels = unit, dealt_labels(seed, *unit, np.asarray(counts.iloc[begin]))
                    out[begin:end] = labels[places.iloc[begin:end].to_numpy()]
            yield pd.Series(out)

    labelled = rows.join(drawn, ["part", "unit"]).select(
        "row", dealt("part", "unit", "i", "counts").alias("shard"), F.struct(F.xxhash64(F.lit(seed), "at"), "at").alias("order"), F.lit(1).cast("long").alias("one")
    )
    placed = exclusive_prefix_sum(labelled, "order", "one", "slot", ["shard"])
    return placed.select("row.*", "shard", "slot")


def _drawn_units(units: DataFrame, shards: int, seed: int) -> DataFrame:
    """``(part, unit, counts)``: rows that each unit sends to each shard."""
    spark = units.sparkSession
    units = materialize(units, "units")
    groups = units.count() // GROUP + 1
    grouped = units.withColumn("group", F.pmod(F.xxhash64("part", "unit"), F.lit(groups)))
    sums = sorted(map(tuple, grouped.groupBy("group").agg(F.sum("n")).collect()))
    sizes = shard_sizes(sum(n for _, n in sums), shards)
    matrix = communication_matrix(np.random.default_rng([seed, 0]), [n for _, n in sums], sizes)
    given = spark.createDataFrame([(group, row) for (group, _), row in zip(sums, matrix)], "group long, given array<long>")

    def draw(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["part", "unit"])
        pick = np.random.default_rng([seed, 1, int(group["group"].iloc[0])])
        group["counts"] = communication_matrix(pick, group["n"].tolist(), [int(x) for x in group["given"].iloc[0]])
        return group[["part", "unit", "counts"]]

    drawn = grouped.join(given, "group").groupBy("group").applyInPandas(draw, "part long, unit long, counts array<long>")
    # Drawn once: every reader gets the same numbers.
    return materialize(drawn, "drawn")


def write_shards(placed: DataFrame, folder: str) -> None:
    """One folder ``shard=i`` of Parquet files per shard, its rows in order of their slots."""
    ordered = placed.repartitionByRange(width(placed.sparkSession), "shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.write.partitionBy("shard").parquet(folder)
