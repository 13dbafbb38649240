"""What the registered queries share: tables, parameters and the trained tokenizer."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.patterns import CHAT_PATTERN, CHAT_SPECIALS
from corpusloom.operators.pairs import chunk_counts, words
from corpusloom.plans.tokenizer import CorpusTokenizer
from corpusloom.sources.documents import virtual_shards

Query = Callable[[SparkSession, str], DataFrame]

MERGES = 30
ROWS_PER_SHARD = 100
ROWS_PER_GROUP = 10
WORLD = 2
BATCH_ROWS = 4
BATCH_COLS = 32
WINDOW = BATCH_ROWS * BATCH_COLS + 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(*(columns or ("doc_id", "text")))


def sharded(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return virtual_shards(documents(spark, sf_dir, *columns), "doc_id", ROWS_PER_SHARD, ROWS_PER_GROUP)


def last_shard(docs: DataFrame) -> int:
    return docs.agg(F.max("shard_idx")).first()[0]


def word_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words(chunk_counts(documents(spark, sf_dir, "doc_id", "text"), CHAT_PATTERN))


_trained: dict[tuple[str, str], CorpusTokenizer] = {}


def tokenizer(spark: SparkSession, sf_dir: str) -> CorpusTokenizer:
    """The tokenizer that most queries use, trained once per session and data set."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _trained:
        size = 256 + MERGES + len(CHAT_SPECIALS)
        _trained[key] = CorpusTokenizer.train(documents(spark, sf_dir), size)
    return _trained[key]


def named(lists: pa.ListArray) -> pa.ListArray:
    """Ids as strings; those of many tokens are looked up, which takes half as long as casting each."""
    import pyarrow.compute as pc

    offsets = lists.offsets.to_numpy()
    ids = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
    low, high = (bound.as_py() for bound in pc.min_max(ids).values())
    if low is None or low < 0 or high >= len(ids):
        return lists.cast(pa.list_(pa.string()))
    names = pa.array(range(high + 1)).cast(pa.string())
    mask = lists.is_null() if lists.null_count else None
    return pa.ListArray.from_arrays(pa.array(offsets - offsets[0], pa.int32()), names.take(ids), mask=mask)


def join_lists(lists: pa.ListArray) -> Iterator[pa.Array]:
    """Each list as one string, some rows at a time."""
    import pyarrow.compute as pc

    # Naming and joining take some thirty bytes an id: so many rows at a time as have a million, or one.
    ends = lists.offsets.to_numpy()
    at = 0
    while at < len(lists):
        end = max(at + 1, int(ends.searchsorted(ends[at] + (1 << 20), "right")) - 1)
        yield pc.binary_join(named(lists.slice(at, end - at)), " ")
        at = end


def joined(ids: Column | str) -> Column:
    """Ids as one string, so that both engines compare the same type."""

    def join(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            yield from join_lists(lists)

    return F.arrow_udf(join, "string")(F.col(ids) if isinstance(ids, str) else ids)


def with_joined(df: DataFrame, *names: str) -> DataFrame:
    """What :func:`joined` gives for some columns, in their places.

    Whole rows pass through the worker. Beside a function of columns Spark queues the rows that wait for its results, in
    memory and then on disk: of many short rows that is more than the table itself.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in names:
                parts = [pa.array([], pa.string()), *join_lists(batch.column(name))]
                batch = batch.set_column(batch.schema.get_field_index(name), name, pa.concat_arrays(parts))
            yield batch

    kinds = ", ".join(f"`{name}` {'string' if name in names else kind}" for name, kind in df.dtypes)
    return df.mapInArrow(join, kinds)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
