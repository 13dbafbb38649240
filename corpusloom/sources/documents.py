"""Reading document shards: listing, scanning, splits and row groups."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader

from corpusloom.session import width
from corpusloom.sources.row_groups import ROWS_PER_SHARD_LIMIT, RowGroups

SHARDS_SCHEMA = "shard_idx int, file_name string"
# The session's switch for filters of Python data sources.
PUSH_FILTERS = "spark.sql.python.filterPushdown.enabled"
# Fixed value: documents that the loader encodes at a time.
LOADER_BATCH = 128


def parquet_reader(spark: SparkSession, skip_unreadable: bool = False) -> DataFrameReader:
    reader = spark.read.option("pathGlobFilter", "*.parquet")
    return reader.option("ignoreCorruptFiles", str(skip_unreadable).lower())


def listed_files(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the Parquet files in a folder and below, as a scan of it takes them; none if it does not exist.

    This is the listing that the driver makes to plan a scan; no file is opened.
    """
    try:
        return parquet_reader(spark).schema("text string").parquet(folder).inputFiles()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def shard_paths(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the Parquet files that lie directly in a folder, by name; none if it does not exist."""
    return first_level(listed_files(spark, folder))


def first_level(files: Sequence[str]) -> list[str]:
    # A table's own folder may hold deeper ones; only the first level counts. A single file is its own folder.
    level = min((file.count("/") for file in files), default=0)
    return sorted((file for file in files if file.count("/") == level), key=shard_name)


def shard_name(path: str) -> str:
    return unquote(path.rsplit("/", 1)[-1])


def shard_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the shards of a folder, in order."""
    return [shard_name(path) for path in shard_paths(spark, folder)]


def list_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Parquet files of a folder in name order: ``(shard_idx, file_name)``."""
    return spark.createDataFrame(list(enumerate(shard_names(spark, folder))), SHARDS_SCHEMA)


def chosen_shards(paths: Sequence[str], which: str | None, start: int = 0) -> list[tuple[int, str]]:
    """Numbered paths of a split (``train``, ``val``, or None for all) from shard ``start`` on."""
    if which not in ("train", "val", None):
        raise ValueError(f"split must be 'train' or 'val', not {which!r}")
    last = len(paths) - 1
    numbered = enumerate(paths)
    return [(i, p) for i, p in numbered if i >= start and (which is None or (i == last) == (which == "val"))]


def row_group_starts(spark: SparkSession, shards: Sequence[tuple[int, str]]) -> DataFrame:
    """``(shard_idx, starts)``: the first row of each row group, from the footers of the files.

    Footers are read by the tasks, one file at a time; a file that cannot be
    read has no row. Paths must be of a store that Arrow can open.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import ArrowException, fs, parquet

        for batch in batches:
            rows = []
            for shard, path in zip(batch["shard_idx"], batch["path"]):
                store, inner = fs.FileSystem.from_uri(path)
                try:
                    footer = parquet.read_metadata(inner, filesystem=store)
                except ArrowException:
                    continue
                sizes = [footer.row_group(i).num_rows for i in range(footer.num_row_groups)]
                rows.append((shard, [sum(sizes[:i]) for i in range(len(sizes))]))
            yield pd.DataFrame(rows, columns=["shard_idx", "starts"])

    listing = spark.createDataFrame(list(shards), "shard_idx int, path string")
    return listing.repartition(max(1, min(len(shards), width(spark)))).mapInPandas(read, "shard_idx int, starts array<long>")


def scan_documents(
    spark: SparkSession,
    folder: str,
    text: str = "text",
    skip_unreadable: bool = True,
    rows_per_group: int | None = None,
    row_groups: bool = False,
    which: str | None = None,
    start_shard: int = 0,
) -> DataFrame:
    """Documents of a folder of shards, in columns ``shard_idx, row_idx, doc_key, text``.

    ``doc_key`` increases in reading order: by file name, then by row. ``which``
    and ``start_shard`` choose files from the listing: no other file is read.
    ``row_groups`` adds the row group of each row as ``rg_idx``, from the
    files' footers; ``rows_per_group`` adds one of a fixed size instead.
    Corrupt files are skipped (:func:`unreadable_shards` names them); a missing
    text column is an error.
    """
    files = listed_files(spark, folder)
    shards = chosen_shards(first_level(files), which, start_shard)
    columns = ["shard_idx", "row_idx", "doc_key", text]
    if not shards:
        docs = spark.createDataFrame([], f"file_name string, row_idx long, `{text}` string")
    else:
        # Listed paths are escaped; the reader takes them plain. Spark looks up each path by itself, so a whole folder is one path.
        paths = [folder] if len(shards) == len(files) else [unquote(path) for _, path in shards]
        require_column(spark, paths, text)
        scan = parquet_reader(spark, skip_unreadable).schema(f"`{text}` string").parquet(*paths)
        docs = scan.select(F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.row_index").alias("row_idx"), text)
    # The driver holds the listing to plan the scan, so every task can: texts are not shuffled to be numbered.
    # All lie in one folder, so their names tell them apart; the files' own names are escaped like the listed ones.
    listing = spark.createDataFrame([(i, path.rsplit("/", 1)[-1]) for i, path in shards], SHARDS_SCHEMA)
    if row_groups and shards:
        listing = listing.join(row_group_starts(spark, shards), "shard_idx")
    rows = docs.join(F.broadcast(listing), "file_name").withColumn(
        "doc_key", F.col("shard_idx").cast("long") * ROWS_PER_SHARD_LIMIT + F.col("row_idx")
    )
    if row_groups:
        before = F.filter("starts", lambda first: first <= F.col("row_idx")) if shards else F.array()
        rows = rows.withColumn("rg_idx", F.size(before) - 1)
    elif rows_per_group:
        rows = rows.withColumn("rg_idx", F.expr(f"cast(row_idx div {rows_per_group} AS int)"))
    if row_groups or rows_per_group:
        columns.insert(1, "rg_idx")
    return rows.select(*columns)


def scan_row_groups(
    spark: SparkSession,
    folder: str,
    text: str = "text",
    which: str | None = None,
    start: int = 0,
    step: int = 1,
    resume: tuple[int, int] | None = None,
    world: int = 1,
    skip_unreadable: bool = True,
) -> DataFrame:
    """Documents of chosen row groups: ``shard_idx, rg_idx, row_idx, doc_key, text, failure``; no other group is opened.

    ``start`` and ``step`` choose row groups of each shard, ``resume`` those that come after a saved ``(shard, row group)`` for each of
    ``world`` ranks. What cannot be read gives one row with its name and error in ``failure``, from the same pass:
    :func:`readable` leaves it out, and tells how many there were.
    """
    shards = chosen_shards(shard_paths(spark, folder), which, resume[0] if resume else 0)
    reader = row_group_reader(spark, spark.read, shards, text, skip_unreadable, start=start, step=step, world=world, resume=resume)
    return reader.option("pushes", spark.conf.get(PUSH_FILTERS)).load().drop("epoch")


def row_group_reader(
    spark: SparkSession, reader: DataFrameReader | DataStreamReader, shards: Sequence[tuple[int, str]], text: str, skip_unreadable: bool, **options: object
) -> DataFrameReader | DataStreamReader:
    """``reader`` set up for the row groups of numbered paths; options are left out where they are None."""
    spark.dataSource.register(RowGroups)
    given = {name: json.dumps(value) for name, value in options.items() if value is not None}
    # A folder and the listing that the driver has made; its paths are escaped, as Arrow wants them.
    paths = json.dumps([(shard, path) for shard, path in shards])
    return reader.format(RowGroups.name()).options(shards=paths, text=text, skip_unreadable=str(skip_unreadable).lower(), **given)


def readable(scanned: DataFrame, observation: Observation | None = None) -> DataFrame:
    """What a scan of row groups could read. ``observation`` counts rows and lists failures in the same pass."""
    if observation is not None:
        failures = F.sort_array(F.collect_set("failure"))
        scanned = scanned.observe(observation, F.count_if(F.col("failure").isNull()).alias("rows"), F.count("failure").alias("failed"), failures.alias("failures"))
    return scanned.where(F.col("failure").isNull()).drop("failure")


def stream_row_groups(
    spark: SparkSession,
    folder: str,
    progress: str,
    text: str = "text",
    which: str | None = None,
    groups_per_batch: int = 64,
    epochs: int | None = None,
    stop_after: int | None = None,
    skip_unreadable: bool = True,
) -> DataFrame:
    """An endless stream of passes over the row groups, ``groups_per_batch`` in each micro-batch, with the pass as ``epoch``.

    It ends after ``epochs`` passes, or stands still after ``stop_after`` row groups, if these are given. ``progress`` is a folder that belongs to
    the query's checkpoint: with both, a query goes on where it stopped, also in a later pass.
    """
    shards = chosen_shards(shard_paths(spark, folder), which)
    options = {"progress": progress} | {name: str(n) for name, n in (("epochs", epochs), ("stop_after", stop_after)) if n is not None}
    reader = row_group_reader(spark, spark.readStream, shards, text, skip_unreadable, groups_per_batch=groups_per_batch)
    return reader.options(**options).load()


def unreadable_shards(spark: SparkSession, folder: str) -> DataFrame:
    """``(shard_idx, file_name)`` of the files of a folder whose footer cannot be read."""
    shards = chosen_shards(shard_paths(spark, folder), None)
    if not shards:
        return spark.createDataFrame([], SHARDS_SCHEMA)
    return list_shards(spark, folder).join(row_group_starts(spark, shards), "shard_idx", "left_anti")


def require_column(spark: SparkSession, paths: Sequence[str], text: str) -> None:
    """Fail clearly when the files have no column for the text."""
    try:
        columns = parquet_reader(spark, True).parquet(*paths).columns
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        # The file whose footer was tried is corrupt; the executors try them all.
        columns = parquet_reader(spark, True).option("mergeSchema", "true").parquet(*paths).columns
    if text not in columns:
        raise ValueError(f"documents have no column {text!r}: {columns}")


def virtual_shards(docs: DataFrame, key: str, rows_per_shard: int, rows_per_group: int) -> DataFrame:
    """Number shards and row groups by an order key, for a corpus that is one table."""
    shard = f"cast({key} div {rows_per_shard} AS int)"
    group = f"cast({key} % {rows_per_shard} div {rows_per_group} AS int)"
    return docs.withColumns({"shard_idx": F.expr(shard), "rg_idx": F.expr(group)})


def split(docs: DataFrame, which: str, last_shard: int | None = None) -> DataFrame:
    """``train`` is all but the last shard, ``val`` the last one.

    ``last_shard`` saves a pass over the shard column when it is known.
    """
    if which not in ("train", "val"):
        raise ValueError(f"split must be 'train' or 'val', not {which!r}")
    if last_shard is None:
        last_shard = docs.agg(F.max("shard_idx")).first()[0]
    last = F.lit(-1 if last_shard is None else last_shard)
    return docs.where(F.col("shard_idx") < last if which == "train" else F.col("shard_idx") == last)


def rank_of(world: int) -> Column:
    """The rank that reads a row group; numbering restarts in each shard."""
    return (F.col("rg_idx") % world).cast("int")


def stripe(docs: DataFrame, start: int = 0, step: int = 1) -> DataFrame:
    """Row groups ``start, start + step, ...`` of each shard."""
    return docs.where((F.col("rg_idx") >= start) & ((F.col("rg_idx") - start) % step == 0))


def loader_batches(docs: DataFrame, key: str, size: int = LOADER_BATCH) -> DataFrame:
    """Number the batches of ``size`` documents within each row group.

    Rows are ranked in buckets of the order key, then offset by the earlier
    buckets, so a large row group is not sorted in one task.
    """
    from corpusloom.operators.prefix import exclusive_prefix_sum

    ranked = exclusive_prefix_sum(docs.withColumn("_one", F.lit(1).cast("long")), key, "_one", "_row", ["shard_idx", "rg_idx"])
    return ranked.withColumn("batch_idx", F.expr(f"_row div {size}")).drop("_one", "_row")
