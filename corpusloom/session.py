"""Session-level helpers: where intermediate tables live, and how wide to spread them."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


# The session's switch for removing a job's shuffle files at its end.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session, where
    driver and executors share one machine, may fall back to a temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        configured = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one intermediate table in the shared folder."""
    return f"{checkpoint_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside go when it is written, not when the driver happens to collect its garbage."""
    before = spark.conf.get(DROP_SHUFFLES, "false")
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(DROP_SHUFFLES, before)


def materialize(df: DataFrame, name: str, rows_per_group: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Spark's reader holds up to 4,096 rows of a row group at a time: long rows need smaller groups. Unlike ``checkpoint()`` the result is column-pruned by later readers.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_dropped(spark):
        df.write.options(**{"parquet.block.row.count.limit": rows_per_group} if rows_per_group else {}).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; survives the loss of executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def width(spark: SparkSession) -> int:
    """Partitions for tables that are small in bytes but heavy in CPU."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
