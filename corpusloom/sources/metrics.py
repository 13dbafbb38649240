"""Run metrics: an append-only table, and the last report of each section."""

from __future__ import annotations

import datetime
import re
import sys
import uuid
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from urllib.parse import quote

from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from corpusloom.functions.text import slug

METRICS_SCHEMA = "run_id string, section string, ts timestamp, key string, value string, place int"


def format_value(value: object) -> str:
    return f"{value:.4f}" if isinstance(value, float) else str(value)


def log_metrics(
    spark: SparkSession,
    path: str,
    run_id: str,
    section: str,
    *data: Mapping[str, object] | str | None,
    ts: datetime.datetime | None = None,
) -> None:
    """Append one section to the table at ``path``: metrics and free text, in the order given.

    A row without key holds text. Empty items are left out.
    """
    ts = ts or datetime.datetime.now(datetime.timezone.utc)
    items = [item for part in data if part for item in ([(None, part)] if isinstance(part, str) else part.items())]
    rows = [
        (run_id, section, ts, key, value if key is None else format_value(value), i) for i, (key, value) in enumerate(items)
    ]
    spark.createDataFrame(rows, METRICS_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def latest_report(metrics: DataFrame) -> DataFrame:
    """Rows of the last report of each section: a later report replaces an earlier one.

    Times are reduced to one per section and joined back; no section is gathered.
    """
    last = metrics.groupBy("section").agg(F.max("ts").alias("ts"))
    return metrics.join(last, ["section", "ts"])


def report_lines(metrics: DataFrame) -> DataFrame:
    """``(slug, line)`` of each item of a report."""
    return metrics.select(slug(F.col("section")).alias("slug"), item_line().alias("line"))


def item_line() -> Column:
    return F.when(F.col("key").isNull(), F.col("value")).otherwise(F.format_string("- %s: %s", "key", "value"))


def rendered_reports(metrics: DataFrame) -> DataFrame:
    """``(slug, document)``: heading, time and items of the last report of each section, one document each.

    Items are ordered by ``place``; a section's report is what one call logged.
    """
    # Metrics take a line each; text is kept as it is.
    line = F.when(F.col("key").isNull(), item_line()).otherwise(F.concat(item_line(), F.lit("\n")))
    items = F.sort_array(F.collect_list(F.struct("place", line.alias("line"))))
    body = F.array_join(F.transform(items, lambda x: x["line"]), "")
    head = F.concat(F.lit("## "), "section", F.lit("\ntimestamp: "), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("\n\n"))
    grouped = latest_report(metrics).groupBy("section", "ts").agg(body.alias("body"))
    return grouped.select(slug(F.col("section")).alias("slug"), F.concat(head, "body", F.lit("\n")).alias("document"))


def write_report(metrics: DataFrame, folder: str) -> None:
    """One file ``<slug>.md`` per section in ``folder``; a section's earlier report is replaced."""
    spark = metrics.sparkSession
    spark.dataSource.register(ReportFiles)
    rendered_reports(metrics).write.format(ReportFiles.name()).mode("append").save(folder)


def read_report(spark: SparkSession, folder: str) -> DataFrame:
    """``(slug, document)`` of the reports in a folder."""
    files = spark.read.option("pathGlobFilter", "*.md").text(folder, wholetext=True)
    name = F.url_decode(F.url_decode(F.regexp_replace("_metadata.file_name", r"\.md$", "")))
    return files.select(name.alias("slug"), F.col("value").alias("document"))


@dataclass
class Written(WriterCommitMessage):
    """Finished files of one task: where they wait, and the name each gets."""

    files: list[tuple[str, str]]


class ReportFiles(DataSource):
    """A sink for rows ``(slug, document)``: one Markdown file each, in a folder that Arrow can open."""

    @classmethod
    def name(cls) -> str:
        return "report_files"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return ReportWriter(self.options["path"])


class ReportWriter(DataSourceWriter):
    """Tasks write hidden files; the commit gives them their names, an abort removes them."""

    def __init__(self, folder: str):
        self.folder = folder

    def store(self) -> tuple[fs.FileSystem, str]:
        # Hadoop writes local paths as file:/a, Arrow reads file:///a.
        return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", self.folder))

    def write(self, iterator: Iterator[Row]) -> Written:
        store, folder = self.store()
        store.create_dir(folder)
        files = []
        for row in iterator:
            pending = f"{folder}/_{uuid.uuid4().hex}"
            with store.open_output_stream(pending) as out:
                out.write(row["document"].encode())
            files.append((pending, f"{folder}/{quote(row['slug'], safe='')}.md"))
        return Written(files)

    def commit(self, messages: list[Written]) -> None:
        store, _ = self.store()
        for message in messages:
            for pending, final in message.files:
                store.move(pending, final)

    def abort(self, messages: list[Written | None]) -> None:
        store, _ = self.store()
        for message in filter(None, messages):
            for pending, _ in message.files:
                store.delete_file(pending)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
