"""Row groups as the unit of reading."""

import json

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNotNull

from corpusloom.plans import loader
from corpusloom.plans.tokenizer import CorpusTokenizer
from corpusloom.plans.training import TrainedMerge
from corpusloom.session import scratch_path
from corpusloom.sources import documents as D
from corpusloom.sources.row_groups import FilteredRowGroupReader, RowGroupReader, RowGroupStream

SHARDS, GROUPS, ROWS = 3, 7, 4


@pytest.fixture
def folder(tmp_path):
    for shard in range(SHARDS):
        texts = [f"s{shard} d{i} " + "long " * 50 for i in range(GROUPS * ROWS)]
        pq.write_table(pa.table({"other": range(len(texts)), "text": texts}), tmp_path / f"s {shard}.parquet", row_group_size=ROWS, compression="none", use_dictionary=False)
    return tmp_path


def break_groups(folder, shard, broken):
    """Overwrite the text pages of some row groups; the footer stays as it is."""
    path = folder / f"s {shard}.parquet"
    data, footer = bytearray(path.read_bytes()), pq.read_metadata(path)
    for group in broken:
        column = footer.row_group(group).column(1)
        data[column.data_page_offset : column.data_page_offset + 60] = b"\xff" * 60
    path.write_bytes(data)


def keys(scanned):
    return sorted((r.shard_idx, r.rg_idx) for r in scanned.select("shard_idx", "rg_idx").distinct().collect())


def test_scan_equals_the_other_reader(spark, folder):
    columns = ["shard_idx", "rg_idx", "row_idx", "doc_key", "text"]
    mine = D.readable(D.scan_row_groups(spark, str(folder))).select(columns).collect()
    other = D.scan_documents(spark, str(folder), row_groups=True).select(columns).collect()
    assert sorted(mine) == sorted(other) and len(mine) == SHARDS * GROUPS * ROWS
    assert D.scan_row_groups(spark, str(folder / "nowhere")).collect() == []


@pytest.mark.parametrize("start, step", [(1, 3), (0, 2), (6, 1), (9, 4)])
def test_only_chosen_groups_are_opened(spark, folder, start, step):
    """All other groups are broken: none of them is noticed."""
    chosen = list(range(start, GROUPS, step))
    for shard in range(SHARDS):
        break_groups(folder, shard, set(range(GROUPS)) - set(chosen))
    scanned = D.scan_row_groups(spark, str(folder), which="train", start=start, step=step, skip_unreadable=False)
    assert keys(scanned) == [(shard, group) for shard in range(SHARDS - 1) for group in chosen]
    assert scanned.count() == len(chosen) * ROWS * (SHARDS - 1)


@pytest.mark.parametrize("world", [1, 2, 3])
def test_a_resumed_run_opens_only_what_is_left(spark, folder, world):
    position = (1, 3)
    docs = D.scan_documents(spark, str(folder), row_groups=True)
    from corpusloom.operators.packing import resume_filter

    left = keys(docs.where(resume_filter(*position, world, D.rank_of(world))))
    for shard in range(SHARDS):
        break_groups(folder, shard, {g for g in range(GROUPS) if (shard, g) not in left})
    assert keys(D.scan_row_groups(spark, str(folder), resume=position, world=world, skip_unreadable=False)) == left


def test_large_files_are_read_by_several_tasks(folder):
    shards = f'[[0, "{folder}/s%200.parquet"]]'.replace(str(folder), folder.as_uri())
    reader = RowGroupReader({"shards": shards, "bytes_per_task": "2000"})
    parts = reader.partitions()
    found = [int(g) for part in parts for batch in reader.read(part) for g in set(batch.column("rg_idx").to_pylist())]
    assert len(parts) > 1 and sorted(found) == list(range(GROUPS))


def test_what_cannot_be_read_is_named(spark, folder):
    break_groups(folder, 1, [2, 4])
    (folder / "s 3.parquet").write_text("this is no Parquet file")
    seen = Observation("scan")
    rows = D.readable(D.scan_row_groups(spark, str(folder)), seen)
    assert rows.count() == SHARDS * GROUPS * ROWS - 2 * ROWS
    told = seen.get
    assert (told["rows"], told["failed"]) == (rows.count(), 3)
    assert sorted(f.split(":")[0] for f in told["failures"]) in (["s 1.parquet", "s 1.parquet", "s 3.parquet"], ["s 1.parquet", "s 3.parquet"])
    failures = D.scan_row_groups(spark, str(folder)).where("failure IS NOT NULL").select("shard_idx", "rg_idx").collect()
    assert sorted(map(tuple, failures), key=str) == [(1, 2), (1, 4), (3, None)]
    with pytest.raises(Exception, match="failed|Parquet|page"):
        D.scan_row_groups(spark, str(folder), skip_unreadable=False).collect()


def test_comparisons_are_pushed_to_the_reader(spark, folder):
    reader = FilteredRowGroupReader({"shards": "[[0, \"x\"], [1, \"y\"], [2, \"z\"]]"})
    rest = list(reader.pushFilters([In(("shard_idx",), (1, 2)), GreaterThan(("rg_idx",), 3), EqualTo(("text",), "a"), IsNotNull(("shard_idx",))]))
    assert rest == [EqualTo(("text",), "a"), IsNotNull(("shard_idx",))]
    assert [s for s in range(3) if reader.choice.shard(s)] == [1, 2] and [g for g in range(6) if reader.choice.group(1, g)] == [4, 5]
    for shard in range(SHARDS):
        break_groups(folder, shard, [0, 1])
    before = spark.conf.get(D.PUSH_FILTERS)
    spark.conf.set(D.PUSH_FILTERS, "true")
    try:
        found = D.scan_row_groups(spark, str(folder), skip_unreadable=False).where("rg_idx >= 2 and shard_idx = 1")
        assert found.count() == (GROUPS - 2) * ROWS
    finally:
        spark.conf.set(D.PUSH_FILTERS, before)


def test_stream_of_passes_goes_on_after_a_stop(spark, folder):
    progress, checkpoint, out = (scratch_path(spark, name) for name in ("progress", "checkpoint", "out"))
    seen = []
    for stop_after in (5, 30, None):
        docs = D.stream_row_groups(spark, str(folder), progress, groups_per_batch=4, epochs=2, stop_after=stop_after)
        query = docs.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).start()
        query.processAllAvailable()
        query.stop()
        seen.append(spark.read.parquet(out).count() // ROWS)
    assert seen == [5, 30, 2 * SHARDS * GROUPS]
    counts = spark.read.parquet(out).groupBy("epoch", "shard_idx", "rg_idx").agg(F.count("text").alias("n")).collect()
    assert {(r.epoch, r.shard_idx, r.rg_idx, r.n) for r in counts} == {(e, s, g, ROWS) for e in range(2) for s in range(SHARDS) for g in range(GROUPS)}


@pytest.mark.parametrize("resume", [None, (0, 4)])
def test_loader_over_a_folder(spark, folder, resume):
    """A resumed pass opens only what is left, and gives the same batches as reading everything."""
    tok = CorpusTokenizer((TrainedMerge(0, 111, 110, 256, 0),), None, {"<|bos|>": 257})
    docs = D.scan_documents(spark, str(folder), row_groups=True, which="train")
    expected = loader.pack_corpus(docs, tok, 2, 20, None, 2, resume=resume, key="doc_key").collect()
    if resume:
        break_groups(folder, 0, [0, 1, 2, 3, 4])
        break_groups(folder, 2, range(GROUPS))
    found = loader.pack_folder(spark, str(folder), tok, 2, 20, "train", 2, resume=resume).collect()
    assert sorted(found) == sorted(expected) and len(found) > 20


def test_a_stream_reads_small_files_together(folder, tmp_path):
    paths = [[shard, (folder / f"s%20{shard}.parquet").as_uri().replace("%25", "%")] for shard in range(SHARDS)]
    stream = RowGroupStream({"shards": json.dumps(paths), "progress": (tmp_path / "progress").as_uri(), "groups_per_batch": str(GROUPS + 3)})
    start = stream.initialOffset()
    seen = []
    for _ in range(4):
        end = stream.latestOffset()
        parts = stream.partitions(start, end)
        assert len(parts) == 1
        seen += [(r["epoch"], r["shard_idx"], r["rg_idx"], r["row_idx"]) for part in parts for batch in stream.read(part) for r in batch.to_pylist()]
        start = end
    rows = [(e, s, row // ROWS, row) for e in range(2) for s in range(SHARDS) for row in range(GROUPS * ROWS)]
    assert seen == rows[: 4 * (GROUPS + 3) * ROWS]


def test_large_files_of_a_stream_have_their_own_tasks(folder, tmp_path, monkeypatch):
    from corpusloom.sources import row_groups

    monkeypatch.setattr(row_groups, "BYTES_PER_TASK", 2000)
    paths = [[shard, (folder / f"s%20{shard}.parquet").as_uri().replace("%25", "%")] for shard in range(SHARDS)]
    stream = RowGroupStream({"shards": json.dumps(paths), "progress": (tmp_path / "progress").as_uri()})
    parts = stream.partitions(stream.initialOffset(), {"epoch": 1, "shard": 0, "group": 0})
    assert len(parts) > SHARDS and all(len(part.files) == 1 for part in parts)
    found = [(files.files[0].shard, group) for files in parts for group in files.files[0].listed]
    assert found == [(shard, group) for shard in range(SHARDS) for group in range(GROUPS)]
