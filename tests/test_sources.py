import datetime
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from corpusloom.plans.tokenizer import CorpusTokenizer
from corpusloom.plans.training import TrainedMerge
from corpusloom.session import checkpoint_dir, scratch_path
from corpusloom.sources import documents as D
from corpusloom.sources import metrics, model_store


@pytest.fixture
def folder(tmp_path):
    for shard in (2, 0, 1):
        table = pa.table({"text": [f"s{shard} d{i}" for i in range(5)], "other": range(5)})
        pq.write_table(table, tmp_path / f"shard_{shard:05d}.parquet", row_group_size=2)
    pq.write_table(pa.table({"text": ["hidden"]}), tmp_path / "shard_00009.parquet.tmp")
    return tmp_path


def test_listing(spark, folder):
    rows = D.list_shards(spark, str(folder)).orderBy("shard_idx").collect()
    assert [tuple(r) for r in rows] == [(i, f"shard_{i:05d}.parquet") for i in range(3)]
    assert D.list_shards(spark, str(folder / "nowhere")).count() == 0
    assert D.scan_documents(spark, str(folder / "nowhere")).count() == 0


def test_scan_order_groups_and_pruning(spark, folder):
    docs = D.scan_documents(spark, str(folder), rows_per_group=2)
    rows = docs.orderBy("doc_key").collect()
    assert [r.text for r in rows] == [f"s{s} d{i}" for s in range(3) for i in range(5)]
    assert [(r.shard_idx, r.rg_idx) for r in rows] == [(s, i // 2) for s in range(3) for i in range(5)]
    plan = docs._jdf.queryExecution().toString()
    assert "ReadSchema: struct<text:string" in plan and "other" not in plan


@pytest.mark.parametrize("broken", [0, 1, 2])
def test_corrupt_file_is_skipped(spark, folder, broken):
    with open(folder / f"shard_{broken:05d}.parquet", "wb") as f:
        f.write(b"not a parquet file")
    docs = D.scan_documents(spark, str(folder))
    assert {r.shard_idx for r in docs.collect()} == {0, 1, 2} - {broken}
    with pytest.raises(Exception):
        D.scan_documents(spark, str(folder), skip_unreadable=False).collect()


def test_missing_text_column_is_an_error(spark, folder):
    with pytest.raises(ValueError, match="no column 'body'"):
        D.scan_documents(spark, str(folder), text="body")


def files_read(df):
    return df.select(F.input_file_name()).distinct().count(), len(df.inputFiles())


def test_only_chosen_files_are_read(spark, folder):
    val = D.scan_documents(spark, str(folder), which="val")
    assert files_read(val) == (1, 1) and {r.shard_idx for r in val.collect()} == {2}
    train = D.scan_documents(spark, str(folder), which="train", start_shard=1)
    assert files_read(train) == (1, 1) and [r.text for r in train.orderBy("doc_key").collect()] == [f"s1 d{i}" for i in range(5)]
    with pytest.raises(ValueError):
        D.scan_documents(spark, str(folder), which="test")


def test_texts_are_not_shuffled_to_be_numbered(spark, folder):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = D.scan_documents(spark, str(folder), row_groups=True)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan.split("BroadcastExchange")[0]


def test_folders_below_do_not_count(spark, folder):
    for name in ("a", "b"):
        (folder / f"lang={name}").mkdir()
        pq.write_table(pa.table({"text": ["x"]}), folder / f"lang={name}" / "shard_00000.parquet")
    assert D.scan_documents(spark, str(folder)).count() == 15


def test_row_groups_of_any_size(spark, tmp_path):
    schema = pa.schema([("text", pa.string())])
    for name, sizes in (("a b", (3, 1, 4)), ("c", (2, 5))):
        with pq.ParquetWriter(tmp_path / f"{name}.parquet", schema) as writer:
            for size in sizes:
                writer.write_table(pa.table({"text": [f"{name}{size}"] * size}, schema))
    rows = D.scan_documents(spark, str(tmp_path), row_groups=True).orderBy("doc_key").collect()
    assert [(r.shard_idx, r.rg_idx) for r in rows] == [(0, 0)] * 3 + [(0, 1)] + [(0, 2)] * 4 + [(1, 0)] * 2 + [(1, 1)] * 5
    (tmp_path / "b.parquet").write_bytes(b"nothing")
    assert [tuple(r) for r in D.unreadable_shards(spark, str(tmp_path)).collect()] == [(1, "b.parquet")]


def test_split(spark, folder):
    docs = D.scan_documents(spark, str(folder))
    assert D.split(docs, "train").count() == 10 and D.split(docs, "val").count() == 5
    one = docs.where("shard_idx = 0")
    assert D.split(one, "train").count() == 0 and D.split(one, "val").count() == 5
    assert D.split(docs.where("shard_idx > 7"), "train").count() == 0
    with pytest.raises(ValueError):
        D.split(docs, "test")


def test_ranks_partition_the_row_groups(spark):
    docs = D.virtual_shards(spark.range(230).withColumnRenamed("id", "doc_id"), "doc_id", 100, 10)
    parts = [D.stripe(docs, r, 3).collect() for r in range(3)]
    assert sorted(x.doc_id for p in parts for x in p) == list(range(230))
    assert all(x.rg_idx % 3 == r for r, p in enumerate(parts) for x in p)


@pytest.mark.parametrize("size", [1, 3, 128])
def test_loader_batches(spark, size):
    docs = D.virtual_shards(spark.range(57).withColumnRenamed("id", "doc_id"), "doc_id", 20, 7)
    for r in D.loader_batches(docs, "doc_id", size).collect():
        assert r.batch_idx == (r.doc_id % 20 % 7) // size


def tokenizer():
    merges = (TrainedMerge(0, 97, 98, 256, 0), TrainedMerge(1, 256, 99, 257, 0))
    return CorpusTokenizer(merges, r"'(?i:x)|\p{L}+| ?\s+", {"<|bos|>": 300, "<two words>": 301})


def test_parquet_round_trip(spark):
    path = scratch_path(spark, "tokenizer")
    model_store.save(tokenizer(), spark, path)
    assert model_store.load(spark, path) == tokenizer()


def test_text_round_trip(spark):
    path = scratch_path(spark, "tokenizer")
    model_store.save_text(tokenizer(), spark, path, format_name="other")
    assert model_store.load_text(spark, f"{path}.model") == tokenizer()
    lines = [r.value for r in spark.read.text(f"{path}.vocab").collect()]
    assert "[ab][c] -> [abc] 257" in lines and len(lines) == 260
    with pytest.raises(ValueError):
        model_store.load_text(spark, path)
    with pytest.raises(NotImplementedError):
        permuted = CorpusTokenizer((), "x", {}, tuple(range(256)))
        model_store.save_text(permuted, spark, path)


def test_model_version_is_checked(spark, tmp_path):
    path = tmp_path / "old.model"
    path.write_text("bpe v2\n\n0\n97 98\n")
    with pytest.raises(ValueError, match="version"):
        model_store.load_text(spark, str(path))
    path.write_text("bpe v1\n\n0\n97 98\n256 99\n")
    assert [m.new_id for m in model_store.load_text(spark, str(path)).merges] == [256, 257]


def test_metrics(spark):
    path = scratch_path(spark, "metrics")
    at = lambda minute: datetime.datetime(2024, 1, 1, 0, minute)
    metrics.log_metrics(spark, path, "r", "Tokenizer Training", {"loss": 0.5, "size": 7}, ts=at(1))
    metrics.log_metrics(spark, path, "r", "Tokenizer Training", {"loss": 0.25}, ts=at(2))
    metrics.log_metrics(spark, path, "r", "Other", {"path": "x"}, ts=at(1))
    lines = metrics.report_lines(metrics.latest_report(spark.read.parquet(path))).collect()
    assert {tuple(r) for r in lines} == {("tokenizer-training", "- loss: 0.2500"), ("other", "- path: x")}
    metrics.log_metrics(spark, path, "r", "Other", {"a": 1.5, "b": "c"}, None, "free text\n", {}, ts=at(3))
    reports = dict(map(tuple, metrics.rendered_reports(spark.read.parquet(path)).collect()))
    assert reports["other"] == "## Other\ntimestamp: 2024-01-01 00:03:00\n\n- a: 1.5000\n- b: c\nfree text\n\n"
    out = scratch_path(spark, "report")
    metrics.write_report(spark.read.parquet(path), out)
    written = dict(map(tuple, metrics.read_report(spark, out).collect()))
    assert written == reports and written.keys() == {"tokenizer-training", "other"}
    metrics.log_metrics(spark, path, "r", "Other", {"a": 2}, ts=at(4))
    metrics.log_metrics(spark, path, "r", "A 100% slug/é", {"a": 3}, ts=at(4))
    metrics.write_report(spark.read.parquet(path), out)
    again = dict(map(tuple, metrics.read_report(spark, out).collect()))
    assert again.keys() == {"tokenizer-training", "other", "a-100%-slug/é"}
    assert again["other"].endswith("\n\n- a: 2\n\n") and again["tokenizer-training"] == written["tokenizer-training"]


def test_report_files_of_a_failed_write_are_removed(tmp_path):
    writer = metrics.ReportWriter(str(tmp_path))
    done = writer.write(iter([Row(slug="a", document="x")]))
    writer.abort([done, None])
    assert list(tmp_path.iterdir()) == []


def test_checkpoint_dir_is_kept(spark):
    assert checkpoint_dir(spark) == checkpoint_dir(spark)
    assert os.path.basename(os.path.dirname(scratch_path(spark, "x"))) == "tables"


def test_oversized_models_are_refused(spark, monkeypatch):
    lines = [(0, "bpe v1"), (1, ""), (2, "0"), *((3 + i, "97 98") for i in range(9))]
    frame = spark.createDataFrame(lines, "line_no int, line string")
    assert len(model_store.parse_model(frame).merges) == 9
    monkeypatch.setattr(model_store.S, "MAX_TOKENS", 5)
    with pytest.raises(ValueError, match="more lines"):
        model_store.parse_model(frame)
