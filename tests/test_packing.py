import random
import time

import golden
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import packing
from corpusloom.operators.prefix import exclusive_prefix_sum, within_budget
from corpusloom.plans import loader
from corpusloom.plans.tokenizer import CorpusTokenizer
from corpusloom.plans.training import TrainedMerge
from corpusloom.sources.documents import rank_of, virtual_shards

SHARD, GROUP, DOCS = 12, 5, 53


@pytest.fixture(scope="module")
def token_lists():
    random.seed(11)
    return [[random.randrange(300) for _ in range(random.choice([0, 1, 2, 7, 30, 260]))] for _ in range(DOCS)]


def encoded(spark, token_lists, world):
    df = spark.createDataFrame(list(enumerate(token_lists)), "doc_id long, ids array<int>").repartition(5)
    return virtual_shards(df, "doc_id", SHARD, GROUP).withColumn("rank", rank_of(world))


def groups(token_lists):
    found = {}
    for i, ids in enumerate(token_lists):
        found.setdefault((i // SHARD, i % SHARD // GROUP), []).append(ids)
    return [(s, g, docs) for (s, g), docs in sorted(found.items())]


@pytest.mark.parametrize("bucket", [2, 7, 4096])
def test_prefix_sum(spark, bucket):
    random.seed(5)
    rows = [(k, random.choice("ab"), random.randrange(-3, 9)) for k in random.sample(range(1000), 80)]
    df = spark.createDataFrame(rows, "k long, g string, v long").repartition(6)
    got = {r.k: r.s for r in exclusive_prefix_sum(df, "k", "v", "s", ["g"], bucket).collect()}
    assert got == {k: sum(v for j, h, v in rows if h == g and j < k) for k, g, _ in rows}
    alone = {r.k: r.s for r in exclusive_prefix_sum(df, "k", "v", "s", bucket=bucket).collect()}
    assert alone == {k: sum(v for j, _, v in rows if j < k) for k, _, _ in rows}


def test_prefix_sum_with_nulls_and_one_large_group(spark):
    rows = [(k, None if k % 3 else "g", None if k % 11 == 0 else k, f"t{k}") for k in range(3000)]
    df = spark.createDataFrame(rows, "k long, g string, v int, s string").repartition(7)
    got = {r.k: (r.p, r.s) for r in exclusive_prefix_sum(df, "k", "v", "p", ["g"], 64).collect()}
    sums, expected = {}, {}
    for k, g, v, s in rows:
        expected[k] = (sums.get(g, 0), s)
        sums[g] = sums.get(g, 0) + (v or 0)
    assert got == expected


def test_prefix_sum_has_no_self_join(spark):
    df = spark.range(1000).withColumnRenamed("id", "k").withColumn("v", F.lit(1))
    plan = exclusive_prefix_sum(df, "k", "v", "s")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Range (" not in plan


def test_prefix_sum_of_nothing(spark):
    df = spark.createDataFrame([], "k long, v long")
    assert exclusive_prefix_sum(df, "k", "v", "s").count() == 0


def test_budget_keeps_the_crossing_document(spark):
    df = spark.createDataFrame([(i, 10) for i in range(10)], "doc_id long, n long")
    kept = lambda budget: within_budget(df, "doc_id", "n", budget).count()
    assert (kept(0), kept(9), kept(10), kept(25), kept(1000)) == (1, 1, 2, 3, 10)


@pytest.mark.parametrize("rows, cols, world", [(2, 8, 1), (1, 1, 2), (3, 50, 3), (4, 1000, 1)])
def test_packing_equals_a_buffer(spark, token_lists, rows, cols, world):
    packed = loader.pack_encoded(encoded(spark, token_lists, world), rows, cols, world)
    expected = [b for r in range(world) for b in golden.pack(groups(token_lists), rows, cols, r, world)]
    assert sorted(tuple(r) for r in packed.collect()) == sorted(expected)


@pytest.mark.parametrize("resume", [None, (1, 0), (2, 1), (0, 2), (9, 9)])
@pytest.mark.parametrize("epochs", [1, 3])
def test_epochs_and_resume(spark, token_lists, epochs, resume):
    packed = loader.pack_encoded(encoded(spark, token_lists, 2), 2, 20, 2, epochs, resume)
    expected = [b for r in range(2) for b in golden.pack(groups(token_lists), 2, 20, r, 2, epochs, resume)]
    assert sorted(tuple(r) for r in packed.collect()) == sorted(expected)


def test_no_token_is_lost(spark, token_lists):
    placed = packing.stream_positions(encoded(spark, token_lists, 1), "doc_id")
    total = packing.assemble(placed, 33).agg(F.sum("filled")).first()[0]
    assert total == sum(map(len, token_lists))
    assert packing.windows(placed, 33).count() == total // 33


def test_whole_loader(spark, docs, texts):
    tok = CorpusTokenizer((TrainedMerge(0, 97, 97, 256, 0),), None, {"<|bos|>": 257})
    sharded = virtual_shards(docs, "doc_id", 8, 3)
    last = (len(texts) - 1) // 8
    lists = [[257, *golden.encode(t, [(97, 97, 256)], None)] for t in texts]
    for split, keep in (("train", lambda s: s < last), ("val", lambda s: s == last)):
        found = {}
        for i, ids in enumerate(lists):
            if keep(i // 8):
                found.setdefault((i // 8, i % 8 // 3), []).append(ids)
        listed = [(s, g, d) for (s, g), d in sorted(found.items())]
        expected = [b for r in range(2) for b in golden.pack(listed, 2, 8, r, 2)]
        packed = loader.pack_corpus(sharded, tok, 2, 8, split, world=2)
        assert sorted(tuple(r) for r in packed.collect()) == sorted(expected)
    with pytest.raises(ValueError):
        loader.pack_encoded(sharded, 1, 1, epochs=0)


def test_shown_ids_pass_through_no_queue(spark):
    """Beside a function of columns, rows wait in queues that a task writes to disk."""
    from corpusloom.catalog.packing import shown

    lists = [[0, 7, 12345], [], [257] * 9, None, list(range(300)), [1 << 20, -1]]
    df = spark.createDataFrame([(0, i, ids, ids and ids[::-1], i) for i, ids in enumerate(lists)], "rank int, batch_id long, inputs array<int>, targets array<int>, rg_idx int")
    out = shown(df.coalesce(1))
    text = lambda ids: None if ids is None else " ".join(map(str, ids))
    assert [tuple(r) for r in out.orderBy("batch_id").collect()] == [(0, i, text(ids), text(ids and ids[::-1]), i) for i, ids in enumerate(lists)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "ArrowEvalPython" not in plan


def test_a_stored_table_leaves_no_shuffle_files(spark):
    from corpusloom.session import DROP_SHUFFLES, materialize

    files = lambda: {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()) if f.getName().startswith("shuffle_")}
    before, setting = files(), spark.conf.get(DROP_SHUFFLES)
    df = spark.range(5000).withColumn("k", F.col("id") % 7).repartition(4, "k")
    stored = materialize(df, "dealt")
    deadline = time.time() + 20
    while files() - before and time.time() < deadline:
        time.sleep(0.2)
    assert not files() - before and spark.conf.get(DROP_SHUFFLES) == setting
    assert stored.count() == 5000


@pytest.mark.parametrize("resume, length", [(None, 9), ((1, 1), 33), ((0, 2), 1000)])
def test_rows_of_documents_are_cut_by_themselves(spark, token_lists, monkeypatch, resume, length):
    """Neighbouring documents in one row give the windows of single ones, however rows are dealt; pieces are not stored."""
    stored = []
    monkeypatch.setattr(packing, "RUN_TOKENS", 150)
    monkeypatch.setattr(packing, "RUN_WINDOWS", 1)
    monkeypatch.setattr(packing, "materialize", lambda df, name, write=packing.materialize: stored.append(name) or write(df, name))
    monkeypatch.setattr(packing, "GROUP_TOKENS", 300 if length < 150 else 1)
    single = packing.stream_positions(encoded(spark, token_lists, 2), "doc_id")
    runs = packing.stream_runs(encoded(spark, token_lists, 2), "doc_id", length)
    assert 4 < runs.count() < DOCS and runs.agg(F.sum(F.size("sizes"))).first()[0] == DOCS
    assert [r.n_tokens for r in runs.collect()] == [sum(r.sizes) for r in runs.collect()]
    sizes = [footer.row_group(i).num_rows for file in runs.inputFiles() for footer in [pq.read_metadata(file.removeprefix("file://"))] for i in range(footer.num_row_groups)]
    assert max(sizes) == (2 if length < 150 else 1)
    passes = [packing.epoch_passes(placed, 2, resume, 2) for placed in (single, runs)]
    assert passes[0] == passes[1]
    expected = packing.run_windows(single, length, passes[0]).collect()
    stored.clear()
    found = packing.run_windows(runs.repartition(7), length, passes[0]).collect()
    assert sorted(found) == sorted(expected) and len(found) > 2
    assert stored == ["edges"]


def test_last_document_of_a_row(spark):
    rows = [([3, 0, 0], [1, 2, 0], [7, 0, 9]), ([0, 0], [4, 3], [0, 0]), ([2, 5], [9, 1], [0, 1]), ([0], [6], [2])]
    df = spark.createDataFrame(rows, "sizes array<int>, shards array<int>, groups array<int>").select(packing.last_document().alias("doc"))
    assert [tuple(r.doc) for r in df.collect()] == [(2, 0), (4, 0), (1, 1), (6, 2)]
