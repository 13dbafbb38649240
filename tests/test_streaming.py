from pyspark.sql import functions as F

from corpusloom.functions.patterns import CHAT_PATTERN
from corpusloom.operators.pairs import chunk_counts
from corpusloom.plans import loader
from corpusloom.plans.tokenizer import CorpusTokenizer
from corpusloom.plans.training import TrainedMerge
from corpusloom.session import scratch_path
from corpusloom.sources.documents import rank_of, virtual_shards
from corpusloom.streaming import counting, encoding

TOK = CorpusTokenizer((TrainedMerge(0, 116, 104, 256, 0),), CHAT_PATTERN, {"<|bos|>": 257})


def arrivals(spark, corpus, *bounds):
    """A folder to which documents are added range by range."""
    path = scratch_path(spark, "arrivals")
    stream = lambda: spark.readStream.schema(corpus.schema).parquet(path)
    for low, high in zip(bounds, bounds[1:]):
        corpus.where((F.col("doc_id") >= low) & (F.col("doc_id") < high)).write.mode("append").parquet(path)
        yield stream()


def test_counting_goes_on_from_its_checkpoint(spark, corpus):
    checkpoint = scratch_path(spark, "counting")
    for high, stream in zip((10, 30), arrivals(spark, corpus, 0, 10, 30)):
        counting.start_counting(stream, CHAT_PATTERN, checkpoint).awaitTermination()
        expected = chunk_counts(corpus.where(F.col("doc_id") < high), CHAT_PATTERN)
        counted = counting.counted_chunks(spark, checkpoint)
        assert sorted(map(tuple, counted.collect())) == sorted(map(tuple, expected.collect()))


def test_encoding_and_packing_carry_over(spark, corpus):
    out, state, batches = (scratch_path(spark, name) for name in ("ids", "state", "batches"))
    checkpoint, second = scratch_path(spark, "ckpt"), scratch_path(spark, "ckpt")
    for stream in arrivals(spark, corpus, 0, 0, 3, 4, 25):
        docs = virtual_shards(stream, "doc_id", 10, 3).withColumn("rank", rank_of(2))
        encoding.start_encoding(docs, TOK, out, checkpoint, prepend="<|bos|>").awaitTermination()
        encoding.start_packing(docs, TOK, state, batches, second, 2, 40).awaitTermination()
    encoded = spark.read.parquet(out)
    docs = virtual_shards(corpus.where("doc_id < 25"), "doc_id", 10, 3)
    striped = loader.encode_striped(docs, TOK, 2)
    assert sorted((r.doc_id, r.ids) for r in encoded.collect()) == sorted((r.doc_id, r.ids) for r in striped.collect())
    expected = loader.pack_encoded(striped, 2, 40, 2)
    got = encoding.packed(spark, batches, state).select(expected.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_late_keys_are_packed(spark):
    """A later call may bring lower keys; an empty one changes nothing; one cut short does not count."""
    state, out = scratch_path(spark, "state"), scratch_path(spark, "batches")
    doc = lambda key, size: (key, 0, 0, 0, [key] * size)
    frame = lambda *docs: spark.createDataFrame(docs, "doc_id long, rank int, shard_idx int, rg_idx int, ids array<int>")
    assert encoding.pack_new(spark, frame(), state, out, 1, 4) == 1
    assert encoding.pack_new(spark, frame(doc(5, 6)), state, out, 1, 4) == 2
    assert encoding.pack_new(spark, frame(), state, out, 1, 4) == 3
    # A version without its commit: as if the call had stopped halfway.
    encoding.packing.batch_rows(spark.createDataFrame([(0, 9, [1] * 5, 0, 0)], "rank int, win long, tokens array<int>, shard_idx int, rg_idx int"), 1, 4).write.parquet(f"{out}/version=4")
    assert encoding.packed(spark, out, state).count() == 1
    assert encoding.pack_new(spark, frame(doc(3, 5)), state, out, 1, 4) == 4
    rows = encoding.packed(spark, out, state).orderBy("batch_id").collect()
    assert [(r.batch_id, r.inputs, r.targets) for r in rows] == [(0, [5] * 4, [5] * 4), (1, [5, 3, 3, 3], [3, 3, 3, 3])]


def test_a_stream_reads_a_table_that_is_a_folder(spark, corpus):
    """Tables may be a file or a folder of files."""
    from corpusloom.catalog import streams

    folder = scratch_path(spark, "tables")
    corpus.limit(20).repartition(3).write.parquet(f"{folder}/documents.parquet")
    expected = chunk_counts(spark.read.parquet(f"{folder}/documents.parquet"), CHAT_PATTERN)
    counted = streams.h1_stream_chunk_counts(spark, folder)
    assert sorted(map(tuple, counted.collect())) == sorted(map(tuple, expected.collect()))
    assert streams.h2_stream_encode(spark, folder).count() == 20
