"""Time the headline jobs on one data set and print one JSON line."""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.catalog import streams
from corpusloom.catalog.base import MERGES, documents, last_shard, sharded, table
from corpusloom.functions.patterns import CHAT_PATTERN
from corpusloom.operators import codec, pairs, scores, vocabulary
from corpusloom.catalog.scores import vectors
from corpusloom.operators.prefix import within_budget
from corpusloom.plans import loader
from corpusloom.plans.tokenizer import CorpusTokenizer

VOCAB = 256 + 256 + 9
# The loader's usual batch.
ROWS, COLS = 8, 1024


def run(df: DataFrame) -> None:
    """Compute every row and column; keep nothing."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # The test table is a single row group, so a scan is one task: every job deals it to all cores, on the clock.
    docs = documents(spark, sf_dir).repartition(int(cpus), "doc_id")
    run(pairs.chunk_counts(docs.limit(10), CHAT_PATTERN))
    times: dict[str, float] = {}

    def timed(name, job):
        start = time.perf_counter()
        result = job()
        if isinstance(result, DataFrame):
            run(result)
        times[name] = round(time.perf_counter() - start, 3)
        return result

    lengths = table(spark, sf_dir, "documents").select("doc_id", F.length("text").cast("long").alias("n_chars"))
    timed("c1_char_budget", lambda: within_budget(lengths, "doc_id", "n_chars", 10_000_000))
    timed("b3_chat_chunks", lambda: pairs.explode_chunks(docs, CHAT_PATTERN, "text", "doc_id"))
    timed("c2_chunk_counts", lambda: pairs.chunk_counts(docs, CHAT_PATTERN))
    timed("c10_train_30_merges", lambda: CorpusTokenizer.train(docs, 256 + MERGES + 9))
    tok = timed("c14_train_256_merges", lambda: CorpusTokenizer.train(docs, VOCAB))
    few = CorpusTokenizer(tok.merges[:MERGES], tok.pattern, tok.specials)
    timed("d1_vocabulary", lambda: tok.vocabulary(spark))
    timed("d5_recover_merges", lambda: vocabulary.recover_merges(tok.mergeable_ranks(spark)))
    timed("e2_encode_30_merges", lambda: docs.select("doc_id", few.encode("text")))
    timed("e2_encode_256_merges", lambda: docs.select("doc_id", tok.encode("text")))
    timed("e4_encode_arrow", lambda: docs.select("doc_id", tok.encode("text", prepend="<|bos|>", fold_limit=0)))
    timed("e8_round_trip", lambda: docs.select((tok.decode(tok.encode("text")) == F.col("text")).alias("same")))
    chunks = pairs.chunk_counts(docs, CHAT_PATTERN)
    timed("e9_token_counts", lambda: codec.token_counts(codec.encode_chunk_table(chunks, tok.rules)))
    split = sharded(spark, sf_dir)
    timed("f9_loader", lambda: loader.pack_corpus(split, few, ROWS, COLS, world=2, last_shard=last_shard(split)))
    timed("f7_epochs", lambda: loader.pack_corpus(split, few, ROWS, COLS, world=2, epochs=2, last_shard=last_shard(split)))
    logits = vectors(spark, sf_dir)
    timed("g2_cross_entropy", lambda: scores.cross_entropy(logits, "row_id", "logits", "target"))
    timed("g4_softmax", lambda: logits.select(scores.softmax(F.col("logits"))))
    timed("h1_stream_chunk_counts", lambda: streams.h1_stream_chunk_counts(spark, sf_dir))
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline jobs, total time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else sf_dir,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
