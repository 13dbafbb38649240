"""Saving and loading tokenizers: Parquet tables, and a portable text format."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import sequences as S
from corpusloom.operators.vocabulary import SPECIALS_SCHEMA, listing, specials_frame
from corpusloom.plans.tokenizer import CorpusTokenizer
from corpusloom.plans.training import MERGES_SCHEMA, TrainedMerge, merges_frame

FORMAT_VERSION = "v1"
DEFAULT_FORMAT = "bpe"


def save(tokenizer: CorpusTokenizer, spark: SparkSession, folder: str) -> None:
    """Write tables ``merges``, ``specials``, ``vocab`` and ``meta`` below ``folder``."""
    writer = lambda df, name: df.write.mode("overwrite").parquet(f"{folder}/{name}")
    writer(merges_frame(spark, list(tokenizer.merges)).coalesce(1), "merges")
    writer(specials_frame(spark, tokenizer.specials).coalesce(1), "specials")
    writer(tokenizer.vocabulary(spark), "vocab")
    permutation = json.dumps(tokenizer.permutation)
    meta = spark.createDataFrame([(tokenizer.pattern, permutation)], "pattern string, permutation string")
    writer(meta.coalesce(1), "meta")


def load(spark: SparkSession, folder: str) -> CorpusTokenizer:
    """Read a tokenizer written by :func:`save`."""
    merges = from_table(spark.read.schema(MERGES_SCHEMA).parquet(f"{folder}/merges"))
    specials = spark.read.schema(SPECIALS_SCHEMA).parquet(f"{folder}/specials").orderBy("id").collect()
    meta = spark.read.parquet(f"{folder}/meta").first()
    permutation = json.loads(meta["permutation"])
    return CorpusTokenizer(
        tuple(merges),
        meta["pattern"],
        {r["token"]: r["id"] for r in specials},
        tuple(permutation) if permutation else None,
    )


def from_table(merges: DataFrame) -> list[TrainedMerge]:
    """Merges of a table in rank order; its size is checked to be a vocabulary's."""
    rows = merges.limit(S.MAX_TOKENS + 1).collect()
    if len(rows) > S.MAX_TOKENS:
        raise ValueError("more merges than a vocabulary can have")
    return [TrainedMerge(*r) for r in sorted(rows)]


def model_lines(tokenizer: CorpusTokenizer, spark: SparkSession, format_name: str = DEFAULT_FORMAT) -> DataFrame:
    """Lines of the text format: ``(line_no, line)``.

    A name and version, the pattern, the number of special tokens, ``token id``
    lines and one ``a b`` line per merge, whose ids are implied by the order.
    """
    head = [f"{format_name} {FORMAT_VERSION}", tokenizer.pattern or "", str(len(tokenizer.specials))]
    head += [f"{name} {i}" for name, i in tokenizer.specials.items()]
    header = spark.createDataFrame(list(enumerate(head)), "line_no int, line string")
    merges = merges_frame(spark, list(tokenizer.merges)).select(
        (F.col("rank") + len(head)).alias("line_no"), F.concat_ws(" ", "a", "b").alias("line")
    )
    return header.unionByName(merges)


def vocab_lines(tokenizer: CorpusTokenizer, spark: SparkSession) -> DataFrame:
    """Readable listing of the vocabulary: ``(id, line)``."""
    return listing(tokenizer.vocabulary(spark))


def save_text(tokenizer: CorpusTokenizer, spark: SparkSession, prefix: str, format_name: str = DEFAULT_FORMAT) -> None:
    """Write ``<prefix>.model`` and ``<prefix>.vocab`` as single-part text folders."""
    if tokenizer.permutation is not None:
        raise NotImplementedError("the text format has no place for a byte permutation")
    ordered = lambda df, key: df.repartition(1).sortWithinPartitions(key).select("line")
    ordered(model_lines(tokenizer, spark, format_name), "line_no").write.mode("overwrite").text(f"{prefix}.model")
    vocab = vocab_lines(tokenizer, spark).withColumn("line", F.replace("line", F.lit("\n"), F.lit("\\n")))
    ordered(vocab, "id").write.mode("overwrite").text(f"{prefix}.vocab")


def load_text(spark: SparkSession, path: str) -> CorpusTokenizer:
    """Read a ``.model`` file or folder; merges are numbered from 256 in line order."""
    if not path.rstrip("/").endswith(".model"):
        raise ValueError(f"not a .model file: {path}")
    whole = spark.read.text(path, wholetext=True)
    lines = whole.select(F.posexplode(F.split("value", "\n", -1)).alias("line_no", "line"))
    return parse_model(lines)


def parse_model(lines: DataFrame) -> CorpusTokenizer:
    """A tokenizer from ``(line_no, line)`` rows; more than a vocabulary's worth of lines is refused."""
    rows = lines.limit(2 * S.MAX_TOKENS + 1).collect()
    if len(rows) > 2 * S.MAX_TOKENS:
        raise ValueError("more lines than a vocabulary can have")
    texts = [r["line"] for r in sorted(rows, key=lambda r: r["line_no"])]
    header = texts[0].split()
    if len(header) != 2 or header[1] != FORMAT_VERSION:
        raise ValueError(f"model version not understood: {texts[0]!r}")
    count = int(texts[2])
    specials = {}
    for line in texts[3 : 3 + count]:
        name, i = line.rsplit(" ", 1)
        specials[name] = int(i)
    merges = []
    for line in texts[3 + count :]:
        if line.strip():
            a, b = map(int, line.split())
            merges.append(TrainedMerge(len(merges), a, b, 256 + len(merges), 0))
    if len(merges) + 256 + len(specials) > S.MAX_TOKENS:
        raise ValueError("more merges than a vocabulary can have")
    return CorpusTokenizer(tuple(merges), texts[1] or None, specials)
