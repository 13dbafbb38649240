"""From raw documents to token ids in five stages, each over all that the stage before has kept.

A stage takes (spark, docs, sf_dir) and returns a table that is written as Parquet before the next one reads it. All but
the last return the columns of the documents; a stage that filters keeps its rows as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import decontamination, pieces, pseudonyms, shingle_join, toxicity
from corpusloom.llm.catalog import PIECE_MODEL, PSEUDONYM_KEY, table
from corpusloom.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, trained without the held-out labels, does not reject."""
    model = toxicity.fit_without_held_out(docs, table(spark, sf_dir, "labels"))
    return docs.where(model.score(F.col("text")) < toxicity.THRESHOLD)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each component of the n-gram Jaccard join: five words, similarity 0.8."""
    return shingle_join.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage within the edit distance of a benchmark item."""
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms for personal data; n_chars follows the text."""
    found = docs.withColumn("text", pseudonyms.pseudonymized(F.col("text"), PSEUDONYM_KEY)["text"])
    return found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as piece ids, and whether decoding gives the text back."""
    encoded = pieces.round_trips(docs.select("doc_id", "lang", "source", "text"), pieces.PieceModel(PIECE_MODEL))
    return encoded.select("doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_pieces"), "round_trip")


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("PII", hide_personal_data),
    ("SentencePiece encoding and decoding", encode_pieces),
]

#: The stages learn models and follow links over any number of steps: tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.split()[0].lower())
    return docs
