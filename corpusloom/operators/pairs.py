"""Chunk counts, adjacent-pair counts, merges and their effect on the counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import sequences as S
from corpusloom.functions.cuts import count_blocks
from corpusloom.functions.tasks import count_chunks
from corpusloom.operators.pretokenize import DIGITS, SPACE_BEGINS_CHUNK, character_kinds, explode_chunks, kind_pattern


def chunk_counts(docs: DataFrame, pattern: str | None, text: str = "text") -> DataFrame:
    """Chunk frequencies ``(chunk, cnt)``; counted per partition before the shuffle.

    Where the pattern allows it, a task cuts many texts at once, or cuts them at spaces first and splits each distinct piece once.
    """
    if pattern not in SPACE_BEGINS_CHUNK:
        return explode_chunks(docs, pattern, text).groupBy("chunk").agg(F.count("*").alias("cnt"))
    cut, kinds = kind_pattern(pattern), character_kinds(docs.sparkSession)
    digits = DIGITS.get(pattern)
    count = (lambda batches: count_blocks(batches, kinds, digits)) if digits else (lambda batches: count_chunks(batches, cut, kinds))
    found = docs.where(F.col(text).isNotNull()).select(text).mapInArrow(count, "chunk string, n long")
    return found.groupBy("chunk").agg(F.sum("n").alias("cnt"))


def words(chunks: DataFrame, chunk: str = "chunk") -> DataFrame:
    """Add the byte sequence of each chunk as column ``seq``."""
    return chunks.withColumn("seq", S.byte_symbols(F.col(chunk)))


# Long sequences are cut into spans before their pairs are taken: finding the
# n-th character of a string takes n steps.
SPAN = 200


def explode_grams(seqs: DataFrame, size: int, seq: str = "seq", *keep: str) -> DataFrame:
    """One row per adjacent pair: ``keep``, ``off``, ``gram``.

    ``off`` is the offset in the sequence, ``gram`` its next ``size`` tokens, or
    fewer at the end but at least two. The expressions compile to plain loops,
    which arrays and lambdas would not.
    """
    start = f"cast(k * {SPAN} + 1 AS int)"
    spans = f"transform(sequence(0, (length({seq}) - 2) div {SPAN}), k -> substring({seq}, {start}, {SPAN + size - 1}))"
    cut = seqs.selectExpr(*keep, f"posexplode(if(length({seq}) <= {SPAN}, array({seq}), {spans})) AS (_span, _part)")
    places = f"if(length(_part) > 1, sequence(1, least({SPAN}, length(_part) - 1)), cast(array() AS array<int>))"
    each = cut.selectExpr(*keep, "_span", "_part", f"explode({places}) AS _i")
    return each.selectExpr(*keep, f"_span * {SPAN} + _i - 1 AS off", f"substring(_part, _i, {size}) AS gram")


def with_pair_ids(counts: DataFrame, pair: str = "pair") -> DataFrame:
    a, b = S.pair_ids(F.col(pair))
    rest = [c for c in counts.columns if c != pair]
    return counts.select(a.alias("a"), b.alias("b"), *rest)


def explode_pairs(seqs: DataFrame, seq: str = "seq", *keep: str) -> DataFrame:
    """One row per adjacent pair, overlapping ones included: ``keep``, ``off``, ``pair``."""
    return explode_grams(seqs, 2, seq, *keep).withColumnRenamed("gram", "pair")


def pair_counts(seqs: DataFrame, seq: str = "seq", weight: str | None = None, into: DataFrame | None = None) -> DataFrame:
    """Adjacent-pair counts ``(pair, n)``; with ``into``, added to earlier counts."""
    keep = [weight] if weight else []
    one = F.col(weight) if weight else F.lit(1).cast("long")
    counts = explode_pairs(seqs, seq, *keep).groupBy("pair").agg(F.sum(one).alias("n"))
    if into is None:
        return counts
    return counts.unionByName(into).groupBy("pair").agg(F.sum("n").alias("n"))


def pair_index(seqs: DataFrame, word: str, seq: str = "seq") -> DataFrame:
    """Which words contain which pair, as rows ``(pair, word)``: no list grows with a frequent pair."""
    return explode_pairs(seqs, seq, word).select("pair", word).distinct()


def best_pairs(counts: DataFrame, k: int = 1) -> DataFrame:
    """The ``k`` most frequent pairs; equal counts go to the smaller pair."""
    return counts.where(F.col("n") > 0).orderBy(F.desc("n"), "pair").limit(k)


def best_pair_first_seen(seqs: DataFrame, order: list[str], seq: str = "seq", weight: str = "cnt") -> DataFrame:
    """The most frequent pair; equal counts go to the pair that occurs first.

    ``order`` are the columns that give the first position of each sequence.
    """
    return (
        explode_pairs(seqs, seq, weight, *order)
        .groupBy("pair")
        .agg(F.sum(weight).alias("n"), F.min(F.struct(*order, "off")).alias("first"))
        .orderBy(F.desc("n"), "first")
        .select("pair", "n")
        .limit(1)
    )


def merge_pair(seq: Column, a: int, b: int, new_id: int) -> Column:
    """Replace the pair by ``new_id``, left to right and non-overlapping."""
    return F.replace(seq, F.lit(S.symbol(a) + S.symbol(b)), F.lit(S.symbol(new_id)))


def signed_grams(seqs: DataFrame, merges: list[S.Merge], size: int, seq: str, weight: str) -> DataFrame:
    """``(gram, n)`` rows that turn the counts before the merges into those after.

    Words that do not change yield nothing. That is a condition on the array,
    not a filter: pushed below the projection it would fold every word twice.
    """
    after = seqs.select(seq, weight, S.fold(F.col(seq), merges).alias("_after"))
    both = f"array(struct({seq} AS seq, -{weight} AS n), struct(_after AS seq, {weight} AS n))"
    signed = after.selectExpr(f"inline(if(_after = {seq}, array(), {both}))")
    return explode_grams(signed, size, "seq", "n").select("gram", "n")


def pair_deltas(seqs: DataFrame, merges: list[S.Merge], seq: str = "seq", weight: str = "cnt") -> DataFrame:
    """Changes of the pair counts caused by merges, from the changed words only."""
    return (
        signed_grams(seqs, merges, 2, seq, weight)
        .groupBy(F.col("gram").alias("pair"))
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") != 0)
    )


def apply_deltas(counts: DataFrame, deltas: DataFrame) -> DataFrame:
    """Pair counts after the merges behind ``deltas``."""
    summed = counts.unionByName(deltas).groupBy("pair").agg(F.sum("n").alias("n"))
    return summed.where(F.col("n") > 0)
