"""Vocabulary tables: token bytes, special tokens, ranks, rendering."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import sequences as S
from corpusloom.functions.tasks import split_at_rank
from corpusloom.functions.text import lossy_utf8, render
from corpusloom.plans.training import TrainedMerge, merges_frame

SPECIALS_SCHEMA = "id int, token string"


def append_specials(names: Sequence[str], num_ranks: int) -> dict[str, int]:
    """Ids for special tokens: list order, starting after the last rank."""
    return {name: num_ranks + i for i, name in enumerate(names)}


def specials_frame(spark: SparkSession, specials: Mapping[str, int]) -> DataFrame:
    """Registered special tokens; names and ids must be unique."""
    if len(set(specials.values())) != len(specials):
        raise ValueError("two special tokens share an id")
    return spark.createDataFrame([(i, name) for name, i in specials.items()], SPECIALS_SCHEMA)


def expand(seq: Column, merges: Sequence[S.Merge]) -> Column:
    """Replace every token by its parents until only bytes remain.

    All tokens of a sequence expand at once, so the number of passes is the
    depth of the merge tree, not the number of merges.
    """
    if not merges:
        return seq
    depth = {}
    for a, b, new_id in merges:
        depth[new_id] = 1 + max(depth.get(a, 0), depth.get(b, 0))
    parents = [S.symbol(i) for i in range(256)] + [S.symbol(a) + S.symbol(b) for a, b, _ in merges]
    step = lambda s: F.array_join(F.transform(F.split(s, ""), lambda c: S.lookup(parents, S.char_id(c), S.BREAK)), "")
    return F.aggregate(F.sequence(F.lit(1), F.lit(max(depth.values()))), seq, lambda s, _: step(s))


def token_bytes_column(token: Column, merges: Sequence[S.Merge], permutation: Sequence[int] | None = None) -> Column:
    """The bytes of a base or merged token id; with a permutation, base id ``permutation[b]`` stands for byte ``b``."""
    parents = [S.symbol(i) for i in range(256)] + [S.symbol(a) + S.symbol(b) for a, b, _ in merges]
    seq = expand(S.lookup(parents, token, S.BREAK), merges)
    if permutation is not None:
        table = [S.symbol(b) for b in inverse(permutation)]
        seq = F.array_join(F.transform(F.split(seq, ""), lambda c: S.lookup(table, S.char_id(c), S.BREAK)), "")
    return S.symbol_bytes(seq)


def mergeable_ranks(
    spark: SparkSession, merges: Sequence[TrainedMerge], permutation: Sequence[int] | None = None
) -> DataFrame:
    """``(id, bytes)`` of the 256 bytes and every merge."""
    rules = [(m.a, m.b, m.new_id) for m in merges]
    token = spark.range(256 + len(rules)).select(F.col("id").cast("int").alias("id"))
    return token.select("id", token_bytes_column(F.col("id"), rules, permutation).alias("bytes"))


def vocabulary(
    spark: SparkSession,
    merges: Sequence[TrainedMerge],
    specials: Mapping[str, int],
    permutation: Sequence[int] | None = None,
) -> DataFrame:
    """``(id, bytes, left, right, is_special, token)`` for every token."""
    parents = merges_frame(spark, list(merges)).select(
        F.col("new_id").alias("id"), F.col("a").alias("left"), F.col("b").alias("right")
    )
    plain = mergeable_ranks(spark, merges, permutation).join(parents, "id", "left")
    plain = plain.select(
        "id", "bytes", "left", "right", F.lit(False).alias("is_special"), F.lit(None).cast("string").alias("token")
    )
    special = specials_frame(spark, specials).select(
        "id",
        F.encode("token", "UTF-8").alias("bytes"),
        F.lit(None).cast("int").alias("left"),
        F.lit(None).cast("int").alias("right"),
        F.lit(True).alias("is_special"),
        "token",
    )
    return plain.unionByName(special)


def listing(vocab: DataFrame) -> DataFrame:
    """Readable vocabulary: ``[left][right] -> [token] id``, or ``[token] id`` for leaves."""
    shown = vocab.select("id", "left", "right", render(F.col("bytes")).alias("shown"))
    side = lambda name: shown.select(F.col("id").alias(name), F.col("shown").alias(f"{name}_shown"))
    joined = shown.join(side("left"), "left", "left").join(side("right"), "right", "left")
    leaf = F.format_string("[%s] %d", "shown", "id")
    merged = F.format_string("[%s][%s] -> [%s] %d", "left_shown", "right_shown", "shown", "id")
    return joined.select("id", F.when(F.col("left").isNull(), leaf).otherwise(merged).alias("line"))


def token_byte_lengths(vocab: DataFrame) -> DataFrame:
    """``n_bytes``: UTF-8 length of the token as text, 0 for special tokens.

    An invalid byte counts as the replacement character, three bytes;
    ``raw_bytes`` is the length without that effect.
    """
    text_length = F.octet_length(lossy_utf8(F.col("bytes")))
    return vocab.select(
        "id",
        F.when(F.col("is_special"), 0).otherwise(text_length).alias("n_bytes"),
        F.octet_length("bytes").alias("raw_bytes"),
    )


def byte_permutation(ranks: DataFrame) -> list[int]:
    """For each byte, the rank of its one-byte token; a missing or repeated byte is refused."""
    single = ranks.where(F.octet_length("bytes") == 1)
    # One row per byte value, whatever the table holds.
    rows = single.groupBy("bytes").agg(F.count("*").alias("n"), F.min("id").alias("id")).collect()
    table = {bytes(r["bytes"])[0]: r["id"] for r in rows}
    if sorted(table) != list(range(256)) or any(r["n"] > 1 for r in rows):
        raise ValueError("the ranks must hold each single byte exactly once")
    return [table[b] for b in range(256)]


def permute(token_ids: Column, permutation: Sequence[int]) -> Column:
    """Map byte ids through a permutation of 0..255."""
    table = [str(p) for p in permutation]
    return F.transform(token_ids, lambda b: S.lookup(table, b).cast("int"))


def inverse(permutation: Sequence[int]) -> list[int]:
    back = [0] * len(permutation)
    for i, p in enumerate(permutation):
        back[p] = i
    return back


def recover_merges(ranks: DataFrame) -> DataFrame:
    """Merges ``(rank, a, b, new_id)`` behind a table of ranks ``(id, bytes)``.

    Tokens are independent of each other; only the rank table goes to every
    task, and its size is checked.
    """
    spark = ranks.sparkSession
    rows = ranks.select("bytes", "id").limit(S.MAX_TOKENS + 1).collect()
    if len(rows) > S.MAX_TOKENS:
        raise ValueError("more ranks than a vocabulary can have")
    table = spark.sparkContext.broadcast({bytes(r["bytes"]): r["id"] for r in rows})

    def recover(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = table.value
        for batch in batches:
            found = []
            for token, rank in zip(batch["bytes"], batch["id"]):
                parts = split_at_rank(bytes(token), known, rank)
                if len(parts) != 2:
                    raise ValueError(f"token {rank} is not the merge of two others")
                found.append((known[parts[0]], known[parts[1]], rank))
            yield pd.DataFrame(found, columns=["a", "b", "new_id"])

    longer = ranks.where(F.octet_length("bytes") > 1).select("bytes", "id")
    merges = longer.mapInPandas(recover, "a int, b int, new_id int")
    return merges.select((F.col("new_id") - 256).alias("rank"), "a", "b", "new_id")
