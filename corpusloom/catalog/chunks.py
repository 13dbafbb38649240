"""Queries over pre-tokenization."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.catalog import oracle as O
from corpusloom.catalog.base import Query, documents, joined, table
from corpusloom.functions.patterns import CHAT_PATTERN, CHAT_SPECIALS, GPT2_PATTERN, GPT4_PATTERN
from corpusloom.operators import pairs, pretokenize

WORDS_ONLY = r"\p{L}+|\p{N}+"


def chat_turns(spark, sf_dir):
    """Conversation turns with their markers; only users and assistants have special tokens."""
    marked = F.concat(
        F.lit("<|bos|><|"), "role", F.lit("_start|>"), "text", F.lit("<|"), "role", F.lit("_end|>")
    )
    plain = F.when(F.col("role") == "system", F.col("text")).otherwise(marked)
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", plain.alias("text"))


CHAT_TURNS = """(
  SELECT conv_id, turn, role, CASE WHEN role = 'system' THEN text
         ELSE '<|bos|><|' || role || '_start|>' || text || '<|' || role || '_end|>' END AS text
  FROM conversations)"""


def b1_gpt2_chunks(spark, sf_dir):
    return pretokenize.explode_chunks(documents(spark, sf_dir), GPT2_PATTERN, "text", "doc_id")


def b2_gpt4_chunks(spark, sf_dir):
    return pretokenize.explode_chunks(documents(spark, sf_dir), GPT4_PATTERN, "text", "doc_id")


def b3_chat_chunks(spark, sf_dir):
    return pretokenize.explode_chunks(documents(spark, sf_dir), CHAT_PATTERN, "text", "doc_id")


def b4_user_pattern(spark, sf_dir):
    return pretokenize.explode_chunks(documents(spark, sf_dir), WORDS_ONLY, "text", "doc_id")


def b5_turn_chunks(spark, sf_dir):
    return pretokenize.explode_chunks(chat_turns(spark, sf_dir), CHAT_PATTERN, "text", "conv_id", "turn")


def b6_chunk_bytes(spark, sf_dir):
    chunks = pairs.chunk_counts(documents(spark, sf_dir), CHAT_PATTERN)
    return chunks.select("chunk", joined(pretokenize.chunk_bytes(F.col("chunk"))).alias("bytes"))


def b7_special_split(spark, sf_dir):
    parts = pretokenize.split_specials(F.col("text"), CHAT_SPECIALS)
    return chat_turns(spark, sf_dir).select("conv_id", "turn", F.posexplode(parts).alias("pos", "part"))


def b8_special_policy(spark, sf_dir):
    found = pretokenize.special_violations(chat_turns(spark, sf_dir), CHAT_SPECIALS)
    return found.select("conv_id", "turn", F.length("text").alias("n_chars"))


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        b1_gpt2_chunks,
        b2_gpt4_chunks,
        b3_chat_chunks,
        b4_user_pattern,
        b5_turn_chunks,
        b6_chunk_bytes,
        b7_special_split,
        b8_special_policy,
    )
}

_any_special = "|".join(s.replace("|", r"\|") for s in CHAT_SPECIALS)

ORACLES: dict[str, str] = {
    "b1_gpt2_chunks": O.numbered("doc_id", O.split("text", O.GPT2), "documents"),
    "b2_gpt4_chunks": O.numbered("doc_id", O.split("text", O.GPT4), "documents"),
    "b3_chat_chunks": O.numbered("doc_id", O.split("text", O.CHAT), "documents"),
    "b4_user_pattern": O.numbered("doc_id", f"regexp_extract_all(text, '{WORDS_ONLY}')", "documents"),
    "b5_turn_chunks": O.numbered("conv_id, turn", O.split("text", O.CHAT), CHAT_TURNS),
    "b6_chunk_bytes": f"""
WITH ch AS ({O.numbered("doc_id", O.split("text", O.CHAT), "documents")})
SELECT chunk, trim(replace({O.framed("chunk")}, '  ', ' ')) AS bytes FROM (SELECT DISTINCT chunk FROM ch)""",
    "b7_special_split": O.numbered(
        "conv_id, turn",
        f"list_filter(string_split(regexp_replace(text, '({_any_special})', chr(57345) || '\\1' || chr(57345), 'g'),"
        " chr(57345)), lambda x: x <> '')",
        CHAT_TURNS,
        "part",
    ),
    "b8_special_policy": f"""
SELECT conv_id, turn, length(text) AS n_chars FROM {CHAT_TURNS} WHERE regexp_matches(text, '{_any_special}')""",
}
