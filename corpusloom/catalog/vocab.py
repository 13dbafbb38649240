"""Queries over vocabulary tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.catalog import oracle as O
from corpusloom.catalog.base import Query, joined, tokenizer, word_table
from corpusloom.functions import sequences as S
from corpusloom.functions.patterns import CHAT_PATTERN, GPT4_SPECIALS
from corpusloom.functions.text import render
from corpusloom.operators import vocabulary
from corpusloom.plans.tokenizer import CorpusTokenizer


def d1_vocabulary(spark, sf_dir):
    vocab = tokenizer(spark, sf_dir).vocabulary(spark)
    return vocab.select("id", F.hex("bytes").alias("bytes_hex"), "left", "right", "is_special", "token")


def d2_mergeable_ranks(spark, sf_dir):
    """Ranks of the tokenizer, and of one rebuilt from ranks with permuted bytes, which must give them back."""
    ranks = tokenizer(spark, sf_dir).mergeable_ranks(spark).select("id", F.hex("bytes").alias("bytes_hex"))
    permuted = permuted_tokenizer(spark, sf_dir).mergeable_ranks(spark).select("id", F.hex("bytes").alias("permuted_hex"))
    return ranks.join(permuted, "id")


def d3_special_ids(spark, sf_dir):
    return vocabulary.specials_frame(spark, tokenizer(spark, sf_dir).specials)


def d4_registered_specials(spark, sf_dir):
    """The fixed, non-contiguous ids next to the trained tokens."""
    vocab = tokenizer(spark, sf_dir).register_specials(GPT4_SPECIALS).vocabulary(spark)
    return vocab.select("id", F.hex("bytes").alias("bytes_hex"), "token")


def d5_recover_merges(spark, sf_dir):
    return vocabulary.recover_merges(tokenizer(spark, sf_dir).mergeable_ranks(spark))


def frequency_permutation(spark, sf_dir) -> list[int]:
    """A permutation of the bytes that depends on the corpus: by falling frequency."""
    words = word_table(spark, sf_dir)
    byte = words.select("cnt", F.explode(S.ids(F.col("seq"), 256)).alias("byte"))
    counted = byte.groupBy("byte").agg(F.sum("cnt").alias("n"))
    every = spark.range(256).select(F.col("id").cast("int").alias("byte")).join(counted, "byte", "left")
    ordered = every.orderBy(F.desc(F.coalesce("n", F.lit(0))), "byte").collect()
    return vocabulary.inverse([r.byte for r in ordered])


def permuted_tokenizer(spark, sf_dir) -> CorpusTokenizer:
    """A tokenizer rebuilt from ranks whose single bytes are permuted."""
    plain = tokenizer(spark, sf_dir)
    moved = vocabulary.permute(F.array("id"), frequency_permutation(spark, sf_dir))[0]
    ranks = plain.mergeable_ranks(spark)
    ranks = ranks.select(F.when(F.col("id") < 256, moved).otherwise(F.col("id")).alias("id"), "bytes")
    return CorpusTokenizer.from_ranks(ranks, CHAT_PATTERN, plain.specials)


def d6_byte_permutation(spark, sf_dir):
    there = frequency_permutation(spark, sf_dir)
    back = vocabulary.inverse(there)
    words = word_table(spark, sf_dir).withColumn("ids", S.ids(F.col("seq"), 256))
    moved = words.withColumn("moved", vocabulary.permute(F.col("ids"), there))
    return moved.select(
        "chunk", joined("moved").alias("permuted"), joined(vocabulary.permute(F.col("moved"), back)).alias("restored")
    )


def d7_render_chunks(spark, sf_dir):
    return word_table(spark, sf_dir).select("chunk", render(F.encode("chunk", "UTF-8")).alias("shown"))


def d8_lookups(spark, sf_dir):
    tok = tokenizer(spark, sf_dir)
    vocab = tok.vocabulary(spark)
    one = lambda name, frame, value: frame.select(F.lit(name).alias("name"), value.cast("string").alias("value"))
    special = F.concat(F.lit("special "), "token")
    size = one("vocab size", vocab.agg(F.count("*").alias("n")), F.col("n"))
    bos = one("bos id", vocab.where(F.col("token") == "<|bos|>"), F.col("id"))
    ids = vocab.where("is_special").select(special.alias("name"), F.col("id").cast("string").alias("value"))
    names = vocab.select(F.concat(F.lit("token "), "id").alias("name"), tok.id_to_token("id").alias("value"))
    return size.unionByName(bos).unionByName(ids).unionByName(names)


def d9_token_bytes(spark, sf_dir):
    lengths = vocabulary.token_byte_lengths(tokenizer(spark, sf_dir).vocabulary(spark))
    permuted = vocabulary.token_byte_lengths(permuted_tokenizer(spark, sf_dir).vocabulary(spark))
    return lengths.join(permuted.select("id", F.col("n_bytes").alias("permuted_n_bytes")), "id")


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        d1_vocabulary,
        d2_mergeable_ranks,
        d3_special_ids,
        d4_registered_specials,
        d5_recover_merges,
        d6_byte_permutation,
        d7_render_chunks,
        d8_lookups,
        d9_token_bytes,
    )
}

_fixed = ", ".join(f"({i}, '{name}')" for name, i in GPT4_SPECIALS.items())

# ``perm(byte, p)``: bytes by falling frequency.
PERMUTATION = f""",
perm AS MATERIALIZED (
  SELECT byte, row_number() OVER (ORDER BY coalesce(n, 0) DESC, byte) - 1 AS p
  FROM range(256) r(byte) LEFT JOIN (
    SELECT byte, sum(c) AS n FROM (SELECT c, unnest({O.id_list('s')}) AS byte FROM w0) GROUP BY byte) USING (byte)),
plist AS MATERIALIZED (SELECT list(p ORDER BY byte) AS ps FROM perm),
told AS MATERIALIZED (SELECT DISTINCT chunk, s FROM w0),
moved AS MATERIALIZED (
  SELECT chunk, list(byte ORDER BY i) AS ids, list(p ORDER BY i) AS permuted
  FROM (SELECT chunk, unnest(ids) AS byte, generate_subscripts(ids, 1) AS i FROM (SELECT chunk, {O.id_list('s')} AS ids FROM told))
  JOIN perm USING (byte) GROUP BY chunk)"""

ORACLES: dict[str, str] = {
    "d1_vocabulary": O.with_training(
        """
SELECT v.id, h AS bytes_hex, m.a AS "left", m.b AS "right", false AS is_special, NULL::VARCHAR AS token
FROM vocab v LEFT JOIN merges m ON m.rnk + 256 = v.id
UNION ALL SELECT id, hex(encode(token)), NULL, NULL, true, token FROM specials""",
        more=O.VOCAB + O.SPECIALS,
    ),
    "d2_mergeable_ranks": O.with_training(
        """
SELECT v.id, v.h AS bytes_hex, coalesce(b.h, v.h) AS permuted_hex
FROM vocab v LEFT JOIN perm ON perm.p = v.id LEFT JOIN vocab b ON b.id = perm.byte""",
        more=O.VOCAB + PERMUTATION,
    ),
    "d3_special_ids": O.with_training("SELECT id, token FROM specials", more=O.SPECIALS),
    "d4_registered_specials": O.with_training(
        f"""
SELECT id, h AS bytes_hex, NULL::VARCHAR AS token FROM vocab
UNION ALL SELECT id, hex(encode(token)), token FROM (VALUES {_fixed}) t(id, token)""",
        more=O.VOCAB,
    ),
    "d5_recover_merges": O.with_training('SELECT rnk AS "rank", a, b, 256 + rnk AS new_id FROM merges'),
    "d6_byte_permutation": O.with_training(
        """
SELECT chunk, array_to_string(permuted, ' ') AS permuted, array_to_string(ids, ' ') AS restored FROM moved""",
        merges=0,
        more=PERMUTATION,
    ),
    "d7_render_chunks": f"""
SELECT chunk, {O.escaped("chunk")} AS shown
FROM (SELECT DISTINCT chunk FROM ({O.numbered("doc_id", O.split("text", O.CHAT), "documents")}))""",
    "d8_lookups": O.with_training(
        """
SELECT 'vocab size' AS name, ((SELECT count(*) FROM vocab) + (SELECT count(*) FROM specials))::VARCHAR AS value
UNION ALL SELECT 'bos id', id::VARCHAR FROM specials WHERE token = '<|bos|>'
UNION ALL SELECT 'special ' || token, id::VARCHAR FROM specials
UNION ALL SELECT 'token ' || id, token FROM specials
UNION ALL SELECT 'token ' || id, decode(unhex("""
        + O.lossy_hex("h")
        + """)) FROM vocab""",
        more=O.VOCAB + O.SPECIALS,
    ),
    "d9_token_bytes": O.with_training(
        f"""
, sized AS (SELECT id, length({O.lossy_hex("h")}) // 2 AS n, length(h) // 2 AS raw_bytes FROM vocab)
SELECT v.id, v.n AS n_bytes, v.raw_bytes, coalesce(b.n, v.n) AS permuted_n_bytes
FROM sized v LEFT JOIN perm ON perm.p = v.id LEFT JOIN sized b ON b.id = perm.byte
UNION ALL SELECT id, 0, octet_length(encode(token)), 0 FROM specials""",
        more=O.VOCAB + O.SPECIALS + PERMUTATION,
    ),
}
