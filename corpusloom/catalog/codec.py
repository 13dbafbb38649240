"""Queries over encoding and decoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.catalog import oracle as O
from corpusloom.catalog.base import MERGES, Query, documents, joined, tokenizer
from corpusloom.catalog.chunks import CHAT_TURNS, chat_turns
from corpusloom.catalog.vocab import PERMUTATION, permuted_tokenizer
from corpusloom.functions.patterns import CHAT_PATTERN, CHAT_SPECIALS
from corpusloom.operators import codec, pairs, vocabulary
from corpusloom.plans.tokenizer import CorpusTokenizer


def e1_encode_chunks(spark, sf_dir):
    tok = tokenizer(spark, sf_dir)
    chunks = pairs.chunk_counts(documents(spark, sf_dir), CHAT_PATTERN)
    return codec.encode_chunk_table(chunks, tok.rules).select("chunk", "cnt", joined("ids").alias("ids"))


def e2_encode_ordinary(spark, sf_dir):
    tok = tokenizer(spark, sf_dir)
    return documents(spark, sf_dir).select("doc_id", joined(tok.encode("text")).alias("ids"))


def e3_encode_specials(spark, sf_dir):
    tok = tokenizer(spark, sf_dir)
    ids = tok.encode("text", allowed_special="all")
    return chat_turns(spark, sf_dir).select("conv_id", "turn", joined(ids).alias("ids"))


def e4_encode_framed(spark, sf_dir):
    """Through the Arrow path that large vocabularies take."""
    tok = tokenizer(spark, sf_dir)
    ids = tok.encode("text", prepend="<|bos|>", append=tok.special_id("<|user_end|>"), fold_limit=0)
    return documents(spark, sf_dir).select("doc_id", joined(ids).alias("ids"))


def e5_encode_whole_texts(spark, sf_dir):
    docs = documents(spark, sf_dir)
    size = 256 + MERGES
    tok = CorpusTokenizer.train(docs, size, pattern=None, specials=(), tie="first_seen", order="doc_id")
    return docs.select("doc_id", joined(tok.encode("text")).alias("ids"))


def e6_encode_permuted(spark, sf_dir):
    """A tokenizer rebuilt from ranks whose single bytes are permuted."""
    tok = permuted_tokenizer(spark, sf_dir)
    return documents(spark, sf_dir).select("doc_id", joined(tok.encode("text")).alias("ids"))


def e7_decode(spark, sf_dir):
    tok = tokenizer(spark, sf_dir)
    encoded = chat_turns(spark, sf_dir).select("conv_id", "turn", tok.encode("text", allowed_special="all").alias("ids"))
    return encoded.select("conv_id", "turn", tok.decode("ids").alias("text"))


def e8_round_trip(spark, sf_dir):
    tok = tokenizer(spark, sf_dir)
    same = tok.decode(tok.encode("text")) == F.col("text")
    return documents(spark, sf_dir).agg(F.count("*").alias("n_docs"), F.count_if(~same).alias("n_failed"))


def e9_token_counts(spark, sf_dir):
    """Token frequencies of the corpus, from its distinct chunks."""
    tok = tokenizer(spark, sf_dir)
    chunks = pairs.chunk_counts(documents(spark, sf_dir), CHAT_PATTERN)
    return codec.token_counts(codec.encode_chunk_table(chunks, tok.rules))


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        e1_encode_chunks,
        e2_encode_ordinary,
        e3_encode_specials,
        e4_encode_framed,
        e5_encode_whole_texts,
        e6_encode_permuted,
        e7_decode,
        e8_round_trip,
        e9_token_counts,
    )
}

_any_special = "|".join(s.replace("|", r"\|") for s in CHAT_SPECIALS)

# Conversation turns are encoded by folding the merges into their chunks, which need not occur in the documents.
_merge_list = "(SELECT list({'a': a, 'b': b, 'n': 256 + rnk} ORDER BY rnk) FROM merges)"
_fold = (
    "list_reduce(list_prepend({'s': s, 'a': 0, 'b': 0, 'n': 0}, list_transform(ms, lambda m: {'s': '', 'a': m.a, 'b': m.b, 'n': m.n})),"
    " lambda x, y: {'s': replace(x.s, ' ' || y.a || '  ' || y.b || ' ', ' ' || y.n || ' '), 'a': 0, 'b': 0, 'n': 0})"
)
_TURNS = f""",
parts AS ({O.numbered(
    "conv_id, turn",
    f"list_filter(string_split(regexp_replace(text, '({_any_special})', chr(57345) || '\\1' || chr(57345), 'g'),"
    " chr(57345)), lambda x: x <> '')",
    CHAT_TURNS,
    "part",
)}),
cut AS (
  SELECT conv_id, turn, pos AS part_pos, part, unnest(l) AS chunk, generate_subscripts(l, 1) AS chunk_pos
  FROM (SELECT *, CASE WHEN part IN (SELECT token FROM specials) THEN [part] ELSE {O.split("part", O.CHAT)} END AS l FROM parts)),
seqs AS (SELECT DISTINCT chunk, {O.framed("chunk")} AS s FROM cut WHERE chunk NOT IN (SELECT token FROM specials)),
known AS MATERIALIZED (
  SELECT chunk, trim(replace(({_fold}).s, '  ', ' ')) AS ids FROM seqs, (SELECT {_merge_list} AS ms)
  UNION ALL SELECT token, id::VARCHAR FROM specials)"""

ORACLES: dict[str, str] = {
    "e1_encode_chunks": O.with_training("SELECT chunk, c AS cnt, array_to_string(ids, ' ') AS ids FROM enc"),
    "e2_encode_ordinary": O.with_training(
        """
SELECT doc_id, coalesce(array_to_string(ids, ' '), '') AS ids FROM documents LEFT JOIN encoded USING (doc_id)""",
        more=O.ENCODED,
    ),
    "e3_encode_specials": O.with_training(
        """
SELECT conv_id, turn, string_agg(ids, ' ' ORDER BY part_pos, chunk_pos) AS ids
FROM cut JOIN known USING (chunk) GROUP BY conv_id, turn""",
        more=O.SPECIALS + _TURNS,
    ),
    "e4_encode_framed": O.with_training(
        """
SELECT doc_id, array_to_string(list_append(list_prepend(
         (SELECT id FROM specials WHERE token = '<|bos|>'), coalesce(ids, [])),
         (SELECT id FROM specials WHERE token = '<|user_end|>')), ' ') AS ids
FROM documents LEFT JOIN encoded USING (doc_id)""",
        more=O.SPECIALS + O.ENCODED,
    ),
    "e5_encode_whole_texts": O.with_training(
        """
SELECT doc_id, coalesce(array_to_string(ids, ' '), '') AS ids FROM documents LEFT JOIN encoded USING (doc_id)""",
        pattern=None,
        merges=MERGES,
        first_seen=True,
        more=O.ENCODED,
    ),
    "e6_encode_permuted": O.with_training(
        """
SELECT doc_id, coalesce(array_to_string(list_transform(ids, lambda x: CASE WHEN x < 256 THEN ps[x + 1] ELSE x END), ' '), '') AS ids
FROM documents LEFT JOIN encoded USING (doc_id), plist""",
        more=O.ENCODED + PERMUTATION,
    ),
    "e7_decode": f"SELECT conv_id, turn, text FROM {CHAT_TURNS}",
    "e8_round_trip": "SELECT count(*) AS n_docs, 0::BIGINT AS n_failed FROM documents",
    "e9_token_counts": O.with_training(
        "SELECT id, sum(c)::BIGINT AS n FROM (SELECT c, unnest(ids) AS id FROM enc) GROUP BY id"
    ),
}
