"""Queries over counting, merging and training."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.catalog import oracle as O
from corpusloom.catalog.base import MERGES, Query, documents, joined, table, tokenizer, word_table
from corpusloom.functions import sequences as S
from corpusloom.functions.patterns import CHAT_PATTERN, GPT4_PATTERN
from corpusloom.operators import pairs, vocabulary
from corpusloom.operators.prefix import within_budget
from corpusloom.plans.training import merges_frame, train_bpe

BUDGET = 1_000_000


def c1_char_budget(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.length("text").cast("long").alias("n_chars"))
    return within_budget(docs, "doc_id", "n_chars", BUDGET)


def c2_chunk_counts(spark, sf_dir):
    return pairs.chunk_counts(documents(spark, sf_dir), CHAT_PATTERN)


def c3_pair_counts(spark, sf_dir):
    seqs = documents(spark, sf_dir).select(S.byte_symbols(F.col("text")).alias("seq"))
    return pairs.with_pair_ids(pairs.pair_counts(seqs))


def c4_weighted_pairs(spark, sf_dir):
    words = word_table(spark, sf_dir)
    counts = pairs.pair_counts(words, weight="cnt")
    index = pairs.pair_index(words, "chunk").groupBy("pair").agg(F.count("*").alias("n_words"))
    return pairs.with_pair_ids(counts.join(index, "pair"))


def c5_best_pairs(spark, sf_dir):
    counts = pairs.pair_counts(word_table(spark, sf_dir), weight="cnt")
    return pairs.with_pair_ids(pairs.best_pairs(counts, 64))


def c6_best_pair_first_seen(spark, sf_dir):
    exploded = pairs.explode_chunks(documents(spark, sf_dir), GPT4_PATTERN, "text", "doc_id")
    counts = exploded.groupBy("chunk").agg(F.count("*").alias("cnt"), F.min(F.struct("doc_id", "pos")).alias("first"))
    return pairs.with_pair_ids(pairs.best_pair_first_seen(pairs.words(counts), ["first"]))


def first_merge(words) -> S.Merge:
    """The first merge of a corpus, found by a job of its own."""
    best = pairs.best_pairs(pairs.pair_counts(words, weight="cnt")).first()
    return S.token_id(best.pair[0]), S.token_id(best.pair[1]), 256


def c7_merge_pair(spark, sf_dir):
    words = word_table(spark, sf_dir)
    merged = pairs.merge_pair(F.col("seq"), *first_merge(words))
    return words.select("chunk", joined(S.ids(merged)).alias("ids"))


def c8_pair_deltas(spark, sf_dir):
    words = word_table(spark, sf_dir)
    return pairs.with_pair_ids(pairs.pair_deltas(words, [first_merge(words)]))


def c10_train_chunks(spark, sf_dir):
    merges = train_bpe(documents(spark, sf_dir), 256 + MERGES, CHAT_PATTERN)
    return merges_frame(spark, merges)


def c11_train_first_seen(spark, sf_dir):
    docs = documents(spark, sf_dir)
    merges = train_bpe(docs, 256 + MERGES, GPT4_PATTERN, tie="first_seen", order="doc_id")
    return merges_frame(spark, merges)


def c12_train_whole_texts(spark, sf_dir):
    docs = documents(spark, sf_dir)
    merges = train_bpe(docs, 256 + MERGES, None, tie="first_seen", order="doc_id")
    return merges_frame(spark, merges)


def c13_training_trace(spark, sf_dir):
    merges = tokenizer(spark, sf_dir).merges
    rules = [(m.a, m.b, m.new_id) for m in merges]
    return merges_frame(spark, list(merges)).select(
        (F.col("rank") + 1).alias("step"),
        F.floor((F.col("rank") + 1) * 100 / len(merges)).cast("int").alias("percent"),
        "a",
        "b",
        "new_id",
        F.hex(vocabulary.token_bytes_column(F.col("new_id"), rules)).alias("bytes_hex"),
        "cnt",
    )


def c14_train_tokenizer(spark, sf_dir):
    vocab = tokenizer(spark, sf_dir).vocabulary(spark)
    return vocab.select("id", F.hex("bytes").alias("bytes_hex"), "token", "is_special")


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        c1_char_budget,
        c2_chunk_counts,
        c3_pair_counts,
        c4_weighted_pairs,
        c5_best_pairs,
        c6_best_pair_first_seen,
        c7_merge_pair,
        c8_pair_deltas,
        c10_train_chunks,
        c11_train_first_seen,
        c12_train_whole_texts,
        c13_training_trace,
        c14_train_tokenizer,
    )
}

_pairs = "SELECT {keep}, i[j] AS a, i[j + 1] AS b, j FROM (SELECT {keep}, i, unnest(range(1, len(i))) AS j FROM {source})"

_word_ids = f"(SELECT chunk, c, f, {O.id_list('s')} AS i FROM w0)"
_merge_rows = 'SELECT rnk AS "rank", a, b, 256 + rnk AS new_id, n::BIGINT AS cnt FROM merges'


def _steps(step: int) -> str:
    """Pair counts of all words after so many steps."""
    ids = f"(SELECT c, {O.id_list('s')} AS i FROM w WHERE step = {step})"
    return f"SELECT a, b, sum(c)::BIGINT AS n FROM ({_pairs.format(keep='c', source=ids)}) GROUP BY a, b"


ORACLES: dict[str, str] = {
    "c1_char_budget": f"""
SELECT doc_id, n_chars FROM (
  SELECT doc_id, length(text) AS n_chars,
         coalesce(sum(length(text)) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM documents)
WHERE before <= {BUDGET}""",
    "c2_chunk_counts": f"""
SELECT chunk, count(*) AS cnt FROM ({O.numbered("doc_id", O.split("text", O.CHAT), "documents")}) GROUP BY chunk""",
    "c3_pair_counts": f"""
SELECT a, b, count(*) AS n FROM (
  {_pairs.format(keep="doc_id", source=f"(SELECT doc_id, {O.id_list(O.framed('text'))} AS i FROM documents)")})
GROUP BY a, b""",
    "c4_weighted_pairs": O.with_training(
        f"""
SELECT a, b, sum(c)::BIGINT AS n, count(DISTINCT chunk) AS n_words
FROM ({_pairs.format(keep="chunk, c", source=_word_ids)}) GROUP BY a, b""",
        merges=0,
    ),
    "c5_best_pairs": O.with_training(
        f"""
SELECT a, b, sum(c)::BIGINT AS n FROM ({_pairs.format(keep="c", source=_word_ids)})
GROUP BY a, b ORDER BY n DESC, a, b LIMIT 64""",
        merges=0,
    ),
    "c6_best_pair_first_seen": O.with_training(
        f"""
SELECT a, b, sum(c)::BIGINT AS n FROM ({_pairs.format(keep="c, f", source=_word_ids)})
GROUP BY a, b ORDER BY n DESC, min((f, j)) LIMIT 1""",
        pattern=O.GPT4,
        merges=0,
        first_seen=True,
    ),
    "c7_merge_pair": O.with_training(
        "SELECT chunk, trim(replace(s, '  ', ' ')) AS ids FROM w WHERE step = 1", merges=1
    ),
    "c8_pair_deltas": O.with_training(
        f"""
SELECT coalesce(x.a, y.a) AS a, coalesce(x.b, y.b) AS b, coalesce(y.n, 0) - coalesce(x.n, 0) AS n
FROM ({_steps(0)}) x FULL JOIN ({_steps(1)}) y ON x.a = y.a AND x.b = y.b
WHERE coalesce(y.n, 0) <> coalesce(x.n, 0)""",
        merges=1,
    ),
    "c10_train_chunks": O.with_training(_merge_rows),
    "c11_train_first_seen": O.with_training(_merge_rows, O.GPT4, first_seen=True),
    "c12_train_whole_texts": O.with_training(_merge_rows, None, first_seen=True),
    "c13_training_trace": O.with_training(
        f"""
SELECT rnk + 1 AS step, (rnk + 1) * 100 // {MERGES} AS percent, a, b, 256 + rnk AS new_id, h AS bytes_hex, n::BIGINT AS cnt
FROM merges JOIN vocab ON id = 256 + rnk""",
        more=O.VOCAB,
    ),
    "c14_train_tokenizer": O.with_training(
        """
SELECT id, h AS bytes_hex, NULL::VARCHAR AS token, false AS is_special FROM vocab
UNION ALL SELECT id, hex(encode(token)), token, true FROM specials""",
        more=O.VOCAB + O.SPECIALS,
    ),
}
