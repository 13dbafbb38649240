"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import decontamination, pieces, prefix_trie, pseudonyms, role_repair, sharding, shingle_join, style_tree, suffix_array, suffix_tree, token_counts, topk, toxicity

#: Public tokenizer files; the folder is a parameter.
TOKENIZERS = os.environ.get("CORPUSLOOM_TOKENIZERS", "/opt/tokenizers")
PIECE_MODEL = f"{TOKENIZERS}/piece_bpe_32k.model"
RANKS = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"
#: Pseudonyms are as secret as this key: set one of your own.
PSEUDONYM_KEY = os.environ.get("CORPUSLOOM_PSEUDONYM_KEY", "a key for trials only").encode()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share 85 % of their four-word shingles."""
    return shingle_join.jaccard_components(table(spark, sf_dir, "documents"), size=4, percent=85)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every text, and whether decoding gives the text back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = pieces.round_trips(docs, pieces.PieceModel(PIECE_MODEL))
    return encoded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_pieces"), "round_trip")


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return style_tree.extract(table(spark, sf_dir, "pages"))


def op4_repeated_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text without the words of windows of 50 words that stand in a document before it."""
    found = suffix_tree.without_repeated_words(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text without the bytes of windows of 100 bytes that begin somewhere before."""
    found = suffix_array.without_repeated_bytes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text with pseudonyms for personal data."""
    return pseudonyms.pseudonymize(table(spark, sf_dir, "documents"), PSEUDONYM_KEY)


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best candidates of every fiftieth vector by integer inner product."""
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and word pieces of every text."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"), token_counts.Automaton(token_counts.read_ranks(RANKS)))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every text, learned without the held-out quarter of the labels."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit_without_held_out(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", toxicity.held_out().alias("held_out"), model.score("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item that a document holds within the edit distance."""
    return decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of conversations that begin like the first of their five."""
    turns = prefix_trie.numbered_turns(table(spark, sf_dir, "conversations"))
    borrowed = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    rebuilt, ids = prefix_trie.with_heads_of(turns, F.col("conv_id") - F.col("conv_id") % 5, borrowed, most=8)
    nodes, ends = prefix_trie.trie(rebuilt, ids)
    named = nodes.join(prefix_trie.joined_ids(ends), ["node1", "node2"], "left").drop("node1", "node2")
    return named.withColumn("ends_sha256", F.coalesce("sha256", F.sha2(F.lit(""), 256))).drop("sha256")


def op12_uniform_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards, uniformly shuffled, counts at most one apart."""
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + F.lit(1).cast("long")).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
    return sharding.uniform_shards(docs, shards=8, seed=12)


def op13_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and the cheapest repair of every conversation, one turn in four damaged."""
    return role_repair.repair_report(role_repair.damaged(table(spark, sf_dir, "conversations")))


_REGISTERED = (
    op1_ngram_jaccard_join,
    op2_sentencepiece,
    op3_html_text,
    op4_repeated_words,
    op5_repeated_bytes,
    op6_pseudonyms,
    op7_top_k,
    op8_token_counts,
    op9_toxicity,
    op10_decontamination,
    op11_prefix_trie,
    op12_uniform_shards,
    op13_role_repair,
)
QUERIES = {query.__name__: query for query in _REGISTERED}

ORACLES = {
    "op4_repeated_words": """
        WITH words AS (
            SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
        ), windows AS (
            SELECT doc_id, i, array_to_string(w[i : i + 49], ' ') AS said FROM words, range(1, len(w) - 48) AS r(i)
        ), first AS (
            SELECT said, min(doc_id) AS doc_id FROM windows GROUP BY said
        ), hit AS (
            SELECT w.doc_id, w.i FROM windows w JOIN first f ON w.said = f.said WHERE w.doc_id > f.doc_id
        ), gone AS (
            SELECT DISTINCT doc_id, i + k AS i FROM hit, range(50) AS r(k)
        ), kept AS (
            SELECT s.doc_id, string_agg(s.word, ' ' ORDER BY s.i) AS text, count(*) AS n
            FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words) s
            ANTI JOIN gone g ON s.doc_id = g.doc_id AND s.i = g.i GROUP BY s.doc_id
        )
        SELECT w.doc_id, len(w.w)::BIGINT AS n_words, (len(w.w) - coalesce(k.n, 0))::BIGINT AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
        FROM words w LEFT JOIN kept k USING (doc_id)
    """,
    "op7_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.e, v.e)::BIGINT AS score FROM v AS q, v WHERE q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id
        )
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s
        QUALIFY rank <= 5
    """,
    "op11_prefix_trie": """
        WITH turns AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) - 1 AS pos
            FROM conversations WHERE conv_id IS NOT NULL
        ), convs AS (
            SELECT conv_id, conv_id - conv_id % 5 AS lender, xor(4294967295, list_reduce(
                list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
                lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, 3988292384 * (a & 1)) END)) % 9 AS h
            FROM (SELECT DISTINCT conv_id FROM turns)
        ), said AS (
            SELECT c.conv_id, 0 AS own, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.lender AND t.pos < c.h
            UNION ALL SELECT c.conv_id, 1, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos >= c.h
        ), path AS (
            SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY own, pos) AS depth, strlen(text) AS bytes,
                   string_agg(md5(length(role) || ':' || role || text), ',') OVER (PARTITION BY conv_id ORDER BY own, pos) AS node
            FROM said
        ), member AS (
            SELECT conv_id, depth, bytes, node, coalesce(lag(node) OVER (PARTITION BY conv_id ORDER BY depth), '') AS parent,
                   depth = count(*) OVER (PARTITION BY conv_id) AS ends FROM path
            UNION ALL SELECT conv_id, 0, 0, '', NULL, conv_id NOT IN (SELECT conv_id FROM path) FROM convs
        ), nodes AS (
            SELECT node, min(parent) AS parent, min(conv_id) AS conv_id, min(depth) AS depth, count(*) AS n_convs, (count(*) - 1) * min(bytes) AS saved,
                   sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
            FROM member GROUP BY node
        ), children AS (
            SELECT parent, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY parent
        ), below AS (
            SELECT n.node, count(*) FILTER (WHERE b.node NOT IN (SELECT parent FROM children)) AS n_leaves, sum(b.saved) AS saved
            FROM nodes n JOIN nodes b ON b.node = n.node OR n.node = '' OR starts_with(b.node, n.node || ',') GROUP BY n.node
        )
        SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs, coalesce(c.n, 0)::BIGINT AS n_children,
               b.n_leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens, n.ends_sha256
        FROM nodes n JOIN below b USING (node) LEFT JOIN nodes p ON p.node = n.parent LEFT JOIN children c ON c.parent = n.node
    """,
}
