"""Queries over score tables: the embeddings serve as scores, their labels as targets."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.catalog.base import Query, table
from corpusloom.operators import scores as S

TOP_K = 5
TEMPERATURE = 0.7
VECTORS_PER_BATCH = 16


def vectors(spark, sf_dir):
    """Score vectors; label 0 stands for an ignored target."""
    target = F.when(F.col("label") == 0, S.IGNORED_TARGET).otherwise(F.col("label"))
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("row_id"), F.col("embedding").cast("array<double>").alias("logits"), target.alias("target")
    )


def scores(spark, sf_dir):
    return S.score_rows(vectors(spark, sf_dir), "row_id", "logits")


def exploded(frame, vector):
    return S.score_rows(frame.select("row_id", vector.alias("logits")), "row_id", "logits")


def g1_softcap(spark, sf_dir):
    return scores(spark, sf_dir).select("row_id", "token_id", F.round(S.softcap(F.col("logit")), 6).alias("logit"))


def g2_cross_entropy(spark, sf_dir):
    losses = S.cross_entropy(vectors(spark, sf_dir), "row_id", "logits", "target")
    mean = S.reduce_loss(losses).select(F.lit(-1).cast("long").alias("row_id"), "loss")
    return losses.unionByName(mean).select("row_id", F.round("loss", 6).alias("loss"))


def g3_top_k(spark, sf_dir):
    masked = exploded(vectors(spark, sf_dir), S.top_k_mask(F.col("logits"), TOP_K))
    return masked.where(F.col("logit") > float("-inf")).select("row_id", "token_id", F.round("logit", 6).alias("logit"))


def g4_softmax(spark, sf_dir):
    probabilities = exploded(vectors(spark, sf_dir), S.softmax(F.col("logits"), TEMPERATURE))
    return probabilities.select("row_id", "token_id", F.round("logit", 6).alias("prob"))


def g5_greedy(spark, sf_dir):
    return S.greedy(scores(spark, sf_dir))


def g6_draw(spark, sf_dir):
    return S.draw(S.top_k_rows(scores(spark, sf_dir), TOP_K), TEMPERATURE)


def g7_rms_norm(spark, sf_dir):
    normed = exploded(vectors(spark, sf_dir), S.rms_norm(F.col("logits")))
    return normed.select("row_id", "token_id", F.round("logit", 6).alias("value"))


def g8_validation_loss(spark, sf_dir):
    losses = S.cross_entropy(vectors(spark, sf_dir), "row_id", "logits", "target")
    batches = losses.withColumn("batch_id", F.floor(F.col("row_id") / VECTORS_PER_BATCH))
    return S.validation_loss(batches).select(F.round("val_loss", 6).alias("val_loss"))


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (g1_softcap, g2_cross_entropy, g3_top_k, g4_softmax, g5_greedy, g6_draw, g7_rms_norm, g8_validation_loss)
}

_scores = """
WITH s AS (
  SELECT vec_id AS row_id, generate_subscripts(embedding, 1) - 1 AS token_id, unnest(embedding)::DOUBLE AS logit, label
  FROM embeddings)"""
_losses = f"""{_scores},
l AS (
  SELECT row_id, ln(sum(exp(logit - top))) + max(top) - max(CASE WHEN token_id = label THEN logit END) AS loss
  FROM (SELECT *, max(logit) OVER (PARTITION BY row_id) AS top FROM s) WHERE label <> 0 GROUP BY row_id)"""
_top = f"{_scores}, t AS (SELECT *, rank() OVER (PARTITION BY row_id ORDER BY logit DESC) AS place FROM s)"

ORACLES: dict[str, str] = {
    "g1_softcap": f"{_scores} SELECT row_id, token_id, round(15 * tanh(logit / 15), 6) AS logit FROM s",
    "g2_cross_entropy": f"""{_losses}
SELECT row_id, round(loss, 6) AS loss FROM l UNION ALL SELECT -1, round(avg(loss), 6) FROM l""",
    "g3_top_k": f"{_top} SELECT row_id, token_id, round(logit, 6) AS logit FROM t WHERE place <= {TOP_K}",
    "g4_softmax": f"""{_scores}
SELECT row_id, token_id, round(e / sum(e) OVER (PARTITION BY row_id), 6) AS prob FROM (
  SELECT *, exp((logit - max(logit) OVER (PARTITION BY row_id)) / {TEMPERATURE}) AS e FROM s)""",
    "g5_greedy": f"""{_scores}
SELECT row_id, token_id FROM (
  SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY logit DESC, token_id) AS place FROM s) WHERE place = 1""",
    "g6_draw": f"""{_top}
SELECT row_id, token_id FROM (
  SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY logit / {TEMPERATURE} - ln(-ln(u)) DESC, token_id) AS first FROM (
    SELECT *, (('0x' || substr(md5(row_id || ':' || token_id || ':42'), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296 AS u
    FROM t WHERE place <= {TOP_K})) WHERE first = 1""",
    "g7_rms_norm": f"""{_scores}
SELECT row_id, token_id, round(logit / sqrt(avg(logit * logit) OVER (PARTITION BY row_id) + {S.RMS_EPSILON!r}), 6) AS value FROM s""",
    "g8_validation_loss": f"""{_losses}
SELECT round(avg(loss), 6) AS val_loss FROM (
  SELECT row_id // {VECTORS_PER_BATCH} AS batch_id, avg(loss) AS loss FROM l GROUP BY 1) WHERE batch_id < 20""",
}
