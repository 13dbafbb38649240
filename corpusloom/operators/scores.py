"""Operators over score tables ``(row_id, token_id, logit)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values.
SOFTCAP = 15.0
IGNORED_TARGET = -1
SEED = 42
VALIDATION_BATCHES = 20
# The smallest step of a 32-bit float above 1.
RMS_EPSILON = 2.0**-23


def score_rows(vectors: DataFrame, row: str, vector: str) -> DataFrame:
    """One row per score from a table of score vectors."""
    return vectors.select(
        F.col(row).alias("row_id"), F.posexplode(F.col(vector).cast("array<double>")).alias("token_id", "logit")
    )


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once: a lambda would compute it per element."""
    return F.transform(F.array(value), body)[0]


def softcap(logit: Column, cap: float = SOFTCAP) -> Column:
    return F.tanh(logit / cap) * cap


def cross_entropy(vectors: DataFrame, row: str, vector: str, target: str, ignore: int = IGNORED_TARGET) -> DataFrame:
    """``(row_id, loss)`` of rows whose target is not ignored.

    A target that is null or no index of the scores fails the job. A row carries
    its whole score vector, so no shuffle is needed.
    """
    logits = F.col(vector).cast("array<double>")
    total = lambda top: F.aggregate(logits, F.lit(0.0), lambda acc, x: acc + F.exp(x - top))
    log_total = bind(F.array_max(logits), lambda top: F.log(total(top)) + top)
    chosen = F.coalesce(F.col(target), F.lit(-1))
    refused = F.raise_error(F.concat(F.lit("target out of range: "), F.coalesce(F.col(target).cast("string"), F.lit("null"))))
    picked = F.when((chosen >= 0) & (chosen < F.size(logits)), F.get(logits, chosen)).otherwise(refused.cast("double"))
    loss = log_total - picked
    return vectors.where(~F.col(target).eqNullSafe(F.lit(ignore))).select(F.col(row).alias("row_id"), loss.alias("loss"))


def reduce_loss(losses: DataFrame, how: str = "mean") -> DataFrame:
    """Loss per row (``none``), or one row with its ``mean`` or ``sum``."""
    if how == "none":
        return losses
    if how not in ("mean", "sum"):
        raise ValueError(f"reduction must be 'none', 'mean' or 'sum', not {how!r}")
    return losses.agg((F.avg("loss") if how == "mean" else F.sum("loss")).alias("loss"))


def top_k_mask(vector: Column, k: int) -> Column:
    """Scores below the ``k``-th largest become -infinity; ties with it are kept."""
    ordered = F.sort_array(vector, asc=False)
    last = F.element_at(ordered, F.least(F.lit(k), F.size(vector)))
    low = F.lit(float("-inf"))
    return bind(last, lambda limit: F.transform(vector, lambda x: F.when(x < limit, low).otherwise(x)))


def top_k_rows(scores: DataFrame, k: int) -> DataFrame:
    """Score rows that survive the top-k mask (ties kept)."""
    best = Window.partitionBy("row_id").orderBy(F.desc("logit"))
    return scores.withColumn("_rank", F.rank().over(best)).where(F.col("_rank") <= k).drop("_rank")


def softmax(vector: Column, temperature: float = 1.0) -> Column:
    weights = lambda top: F.transform(vector, lambda x: F.exp((x - top) / temperature))
    total = lambda values: F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)
    shares = lambda values: bind(total(values), lambda t: F.transform(values, lambda w: w / t))
    return bind(bind(F.array_max(vector), weights), shares)


def greedy(scores: DataFrame) -> DataFrame:
    """Token with the highest score per row; the smaller id on a tie."""
    best = F.max_by("token_id", F.struct("logit", -F.col("token_id")))
    return scores.groupBy("row_id").agg(best.alias("token_id"))


def uniform(row: Column, token: Column, seed: int = SEED) -> Column:
    """A number in (0, 1) that depends on nothing but row, token and seed."""
    digest = F.md5(F.concat_ws(":", row.cast("string"), token.cast("string"), F.lit(str(seed))))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0


def draw(scores: DataFrame, temperature: float = 1.0, seed: int = SEED) -> DataFrame:
    """One token per row, with the probabilities of the softmax (Gumbel maximum).

    A temperature that is not positive picks greedily.
    """
    if temperature <= 0:
        return greedy(scores)
    noise = -F.log(-F.log(uniform(F.col("row_id"), F.col("token_id"), seed)))
    noisy = scores.withColumn("logit", F.col("logit") / temperature + noise)
    return greedy(noisy)


def rms_norm(vector: Column, eps: float = RMS_EPSILON) -> Column:
    """Divide by the root of the mean square, to which ``eps`` is added; zeros stay zeros."""
    squares = F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x * x)
    return bind(F.sqrt(squares / F.size(vector) + eps), lambda scale: F.transform(vector, lambda x: x / scale))


def validation_loss(losses: DataFrame, batches: int = VALIDATION_BATCHES) -> DataFrame:
    """Mean of the first ``batches`` batch means of ``(batch_id, loss)``."""
    means = losses.where(F.col("batch_id") < batches).groupBy("batch_id").agg(F.avg("loss").alias("loss"))
    return means.agg(F.avg("loss").alias("val_loss"))
