import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import scores as S


@pytest.fixture(scope="module")
def matrix():
    rng = np.random.default_rng(1)
    m = rng.normal(size=(40, 12)) * 4
    m[0, :] = 1.0
    m[1, 3] = m[1, 5] = 50.0
    return m


@pytest.fixture(scope="module")
def vectors(spark, matrix):
    rows = [(i, row.tolist(), int(i % 13) - 1) for i, row in enumerate(matrix)]
    return spark.createDataFrame(rows, "row_id long, logits array<double>, target int")


def column(vectors, expr):
    return np.array([r.v for r in vectors.select("row_id", expr.alias("v")).orderBy("row_id").collect()])


def test_softcap(vectors, matrix):
    got = column(vectors, F.transform("logits", lambda x: S.softcap(x)))
    np.testing.assert_allclose(got, 15 * np.tanh(matrix / 15))


@pytest.mark.parametrize("temperature", [1.0, 0.3])
def test_softmax(vectors, matrix, temperature):
    e = np.exp((matrix - matrix.max(1, keepdims=True)) / temperature)
    np.testing.assert_allclose(column(vectors, S.softmax(F.col("logits"), temperature)), e / e.sum(1, keepdims=True))


@pytest.mark.parametrize("k", [1, 2, 5, 12, 100])
def test_top_k_keeps_ties(vectors, matrix, k):
    limit = np.sort(matrix, axis=1)[:, -min(k, 12)][:, None]
    expected = np.where(matrix < limit, -np.inf, matrix)
    np.testing.assert_array_equal(column(vectors, S.top_k_mask(F.col("logits"), k)), expected)
    kept = S.top_k_rows(S.score_rows(vectors, "row_id", "logits"), k).count()
    assert kept == np.isfinite(expected).sum()


def test_cross_entropy(vectors, matrix):
    losses = S.cross_entropy(vectors, "row_id", "logits", "target")
    logsum = np.log(np.exp(matrix).sum(1))
    expected = {i: logsum[i] - matrix[i, i % 13 - 1] for i in range(40) if i % 13}
    got = {r.row_id: r.loss for r in losses.collect()}
    assert got.keys() == expected.keys()
    assert all(abs(got[i] - expected[i]) < 1e-9 for i in got)
    mean, total = S.reduce_loss(losses).first()[0], S.reduce_loss(losses, "sum").first()[0]
    assert abs(mean * len(got) - total) < 1e-9 and S.reduce_loss(losses, "none") is losses
    with pytest.raises(ValueError):
        S.reduce_loss(losses, "max")
    batches = losses.withColumn("batch_id", F.floor(F.col("row_id") / 10))
    means = [np.mean([expected[i] for i in expected if i // 10 == b]) for b in range(2)]
    assert abs(S.validation_loss(batches, 2).first()[0] - np.mean(means)) < 1e-9


def test_rms_norm(vectors, matrix):
    expected = matrix / np.sqrt((matrix**2).mean(1, keepdims=True))
    np.testing.assert_allclose(column(vectors, S.rms_norm(F.col("logits"))), expected)


def test_greedy_and_draw(spark, vectors, matrix):
    scores = S.score_rows(vectors, "row_id", "logits")
    picked = {r.row_id: r.token_id for r in S.greedy(scores).collect()}
    assert picked == {i: int(row.argmax()) for i, row in enumerate(matrix)}
    assert {r.row_id: r.token_id for r in S.draw(scores, temperature=0).collect()} == picked
    assert sorted(S.draw(scores).collect()) == sorted(S.draw(scores).collect())
    many = spark.range(4000).select(F.col("id").alias("row_id"), F.array(F.lit(0.0), F.log(F.lit(3.0))).alias("l"))
    share = S.draw(S.score_rows(many, "row_id", "l")).agg(F.avg("token_id")).first()[0]
    assert abs(share - 0.75) < 0.03


@pytest.mark.parametrize("target", [12, -2, None])
def test_targets_out_of_range_fail(spark, target):
    rows = spark.createDataFrame([(0, [0.0] * 12, 3), (1, [0.0] * 12, target)], "row_id long, logits array<double>, target int")
    with pytest.raises(Exception, match="target out of range"):
        S.reduce_loss(S.cross_entropy(rows, "row_id", "logits", "target")).collect()


def test_rms_norm_of_zeros(spark):
    row = spark.sql("select array(0d, 0d, 0d) as v").select(S.rms_norm(F.col("v"))).first()
    assert row[0] == [0.0, 0.0, 0.0]
