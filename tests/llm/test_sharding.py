"""The uniform shuffle into shards."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import catalog, sharding


def test_shards_are_exact_and_whole(odd, none, monkeypatch):
    monkeypatch.setattr(sharding, "UNIT", 4)
    monkeypatch.setattr(sharding, "GROUP", 2)
    clashing = odd.withColumns({"shard": F.lit("old"), "slot": F.lit(9), "at": F.lit(1), "part": F.lit(2), "row": F.lit("r"), "order": F.lit(0)})
    found = sharding.uniform_shards(clashing, 5, seed=3).collect()
    rows = clashing.collect()
    assert sorted(Counter(r.shard for r in found).values()) == sorted(sharding.shard_sizes(len(rows), 5))
    for shard in range(5):
        slots = sorted(r.slot for r in found if r.shard == shard)
        assert slots == list(range(len(slots)))
    same = lambda table: Counter((r.doc_id, r.text, r.doc, r.component, r.kept, r["at"], r.part, r.row, r.order) for r in table)
    assert same(found) == same(rows)
    assert sharding.uniform_shards(none, 5).collect() == []


def test_query(spark, tmp_path):
    rows = [(i, None if i % 7 == 0 else "é" * (i % 5), "x") for i in range(50)] * 2 + [(None, "", "y")]
    spark.createDataFrame(rows, "doc_id long, text string, law string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    found = catalog.op12_uniform_shards(spark, str(tmp_path)).collect()
    data = lambda text: (text or "").encode()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == Counter((i, len(data(t)) + 1, zlib.crc32(data(t))) for i, t, _ in rows)
    assert {(r.law, r.grown_shard) for r in found} == {("rows", None)}
    assert sorted(Counter(r.shard for r in found).values()) == [12] * 3 + [13] * 5


def test_written_shards(spark, tmp_path):
    placed = sharding.uniform_shards(spark.range(1000), 3, seed=1)
    sharding.write_shards(placed, f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(map(tuple, back.select("shard", "slot", "id").collect())) == sorted(map(tuple, placed.select("shard", "slot", "id").collect()))
    assert placed.where("shard = 0").orderBy("slot").limit(20).select("id").collect() != placed.where("shard = 0").orderBy("id").limit(20).select("id").collect()


def test_matrix_has_exact_sums():
    for seed in range(100):
        pick = random.Random(seed)
        parts = [pick.randrange(9) for _ in range(pick.randrange(1, 8))]
        shards = sharding.shard_sizes(sum(parts), pick.randrange(1, 6))
        matrix = sharding.communication_matrix(np.random.default_rng(seed), parts, shards)
        assert [sum(row) for row in matrix] == parts and [sum(column) for column in zip(*matrix)] == shards
        assert min(min(row) for row in matrix) >= 0


def test_every_assignment_is_equally_likely():
    """Five rows in two units and two groups, shards of 3 and 2: ten assignments, 1,000 times each."""
    seen = Counter()
    for seed in range(10_000):
        groups = sharding.communication_matrix(np.random.default_rng([seed, 0]), [2, 3], [3, 2])
        labels = [sharding.dealt_labels(seed, g, 0, np.array(row)) for g, row in enumerate(groups)]
        seen[tuple(np.concatenate(labels))] += 1
    assert len(seen) == 10 and sum((n - 1000) ** 2 / 1000 for n in seen.values()) < 27.9  # 0.1 % for nine degrees of freedom


@pytest.mark.parametrize("good, bad, drawn", [(40, 60, 30), (5, 200, 100), (3, 2, 4), (1000, 1, 500)])
def test_draws_by_inversion(monkeypatch, good, bad, drawn):
    monkeypatch.setattr(sharding, "LIBRARY_LIMIT", 0)
    pick = np.random.default_rng(5)
    found = np.array([sharding.hypergeometric(pick, good, bad, drawn) for _ in range(4000)])
    expected = np.random.default_rng(6).hypergeometric(good, bad, drawn, 400_000)
    share = good / (good + bad)
    spread = (drawn * share * (1 - share) * (good + bad - drawn) / max(good + bad - 1, 1)) ** 0.5
    assert abs(found.mean() - drawn * share) < 4 * spread / 4000**0.5 + 1e-9
    assert abs(found.std() - expected.std()) < 0.06 * spread + 1e-9
    assert found.min() >= expected.min() - 2 * spread and found.max() <= expected.max() + 2 * spread


def test_draws_from_large_populations():
    pick = np.random.default_rng(7)
    good, bad, drawn = 2 * 10**9, 6 * 10**9, 4 * 10**9
    found = np.array([sharding.hypergeometric(pick, good, bad, drawn) for _ in range(20)])
    spread = (drawn * 0.25 * 0.75 * 0.5) ** 0.5
    assert abs(found.mean() - 10**9) < 5 * spread / 20**0.5
