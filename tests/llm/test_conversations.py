"""Operators on conversations."""

import itertools
import random
import re

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import catalog, prefix_trie, role_repair

SCHEMA = "conv_id long, turn long, role string, text string, pos string, path int, one int, block long, node1 string"
TRIE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def stored(spark, tmp_path, rows):
    """A folder with the table, with extra columns named like the operators' own."""
    spark.createDataFrame([(*row, "x", 1, 2, 3, "y") for row in rows], SCHEMA).repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    return str(tmp_path)


def made(seed, n=60, turns=9):
    pick = random.Random(seed)
    opening = [("system", "be kind"), ("user", "hello"), ("assistant", "hello to you")]
    rows = []
    for conv in range(-7, n):
        said = opening[: pick.randrange(4)] + [(pick.choice(["user", "assistant"]), pick.choice(["yes", "no", "", "é é"])) for _ in range(pick.randrange(turns))]
        numbers = [None] * pick.randrange(2) + list(range(len(said)))
        rows += [(conv, t, *((None, None) if pick.random() < 0.05 else turn)) for t, turn in zip(numbers, said, strict=False)]
    rows += pick.sample(rows, 10) + [(None, 1, "user", "lost")]
    pick.shuffle(rows)
    return rows


def found_trie(spark, folder):
    return sorted((tuple(r) for r in catalog.op11_prefix_trie(spark, folder).select(TRIE).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_trie(spark, tmp_path, seed):
    rows = made(seed)
    assert found_trie(spark, stored(spark, tmp_path, rows)) == brute.trie(brute.rebuilt_conversations(rows))


def test_trie_of_long_conversations_and_copies(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(prefix_trie, "TURNS_AT_A_TIME", 50)
    long = [("user", f"turn {i}") for i in range(600)]
    said = {5 * c: long[: 100 * c] + ([("user", "other")] if c % 2 else []) for c in range(7)} | {c: long[:3] for c in range(1001, 1200)} | {7: [("user", "x" * 100_000)] * 12}
    rows = [(conv, t, *turn) for conv, turns in said.items() for t, turn in enumerate(turns)]
    assert found_trie(spark, stored(spark, tmp_path, rows)) == brute.trie(brute.rebuilt_conversations(rows))


def test_trie_of_nothing(spark, tmp_path):
    assert found_trie(spark, stored(spark, tmp_path, [(None, 0, "user", "x")])) == []


def test_extents():
    for seed in range(50):
        pick = np.random.default_rng(seed)
        lcp = pick.integers(0, 4, pick.integers(1, 40))
        lcp[0] = 0
        row = pick.integers(0, len(lcp), 30)
        depth = pick.integers(1, 4, 30)
        for i, d, left, right in zip(row, depth, *prefix_trie.extents(lcp, row, depth), strict=True):
            a = max(j for j in range(i + 1) if lcp[j] < d)
            b = next((j for j in range(i + 1, len(lcp)) if lcp[j] < d), len(lcp))
            assert (left, right) == (a, b)


REPAIR = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def found_repairs(spark, folder):
    return sorted((tuple(r) for r in catalog.op13_role_repair(spark, folder).select(REPAIR).collect()), key=str)


@pytest.mark.parametrize("seed", [3, 4])
def test_repair(spark, tmp_path, seed):
    pick = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", "User", None]
    texts = ["Yes.", "no", "What?", " \t\n", "", "é é!", "done. ", None, "x" * 3000 + "!"]
    rows = []
    for conv in [*range(-3, 80), None]:
        turn = pick.randrange(5)
        for i in range(pick.randrange(12)):
            role = roles[i % 2] if pick.random() < 0.7 else pick.choice(roles)
            rows.append((conv, None if pick.random() < 0.05 else turn, role, pick.choice(texts) if pick.random() < 0.5 else f"text {i}."))
            turn += pick.choice([0, 1, 1, 1, 3])
    rows += pick.sample(rows, 15)
    pick.shuffle(rows)
    assert found_repairs(spark, stored(spark, tmp_path, rows)) == brute.repair_report(rows)


def test_repair_of_long_conversations(spark, tmp_path):
    rows = [(1, i, ("user", "assistant", "system")[i % 7 % 3], f"turn {i}" + "." * (i % 5 > 0)) for i in range(1500)]
    rows += [(2, i, "user", "again.") for i in range(200)]
    assert found_repairs(spark, stored(spark, tmp_path, rows)) == brute.repair_report(rows)


def test_repair_of_nothing(spark, tmp_path):
    folder = stored(spark, tmp_path, [(1, 0, "user", "x")])
    empty = spark.read.parquet(f"{folder}/conversations.parquet").where("conv_id < 0")
    assert role_repair.repair_report(role_repair.damaged(empty)).collect() == []


def test_repaired_turns(spark):
    rows = [(1, 0, "assistant", "Hm.", 1), (1, 1, "assistant", "Well", 1), (1, 2, "user", " ", 1), (2, 0, "user", "x.", 0)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, copies int")
    found = role_repair.edits(turns)
    assert [(r.conv_id, r.cost, r.audit) for r in found.where("report").orderBy("conv_id").collect()] == [(1, 10, "RKD"), (2, 0, "")]
    said = role_repair.repaired(turns, found).orderBy("conv_id", "place").collect()
    assert [(r.conv_id, r.place, r.role, r.text) for r in said] == [(1, 0, "user", "Hm."), (1, 1, "assistant", "Well")]


def test_repair_tries_every_edit():
    """All audits of short conversations, written out: none is cheaper, or as cheap and before."""
    for length in range(4):
        for roles in itertools.product("suax", repeat=length):
            repairer = role_repair.Repairer()
            conv = role_repair.Conversation(repairer, 1)
            for i, role in enumerate(roles):
                conv.add(i, role, bytes([i]), i == 2, i == 1)
            report = next(conv.finished())
            best = None
            for audit, cost, said in written_out(roles):
                if legal(said) and (best is None or (cost, audit) < best):
                    best = cost, audit
            assert (report[7], report[8]) == best, roles


def legal(said):
    return re.fullmatch("(s?(ua)+)?", said) is not None


def written_out(roles):
    """Every sequence of edits with at most one insertion between two turns, with its cost and the initials it leaves."""
    options = [[("", 0, ""), ("I", 3, "u"), ("I", 3, "a"), ("II", 6, "ua"), ("II", 6, "au")]]
    for i, role in enumerate(roles):
        cut = 3 * (i == 1)
        options.append([("D", 4, "")] + ([] if i == 2 else [("K", cut, role), ("R", cut + 3, "u"), ("R", cut + 3, "a")]))
        options.append([("", 0, ""), ("I", 3, "u"), ("I", 3, "a")])
    for chosen in itertools.product(*options):
        yield "".join(c[0] for c in chosen), sum(c[1] for c in chosen), "".join(c[2] for c in chosen)
