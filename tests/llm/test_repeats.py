"""Near copies and repeats against plain versions."""

import random

import brute
import numpy as np
import pytest

from corpusloom.llm import components, shingle_join, suffix_array, suffix_tree
from corpusloom.llm.flat import gram_hashes, leftmost_minima


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(5)


@pytest.mark.parametrize("size, percent", [(4, 85), (5, 80), (1, 100)])
def test_jaccard_components(spark, mutated, size, percent):
    found = {r[0]: tuple(r[1:]) for r in shingle_join.jaccard_components(frame(spark, mutated), size=size, percent=percent).collect()}
    assert found == brute.jaccard_components(mutated, size, percent)


def test_large_groups_lose_no_link(spark, monkeypatch):
    """Near copies that reach the first only through others, in groups too large for all pairs."""
    pick, words, rows = random.Random(3), [f"w{i}" for i in range(120)], []
    for i in range(60):
        words = list(words)
        words[pick.randrange(120)] = f"n{i}"
        rows.append((i, " ".join(words)))
    found = {r[0]: tuple(r[1:]) for r in shingle_join.jaccard_components(frame(spark, rows), size=4, percent=85).collect()}
    assert found == brute.jaccard_components(rows, 4, 85)


def test_jaccard_odd_rows(odd, none, unique_rows):
    found = shingle_join.jaccard_components(odd, size=4, percent=85).collect()
    plain = brute.jaccard_components(unique_rows, 4, 85)
    assert len(found) == odd.count()
    for row in found:
        if row.doc_id is None:
            assert row.component_id is None and row.n_shingles == plain[5][0]
        else:
            assert (row.n_shingles, row.component_id) == plain[row.doc_id]
    assert shingle_join.jaccard_components(none).collect() == []


def test_one_of_each_keeps_columns(odd, none):
    kept = shingle_join.one_of_each(odd)
    assert kept.columns == odd.columns
    # 6 and 7 are copies of 5, which stands three times; 12 is a near copy of 11; the row without id stays.
    ids = sorted(r.doc_id for r in kept.where("doc_id is not null").collect())
    assert ids == [0, 1, 2, 3, 4, 5, 5, 5, 8, 9, 10, 11, 13] and kept.where("doc_id is null").count() == 1
    assert shingle_join.one_of_each(none).count() == 0


def test_components_of_chains(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 40)] + [(100, 99), (5, 5)], "a long, b long")
    found = dict(map(tuple, components.components(links).collect()))
    assert found == {i: 0 for i in range(41)} | {99: 99, 100: 99}


@pytest.mark.parametrize("window, gram", [(50, 20), (8, 3)])
def test_repeated_words(spark, mutated, window, gram):
    found = {r[0]: (r.n_words, r.n_removed, r.kept) for r in suffix_tree.without_repeated_words(frame(spark, mutated), window=window, gram=gram).collect()}
    assert found == brute.without_repeated_words(mutated, window)


@pytest.mark.parametrize("window, gram", [(100, 40), (40, 8)])
def test_repeated_bytes(spark, mutated, window, gram):
    rows = [*mutated, (len(mutated), "ab" * 300), (len(mutated) + 1, "é" * 200 + "ab" * 80), (len(mutated) + 2, "a" * 1000)]
    found = {r[0]: tuple(r[1:4]) + (bytes(r.kept),) for r in suffix_array.without_repeated_bytes(frame(spark, rows), window=window, gram=gram).collect()}
    assert found == brute.without_repeated_bytes(rows, window)


def test_repeats_odd_rows(odd, none, unique_rows):
    plain = brute.without_repeated_words(unique_rows, 50)
    found = suffix_tree.without_repeated_words(odd).collect()
    assert len(found) == odd.count()
    for row in found:
        assert (row.n_words, row.n_removed, row.kept) == plain[5 if row.doc_id is None else row.doc_id]
    plain = brute.without_repeated_bytes(unique_rows, 100)
    found = suffix_array.without_repeated_bytes(odd).collect()
    assert len(found) == odd.count()
    for row in found:
        assert (row.n_bytes, row.n_removed, row.n_spans, bytes(row.kept)) == plain[5 if row.doc_id is None else row.doc_id]
    assert suffix_tree.without_repeated_words(none).collect() == suffix_array.without_repeated_bytes(none).collect() == []


def test_texts_under_one_id(spark):
    """Two texts of one id are no repeats of each other, but both are of a smaller id."""
    text = " ".join(f"w{i}" for i in range(80))
    rows = [(3, text), (3, text + " end"), (5, text)]
    found = sorted((r.doc_id, r.n_words, r.n_removed) for r in suffix_tree.without_repeated_words(frame(spark, rows)).collect())
    assert found == [(3, 80, 0), (3, 81, 0), (5, 80, 80)]


def test_suffix_array():
    for trial in range(300):
        pick = random.Random(trial)
        symbols = [pick.randint(1, pick.randint(1, 4)) for _ in range(pick.randint(0, 40))] + [0]
        assert list(suffix_array.suffix_array(np.array(symbols))) == sorted(range(len(symbols)), key=lambda i: symbols[i:])


def test_sliding_minima():
    values = np.random.default_rng(1).integers(0, 6, 300).astype(np.uint64)
    for width in (1, 2, 7, 31, 300):
        assert list(leftmost_minima(values, width)) == [i + int(np.argmin(values[i : i + width])) for i in range(300 - width + 1)]
    assert not len(leftmost_minima(values, 301)) and not len(gram_hashes(values[:3], 4))
