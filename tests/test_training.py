import random
from collections import Counter

import golden
import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.functions import sequences as S
from corpusloom.functions.patterns import CHAT_PATTERN, GPT4_PATTERN
from corpusloom.operators import pairs
from corpusloom.plans import training
from corpusloom.plans.tokenizer import CorpusTokenizer


def as_tuples(merges):
    assert [m.rank for m in merges] == list(range(len(merges)))
    return [(m.a, m.b, m.new_id, m.cnt) for m in merges]


def seq_frame(spark, *id_lists):
    rows = [("".join(map(S.symbol, ids)), 1) for ids in id_lists]
    return spark.createDataFrame(rows, "seq string, cnt long")


def test_pair_counts_example(spark):
    rows = pairs.with_pair_ids(pairs.pair_counts(seq_frame(spark, [1, 2, 3, 1, 2]))).collect()
    assert {(r.a, r.b): r.n for r in rows} == {(1, 2): 2, (2, 3): 1, (3, 1): 1}


def test_pair_counts_overlap_and_accumulate(spark):
    counts = pairs.pair_counts(seq_frame(spark, [5, 5, 5], [], [7]))
    assert [(r.pair, r.n) for r in counts.collect()] == [("\x05\x05", 2)]
    assert pairs.pair_counts(seq_frame(spark, [5, 5]), into=counts).first().n == 3


@pytest.mark.parametrize("length", [199, 200, 201, 202, 399, 400, 401, 402, 403, 1000])
def test_grams_of_long_sequences(spark, length):
    seq = "".join(chr(300 + i % 97) for i in range(length))
    df = spark.createDataFrame([(seq,)], "seq string")
    for size in (2, 3):
        rows = pairs.explode_grams(df, size).orderBy("off").collect()
        assert [(r.off, r.gram) for r in rows] == [(i, seq[i : i + size]) for i in range(length - 1)]


def test_merge_example(spark):
    df = seq_frame(spark, [1, 2, 3, 1, 2]).select(S.ids(pairs.merge_pair(F.col("seq"), 1, 2, 4)))
    assert df.first()[0] == [4, 3, 4]


@pytest.mark.parametrize("n", range(2, 8))
def test_merge_of_equal_tokens(spark, n):
    df = seq_frame(spark, [9] * n).select(S.ids(pairs.merge_pair(F.col("seq"), 9, 9, 300)))
    assert df.first()[0] == golden.merge([9] * n, (9, 9), 300)


def test_ids_around_the_surrogates(spark):
    tokens = [0, 255, 256, S.SURROGATES - 1, S.SURROGATES, 65536, S.MAX_TOKENS - 1]
    df = seq_frame(spark, tokens).select(S.ids(F.col("seq")))
    assert df.first()[0] == tokens
    with pytest.raises(ValueError):
        S.symbol(S.MAX_TOKENS)


def test_deltas_lead_to_recounted_pairs(spark):
    words = seq_frame(spark, [1, 1, 1, 1], [1, 2, 1, 2], [3, 1, 1, 2], [4, 5]).withColumn("cnt", F.lit(3).cast("long"))
    merges = [(1, 1, 256), (256, 2, 257)]
    before = pairs.pair_counts(words, weight="cnt")
    updated = pairs.apply_deltas(before, pairs.pair_deltas(words, merges))
    recount = pairs.pair_counts(words.withColumn("seq", S.fold(F.col("seq"), merges)), weight="cnt")
    assert sorted(map(tuple, updated.collect())) == sorted(map(tuple, recount.collect()))


@pytest.mark.parametrize("pattern", [GPT4_PATTERN, None])
def test_training_equals_python(docs, texts, pattern):
    merges = as_tuples(training.train_bpe(docs, 256 + 25, pattern))
    if pattern:
        assert merges == golden.train(texts, 25, pattern)
    else:
        assert [m[3] for m in merges] == sorted((m[3] for m in merges), reverse=True)
        assert merges == golden.train(texts, 25, None)


@pytest.mark.parametrize("pattern", [GPT4_PATTERN, None])
def test_first_seen_ties_equal_python(docs, texts, pattern):
    merges = training.train_bpe(docs, 256 + 12, pattern, tie="first_seen", order="doc_id")
    assert as_tuples(merges) == golden.train(texts, 12, pattern, first_seen=True)


def test_batching_changes_nothing(spark, corpus):
    some = corpus.where("doc_id < 20")
    together = training.train_bpe(some, 256 + 40, CHAT_PATTERN)
    singly = training.train_bpe(some, 256 + 40, CHAT_PATTERN, batch=False)
    assert together == singly
    counts = [m.cnt for m in together]
    assert counts == sorted(counts, reverse=True)


def recounted(before, after):
    counts = Counter(after[i : i + 2] for i in range(len(after) - 1))
    counts.subtract(before[i : i + 2] for i in range(len(before) - 1))
    return {pair: n for pair, n in counts.items() if n}


def test_changes_of_pairs_equal_a_recount():
    pick = random.Random(4)
    for _ in range(2000):
        seq = "".join(pick.choice("aab") for _ in range(pick.randrange(2, 40)))
        pair = pick.choice(["aa", "ab", "ba", "bb"])
        after, sums = seq.replace(pair, "X"), Counter()
        training.add_changes(sums, seq, pair, "X", 1)
        assert {p: n for p, n in sums.items() if n} == recounted(seq, after)
        sums = Counter()
        for changed, n in training.long_changes(seq, after, "X"):
            sums[changed] += n
        assert {p: n for p, n in sums.items() if n} == recounted(seq, after)


@pytest.mark.parametrize("first_seen", [False, True])
def test_generations_and_index_change_nothing(spark, corpus, monkeypatch, first_seen):
    """Few followed pairs, short generations and an index from the first small round on."""
    some = corpus.where("doc_id < 12")
    tie = {"tie": "first_seen", "order": "doc_id"} if first_seen else {}
    for name, value in (("FOLLOWED", 300), ("GENERATION_MERGES", 9), ("INDEX_SHARE", 0), ("INDEXED_LENGTH", 9), ("LISTED_TIES", 5)):
        monkeypatch.setattr(training, name, value)
    found = training.train_bpe(some, 256 + 30, CHAT_PATTERN, **tie)
    texts = [r.text for r in some.orderBy("doc_id").collect()]
    assert as_tuples(found) == golden.train(texts, 30, CHAT_PATTERN, first_seen=first_seen)


def test_a_round_reads_what_it_changes(spark, corpus, monkeypatch):
    monkeypatch.setattr(training, "INDEX_SHARE", 0)
    monkeypatch.setattr(training, "GENERATION_MERGES", 60)
    rounds = []
    training.train_on_chunks(pairs.chunk_counts(corpus, CHAT_PATTERN), 120, rounds=rounds)
    words = pairs.chunk_counts(corpus, CHAT_PATTERN).count()
    assert sum(r.made for r in rounds) == 120
    late = [r for r in rounds[len(rounds) // 2 :]]
    assert all(r.changed <= r.read for r in rounds) and sum(r.read for r in late) < len(late) * words


def test_one_long_text(spark):
    """A text of 10 MB, half of it one run, with merges across it."""
    text = "a" * 5_000_000 + "abcab " * 833_333
    docs = spark.createDataFrame([(0, text), (1, "abab")], "doc_id long, text string")
    merges = training.train_bpe(docs, 256 + 8, None, tie="first_seen", order="doc_id")
    expected, seqs = [], [text, "abab"]
    for rank in range(8):
        counts, first = Counter(), {}
        for d, seq in enumerate(seqs):
            codes = np.frombuffer(seq.encode("utf-32-le"), "<u4").astype("int64")
            pairs_of, at, n = np.unique(codes[:-1] << 32 | codes[1:], return_index=True, return_counts=True)
            for code, i, m in zip(pairs_of.tolist(), at.tolist(), n.tolist()):
                pair = chr(code >> 32) + chr(code & 0xFFFFFFFF)
                counts[pair] += m
                first.setdefault(pair, (d, i))
        pair = min(counts, key=lambda p: (-counts[p], first[p]))
        expected.append((S.token_id(pair[0]), S.token_id(pair[1]), 256 + rank, counts[pair]))
        seqs = [seq.replace(pair, S.symbol(256 + rank)) for seq in seqs]
    assert as_tuples(merges) == expected


def test_prefix_stops_at_touching_pairs():
    class Row:
        def __init__(self, pair, n, bound):
            self.pair, self.n, self.bound = pair, n, bound

    take = lambda *rows: len(training._independent_prefix([Row(*r) for r in rows]))
    assert take(("ab", 9, 1), ("cd", 8, 1), ("ad", 7, 1)) == 3
    assert take(("ab", 9, 1), ("bc", 8, 1)) == 1
    assert take(("ab", 9, 1), ("ca", 8, 1)) == 1
    assert take(("aa", 9, 1), ("ac", 8, 1)) == 1
    assert take(("ab", 9, 8), ("cd", 8, 1)) == 1
    assert take() == 0


def test_training_stops_when_no_pair_is_left(spark):
    df = spark.createDataFrame([(0, "abab")], "doc_id long, text string")
    assert as_tuples(training.train_bpe(df, 400)) == golden.train(["abab"], 144, GPT4_PATTERN)
    assert len(training.train_bpe(df, 400, tie="first_seen", order="doc_id")) == 2
    empty = df.where("doc_id < 0")
    assert training.train_bpe(empty, 300) == []


def test_vocab_size_limits(docs):
    assert training.train_bpe(docs, 256) == []
    with pytest.raises(ValueError):
        training.train_bpe(docs, 255)
    with pytest.raises(ValueError):
        training.train_bpe(docs, 300, tie="random")
    with pytest.raises(ValueError):
        CorpusTokenizer.train(docs, 264)


def test_special_ids_follow_the_last_merge(spark):
    df = spark.createDataFrame([("abab",)], "text string")
    tok = CorpusTokenizer.train(df, 600)
    assert tok.bos_id == 256 + len(tok.merges) and tok.vocab_size == tok.bos_id + 9


def test_long_words_are_joined(spark, monkeypatch):
    """Whole texts are looked at many at a time: pairs do not cross texts, copies count, first places settle ties."""
    rows = [(i, "".join(chr(97 + (i * 7 + j * j) % 5) for j in range(70 + i)) * (1 + i % 2)) for i in range(9)]
    rows += [(20, rows[3][1]), (21, rows[3][1]), (22, "short"), (23, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2, "doc_id")
    texts = [list(text.encode()) for _, text in rows if text]
    expected = []
    for new in range(256, 261):
        counts, first = {}, {}
        for i, text in enumerate(texts):
            for j, pair in enumerate(zip(text, text[1:])):
                counts[pair] = counts.get(pair, 0) + 1
                first.setdefault(pair, (i, j))
        pair = min(counts, key=lambda p: (-counts[p], first[p]))
        expected.append((*pair, new, counts[pair]))
        texts = [_merged(text, pair, new) for text in texts]
    for length, dense in ((training.JOINED_LENGTH, training.DENSE_SYMBOLS), (100, 2)):
        monkeypatch.setattr(training, "JOINED_LENGTH", length)
        monkeypatch.setattr(training, "DENSE_SYMBOLS", dense)
        merges = training.train_bpe(docs, 261, None, tie="first_seen", order="doc_id")
        assert [(m.a, m.b, m.new_id, m.cnt) for m in merges] == expected


def _merged(text, pair, new):
    out, i = [], 0
    while i < len(text):
        if tuple(text[i : i + 2]) == pair:
            out.append(new)
            i += 2
        else:
            out.append(text[i])
            i += 1
    return out
