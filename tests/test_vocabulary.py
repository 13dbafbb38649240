import itertools
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from corpusloom.functions.text import escape_control, lossy_utf8, slug
from corpusloom.operators import vocabulary as V
from corpusloom.plans.tokenizer import CorpusTokenizer
from corpusloom.plans.training import TrainedMerge, train_bpe


@pytest.fixture(scope="module")
def merges(corpus):
    return train_bpe(corpus, 256 + 60)


def test_token_bytes_and_recovery(spark, merges):
    known = [bytes([b]) for b in range(256)]
    for m in merges:
        known.append(known[m.a] + known[m.b])
    ranks = V.mergeable_ranks(spark, merges)
    assert [bytes(r.bytes) for r in ranks.orderBy("id").collect()] == known
    recovered = V.recover_merges(ranks).orderBy("rank").collect()
    assert [tuple(r) for r in recovered] == [(m.rank, m.a, m.b, m.new_id) for m in merges]


def test_recovery_refuses_other_vocabularies(spark):
    rows = [(b, bytes([b])) for b in range(256)] + [(256, b"abc")]
    with pytest.raises(Exception, match="not the merge of two"):
        V.recover_merges(spark.createDataFrame(rows, "id int, bytes binary")).collect()


def test_specials_are_unique(spark):
    with pytest.raises(ValueError):
        V.specials_frame(spark, {"a": 1, "b": 1})
    assert V.append_specials(["x", "y"], 300) == {"x": 300, "y": 301}


def hard_bytes():
    random.seed(3)
    singles = [bytes([b]) for b in range(256)]
    doubles = [bytes(p) for p in itertools.product(range(0xC0, 0x100, 3), range(0x70, 0xD0, 5))]
    runs = [bytes(random.randrange(0x80, 0x100) for _ in range(random.randrange(1, 7))) for _ in range(500)]
    return [b"", *singles, *doubles, *runs, "é€\U0001f600".encode(), "é€\U0001f600".encode()[:-1]]


def test_lossy_decoding_equals_python(spark):
    samples = hard_bytes()
    df = spark.createDataFrame(list(enumerate(samples)), "i int, b binary").select("i", lossy_utf8(F.col("b")).alias("t"))
    assert {r.i: r.t for r in df.collect()} == {i: b.decode(errors="replace") for i, b in enumerate(samples)}


def test_rendering_equals_python(spark):
    samples = ["a\nb\x00", "\x7f\x85­é", "​‮", "", "\U000e0001x", "中\U0001f600", ""]
    expected = [
        "".join(c if unicodedata.category(c)[0] != "C" else f"\\u{ord(c):04x}" for c in s) for s in samples
    ]
    df = spark.createDataFrame([(s,) for s in samples], "t string")
    assert [r[0] for r in df.select(escape_control(F.col("t"))).collect()] == expected


def test_listing(spark):
    tok = CorpusTokenizer((TrainedMerge(0, 97, 10, 256, 5), TrainedMerge(1, 256, 195, 257, 4)), "x", {"<|bos|>": 300})
    lines = {r.id: r.line for r in V.listing(tok.vocabulary(spark)).collect()}
    assert lines[97] == "[a] 97"
    assert lines[256] == "[a][\\u000a] -> [a\\u000a] 256"
    assert lines[257] == "[a\\u000a][�] -> [a\\u000a�] 257"
    assert lines[300] == "[<|bos|>] 300"
    sizes = {r.id: (r.n_bytes, r.raw_bytes) for r in V.token_byte_lengths(tok.vocabulary(spark)).collect()}
    assert (sizes[97], sizes[195], sizes[257], sizes[300]) == ((1, 1), (3, 1), (5, 3), (0, 7))


def test_permutation(spark):
    table = [(i * 5 + 1) % 256 for i in range(256)]
    df = spark.createDataFrame([(list(range(256)),)], "ids array<int>")
    there = df.select(V.permute(F.col("ids"), table).alias("ids"))
    assert there.first()[0] == table
    assert there.select(V.permute(F.col("ids"), V.inverse(table))).first()[0] == list(range(256))
    with pytest.raises(ValueError):
        V.byte_permutation(spark.createDataFrame([(0, b"a")], "id int, bytes binary"))


def test_lookups(spark, merges):
    tok = CorpusTokenizer(tuple(merges), None, {"<|bos|>": 900})
    assert tok.vocab_size == 901 and tok.bos_id == 900 and tok.special_names == {"<|bos|>"}
    row = spark.range(1).select(tok.id_to_token(F.lit(97)), tok.id_to_token(F.lit(900)), slug(F.lit("Big Run"))).first()
    assert tuple(row) == ("a", "<|bos|>", "big-run")


def test_repeated_bytes_are_refused(spark):
    rows = [(i, bytes([i])) for i in range(256)] + [(256, b"a")]
    with pytest.raises(ValueError, match="exactly once"):
        V.byte_permutation(spark.createDataFrame(rows, "id int, bytes binary"))


def test_permuted_ranks_come_back(spark):
    order = list(range(256))
    random.Random(1).shuffle(order)
    rows = [(order[b], bytes([b])) for b in range(256)] + [(256, b"th"), (257, b"the")]
    tok = CorpusTokenizer.from_ranks(spark.createDataFrame(rows, "id int, bytes binary"), specials={})
    assert sorted((r.id, bytes(r.bytes)) for r in tok.mergeable_ranks(spark).collect()) == sorted(rows)
    lines = {r.id: r.line for r in V.listing(tok.vocabulary(spark)).collect()}
    assert lines[257] == "[th][e] -> [the] 257" and lines[order[ord("t")]] == f"[t] {order[ord('t')]}"
