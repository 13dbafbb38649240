import golden
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.functions.patterns import CHAT_PATTERN, GPT2_PATTERN, GPT4_PATTERN, GPT4_SPECIALS
from corpusloom.operators import codec, vocabulary
from corpusloom.plans.tokenizer import CorpusTokenizer
from corpusloom.plans.training import TrainedMerge


@pytest.fixture(scope="module")
def tok(docs):
    trained = CorpusTokenizer.train(docs, 256 + 40, GPT4_PATTERN, specials=())
    return trained.register_specials({"<|bos|>": 400, "<|end|>": 100276})


def learned(tok):
    return [(m.a, m.b, m.new_id) for m in tok.merges]


@pytest.mark.parametrize("fold_limit", [1000, 0])
def test_encode_equals_python(docs, texts, tok, fold_limit):
    rows = docs.select("doc_id", tok.encode("text", fold_limit=fold_limit).alias("ids")).collect()
    assert {r.doc_id: r.ids for r in rows} == {
        i: golden.encode(t, learned(tok), GPT4_PATTERN) for i, t in enumerate(texts)
    }


@pytest.mark.parametrize("fold_limit", [1000, 0])
def test_many_merges(spark, corpus, fold_limit):
    """More merges than are folded by default, on whole texts."""
    some = corpus.where("doc_id < 6")
    tok = CorpusTokenizer.train(corpus.where("doc_id < 40"), 256 + 100, specials=())
    assert len(tok.merges) > 12
    rows = some.select("text", tok.encode("text", fold_limit=fold_limit).alias("ids")).collect()
    for r in rows:
        assert r.ids == golden.encode(r.text, learned(tok), tok.pattern)
    assert tok.round_trip_failures(corpus).count() == 0


@pytest.mark.parametrize("fold_limit", [1000, 0])
def test_null_texts_stay_null(spark, tok, fold_limit):
    df = spark.createDataFrame([(0, None), (1, "ab"), (2, ""), (3, None)], "i int, text string").coalesce(1)
    rows = df.select("i", tok.encode("text", fold_limit=fold_limit).alias("ids")).collect()
    assert {r.i: r.ids for r in rows} == {0: None, 1: golden.encode("ab", learned(tok), GPT4_PATTERN), 2: [], 3: None}


def test_whole_text_encoding(docs, texts):
    tok = CorpusTokenizer.train(docs, 256 + 10, pattern=None, specials=(), tie="first_seen", order="doc_id")
    rules = golden.train(texts, 10, None, first_seen=True)
    rows = docs.select("doc_id", tok.encode("text").alias("ids")).collect()
    assert {r.doc_id: r.ids for r in rows} == {i: golden.encode(t, rules, None) for i, t in enumerate(texts)}


@pytest.mark.parametrize("fold_limit", [1000, 0])
def test_specials(spark, tok, fold_limit):
    text = "a  <|bos|> b<|end|><|end|>"
    df = spark.createDataFrame([(text,)], "text string")
    plain = lambda s: golden.encode(s, learned(tok), GPT4_PATTERN)
    one = lambda policy: df.select(tok.encode("text", allowed_special=policy, fold_limit=fold_limit)).first()[0]
    end = 100276
    assert one("all") == plain("a  ") + [400] + plain(" b") + [end, end]
    assert one("none") == plain(text)
    assert one({"<|end|>"}) == plain("a  <|bos|> b") + [end, end]
    with pytest.raises(Exception, match="special token"):
        one("none_raise")
    decoded = df.select(tok.decode(tok.encode("text", allowed_special="all"))).first()[0]
    assert decoded == text


def test_prepend_and_append(spark, tok):
    df = spark.createDataFrame([("ab",), ("",)], "text string")
    rows = df.select(tok.encode("text", prepend="<|bos|>", append=7).alias("ids")).collect()
    assert [r.ids for r in rows] == [[400, *golden.encode("ab", learned(tok), GPT4_PATTERN), 7], [400, 7]]
    with pytest.raises(KeyError):
        tok.encode("text", prepend="<|unknown|>")
    with pytest.raises(ValueError):
        tok.encode(3)


def test_round_trip(docs, tok):
    assert tok.round_trip_failures(docs).count() == 0


def test_decode_is_lossy_and_strict(spark, tok):
    df = spark.createDataFrame([([0xC3],), ([104, 0xFF, 105],)], "ids array<int>")
    assert [r[0] for r in df.select(tok.decode("ids")).collect()] == ["�", "h�i"]
    bad = spark.createDataFrame([([104, 399],)], "ids array<int>")
    with pytest.raises(Exception, match="invalid token id: 399"):
        bad.select(tok.decode("ids")).collect()
    assert [tuple(r) for r in codec.unknown_ids(bad, tok.vocabulary(spark)).collect()] == [(399, 1)]


def test_permuted_ranks(spark, docs, tok):
    permutation = [(i * 7 + 3) % 256 for i in range(256)]
    ranks = tok.mergeable_ranks(spark).collect()
    moved = [(permutation[r.id] if r.id < 256 else r.id, bytes(r.bytes)) for r in ranks]
    other = CorpusTokenizer.from_ranks(spark.createDataFrame(moved, "id int, bytes binary"))
    assert other.permutation == tuple(permutation) and other.specials == GPT4_SPECIALS
    plain = docs.select("doc_id", tok.encode("text").alias("ids")).collect()
    expected = {r.doc_id: [permutation[x] if x < 256 else x for x in r.ids] for r in plain}
    for limit in (1000, 0):
        got = docs.select("doc_id", other.encode("text", fold_limit=limit).alias("ids")).collect()
        assert {r.doc_id: r.ids for r in got} == expected
    assert other.round_trip_failures(docs).count() == 0
    df = spark.createDataFrame([([100257],)], "ids array<int>")
    assert df.select(other.decode("ids")).first()[0] == "<|endoftext|>"


@pytest.mark.parametrize("length", [5, 100, 600, 2000])
def test_chunks_of_any_length(spark, tok, length):
    """Chunks longer than the limit are merged another way."""
    text = ("the" * length)[:length]
    df = spark.createDataFrame([(text,)], "text string")
    for limit in (1000, 0):
        ids = df.select(tok.encode("text", fold_limit=limit)).first()[0]
        assert ids == golden.encode(text, learned(tok), GPT4_PATTERN)


def test_chunk_table_and_token_counts(spark, tok):
    chunks = spark.createDataFrame([("the", 3), ("tt", 2)], "chunk string, cnt long")
    encoded = codec.encode_chunk_table(chunks, tok.rules)
    counts = {r.id: r.n for r in codec.token_counts(encoded).collect()}
    expected = {}
    for chunk, n in (("the", 3), ("tt", 2)):
        for i in golden.encode(chunk, learned(tok), GPT4_PATTERN):
            expected[i] = expected.get(i, 0) + n
    assert counts == expected


def test_deep_merge_chain(spark):
    """Each merge extends the one before, the worst case for the depth of a token."""
    merges = [TrainedMerge(0, 97, 97, 256, 0)] + [TrainedMerge(k, 255 + k, 97, 256 + k, 0) for k in range(1, 40)]
    rows = vocabulary.mergeable_ranks(spark, merges).orderBy("id").collect()
    assert [bytes(r.bytes) for r in rows[256:]] == [b"a" * (k + 2) for k in range(40)]


def test_chunks_of_any_length_merge_in_rank_order():
    import random

    from corpusloom.functions.tasks import merge_chunk

    pick = random.Random(3)
    for _ in range(300):
        rules, known = {}, list("abc")
        for i in range(pick.randint(1, 12)):
            pair = pick.choice(known) + pick.choice(known)
            if pair not in rules:
                rules[pair] = chr(0x100 + i)
                known.append(rules[pair])
        chunk = "".join(pick.choices("abc", k=pick.choice((0, 1, 2, 5, 40, 700))))
        expected = chunk
        for pair, new in rules.items():
            expected = expected.replace(pair, new)
        assert merge_chunk(chunk, rules) == expected


@pytest.mark.parametrize("pattern", [CHAT_PATTERN, GPT2_PATTERN, None])
@pytest.mark.parametrize("prepend", [None, 7])
def test_rows_are_encoded_like_a_column(spark, texts, pattern, prepend):
    """As a function of batches of rows, for batches of any size."""
    merges = [(116, 104, 256), (256, 101, 257), (97, 97, 258)]
    rows = [(i, text) for i, text in enumerate(texts * 70)]
    df = spark.createDataFrame(rows, "n long, text string")
    column = codec.frame_ids(codec.encode_text(F.col("text"), merges, pattern), prepend)
    expected = {r.n: r.ids for r in df.select("n", column.alias("ids")).collect()}
    encode = codec.rows_encoder(merges, pattern, None, "text", prepend)
    whole = pa.RecordBatch.from_pydict({"n": [n for n, _ in rows], "text": [text for _, text in rows]})
    batches = [whole.slice(0, 5), whole.slice(5, 0), whole.slice(5, 1200), whole.slice(1205)]
    found = [r for batch in encode(iter(batches)) for r in batch.to_pylist()]
    assert [r["n"] for r in found] == list(range(len(rows)))
    assert all(r["ids"] == expected[r["n"]] and r["n_tokens"] == len(r["ids"]) for r in found)
