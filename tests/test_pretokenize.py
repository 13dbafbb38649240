import golden
import pytest
import regex
from pyspark.sql import functions as F

from corpusloom.functions.patterns import CHAT_PATTERN, CHAT_SPECIALS, GPT2_PATTERN, GPT4_PATTERN
from corpusloom.operators import pretokenize as P


@pytest.mark.parametrize("pattern", [GPT2_PATTERN, GPT4_PATTERN, CHAT_PATTERN, None, r"\p{L}+"])
def test_chunks_equal_python(docs, texts, pattern):
    rows = docs.select("doc_id", P.chunk_array(F.col("text"), pattern).alias("c")).collect()
    assert {r.doc_id: r.c for r in rows} == {i: golden.split(t, pattern) for i, t in enumerate(texts)}


def test_explode_keeps_positions_and_skips_nulls(spark):
    df = spark.createDataFrame([(0, "a b"), (1, None), (2, "")], "doc_id long, text string")
    rows = P.explode_chunks(df, GPT4_PATTERN, "text", "doc_id").orderBy("doc_id", "pos").collect()
    assert [tuple(r) for r in rows] == [(0, 0, "a"), (0, 1, " b")]


def test_invalid_pattern_is_an_error(docs):
    with pytest.raises(Exception, match="(?i)pattern|regex"):
        docs.select(P.chunk_array(F.col("text"), "(")).collect()


def test_bytes(spark):
    df = spark.createDataFrame([("é€\U0001f600\x00z",)], "t string")
    assert df.select(P.chunk_bytes(F.col("t"))).first()[0] == list("é€\U0001f600\x00z".encode())


def test_split_specials(spark):
    specials = ["<|bos|>", "a.b", "<|bos|>x"]
    samples = ["a  <|bos|> b", "<|bos|><|bos|>", "x <|bos|", "<|bos|>", "", "a.b axb a.b\n<|bos|>x", "\n\n"]
    df = spark.createDataFrame([(s,) for s in samples], "t string")
    got = [r[0] for r in df.select(P.split_specials(F.col("t"), specials)).collect()]
    pattern = "(" + "|".join(map(regex.escape, specials)) + ")"
    assert got == [[p for p in regex.split(pattern, s) if p] for s in samples]


def test_policies():
    registered = {"<|bos|>": 1, "<|end|>": 2}
    assert P.allowed_specials(registered, "all") == registered
    assert P.allowed_specials(registered, "none") == {}
    assert P.allowed_specials(registered, {"<|end|>", "other"}) == {"<|end|>": 2}
    with pytest.raises(ValueError):
        P.allowed_specials(registered, "some")


def test_refuse_specials(spark):
    df = spark.createDataFrame([("plain",), ("with <|bos|>",)], "text string")
    assert [r.text for r in P.special_violations(df, CHAT_SPECIALS).collect()] == ["with <|bos|>"]
    with pytest.raises(Exception, match="special token"):
        df.select(P.refuse_specials(F.col("text"), CHAT_SPECIALS)).collect()


def test_kinds_give_the_chunks_of_the_pattern(spark, docs, texts):
    """Cut at spaces and split by kinds of characters in a task, texts give the chunks that the pattern gives."""
    import random
    import re
    import zlib

    from corpusloom.functions.patterns import CHAT_PATTERN, GPT2_PATTERN, GPT4_PATTERN
    from corpusloom.functions.tasks import PIECES
    from corpusloom.operators.pairs import chunk_counts
    from corpusloom.operators.pretokenize import character_kinds, kind_pattern

    draw = random.Random(1)
    signs = list("  \t\n\r'sSdDlLvVeErRmMtT19a.,") + ["ſ", " ", "\u0085", "\u001c", " ", "　", "²", "Ⅷ", "中", "\U00020000", "\U0001f600", "́", "͸", "Ꟑ", "\U0001e4d0"]
    every = [chr(i) for i in range(0x30000) if not 0xD800 <= i < 0xE000]
    rows = texts + ["".join(draw.choices(signs, k=draw.randrange(40))) for _ in range(400)]
    rows += [" x".join(every[i : i + 500]) for i in range(0, len(every), 500)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(8)
    kinds = zlib.decompress(character_kinds(spark)).decode()
    for pattern in (GPT2_PATTERN, GPT4_PATTERN, CHAT_PATTERN):
        cut = re.compile(kind_pattern(pattern))
        for row in df.select("text", P.chunk_array(F.col("text"), pattern).alias("chunks")).collect():
            pieces = re.findall(PIECES, row.text)
            assert "".join(pieces) == row.text
            assert [piece[m.start() : m.end()] for piece in pieces for m in cut.finditer(piece.translate(kinds))] == row.chunks
        expected = df.select(F.explode(P.chunk_array(F.col("text"), pattern)).alias("chunk")).groupBy("chunk").count()
        assert sorted(map(tuple, chunk_counts(df, pattern).collect())) == sorted(map(tuple, expected.collect()))
