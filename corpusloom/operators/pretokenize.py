"""Splitting texts into chunks and around special tokens."""

from __future__ import annotations

import re
import zlib
from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import sequences as S
from corpusloom.functions.patterns import CHAT_PATTERN, GPT2_PATTERN, GPT4_PATTERN, java_pattern, quote

# Patterns with which every space after something else than white space begins a chunk, whose chunks cover the whole text, and
# which look back at nothing: a text may be cut before such spaces first. They tell characters apart by kind, but for the letters of contractions.
SPACE_BEGINS_CHUNK = frozenset([GPT2_PATTERN, GPT4_PATTERN, CHAT_PATTERN])
# Patterns that are alike but for the most numbers in a chunk.
DIGITS = {GPT4_PATTERN: 3, CHAT_PATTERN: 2}
# One character for each kind; letters that patterns name stand for themselves.
LETTER, NUMBER, BLANK, OTHER = "a", "0", "\t", "!"
NAMED = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz\u017f' \r\n"
_kinds: dict[str, bytes] = {}


def chunk_array(text: Column, pattern: str | None) -> Column:
    """All matches of ``pattern`` in order; without a pattern the text is one chunk."""
    if pattern is None:
        return F.when(text == "", F.array().cast("array<string>")).otherwise(F.array(text))
    return F.regexp_extract_all(text, F.lit(java_pattern(pattern)), F.lit(0))


def kind_pattern(pattern: str) -> str:
    """A pattern of ``SPACE_BEGINS_CHUNK`` over the kinds of characters instead of the characters."""
    kinds = {r"\p{L}": "A-Za-z\u017f", r"\p{N}": NUMBER, r"\s": " \t\r\n"}
    out, inside = [], False
    for part in re.findall(r"\\p\{\w\}|\\.|.", pattern, re.DOTALL):
        if part in ("[", "]"):
            inside = part == "["
        if part == r"\S":
            part = f"[^{kinds[chr(92) + 's']}]"
        elif part in kinds:
            part = kinds[part] if inside else f"[{kinds[part]}]"
        out.append(part)
    return "".join(out)


def character_kinds(spark: SparkSession) -> bytes:
    """The kind of every character as one compressed string, as the executors' regular expressions see it."""
    key = spark.sparkContext.applicationId
    if key not in _kinds:
        points = spark.range(0, 0x110000, 1, 8).where("id NOT BETWEEN 55296 AND 57343")
        char = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
        kind = F.lit(OTHER)
        for regex, value in ((r"\s", BLANK), (r"\p{N}", NUMBER), (r"\p{L}", LETTER)):
            kind = F.when(F.rlike(char, F.lit(java_pattern(rf"\A{regex}\z"))), value).otherwise(kind)
        block = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "kind"))), lambda x: x["kind"]), "")
        rows = points.withColumn("kind", kind).groupBy(F.expr("id div 256").alias("block")).agg(block.alias("kinds"))
        table = [OTHER * 256] * (0x110000 // 256)
        for row in rows.where(F.replace("kinds", F.lit(OTHER), F.lit("")) != "").collect():
            table[row.block] = row.kinds
        named = {ord(char): char for char in NAMED}
        _kinds[key] = zlib.compress("".join(named.get(i, char) for i, char in enumerate("".join(table))).encode())
    return _kinds[key]


def explode_chunks(docs: DataFrame, pattern: str | None, text: str = "text", *keys: str) -> DataFrame:
    """One row per chunk: ``keys``, ``pos``, ``chunk``. Null texts give no rows."""
    return docs.where(F.col(text).isNotNull()).select(
        *keys, F.posexplode(chunk_array(F.col(text), pattern)).alias("pos", "chunk")
    )


def chunk_bytes(chunk: Column) -> Column:
    """UTF-8 byte ids of a chunk."""
    return S.ids(S.byte_symbols(chunk), 256)


def special_alternation(specials: Sequence[str]) -> str:
    """The special tokens as one regex; earlier ones win."""
    return "(?:" + "|".join(quote(s) for s in specials) + ")"


def split_specials(text: Column, specials: Sequence[str]) -> Column:
    """Parts of ``text`` in order, special tokens kept as parts of their own."""
    if not specials:
        return chunk_array(text, None)
    any_special = special_alternation(specials)
    pattern = rf"(?s){any_special}|.+?(?={any_special}|\z)"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def allowed_specials(registered: Mapping[str, int], policy: str | Collection[str]) -> dict[str, int]:
    """Special tokens that a policy recognises in text.

    ``all``, ``none`` (read as plain text), ``none_raise`` (as ``none``, but texts
    must not contain any) or a set of names.
    """
    if policy == "all":
        return dict(registered)
    if policy in ("none", "none_raise"):
        return {}
    if isinstance(policy, (set, frozenset)):
        return {name: i for name, i in registered.items() if name in policy}
    raise ValueError(f"special-token policy not understood: {policy!r}")


def has_special(text: Column, registered: Collection[str]) -> Column:
    found = F.lit(False)
    for name in registered:
        found = found | F.contains(text, F.lit(name))
    return found


def special_violations(docs: DataFrame, registered: Collection[str], text: str = "text") -> DataFrame:
    """Rows whose text contains a special token: what ``none_raise`` refuses."""
    return docs.where(has_special(F.col(text), registered))


def refuse_specials(text: Column, registered: Collection[str]) -> Column:
    """``text``, or a failed job when it contains a special token."""
    if not registered:
        return text
    message = F.concat(F.lit("text contains a special token: "), F.substring(text, 1, 80))
    return F.when(has_special(text, registered), F.raise_error(message).cast("string")).otherwise(text)
