"""Token sequences as strings with one character per token.

Byte ``b`` is the character U+00bb, so the UTF-8 bytes of a text become a token
sequence by reading them as ISO-8859-1. Later tokens use the following code
points, skipping the surrogates. Merging a pair is then the built-in
``replace`` of two characters by one: left to right and non-overlapping, also
for a pair of equal tokens. String order is token-id order, because UTF-8 keeps
code point order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SURROGATES = 0xD800
GAP = 0x800
# Separates chunks inside one sequence; no token uses the last code point.
BREAK = chr(0x10FFFF)
MAX_TOKENS = 0x10FFFF - GAP

Merge = tuple[int, int, int]


def symbol(token_id: int) -> str:
    """The character that stands for a token id."""
    if not 0 <= token_id < MAX_TOKENS:
        raise ValueError(f"token id out of range: {token_id}")
    return chr(token_id if token_id < SURROGATES else token_id + GAP)


def token_id(char: str) -> int:
    """Inverse of :func:`symbol`."""
    point = ord(char)
    return point if point < SURROGATES else point - GAP


def byte_symbols(text: Column) -> Column:
    """UTF-8 bytes of ``text``, one character per byte."""
    return F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")


def symbol_bytes(seq: Column) -> Column:
    """Inverse of :func:`byte_symbols`, as binary."""
    return F.encode(seq, "ISO-8859-1")


def symbols(seq: Column) -> Column:
    """The characters of a sequence; an empty sequence gives an empty array."""
    return F.when(F.length(seq) == 0, F.array().cast("array<string>")).otherwise(F.split(seq, ""))


def char_id(char: Column) -> Column:
    point = F.ascii(char)
    return F.when(point < SURROGATES, point).otherwise(point - GAP)


def ids(seq: Column, num_tokens: int = MAX_TOKENS) -> Column:
    """Token ids of a sequence as ``array<int>``; chunk breaks vanish.

    With ``num_tokens`` ids below the surrogates, a code point is the id itself.
    """
    to_id = F.ascii if num_tokens <= SURROGATES else char_id
    return F.transform(symbols(F.replace(seq, F.lit(BREAK), F.lit(""))), lambda c: to_id(c))


def _string_array(values: Sequence[str], sep: str) -> Column:
    """An array literal that costs one call however long it is (folded by the optimizer)."""
    return F.split(F.lit(sep.join(values)), sep)


def _escaped(chars: str) -> str:
    """``chars`` for a SQL string literal."""
    return "".join(f"\\U{ord(c):08X}" for c in chars)


def fold(seq: Column, merges: Sequence[Merge]) -> Column:
    """Apply merges in rank order to a sequence.

    The rules travel as one literal array, so that the compiled code of a plan
    is the same whichever merges it applies.
    """
    if not merges:
        return seq
    rules = (f"struct('{_escaped(symbol(a) + symbol(b))}' AS p, '{_escaped(symbol(n))}' AS n)" for a, b, n in merges)
    literal = F.expr(f"array({', '.join(rules)})")
    return F.aggregate(literal, seq, lambda acc, rule: F.replace(acc, rule["p"], rule["n"]))


def pair_ids(pair: Column) -> tuple[Column, Column]:
    """The two token ids of a two-character string."""
    return char_id(F.substring(pair, 1, 1)), char_id(F.substring(pair, 2, 1))


def lookup(values: Sequence[str], index: Column, sep: str = ",") -> Column:
    """``values[index]`` for a literal list, NULL when out of range."""
    return F.get(_string_array(values, sep), index)
