"""Personal data replaced by pseudonyms of the same format.

Numbers and dates that pass their checks are permuted within their format by a keyed Feistel network: digits stay
digits, check digits and dates stay valid, and equal values get equal pseudonyms in all documents. The network works
on any range of integers; values that fall outside are permuted again until they are inside.

Kinds: e-mail addresses, IPv4 addresses, phone numbers, payment cards (Luhn) and other runs of 13 to 19 digits,
IBANs (modulo 97), social security numbers, dates (also with a time after a T), and hexadecimal secrets of 32 digits and
more. Where digit groups follow each other, a card among them is found by its check digit: groups of the sizes usual for
cards, or else the longest run of whole groups. Only the ASCII digits count as digits. Work grows in proportion to the text, blanks or none.
Null stays null, an empty text stays empty, and a text without such data is returned unchanged.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from datetime import date
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.flat import give_back

ROUNDS = 8
#: Text on either side of a digit or @ in which a value is looked for; it is widened to the next blank.
MARGIN = 64

FOUND_TYPE = "struct<text:string,n_found:bigint>"

SPOT = re.compile(r"[0-9@]|[0-9a-fA-F]{32}")
#: An address has a local part of up to 64 characters; the last ones count. A label of its domain has up to 63 letters, the domain up to 255.
LOCAL_PART, DOMAIN_PART = 64, 255
LOCAL_CHAR, WORD_CHAR = re.compile(r"[\w.+%-]"), re.compile(r"\w")
DOMAIN = re.compile(r"@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z]{2,}")
#: All other kinds. Every quantifier is bounded, or follows the edge of a word, so a search takes time in proportion to the text.
PATTERN = re.compile(
    r"(?P<ip>(?<![\w.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![\w]|\.[0-9]))"
    r"|(?P<date>(?<![\w/.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})(?!(?![Tt][0-9]{2})[\w/-]|\.[0-9]))"
    r"|(?P<ssn>(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-]))"
    r"|(?P<iban>(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?!\w))"
    r"|(?P<secret>(?<!\w)(?=[a-f]*[0-9])[0-9a-f]{32,}(?!\w)|(?<!\w)(?=[A-F]*[0-9])[0-9A-F]{32,}(?!\w))"
    r"|(?P<number>(?<![\w.])[0-9](?:[ -]?[0-9]){12,18}(?!\w))"
    r"|(?P<phone>(?<!\w)(?:\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}|\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,4}"
    r"|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?!\w|\.[0-9]))"
)
GROUPS, GROUP = re.compile(r"[0-9](?:[ -]?[0-9])*"), re.compile(r"[0-9]+")
CARD_WINDOW = 192
#: Sizes of the groups in which cards are usually written.
CARD_SHAPES = frozenset(((4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 4, 4, 4, 3)))
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class Value(NamedTuple):
    """A place in a text and the kind of value there."""

    kind: str
    begin: int
    end: int


def next_email(text: str, low: int, high: int) -> Value | None:
    """The first address in a part of a text, found from its ``@``."""
    at = text.find("@", low, high)
    while at >= 0:
        begin = at
        if at > low and WORD_CHAR.match(text, at - 1) and (domain := DOMAIN.match(text, at, min(high, at + 1 + DOMAIN_PART))):
            while begin > max(low, at - LOCAL_PART) and LOCAL_CHAR.match(text, begin - 1):
                begin -= 1
            return Value("email", begin, domain.end())
        at = text.find("@", at + 1, high)
    return None


def next_other(text: str, low: int, high: int) -> Value | None:
    match = PATTERN.search(text, low, high)
    return match and Value(match.lastgroup, *match.span())


def find_values(text: str, low: int = 0, high: int | None = None, clear: int = 0) -> Iterator[Value]:
    """All values, the leftmost first, with cards told apart from the numbers beside them. No card begins before ``clear``."""
    high = len(text) if high is None else high
    email, other = next_email(text, low, high), next_other(text, low, high)
    while email or other:
        if email and (not other or email.begin <= other.begin):
            found = email
        else:
            found = other
            place = None
            if other.kind == "number":
                while not place and other.end > clear:
                    place, clear = card_place(text, max(other.begin, clear), high)
                if place:
                    yield from find_values(text, other.begin, place[0], clear)
                    found = Value("number", *place)
        yield found
        if email and email.begin < found.end:
            email = next_email(text, found.end, high)
        if other and other.begin < found.end:
            other = next_other(text, found.end, high)


class Pseudonyms:
    """The permutations under one key."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def permute(self, value: int, size: int, kind: str) -> int:
        """A keyed permutation of the integers below ``size``, another one for each kind."""
        if size < 2:
            return value
        width = -(-size.bit_length() // 2)
        half = (1 << width) - 1
        while True:
            left, right = value >> width, value & half
            for turn in range(ROUNDS):
                # Hexadecimal: it takes time in proportion to the number of digits.
                said = f"{kind}|{size:x}|{turn}|{right:x}".encode()
                seed = hashlib.blake2b(said, key=self.key, digest_size=32).digest()
                noise = hashlib.shake_256(seed).digest((width + 64 + 7) // 8)
                left, right = right, left ^ (int.from_bytes(noise, "big") & half)
            value = left << width | right
            if value < size:
                return value

    def digits(self, text: str, kind: str, alphabet: str = DIGITS) -> str:
        n, base, value = len(text), len(alphabet), 0
        if base == 16:
            value = self.permute(int(text, 16), 1 << 4 * n, kind)
            return f"{value:0{n}{'X' if 'A' in alphabet else 'x'}}"
        for c in text:
            value = value * base + alphabet.index(c)
        value, out = self.permute(value, base**n, kind), []
        for _ in range(n):
            value, rest = divmod(value, base)
            out.append(alphabet[rest])
        return "".join(reversed(out))

    def shaped(self, text: str, kind: str, digits_only: bool = False) -> str:
        """Digits, small and capital letters are permuted together, each within its kind; the rest stays in place."""
        sets = [next((a for a in (DIGITS,) + (() if digits_only else (LOWER, UPPER)) if c in a), None) for c in text]
        size, value = 1, 0
        for c, letters in zip(text, sets, strict=True):
            if letters:
                size, value = size * len(letters), value * len(letters) + letters.index(c)
        value, out = self.permute(value, size, kind), list(text)
        for i in reversed(range(len(text))):
            if sets[i]:
                value, rest = divmod(value, len(sets[i]))
                out[i] = sets[i][rest]
        return "".join(out)

    def email(self, text: str) -> str:
        name, _, domain = text.partition("@")
        host, _, top = domain.rpartition(".")
        # Letter case does not tell addresses apart, so it doesn't change the pseudonym either.
        hidden = self.shaped(f"{name}@{host}".lower(), "email")
        return hidden.upper() + "." + top if text.isupper() else hidden + "." + top

    def ip(self, text: str) -> str | None:
        parts = [int(x) for x in text.split(".")]
        if max(parts) > 255:
            return None
        value = self.permute(int.from_bytes(bytes(parts), "big"), 1 << 32, "ip")
        return ".".join(map(str, value.to_bytes(4, "big")))

    def date(self, text: str) -> str | None:
        mark = next(c for c in text if not c.isdigit())
        parts = text.split(mark)
        year, month, day = map(int, parts if mark == "-" else reversed(parts))
        swapped = mark == "/" and month > 12
        if swapped:
            month, day = day, month
        try:
            value = date(year, month, day).toordinal()
        except ValueError:
            return None
        # Dates of 1900 to 2099 stay among themselves.
        low, high = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()
        if low <= value <= high:
            value = low + self.permute(value - low, high - low + 1, "date")
        else:
            others = date.max.toordinal() - (high - low + 1)
            place = self.permute(value - 1 if value < low else value - 1 - (high - low + 1), others, "date")
            value = place + 1 if place + 1 < low else place + 1 + (high - low + 1)
        new = date.fromordinal(value)
        if mark == "-":
            return f"{new.year:04d}-{new.month:02d}-{new.day:02d}"
        first, second = (new.month, new.day) if swapped else (new.day, new.month)
        return f"{first:02d}{mark}{second:02d}{mark}{new.year:04d}"

    def ssn(self, text: str) -> str | None:
        area, group, serial = map(int, text.split("-"))
        if area in (0, 666) or area > 899 or not group or not serial:
            return None
        place = area - 1 - (area > 666)
        place = self.permute((place * 99 + group - 1) * 9999 + serial - 1, 898 * 99 * 9999, "ssn")
        place, serial = divmod(place, 9999)
        area, group = divmod(place, 99)
        return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"

    def number(self, text: str) -> str:
        plain = [c for c in text if c.isdigit()]
        if luhn(plain) == 0:
            new = list(self.digits("".join(plain[:-1]), "card"))
            new.append(str(-luhn(new + ["0"]) % 10))
        else:
            new = list(self.digits("".join(plain), "number"))
        filled = iter(new)
        return "".join(next(filled) if c.isdigit() else c for c in text)

    def iban(self, text: str) -> str | None:
        plain = text.replace(" ", "")
        if not 15 <= len(plain) <= 34 or mod97(plain[4:] + plain[:4]) != 1:
            return None
        account = self.shaped(plain[4:], "iban " + plain[:2])
        new = iter(f"{plain[:2]}{98 - mod97(account + plain[:2] + '00'):02d}{account}")
        return "".join(" " if c == " " else next(new) for c in text)

    def phone(self, text: str) -> str:
        country = re.match(r"\+(?:1|7|\d{2,3}(?=[ .(-])|\d{2})", text)
        cut = country.end() if country else 0
        return text[:cut] + self.shaped(text[cut:], "phone " + text[:cut], digits_only=True)

    def secret(self, text: str) -> str:
        return self.digits(text, "secret", DIGITS + (UPPER[:6] if text.upper() == text else LOWER[:6]))

    def replace(self, text: str) -> tuple[str, int]:
        """The text with pseudonyms, and how many values were replaced."""
        out, done, found = [], 0, 0
        for low, high in stretches(text):
            for kind, begin, end in find_values(text, low, high):
                new = getattr(self, kind)(text[begin:end])
                if new is not None:
                    out += text[done:begin], new
                    done, found = end, found + 1
        return ("".join(out) + text[done:], found) if found else (text, 0)


def luhn(digits: list[str]) -> int:
    """The weighted digit sum modulo 10: 0 for a valid number."""
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10


def card_place(text: str, low: int, high: int) -> tuple[tuple[int, int] | None, int]:
    """The first card among the digit groups that begin at ``low``, and a place before which no card begins.

    Check sums of runs are differences of two running sums, one for each way to weigh every other digit. Only ``CARD_WINDOW``
    characters are looked at: if groups go on behind them, the last ones are left for the next look.
    """
    limit = min(high, low + CARD_WINDOW)
    end = GROUPS.match(text, low, limit).end()
    groups = [m.span() for m in GROUP.finditer(text, low, end)]
    cut = end >= limit - 1 and limit < high and groups[-1][1] - groups[-1][0] < 20
    if cut or groups[-1][1] - groups[-1][0] >= 20 or end < high and (text[end].isalnum() or text[end] == "_"):
        groups.pop()
    starts = [0, *accumulate(b - a for a, b in groups)]
    digits = [int(c) for a, b in groups for c in text[a:b]]
    sums = [[0, *accumulate(d if i % 2 == parity else sum(divmod(2 * d, 10)) for i, d in enumerate(digits))] for parity in (0, 1)]

    def valid(first: int, last: int) -> bool:
        a, b = starts[first], starts[last]
        weighed = sums[(b - 1) % 2]
        return 13 <= b - a <= 19 and (weighed[b] - weighed[a]) % 10 == 0

    for first in range(len(groups)):
        # A card and the usual ones beside it end within 40 digits.
        if cut and first and starts[-1] - starts[first] < 40:
            return None, groups[first][0]
        # Groups have a digit or more, so few runs have 13 to 19 digits.
        least, most = bisect_left(starts, starts[first] + 13), bisect_right(starts, starts[first] + 19) - 1
        for last in range(most, least - 1, -1):
            if valid(first, last):
                usual = ((a, b) for a in range(first, last) for b in range(a + 1, min(len(groups), a + 5) + 1))
                shape = lambda a, b: tuple(y - x for x, y in groups[a:b])
                run = next(((a, b) for a, b in usual if (b - a == 1 or shape(a, b) in CARD_SHAPES) and valid(a, b)), (first, last))
                return (groups[run[0]][0], groups[run[1] - 1][1]), groups[first][0]
    return None, end


def mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


def stretches(text: str):
    """Parts of the text that may hold a value, from blank to blank, in order and disjoint."""
    low = high = -1
    for spot in SPOT.finditer(text):
        a, b = spot.span()
        if a < high - 1:
            if b + MARGIN > high:
                high = widened(text, b)
            continue
        if high >= 0 and a - MARGIN > high:
            yield low, high
            low = high = -1
        if high < 0:
            at = max(0, a - MARGIN)
            while at and not text[at - 1].isspace():
                at -= 1
            low = at
        high = widened(text, b)
    if high >= 0:
        yield low, high


def widened(text: str, at: int) -> int:
    at = min(len(text), at + MARGIN)
    while at < len(text) and not text[at].isspace():
        at += 1
    return at


def pseudonymized(text: Column | str, key: bytes) -> Column:
    """A struct of the text with pseudonyms and the number of values found."""
    names = Pseudonyms(key)

    def replaced(texts: pa.Array) -> pa.Array:
        rows = [(None, 0) if t is None else names.replace(t) for t in texts.to_pylist()]
        found = pa.StructArray.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64())], ["text", "n_found"])
        give_back()
        return found

    return F.arrow_udf(replaced, FOUND_TYPE)(text)


def pseudonymize(docs: DataFrame, key: bytes, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """For each row: id, text with pseudonyms, n_found."""
    return docs.select(F.col(id_column), pseudonymized(F.col(text_column), key).alias("found")).select(id_column, "found.*")
