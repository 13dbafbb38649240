"""Text helpers: lossy decoding, rendering of control characters, slugs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lossy_utf8(data: Column) -> Column:
    """Decode UTF-8, invalid bytes becoming U+FFFD."""
    return F.make_valid_utf8(data.cast("string"))


def escape_control(text: Column) -> Column:
    r"""Characters of a Unicode category ``C*`` as ``\uXXXX``."""
    escape = lambda c: F.lower(F.hex(F.ascii(c)))
    padded = lambda c: F.when(F.length(escape(c)) < 4, F.lpad(escape(c), 4, "0")).otherwise(escape(c))
    shown = lambda c: F.when(F.rlike(c, F.lit(r"^\p{C}$")), F.concat(F.lit("\\u"), padded(c))).otherwise(c)
    return F.array_join(F.transform(F.split(text, ""), shown), "")


def render(data: Column) -> Column:
    """Token bytes as printable text."""
    return escape_control(lossy_utf8(data))


def slug(title: Column) -> Column:
    return F.replace(F.lower(title), F.lit(" "), F.lit("-"))
