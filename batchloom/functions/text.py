"""Blank tests, trimming and strict number parsing over string columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# All Unicode whitespace, as a regex class and as characters. Spark's plain trim()
# knows U+0020 only.
SPACE = r"\t-\r\x1c-\x1f\x85\p{Z}"
SPACE_CHARACTERS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_INTEGER = r"^[+-]?[0-9]+$"


def as_text(col: Column) -> Column:
    """String form of any column, NULL as the empty string."""
    return F.coalesce(col.cast("string"), F.lit(""))


def strip(col: Column) -> Column:
    return F.trim(col, F.lit(SPACE_CHARACTERS))


def is_blank(col: Column) -> Column:
    """NULL, empty or whitespace only. The search stops at the first visible character."""
    return col.isNull() | ~col.rlike(f"[^{SPACE}]")


def has_value(col: Column) -> Column:
    """Neither NULL, nor empty, nor the literal text 'null'."""
    return col.isNotNull() & ~col.isin("", "null")


def to_number(col: Column) -> Column:
    """Text to double; NULL unless the whole text is a decimal number.

    The pattern guards against forms only a Java parser takes, such as '3d' or '0x1p3'.
    """
    text = strip(col)
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def to_integer(col: Column) -> Column:
    text = strip(col)
    return F.when(text.rlike(_INTEGER), text.try_cast("bigint"))


def fenced_body(col: Column) -> Column:
    """The JSON inside a Markdown code fence, or the text itself where there is none.

    A ```json fence wins over a plain one; a fence that is never closed runs to the end.
    """
    fence = "```"
    tagged = F.substring_index(_after(col, fence + "json"), fence, 1)
    plain = F.substring_index(_after(col, fence), fence, 1)
    return strip(
        F.when(F.contains(col, F.lit(fence + "json")), tagged)
        .when(F.contains(col, F.lit(fence)), plain)
        .otherwise(col)
    )


def _after(col: Column, marker: str) -> Column:
    return F.substr(col, F.instr(col, marker) + F.lit(len(marker)))
