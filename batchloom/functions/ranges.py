"""Range-valued metric text, such as '￥50万 ~ ￥75万', to numbers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchloom.functions.text import SPACE, strip, to_number

# The shape of a range, its ten-thousand marker, and the marks that are dropped.
RANGE = rf"(?s)^([0-9.]+)(万)?[{SPACE}]*~[{SPACE}]*([0-9.]+)(万)?.*$"
TEN_THOUSAND = 10000.0
DROPPED = ",￥%"

_WIDE_DIGITS = "０１２３４５６７８９"
_MARK = "\x01"


def normalise_ranges(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add the number each text column stands for; ``columns`` maps new names to text columns.

    A range becomes its middle, where each end has its own ten-thousand marker, and any other text
    the number it spells. Blank or unreadable text is NULL, as is a single number with a
    ten-thousand marker. Works in three projections, so that each text is cleaned and matched once.
    """
    clean = {f"_clean_{n}": strip(F.translate(c, _WIDE_DIGITS + DROPPED, "0123456789")) for n, c in columns.items()}
    parts = {
        f"_parts_{n}": F.split(F.regexp_replace(f"_clean_{n}", RANGE, _MARK.join(["$1", "$2", "$3", "$4"])), _MARK)
        for n in columns
    }
    values = {n: _value(F.col(f"_clean_{n}"), F.col(f"_parts_{n}")) for n in columns}
    return df.withColumns(clean).withColumns(parts).withColumns(values).drop(*clean, *parts)


def _value(clean: Column, parts: Column) -> Column:
    middle = (_end(parts, 0) + _end(parts, 2)) / F.lit(2.0)
    return F.when(F.size(parts) == 4, middle).otherwise(to_number(clean))


def _end(parts: Column, index: int) -> Column:
    number = F.get(parts, F.lit(index)).try_cast("double")
    return number * F.when(F.get(parts, F.lit(index + 1)) == "万", TEN_THOUSAND).otherwise(1.0)


def within(col: Column, below: float | None = None, at_most: float | None = None) -> Column:
    """Keep a value inside the limits, else NULL."""
    kept = col
    if below is not None:
        kept = F.when(kept < below, kept)
    if at_most is not None:
        kept = F.when(kept <= at_most, kept)
    return kept


def nonzero(col: Column) -> Column:
    return F.when(col != 0, col)
