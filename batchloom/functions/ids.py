"""Reversible request ids built from key columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchloom.functions.text import as_text

# The id format.
PREFIX = "req-"
SEPARATOR = "|"


def percent_encode(col: Column) -> Column:
    """RFC 3986 percent-encoding over UTF-8 in which only unreserved characters stay as they are."""
    form = F.url_encode(col)
    for form_style, rfc_style in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        form = F.replace(form, F.lit(form_style), F.lit(rfc_style))
    return form


def percent_decode(col: Column) -> Column:
    """Inverse of percent_encode; '+' is literal, and text with a broken escape is kept as it is."""
    return F.coalesce(F.try_url_decode(F.replace(col, F.lit("+"), F.lit("%2B"))), col)


def request_id(keys: Sequence[str]) -> Column:
    parts = [percent_encode(as_text(F.col(k))) for k in keys]
    return F.concat(F.lit(PREFIX), F.concat_ws(SEPARATOR, *parts))


def bare_id(col: Column) -> Column:
    """The id without its prefix; ids that never had one pass through."""
    return F.when(col.startswith(PREFIX), F.substr(col, F.lit(len(PREFIX) + 1))).otherwise(col)


def stamp_request_id(df: DataFrame, keys: Sequence[str], out: str = "custom_id") -> DataFrame:
    return df.withColumn(out, request_id(keys))


def restore_keys(df: DataFrame, keys: Sequence[str], id_col: str = "custom_id") -> DataFrame:
    """Add the key columns an id was built from, as strings; missing trailing keys are empty."""
    parts = F.split(bare_id(F.col(id_col)), r"\|", -1)
    return df.withColumns(
        {k: F.coalesce(percent_decode(F.get(parts, F.lit(i))), F.lit("")) for i, k in enumerate(keys)}
    )
