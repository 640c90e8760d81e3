"""Helpers that the text operators share."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: White space of the word contracts: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = " \t\n\x0b\x0c\r"

_LETTER = re.compile(r"[^\W\d_]")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case, as UTF-8. Null has none."""
    return text.encode("utf-8", "replace").lower().split() if text else []


def has_letter(text: str) -> bool:
    return any(m[0].isalpha() for m in _LETTER.finditer(text))


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of an id's decimal text, modulo ``modulus``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def task_partitions(df: DataFrame, least: int = 1) -> int:
    """The session's shuffle partitions, for explicit repartitions."""
    return max(least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def with_made(df: DataFrame, inputs: Sequence[str], fn: Callable[..., list[list]], made: str, rows: int = 256) -> DataFrame:
    """``df`` with the columns that ``fn`` makes of lists of the ``inputs``, a few rows at a time.

    ``made`` is DDL; new columns replace old ones of their name. Spark hands over batches of thousands of
    documents; only ``rows`` of them are Python objects at once, whatever the length of the batch.
    """
    fields = T.StructType.fromDDL(made)
    kept = [c for c in df.columns if c not in fields.names]
    schema = T.StructType([*(f for f in df.schema.fields if f.name in kept), *fields.fields])
    types = [f.type for f in to_arrow_schema(fields)]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                values = fn(*(part.column(c).to_pylist() for c in inputs))
                arrays = [part.column(c) for c in kept] + [pa.array(v, type=t) for v, t in zip(values, types)]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return df.mapInArrow(of, schema)
