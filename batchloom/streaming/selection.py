"""Select each new key once, with the keys that were selected held as the stream's own state."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from batchloom.operators.incremental import split_null_keys, target_keys
from batchloom.storage import path_exists

_SEEN = T.StructType([T.StructField("seen", T.BooleanType())])

#: The state store that keeps named values; and no micro-batches without data, of which lifetimes would ask for more
#: and more, so that a query over what is there would never end.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
ONCE = {"availableNow": True}


def _rank(row: Row, order: Sequence[str]) -> tuple:
    return tuple((row[c] is not None, row[c]) if row[c] is not None else (False,) for c in order)


class _Once(StatefulProcessor):
    """The first row of a key in ``order``; nothing for a key that was seen, here or in the initial state."""

    def __init__(self, order: Sequence[str], lifetime_ms: int | None):
        self._order, self._lifetime = list(order), lifetime_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._seen = handle.getValueState("seen", _SEEN, self._lifetime)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        if self._seen.exists():
            return
        yield min(rows, key=lambda row: _rank(row, self._order))
        self._seen.update((True,))

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:  # noqa: N802, N803
        self._seen.update((True,))

    def close(self) -> None:
        pass


def select_once(
    rows: DataFrame,
    keys: Sequence[str],
    done: DataFrame | None = None,
    order: Sequence[str] = (),
    lifetime_ms: int | None = None,
) -> DataFrame:
    """Streaming ``rows`` cut to the first row of each key that was neither selected before nor is in ``done``.

    Selected keys are state, partitioned by key. ``done`` becomes initial state in the first micro-batch; nothing reads a
    target or an earlier selection after it. With ``lifetime_ms`` a key is
    forgotten that long after it was selected, which bounds the state; it can then be selected again. Rows with
    a NULL in the key are not selected. Of the rows that a micro-batch has for a new key, the first in ``order``
    (by default the keys, so any) is passed on; NULLs come first. All rows of a key in one micro-batch are read by one
    task, one after the other, and it holds one of them.
    """
    complete, _ = split_null_keys(rows, keys)
    known = target_keys(rows, done, keys).groupBy(*keys) if done is not None else None
    return complete.groupBy(*keys).transformWithState(
        _Once(order or keys, lifetime_ms), rows.schema, "append", "ProcessingTime" if lifetime_ms else "None", known
    )


def stream_selection(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    keys: Sequence[str],
    selected: str,
    checkpoint: str,
    done: DataFrame | None = None,
    order: Sequence[str] = (),
    lifetime_ms: int | None = None,
    trigger: dict[str, Any] | None = None,
) -> StreamingQuery:
    """``select_once`` from a folder of Parquet files to another, exactly once, also when a micro-batch is repeated.

    ``done`` is needed by the first micro-batch only. A query that is to run on therefore takes the files that are there
    first, and then goes on, like any later start, without ``done`` in its plan.
    """
    asked = trigger or ONCE

    def start(known: DataFrame | None, how: dict[str, Any]) -> StreamingQuery:
        found = select_once(spark.readStream.schema(schema).parquet(folder), keys, known, order, lifetime_ms)
        writer = found.writeStream.format("parquet").outputMode("append").option("path", selected)
        return _with_settings(spark, writer.option("checkpointLocation", checkpoint).trigger(**how).start)

    def begun() -> bool:
        return path_exists(spark, f"{checkpoint}/commits/0")

    if done is not None and asked != ONCE and not begun():
        start(done, ONCE).awaitTermination()
    return start(None if begun() else done, asked)


def _with_settings(spark: SparkSession, start: Callable[[], StreamingQuery]) -> StreamingQuery:
    """Start a query under ``SETTINGS``; it takes the session's settings when it starts, and they are put back."""
    before = {name: spark.conf.get(name, None) for name in SETTINGS}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    try:
        return start()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
