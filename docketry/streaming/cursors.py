"""Cursors of benches as keyed state of a stream: how far each one is complete.

The state of a (court, bench) is the last outcome of each of its years and a cursor. A batch brings outcomes; a year is
good in it if all its rows are. The cursor moves, and never back, to the latest day brought so far once the last outcome
of every year is good: one failed year holds its own bench until it succeeds, and no other bench.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

CURSORS = "court string, bench string, cursor date, failed_years array<int>"


class BenchCursor(StatefulProcessor):
    """Rows of a key and batch in, one row (court, bench, cursor, failed_years) out."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._years = handle.getMapState("years", "year int", "ok boolean")
        self._reached = handle.getValueState("reached", "day date")
        self._cursor = handle.getValueState("cursor", "day date")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        outcome: dict[int, bool] = {}
        day = self._reached.get()[0] if self._reached.exists() else None
        for r in rows:  # two values per year are held, not the rows
            outcome[r["year"]] = outcome.get(r["year"], True) and bool(r["ok"])
            if r["through"] is not None and (day is None or r["through"] > day):
                day = r["through"]
        for year, ok in outcome.items():
            self._years.updateValue((year,), (ok,))
        if day is not None:
            self._reached.update((day,))
        failed = sorted(y[0] for y, ok in self._years.iterator() if not ok[0])
        if not failed and day is not None:
            self._cursor.update((day,))
        cursor = self._cursor.get()[0] if self._cursor.exists() else None
        yield Row(court=key[0], bench=key[1], cursor=cursor, failed_years=failed)

    def close(self) -> None:
        pass


def cursor_stream(outcomes: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Start writing what each batch makes of the cursors to the table at path, for all data that is there.

    outcomes is a stream of (court, bench, year, ok, through). A null ok is a failure; a null year counts as a year of
    its own; a null `through` moves nothing. A restart from the checkpoint goes on with the state.
    """
    spark = outcomes.sparkSession
    rows = outcomes.select(F.col("court").cast("string"), F.col("bench").cast("string"), F.coalesce(F.col("year").cast("int"), F.lit(0)).alias("year"), F.coalesce("ok", F.lit(False)).alias("ok"), F.col("through").cast("date"))
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)  # a query keeps the store that it starts with
    try:
        state = rows.groupBy("court", "bench").transformWithState(BenchCursor(), CURSORS, "Append", "None")
        return state.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def kept_cursors(written: DataFrame) -> DataFrame:
    """(court, bench, cursor): the latest of what cursor_stream() has written; benches that never were complete are not in it."""
    return written.groupBy("court", "bench").agg(F.max("cursor").alias("cursor")).where("cursor is not null")
