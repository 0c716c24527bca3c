"""Newest row per key as operator state: one value per key in RocksDB, forgotten when it stays silent."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import timedelta
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

WATERMARKED = "_watermarked"


class NewestRow(StatefulProcessor):
    """Keeps the row that is last by ``order`` (NULLs first) and returns it whenever it changes.

    With ``silent_ms`` a timer runs from the newest row's event time (microseconds in
    ``event_time``); when the watermark passes it, the key's state is dropped.
    """

    def __init__(self, keys: Sequence[str], names: Sequence[str], state: str, order: Sequence[str], event_time: str | None, silent_ms: int | None):
        self.keys, self.names, self.state, self.order = list(keys), list(names), state, list(order)
        self.event_time, self.silent_ms = event_time, silent_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", self.state)

    def _rank(self, values: Sequence[Any]) -> tuple:
        row = dict(zip(self.names, values))
        return tuple((row[c] is not None, row[c]) for c in self.order)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        best = max((tuple(row[n] for n in self.names) for row in rows), key=self._rank)
        if self.newest.exists() and self._rank(best) <= self._rank(self.newest.get()):
            return
        self.newest.update(best)
        if self.silent_ms is not None:
            for timer in self.handle.listTimers():
                self.handle.deleteTimer(timer)
            micros = best[self.names.index(self.event_time)]
            if micros is not None:
                self.handle.registerTimer(micros // 1000 + self.silent_ms)
        yield Row(**dict(zip(self.keys, key)), **dict(zip(self.names, best)))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        self.newest.clear()
        return iter(())

    def close(self) -> None:
        pass


def newest_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    event_time: str | None = None,
    delay: str | None = None,
    silent_for: timedelta | None = None,
) -> DataFrame:
    """Changes of the newest row per key (update mode); ``order`` names columns, not keys.

    Without ``silent_for`` a key is kept for ever and late rows compete like any other.  With it
    a key is forgotten once the watermark (``event_time`` less ``delay``) is that far beyond its
    newest row, and rows behind the watermark are not read.  Times enter the state as whole
    microseconds, so no worker's time zone can change them.  Start the query under
    :func:`quarrylens.streaming.jobs.operator_state`, or in a session with RocksDB state.
    """
    names = [c for c in df.columns if c not in keys]
    times = {f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)}
    kinds = {f.name: "bigint" if f.name in times else f.dataType.simpleString() for f in df.schema}
    ddl = lambda chosen: ", ".join(f"`{c}` {kinds[c]}" for c in chosen)
    numbers = [F.unix_micros(c).alias(c) if c in times else F.col(c) for c in df.columns]
    mode, silent_ms = "None", None
    if silent_for is not None:
        if event_time not in times or event_time in keys or not delay:
            raise ValueError("silent_for needs a timestamp column as event time and a delay")
        mode, silent_ms = "EventTime", int(silent_for.total_seconds() * 1000)
        df = df.withWatermark(event_time, delay)
        numbers.append(F.col(event_time).alias(WATERMARKED))
    processor = NewestRow(keys, names, ddl(names), order, event_time, silent_ms)
    out = df.select(*numbers).groupBy(*keys).transformWithState(processor, ddl([*keys, *names]), "Update", mode)
    return out.select(*[F.timestamp_micros(c).alias(c) if c in times else F.col(c) for c in [*keys, *names]])
