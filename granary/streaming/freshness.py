"""Freshness as a stream of changes: STALE when a table's data stops coming, FRESH when it is back.

State per table is its newest event time and whether it is stale. An event-time timer at newest + limit says STALE even if
nothing arrives for that table any more, as soon as the watermark (moved on by the others) passes it; a second timer forgets
a table that has been silent for ``forget``. Before the state, each task keeps the first and the last event per table and
half a limit of time: no gap above the limit lies between other events, so a table with a third of all rows sends few.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

CHANGES = "table_name string, status string, at timestamp"


def _thin(half: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            micros = batch["at"].astype("int64") // 1000 if str(batch["at"].dtype).endswith("[ns]") or "ns" in str(batch["at"].dtype) else batch["at"].astype("int64")
            by = batch.groupby([batch["table_name"], micros // half], sort=False)["at"]
            ends = pd.concat([by.min(), by.max()]).reset_index(level=0).drop_duplicates()
            yield ends[["table_name", "at"]]

    return run


def _micros(values: pd.Series) -> np.ndarray:
    return values.to_numpy().astype("datetime64[us]").astype("int64")


def _time(micros: int) -> datetime:
    return datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=micros)


class Freshness(StatefulProcessor):
    def __init__(self, limit_micros: int, forget_micros: int):
        self.limit, self.forget = limit_micros, forget_micros

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.known = handle.getValueState("known", "newest long, stale boolean")

    def _expire(self, at: int) -> int:
        return -(-at // 1000)  # timers are in milliseconds

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        newest, stale = self.known.get() if self.known.exists() else (None, False)
        out, before = [], newest
        for at in sorted({int(x) for part in rows for x in _micros(part["at"])}):
            if newest is not None and at <= newest:
                continue  # late: says nothing about a gap
            if stale:
                out.append(("FRESH", at))
                stale = False
            elif newest is not None and at - newest > self.limit:
                out += [("STALE", newest + self.limit), ("FRESH", at)]
            newest = at
        if newest != before:
            if before is not None:
                for old in (before + self.limit, before + self.forget):
                    self.handle.deleteTimer(self._expire(old))
            self.handle.registerTimer(self._expire(newest + self.limit))
            self.handle.registerTimer(self._expire(newest + self.forget))
        self.known.update((newest, stale))
        if out:
            yield pd.DataFrame({"table_name": key[0], "status": [s for s, _ in out], "at": [_time(t) for _, t in out]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.known.exists():
            return
        newest, stale = self.known.get()
        expiry = expiredTimerInfo.getExpiryTimeInMs()
        if expiry == self._expire(newest + self.forget):
            self.known.clear()
        elif not stale and expiry == self._expire(newest + self.limit):
            self.known.update((newest, True))
            yield pd.DataFrame({"table_name": [key[0]], "status": ["STALE"], "at": [_time(newest + self.limit)]})

    def close(self) -> None:
        pass


def changes(stream: DataFrame, table_column: str, event_time: str, limit: str, delay: str, forget: str = "30 days") -> DataFrame:
    """``(table_name, status, at)`` for every gap longer than ``limit`` in a table's events. Needs the RocksDB state store."""
    limit_micros, forget_micros = (int(pd.Timedelta(x).total_seconds() * 1_000_000) for x in (limit, forget))
    slim = stream.select(F.col(table_column).cast("string").alias("table_name"), F.col(event_time).cast("timestamp").alias("at")).filter("table_name is not null and at is not null")
    thin = slim.mapInPandas(_thin(limit_micros // 2), "table_name string, at timestamp").withWatermark("at", delay)
    return thin.groupBy("table_name").transformWithStateInPandas(Freshness(limit_micros, forget_micros), CHANGES, "Append", "EventTime")
