"""The circuit breaker over a stream of requests, with a state and timers for each host.

A host trips at its third refusal without a success between them; from then on its
requests are not made (they are passed over) until the cooldown is over, and then counting
starts anew.  Requests are kept until the watermark has passed them and are then taken in
their order, so late and shuffled micro-batches give what the ordered log gives.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

OUTPUT = "host string, tripped_at long, at timestamp, until timestamp"
WAITING = "ms long, seq long, kind string"
COUNT = "run int, until_ms long"


def advance(run: int, until_ms: int, ms: int, kind: str, limit: int, cooldown_ms: int) -> tuple[int, int, bool]:
    """(refusals in a row, end of the cooldown, whether the host trips now) after one request."""
    if ms < until_ms:
        return run, until_ms, False
    if kind == "fine":
        return 0, until_ms, False
    run += kind == "refused"
    if run < limit:
        return run, until_ms, False
    return 0, ms + cooldown_ms, True


class Breaker(StatefulProcessor):
    def __init__(self, limit: int, cooldown_ms: int):
        self.limit, self.cooldown_ms = limit, cooldown_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", WAITING)
        self.count = handle.getValueState("count", COUNT)

    def handleInputRows(self, key, rows: Iterable[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        """Requests wait for the watermark; a timer stands where the first of them is due."""
        fresh = [(int(ms), int(seq), kind) for part in rows for ms, seq, kind in zip(part["ms"], part["seq"], part["kind"])]
        self.waiting.appendList(fresh)
        for ms in sorted({ms for ms, *_ in fresh}):
            self.handle.registerTimer(ms)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        due, later = [], []
        for row in self.waiting.get():
            (due if row[0] <= now else later).append(tuple(row))
        if not due:
            return
        self.waiting.put(later) if later else self.waiting.clear()
        run, until = self.count.get() if self.count.exists() else (0, 0)
        tripped = []
        for ms, seq, kind in sorted(due):
            run, until, trips = advance(run, until, ms, kind, self.limit, self.cooldown_ms)
            if trips:
                tripped.append((key[0], seq, ms, until))
        if run or until > now:
            self.count.update((run, until))
        elif self.count.exists():  # nothing is left to remember
            self.count.clear()
        if tripped:
            at = lambda k: pd.to_datetime([t[k] for t in tripped], unit="ms")
            yield pd.DataFrame({"host": [t[0] for t in tripped], "tripped_at": [t[1] for t in tripped], "at": at(2), "until": at(3)})

    def close(self) -> None:
        pass


def trips_stream(log: DataFrame, host: str, seq: str, at: str, refused: Column, succeeded: Column, late: str = "10 minutes", limit: int = 3, cooldown: dt.timedelta = dt.timedelta(hours=24)) -> DataFrame:
    """(host, tripped_at, at, until) of every trip, from a stream of requests that is at most ``late`` out of order.

    Needs the RocksDB state store (``spark.sql.streaming.stateStore.providerClass``).
    """
    kind = F.when(succeeded, "fine").when(refused, "refused").otherwise("other")
    rows = log.withWatermark(at, late).select(F.col(host).cast("string").alias("host"), F.col(at), F.unix_millis(at).alias("ms"), F.col(seq).cast("long").alias("seq"), kind.alias("kind"))
    return rows.groupBy("host").transformWithStateInPandas(Breaker(limit, int(cooldown.total_seconds() * 1000)), outputStructType=OUTPUT, outputMode="append", timeMode="eventTime")
