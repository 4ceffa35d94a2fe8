"""Pairing of open and close marks as keyed state with event-time timers.

Rows may come out of order by as much as the watermark allows: they wait in list state until it has passed them, then
they are read in order, with the last open mark in value state.  One timer, at the earliest waiting row or at the time
when an open mark's patience ends, wakes a key without input.  Rows behind the watermark are dropped by Spark and
counted in the query's progress.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from ..sources.shared import folder, written

_MARK = "ms long, event_id long, line long, opens boolean"
_OUT = "user_id long, event_id long, state string, crosses boolean"


class PairMarks(StatefulProcessor):
    """event_id, state (paired, open or close) and crosses of each range; an open mark that no mark follows within
    ``patience`` milliseconds of event time stays open."""

    def __init__(self, patience: int):
        self.patience = patience

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", _MARK)
        self.open = handle.getValueState("open", _MARK)

    def _read(self, key: tuple, until: int) -> Iterator[pd.DataFrame]:
        """Takes the waiting marks up to ``until`` in order, and sets the timer for the rest: whatever is due is read when
        it fires, so the earliest time is enough."""
        waiting = sorted(tuple(r) for r in self.waiting.get())
        due = [m for m in waiting if m[0] <= until]
        held, found = tuple(self.open.get()) if self.open.exists() else None, []
        for mark in due:
            if held is not None:
                found.append((held[1], "open" if mark[3] else "paired", not mark[3] and mark[2] != held[2]))
            elif not mark[3]:
                found.append((mark[1], "close", False))
            held = mark if mark[3] else None
        if held is not None and held[0] + self.patience <= until:
            found.append((held[1], "open", False))
            held = None
        self.open.clear() if held is None else self.open.update(held)
        rest = waiting[len(due) :]
        self.waiting.put(rest) if rest else self.waiting.clear()
        at = [m[0] for m in rest[:1]] + ([held[0] + self.patience] if held is not None else [])
        if at:
            self.handle.registerTimer(min(at))
        if found:
            yield pd.DataFrame([(key[0], *f) for f in found], columns=["user_id", "event_id", "state", "crosses"])

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            self.waiting.appendList([(int(m), int(e), int(d), bool(o)) for m, e, d, o in zip(pdf["ms"], pdf["event_id"], pdf["line"], pdf["opens"])])
        yield from self._read(key, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._read(key, timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def paired(marks: DataFrame, late: str = "1 day", patience_days: int = 366) -> DataFrame:
    """The ranges of a stream of marks (user_id, ts, event_id, line, opens)."""
    keyed = marks.withColumn("ms", F.unix_millis("ts")).withWatermark("ts", late).groupBy("user_id")
    return keyed.transformWithStateInPandas(PairMarks(patience_days * 86_400_000), _OUT, "Append", "EventTime")


def run(marks: DataFrame, batches: int, late: str = "1 day", patience_days: int = 366, order: str = "ts") -> tuple[DataFrame, int, int]:
    """The ranges of a table of marks, fed to the stream in ``batches`` files by ``order``, a trigger each, and then a mark of
    no user far ahead that moves the watermark past all; with the number of triggers and of late rows dropped."""
    spark = marks.sparkSession
    source, sink, state = (folder(spark, x) for x in ("stream-in", "stream-out", "stream-state"))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    fed = written(marks.repartitionByRange(batches, order).withColumn("_p", F.spark_partition_id()), "marks")
    triggers = dropped = 0
    for part in range(batches + 2):
        if part < batches:
            rows = fed.where(F.col("_p") == part).drop("_p")
        else:  # twice: the second is read when the mark has moved
            far = spark.sql(f"SELECT CAST('2200-01-0{part - batches + 1}' AS TIMESTAMP) AS ts, CAST(-1 AS BIGINT) AS user_id, CAST(-1 AS BIGINT) AS event_id, CAST(-1 AS BIGINT) AS line, false AS opens")
            rows = marks.limit(0).unionByName(far, allowMissingColumns=True)
        rows.write.mode("append").parquet(source)
        stream = spark.readStream.schema(marks.schema).parquet(source)  # all that is new is one trigger
        query = paired(stream, late, patience_days).writeStream.format("parquet").option("path", sink).option("checkpointLocation", state).outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination()
        for p in query.recentProgress:
            triggers += p.numInputRows > 0
            dropped += sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
    return spark.read.schema(_OUT).parquet(sink).where("user_id >= 0"), triggers, dropped
