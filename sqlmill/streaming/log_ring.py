"""T1 on a stream: the newest lines of every run, kept as state.

Each run has a ring of its newest ``n`` lines in list state (``transformWithState``).
A trigger merges the run's new lines into the ring, in order of time and
sequence whatever order they arrive in, and emits the ring as it is then.  With
``keep`` a run that has ended (by its last line) keeps its ring for that long
in the stream's time; then a timer drops the state.  Lines that repeat a (time, sequence) pair already in the ring
are the same line and change nothing, so a source that is read again after a
restart does no harm.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: fixed value: lines of a run that stay available
RING = 1000
_LINE = "ts_us long, seq long, message string, ended boolean"
OUTPUT = "run_id long, rank long, seq long, message string"
#: The state store that list state and timers need.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"


def ring_processor(n: int, keep_ms: int | None) -> StatefulProcessor:
    """The processor of one run's ring.  Its class is made here so that it travels by value: the
    driver-side worker that plans its state does not see files shipped to executors."""
    line = _LINE

    class LogRing(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.ring = handle.getListState("ring", line)

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            lines = {(t, s): (m, e) for t, s, m, e in (self.ring.get() if self.ring.exists() else ())}
            for part in rows:
                for t, s, m, e in part[["ts_us", "seq", "message", "ended"]].itertuples(index=False):
                    lines.setdefault((int(t), int(s)), (m, bool(e)))
                for old in sorted(lines)[:-n]:  # no more than the ring and one batch in memory
                    del lines[old]
            order = sorted(lines)
            self.ring.put([(t, s, *lines[t, s]) for t, s in order])
            if keep_ms is not None:
                for timer in list(self.handle.listTimers()):
                    self.handle.deleteTimer(timer)
                if lines[order[-1]][1]:
                    self.handle.registerTimer(order[-1][0] // 1000 + keep_ms)
            newest = order[::-1]
            yield pd.DataFrame({"run_id": [key[0]] * len(newest), "rank": range(1, len(newest) + 1), "seq": [s for _, s in newest],
                                "message": [lines[k][0] for k in newest]})

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            self.ring.clear()
            return iter(())

        def close(self) -> None:
            pass
    return LogRing()


def stream_latest_logs(log: DataFrame, n: int = RING, keep: str | None = None, ended=None) -> DataFrame:
    """Stream of (run_id, ts, seq, message) -> the rings of the runs that got lines in a trigger, as
    (run_id, rank, seq, message), rank 1 the newest; update mode.

    ``ended`` is a condition on a line that ends its run, and ``keep`` (such as '1 hour') how long the
    ring stays after it; lines that come later than ``keep`` behind the newest are then dropped (the
    watermark).  Without ``keep`` nothing is dropped and rings stay.  Set ``PROVIDER_KEY`` to
    ``PROVIDER`` before the query starts."""
    log = log.withColumn("ts", F.col("ts").cast("timestamp"))
    if keep:
        log = log.withWatermark("ts", keep)
    last = F.coalesce(F.lit(False) if ended is None else ended, F.lit(False))
    lines = log.select("run_id", "ts", F.unix_micros("ts").alias("ts_us"), "seq", "message", last.alias("ended"))
    keep_ms = pd.Timedelta(keep) // pd.Timedelta(milliseconds=1) if keep else None
    return lines.groupBy("run_id").transformWithStateInPandas(
        statefulProcessor=ring_processor(n, keep_ms), outputStructType=OUTPUT, outputMode="Update", timeMode="EventTime" if keep else "None")
