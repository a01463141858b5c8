"""What becomes of files that a service is asked about again and again, as a stream with state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.tasks import ENDED
from .seen import state_in_rocks

OUT = "file string, state string, at timestamp"


class _Ends(StatefulProcessor):
    """State of a file that isn't at an end: when it began, and its timer.  State of one that
    is: that it ended; it goes ``keep_ms`` later, by its TTL or, where time is the reports'
    own and there is none, by a timer."""

    def __init__(self, timeout_ms: int, keep_ms: int, wall_clock: bool):
        self.timeout_ms, self.keep_ms, self.wall_clock = timeout_ms, keep_ms, wall_clock

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "begun bigint, timer bigint")
        self.ended = handle.getValueState("ended", "at bigint", ttlDurationMs=self.keep_ms if self.wall_clock else None)

    def _now(self, timers) -> int:
        return timers.getCurrentProcessingTimeInMs() if self.wall_clock else timers.getCurrentWatermarkInMs()

    def _end(self, key: tuple, state: str, at_us: int, timers) -> pd.DataFrame:
        """Emits a file's end, and forgets all but that it ended."""
        if self.open.exists():
            self.handle.deleteTimer(self.open.get()[1])
            self.open.clear()
        self.ended.update((at_us,))
        if not self.wall_clock:
            self.handle.registerTimer(max(at_us // 1000, self._now(timers)) + self.keep_ms)
        return pd.DataFrame({"file": [key[0]], "state": [state], "at": [pd.Timestamp(at_us, unit="us")]})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        first = last = final = None
        for frame in rows:  # one at a time: a file may have any number of reports
            us = frame["us"]
            first, last = (us.min() if first is None else min(first, us.min())), (us.max() if last is None else max(last, us.max()))
            ends = frame[frame["state"].isin(ENDED)]
            if len(ends):
                row = ends.sort_values(["us", "ord"]).iloc[0]
                found = (int(row["us"]), int(row["ord"]), row["state"])
                final = found if final is None else min(final, found)
        if first is None or self.ended.exists():
            return
        if self.wall_clock:
            first = last = self._now(timerValues) * 1000
            final = final and (first, 0, final[2])
        before = self.open.get() if self.open.exists() else None
        begun = int(first) if before is None else min(before[0], int(first))
        limit = begun + self.timeout_ms * 1000
        if final is not None and final[0] <= limit:
            yield self._end(key, final[2], final[0], timerValues)
        elif last > limit:
            yield self._end(key, "timeout", limit, timerValues)
        elif before is None or begun < before[0]:
            if before is not None:
                self.handle.deleteTimer(before[1])
            timer = max(limit // 1000, self._now(timerValues)) + 1
            self.handle.registerTimer(timer)
            self.open.update((begun, timer))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802
        if self.ended.exists():
            self.ended.clear()  # its time is over
        elif self.open.exists():
            yield self._end(key, "timeout", self.open.get()[0] + self.timeout_ms * 1000, timerValues)

    def close(self) -> None:
        pass


def final_states(reports: DataFrame, timeout_s: float = 300, late_s: int = 0, keep_s: float = 86_400, wall_clock: bool = False) -> DataFrame:
    """ST7: reports (file, state, ts, ord) on a stream -> one row for each file that is at an
    end: ``done`` or ``failed`` by its first such report, or ``timeout`` if there was none in
    ``timeout_s`` seconds from its first report.

    Time is the reports' own, so a replay gives the same, and reports may come ``late_s``
    seconds late; or, with ``wall_clock``, the time at which they come in: a timeout then
    needs no further report.  State is kept for files that aren't at an end, and for ``keep_s``
    seconds after it, as a later report must not start a file again; then it is gone, so
    state is bounded by the files of that time.  With ``wall_clock`` the stream needs a trigger
    that goes on (timers fire in its batches), not one that ends with the data."""
    state_in_rocks(reports.sparkSession)
    own = reports.select("file", "state", F.col("ts").cast("timestamp").alias("ts"), F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), F.col("ord").cast("bigint").alias("ord"))
    keyed = own if wall_clock else own.withWatermark("ts", f"{late_s} seconds")
    ends = _Ends(int(timeout_s * 1000), int(keep_s * 1000), wall_clock)
    return keyed.groupBy("file").transformWithStateInPandas(ends, OUT, "append", "ProcessingTime" if wall_clock else "EventTime")
