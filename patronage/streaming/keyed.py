"""Sliding counts of a stream as one piece of state per visitor.

A windowed aggregate copies a view into every window it lies in and keeps a row of state for
each. Here a visitor's state is one row: a ring of the ticks that can still be in an
open window, with their counts. A batch of views adds to its ticks and tells the windows
it changed; a timer clears ticks that the watermark has passed, and with the last of them the
row.
"""

from __future__ import annotations

import datetime as dt
import itertools
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

MICROS = 1_000_000
# Windows that one row may list.
LISTED = 10_000
#: State lives in RocksDB, on disk and not in the heap; a stream takes the setting when it starts.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def micros(text: str) -> int:
    """Length of an interval such as '15 seconds'."""
    number, unit = text.split()
    one = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]
    return int(number) * one * MICROS


class Ring(StatefulProcessor):
    """Ticks and counts of a visitor. Lengths are in microseconds; a tick divides window and slide."""

    def __init__(self, window: int, slide: int, tick: int):
        self.window, self.slide, self.tick = window, slide, tick

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ring = handle.getValueState("ring", "ticks array<bigint>, counts array<bigint>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        for start, total, _ in self._changed(rows):
            yield Row(start=self._time(start), end=self._time(start + self.window), visitor=key[0], count=total)

    def _changed(self, rows) -> Iterator[tuple[int, int, bool]]:
        """Add views to the ring: start and count of every window they change, and whether it was empty before."""
        fresh = Counter(row["at"] // self.tick * self.tick for row in rows)
        known = self.ring.get() if self.ring.exists() else ([], [])
        ring = Counter(dict(zip(known[0], known[1], strict=True)))
        ring.update(fresh)
        self._keep(ring)
        starts = set()
        for at in fresh:  # the windows that hold a changed tick
            last = at // self.slide * self.slide
            starts.update(range(last, at - self.window, -self.slide))
        ticks = sorted(ring)
        low = high = total = added = 0
        for start in sorted(starts):
            while high < len(ticks) and ticks[high] < start + self.window:
                total += ring[ticks[high]]
                added += fresh[ticks[high]]
                high += 1
            while low < high and ticks[low] < start:
                total -= ring[ticks[low]]
                added -= fresh[ticks[low]]
                low += 1
            yield start, total, total == added

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        ticks, counts = self.ring.get() if self.ring.exists() else ([], [])
        self._keep({t: n for t, n in zip(ticks, counts, strict=True) if t + self.tick + self.window > passed})
        return iter(())

    def _keep(self, ring: dict[int, int]) -> None:
        """Store the ring; its oldest tick sets the one timer."""
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if ring:
            ticks = sorted(ring)
            self.ring.update((ticks, [ring[t] for t in ticks]))
            self.handle.registerTimer((ticks[0] + self.tick + self.window) // 1000 + 1)
        else:
            self.ring.clear()

    @staticmethod
    def _time(at: int) -> dt.datetime:
        return dt.datetime.fromtimestamp(at // MICROS, dt.timezone.utc).replace(microsecond=at % MICROS)

    def close(self) -> None:
        pass


class PackedRing(Ring):
    """The same state; what a batch changes is told in a few rows of long lists, which the JVM unfolds."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        changed = self._changed(rows)
        while some := list(itertools.islice(changed, LISTED)):
            starts, counts, firsts = map(list, zip(*some))
            yield Row(visitor=key[0], starts=starts, counts=counts, firsts=firsts)


def _changes(views: DataFrame, late: str, window: str, slide: str, tick: str) -> DataFrame:
    """Windows that a batch changes: start, end, visitor, count, and whether the visitor is new there (``first``)."""
    views.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    w, s, t = micros(window), micros(slide), micros(tick)
    if w % t or s % t:
        raise ValueError("the tick must divide window and slide")
    # views of the same tick are counted where they are kept; only visitor and time travel
    marked = views.withWatermark("timestamp", late).select("visitor", "timestamp", F.unix_micros("timestamp").alias("at"))
    lists = marked.groupBy("visitor").transformWithState(
        PackedRing(w, s, t), "visitor string, starts array<bigint>, counts array<bigint>, firsts array<boolean>", "Update", "EventTime"
    )
    each = lists.select("visitor", F.explode(F.arrays_zip("starts", "counts", "firsts")).alias("c"))
    begin = F.col("c.starts")
    return each.select(
        F.timestamp_micros(begin).alias("start"), F.timestamp_micros(begin + w).alias("end"), "visitor",
        F.col("c.counts").alias("count"), F.col("c.firsts").alias("first"),
    )


def visitor_counts(views: DataFrame, late: str, window: str = "15 seconds", slide: str = "2 seconds", tick: str = "1 second") -> DataFrame:
    """Views per visitor in a sliding window, of a stream: the newest count of every window that a batch changes.

    For an update-mode sink such as ``feed.write_updates``. ``late`` is how long after its time a view may still arrive.
    """
    return _changes(views, late, window, slide, tick).drop("first")


def new_visitors(views: DataFrame, late: str, window: str = "15 seconds", slide: str = "2 seconds", tick: str = "1 second") -> DataFrame:
    """Every window and visitor once, with the batch that first sees it: start, end, visitor.

    A window's rows over all batches are its different visitors, so they are counted and need not be compared.
    """
    return _changes(views, late, window, slide, tick).where("first").select("start", "end", "visitor")
