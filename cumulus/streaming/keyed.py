"""Keyed state in event-time order.

Files and partitions arrive in any order, so a key's rows wait in its state until
the watermark has passed them and are then stepped through by time, rows of one
time together.  Rows that come behind the watermark are dropped by the engine,
which counts them (``numRowsDroppedByWatermark``); `streams.run_append` and
`streams.run_foreach_batch` write that count beside the output.

State is kept in pieces, so what a batch reads and writes grows with its new rows and
not with all that waits:

* ``waiting``: a map from time bucket to the rows that wait in it.  A key has one timer, at
  the end of its first bucket; it hands on all buckets that the watermark has passed, so a
  stream that catches up makes a few calls a bucket and not one timer each.
* ``history``: a map from time bucket to the rows of the last ``span`` that the steps
  look back at.  Handing on writes the buckets still in it and removes those that are too old.
* ``value``: the small rest that a step carries on (an average, an alert's state).

A key that falls silent loses its history by a timer when the span has passed, and its value
too if that is what a new key starts with, so this changes no result.  With ``keep`` its
value goes after that time (microseconds) whatever it is, and the key starts anew if it
comes back; the rule is applied by the rows' times, so batches don't change it.
"""

from __future__ import annotations

import pickle
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

#: Rows of this many microseconds wait and are handed on together (whole milliseconds).
BUCKET_US = 600_000_000

#: Timers and maps need this state store.
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: Rows of one frame that a key hands on.
OUT_ROWS = 10_000


class History:
    """The rows (t, values...) of the last span microseconds, in order of time."""

    def __init__(self, span: int, rows=()):
        self.span, self.rows, self.first = span, list(rows), 0

    def _from(self, t: int) -> int:
        return bisect_left(self.rows, t, self.first, key=lambda r: r[0])

    def forget(self, t: int) -> None:
        self.first = self._from(t - self.span)
        if self.first > 1000 and 2 * self.first > len(self.rows):
            del self.rows[:self.first]
            self.first = 0

    def since(self, t: int) -> list[tuple]:
        return self.rows[self._from(t):]

    def first_since(self, t: int) -> tuple | None:
        i = self._from(t)
        return self.rows[i] if i < len(self.rows) else None


class InOrder(StatefulProcessor):
    """Steps through each key's rows; see `in_order` for the parameters."""

    def __init__(self, ts: str, names: list[str], start: Callable, step: Callable, span: int, width: int,
                 keep: int | None):
        self.ts, self.names, self.start, self.step = ts, names, start, step
        self.span, self.width, self.keep = span, width, keep

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "bucket long", "rows binary")
        self.history = handle.getMapState("history", "bucket long", "rows binary")
        # due: time of the timer that clears a silent key, in milliseconds
        self.value = handle.getValueState("value", "packed binary, last long, due long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            new = defaultdict(list)
            us = pd.to_datetime(pdf[self.ts]).astype("datetime64[us]").astype("int64")
            for t, row in zip(us.tolist(), pdf.to_dict("records")):
                new[t // self.width].append((t, row))
            for bucket, more in new.items():
                before = self.waiting.getValue((bucket,))
                if before is not None:
                    more = pickle.loads(before[0]) + more
                self.waiting.updateValue((bucket,), (pickle.dumps(more),))
            if new:
                self.handle.registerTimer((min(new) + 1) * self.width // 1000)
        yield pd.DataFrame(columns=self.names)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at = expiredTimerInfo.getExpiryTimeInMs()
        if at * 1000 % self.width == 0:
            yield from self.hand_on(key, max(at, timerValues.getCurrentWatermarkInMs()) * 1000)
        elif self.value.exists():
            packed, last, due = self.value.get()
            if due == at:
                self.clear(packed, last, due)
        yield pd.DataFrame(columns=self.names)

    def hand_on(self, key, passed: int) -> Iterator[pd.DataFrame]:
        """Step through the rows of all buckets that end by ``passed``."""
        buckets = sorted(k[0] for k in self.waiting.keys())
        ready = [b for b in buckets if (b + 1) * self.width <= passed]
        if not ready:
            return
        value, last, due = self.start(), None, None
        if self.value.exists():
            packed, last, due = self.value.get()
            value = pickle.loads(packed)
        stored = sorted((k[0], v[0]) for k, v in self.history.iterator()) if self.span else []
        past = History(self.span, [r for _, packed in stored for r in pickle.loads(packed)])
        out = []
        for bucket in ready:
            rows = sorted(pickle.loads(self.waiting.getValue((bucket,))[0]), key=lambda x: x[0])
            for t, peers in groupby(rows, key=lambda x: x[0]):
                past.forget(t)
                if self.keep is not None and last is not None and t - last >= self.keep:
                    value = self.start()  # also if the timer is not due yet, so batches change nothing
                value, got = self.step(value, past, key[0], t, [p for _, p in peers])
                out += got
                last = t
            if len(out) >= OUT_ROWS:
                yield pd.DataFrame(out, columns=self.names)
                out = []
        if len(ready) == len(buckets):
            self.waiting.clear()
        else:
            for bucket in ready:
                self.waiting.removeKey((bucket,))
            self.handle.registerTimer((buckets[len(ready)] + 1) * self.width // 1000)
        end = (ready[-1] + 1) * self.width
        for k, _ in stored:
            if (k + 1) * self.width <= end - self.span:
                self.history.removeKey((k,))
        for k, own in groupby(past.rows[past.first:], key=lambda r: r[0] // self.width):
            if k >= ready[0]:
                self.history.updateValue((k,), (pickle.dumps(list(own)),))
        if due is not None:
            self.handle.deleteTimer(due)
        self.wait_for_silence(pickle.dumps(value), last, self.span, end)
        yield pd.DataFrame(out, columns=self.names)

    def wait_for_silence(self, packed: bytes, last: int, silent: int, end: int) -> None:
        # half a bucket off the buckets' ends, so that no timer stands for both
        due = (-(-max(last + silent, end) // self.width) * self.width + self.width // 2) // 1000
        self.handle.registerTimer(due)
        self.value.update((packed, last, due))

    def clear(self, packed: bytes, last: int, due: int) -> None:
        self.history.clear()
        gone = self.keep is not None and due * 1000 >= last + self.keep
        if gone or pickle.loads(packed) == self.start():
            self.value.clear()
        elif self.keep is not None:
            self.wait_for_silence(packed, last, max(self.keep, self.span), due * 1000)
        else:
            self.value.update((packed, last, None))


def in_order(stream: DataFrame, key: str, ts: str, watermark: str, out: str, start: Callable[[], object],
             step: Callable, span: int = 0, bucket_us: int = BUCKET_US, keep: int | None = None) -> DataFrame:
    """``step(value, past, key, t_us, peers) -> (value, rows)`` for each time of each
    key; peers are the named rows of that time, rows tuples for the columns of out.

    past (`History`) has the tuples that earlier steps put into ``past.rows`` in the last ``span``
    microseconds.  Rows come out when the watermark has passed the end of their bucket.
    Rows without a key or a time have no place in a series and are left out."""
    spark = stream.sparkSession
    if spark.conf.get(PROVIDER, None) != ROCKS:
        spark.conf.set(PROVIDER, ROCKS)
    if bucket_us % 2000:
        raise ValueError("a bucket is an even number of milliseconds")
    names = [c.split()[0] for c in out.split(", ")]
    rows = stream.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
    return (rows.withWatermark(ts, watermark).groupBy(key).transformWithStateInPandas(
        InOrder(ts, names, start, step, span, bucket_us, keep), out, "append", "eventTime"))


def number(v) -> float | None:
    """None for NULL and NaN."""
    return None if v is None or v != v else float(v)
