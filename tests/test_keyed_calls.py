"""A key that catches up makes a bounded number of timers, and hands on the same rows."""

from datetime import datetime, timedelta

import pandas as pd

from cumulus.streaming.keyed import BUCKET_US, InOrder

MINUTE = 60_000_000


class Map(dict):
    def getValue(self, k): return self.get(k)
    def containsKey(self, k): return k in self
    def updateValue(self, k, v): self[k] = v
    def removeKey(self, k): del self[k]
    def iterator(self): return iter(list(self.items()))


class Value:
    def __init__(self): self.v = None
    def exists(self): return self.v is not None
    def get(self): return self.v
    def update(self, v): self.v = v
    def clear(self): self.v = None


class Handle:
    def __init__(self): self.timers, self.registered = set(), 0
    def getMapState(self, name, *_): return Map()
    def getValueState(self, *_): return Value()
    def registerTimer(self, t): self.registered += 1; self.timers.add(t)
    def deleteTimer(self, t): self.timers.discard(t)


class Watermark:
    def __init__(self, ms): self.ms = ms
    def getCurrentWatermarkInMs(self): return self.ms
    def getExpiryTimeInMs(self): return self.ms


def _run(batches, span=15 * MINUTE):
    """(time, rows in the last 15 minutes) of each row; timers registered."""
    def step(n, past, key, t, peers):
        past.rows.extend((t, 1) for _ in peers)
        return n + len(peers), [(key, t, len(past.since(t - span)), n + len(peers))]

    p, h, out = InOrder("timestamp", ["k", "t", "near", "n"], lambda: 0, step, span, BUCKET_US, None), Handle(), []
    p.init(h)
    for times, watermark in batches:
        if times:
            list(p.handleInputRows(("a",), iter([pd.DataFrame({"timestamp": times})]), Watermark(watermark)))
        while due := sorted(t for t in h.timers if t < watermark):
            for frame in p.handleExpiredTimer(("a",), Watermark(watermark), Watermark(due[0])):
                out += frame.values.tolist()
            h.timers.discard(due[0])
    return out, h.registered


def test_catching_up_takes_few_timers():
    t0 = datetime(2024, 7, 1)
    times = [t0 + timedelta(minutes=i) for i in range(2000)]
    ms = int((pd.Timestamp(t0) - pd.Timestamp(0)).total_seconds() * 1000)
    end = ms + 2 * 86_400_000
    at_once, timers = _run([(times, ms), ([], end)])
    assert len(at_once) == 2000 and timers <= 3  # one a bucket before: 200 and 200 more
    assert [r[2] for r in at_once] == [min(i + 1, 16) for i in range(2000)]
    parts = [(times[i:i + 100], ms + (i + 90) * 60_000) for i in range(0, 2000, 100)] + [([], end)]
    assert _run(parts)[0] == at_once
