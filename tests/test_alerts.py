"""Chunked hysteresis equals a plain sequential loop, for tiny chunks."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cumulus.operators import alerts as AL
from cumulus.operators import series as S


def loop(ts_us, ps, thr, margin=0.05, hold=10 * 60_000_000):
    carried, out = (AL.INACTIVE, None), []
    for t, p in zip(ts_us, ps):
        carried = AL.advance(*carried, t, p, thr, margin, hold)
        out.append(int(carried[0] != AL.INACTIVE))
    return out


@pytest.mark.parametrize("minutes, scores, alerts", [
    # on at the threshold; held for ten minutes; off only below 0.45 after that
    ([0, 1, 5, 9, 10, 11], [0.5, 0.1, 0.1, 0.1, 0.46, 0.44], [1, 1, 1, 1, 1, 0]),
    # a trigger inside the hold extends it from its own time
    ([0, 9, 12, 18, 19], [0.9, 0.9, 0.0, 0.0, 0.0], [1, 1, 1, 1, 0]),
    # a trigger after the hold keeps the alert on without a new hold
    ([0, 10, 11], [0.9, 0.9, 0.0], [1, 1, 0]),
    ([0, 1, 2], [0.49, 0.0, 0.5], [0, 0, 1]),
])
def test_hysteresis_sequences(minutes, scores, alerts):
    assert loop([m * 60_000_000 for m in minutes], scores, 0.5) == alerts


@pytest.mark.parametrize("chunk", [3, 7, 50, 1 << 17])
def test_hysteresis_chunked(spark, chunk):
    rng = np.random.default_rng(11)
    rows = []
    for loc in ("a", "b"):
        t = pd.Timestamp("2024-07-01")
        for i in range(300):
            t += pd.Timedelta(seconds=int(rng.integers(20, 400)))
            p = float(np.clip(0.5 + 0.3 * np.sin(i / 9) + rng.normal(0, 0.15), 0, 1))
            rows.append((loc, t.to_pydatetime(), p))
    df = spark.createDataFrame(rows, "location_id string, timestamp timestamp, probability double")
    spec = S.SeriesSpec(chunk_rows=chunk, bucket_us=3600 * 1_000_000)
    got = AL.alert_hysteresis(df, threshold=0.55, spec=spec).select("location_id", "timestamp", "alert")
    got = {(r[0], r[1]): r[2] for r in got.collect()}
    for loc in ("a", "b"):
        sub = sorted((t, p) for l, t, p in rows if l == loc)
        exp = loop([int(pd.Timestamp(t).value // 1000) for t, _ in sub], [p for _, p in sub], 0.55)
        assert [got[(loc, t)] for t, _ in sub] == exp


def random_series(rng, n):
    t = np.cumsum(rng.choice([0, 1, 2, 5, 30], n) * 60_000_000 // int(rng.integers(1, 4))).astype("int64")
    p = np.clip(0.5 + rng.normal(0, rng.choice([0.05, 0.3]), n), 0, 1).round(2)
    p[rng.random(n) < 0.1] = np.nan
    return t, p


@pytest.mark.parametrize("hold", [0, 60_000_000, 600_000_000])
def test_episodes_equal_the_sequential_machine(hold):
    """Every reading, every summary, from every kind of entering state."""
    rng = np.random.default_rng(5)
    for _ in range(400):
        t, p = random_series(rng, int(rng.integers(1, 40)))
        m = AL.Readings(t, p, 0.5, 0.05, hold)
        holds = [(AL.PENDING, int(u)) for u in rng.integers(t[0] - 10, t[-1] + 2 * hold + 10, 8)]
        for entered in [(AL.INACTIVE, None), (AL.EXPIRED, int(t[0]))] + holds + [(AL.PENDING, int(t[len(t) // 2]))]:
            now, alert, until = entered, [], []
            for i in range(len(t)):
                now = AL.advance(*now, int(t[i]), p[i], 0.5, 0.05, hold)
                alert.append(int(now[0] != AL.INACTIVE))
                until.append(now[1] or 0)
            got = m.states(*entered)
            assert got[0].tolist() == alert and got[1].tolist() == until
            end = AL.through(m.summary(), *entered)
            # pending and its time passed is expired
            assert end[1] == now[1] and (end[0] == AL.INACTIVE) == (now[0] == AL.INACTIVE)


def test_a_day_at_one_hertz_is_quick():
    import time
    rng = np.random.default_rng(2)
    t = np.arange(86400, dtype="int64") * 1_000_000
    p = rng.random(86400)
    began = time.perf_counter()
    m = AL.Readings(t, p, 0.999, 0.05, 600_000_000)
    m.summary()
    got = m.states(AL.PENDING, 30_000_000)[0]
    assert time.perf_counter() - began < 1
    now = (AL.PENDING, 30_000_000)
    for i in range(len(t)):
        now = AL.advance(*now, int(t[i]), p[i], 0.999, 0.05, 600_000_000)
        assert got[i] == int(now[0] != AL.INACTIVE)


def test_no_time_no_score_and_ties(spark):
    rows = [("a", "2024-07-01 00:00:00", 0.9), ("a", "2024-07-01 00:05:00", None), ("a", "2024-07-01 00:20:00", float("nan")),
            ("a", "2024-07-01 00:30:00", 0.6), ("a", "2024-07-01 00:30:00", 0.1), ("a", None, 0.9), ("b", None, 0.1)]
    df = (spark.createDataFrame(rows, "location_id string, at string, probability double")
          .select("location_id", F.to_timestamp("at").alias("timestamp"), "probability"))
    out = AL.alert_hysteresis(df)
    got = [(r.location_id, str(r.timestamp)[11:16], r.probability if r.probability == r.probability else None, r.alert,
            str(r.alert_until)[11:16]) for r in out.collect()]
    # at 00:30 the low reading goes first and clears, the high one triggers again
    assert sorted(got, key=str) == sorted([("a", "00:00", 0.9, 1, "00:10"), ("a", "00:05", None, 1, "00:10"), ("a", "00:20", None, 1, "00:10"),
                                           ("a", "00:30", 0.1, 0, ""), ("a", "00:30", 0.6, 1, "00:40"), ("a", "", 0.9, None, ""),
                                           ("b", "", 0.1, None, "")], key=str)
    assert AL.alert_hysteresis(df.limit(0)).count() == 0
