"""Trailing frames of dense series: linear, and equal to each row's own frame."""

from datetime import datetime, timedelta

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from cumulus.operators import series as S
from cumulus.operators import windows as W

T0 = datetime(2024, 7, 1, 22, 0)


def _rows():
    out = []
    for i in range(200):
        at = None if i % 50 == 49 else T0 + timedelta(seconds=(i * 37) % 9000)
        rain = None if i % 7 == 0 else float("nan") if i == 90 else float("inf") if i == 10 else i / 8
        out.append((f"s{i % 2}", at, rain, None if i % 9 == 0 else float(i), float(-i)))
    return out + [("s0", T0 + timedelta(seconds=3), 1.0, 5.0, 6.0), ("s0", T0 + timedelta(seconds=3), 2.0, 4.0, 7.0)]


def test_frames_equal_each_rows_own(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "location_id string, timestamp timestamp, rainfall_mm double, pressure double, humidity double")
    m = timedelta(minutes=20)
    got = {(r.location_id, r.timestamp, r.humidity): r for r in W.history_range_join(df, 20).collect() if r.timestamp}
    base = {(r.location_id, r.timestamp, r.humidity): r for r in W.asof_baseline(df, 20).collect() if r.timestamp}
    timed = [r for r in rows if r[1]]
    assert len(got) == len(base) == len(timed)
    for k, t, _, _, h in timed:
        frame = sorted((r for r in timed if r[0] == k and t - m <= r[1] < t),
                       key=lambda r: (r[1], r[3] is None, r[3] or 0.0, r[4]))
        g, b = got[k, t, h], base[k, t, h]
        want = sum(r[2] for r in frame if r[2] is not None)
        assert g.history_rows == len(frame)
        assert np.isclose(g.history_rain, want, equal_nan=True)
        assert (g.history_first_ts, g.history_last_ts) == ((frame[0][1], frame[-1][1]) if frame else (None, None))
        assert (b.baseline_pressure, b.baseline_humidity) == ((frame[0][3], frame[0][4]) if frame else (None, None))


def test_timed_rows_take_no_sliding_window(spark):
    df = spark.createDataFrame(_rows(), "location_id string, timestamp timestamp, rainfall_mm double, pressure double, humidity double")
    for out in (W.history_range_join(df, 180), W.asof_baseline(df, 180)):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "FlatMapGroupsInArrow" in plan


def test_sums_without_cancellation():
    v = pa.array([1e12, 0.1, None, float("inf"), 0.2, float("-inf"), 0.3])
    first, end = np.array([0, 1, 3, 3, 6, 4]), np.array([0, 3, 5, 6, 7, 5])
    got = W.frame_sums(v, first, end)
    assert got[0] == 0 and abs(got[1] - 0.1) < 1e-6 and got[2] == np.inf and np.isnan(got[3])
    assert abs(got[4] - 0.3) < 1e-6 and abs(got[5] - 0.2) < 1e-6
