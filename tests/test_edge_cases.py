"""Literal edge cases (FIXTURES section 3) with hand-computed results."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cumulus.functions import scalar as X
from cumulus.operators import fill as FL
from cumulus.operators import joins as J
from cumulus.operators import recursive as RC
from cumulus.operators import stats as ST
from cumulus.operators import windows as W
from cumulus.operators import series as S

SCHEMA = "location_id string, timestamp timestamp, rainfall_mm double, pressure double, humidity double"
T0 = dt.datetime(2024, 7, 1, 0, 0)


def mk(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def at(m, s=0):
    return T0 + dt.timedelta(minutes=m, seconds=s)


def by_ts(df, col):
    return [r[col] for r in df.orderBy("location_id", "timestamp").collect()]


def test_empty_input(spark):
    e = mk(spark, [])
    assert W.history_features_station(e).count() == 0
    assert FL.interpolate_fill(e, ["pressure"], 3).count() == 0
    assert RC.ema(e, "pressure").count() == 0


def test_one_row(spark):
    d = mk(spark, [("a", at(0), 1.5, 1000.0, 50.0)])
    r = W.history_features_station(d).first()
    assert (r.rain_last_5min, r.pressure_drop_15min, r.humidity_change) == (1.5, 0.0, 0.0)
    r = W.history_features_predict(d).first()
    assert (r.rain_last_5min, r.pressure_drop_15min) == (0.0, 0.0)
    assert RC.ema(d, "pressure").first().pressure_ema == 1000.0
    k = RC.kalman_1d(d, "pressure").first()
    assert (k.pressure_kalman, k.pressure_kalman_resid) == (1000.0, 0.0)
    assert W.savgol_11_2(d, ["pressure"]).first().pressure_sg == 1000.0


def test_window_edges_exactly_at_t_minus_w(spark):
    # readings at 0, 5 and 15 minutes: the 5-minute window [t-5, t] of the
    # 5-minute reading includes the one at 0; (t-w, t] excludes it
    d = mk(spark, [("a", at(0), 1.0, 1000.0, 50.0), ("a", at(5), 2.0, 999.0, 52.0), ("a", at(15), 4.0, 997.0, 55.0)])
    st = W.history_features_station(d)
    assert by_ts(st, "rain_last_5min") == [1.0, 3.0, 4.0]
    assert by_ts(st, "rain_last_15min") == [1.0, 3.0, 7.0]
    assert by_ts(st, "pressure_drop_15min") == [0.0, 1.0, 3.0]
    right = W.rain_time_sums(d, windows=(5, 15))
    assert by_ts(right, "rain_5") == [1.0, 2.0, 4.0]
    assert by_ts(right, "rain_15") == [1.0, 3.0, 6.0]
    pr = W.history_features_predict(d)
    assert by_ts(pr, "rain_last_5min") == [0.0, 1.0, 0.0]
    assert by_ts(pr, "pressure_drop_15min") == [0.0, -1.0, -3.0]


def test_fallback_when_window_empty(spark):
    # 40 and 90 minutes apart: no reading in [t-15, t); last - first of history
    d = mk(spark, [("a", at(0), 0.0, 1000.0, 50.0), ("a", at(40), 0.0, 998.0, 55.0), ("a", at(130), 0.0, 990.0, 60.0)])
    pr = W.history_features_predict(d)
    assert by_ts(pr, "pressure_drop_15min") == [0.0, 0.0, -2.0]
    assert by_ts(pr, "humidity_change") == [0.0, 0.0, 5.0]


def test_interleaved_stations_and_unseen_code(spark):
    d = mk(spark, [("b", at(0), 1.0, 1000.0, 50.0), ("a", at(0), 5.0, 990.0, 40.0),
                   ("b", at(1), 2.0, 1001.0, 51.0), ("a", at(1), 6.0, 991.0, 41.0)])
    st = W.history_features_station(d)
    assert by_ts(st, "rain_last_5min") == [5.0, 11.0, 1.0, 3.0]
    codes = J.fit_location_codes(d)
    other = mk(spark, [("zz", at(0), 0.0, 0.0, 0.0), ("b", at(0), 0.0, 0.0, 0.0)])
    enc = {r.location_id: r.location_id_enc for r in J.encode_location(other, codes).collect()}
    assert enc == {"zz": 0, "b": 1}


@pytest.mark.parametrize("gap,k,expect", [
    (1, 3, [1.0, 2.0, 3.0]),
    (3, 3, [1.0, 2.0, 3.0, 4.0, 5.0]),
    (7, 3, [1.0, 2.0, 3.0, 4.0, 4.0, 6.0, 7.0, 8.0, 9.0]),   # middle: forward fill of the last filled value
])
def test_inner_gap_interpolation(spark, gap, k, expect):
    vals = [1.0] + [None] * gap + [float(gap + 2)]
    d = mk(spark, [("a", at(i), 0.0, v, 0.0) for i, v in enumerate(vals)])
    assert by_ts(FL.interpolate_fill(d, ["pressure"], k), "pressure") == expect
    lim = by_ts(FL.interpolate_limit(d, ["pressure"], k), "pressure")
    assert [v for v in lim if v is not None] == [v for v, n in zip(expect, lim) if n is not None]


def test_leading_and_trailing_gaps(spark):
    vals = [None] * 6 + [10.0, 11.0] + [None] * 6
    d = mk(spark, [("a", at(i), 0.0, v, 0.0) for i, v in enumerate(vals)])
    got = by_ts(FL.interpolate_limit(d, ["pressure"], 4), "pressure")
    assert got == [None, None] + [10.0] * 5 + [11.0] * 5 + [None, None]
    assert by_ts(FL.interpolate_fill(d, ["pressure"], 4), "pressure") == [10.0] * 7 + [11.0] * 7


def test_all_null_and_constant(spark):
    d = mk(spark, [("a", at(i), 0.0, None, 7.0) for i in range(5)])
    assert by_ts(FL.ffill_bfill(d, ["pressure"]), "pressure") == [None] * 5
    z = ST.zscore_outliers(d, ["humidity"], None)   # std 0 -> no flags
    assert by_ts(z, "humidity_is_outlier") == [False] * 5
    k = RC.residual_outliers(RC.kalman_1d(d, "humidity"), "humidity_kalman_resid", "flag")
    assert by_ts(k, "flag") == [False] * 5


def test_stuck_run_quirks(spark):
    # first run of 21 equal values: counted one extra and flagged entirely;
    # a later run of 20: all but its first element flagged
    vals = [5.0] * 21 + [6.0] + [7.0] * 20 + [8.0]
    d = mk(spark, [("a", at(i), 0.0, v, 0.0) for i, v in enumerate(vals)])
    flags = by_ts(W.stuck_flags(d, ["pressure"], 20), "pressure_stuck")
    assert flags == [True] * 21 + [False] + [False] + [True] * 19 + [False]


def test_risk_bands_and_alert_threshold(spark):
    d = spark.createDataFrame([(p,) for p in (0.0, 0.099999, 0.10, 0.29999, 0.30, 0.59999, 0.60, 1.0, 0.000775)],
                              "p double")
    out = d.select(X.risk_level("p").alias("r"), X.alert_flag("p", 0.31532663316582915).alias("a")).collect()
    assert [r.r for r in out] == ["LOW", "LOW", "MODERATE", "MODERATE", "HIGH", "HIGH", "CRITICAL", "CRITICAL", "LOW"]
    assert [r.a for r in out] == [0, 0, 0, 0, 0, 1, 1, 1, 0]


def test_scalar_rules(spark):
    d = spark.createDataFrame([(0.0, 0.0), (10.0, 90.0), (80.0, -90.0), (-180.0, 45.0)], "r double, a double")
    out = d.select(X.reflectivity_zr("r").alias("z"), X.compass8("a").alias("c")).collect()
    assert [o.z for o in out][:2] == [0.0, 39.01]
    assert [o.c for o in out] == ["E", "N", "S", "NE"]


def test_kalman_gains_fixed_point():
    g = RC.kalman_gains()
    assert g[0] == 0.0 and abs(g[1] - 1.01 / 2.01) < 1e-15
    assert len(g) < 400 and abs(g[-1] - 0.0951249219725) < 1e-12


@pytest.mark.parametrize("closed,expect", [
    ("right", [1.0, 2.0, 4.0]),     # (t-5, t]
    ("left", [0.0, 1.0, 0.0]),      # [t-5, t)
    ("both", [1.0, 3.0, 4.0]),      # [t-5, t]
    ("neither", [0.0, 0.0, 0.0]),   # (t-5, t)
])
def test_time_window_closedness(spark, closed, expect):
    d = mk(spark, [("a", at(0), 1.0, 1.0, 1.0), ("a", at(5), 2.0, 1.0, 1.0), ("a", at(15), 4.0, 1.0, 1.0)])
    got = W.rain_time_sums(d, windows=(5,), closed=closed)
    assert [v or 0.0 for v in by_ts(got, "rain_5")] == expect


def test_broadcasts_are_bounded_by_bytes(spark):
    from cumulus.operators import joins as J
    small = spark.createDataFrame([(1, "x" * 1000, [1, 2]), (2, None, None)], "k long, s string, a array<int>")
    n, size = J.measured(small)
    assert n == 2 and 1000 < size < 1300
    assert J.measured(small.limit(0)) == (0, 0)
    big = spark.range(4).withColumnRenamed("id", "k")
    for bound, broadcast in ((1 << 20, True), (500, False)):
        out = J.attach(big, small, "k", max_bytes=bound)
        assert ("strategy=broadcast" in out._jdf.queryExecution().logical().toString()) == broadcast
        assert sorted((r.k, r.s and len(r.s)) for r in out.collect()) == [(0, None), (1, 1000), (2, None), (3, None)]
