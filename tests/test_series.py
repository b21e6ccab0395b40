"""The chunked / bucketed plans must equal the single-chunk result: tiny
buckets and chunks force many halos and cross-chunk carries."""

import pytest
from pyspark.sql import functions as F

from cumulus.operators import series as S
from cumulus.operators import windows as W
from cumulus.sources import fixtures as fx
from conftest import SF001, rows

TINY = S.SeriesSpec(bucket_us=7 * S.US_PER_MINUTE, chunk_rows=13)
BIG = S.SeriesSpec()
KEY = ["location_id", "timestamp"]


@pytest.fixture(scope="module")
def dirty(spark):
    return fx.sensor_dirty(spark, SF001).cache()


def same(a, b, cols):
    assert rows(a, cols) == rows(b, cols)


def test_positions(spark, dirty):
    a = S.with_positions(dirty, TINY).select(*KEY, S.POS, S.NROWS)
    ref = dirty.select(*KEY, (F.row_number().over(
        __import__("pyspark.sql").sql.Window.partitionBy("location_id").orderBy("timestamp")) - 1)
        .alias(S.POS), F.count(F.lit(1)).over(
        __import__("pyspark.sql").sql.Window.partitionBy("location_id")).alias(S.NROWS))
    same(a, ref, KEY + [S.POS, S.NROWS])


@pytest.mark.parametrize("op", [
    lambda d, s: W.history_features_station(d, spec=s),
    lambda d, s: W.rain_time_sums(d, spec=s),
    lambda d, s: W.sensor_stats_15(d, "temperature", "humidity", "pressure", "wind_gust", spec=s),
    lambda d, s: W.history_features_predict(d, spec=s),
    lambda d, s: W.generated_rolling(d, spec=s),
    lambda d, s: W.median_mean_smooth(d, ["pressure", "humidity"], spec=s),
    lambda d, s: W.savgol_11_2(d, ["temperature"], spec=s),
    lambda d, s: W.stuck_flags(d, ["temperature", "pressure"], spec=s),
    lambda d, s: W.spike_flags(d, {"pressure": 3.0}, spec=s),
    lambda d, s: W.trend20(d, ["humidity", "pressure"], spec=s),
    lambda d, s: W.asof_fallback(d, spec=s),
])
def test_chunked_equals_whole(spark, dirty, op):
    a = S.drop_helpers(op(dirty, TINY))
    b = S.drop_helpers(op(dirty, BIG))
    same(a, b, a.columns)


def test_linear_recurrence_matches_loop(spark, dirty):
    # EMA with s0 = x0: a = 0 at the first row, else 0.7; b = 0.3 x (x0 first)
    x = S.with_positions(dirty, TINY)
    a = F.when(F.col(S.POS) == 0, 0.0).otherwise(0.7)
    b = F.when(F.col(S.POS) == 0, F.col("temperature")).otherwise(0.3 * F.col("temperature"))
    got = S.linear_recurrence(x, TINY, a, b, "ema").select(*KEY, "ema")
    pdf = dirty.select(*KEY, "temperature").toPandas().sort_values(KEY)
    exp = []
    for loc, g in pdf.groupby("location_id"):
        s = None
        for t, v in zip(g["timestamp"], g["temperature"]):
            s = v if s is None else 0.3 * v + 0.7 * s
            exp.append((loc, t, round(s, 6)))
    got_rows = sorted((r[0], r[1], round(r[2], 6)) for r in got.collect())
    assert [(a, round(c, 6)) for a, _, c in got_rows] == [(a, c) for a, _, c in sorted(exp)]


@pytest.mark.parametrize("k", [1, 3, 4])
def test_interpolate_fill_one_pass(spark, dirty, k):
    from cumulus.operators import fill as FL
    cols = ["pressure", "temperature"]
    d = dirty.withColumn("temperature", F.when(F.col("temperature") == 20.0, None).otherwise(F.col("temperature")))
    a = S.drop_helpers(FL.interpolate_fill(d, cols, k, spec=TINY))
    b = S.drop_helpers(FL.ffill_bfill(FL.interpolate_limit(d, cols, k, spec=BIG), cols, spec=BIG))
    same(a, b, KEY + cols)


def test_fused_spike_stuck_equals_two_steps(spark, dirty):
    lim = {"pressure": 3.0, "temperature": 5.0}
    cols = ["temperature", "pressure"]
    a = S.drop_helpers(W.spike_and_stuck(dirty, lim, cols, spec=TINY))
    b = S.drop_helpers(W.stuck_flags(W.spike_flags(dirty, lim, spec=BIG), cols, spec=BIG))
    keep = KEY + cols + [f"{c}_spike" for c in lim] + [f"{c}_stuck" for c in cols]
    same(a, b, keep)
