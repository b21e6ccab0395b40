"""The smoothing stage of pipeline B: compilable smoother, residuals without a shuffle by station."""
from __future__ import annotations

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from cumulus.operators import recursive as RC
from cumulus.operators import series as S
from cumulus.operators import windows as W

COLS = ["a", "b", "c", "d", "e"]
JIT_LIMIT = 8000  # bytes of a method that HotSpot still compiles


def readings(spark, n=60, keys=2):
    rng = np.random.default_rng(3)
    start = dt.datetime(2024, 7, 1, 23, 30)
    rows = [(f"loc_{k}", start + dt.timedelta(minutes=i), *[float(round(rng.normal(), 3)) for _ in COLS])
            for k in range(keys) for i in range(n)]
    return spark.createDataFrame(rows, "location_id string, timestamp timestamp, " + ", ".join(f"{c} double" for c in COLS))


def generated(spark, df) -> int:
    """Size of the longest generated method."""
    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = df.select("*")._jdf.queryExecution().debug().codegenToSeq()
        return max(parts.apply(i)._3().maxMethodCodeSize() for i in range(parts.size()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)


def test_smoother_compiles(spark):
    """no generated method is too long for the JVM."""
    assert generated(spark, W.savgol_11_2(readings(spark), COLS)) < JIT_LIMIT


def test_residuals_are_not_dealt_out_by_station(spark):
    """the stations' deviations come to the rows, not the rows to one task a station."""
    df = readings(spark).select("location_id", "timestamp", F.col("a").alias("r"))
    text = RC.residual_outliers(df, "r", "out")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_smoother_at_the_ends(spark):
    df = readings(spark, 23).select("location_id", "timestamp", "a")
    coef = np.array([-36, 9, 44, 69, 84, 89, 84, 69, 44, 9, -36]) / 429.0
    got = W.savgol_11_2(df, ["a"], spec=S.DEFAULT.with_(chunk_rows=7)).toPandas()
    for _, own in got.groupby("location_id"):
        own = own.sort_values("timestamp")
        v = own["a"].to_numpy()
        ext = np.concatenate([v[5:0:-1], v, v[-2:-7:-1]])
        assert np.allclose(own["a_sg"], [coef @ ext[i:i + 11] for i in range(len(v))])
