"""Registered recursive-filter queries; oracles are recursive
CTEs or brute-force sums."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from cumulus.operators import recursive as RC
from cumulus.operators.series import DEFAULT
from cumulus.plans.common import finish, fround, r
from cumulus.plans.registry import query
from cumulus.plans.q_windows import KEY, WROW
from cumulus.sources import fixtures as fx

CAM = DEFAULT.with_(keys=("camera_id",))


@query("ema", views=("frames",), section="2.6", sql=f"""
WITH RECURSIVE b AS (
  SELECT camera_id, timestamp, brightness AS x,
         row_number() OVER (PARTITION BY camera_id ORDER BY timestamp) AS rn FROM frames),
e(camera_id, rn, timestamp, s) AS (
  SELECT camera_id, rn, timestamp, x FROM b WHERE rn = 1
  UNION ALL
  SELECT b.camera_id, b.rn, b.timestamp, 0.3 * b.x + 0.7 * e.s
  FROM e JOIN b ON b.camera_id = e.camera_id AND b.rn = e.rn + 1)
SELECT camera_id, timestamp, {r('s')} AS brightness_ema FROM e""")
def q_ema(spark, sf):
    df = RC.ema(fx.frames(spark, sf), "brightness", 0.3, spec=CAM)
    return finish(df, cols=["camera_id", "timestamp", "brightness_ema"])


def kalman_sql(src: str, col: str) -> str:
    return f"""
WITH RECURSIVE b AS (
  SELECT location_id, timestamp, {col} AS z,
         row_number() OVER (PARTITION BY location_id ORDER BY timestamp) AS rn FROM {src}),
k(location_id, rn, timestamp, z, xh, P) AS (
  SELECT location_id, rn, timestamp, z, z, CAST(1.0 AS DOUBLE) FROM b WHERE rn = 1
  UNION ALL
  SELECT b.location_id, b.rn, b.timestamp, b.z,
         k.xh + ((k.P + 0.01) / ((k.P + 0.01) + 1.0)) * (b.z - k.xh),
         (1 - (k.P + 0.01) / ((k.P + 0.01) + 1.0)) * (k.P + 0.01)
  FROM k JOIN b ON b.location_id = k.location_id AND b.rn = k.rn + 1),
o AS (SELECT location_id, timestamp, xh, CASE WHEN rn = 1 THEN 0.0 ELSE z - xh END AS resid FROM k)"""


@query("kalman_1d", views=("sensor_grid",), section="2.6", sql=kalman_sql("sensor_grid", "temperature") + f"""
SELECT location_id, timestamp, {r('xh')} AS temperature_kalman, {r('resid')} AS temperature_kalman_resid FROM o""")
def q_kalman(spark, sf):
    df = RC.kalman_1d(fx.sensor_grid(spark, sf), "temperature")
    return finish(df, cols=KEY + ["temperature_kalman", "temperature_kalman_resid"])


@query("kalman_residual_outliers", views=("sensor_grid",), section="2.5", sql=kalman_sql("sensor_grid", "temperature") + """
, s AS (SELECT *, stddev_pop(resid) OVER (PARTITION BY location_id) AS sd FROM o)
SELECT location_id, timestamp, coalesce(CASE WHEN sd > 0 THEN abs(resid) > 3 * sd END, false) AS temperature_kalman_outlier FROM s""")
def q_kalman_outliers(spark, sf):
    df = RC.kalman_1d(fx.sensor_grid(spark, sf), "temperature")
    df = RC.residual_outliers(df, "temperature_kalman_resid", "temperature_kalman_outlier")
    return finish(df, cols=KEY + ["temperature_kalman_outlier"])


@query("periodogram", views=("sensor_grid",), section="2.6", sql=f"""
WITH b AS (SELECT location_id, row_number() OVER ({WROW}) - 1 AS pos, count(*) OVER (PARTITION BY location_id) AS n,
                  pressure - avg(pressure) OVER (PARTITION BY location_id) AS x FROM sensor_grid),
ks AS (SELECT location_id, n, unnest(range(0, n // 2 + 1)) AS k FROM (SELECT DISTINCT location_id, n FROM b WHERE n >= 4)),
d AS (SELECT ks.location_id, ks.k, ks.n,
        sum(b.x * cos(2 * pi() * ks.k * b.pos / ks.n)) AS re, sum(b.x * sin(2 * pi() * ks.k * b.pos / ks.n)) AS im
      FROM ks JOIN b ON b.location_id = ks.location_id GROUP BY ks.location_id, ks.k, ks.n)
SELECT location_id, k, {r('k * (1.0 / 60.0) / n', 9)} AS frequency_hz, {r('(re * re + im * im) / n', 4)} AS power FROM d""")
def q_periodogram(spark, sf):
    df = RC.periodogram(fx.sensor_grid(spark, sf), "pressure", fs_hz=1.0 / 60.0)
    return df.select("location_id", "k", fround(F.col("frequency_hz"), 9).alias("frequency_hz"),
                     fround(F.col("power"), 4).alias("power"))
