"""Registered window queries (per-station time and row frames)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cumulus.operators import windows as W
from cumulus.plans.common import finish, r
from cumulus.plans.registry import query
from cumulus.sources import fixtures as fx

KEY = ["location_id", "timestamp"]
# DuckDB window ordered by event time in micro-seconds (range frames in us).
WLOC = "PARTITION BY location_id ORDER BY epoch_us(timestamp)"
MIN = 60_000_000


_STATION_SQL = f"""
SELECT location_id, timestamp,
  {r('coalesce(sum(coalesce(rainfall_mm, 0)) OVER (' + WLOC + f' RANGE BETWEEN {5*MIN} PRECEDING AND CURRENT ROW), 0)')} AS rain_last_5min,
  {r('coalesce(sum(coalesce(rainfall_mm, 0)) OVER (' + WLOC + f' RANGE BETWEEN {15*MIN} PRECEDING AND CURRENT ROW), 0)')} AS rain_last_15min,
  {r('coalesce(round(first_value(pressure) OVER (' + WLOC + f' RANGE BETWEEN {5*MIN} PRECEDING AND 1 PRECEDING) - pressure, 3), 0)')} AS pressure_drop_5min,
  {r('coalesce(round(first_value(pressure) OVER (' + WLOC + f' RANGE BETWEEN {15*MIN} PRECEDING AND 1 PRECEDING) - pressure, 3), 0)')} AS pressure_drop_15min,
  {r('coalesce(round(humidity - first_value(humidity) OVER (' + WLOC + f' RANGE BETWEEN {15*MIN} PRECEDING AND 1 PRECEDING), 3), 0)')} AS humidity_change
FROM sensor_grid"""


@query("history_features_station", views=("sensor_grid",), section="2.5", sql=_STATION_SQL)
def q_history_features_station(spark, sf):
    df = W.history_features_station(fx.sensor_grid(spark, sf))
    return finish(df, cols=KEY + ["rain_last_5min", "rain_last_15min", "pressure_drop_5min",
                                  "pressure_drop_15min", "humidity_change"])

from cumulus.operators import fill as FL
from cumulus.operators import quality as QC
from cumulus.functions import scalar as X

WROW = "PARTITION BY location_id ORDER BY timestamp"


def _gen(spark, sf):
    return W.generated_rolling(fx.sensor_grid(spark, sf))


_ROWS_SQL = f"""
WITH b AS (
  SELECT location_id, timestamp, rainfall_mm, pressure, humidity,
    row_number() OVER ({WROW}) - 1 AS pos, count(*) OVER (PARTITION BY location_id) AS n,
    count(rainfall_mm) OVER ({WROW} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS c5,
    sum(rainfall_mm) OVER ({WROW} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS s5,
    count(rainfall_mm) OVER ({WROW} ROWS BETWEEN 14 PRECEDING AND CURRENT ROW) AS c15,
    sum(rainfall_mm) OVER ({WROW} ROWS BETWEEN 14 PRECEDING AND CURRENT ROW) AS s15,
    lag(pressure, 15) OVER ({WROW}) AS p15, lag(humidity, 15) OVER ({WROW}) AS h15,
    count(rainfall_mm) OVER ({WROW} ROWS BETWEEN 1 FOLLOWING AND 30 FOLLOWING) AS cf,
    avg(rainfall_mm) OVER ({WROW} ROWS BETWEEN 1 FOLLOWING AND 30 FOLLOWING) AS mf
  FROM sensor_grid)
"""


@query("rain_rows_5_15", views=("sensor_grid",), section="2.5", sql=_ROWS_SQL + f"""
SELECT location_id, timestamp,
  {r('coalesce(CASE WHEN c5 = 5 THEN s5 END, 0)')} AS rain_last_5min,
  {r('coalesce(CASE WHEN c15 = 15 THEN s15 END, 0)')} AS rain_last_15min FROM b""")
def q_rain_rows(spark, sf):
    return finish(_gen(spark, sf), cols=KEY + ["rain_last_5min", "rain_last_15min"])


@query("pressure_drop_rows", views=("sensor_grid",), section="2.5", sql=_ROWS_SQL + f"""
SELECT location_id, timestamp, {r('coalesce(-(pressure - p15), 0) + 0.0')} AS pressure_drop_15min FROM b""")
def q_pressure_drop_rows(spark, sf):
    return finish(_gen(spark, sf), cols=KEY + ["pressure_drop_15min"])


@query("humidity_change_rows", views=("sensor_grid",), section="2.5", sql=_ROWS_SQL + f"""
SELECT location_id, timestamp, {r('coalesce(humidity - h15, 0)')} AS humidity_change FROM b""")
def q_humidity_change_rows(spark, sf):
    return finish(_gen(spark, sf), cols=KEY + ["humidity_change"])


@query("forecast_lead_mean", views=("sensor_grid",), section="2.5", sql=_ROWS_SQL + f"""
SELECT location_id, timestamp,
  {r('coalesce(CASE WHEN pos >= 29 AND pos < n - 30 AND cf = 30 THEN mf END, 0)')} AS forecast_30min FROM b""")
def q_forecast_lead_mean(spark, sf):
    return finish(_gen(spark, sf), cols=KEY + ["forecast_30min"])


def _rng(lo_min, closed_left, hi_excl=False):
    lo = lo_min * MIN - (0 if closed_left else 1)
    hi = "1 PRECEDING" if hi_excl else "CURRENT ROW"
    return f"RANGE BETWEEN {lo} PRECEDING AND {hi}"


@query("rain_time_5_15_30", views=("sensor_grid",), section="2.5", sql=f"""
SELECT location_id, timestamp,
  {r(f'sum(rainfall_mm) OVER ({WLOC} {_rng(5, False)})')} AS rain_5,
  {r(f'sum(rainfall_mm) OVER ({WLOC} {_rng(15, False)})')} AS rain_15,
  {r(f'sum(rainfall_mm) OVER ({WLOC} {_rng(30, False)})')} AS rain_30
FROM sensor_grid""")
def q_rain_time(spark, sf):
    return finish(W.rain_time_sums(fx.sensor_grid(spark, sf)), cols=KEY + ["rain_5", "rain_15", "rain_30"])


_STATS = ["temp_mean_15", "temp_std_15", "hum_mean_15", "hum_std_15", "pressure_std_30",
          "wind_mean_15", "wind_max_15", "wind_std_15"]


@query("temp_humidity_wind_stats", views=("sensor_grid",), section="2.5", sql=f"""
SELECT location_id, timestamp,
  {r(f'avg(temperature) OVER ({WLOC} {_rng(15, False)})')} AS temp_mean_15,
  {r(f'stddev_samp(temperature) OVER ({WLOC} {_rng(15, False)})')} AS temp_std_15,
  {r(f'avg(humidity) OVER ({WLOC} {_rng(15, False)})')} AS hum_mean_15,
  {r(f'stddev_samp(humidity) OVER ({WLOC} {_rng(15, False)})')} AS hum_std_15,
  {r(f'stddev_samp(pressure) OVER ({WLOC} {_rng(30, False)})')} AS pressure_std_30,
  {r(f'avg(wind_gust) OVER ({WLOC} {_rng(15, False)})')} AS wind_mean_15,
  {r(f'max(wind_gust) OVER ({WLOC} {_rng(15, False)})')} AS wind_max_15,
  {r(f'stddev_samp(wind_gust) OVER ({WLOC} {_rng(15, False)})')} AS wind_std_15
FROM sensor_grid""")
def q_stats(spark, sf):
    df = W.sensor_stats_15(fx.sensor_grid(spark, sf), "temperature", "humidity", "pressure", "wind_gust")
    return finish(df, cols=KEY + _STATS)


_PREDICT_SQL = f"""
WITH b AS (
  SELECT location_id, timestamp, pressure, humidity,
    row_number() OVER ({WROW}) - 1 AS pos,
    coalesce(sum(rainfall_mm) OVER ({WLOC} {_rng(5, True, True)}), 0) AS r5,
    coalesce(sum(rainfall_mm) OVER ({WLOC} {_rng(15, True, True)}), 0) AS r15,
    count(*) OVER ({WLOC} {_rng(15, True, True)}) AS n15,
    first_value(pressure) OVER ({WLOC} {_rng(15, True, True)}) AS bp,
    first_value(humidity) OVER ({WLOC} {_rng(15, True, True)}) AS bh,
    lag(pressure) OVER ({WROW}) AS lp, lag(humidity) OVER ({WROW}) AS lh,
    first_value(pressure) OVER ({WROW} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS fp,
    first_value(humidity) OVER ({WROW} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS fh
  FROM sensor_raw)
"""


@query("history_features_predict", views=("sensor_raw",), section="2.5", sql=_PREDICT_SQL + f"""
SELECT location_id, timestamp,
  {r('CASE WHEN pos > 0 THEN r5 ELSE 0 END')} AS rain_last_5min,
  {r('CASE WHEN pos > 0 THEN r15 ELSE 0 END')} AS rain_last_15min,
  {r('CASE WHEN pos = 0 THEN 0 WHEN n15 > 0 THEN pressure - bp ELSE lp - fp END')} AS pressure_drop_15min,
  {r('CASE WHEN pos = 0 THEN 0 WHEN n15 > 0 THEN humidity - bh ELSE lh - fh END')} AS humidity_change
FROM b""")
def q_history_predict(spark, sf):
    df = W.history_features_predict(fx.sensor_raw(spark, sf))
    return finish(df, cols=KEY + ["rain_last_5min", "rain_last_15min", "pressure_drop_15min",
                                  "humidity_change"])


@query("lag3_changes", views=("sensor_grid",), section="2.5", sql=f"""
SELECT location_id, timestamp,
  {r(f'lag(pressure, 3) OVER ({WROW})')} AS pressure_prev_15,
  {r(f'lag(pressure, 3) OVER ({WROW}) - pressure')} AS pressure_drop_15,
  {r(f'lag(humidity, 3) OVER ({WROW})')} AS humidity_prev_15,
  {r(f'humidity - lag(humidity, 3) OVER ({WROW})')} AS humidity_change_15
FROM sensor_grid""")
def q_lag3(spark, sf):
    df = W.lag_changes(fx.sensor_grid(spark, sf), "pressure", "humidity", 3)
    return finish(df, cols=KEY + ["pressure_prev_15", "pressure_drop_15", "humidity_prev_15",
                                  "humidity_change_15"])


@query("median_mean_smooth", views=("sensor_dirty",), section="2.5", sql=f"""
WITH m AS (
  SELECT location_id, timestamp,
    quantile_cont(rainfall_mm, 0.5) OVER ({WROW} ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS mr,
    quantile_cont(pressure, 0.5) OVER ({WROW} ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS mp,
    quantile_cont(humidity, 0.5) OVER ({WROW} ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS mh
  FROM sensor_dirty)
SELECT location_id, timestamp,
  {r(f'avg(mr) OVER ({WROW} ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)')} AS rainfall_mm_smooth,
  {r(f'avg(mp) OVER ({WROW} ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)')} AS pressure_smooth,
  {r(f'avg(mh) OVER ({WROW} ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)')} AS humidity_smooth
FROM m""")
def q_median_mean(spark, sf):
    df = W.median_mean_smooth(fx.sensor_dirty(spark, sf), ["rainfall_mm", "pressure", "humidity"])
    return finish(df, cols=KEY + ["rainfall_mm_smooth", "pressure_smooth", "humidity_smooth"])


def interp_sql(src: str, col: str, k: int) -> str:
    """Oracle: limited linear interpolation by position, written with
    IGNORE NULLS look-ups."""
    return f"""
WITH b AS (SELECT location_id, timestamp, {col} AS x, row_number() OVER ({WROW}) - 1 AS pos FROM {src}),
c AS (SELECT *,
  last_value(CASE WHEN x IS NOT NULL THEN pos END IGNORE NULLS) OVER (PARTITION BY location_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p0,
  last_value(x IGNORE NULLS) OVER (PARTITION BY location_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS v0,
  first_value(CASE WHEN x IS NOT NULL THEN pos END IGNORE NULLS) OVER (PARTITION BY location_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS p1,
  first_value(x IGNORE NULLS) OVER (PARTITION BY location_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS v1
  FROM b)
SELECT location_id, timestamp, {r(f'''CASE WHEN x IS NOT NULL THEN x
  WHEN p0 IS NOT NULL AND p1 IS NOT NULL AND (pos - p0 <= {k} OR p1 - pos <= {k}) THEN v0 + (v1 - v0) / CAST(p1 - p0 AS DOUBLE) * CAST(pos - p0 AS DOUBLE)
  WHEN p0 IS NULL AND p1 IS NOT NULL AND p1 - pos <= {k} THEN v1
  WHEN p1 IS NULL AND p0 IS NOT NULL AND pos - p0 <= {k} THEN v0 END''')} AS {col}
FROM c"""


@query("interpolate_limit", views=("sensor_dirty",), section="2.5", sql=interp_sql("sensor_dirty", "pressure", 3))
def q_interpolate(spark, sf):
    df = FL.interpolate_limit(fx.sensor_dirty(spark, sf), ["pressure"], 3)
    return finish(df, cols=KEY + ["pressure"])


@query("ffill_bfill", views=("sensor_dirty",), section="2.5", sql=f"""
SELECT location_id, timestamp, {r(f'''coalesce(pressure,
   last_value(pressure IGNORE NULLS) OVER ({WROW} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
   first_value(pressure IGNORE NULLS) OVER ({WROW} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))''')} AS pressure
FROM sensor_dirty""")
def q_ffill_bfill(spark, sf):
    return finish(FL.ffill_bfill(fx.sensor_dirty(spark, sf), ["pressure"]), cols=KEY + ["pressure"])


def range_sql(src: str) -> str:
    """Oracle CTE body: range-checked raw_station columns and flags."""
    return f"""SELECT location_id, timestamp,
   CASE WHEN temp_C BETWEEN -40 AND 60 THEN temp_C END AS temp_C,
   CASE WHEN humidity BETWEEN 0 AND 100 THEN humidity END AS humidity,
   CASE WHEN pressure BETWEEN 800 AND 1100 THEN pressure END AS pressure,
   CASE WHEN rain_mm < 0 THEN 0.0 ELSE rain_mm END AS rain_mm,
   CASE WHEN wind_speed BETWEEN 0 AND 60 THEN wind_speed END AS wind_speed,
   NOT coalesce(temp_C BETWEEN -40 AND 60, false) AS temp_err,
   NOT coalesce(humidity BETWEEN 0 AND 100, false) AS hum_err,
   NOT coalesce(pressure BETWEEN 800 AND 1100, false) AS press_err,
   coalesce(rain_mm < 0, false) AS rain_err,
   NOT coalesce(wind_speed BETWEEN 0 AND 60, false) AS wind_err,
   satellite_precip, cloudburst
 FROM {src}"""


_SPIKE = {"temp_C": 5.0, "pressure": 3.0, "humidity": 20.0, "wind_speed": 15.0}


def spike_sql(prev: str) -> str:
    flags = ",\n   ".join(f"coalesce(abs({c} - lag({c}) OVER ({WROW})) > {v}, false) AS {c}_spike"
                          for c, v in _SPIKE.items())
    return f"SELECT *, {flags} FROM {prev}"


def spike_clean_sql(prev: str) -> str:
    vals = ", ".join(f"CASE WHEN {c}_spike THEN NULL ELSE {c} END AS {c}" for c in _SPIKE)
    return f"SELECT * REPLACE ({vals}) FROM {prev}"


@query("range_check", views=("raw_station",), section="2.2", sql=f"""
WITH a AS ({range_sql('raw_station')})
SELECT location_id, timestamp, {r('temp_C')} AS temp_C, {r('humidity')} AS humidity,
  {r('pressure')} AS pressure, {r('rain_mm')} AS rain_mm, {r('wind_speed')} AS wind_speed,
  temp_err, hum_err, press_err, rain_err, wind_err FROM a""")
def q_range_check(spark, sf):
    df = QC.range_check(fx.raw_station(spark, sf))
    return finish(df, cols=KEY + ["temp_C", "humidity", "pressure", "rain_mm", "wind_speed",
                                  "temp_err", "hum_err", "press_err", "rain_err", "wind_err"])


@query("spike_check", views=("raw_station",), section="2.5", sql=f"""
WITH a AS ({range_sql('raw_station')}), s AS ({spike_sql('a')}), c AS ({spike_clean_sql('s')})
SELECT location_id, timestamp, {r('temp_C')} AS temp_C, {r('humidity')} AS humidity,
  {r('pressure')} AS pressure, {r('wind_speed')} AS wind_speed,
  temp_C_spike, humidity_spike, pressure_spike, wind_speed_spike FROM c""")
def q_spike(spark, sf):
    df = W.spike_flags(QC.range_check(fx.raw_station(spark, sf)), QC.SPIKE_LIMITS)
    return finish(df, cols=KEY + ["temp_C", "humidity", "pressure", "wind_speed", "temp_C_spike",
                                  "humidity_spike", "pressure_spike", "wind_speed_spike"])


def stuck_sql(prev: str, cols: list[str], n: int = 20) -> str:
    """Oracle: the reference's run rule by gaps-and-islands group counts."""
    same = ", ".join(f"coalesce({c} - lag({c}) OVER ({WROW}), 0) = 0 AS {c}_same" for c in cols)
    grp = ", ".join(f"sum(CASE WHEN {c}_same THEN 0 ELSE 1 END) OVER ({WROW} ROWS UNBOUNDED PRECEDING) AS {c}_grp"
                    for c in cols)
    cnt = ", ".join(f"sum(CASE WHEN {c}_same THEN 1 ELSE 0 END) OVER (PARTITION BY location_id, {c}_grp) + 1 AS {c}_cnt"
                    for c in cols)
    return (f"s1 AS (SELECT *, {same} FROM {prev}), s2 AS (SELECT *, {grp} FROM s1), "
            f"s3 AS (SELECT *, {cnt} FROM s2), s4 AS (SELECT * REPLACE ("
            + ", ".join(f"CASE WHEN {c}_cnt >= {n} AND {c}_same THEN NULL ELSE {c} END AS {c}" for c in cols)
            + "), " + ", ".join(f"{c}_cnt >= {n} AND {c}_same AS {c}_stuck" for c in cols) + " FROM s3)")


@query("stuck_sensor", views=("sensor_dirty",), section="2.5", sql=f"""
WITH {stuck_sql('sensor_dirty', ['temperature'])}
SELECT location_id, timestamp, {r('temperature')} AS temperature, temperature_stuck FROM s4""")
def q_stuck(spark, sf):
    df = W.stuck_flags(fx.sensor_dirty(spark, sf), ["temperature"], 20)
    return finish(df, cols=KEY + ["temperature", "temperature_stuck"])


_EF_COLS = ["temp_C", "humidity", "pressure", "rain_mm", "wind_speed",
            "temp_err", "hum_err", "press_err", "rain_err", "wind_err", "any_error"]


def error_filters_sql(src: str) -> str:
    cols4 = ["temp_C", "humidity", "pressure", "wind_speed"]
    return f"""WITH a AS ({range_sql(src)}), s AS ({spike_sql('a')}), c AS ({spike_clean_sql('s')}),
{stuck_sql('c', cols4)},
e AS (SELECT location_id, timestamp, temp_C, humidity, pressure, rain_mm, wind_speed, satellite_precip, cloudburst,
  temp_err OR temp_C_spike OR temp_C_stuck AS temp_err,
  hum_err OR humidity_spike OR humidity_stuck AS hum_err,
  press_err OR pressure_spike OR pressure_stuck AS press_err,
  rain_err,
  wind_err OR wind_speed_spike OR wind_speed_stuck AS wind_err
  FROM s4),
f AS (SELECT *, temp_err OR hum_err OR press_err OR rain_err OR wind_err AS any_error FROM e)"""


@query("error_filters", views=("raw_station",), section="2.5", sql=error_filters_sql("raw_station") + f"""
SELECT location_id, timestamp, {r('temp_C')} AS temp_C, {r('humidity')} AS humidity,
  {r('pressure')} AS pressure, {r('rain_mm')} AS rain_mm, {r('wind_speed')} AS wind_speed,
  temp_err, hum_err, press_err, rain_err, wind_err, any_error FROM f""")
def q_error_filters(spark, sf):
    return finish(QC.error_filters(fx.raw_station(spark, sf)), cols=KEY + _EF_COLS)


_SG = [-36, 9, 44, 69, 84, 89, 84, 69, 44, 9, -36]


def savgol_sql(src: str, col: str, out: str) -> str:
    vals = ", ".join(f"({j}, {w})" for j, w in zip(range(-5, 6), _SG))
    return f"""
WITH b AS (SELECT location_id, timestamp, {col} AS x, row_number() OVER ({WROW}) - 1 AS pos,
                  count(*) OVER (PARTITION BY location_id) AS n FROM {src}),
c(j, w) AS (VALUES {vals}),
i AS (SELECT b.location_id, b.timestamp, b.n, b.x, c.w,
        CASE WHEN b.pos + c.j < 0 THEN -(b.pos + c.j)
             WHEN b.pos + c.j > b.n - 1 THEN 2 * (b.n - 1) - (b.pos + c.j)
             ELSE b.pos + c.j END AS q
      FROM b, c)
SELECT i.location_id, i.timestamp,
  {r('CASE WHEN min(i.n) < 11 THEN min(i.x) ELSE sum(i.w * b2.x) / 429.0 END')} AS {out}
FROM i JOIN b b2 ON b2.location_id = i.location_id AND b2.pos = i.q
GROUP BY i.location_id, i.timestamp"""


@query("savgol_11_2", views=("sensor_grid",), section="2.5", sql=savgol_sql("sensor_grid", "temperature", "temperature_sg"))
def q_savgol(spark, sf):
    df = W.savgol_11_2(fx.sensor_grid(spark, sf), ["temperature"])
    return finish(df, cols=KEY + ["temperature_sg"])


@query("ar_lags", views=("sensor_grid",), section="2.5", sql=f"""
WITH b AS (SELECT location_id, timestamp, temperature,
  lag(temperature, 1) OVER ({WROW}) AS lag_1, lag(temperature, 2) OVER ({WROW}) AS lag_2,
  lag(temperature, 3) OVER ({WROW}) AS lag_3 FROM sensor_grid)
SELECT location_id, timestamp, {r('lag_3')} AS lag_3, {r('lag_2')} AS lag_2, {r('lag_1')} AS lag_1,
  {r('temperature')} AS target FROM b
WHERE lag_1 IS NOT NULL AND lag_2 IS NOT NULL AND lag_3 IS NOT NULL AND temperature IS NOT NULL""")
def q_ar_lags(spark, sf):
    df = W.ar_lags(fx.sensor_grid(spark, sf), "temperature", 3).withColumnRenamed("temperature", "target")
    return finish(df, cols=KEY + ["lag_3", "lag_2", "lag_1", "target"])


@query("decimate", views=("sensor_grid",), section="2.5", sql=f"""
WITH b AS (SELECT location_id, timestamp, temperature, row_number() OVER ({WROW}) - 1 AS pos,
  count(*) OVER (PARTITION BY location_id) AS n FROM sensor_grid)
SELECT location_id, timestamp, {r('temperature')} AS temperature FROM b WHERE pos % 3 = 0 OR pos = n - 1""")
def q_decimate(spark, sf):
    return finish(W.decimate(fx.sensor_grid(spark, sf), 3), cols=KEY + ["temperature"])


@query("minmax_scale", views=("sensor_grid",), section="2.5", sql=f"""
WITH b AS (SELECT location_id, timestamp, temperature,
  min(temperature) OVER (PARTITION BY location_id) AS mn, max(temperature) OVER (PARTITION BY location_id) AS mx
  FROM sensor_grid),
c AS (SELECT *, CASE WHEN mx - mn = 0 THEN 1.0 ELSE mx - mn END AS rg FROM b)
SELECT location_id, timestamp, {r('mn')} AS series_min, {r('mx')} AS series_max,
  {r('mn - rg * 0.2')} AS scale_low, {r('mx + rg * 0.2')} AS scale_high,
  {r('(temperature - (mn - rg * 0.2)) / ((mx + rg * 0.2) - (mn - rg * 0.2))')} AS scaled FROM c""")
def q_minmax(spark, sf):
    df = W.minmax_scale(fx.sensor_grid(spark, sf), "temperature")
    return finish(df, cols=KEY + ["series_min", "series_max", "scale_low", "scale_high", "scaled"])
