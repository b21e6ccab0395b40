"""Registered composed transforms, sorts / limits / set
operations (2.7) and scalar operators (2.8)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from cumulus.functions import scalar as X
from cumulus.operators import joins as J
from cumulus.operators import sky as SK
from cumulus.operators import stats as ST
from cumulus.plans import composed as C
from cumulus.plans import oracle_chains as O
from cumulus.plans.common import finish, fround, r
from cumulus.plans.q_windows import KEY, WLOC, WROW, MIN, error_filters_sql
from cumulus.plans.registry import query
from cumulus.sources import fixtures as fx

NUM_A = ["rainfall_mm", "humidity", "pressure", "temperature", "wind_gust", "satellite_precip", "radar_dbz"]
OUT_A = ["location_id", "timestamp", "rainfall_mm", "humidity", "pressure", "temperature", "wind_gust",
         "satellite_precip", "radar_dbz", "cloudburst", "rainfall_mm_is_outlier", "pressure_is_outlier",
         "humidity_is_outlier", "rainfall_mm_smooth", "pressure_smooth", "humidity_smooth", "rain_5", "rain_15",
         "pressure_prev_15", "pressure_drop_15", "humidity_prev_15", "humidity_change_15"]


def _select_rounded(cols, src, where_not_null=True):
    sel = ", ".join(c if c in ("location_id", "timestamp", "cloudburst") or c.endswith(("_is_outlier", "_outlier", "any_error"))
                    else f"{r(c)} AS {c}" for c in cols)
    return f"SELECT {sel} FROM {src}" + (" WHERE COLUMNS(*) IS NOT NULL" if where_not_null else "")


_A_SQL = "WITH " + ",\n".join([
    O.positions("a0", "sensor_dirty"),
    O.interpolate("a1", "a0", NUM_A, 3), O.ffill("a2", "a1", NUM_A), O.bfill("a3", "a2", NUM_A),
    "a4 AS (SELECT * REPLACE (coalesce(rainfall_mm, 0) AS rainfall_mm) FROM a3)",
    O.zscore("a5", "a4", ["rainfall_mm", "pressure", "humidity"], "cloudburst"),
    O.interpolate("a6", "a5", NUM_A, 3), O.ffill("a7", "a6", NUM_A), O.bfill("a8", "a7", NUM_A),
    O.median_mean("a9", "a8", ["rainfall_mm", "pressure", "humidity"]),
    O.time_sums("a10", "a9", "rainfall_mm_smooth", [5, 15]),
    """a11 AS (SELECT *, lag(pressure_smooth, 3) OVER (PARTITION BY location_id ORDER BY _pos) AS pressure_prev_15,
       lag(pressure_smooth, 3) OVER (PARTITION BY location_id ORDER BY _pos) - pressure_smooth AS pressure_drop_15,
       lag(humidity_smooth, 3) OVER (PARTITION BY location_id ORDER BY _pos) AS humidity_prev_15,
       humidity_smooth - lag(humidity_smooth, 3) OVER (PARTITION BY location_id ORDER BY _pos) AS humidity_change_15
     FROM a10)""",
    "a12 AS (SELECT * FROM a11 WHERE COLUMNS(*) IS NOT NULL)",
]) + "\n" + _select_rounded(OUT_A, "a12", False)


@query("pipeline_a_features", views=("sensor_dirty",), section="2.7b", sql=_A_SQL)
def q_pipeline_a(spark, sf):
    return finish(C.pipeline_a_features(fx.sensor_dirty(spark, sf)), cols=OUT_A)


SENS_B = ["temp_C", "humidity", "pressure", "rain_mm", "wind_speed"]
NUM_B = SENS_B + ["satellite_precip"]
_CLEAN_OUT = ["location_id", "timestamp"] + [f"{c}_{s}" for c in SENS_B for s in ("sg", "kalman", "kalman_resid")] \
    + [f"{c}_kalman_outlier" for c in SENS_B]


def _b_chain(with_features: bool) -> str:
    parts = [
        O.positions("b0", "f"),
        O.interpolate("b1", "b0", NUM_B, 4), O.ffill("b2", "b1", NUM_B), O.bfill("b3", "b2", NUM_B),
        O.savgol("b4", "b3", SENS_B),
        O.kalman("b5", "b4", [f"{c}_sg" for c in SENS_B]),
        O.resid_outliers("b6", "b5", SENS_B),
    ]
    if with_features:
        w15 = f"({WLOC} RANGE BETWEEN {15 * MIN - 1} PRECEDING AND CURRENT ROW)"
        w30 = f"({WLOC} RANGE BETWEEN {30 * MIN - 1} PRECEDING AND CURRENT ROW)"
        lag = "PARTITION BY location_id ORDER BY _pos"
        parts.append(f"""b7 AS (SELECT *,
  sum(rain_mm_kalman) OVER ({WLOC} RANGE BETWEEN {5 * MIN - 1} PRECEDING AND CURRENT ROW) AS rain_5,
  sum(rain_mm_kalman) OVER {w15} AS rain_15, sum(rain_mm_kalman) OVER {w30} AS rain_30,
  avg(temp_C_kalman) OVER {w15} AS temp_mean_15, stddev_samp(temp_C_kalman) OVER {w15} AS temp_std_15,
  avg(humidity_kalman) OVER {w15} AS hum_mean_15, stddev_samp(humidity_kalman) OVER {w15} AS hum_std_15,
  stddev_samp(pressure_kalman) OVER {w30} AS pressure_std_30,
  avg(wind_speed_kalman) OVER {w15} AS wind_mean_15, max(wind_speed_kalman) OVER {w15} AS wind_max_15,
  stddev_samp(wind_speed_kalman) OVER {w15} AS wind_std_15,
  temp_C_kalman - lag(temp_C_kalman, 3) OVER ({lag}) AS temp_change_15,
  humidity_kalman - lag(humidity_kalman, 3) OVER ({lag}) AS hum_change_15,
  pressure_kalman - lag(pressure_kalman, 3) OVER ({lag}) AS pressure_drop_15,
  wind_speed_kalman - lag(wind_speed_kalman, 3) OVER ({lag}) AS wind_change_15,
  237.7 * (17.27 * temp_C / (237.7 + temp_C) + ln(greatest(humidity, 1.0) / 100.0))
    / (17.27 - (17.27 * temp_C / (237.7 + temp_C) + ln(greatest(humidity, 1.0) / 100.0))) AS dew_point
 FROM b6)""")
        parts.append("b8 AS (SELECT *, temp_C - dew_point AS dewpoint_depression FROM b7 WHERE COLUMNS(*) IS NOT NULL)")
    return ",\n".join(parts)


_EF = error_filters_sql("raw_station")
FEAT_B = ["rain_5", "rain_15", "rain_30", "pressure_drop_15", "pressure_std_30", "hum_change_15", "hum_mean_15",
          "hum_std_15", "temp_change_15", "temp_std_15", "temp_mean_15", "wind_mean_15", "wind_max_15",
          "wind_std_15", "wind_change_15", "dew_point", "dewpoint_depression", "satellite_precip"]
OUT_B = ["location_id", "timestamp", "cloudburst", "any_error"] + FEAT_B + [f"{c}_kalman_outlier" for c in SENS_B]


@query("clean_and_smooth", views=("raw_station",), section="2.6",
       sql="WITH RECURSIVE " + (_EF + ",\n" + _b_chain(False))[5:] + "\n" + _select_rounded(_CLEAN_OUT, "b6", False))
def q_clean_and_smooth(spark, sf):
    from cumulus.operators import quality as QC
    df = C.clean_and_smooth(QC.error_filters(fx.raw_station(spark, sf)))
    return finish(df, cols=_CLEAN_OUT)


@query("pipeline_b_features", views=("raw_station",), section="2.7b",
       sql="WITH RECURSIVE " + (_EF + ",\n" + _b_chain(True))[5:] + "\n" + _select_rounded(OUT_B, "b8", False))
def q_pipeline_b(spark, sf):
    return finish(C.pipeline_b_features(fx.raw_station(spark, sf)), cols=OUT_B)


def _spectra_sql() -> str:
    """Sums of the discrete Fourier transform over the filled readings."""
    long = "\nUNION ALL ".join(
        f"SELECT location_id, _pos, _n, '{c}' AS sensor, {c} - avg({c}) OVER (PARTITION BY location_id) AS x FROM b3"
        for c in SENS_B)
    fill = ",\n".join([O.positions("b0", "f"), O.interpolate("b1", "b0", NUM_B, 4), O.ffill("b2", "b1", NUM_B),
                       O.bfill("b3", "b2", NUM_B)])
    return "WITH RECURSIVE " + (_EF + ",\n" + fill)[5:] + f""",
gaps AS (SELECT location_id, (epoch_us(timestamp) - lag(epoch_us(timestamp)) OVER (
           PARTITION BY location_id ORDER BY _pos)) / 1e6 AS dt FROM b3),
rates AS (SELECT location_id, CASE WHEN median(dt) > 0 THEN 1.0 / median(dt) ELSE 1.0 END AS fs FROM gaps GROUP BY 1),
v AS ({long}),
ks AS (SELECT location_id, _n AS n, unnest(range(0, _n // 2 + 1)) AS k
       FROM (SELECT DISTINCT location_id, _n FROM b3 WHERE _n >= 4)),
d AS (SELECT v.location_id, v.sensor, ks.k, ks.n, sum(v.x * cos(2 * pi() * ((ks.k * v._pos) % ks.n) / ks.n)) AS re,
             sum(v.x * sin(2 * pi() * ((ks.k * v._pos) % ks.n) / ks.n)) AS im
      FROM ks JOIN v ON v.location_id = ks.location_id GROUP BY 1, 2, 3, 4)
SELECT d.location_id, sensor, k, {r('k * fs / n', 9)} AS frequency_hz, {r('(re * re + im * im) / n', 4)} AS power
FROM d JOIN rates ON rates.location_id = d.location_id"""


@query("clean_and_smooth_spectra", views=("raw_station",), section="2.6", sql=_spectra_sql())
def q_clean_and_smooth_spectra(spark, sf):
    """Last stage of pipeline B's cleaning: spectra of the five filled sensors."""
    from cumulus.operators import quality as QC
    filled = C.fill_sensors(QC.error_filters(fx.raw_station(spark, sf)))
    return C.sensor_spectra(filled, SENS_B).select(
        "location_id", "sensor", "k", fround(F.col("frequency_hz"), 9).alias("frequency_hz"),
        fround(F.col("power"), 4).alias("power"))


_LP = ["temp_C", "pressure"]


def _butter_sql() -> str:
    """Forward and backward recursion over the mirrored series of the stations whose
    rate fits; coefficients of the fixture's only such rate."""
    from cumulus.operators.filters import HIGHPASS_HZ, LOWPASS_HZ, ORDER, butter_space
    pad = 3 * (ORDER + 1)
    fs = 1.0 / fx.FAST_GAP_S
    banks = {"lp": butter_space(ORDER, LOWPASS_HZ / (0.5 * fs), "low"),
             "hp": butter_space(ORDER, HIGHPASS_HZ / (0.5 * fs), "high")}
    names = [(c, kind) for c in _LP for kind in banks]

    def num(v) -> str:
        return f"CAST({float(v)!r} AS DOUBLE)"

    def recursion(name: str, src: str, value) -> str:
        """CTE of states before, and outputs at, each sample of src (e = 0, 1, ...)."""
        first, step, out, cols = [], [], [], []
        for c, kind in names:
            M, B, Cc, D, zi = banks[kind]
            v = value(c, kind)
            z = [f"z{j}_{c}_{kind}" for j in range(ORDER)]
            cols += z
            first += [f"{num(zi[j])} * x.{v} AS {z[j]}" for j in range(ORDER)]
            step += [" + ".join(f"{num(M[j][i])} * p.{z[i]}" for i in range(ORDER)) + f" + {num(B[j])} * q.{v}" for j in range(ORDER)]
            out.append(" + ".join(f"{num(Cc[j])} * s.{z[j]}" for j in range(ORDER)) + f" + {num(D)} * x.{v} AS {c}_{kind}")
        return f"""{name}_s(location_id, e, {', '.join(cols)}) AS (
  SELECT x.location_id, x.e, {', '.join(first)} FROM {src} x WHERE x.e = 0
  UNION ALL
  SELECT x.location_id, x.e, {', '.join(step)}
  FROM {name}_s p JOIN {src} x ON x.location_id = p.location_id AND x.e = p.e + 1
       JOIN {src} q ON q.location_id = p.location_id AND q.e = p.e),
{name} AS (SELECT x.location_id, x.e, x.n, {', '.join(out)} FROM {src} x JOIN {name}_s s
  ON s.location_id = x.location_id AND s.e = x.e)"""

    vals = ", ".join(_LP)
    mirror = {"x0": f"{pad} - i", "xn": f"{pad} + 2 * (n - 1) - i"}
    ends = ", ".join(f"arg_min({c}, i) AS x0_{c}, arg_max({c}, i) AS xn_{c}" for c in _LP)
    turned = {at: ", ".join(f"2 * {at}_{c} - {c} AS {c}" for c in _LP) for at in mirror}
    outs = ", ".join(f"CASE WHEN g.fast THEN f.{c}_lp ELSE m.{c} END AS {c}_lp, f.{c}_hp AS {c}_hp" for c in _LP)
    rounded = ", ".join(f"{r(f'{c}_{k}')} AS {c}_{k}" for c, k in names)
    return f"""WITH RECURSIVE m AS (SELECT location_id, timestamp, {vals}, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY location_id) AS n,
        (epoch_us(timestamp) - lag(epoch_us(timestamp)) OVER w) / 1e6 AS dt
      FROM mixed_rate WINDOW w AS (PARTITION BY location_id ORDER BY timestamp)),
g AS (SELECT location_id, 0.5 / median(dt) > {LOWPASS_HZ} AS fast, {ends} FROM m GROUP BY location_id),
a AS (SELECT m.*, g.* EXCLUDE (location_id) FROM m JOIN g ON g.location_id = m.location_id WHERE fast AND n > {pad}),
ext AS (SELECT location_id, n, i + {pad} AS e, {vals} FROM a
  UNION ALL SELECT location_id, n, {mirror['x0']}, {turned['x0']} FROM a WHERE i BETWEEN 1 AND {pad}
  UNION ALL SELECT location_id, n, {mirror['xn']}, {turned['xn']} FROM a WHERE i BETWEEN n - 1 - {pad} AND n - 2),
{recursion('fw', 'ext', lambda c, kind: c)},
rev AS (SELECT location_id, n, n + {2 * pad} - 1 - e AS e, {', '.join(f'{c}_{k}' for c, k in names)} FROM fw),
{recursion('bw', 'rev', lambda c, kind: f'{c}_{kind}')},
f AS (SELECT location_id, n + {pad} - 1 - e AS i, {', '.join(f'{c}_{k}' for c, k in names)} FROM bw),
o AS (SELECT m.location_id, m.timestamp, {outs}
      FROM m JOIN g ON g.location_id = m.location_id
           LEFT JOIN f ON f.location_id = m.location_id AND f.i = m.i)
SELECT location_id, timestamp, {rounded} FROM o"""


@query("butter_zero_phase", views=("mixed_rate",), section="2.6", sql=_butter_sql())
def q_butter(spark, sf):
    """Low- and high-pass where a station's rate fits: three stations with a reading
    every ten seconds are filtered, those with one a minute go unchanged."""
    from cumulus.operators.filters import butter_stage
    df = fx.mixed_rate(spark, sf).select("location_id", "timestamp", *_LP)
    out, lp = butter_stage(df, _LP)
    return finish(out.select("location_id", "timestamp", *[F.col(lp[c]).alias(f"{c}_lp") for c in _LP],
                             *[f"{c}_hp" for c in _LP]))


def _model_input_sql(src: str, train: str) -> str:
    from cumulus.plans.q_windows import _PREDICT_SQL
    b = _PREDICT_SQL.replace("FROM sensor_raw)", f"FROM {src})").replace(
        "SELECT location_id, timestamp, pressure, humidity,",
        "SELECT location_id, timestamp, pressure, humidity, rainfall_mm, temperature, wind_gust, satellite_precip, radar_dbz,")
    return b + f""",
c AS (SELECT *, CASE WHEN pos > 0 THEN r5 ELSE 0 END AS rl5, CASE WHEN pos > 0 THEN r15 ELSE 0 END AS rl15,
    CASE WHEN pos = 0 THEN 0 WHEN n15 > 0 THEN pressure - bp ELSE lp - fp END AS pd15,
    CASE WHEN pos = 0 THEN 0 WHEN n15 > 0 THEN humidity - bh ELSE lh - fh END AS hc FROM b),
codes AS (SELECT location_id, dense_rank() OVER (ORDER BY location_id) - 1 AS enc
          FROM (SELECT DISTINCT location_id FROM {train} WHERE location_id IS NOT NULL))
SELECT c.location_id, c.timestamp, CAST(coalesce(codes.enc, 0) AS INTEGER) AS location_id_enc,
  {r('coalesce(rainfall_mm, 0)')} AS rainfall_mm, {r('coalesce(humidity, 0)')} AS humidity,
  {r('coalesce(pressure, 0)')} AS pressure, {r('coalesce(temperature, 0)')} AS temperature,
  {r('coalesce(wind_gust, 0)')} AS wind_gust,
  {r('coalesce(satellite_precip, least(1.0, coalesce(rainfall_mm, 0) / 20.0))')} AS satellite_precip,
  {r('coalesce(radar_dbz, 10 * log10(greatest(coalesce(rainfall_mm, 0), 0.01) + 1))')} AS radar_dbz,
  {r('rl5')} AS rain_last_5min, {r('rl15')} AS rain_last_15min, {r('pd15')} AS pressure_drop_15min,
  {r('hc')} AS humidity_change, {r('least(100.0, rl15 / 15.0 * 30.0)')} AS forecast_30min
FROM c LEFT JOIN codes ON c.location_id = codes.location_id"""


@query("model_input", views=("sensor_grid",), section="2.7b", sql=_model_input_sql("sensor_grid", "sensor_grid"))
def q_model_input(spark, sf):
    """Serving features for every reading: defaults, fallbacks, history
    features, naive forecast, location code; keys + 13 columns."""
    g = fx.sensor_grid(spark, sf)
    codes = J.fit_location_codes(g)
    return finish(C.model_input(g, codes))


@query("feature_projection", views=("sensor_grid",), section="2.2", sql=f"""
WITH codes AS (SELECT location_id, dense_rank() OVER (ORDER BY location_id) - 1 AS enc
               FROM (SELECT DISTINCT location_id FROM sensor_grid)),
{O.positions('g0', 'sensor_grid')},
g1 AS (SELECT *,
  CASE WHEN count(rainfall_mm) OVER w5 = 5 THEN sum(rainfall_mm) OVER w5 END AS r5,
  CASE WHEN count(rainfall_mm) OVER w15 = 15 THEN sum(rainfall_mm) OVER w15 END AS r15,
  lag(pressure, 15) OVER w AS p15, lag(humidity, 15) OVER w AS h15,
  CASE WHEN _pos >= 29 AND _pos < _n - 30 AND count(rainfall_mm) OVER wf = 30 THEN avg(rainfall_mm) OVER wf END AS fc
  FROM g0 WINDOW w AS ({WROW}), w5 AS ({WROW} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
    w15 AS ({WROW} ROWS BETWEEN 14 PRECEDING AND CURRENT ROW), wf AS ({WROW} ROWS BETWEEN 1 FOLLOWING AND 30 FOLLOWING))
SELECT CAST(coalesce(codes.enc, 0) AS INTEGER) AS location_id_enc, {r('coalesce(rainfall_mm, 0)')} AS rainfall_mm,
  {r('coalesce(humidity, 0)')} AS humidity, {r('coalesce(pressure, 0)')} AS pressure,
  {r('coalesce(temperature, 0)')} AS temperature, {r('coalesce(wind_gust, 0)')} AS wind_gust,
  {r('coalesce(satellite_precip, 0)')} AS satellite_precip, {r('coalesce(radar_dbz, 0)')} AS radar_dbz,
  {r('coalesce(r5, 0)')} AS rain_last_5min, {r('coalesce(r15, 0)')} AS rain_last_15min,
  {r('coalesce(-(pressure - p15), 0) + 0.0')} AS pressure_drop_15min, {r('coalesce(humidity - h15, 0)')} AS humidity_change,
  {r('coalesce(fc, 0)')} AS forecast_30min
FROM g1 LEFT JOIN codes ON g1.location_id = codes.location_id""")
def q_feature_projection(spark, sf):
    """Training matrix: generated rolling columns, location code, exactly the
    13 model columns in order, missing values 0."""
    from cumulus.operators.ml import training_matrix
    return finish(training_matrix(fx.sensor_grid(spark, sf)).select(*C.FEATURES))


# ------------------------------------------------------------------ 2.7


@query("sorted_series", views=("sensor_grid",), section="2.7", sql=f"""
SELECT location_id, timestamp, {r('rainfall_mm')} AS rainfall_mm FROM sensor_grid ORDER BY location_id, timestamp""")
def q_sorted(spark, sf):
    """Total order by (station, time): range-partitioned sort."""
    return finish(fx.sensor_grid(spark, sf).select(*KEY, "rainfall_mm").orderBy(*KEY))


@query("precision_at_k", views=("scored",), section="2.7", sql=f"""
WITH top AS (SELECT label, probability FROM scored WHERE probability IS NOT NULL
             ORDER BY probability DESC, location_id, timestamp LIMIT 100)
SELECT {r('avg(CAST(label AS DOUBLE))')} AS precision_at_k,
  {r('CASE WHEN count(*) >= 100 THEN min(probability) END')} AS kth_score, count(*) AS k_used FROM top""")
def q_precision_at_k(spark, sf):
    return finish(ST.precision_at_k(fx.scored(spark, sf), k=100, tiebreak=KEY))


@query("head", views=("sensor_grid",), section="2.7", sql=f"""
SELECT location_id, timestamp, {r('rainfall_mm')} AS rainfall_mm FROM sensor_grid
ORDER BY location_id, timestamp LIMIT 5""")
def q_head(spark, sf):
    """First rows of the sorted table (top-k, the limit is the feature)."""
    return finish(fx.sensor_grid(spark, sf).select(*KEY, "rainfall_mm").orderBy(*KEY).limit(5))


@query("series_dump", views=("duplicates",), section="2.7", sql=f"""
SELECT location_id, timestamp, {r('rainfall_mm')} AS rainfall_mm, arrival, seq FROM duplicates""")
def q_series_dump(spark, sf):
    """Every stored row (no order guarantee beyond what the caller sorts)."""
    return finish(fx.duplicates(spark, sf).select(*KEY, "rainfall_mm", "arrival", "seq"))


_EDGE = """SELECT temperature AS Temp, humidity AS Humidity, pressure AS Pressure,
  CASE WHEN rainfall_mm < 5 THEN 0 WHEN rainfall_mm < 15 THEN 1 WHEN rainfall_mm < 30 THEN 2 ELSE 3 END AS Weather_Label
  FROM sensor_grid"""


@query("union_augmented", views=("sensor_grid",), section="2.7", sql=f"""
WITH e AS ({_EDGE})
SELECT {r('Temp')} AS Temp, {r('Humidity')} AS Humidity, {r('Pressure')} AS Pressure, Weather_Label FROM (
  SELECT * FROM e UNION ALL SELECT Temp + 0.5, Humidity - 1.0, Pressure + 0.25, Weather_Label FROM e)""")
def q_union_augmented(spark, sf):
    """Originals and a given table of augmented rows (here: shifted ones)."""
    from cumulus.operators.ml import EDGE_FEATURES, edge_training, union_augmented
    base = edge_training(spark, sf).select(*EDGE_FEATURES, "Weather_Label")
    given = base.select((F.col("Temp") + 0.5).alias("Temp"), (F.col("Humidity") - 1.0).alias("Humidity"),
                        (F.col("Pressure") + 0.25).alias("Pressure"), "Weather_Label")
    return finish(union_augmented(base, given))


# ------------------------------------------------------------------ 2.8


@query("dew_point", views=("sensor_grid",), section="2.8", sql=f"""
WITH a AS (SELECT location_id, timestamp, temperature AS T,
   17.27 * temperature / (237.7 + temperature) + ln(greatest(humidity, 1.0) / 100.0) AS al FROM sensor_grid)
SELECT location_id, timestamp, {r('237.7 * al / (17.27 - al)')} AS dew_point,
  {r('T - 237.7 * al / (17.27 - al)')} AS dewpoint_depression FROM a""")
def q_dew_point(spark, sf):
    dp, dep = X.dew_point("temperature", "humidity")
    df = fx.sensor_grid(spark, sf).select(*KEY, dp.alias("dew_point"), dep.alias("dewpoint_depression"))
    return finish(df)


def _compass_sql(a: str) -> str:
    m = f"(({a} + 360.0) - 360.0 * floor(({a} + 360.0) / 360.0))"
    i = f"CAST(floor(((({m}) + 22.5) - 360.0 * floor((({m}) + 22.5) / 360.0)) / 45.0) AS INTEGER)"
    return (f"CASE {i} WHEN 0 THEN 'E' WHEN 1 THEN 'NE' WHEN 2 THEN 'N' WHEN 3 THEN 'NW' WHEN 4 THEN 'W' "
            f"WHEN 5 THEN 'SW' WHEN 6 THEN 'S' WHEN 7 THEN 'SE' END")


@query("compass8", section="2.8", sql=f"""
SELECT l_orderkey, l_linenumber, {_compass_sql('(l_extendedprice - 360.0 * floor(l_extendedprice / 360.0) - 180.0)')} AS direction
FROM lineitem""")
def q_compass(spark, sf):
    """Compass direction of an angle in (-180, 180], here one per line item."""
    li = fx.table(spark, sf, "lineitem")
    ang = F.col("l_extendedprice") - F.lit(360.0) * F.floor(F.col("l_extendedprice") / 360.0) - F.lit(180.0)
    return li.select("l_orderkey", "l_linenumber", X.compass8(ang).alias("direction"))


@query("clear_sky_anomaly", views=("sensor_raw",), section="2.8", sql=f"""
WITH a AS (SELECT location_id, timestamp, humidity * 2.5 AS brightness,
   hour(timestamp) + minute(timestamp) / 60.0 AS h FROM sensor_raw),
b AS (SELECT *, CASE WHEN h < 6 OR h > 18 THEN 0.0 ELSE greatest(0.0, 255.0 * sin((h - 6.0) / 12.0 * pi())) END AS e FROM a)
SELECT location_id, timestamp, {r('h')} AS hour_local, {r('e')} AS brightness_expected_clear,
  {r('brightness - e')} AS brightness_anomaly FROM b""")
def q_clear_sky(spark, sf):
    df = fx.sensor_raw(spark, sf).withColumn("brightness", F.col("humidity") * 2.5)
    df = SK.clear_sky_anomaly(df)
    return finish(df, cols=KEY + ["hour_local", "brightness_expected_clear", "brightness_anomaly"])


@query("thickness_class", views=("frames",), section="2.8", sql="""
SELECT camera_id, timestamp,
  CASE WHEN brightness / 255.0 > 0.7 AND dark_fraction < 0.15 THEN 'THIN'
       WHEN brightness / 255.0 > 0.4 AND brightness / 255.0 <= 0.7 AND dark_fraction < 0.40 THEN 'MEDIUM'
       ELSE 'THICK_CONVECTIVE' END AS thickness_class FROM frames""")
def q_thickness(spark, sf):
    df = fx.frames(spark, sf)
    return df.select("camera_id", "timestamp", X.thickness_class("brightness", "dark_fraction").alias("thickness_class"))


@query("meters_per_pixel", section="2.8", sql=f"""
SELECT p_partkey, {r('2 * (p_size * 100.0) * tan(radians(90.0) / 2.0) / 640.0')} AS m_per_px FROM part""")
def q_mpp(spark, sf):
    """Ground size of a pixel for a cloud base height per row (here
    100 m per part size unit), 640 px, 90 degree field of view."""
    df = fx.table(spark, sf, "part")
    return finish(df.select("p_partkey", X.meters_per_pixel(640, 90.0, F.col("p_size") * 100.0).alias("m_per_px")))


# ------------------------------------------------------------------ sky series (2.5)

from cumulus.operators import windows as WN  # noqa: E402
from cumulus.operators.series import DEFAULT as _DEF  # noqa: E402

CAM = _DEF.with_(keys=("camera_id",))
_WC = "PARTITION BY camera_id ORDER BY timestamp"


@query("vertical_growth", views=("frames",), section="2.5", sql=f"""
WITH b AS (SELECT *, lag(timestamp) OVER ({_WC}) AS pt, lag(brightness) OVER ({_WC}) AS pb,
              lag(cloud_fraction) OVER ({_WC}) AS pc, lag(texture_index) OVER ({_WC}) AS ptx FROM frames),
c AS (SELECT *, CASE WHEN (epoch_us(timestamp) - epoch_us(pt)) / 60000000.0 <= 0 THEN 0.001
                     ELSE (epoch_us(timestamp) - epoch_us(pt)) / 60000000.0 END AS dt FROM b),
d AS (SELECT *, (pb - brightness) / dt AS dr, (cloud_fraction - pc) / dt AS cg, (texture_index - ptx) / dt AS tg,
        CASE WHEN brightness / 255.0 > 0.7 AND dark_fraction < 0.15 THEN 'THIN'
             WHEN brightness / 255.0 > 0.4 AND brightness / 255.0 <= 0.7 AND dark_fraction < 0.40 THEN 'MEDIUM'
             ELSE 'THICK_CONVECTIVE' END AS th FROM c)
SELECT camera_id, timestamp, {r('dr')} AS darkening_rate, {r('cg')} AS cloud_area_growth_rate,
  {r('tg')} AS texture_growth_rate,
  CAST(coalesce(dr > 8 AND brightness < 170 AND cg > 0.08 AND cloud_fraction > 0.60 AND tg > 1.5
                AND texture_index > 6 AND th = 'THICK_CONVECTIVE', false) AS INTEGER) AS vertical_growth_flag
FROM d""")
def q_vertical_growth(spark, sf):
    df = SK.vertical_growth(fx.frames(spark, sf), CAM)
    return finish(df, cols=["camera_id", "timestamp", "darkening_rate", "cloud_area_growth_rate",
                            "texture_growth_rate", "vertical_growth_flag"])


_TREND = ["brightness", "cloud_fraction", "dark_fraction", "texture_index"]
_WT = f"(PARTITION BY camera_id ORDER BY epoch_us(timestamp) RANGE BETWEEN {20 * MIN} PRECEDING AND CURRENT ROW)"


@query("trend20", views=("frames",), section="2.5", sql=f"""
WITH b AS (SELECT *, (epoch_us(timestamp) - first_value(epoch_us(timestamp)) OVER {_WT}) / 60000000.0 AS dt,
  {", ".join(f"first_value({c}) OVER {_WT} AS o_{c}" for c in _TREND)} FROM frames)
SELECT camera_id, timestamp,
  {", ".join(f"{r(f'CASE WHEN dt > 0 THEN ({c} - o_{c}) / dt END')} AS trend20_{c}_slope" for c in _TREND)}
FROM b""")
def q_trend20(spark, sf):
    df = WN.trend20(fx.frames(spark, sf), _TREND, 20, spec=CAM)
    return finish(df, cols=["camera_id", "timestamp"] + [f"trend20_{c}_slope" for c in _TREND])
