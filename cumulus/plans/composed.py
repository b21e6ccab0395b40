"""Composed transforms: chains of operators whose order matters (model
input assembly, the two analysis pipelines, batch scoring)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumulus.functions import scalar as X
from cumulus.operators import joins as J
from cumulus.operators import windows as W
from cumulus.operators.series import DEFAULT, SeriesSpec

# Fixed model feature order (the serving model's input columns).
FEATURES = ["location_id_enc", "rainfall_mm", "humidity", "pressure", "temperature", "wind_gust",
            "satellite_precip", "radar_dbz", "rain_last_5min", "rain_last_15min",
            "pressure_drop_15min", "humidity_change", "forecast_30min"]
BASE_SENSORS = ["rainfall_mm", "humidity", "pressure", "temperature", "wind_gust"]
ROLLING = ["rain_last_5min", "rain_last_15min", "pressure_drop_15min", "humidity_change"]


def rolling_fallback(df: DataFrame, spec: SeriesSpec = DEFAULT) -> DataFrame:
    """Supplied rolling columns win where not NULL; the rest come from the
    serving history features ([t-w, t) windows).  Missing columns count as
    all-NULL."""
    x = df
    for c in ROLLING:
        given = F.col(c) if c in df.columns else F.lit(None).cast("double")
        x = x.withColumn(f"_g_{c}", given)
        if c in x.columns:
            x = x.drop(c)
    x = W.history_features_predict(x, spec=spec)
    for c in ROLLING:
        x = x.withColumn(c, F.coalesce(F.col(f"_g_{c}"), F.col(c))).drop(f"_g_{c}")
    return x


def model_input(df: DataFrame, codes: DataFrame, spec: SeriesSpec = DEFAULT) -> DataFrame:
    """Serving feature rows for every reading at once: defaults for missing
    base sensors, satellite / radar fallbacks, rolling features (given or
    from history), naive forecast, location code (unseen -> 0); keys plus
    the 13 model columns in order."""
    x = rolling_fallback(df, spec)
    for c in BASE_SENSORS:
        x = x.withColumn(c, F.coalesce(F.col(c), F.lit(0.0)) if c in x.columns else F.lit(0.0))
    sat = F.col("satellite_precip") if "satellite_precip" in x.columns else F.lit(None).cast("double")
    rad = F.col("radar_dbz") if "radar_dbz" in x.columns else F.lit(None).cast("double")
    fc = F.col("forecast_30min") if "forecast_30min" in x.columns else F.lit(None).cast("double")
    x = (x.withColumn("satellite_precip", X.satellite_fallback(sat, "rainfall_mm"))
          .withColumn("radar_dbz", X.radar_fallback(rad, "rainfall_mm"))
          .withColumn("forecast_30min", X.naive_forecast(fc, "rain_last_15min")))
    x = J.encode_location(x, codes, spec.keys[0])
    return x.select(*spec.keys, spec.ts, *FEATURES)


# ---------------------------------------------------------------- analysis pipelines

from cumulus.operators import fill as FL  # noqa: E402
from cumulus.operators import quality as QC  # noqa: E402
from cumulus.operators import recursive as RC  # noqa: E402
from cumulus.operators import stats as ST  # noqa: E402

RAIN_COLS_A = ["rainfall_mm", "rain_last_5min", "rain_last_15min"]
SMOOTH_COLS_A = ["rainfall_mm", "pressure", "humidity"]
SENSORS_B = ["temp_C", "humidity", "pressure", "rain_mm", "wind_speed"]


def pipeline_a_features(df: DataFrame, label: str = "cloudburst", spec: SeriesSpec = DEFAULT) -> DataFrame:
    """Pipeline A, in order: interpolate (3 per side) + forward/backward
    fill of numeric columns; rain columns NULL -> 0; global z-score
    outliers (rain only on label 0) -> NULL; interpolate + fill again;
    3-row median then 5-row mean smoothing; rain over (t-5 min, t] and
    (t-15 min, t] on the smoothed rain; 3-reading pressure drop (previous -
    current) and humidity change (current - previous) on the smoothed
    series; rows with any NULL dropped.  Absent sensor columns are skipped."""
    from cumulus.operators.series import materialize
    num = FL.numeric_columns(df, exclude=(label,))
    x = materialize(FL.interpolate_fill(df, num, 3, spec))
    x = FL.default_zero(x, [c for c in RAIN_COLS_A if c in x.columns])
    zc = [c for c in SMOOTH_COLS_A if c in x.columns]
    x = ST.zscore_outliers(x, zc, label if label in x.columns else None, "rainfall_mm")
    x = materialize(FL.interpolate_fill(x, num, 3, spec))
    x = W.median_mean_smooth(x, zc, spec=spec)
    rain = "rainfall_mm_smooth" if "rainfall_mm_smooth" in x.columns else "rainfall_mm"
    press = "pressure_smooth" if "pressure_smooth" in x.columns else "pressure"
    hum = "humidity_smooth" if "humidity_smooth" in x.columns else "humidity"
    x = W.rain_time_sums(x, col=rain, windows=(5, 15), spec=spec)
    x = W.lag_changes(x, press, hum, 3, spec=spec)
    from cumulus.operators.series import drop_helpers
    return drop_helpers(x).na.drop()


def fill_sensors(df: DataFrame, label: str = "cloudburst", spec: SeriesSpec = DEFAULT) -> DataFrame:
    """Numeric columns without gaps: interpolated (4 per side), then filled.  The scans
    read their input twice, so it is stored first."""
    from cumulus.operators.series import materialize
    df = materialize(df)
    return materialize(FL.interpolate_fill(df, FL.numeric_columns(df, exclude=(label,)), 4, spec))


def smooth_sensors(filled: DataFrame, sensors: list[str], spec: SeriesSpec = DEFAULT) -> DataFrame:
    """Per sensor: Butterworth low/high-pass where the station's rate allows, Savitzky-Golay
    (11, 2) of the low-passed series, Kalman filter of that, residual and residual
    outliers (3 population std)."""
    from cumulus.operators.filters import butter_stage
    from cumulus.operators.series import materialize
    x, lp = butter_stage(filled, sensors, spec)
    x = W.savgol_11_2(x, [lp[c] for c in sensors], suffix="_sgtmp", spec=spec)
    for c in sensors:
        x = x.withColumnRenamed(f"{lp[c]}_sgtmp", f"{c}_sg")
    x = RC.kalman_1d(x, [f"{c}_sg" for c in sensors], out=[f"{c}_kalman" for c in sensors], spec=spec)
    x = RC.residual_outliers(x, [f"{c}_kalman_resid" for c in sensors],
                             [f"{c}_kalman_outlier" for c in sensors], spec=spec)
    return materialize(x)


def sensor_spectra(filled: DataFrame, sensors: list[str], spec: SeriesSpec = DEFAULT) -> DataFrame:
    """Noise spectra of the filled sensors (before the low-pass) at each station's rate:
    keys, sensor, k, frequency_hz, power.  A station without a positive median gap
    counts as 1 Hz."""
    from cumulus.operators.counters import sampling_interval
    gap = F.col("sampling_interval_s")
    rates = sampling_interval(filled.select(*spec.keys, spec.ts), spec).select(
        *spec.keys, F.when(gap > 0, 1.0 / gap).otherwise(1.0).alias("fs_hz"))
    return RC.spectra(filled, sensors, rates, spec)


def clean_and_smooth(df: DataFrame, label: str = "cloudburst", spec: SeriesSpec = DEFAULT,
                     sensors: list[str] | None = None) -> DataFrame:
    """Pipeline-B cleaning without its spectra: `fill_sensors`, then `smooth_sensors`."""
    sensors = [c for c in (sensors or SENSORS_B) if c in df.columns]
    return smooth_sensors(fill_sensors(df, label, spec), sensors, spec)


def clean_and_smooth_with_spectra(df: DataFrame, label: str = "cloudburst", spec: SeriesSpec = DEFAULT,
                                  sensors: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Pipeline-B cleaning with all its stages: the smoothed readings, and the sensors'
    spectra; both from one filled table."""
    sensors = [c for c in (sensors or SENSORS_B) if c in df.columns]
    filled = fill_sensors(df, label, spec)
    return smooth_sensors(filled, sensors, spec), sensor_spectra(filled, sensors, spec)


def add_features_b(df: DataFrame, spec: SeriesSpec = DEFAULT) -> DataFrame:
    """Pipeline-B features on the Kalman columns (raw ones when absent):
    rain over 5 / 15 / 30 min, 15-min mean / std / max, 30-min pressure std,
    3-reading differences, dew point and depression from the un-smoothed
    temperature and humidity; rows with any NULL dropped."""
    def pick(c):
        return f"{c}_kalman" if f"{c}_kalman" in df.columns else (c if c in df.columns else None)
    rain, temp, hum, press, wind = (pick(c) for c in SENSORS_B[3:4] + SENSORS_B[0:3] + SENSORS_B[4:5])
    x = df
    if rain:
        x = W.rain_time_sums(x, col=rain, windows=(5, 15, 30), spec=spec)
    x = W.sensor_stats_15(x, temp, hum, press, wind, spec=spec)
    diffs = {}
    if temp:
        diffs["temp_change_15"] = temp
    if hum:
        diffs["hum_change_15"] = hum
    if press:
        diffs["pressure_drop_15"] = press
    if wind:
        diffs["wind_change_15"] = wind
    x = W.diff_rows(x, diffs, 3, spec=spec)
    if "temp_C" in x.columns and "humidity" in x.columns:
        dp, dep = X.dew_point("temp_C", "humidity")
        x = x.withColumn("dew_point", dp).withColumn("dewpoint_depression", dep)
    from cumulus.operators.series import drop_helpers
    return drop_helpers(x).na.drop()


def pipeline_b_features(raw: DataFrame, label: str = "cloudburst", spec: SeriesSpec = DEFAULT) -> DataFrame:
    """Pipeline B: error filters -> clean and smooth -> features."""
    x = clean_and_smooth(QC.error_filters(raw, spec=spec), label, spec)
    return add_features_b(x, spec)
