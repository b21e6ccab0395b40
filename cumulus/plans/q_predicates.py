"""Registered projection / predicate queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cumulus.functions import scalar as X
from cumulus.operators import fill as FL
from cumulus.operators import quality as QC
from cumulus.operators import windows as W
from cumulus.plans.common import finish, r
from cumulus.plans.registry import query
from cumulus.plans.q_windows import KEY, WLOC, WROW, MIN
from cumulus.sources import fixtures as fx

# Alert threshold tuned on the reference's training run (best-F1 grid point).
BEST_F1_THRESHOLD = 0.31532663316582915


@query("numeric_columns", views=("sensor_grid",), section="2.2", sql=f"""
SELECT {r('rainfall_mm')} AS rainfall_mm, {r('humidity')} AS humidity, {r('pressure')} AS pressure,
  {r('temperature')} AS temperature, {r('wind_gust')} AS wind_gust,
  {r('satellite_precip')} AS satellite_precip, {r('radar_dbz')} AS radar_dbz FROM sensor_grid""")
def q_numeric(spark, sf):
    df = fx.sensor_grid(spark, sf)
    return finish(df.select(*FL.numeric_columns(df)))


@query("sanitize_reading", views=("sensor_dirty",), section="2.2", sql=f"""
SELECT location_id, timestamp,
  {r('CASE WHEN temperature BETWEEN -40 AND 85 THEN temperature END')} AS temperature,
  {r('CASE WHEN humidity BETWEEN 0 AND 100 THEN humidity END')} AS humidity,
  {r('CASE WHEN pressure BETWEEN 800 AND 1100 THEN pressure END')} AS pressure,
  {r('coalesce(CASE WHEN humidity BETWEEN 0 AND 100 THEN humidity END, 0)')} AS humidity_out,
  {r('coalesce(CASE WHEN pressure BETWEEN 800 AND 1100 THEN pressure END, 0)')} AS pressure_out
FROM sensor_dirty""")
def q_sanitize(spark, sf):
    s = QC.sanitize_reading(fx.sensor_dirty(spark, sf))
    s = (s.withColumn("humidity_out", F.coalesce("humidity", F.lit(0.0)))
          .withColumn("pressure_out", F.coalesce("pressure", F.lit(0.0))))
    return finish(s, cols=KEY + ["temperature", "humidity", "pressure", "humidity_out", "pressure_out"])


@query("default_zero", views=("sensor_dirty",), section="2.2", sql=f"""
SELECT location_id, timestamp, {r('coalesce(rainfall_mm, 0)')} AS rainfall_mm,
  {r('coalesce(humidity, 0)')} AS humidity, {r('coalesce(pressure, 0)')} AS pressure,
  {r('coalesce(temperature, 0)')} AS temperature, {r('coalesce(wind_gust, 0)')} AS wind_gust
FROM sensor_dirty""")
def q_default_zero(spark, sf):
    cols = ["rainfall_mm", "humidity", "pressure", "temperature", "wind_gust"]
    return finish(FL.default_zero(fx.sensor_dirty(spark, sf), cols), cols=KEY + cols)


@query("radar_fallback", views=("sensor_grid",), section="2.2", sql=f"""
SELECT location_id, timestamp,
  {r('coalesce(radar_dbz, 10 * log10(greatest(rainfall_mm, 0.01) + 1))')} AS radar_dbz FROM sensor_grid""")
def q_radar(spark, sf):
    df = fx.sensor_grid(spark, sf).withColumn("radar_dbz", X.radar_fallback("radar_dbz", "rainfall_mm"))
    return finish(df, cols=KEY + ["radar_dbz"])


@query("satellite_fallback", views=("sensor_grid",), section="2.2", sql=f"""
SELECT location_id, timestamp,
  {r('coalesce(satellite_precip, least(1.0, rainfall_mm / 20.0))')} AS satellite_precip FROM sensor_grid""")
def q_satellite(spark, sf):
    df = fx.sensor_grid(spark, sf).withColumn("satellite_precip",
                                              X.satellite_fallback("satellite_precip", "rainfall_mm"))
    return finish(df, cols=KEY + ["satellite_precip"])


def _predict_sql(src: str) -> str:
    from cumulus.plans.q_windows import _PREDICT_SQL
    return _PREDICT_SQL.replace("FROM sensor_raw)", f"FROM {src})").replace(
        "SELECT location_id, timestamp, pressure, humidity,",
        "SELECT location_id, timestamp, pressure, humidity, rainfall_mm,")


_COMPUTED = f"""
c AS (SELECT location_id, timestamp, rainfall_mm,
  CASE WHEN pos > 0 THEN r5 ELSE 0 END AS rain_last_5min,
  CASE WHEN pos > 0 THEN r15 ELSE 0 END AS rain_last_15min,
  CASE WHEN pos = 0 THEN 0 WHEN n15 > 0 THEN pressure - bp ELSE lp - fp END AS pressure_drop_15min,
  CASE WHEN pos = 0 THEN 0 WHEN n15 > 0 THEN humidity - bh ELSE lh - fh END AS humidity_change
 FROM b)"""


@query("naive_forecast", views=("sensor_grid",), section="2.2", sql=_predict_sql("sensor_grid") + "," + _COMPUTED + f"""
SELECT location_id, timestamp, {r('least(100.0, rain_last_15min / 15.0 * 30.0)')} AS forecast_30min FROM c""")
def q_naive_forecast(spark, sf):
    df = W.history_features_predict(fx.sensor_grid(spark, sf))
    df = df.withColumn("forecast_30min", X.naive_forecast(F.lit(None).cast("double"), "rain_last_15min"))
    return finish(df, cols=KEY + ["forecast_30min"])


@query("rolling_fallback", views=("sensor_dirty",), section="2.2",
       sql=_predict_sql("sensor_dirty") + "," + _COMPUTED + f""",
g AS (SELECT location_id, timestamp,
    CASE WHEN count(rainfall_mm) OVER ({WROW} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) = 5
         THEN sum(rainfall_mm) OVER ({WROW} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) END AS g5,
    CASE WHEN count(rainfall_mm) OVER ({WROW} ROWS BETWEEN 14 PRECEDING AND CURRENT ROW) = 15
         THEN sum(rainfall_mm) OVER ({WROW} ROWS BETWEEN 14 PRECEDING AND CURRENT ROW) END AS g15,
    -(pressure - lag(pressure, 15) OVER ({WROW})) AS gp,
    humidity - lag(humidity, 15) OVER ({WROW}) AS gh
  FROM sensor_dirty)
SELECT c.location_id, c.timestamp,
  {r('coalesce(g.g5, c.rain_last_5min)')} AS rain_last_5min,
  {r('coalesce(g.g15, c.rain_last_15min)')} AS rain_last_15min,
  {r('coalesce(g.gp, c.pressure_drop_15min) + 0.0')} AS pressure_drop_15min,
  {r('coalesce(g.gh, c.humidity_change)')} AS humidity_change
FROM c JOIN g ON c.location_id = g.location_id AND c.timestamp = g.timestamp""")
def q_rolling_fallback(spark, sf):
    """Given rolling columns (row-based, NULL where incomplete) win; the
    history-computed ones fill the rest."""
    from cumulus.plans.composed import rolling_fallback
    given = W.generated_rolling(fx.sensor_dirty(spark, sf), fill=False)
    df = rolling_fallback(given)
    return finish(df, cols=KEY + ["rain_last_5min", "rain_last_15min", "pressure_drop_15min",
                                  "humidity_change"])


@query("risk_level", views=("scored",), section="2.2", sql="""
SELECT location_id, timestamp, probability,
  CASE WHEN probability < 0.10 THEN 'LOW' WHEN probability < 0.30 THEN 'MODERATE'
       WHEN probability < 0.60 THEN 'HIGH' ELSE 'CRITICAL' END AS risk_level FROM scored""")
def q_risk(spark, sf):
    df = fx.scored(spark, sf).withColumn("risk_level", X.risk_level("probability"))
    return finish(df, cols=KEY + ["probability", "risk_level"])


@query("alert_flag", views=("scored",), section="2.2", sql=f"""
SELECT location_id, timestamp, CAST(probability >= {BEST_F1_THRESHOLD} AS INTEGER) AS alert,
  {r(str(BEST_F1_THRESHOLD))} AS used_threshold FROM scored""")
def q_alert(spark, sf):
    df = (fx.scored(spark, sf).withColumn("alert", X.alert_flag("probability", BEST_F1_THRESHOLD))
          .withColumn("used_threshold", F.lit(BEST_F1_THRESHOLD)))
    return finish(df, cols=KEY + ["alert", "used_threshold"])


@query("reflectivity_zr", views=("sensor_grid",), section="2.2", sql=f"""
SELECT location_id, timestamp,
  {r('CASE WHEN coalesce(satellite_precip, 0) > 0 THEN round(10 * log10(200 * pow(satellite_precip, 1.6)), 2) ELSE 0.0 END')} AS radar_dbz_zr
FROM sensor_grid""")
def q_zr(spark, sf):
    df = fx.sensor_grid(spark, sf).withColumn(
        "radar_dbz_zr", X.reflectivity_zr(F.coalesce("satellite_precip", F.lit(0.0))))
    return finish(df, cols=KEY + ["radar_dbz_zr"])


@query("cloudburst_rule", views=("sensor_grid",), section="2.2", sql=f"""
WITH z AS (SELECT location_id, timestamp, value_mm,
    CASE WHEN value_mm > 0 THEN round(10 * log10(200 * pow(value_mm, 1.6)), 2) ELSE 0.0 END AS dbz,
    coalesce(round(first_value(pressure) OVER ({WLOC} RANGE BETWEEN {15*MIN} PRECEDING AND 1 PRECEDING) - pressure, 3), 0) AS pdrop
  FROM (SELECT *, rainfall_mm * 2 AS value_mm FROM sensor_grid))
SELECT location_id, timestamp,
  CAST(coalesce(value_mm > 70 AND dbz > 45, false) AS INTEGER) AS cloudburst_rule,
  CAST(coalesce(value_mm > 70 AND dbz > 45 AND pdrop > 2, false) AS INTEGER) AS cloudburst_rule_strict
FROM z""")
def q_rule(spark, sf):
    # rain in mm per interval: two readings' worth, so both sides of 70 mm occur
    df = fx.sensor_grid(spark, sf).withColumn("value_mm", F.col("rainfall_mm") * 2)
    df = W.history_features_station(df)
    df = (df.withColumn("dbz", X.reflectivity_zr("value_mm"))
            .withColumn("cloudburst_rule", X.cloudburst_rule("value_mm", "dbz"))
            .withColumn("cloudburst_rule_strict", X.cloudburst_rule("value_mm", "dbz", "pressure_drop_15min")))
    return finish(df, cols=KEY + ["cloudburst_rule", "cloudburst_rule_strict"])


@query("drop_incomplete", views=("sensor_dirty",), section="2.2", sql=f"""
SELECT location_id, timestamp, {r('rainfall_mm')} AS rainfall_mm, {r('humidity')} AS humidity,
  {r('pressure')} AS pressure, {r('temperature')} AS temperature, {r('wind_gust')} AS wind_gust,
  {r('satellite_precip')} AS satellite_precip, {r('radar_dbz')} AS radar_dbz, cloudburst
FROM sensor_dirty WHERE location_id IS NOT NULL AND timestamp IS NOT NULL AND rainfall_mm IS NOT NULL
  AND humidity IS NOT NULL AND pressure IS NOT NULL AND temperature IS NOT NULL AND wind_gust IS NOT NULL
  AND satellite_precip IS NOT NULL AND radar_dbz IS NOT NULL AND cloudburst IS NOT NULL""")
def q_drop_incomplete(spark, sf):
    return finish(fx.sensor_dirty(spark, sf).na.drop())


@query("positives", views=("sensor_grid",), section="2.2", sql=f"""
SELECT location_id, timestamp, {r('rainfall_mm')} AS rainfall_mm, cloudburst FROM sensor_grid WHERE cloudburst = 1""")
def q_positives(spark, sf):
    df = fx.sensor_grid(spark, sf).where(F.col("cloudburst") == 1)
    return finish(df, cols=KEY + ["rainfall_mm", "cloudburst"])


@query("row_by_index", views=("sensor_grid",), section="2.2", sql=f"""
WITH s AS (SELECT location_id, timestamp, rainfall_mm,
   row_number() OVER (ORDER BY location_id, timestamp) - 1 AS i, count(*) OVER () AS n FROM sensor_grid)
SELECT location_id, timestamp, {r('rainfall_mm')} AS rainfall_mm, i AS row_index FROM s
WHERE i IN (0, 1234, n - 1)""")
def q_row_by_index(spark, sf):
    from cumulus.operators.rows import row_by_index
    df = fx.sensor_grid(spark, sf)
    picks = [row_by_index(df, k) for k in (0, 1234, None)]
    out = picks[0].unionByName(picks[1]).unionByName(picks[2]).dropDuplicates(["row_index"])
    return finish(out, cols=KEY + ["rainfall_mm", "row_index"])


@query("required_fields", section="2.2", sql="""
SELECT c_custkey, c_name, c_mktsegment FROM customer
WHERE c_name IS NOT NULL AND c_name <> '' AND c_mktsegment IS NOT NULL AND c_mktsegment <> ''""")
def q_required(spark, sf):
    from cumulus.sources.store import required_fields
    df = fx.table(spark, sf, "customer")
    return required_fields(df, ["c_name", "c_mktsegment"]).select("c_custkey", "c_name", "c_mktsegment")


@query("aqi_band", section="2.2", sql=f"""
WITH a AS (SELECT event_id, CAST(floor(value) AS INTEGER) AS aqi, CAST(floor(value) AS DOUBLE) AS v FROM events)
SELECT event_id, aqi, CASE WHEN aqi <= 50 THEN 'Good' WHEN aqi <= 100 THEN 'Moderate' ELSE 'Unhealthy' END AS aqi_category,
  round(v * 0.4, 1) AS pm25, round(v * 0.6, 1) AS pm10, round(v * 0.1, 1) AS so2,
  round(v * 0.2, 1) AS no2, {r('least(aqi / 300.0 * 100, 100)')} AS bar_pct,
  CASE WHEN aqi // 50 > 5 THEN 'High' ELSE 'Moderate' END AS uv_label
FROM a""")
def q_aqi(spark, sf):
    """Integer index per event (the dashboard's AQI is whole); bands,
    pollutant shares to one decimal, bar width and a UV label from the
    index's fiftieths."""
    ev = fx.table(spark, sf, "events").select("event_id", F.floor("value").cast("int").alias("aqi"))
    v = F.col("aqi").cast("double")
    df = ev.select("event_id", "aqi", X.aqi_category("aqi").alias("aqi_category"),
                   F.round(v * 0.4, 1).alias("pm25"), F.round(v * 0.6, 1).alias("pm10"),
                   F.round(v * 0.1, 1).alias("so2"), F.round(v * 0.2, 1).alias("no2"),
                   F.least(v / 300.0 * 100, F.lit(100.0)).alias("bar_pct"),
                   X.uv_label(F.floor(F.col("aqi") / 50)).alias("uv_label"))
    return finish(df)


@query("hour_features", views=("sensor_raw",), section="2.2", sql=f"""
SELECT location_id, timestamp,
  CAST(CASE WHEN hour(timestamp) = 0 THEN 12 WHEN hour(timestamp) > 12 THEN hour(timestamp) - 12 ELSE hour(timestamp) END AS VARCHAR)
    || CASE WHEN hour(timestamp) >= 12 THEN ' PM' ELSE ' AM' END AS hour_label,
  hour(timestamp) > 6 AND hour(timestamp) < 18 AS is_day,
  {r('least(100.0, greatest(0.0, humidity))')} AS humidity_clamped
FROM sensor_raw""")
def q_hour(spark, sf):
    df = fx.sensor_raw(spark, sf)
    df = df.select("location_id", "timestamp", X.hour12_label("timestamp").alias("hour_label"),
                   X.is_day("timestamp").alias("is_day"),
                   X.clamp("humidity", 0.0, 100.0).alias("humidity_clamped"))
    return finish(df)
