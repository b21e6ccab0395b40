"""Registered join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cumulus.operators import interval_joins as IJ
from cumulus.operators import joins as J
from cumulus.operators import windows as W
from cumulus.plans.common import finish, r
from cumulus.plans.registry import query
from cumulus.plans.q_windows import KEY, WLOC, WROW, MIN
from cumulus.sources import fixtures as fx
from cumulus.sources import store as ST


@query("history_range_join", views=("sensor_raw",), section="2.3", sql=f"""
SELECT a.location_id, a.timestamp, count(b.timestamp) AS history_rows,
  {r('coalesce(sum(b.rainfall_mm), 0)')} AS history_rain,
  min(b.timestamp) AS history_first_ts, max(b.timestamp) AS history_last_ts
FROM sensor_raw a LEFT JOIN sensor_raw b
  ON a.location_id = b.location_id AND b.timestamp >= a.timestamp - INTERVAL 3 HOUR AND b.timestamp < a.timestamp
GROUP BY a.location_id, a.timestamp""")
def q_history_range_join(spark, sf):
    """Range join written as the range self-join in the oracle; on Spark a
    bounded range frame over bucketed series (3-hour window on the
    irregular readings)."""
    df = W.history_range_join(fx.sensor_raw(spark, sf), window_min=180)
    return finish(df, cols=KEY + ["history_rows", "history_rain", "history_first_ts", "history_last_ts"])


@query("asof_baseline", views=("sensor_raw",), section="2.3", sql=f"""
SELECT a.location_id, a.timestamp,
  {r('arg_min(b.pressure, b.timestamp)')} AS baseline_pressure,
  {r('arg_min(b.humidity, b.timestamp)')} AS baseline_humidity
FROM sensor_raw a LEFT JOIN sensor_raw b
  ON a.location_id = b.location_id AND b.timestamp >= a.timestamp - INTERVAL 3 HOUR AND b.timestamp < a.timestamp
GROUP BY a.location_id, a.timestamp""")
def q_asof_baseline(spark, sf):
    df = W.asof_baseline(fx.sensor_raw(spark, sf), window_min=180)
    return finish(df, cols=KEY + ["baseline_pressure", "baseline_humidity"])


@query("asof_fallback", views=("sensor_raw",), section="2.3", sql=f"""
SELECT location_id, timestamp,
  {r(f'lag(pressure) OVER ({WROW}) - first_value(pressure) OVER ({WROW} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)')} AS fallback_pressure_change,
  {r(f'lag(humidity) OVER ({WROW}) - first_value(humidity) OVER ({WROW} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)')} AS fallback_humidity_change
FROM sensor_raw""")
def q_asof_fallback(spark, sf):
    df = W.asof_fallback(fx.sensor_raw(spark, sf))
    return finish(df, cols=KEY + ["fallback_pressure_change", "fallback_humidity_change"])


@query("range_join_events", views=("sensor_raw", "tips", "pulses"), section="2.3", sql="""
SELECT a.location_id, a.timestamp, count(b.timestamp) AS tips, min(b.timestamp) AS first_tip,
  max(b.timestamp) AS last_tip
FROM sensor_raw a LEFT JOIN tips b ON a.location_id = b.location_id
  AND b.timestamp >= a.timestamp - INTERVAL 90 MINUTE AND b.timestamp <= a.timestamp + INTERVAL 10 MINUTE
GROUP BY a.location_id, a.timestamp""")
def q_range_join(spark, sf):
    """Readings with the rain-gauge tips from 90 minutes before to 10 minutes after."""
    pairs = IJ.range_join(fx.sensor_raw(spark, sf).select(*KEY), fx.events_keyed(spark, sf, "click"), ["location_id"],
                          "timestamp", "timestamp", 90 * MIN, 10 * MIN, "left", "_tip")
    return pairs.groupBy(*KEY).agg(F.count("timestamp_tip").alias("tips"), F.min("timestamp_tip").alias("first_tip"),
                                   F.max("timestamp_tip").alias("last_tip"))


@query("asof_join_events", views=("sensor_raw", "pulses"), section="2.3", sql="""
WITH j AS (SELECT a.location_id, a.timestamp, b.timestamp AS pulse_at
  FROM sensor_raw a ASOF LEFT JOIN pulses b ON a.location_id = b.location_id AND a.timestamp >= b.timestamp)
SELECT location_id, timestamp, CASE WHEN timestamp - pulse_at <= INTERVAL 3 HOUR THEN pulse_at END AS pulse_at FROM j""")
def q_asof_join(spark, sf):
    """Readings with the last wind pulse at or before them, at most three hours old."""
    out = IJ.asof_join(fx.sensor_raw(spark, sf).select(*KEY), fx.events_keyed(spark, sf, "view").withColumnRenamed(
        "timestamp", "pulse_at"), ["location_id"], "timestamp", "pulse_at", 180 * MIN)
    return out.select(*KEY, "pulse_at")


@query("location_dim", views=("sensor_grid", "location_dim"), section="2.3", sql=f"""
SELECT g.location_id, g.timestamp, {r('d.latitude')} AS latitude, {r('d.longitude')} AS longitude
FROM sensor_grid g LEFT JOIN location_dim d ON g.location_id = d.location_id""")
def q_location_dim(spark, sf):
    df = J.location_dim_join(fx.sensor_grid(spark, sf), fx.location_dim(spark, sf))
    return finish(df, cols=KEY + ["latitude", "longitude"])


@query("encode_location", views=("sensor_grid", "sensor_raw"), section="2.3", sql="""
WITH codes AS (SELECT location_id, CAST(dense_rank() OVER (ORDER BY location_id) - 1 AS INTEGER) AS location_id_enc
               FROM (SELECT DISTINCT location_id FROM sensor_grid WHERE location_id IS NOT NULL)),
s AS (SELECT location_id, timestamp FROM sensor_raw
      UNION ALL SELECT 'loc_unseen' AS location_id, timestamp FROM sensor_raw WHERE location_id = 'loc_1')
SELECT s.location_id, s.timestamp, coalesce(codes.location_id_enc, 0) AS location_id_enc
FROM s LEFT JOIN codes ON s.location_id = codes.location_id""")
def q_encode(spark, sf):
    """Codes fitted on the training readings, applied to other readings
    (plus a copy of one station under a name the dictionary lacks)."""
    codes = J.fit_location_codes(fx.sensor_grid(spark, sf))
    raw = fx.sensor_raw(spark, sf).select("location_id", "timestamp")
    unseen = raw.where(F.col("location_id") == "loc_1").withColumn("location_id", F.lit("loc_unseen"))
    df = J.encode_location(raw.unionByName(unseen), codes)
    return finish(df, cols=KEY + ["location_id_enc"])


@query("class_names", section="2.3", sql="""
SELECT vec_id, label,
  coalesce(CASE label WHEN 0 THEN 'Sunny' WHEN 1 THEN 'Cloudy' WHEN 2 THEN 'Light Rain' WHEN 3 THEN 'Heavy Rain' END,
           CAST(label AS VARCHAR)) AS class_name
FROM embeddings""")
def q_class_names(spark, sf):
    df = fx.table(spark, sf, "embeddings").select("vec_id", "label")
    return J.class_names(df, "label")


@query("anti_existing", views=("duplicates", "sensor_grid"), section="2.3", sql="""
SELECT DISTINCT d.location_id, d.timestamp FROM duplicates d
WHERE NOT EXISTS (SELECT 1 FROM sensor_grid g WHERE g.cloudburst = 1
                  AND g.location_id = d.location_id AND g.timestamp = d.timestamp)""")
def q_anti_existing(spark, sf):
    """Keys of incoming rows not yet in a store that holds the labelled
    readings."""
    existing = fx.sensor_grid(spark, sf).where(F.col("cloudburst") == 1)
    df = J.anti_existing(fx.duplicates(spark, sf), existing, KEY)
    return df.select(*KEY).distinct()
