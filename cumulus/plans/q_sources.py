"""Registered source / sink queries."""

from __future__ import annotations


from pyspark.sql import functions as F

from cumulus.functions import scalar as X
from cumulus.operators import quality as QC
from cumulus.operators import windows as W
from cumulus.plans.common import finish, r
from cumulus.plans.q_predicates import BEST_F1_THRESHOLD
from cumulus.plans.q_windows import _STATION_SQL, KEY, error_filters_sql
from cumulus.plans.registry import query
from cumulus.session import scratch_dir
from cumulus.sources import fixtures as fx
from cumulus.sources import readers as RD
from cumulus.sources import sinks as SK
from cumulus.sources import store as ST

_G = ["location_id", "timestamp", "rainfall_mm", "humidity", "pressure", "temperature", "wind_gust",
      "satellite_precip", "radar_dbz", "cloudburst"]


def _scratch(spark, name):
    return scratch_dir(spark, f"stores/{name}")


@query("scan_readings", views=("sensor_grid",), section="2.1", sql="SELECT " + ", ".join(
    c if c in ("location_id", "timestamp", "cloudburst") else f"{r(c)} AS {c}" for c in _G) + " FROM sensor_grid")
def q_scan(spark, sf):
    """Readings written as CSV with a header, read back with the fixed
    schema (no inference), ordered by station then time."""
    from pyspark.sql import types as T
    path = _scratch(spark, "readings_csv")
    schema = T.StructType([f for f in RD.READING.fields if f.name in _G])
    fx.sensor_grid(spark, sf).select(*schema.fieldNames()).write.option("header", True).csv(path)
    df = RD.scan_readings(spark, path, schema, sort=True)
    return finish(df.select(*_G))


@query("parse_station_ts", views=("sensor_raw",), section="2.1", sql="""
SELECT location_id, strftime(timestamp, '%d-%m-%Y %H:%M') AS local_text,
  strptime(strftime(timestamp, '%d-%m-%Y %H:%M'), '%d-%m-%Y %H:%M') - INTERVAL 330 MINUTE AS timestamp_utc
FROM sensor_raw""")
def q_parse_ts(spark, sf):
    """Station text 'DD-MM-YYYY HH:MM' in local (IST) wall time -> UTC."""
    df = fx.sensor_raw(spark, sf).select("location_id", F.date_format("timestamp", "dd-MM-yyyy HH:mm").alias("local_text"))
    return df.withColumn("timestamp_utc", RD.parse_station_ts(F.col("local_text")))


@query("latest_only_start", views=("sensor_raw",), section="2.1", sql=f"""
SELECT location_id, max(timestamp) AS timestamp, {r('arg_max(rainfall_mm, timestamp)')} AS rainfall_mm
FROM sensor_raw GROUP BY location_id""")
def q_latest_only(spark, sf):
    """First run without saved state: only the newest reading per station."""
    df = ST.latest_reading(fx.sensor_raw(spark, sf).select(*KEY, "rainfall_mm"), keys=["location_id"])
    return finish(df)


@query("latest_reading", views=("sensor_raw",), section="2.1", sql=f"""
SELECT location_id, timestamp, {r('rainfall_mm')} AS rainfall_mm, {r('pressure')} AS pressure
FROM sensor_raw ORDER BY timestamp DESC LIMIT 1""")
def q_latest_reading(spark, sf):
    """Newest reading of the store (top-1, the limit is the feature)."""
    return finish(ST.latest_reading(fx.sensor_raw(spark, sf).select(*KEY, "rainfall_mm", "pressure")))


@query("append_reading", views=("sensor_grid", "sensor_raw"), section="2.1", sql=f"""
SELECT location_id, timestamp, {r('rainfall_mm')} AS rainfall_mm, {r('pressure')} AS pressure, true AS stamped
FROM (SELECT location_id, timestamp, rainfall_mm, pressure FROM sensor_grid
      UNION ALL SELECT location_id, timestamp, rainfall_mm, pressure FROM sensor_raw)""")
def q_append(spark, sf):
    """Typed records appended with created_at; the table read back, with what is stored
    of them and whether created_at is a time of this run."""
    path = _scratch(spark, "appended")
    g = fx.sensor_grid(spark, sf)
    ST.append_reading(g, path)
    began = F.lit(spark.sql("SELECT current_timestamp()").first()[0])
    ST.append_reading(fx.sensor_raw(spark, sf), path)
    got = spark.read.parquet(path)
    return finish(got.select(*KEY, "rainfall_mm", "pressure", F.col("created_at").between(
        began - F.expr("interval 1 hour"), F.current_timestamp()).alias("stamped")))


@query("validate_schema", views=("sensor_dirty",), section="2.1", sql="""
WITH t AS (SELECT location_id, CAST(timestamp AS VARCHAR) AS ts_text, CAST(pressure AS VARCHAR) AS pressure_text,
              CAST(humidity AS VARCHAR) AS humidity_text, CAST(cloudburst AS VARCHAR) AS label_text FROM sensor_dirty)
SELECT location_id, ts_text,
  pressure_text IS NOT NULL AND pressure_text <> '' AND humidity_text IS NOT NULL AND humidity_text <> ''
  AND location_id IS NOT NULL AND ts_text IS NOT NULL AND TRY_CAST(label_text AS INTEGER) IN (0, 1) AS valid
FROM t""")
def q_validate(spark, sf):
    """Text records checked for required typed fields and the label
    domain; ``valid`` splits good rows from the quarantine."""
    d = fx.sensor_dirty(spark, sf).select(
        "location_id", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("ts_text"),
        F.col("pressure").cast("string").alias("pressure_text"), F.col("humidity").cast("string").alias("humidity_text"),
        F.col("cloudburst").cast("string").alias("label_text"))
    v = RD.validate_schema(d, ["location_id", "ts_text", "pressure_text", "humidity_text", "label_text"],
                           ["pressure_text", "humidity_text"], "label_text", "ts_text")
    return v.select("location_id", "ts_text", "valid")


@query("insert_or_ignore", views=("duplicates", "sensor_grid"), section="2.1", sql=f"""
WITH f AS (SELECT *, row_number() OVER (PARTITION BY location_id, timestamp ORDER BY arrival, seq) AS rn FROM duplicates)
SELECT location_id, timestamp, {r('rainfall_mm')} AS rainfall_mm, arrival, seq FROM f
WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM sensor_grid g WHERE g.cloudburst = 1
                             AND g.location_id = f.location_id AND g.timestamp = f.timestamp)""")
def q_insert_or_ignore(spark, sf):
    """UNIQUE(timestamp, location) insert-or-ignore of an arrival log into a
    store holding the labelled readings: first arrival per key, new keys
    only."""
    incoming = fx.duplicates(spark, sf).select(*KEY, "rainfall_mm", "arrival", "seq")
    existing = fx.sensor_grid(spark, sf).where(F.col("cloudburst") == 1)
    return finish(ST.insert_or_ignore(incoming, existing, KEY, ["arrival", "seq"]))


@query("upsert_last_wins", views=("meta_log",), section="2.1", sql="""
SELECT key, arg_max(value, seq) AS value, max(seq) AS last_seq FROM meta_log GROUP BY key""")
def q_upsert(spark, sf):
    return ST.upsert_last_wins(fx.meta_log(spark, sf))


@query("write_features_csv", views=("sensor_grid",), section="2.1", sql=f"""
SELECT timestamp, location_id, rain_last_5min, rain_last_15min, pressure_drop_15min, humidity_change FROM ({_STATION_SQL})""")
def q_write_csv(spark, sf):
    """Engineered table written with a header in fixed column order, read back by
    the names in the files' header."""
    path = _scratch(spark, "features_csv")
    cols = ["timestamp", "location_id", "rain_last_5min", "rain_last_15min", "pressure_drop_15min", "humidity_change"]
    SK.write_features_csv(W.history_features_station(fx.sensor_grid(spark, sf)), path, cols)
    typed = ", ".join(f"{c} {'string' if c == 'location_id' else 'timestamp' if c == 'timestamp' else 'double'}" for c in cols)
    back = spark.read.option("header", True).option("enforceSchema", False).schema(typed).csv(path)
    return finish(back)


@query("error_log", views=("raw_station",), section="2.1", sql=error_filters_sql("raw_station") + """
SELECT location_id, timestamp, temp_err, hum_err, press_err, rain_err, wind_err FROM f WHERE any_error""")
def q_error_log(spark, sf):
    """Rows with any quality error, written to the error sink."""
    errs = SK.error_log(QC.error_filters(fx.raw_station(spark, sf)), _scratch(spark, "error_log"))
    return errs.select(*KEY, "temp_err", "hum_err", "press_err", "rain_err", "wind_err")


@query("write_predictions_json", views=("scored",), section="2.1", sql=f"""
SELECT location_id, max(timestamp) AS timestamp, round(arg_max(probability, timestamp), 6) AS probability,
  arg_max(CASE WHEN probability < 0.10 THEN 'LOW' WHEN probability < 0.30 THEN 'MODERATE'
               WHEN probability < 0.60 THEN 'HIGH' ELSE 'CRITICAL' END, timestamp) AS risk_level,
  arg_max(CAST(probability >= {BEST_F1_THRESHOLD} AS INTEGER), timestamp) AS alert,
  CAST({BEST_F1_THRESHOLD} AS DOUBLE) AS used_threshold
FROM scored GROUP BY location_id""")
def q_predictions_json(spark, sf):
    """Latest prediction per station written as JSON; the values returned."""
    s = fx.scored(spark, sf)
    pred = s.select("timestamp", "location_id", "probability", X.risk_level("probability").alias("risk_level"),
                    X.alert_flag("probability", BEST_F1_THRESHOLD).alias("alert"),
                    F.lit(BEST_F1_THRESHOLD).alias("used_threshold"))
    return SK.write_predictions_json(pred, _scratch(spark, "predictions_json"))


@query("publish_alerts", views=("scored",), section="2.1", sql=f"""
SELECT location_id, timestamp, probability, label FROM scored WHERE probability >= {BEST_F1_THRESHOLD}""")
def q_publish(spark, sf):
    """Alerting rows of a stream handed to two subscribers per micro-batch: one
    that stores them (standing in for the webhook) and one that fails, which is
    logged and stops nothing."""
    from cumulus.streaming import streams as SS
    s = fx.scored(spark, sf)
    stream = SS.read_stream(spark, SS.stage_files(s, "to_publish"), s.schema)

    def failing(batch, batch_id):
        raise ConnectionError("subscriber down")

    def publish(batch, batch_id, out):
        SK.alert_sink(failing, lambda b, i: b.write.mode("overwrite").parquet(f"{out}/batch={i}"))(batch, batch_id)

    out = SS.run_foreach_batch(stream.where(F.col("probability") >= BEST_F1_THRESHOLD), "published", publish)
    return spark.read.parquet(out).drop("batch")


@query("history_retention", views=("sensor_raw",), section="2.1", sql=f"""
SELECT location_id, timestamp, {r('rainfall_mm')} AS rainfall_mm FROM (
  SELECT *, max(timestamp) OVER (PARTITION BY location_id) AS mx FROM sensor_raw)
WHERE timestamp >= mx - INTERVAL 180 MINUTE""")
def q_retention(spark, sf):
    """History buffer after the last update: readings within 3 hours of
    each station's newest one."""
    df = W.history_retention(fx.sensor_raw(spark, sf).select(*KEY, "rainfall_mm"), 180)
    return finish(df)
