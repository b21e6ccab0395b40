"""Registered streaming queries.  Each stages fixture rows as
a growing file source, runs the stream to the end of its input
(``availableNow``) and returns the sink table; where the batch result is
defined the oracle is the batch SQL (stream == batch)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cumulus.functions import scalar as X
from cumulus.operators import alerts as AL
from cumulus.operators import joins as J
from cumulus.plans import composed as C
from cumulus.plans.common import finish, r
from cumulus.plans.q_predicates import BEST_F1_THRESHOLD
from cumulus.plans.q_windows import KEY, q_history_features_station
from cumulus.plans.registry import REGISTRY, query
from cumulus.sources import fixtures as fx
from cumulus.sources.merge import Store, first_wins, last_wins
from cumulus.streaming import streams as SS


def _stream_of(df, name, fmt="parquet", key=None):
    """df as a folder of files; with a key, an end mark lets every row's time pass."""
    path = SS.stage_files(df, name, fmt=fmt)
    if key:
        SS.end_mark(df, path, key, fmt=fmt)
    return SS.read_stream(df.sparkSession, path, df.schema, fmt=fmt)


@query("tip_pulse_tumbling", views=("tips",), section="2.9", sql="""
SELECT location_id, date_trunc('minute', timestamp) AS window_start, count(*) AS n FROM tips GROUP BY 1, 2""")
def q_tumbling(spark, sf):
    """Tip events per station and minute from a watermarked stream, update
    mode, upserted per batch."""
    s = _stream_of(fx.events_keyed(spark, sf, "click"), "tips")
    out = SS.run_foreach_batch(SS.tumbling_counts(s), "tips_counts", SS.upsert_batches, mode="update")
    return SS.latest_per_key(spark, out, ["location_id", "window_start"]).select("location_id", "window_start", "n")


@query("dedup_stream", views=("duplicates",), section="2.9", sql=f"""
SELECT DISTINCT location_id, timestamp FROM duplicates""")
def q_dedup(spark, sf):
    d = fx.duplicates(spark, sf).select(*KEY, "rainfall_mm")
    out = SS.run_append(SS.dedup(_stream_of(d, "dups"), KEY), "dedup")
    return out.select(*KEY)


from cumulus.plans.q_windows import _STATION_SQL  # noqa: E402


@query("station_history_state", views=("sensor_grid",), section="2.9", sql=_STATION_SQL)
def q_station_state(spark, sf):
    """15-minute keyed history per station; equals history_features_station."""
    g = fx.sensor_grid(spark, sf)
    out = SS.run_append(SS.station_history(_stream_of(g, "station", key="location_id")), "station_hist")
    return finish(out)


_HYST_SQL = f"""
WITH RECURSIVE b AS (SELECT location_id, timestamp, probability AS p,
    row_number() OVER (PARTITION BY location_id ORDER BY timestamp) AS rn FROM scored),
h(location_id, rn, timestamp, active, until) AS (
  SELECT location_id, rn, timestamp, p >= {BEST_F1_THRESHOLD},
         CASE WHEN p >= {BEST_F1_THRESHOLD} THEN timestamp + INTERVAL 10 MINUTE END FROM b WHERE rn = 1
  UNION ALL
  SELECT b.location_id, b.rn, b.timestamp,
    CASE WHEN h.active THEN (CASE WHEN b.timestamp >= h.until THEN NOT (b.p < {BEST_F1_THRESHOLD} - 0.05) ELSE true END)
         ELSE b.p >= {BEST_F1_THRESHOLD} END,
    CASE WHEN h.active THEN (CASE WHEN b.timestamp >= h.until THEN (CASE WHEN b.p < {BEST_F1_THRESHOLD} - 0.05 THEN NULL ELSE h.until END)
                                  ELSE (CASE WHEN b.p >= {BEST_F1_THRESHOLD} THEN b.timestamp + INTERVAL 10 MINUTE ELSE h.until END) END)
         ELSE (CASE WHEN b.p >= {BEST_F1_THRESHOLD} THEN b.timestamp + INTERVAL 10 MINUTE END) END
  FROM h JOIN b ON b.location_id = h.location_id AND b.rn = h.rn + 1)
SELECT location_id, timestamp, CAST(active AS INTEGER) AS alert, until AS alert_until FROM h"""


@query("alert_hysteresis", views=("scored",), section="2.9", sql=_HYST_SQL)
def q_hysteresis(spark, sf):
    """Batch hysteresis per station in event time (chunked, exact)."""
    df = AL.alert_hysteresis(fx.scored(spark, sf), "probability", BEST_F1_THRESHOLD)
    return df.select(*KEY, "alert", "alert_until")


@query("alert_hysteresis_stream", views=("scored",), section="2.9", sql=_HYST_SQL)
def q_hysteresis_stream(spark, sf):
    """The same state machine as keyed streaming state."""
    s = _stream_of(fx.scored(spark, sf).select(*KEY, "probability"), "scored", key="location_id")
    out = SS.run_append(SS.hysteresis_stream(s, BEST_F1_THRESHOLD), "hyst")
    return out.select(*KEY, "alert", "alert_until")


@query("sky_trend_stream", section="2.9")
def q_sky(spark, sf):
    """Per camera: EMA, consecutive-frame rates and growth flag, 20-minute
    trends over a 3-hour history."""
    f = fx.frames(spark, sf)
    return SS.run_append(SS.sky_trend_stream(_stream_of(f, "frames", key="camera_id")), "sky")


@query("stream_score", section="2.9")
def q_stream_score(spark, sf):
    """Readings stream -> serving history state -> model input -> calibrated
    ensemble -> risk level -> alert at the tuned threshold, per micro-batch."""
    from cumulus.operators import ml as ML
    from cumulus.plans.q_ml import _ensemble
    _, models, thr = _ensemble(spark, sf)
    g = fx.sensor_grid(spark, sf)
    codes = J.fit_location_codes(g)
    feats = SS.serving_history(_stream_of(g, "serve", key="location_id"))

    def score(batch, batch_id, out):
        b = batch
        for c in C.BASE_SENSORS:
            b = b.withColumn(c, F.coalesce(F.col(c), F.lit(0.0)))
        b = (b.withColumn("satellite_precip", X.satellite_fallback("satellite_precip", "rainfall_mm"))
              .withColumn("radar_dbz", X.radar_fallback("radar_dbz", "rainfall_mm"))
              .withColumn("forecast_30min", X.naive_forecast(F.lit(None).cast("double"), "rain_last_15min")))
        b = J.encode_location(b, codes)
        p = ML.ensemble_predict(b, models, C.FEATURES, "probability")
        (p.select("timestamp", "location_id", F.round("probability", 6).alias("probability"),
                  X.risk_level("probability").alias("risk_level"), X.alert_flag("probability", thr).alias("alert"),
                  F.lit(thr).alias("used_threshold"), F.lit(batch_id).alias("batch_id"))
          .write.mode("overwrite").parquet(f"{out}/batch={batch_id}"))

    out = SS.run_foreach_batch(feats, "score", score)
    return spark.read.parquet(out).drop("batch")


@query("stream_tail_csv", views=("sensor_grid",), section="2.1", sql=f"""
SELECT location_id, timestamp, {r('rainfall_mm')} AS rainfall_mm, {r('pressure')} AS pressure FROM sensor_grid""")
def q_tail_csv(spark, sf):
    """A CSV folder that grows; each file is read once (checkpointed
    progress replaces the saved row position)."""
    g = fx.sensor_grid(spark, sf).select(*KEY, "rainfall_mm", "pressure")
    s = _stream_of(g, "tail", fmt="csv")
    return finish(SS.run_append(s, "tail_out"))


@query("stream_upsert", views=("meta_log",), section="2.1", sql="""
SELECT key, arg_max(value, seq) AS value, max(seq) AS seq FROM meta_log GROUP BY key""")
def q_stream_upsert(spark, sf):
    """A log of metadata writes, merged batch by batch into a stored table: last write wins."""
    log = fx.meta_log(spark, sf)
    path = SS.stage_files(log.withColumn("at", F.timestamp_micros(F.col("seq"))), "meta", ts="at")
    stream = SS.read_stream(spark, path, log.schema, files_per_trigger=2)
    store = Store(spark, SS._scratch(spark, "meta-store"), log.schema, ["key"])
    SS.run_merge(stream, "log", store, last_wins(["key"], "seq"))
    return store.read()


@query("stream_insert_or_ignore", views=("duplicates",), section="2.1", sql=f"""
SELECT location_id, timestamp, {r('arg_min(rainfall_mm, seq * 2 + arrival)')} AS rainfall_mm FROM duplicates
GROUP BY location_id, timestamp""")
def q_stream_insert(spark, sf):
    """Readings, some of which arrive again, inserted into a stored table batch by batch:
    a key that is stored is never written again."""
    d = fx.duplicates(spark, sf).select(*KEY, "rainfall_mm", "arrival", "seq")
    stream = SS.read_stream(spark, SS.stage_files(d, "arrivals"), d.schema, files_per_trigger=3)
    store = Store(spark, SS._scratch(spark, "reading-store"), d.schema, KEY)
    SS.run_merge(stream, "arrivals", store, first_wins(KEY, ["seq", "arrival"]))
    return finish(store.read().drop("arrival", "seq"))


def _quarter(df, ts="timestamp"):
    """The quarter of the table's time span that a row lies in, 0 to 3."""
    us = F.unix_micros(ts)
    lo, hi = df.agg(F.min(us), F.max(us)).first()
    return F.floor((us - F.lit(lo)) / F.lit(-(-(hi - lo + 1) // 4)))


@query("latest_only_stream", views=("sensor_grid",), section="2.1", sql=f"""
WITH b AS (SELECT *, floor((epoch_us(timestamp) - min(epoch_us(timestamp)) OVER ())
    / ceil((max(epoch_us(timestamp)) OVER () - min(epoch_us(timestamp)) OVER () + 1) / 4.0)) AS part FROM sensor_grid),
s AS (SELECT location_id, max(timestamp) AS start FROM b WHERE part < 3 GROUP BY location_id)
SELECT b.location_id, b.timestamp, {r('rainfall_mm')} AS rainfall_mm FROM b LEFT JOIN s ON s.location_id = b.location_id
WHERE s.start IS NULL OR b.timestamp >= s.start""")
def q_latest_only_stream(spark, sf):
    """The service starts when three quarters of the readings are stored: its first run
    yields each station's newest reading, the next one what came since."""
    g = fx.sensor_grid(spark, sf).select(*KEY, "rainfall_mm")
    base = SS._scratch(spark, "service-state")
    part = _quarter(g)
    first, rest = f"{base}/in/early", f"{base}/in/late"
    g.where(part < 3).write.parquet(first)
    for _ in range(2):
        stream = SS.read_stream(spark, f"{base}/in/*", g.schema)
        new = SS.start_at_newest(stream, spark.read.schema(g.schema).parquet(first), base, ["location_id"])
        q = (new.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/chk")
                .trigger(availableNow=True).start())
        q.awaitTermination()
        g.where(part >= 3).write.mode("ignore").parquet(rest)
    return finish(spark.read.schema(g.schema).parquet(f"{base}/out"))
