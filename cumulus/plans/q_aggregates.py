"""Registered aggregate queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cumulus.operators import quality as QC
from cumulus.operators import series as S
from cumulus.operators import sky as SK
from cumulus.operators import stats as ST
from cumulus.operators import windows as W
from cumulus.plans.common import finish, r
from cumulus.plans.q_predicates import BEST_F1_THRESHOLD
from cumulus.plans.q_windows import KEY, MIN, WLOC, WROW
from cumulus.plans.registry import query
from cumulus.sources import fixtures as fx

_DIRTY = ["location_id", "timestamp", "rainfall_mm", "humidity", "pressure", "temperature",
          "wind_gust", "satellite_precip", "radar_dbz", "cloudburst"]


@query("null_counts", views=("sensor_dirty",), section="2.4", sql=f"""
SELECT 'input' AS stage, n_rows, {len(_DIRTY)} AS n_cols, column_name, null_count FROM (
  SELECT count(*) AS n_rows, {", ".join(f"count(*) - count({c}) AS {c}" for c in _DIRTY)} FROM sensor_dirty)
UNPIVOT (null_count FOR column_name IN ({", ".join(_DIRTY)}))""")
def q_null_counts(spark, sf):
    return QC.null_counts(fx.sensor_dirty(spark, sf), "input")


@query("class_balance", views=("sensor_grid",), section="2.4", sql=f"""
SELECT count(*) AS rows, CAST(sum(CASE WHEN cloudburst = 1 THEN 1 ELSE 0 END) AS BIGINT) AS positives,
  CAST(sum(CASE WHEN cloudburst = 0 THEN 1 ELSE 0 END) AS BIGINT) AS negatives,
  {r('sum(CASE WHEN cloudburst = 0 THEN 1 ELSE 0 END) / greatest(1, sum(CASE WHEN cloudburst = 1 THEN 1 ELSE 0 END))')} AS scale_pos_weight,
  {r('count(*) / (2.0 * sum(CASE WHEN cloudburst = 0 THEN 1 ELSE 0 END))')} AS weight_negative,
  {r('count(*) / (2.0 * sum(CASE WHEN cloudburst = 1 THEN 1 ELSE 0 END))')} AS weight_positive
FROM sensor_grid""")
def q_class_balance(spark, sf):
    return finish(ST.class_balance(fx.sensor_grid(spark, sf)))


@query("zscore_outliers", views=("sensor_grid",), section="2.4", sql=f"""
WITH s AS (SELECT avg(rainfall_mm) AS mr, stddev_samp(rainfall_mm) AS sr, avg(pressure) AS mp,
                  stddev_samp(pressure) AS sp, avg(humidity) AS mh, stddev_samp(humidity) AS sh FROM sensor_grid),
f AS (SELECT g.location_id, g.timestamp, g.rainfall_mm, g.pressure, g.humidity,
    coalesce(CASE WHEN sr > 0 THEN abs((g.rainfall_mm - mr) / sr) > 3 END, false) AND g.cloudburst = 0 AS rainfall_mm_is_outlier,
    coalesce(CASE WHEN sp > 0 THEN abs((g.pressure - mp) / sp) > 3 END, false) AS pressure_is_outlier,
    coalesce(CASE WHEN sh > 0 THEN abs((g.humidity - mh) / sh) > 3 END, false) AS humidity_is_outlier
  FROM sensor_grid g, s)
SELECT location_id, timestamp, rainfall_mm_is_outlier, pressure_is_outlier, humidity_is_outlier,
  {r('CASE WHEN rainfall_mm_is_outlier THEN NULL ELSE rainfall_mm END')} AS rainfall_mm,
  {r('CASE WHEN pressure_is_outlier THEN NULL ELSE pressure END')} AS pressure,
  {r('CASE WHEN humidity_is_outlier THEN NULL ELSE humidity END')} AS humidity
FROM f""")
def q_zscore(spark, sf):
    df = ST.zscore_outliers(fx.sensor_grid(spark, sf), ["rainfall_mm", "pressure", "humidity"])
    return finish(df, cols=KEY + ["rainfall_mm_is_outlier", "pressure_is_outlier", "humidity_is_outlier",
                                  "rainfall_mm", "pressure", "humidity"])


def _rule_features(spark, sf):
    """rain_15 over (t-15 min, t]; pressure drop / humidity change over 3
    readings (previous - current, current - previous)."""
    g = fx.sensor_grid(spark, sf)
    g = W.rain_time_sums(g, windows=(15,))
    return W.lag_changes(g, "pressure", "humidity", 3)


_RULE_SQL = f"""
f AS (SELECT location_id, timestamp, cloudburst,
  sum(rainfall_mm) OVER ({WLOC} RANGE BETWEEN {15*MIN - 1} PRECEDING AND CURRENT ROW) AS rain_15,
  lag(pressure, 3) OVER ({WROW}) - pressure AS pressure_drop_15,
  humidity - lag(humidity, 3) OVER ({WROW}) AS humidity_change_15
 FROM sensor_grid),
t AS (SELECT quantile_cont(rain_15, 0.75) AS thr_rain_15, quantile_cont(pressure_drop_15, 0.5) AS thr_pressure_drop_15,
             quantile_cont(humidity_change_15, 0.5) AS thr_humidity_change_15 FROM f WHERE cloudburst = 1)"""


@query("quantile_thresholds", views=("sensor_grid",), section="2.4", sql=f"""
WITH {_RULE_SQL}
SELECT {r('thr_rain_15')} AS thr_rain_15, {r('thr_pressure_drop_15')} AS thr_pressure_drop_15,
  {r('thr_humidity_change_15')} AS thr_humidity_change_15 FROM t""")
def q_quantile_thresholds(spark, sf):
    from cumulus.operators.alerts import rule_thresholds
    t = rule_thresholds(_rule_features(spark, sf))
    a, b, c = t["rain_15"], t["pressure_drop_15"], t["humidity_change_15"]
    df = spark.createDataFrame([(a, b, c)], "thr_rain_15 double, thr_pressure_drop_15 double, "
                                            "thr_humidity_change_15 double")
    return finish(df)


@query("rule_classifier", views=("sensor_grid",), section="2.2", sql=f"""
WITH {_RULE_SQL}
SELECT f.location_id, f.timestamp, CAST(coalesce(rain_15 > thr_rain_15 AND pressure_drop_15 > thr_pressure_drop_15
  AND humidity_change_15 > thr_humidity_change_15, false) AS INTEGER) AS rule_prediction
FROM f, t""")
def q_rule_classifier(spark, sf):
    from cumulus.operators.alerts import rule_classifier
    df = rule_classifier(_rule_features(spark, sf))
    return finish(df, cols=KEY + ["rule_prediction"])


_CORR = ["rainfall_mm", "humidity", "pressure", "temperature", "wind_gust", "satellite_precip", "radar_dbz"]


@query("correlation_matrix", views=("sensor_grid",), section="2.4", sql=" UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, {r(f'corr({a}, {b})')} AS corr FROM sensor_grid"
    for a in _CORR for b in _CORR))
def q_corr(spark, sf):
    return finish(ST.correlation_matrix(fx.sensor_grid(spark, sf), _CORR))


@query("label_histogram", views=("sensor_grid",), section="2.4", sql=f"""
WITH f AS (SELECT cloudburst,
    sum(rainfall_mm) OVER ({WLOC} RANGE BETWEEN {15*MIN - 1} PRECEDING AND CURRENT ROW) AS rain_15 FROM sensor_grid),
m AS (SELECT min(rain_15) AS lo, max(rain_15) AS hi FROM f),
b AS (SELECT cloudburst, lo, CASE WHEN hi > lo THEN (hi - lo) / 20 ELSE 1.0 END AS w, rain_15 FROM f, m WHERE rain_15 IS NOT NULL),
c AS (SELECT cloudburst, lo, w, CAST(least(floor((rain_15 - lo) / w), 19) AS INTEGER) AS bin FROM b)
SELECT n.label, g.bin, {r('n.lo + g.bin * n.w')} AS bin_low, {r('n.lo + (g.bin + 1) * n.w')} AS bin_high,
  coalesce(k.n, 0) AS count, {r('coalesce(k.n, 0) / (n.nl * n.w)')} AS density
FROM (SELECT cloudburst AS label, min(lo) AS lo, min(w) AS w, count(*) AS nl FROM b GROUP BY 1) n
CROSS JOIN (SELECT CAST(unnest(range(20)) AS INTEGER) AS bin) g
LEFT JOIN (SELECT cloudburst AS label, bin, count(*) AS n FROM c GROUP BY 1, 2) k ON k.label = n.label AND k.bin = g.bin""")
def q_label_histogram(spark, sf):
    df = W.rain_time_sums(fx.sensor_grid(spark, sf), windows=(15,))
    return finish(ST.label_histogram(df, "rain_15", "cloudburst", 20))


@query("label_histogram_auto", views=("sensor_grid",), section="2.4", sql=f"""
WITH f AS (SELECT cloudburst,
    sum(rainfall_mm) OVER ({WLOC} RANGE BETWEEN {15*MIN - 1} PRECEDING AND CURRENT ROW) AS rain_15 FROM sensor_grid),
m AS (SELECT min(rain_15) AS lo, max(rain_15) AS hi, count(rain_15) AS n,
        2 * (quantile_cont(rain_15, 0.75) - quantile_cont(rain_15, 0.25)) / pow(count(rain_15), 1.0 / 3.0) AS fd,
        (max(rain_15) - min(rain_15)) / (log2(count(rain_15)) + 1) AS st FROM f),
k AS (SELECT *, CAST(greatest(1, ceil((hi - lo) / CASE WHEN fd > 0 THEN least(fd, st) ELSE st END)) AS INTEGER) AS bins FROM m),
b AS (SELECT cloudburst, lo, bins, (hi - lo) / bins AS w, rain_15 FROM f, k WHERE rain_15 IS NOT NULL),
c AS (SELECT cloudburst, CAST(least(floor((rain_15 - lo) / w), bins - 1) AS INTEGER) AS bin FROM b)
SELECT n.label, g.bin, {r('n.lo + g.bin * n.w')} AS bin_low, {r('n.lo + (g.bin + 1) * n.w')} AS bin_high,
  coalesce(c2.n, 0) AS count, {r('coalesce(c2.n, 0) / (n.nl * n.w)')} AS density
FROM (SELECT cloudburst AS label, min(lo) AS lo, min(w) AS w, count(*) AS nl FROM b GROUP BY 1) n
CROSS JOIN (SELECT CAST(unnest(range(bins)) AS INTEGER) AS bin FROM k) g
LEFT JOIN (SELECT cloudburst AS label, bin, count(*) AS n FROM c GROUP BY 1, 2) c2
  ON c2.label = n.label AND c2.bin = g.bin""")
def q_label_histogram_auto(spark, sf):
    df = W.rain_time_sums(fx.sensor_grid(spark, sf), windows=(15,))
    return finish(ST.label_histogram(df, "rain_15", "cloudburst", "auto"))


_SKETCHED = ["rainfall_mm", "pressure", "humidity"]


@query("quantile_sketch", views=("sensor_raw",), section="2.4", sql="\nUNION ALL ".join(
    f"SELECT location_id, '{c}' AS \"column\", CAST({q} AS DOUBLE) AS q, {r(f'quantile_disc({c}, {q})')} AS value "
    "FROM sensor_raw GROUP BY location_id" for c in _SKETCHED for q in (0.05, 0.5, 0.95)))
def q_quantile_sketch(spark, sf):
    """Quantiles per station from one sketch each; exact while a station has fewer
    readings than the accuracy."""
    return finish(ST.approximate_quantiles(fx.sensor_raw(spark, sf), _SKETCHED, [0.05, 0.5, 0.95], ["location_id"], 100_000))


@query("rain_total_since", views=("sensor_grid",), section="2.4", sql=f"""
SELECT location_id, timestamp,
  {r(f'coalesce(sum(coalesce(rainfall_mm, 0)) OVER ({WLOC} RANGE BETWEEN {15*MIN} PRECEDING AND CURRENT ROW), 0)')} AS rain_total
FROM sensor_grid""")
def q_rain_total_since(spark, sf):
    return finish(W.rain_total_since(fx.sensor_grid(spark, sf), 15), cols=KEY + ["rain_total"])


@query("rain_from_tips", views=("tips",), section="2.4", sql="""
SELECT location_id, date_trunc('minute', timestamp) AS window_start, count(*) AS tips,
  round(CAST(count(*) AS DOUBLE) * 0.2794, 3) AS rainfall_mm
FROM tips GROUP BY 1, 2""")
def q_rain_from_tips(spark, sf):
    from cumulus.operators.counters import rain_from_tips
    return rain_from_tips(fx.events_keyed(spark, sf, "click"))


@query("wind_from_pulses", views=("pulses",), section="2.4", sql="""
SELECT location_id, date_trunc('minute', timestamp) AS window_start, count(*) AS pulses,
  round(count(*) / 60.0 * 2.4, 3) AS wind_kmh
FROM pulses GROUP BY 1, 2""")
def q_wind_from_pulses(spark, sf):
    from cumulus.operators.counters import wind_from_pulses
    return wind_from_pulses(fx.events_keyed(spark, sf, "view"), interval_s=60)


@query("sampling_interval", views=("sensor_raw",), section="2.4", sql=f"""
WITH d AS (SELECT location_id, (epoch_us(timestamp) - epoch_us(lag(timestamp) OVER ({WROW}))) / 1e6 AS dt FROM sensor_raw)
SELECT location_id, {r('quantile_cont(dt, 0.5)')} AS sampling_interval_s FROM d GROUP BY location_id""")
def q_sampling_interval(spark, sf):
    from cumulus.operators.counters import sampling_interval
    return finish(sampling_interval(fx.sensor_raw(spark, sf)))


def _scored_pred(spark, sf):
    return fx.scored(spark, sf).withColumn(
        "prediction", (F.col("probability") >= F.lit(BEST_F1_THRESHOLD)).cast("int"))


_PRED = f"(SELECT *, CAST(probability >= {BEST_F1_THRESHOLD} AS INTEGER) AS prediction FROM scored)"


@query("confusion_matrix", views=("scored",), section="2.4", sql=f"""
SELECT label AS actual, CAST(sum(CASE WHEN prediction = 0 THEN 1 ELSE 0 END) AS BIGINT) AS pred_0,
  CAST(sum(CASE WHEN prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pred_1
FROM {_PRED} p GROUP BY label""")
def q_confusion(spark, sf):
    return ST.confusion_matrix(_scored_pred(spark, sf), "label", "prediction")


@query("accuracy", views=("scored",), section="2.4", sql=f"""
SELECT {r('avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END)')} AS accuracy, count(*) AS n FROM {_PRED} p""")
def q_accuracy(spark, sf):
    return finish(ST.accuracy(_scored_pred(spark, sf)))


@query("classification_report", views=("scored",), section="2.4", sql=f"""
WITH p AS {_PRED},
c AS (SELECT cls, CAST(sum(CASE WHEN label = cls THEN 1 ELSE 0 END) AS BIGINT) AS support,
        sum(CASE WHEN prediction = cls THEN 1 ELSE 0 END) AS predicted,
        sum(CASE WHEN prediction = cls AND label = cls THEN 1 ELSE 0 END) AS tp
      FROM p, (VALUES (0), (1)) v(cls) GROUP BY cls),
m AS (SELECT cls, support, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS precision,
        CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall FROM c),
k AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM m)
SELECT CAST(cls AS VARCHAR) AS class, round(precision, 3) AS precision, round(recall, 3) AS recall, round(f1, 3) AS f1, support FROM k
UNION ALL SELECT 'macro avg', round(avg(precision), 3), round(avg(recall), 3), round(avg(f1), 3), CAST(sum(support) AS BIGINT) FROM k
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 3), round(sum(recall * support) / sum(support), 3),
  round(sum(f1 * support) / sum(support), 3), CAST(sum(support) AS BIGINT) FROM k""")
def q_classification_report(spark, sf):
    return ST.classification_report(_scored_pred(spark, sf))


@query("roc_auc", views=("scored",), section="2.4", sql=f"""
WITH rk AS (SELECT label, rank() OVER (ORDER BY probability) AS r0,
                   count(*) OVER (PARTITION BY probability) AS ties FROM scored WHERE probability IS NOT NULL),
a AS (SELECT sum(CASE WHEN label = 1 THEN r0 + (ties - 1) / 2.0 ELSE 0 END) AS rs,
             CAST(sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS P,
             CAST(sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS BIGINT) AS N FROM rk)
SELECT {r('CASE WHEN P > 0 AND N > 0 THEN (rs - P * (P + 1) / 2.0) / (P * N) END')} AS auc,
  P AS positives, N AS negatives FROM a""")
def q_roc_auc(spark, sf):
    return finish(ST.roc_auc(fx.scored(spark, sf)))


def _grid_values() -> str:
    return ", ".join(f"({i}, {t!r})" for i, t in enumerate(ST.sweep_thresholds()))


_SWEEP_SQL = f"""
t(i, threshold) AS (VALUES {_grid_values()}),
c AS (SELECT t.i, t.threshold,
        CAST(sum(CASE WHEN s.probability >= t.threshold AND s.label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
        CAST(sum(CASE WHEN s.probability >= t.threshold AND s.label <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
        sum(CASE WHEN s.label = 1 THEN 1 ELSE 0 END) AS P
      FROM t, scored s WHERE s.probability IS NOT NULL GROUP BY t.i, t.threshold),
f AS (SELECT i, threshold, tp, fp,
        CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision,
        CASE WHEN P > 0 THEN tp / P ELSE 0 END AS recall,
        CASE WHEN 2 * tp + fp + (P - tp) > 0 THEN 2.0 * tp / (2 * tp + fp + (P - tp)) ELSE 0 END AS f1 FROM c)"""


@query("f1_sweep", views=("scored",), section="2.4", sql=f"""
WITH {_SWEEP_SQL}
SELECT i, {r('threshold')} AS threshold, tp, fp, {r('precision')} AS precision, {r('recall')} AS recall, {r('f1')} AS f1 FROM f""")
def q_f1_sweep(spark, sf):
    return finish(ST.f1_sweep(fx.scored(spark, sf)))


@query("thresholds_table", views=("scored",), section="2.4", sql=f"""
WITH {_SWEEP_SQL},
top AS (SELECT label, probability FROM scored WHERE probability IS NOT NULL
        ORDER BY probability DESC, location_id, timestamp LIMIT 100),
pk AS (SELECT avg(CAST(label AS DOUBLE)) AS p100, CASE WHEN count(*) >= 100 THEN min(probability) END AS kth FROM top),
b AS (SELECT threshold, f1 FROM f ORDER BY f1 DESC, i LIMIT 1)
SELECT {r('p100')} AS precision_at_100, {r('kth')} AS precision_at_100_threshold_prob,
  {r('threshold')} AS best_f1_threshold, {r('f1')} AS best_f1_value FROM pk, b""")
def q_thresholds_table(spark, sf):
    return finish(ST.thresholds_table(fx.scored(spark, sf), tiebreak=KEY))


@query("optical_stats", views=("pixels",), section="2.4", sql=f"""
WITH roi AS (SELECT p.* FROM pixels p JOIN (SELECT frame, max(y) + 1 AS h FROM pixels GROUP BY frame) hh
             ON p.frame = hh.frame WHERE p.y < floor(hh.h * 0.7)),
dims AS (SELECT frame, max(y) AS my, max(x) AS mx FROM roi GROUP BY frame),
nb AS (SELECT r.frame, r.y, r.x, CAST(r.v AS DOUBLE) AS v,
         CASE WHEN r.x = 0 THEN 1 ELSE r.x - 1 END AS xl, CASE WHEN r.x = d.mx THEN d.mx - 1 ELSE r.x + 1 END AS xr,
         CASE WHEN r.y = 0 THEN 1 ELSE r.y - 1 END AS yu, CASE WHEN r.y = d.my THEN d.my - 1 ELSE r.y + 1 END AS yd
       FROM roi r JOIN dims d ON r.frame = d.frame),
lap AS (SELECT nb.frame, nb.v, l.v + rr.v + u.v + dd.v - 4 * nb.v AS lap
        FROM nb JOIN roi l ON l.frame = nb.frame AND l.y = nb.y AND l.x = nb.xl
                JOIN roi rr ON rr.frame = nb.frame AND rr.y = nb.y AND rr.x = nb.xr
                JOIN roi u ON u.frame = nb.frame AND u.y = nb.yu AND u.x = nb.x
                JOIN roi dd ON dd.frame = nb.frame AND dd.y = nb.yd AND dd.x = nb.x),
a AS (SELECT frame, avg(v) AS brightness, stddev_pop(v) AS contrast,
        avg(CASE WHEN v < 90 THEN 1.0 ELSE 0.0 END) AS dark_fraction,
        avg(CASE WHEN v < 200 THEN 1.0 ELSE 0.0 END) AS cloud_fraction, avg(abs(lap)) AS texture_index
      FROM lap GROUP BY frame)
SELECT frame, {r('brightness')} AS brightness, {r('contrast')} AS contrast, {r('dark_fraction')} AS dark_fraction,
  {r('cloud_fraction')} AS cloud_fraction, {r('texture_index')} AS texture_index,
  CASE WHEN brightness / 255.0 > 0.7 AND dark_fraction < 0.15 THEN 'THIN'
       WHEN brightness / 255.0 > 0.4 AND brightness / 255.0 <= 0.7 AND dark_fraction < 0.40 THEN 'MEDIUM'
       ELSE 'THICK_CONVECTIVE' END AS thickness_class
FROM a""")
def q_optical(spark, sf):
    return finish(SK.optical_stats(fx.pixels(spark, sf)))


@query("flow_summary", views=("flow_vectors",), section="2.4", sql=f"""
WITH v AS (SELECT frame, vx, vy, sqrt(vx * vx + vy * vy) AS mag FROM flow_vectors),
m AS (SELECT frame,
        quantile_cont(CASE WHEN mag > 0.3 AND mag < 20 THEN vx END, 0.5) AS mvx,
        quantile_cont(CASE WHEN mag > 0.3 AND mag < 20 THEN vy END, 0.5) AS mvy,
        quantile_cont(CASE WHEN mag > 0.3 AND mag < 20 THEN mag END, 0.5) AS mmag
      FROM v GROUP BY frame),
d AS (SELECT *, degrees(atan2(-mvy, mvx)) AS ang FROM m)
SELECT frame, {r('mvx')} AS cloud_vx, {r('mvy')} AS cloud_vy,
  CASE CAST(floor((((ang + 360.0) - 360.0 * floor((ang + 360.0) / 360.0)) + 22.5 - 360.0 * floor((((ang + 360.0) - 360.0 * floor((ang + 360.0) / 360.0)) + 22.5) / 360.0)) / 45.0) AS INTEGER)
    WHEN 0 THEN 'E' WHEN 1 THEN 'NE' WHEN 2 THEN 'N' WHEN 3 THEN 'NW' WHEN 4 THEN 'W' WHEN 5 THEN 'SW'
    WHEN 6 THEN 'S' WHEN 7 THEN 'SE' END AS cloud_direction,
  {r('mmag / 60.0 * (2 * 2000.0 * tan(radians(90.0) / 2.0) / 640.0) * 3.6')} AS cloud_speed_kmh
FROM d""")
def q_flow(spark, sf):
    return finish(SK.flow_summary(fx.flow_vectors(spark, sf)))
