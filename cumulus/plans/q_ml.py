"""Registered ML queries and batch scoring.  Model outputs
are not SQL-expressible; they get the rows-only check plus unit tests."""

from __future__ import annotations

from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import functions as F

from cumulus.functions import scalar as X
from cumulus.operators import ml as ML
from cumulus.operators import joins as J
from cumulus.operators import stats as ST
from cumulus.plans import composed as C
from cumulus.plans.common import finish, r
from cumulus.plans.q_windows import KEY
from cumulus.plans.registry import query
from cumulus.session import checkpoint_dir, scratch_dir
from cumulus.sources import fixtures as fx

# The model inputs of pipelines A and B.
A_FEATURES = ["rain_15", "rain_5", "pressure_drop_15", "humidity_change_15", "satellite_precip",
              "forecast_30min", "rainfall_mm_smooth", "pressure_smooth", "humidity_smooth"]
B_FEATURES = ["rain_5", "rain_15", "rain_30", "pressure_drop_15", "pressure_std_30", "hum_change_15", "hum_mean_15",
              "hum_std_15", "temp_change_15", "temp_std_15", "temp_mean_15", "wind_mean_15", "wind_max_15",
              "wind_std_15", "wind_change_15", "dew_point", "dewpoint_depression", "satellite_precip", "forecast_30min"]


def _matrix(spark, sf):
    return ML.training_matrix(fx.sensor_grid(spark, sf))


_RANKED = """WITH k AS (SELECT location_id, timestamp, cloudburst,
  row_number() OVER (PARTITION BY cloudburst ORDER BY
    md5(concat(location_id, '|', epoch_us(timestamp), '|42')), location_id, timestamp) AS rk,
  count(*) OVER (PARTITION BY cloudburst) AS n FROM sensor_grid)"""


@query("stratified_split", views=("sensor_grid",), section="2.10", sql=f"""
{_RANKED}
SELECT location_id, timestamp, cloudburst, rk <= floor(n * 0.25 + 0.5) AS is_test FROM k""")
def q_split(spark, sf):
    """25 % test share of each class, exactly, by a seeded hash of the keys."""
    df = ML.stratified_split(_matrix(spark, sf), "cloudburst", 0.25, KEY)
    return df.select(*KEY, "cloudburst", "is_test")


@query("stratified_folds", views=("sensor_grid",), section="2.10", sql=f"""
{_RANKED}
SELECT location_id, timestamp, cloudburst, CAST((rk - 1) % 3 AS INTEGER) AS fold FROM k""")
def q_folds(spark, sf):
    df = ML.stratified_folds(_matrix(spark, sf), "cloudburst", 3, KEY)
    return df.select(*KEY, "cloudburst", "fold")


_SCALE = ["rainfall_mm", "humidity", "pressure", "temperature"]


@query("standard_scale", views=("sensor_grid",), section="2.10", sql="WITH s AS (SELECT "
       + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _SCALE) + " FROM sensor_grid)\nSELECT location_id, timestamp, "
       + ", ".join(f"{r(f'({c} - m_{c}) / CASE WHEN s_{c} > 0 THEN s_{c} ELSE 1.0 END')} AS {c}_scaled" for c in _SCALE)
       + " FROM sensor_grid, s")
def q_scale(spark, sf):
    g = fx.sensor_grid(spark, sf)
    params = ML.fit_standard_scaler(g, _SCALE)
    return finish(ML.standard_scale(g, params, "_scaled"), cols=KEY + [f"{c}_scaled" for c in _SCALE])


def _pipeline_a_split(spark, sf):
    feats = C.pipeline_a_features(fx.sensor_dirty(spark, sf))
    if "forecast_30min" not in feats.columns:
        # no forecast column: the naive one that serving falls back to
        feats = feats.withColumn("forecast_30min", X.naive_forecast(F.lit(None).cast("double"), "rain_15"))
    # stored once: counts, scaling, fit and scoring all read it
    checkpoint_dir(spark)
    return ML.stratified_split(feats, "cloudburst", 0.25, KEY).checkpoint()


@query("logreg", section="2.10")
def q_logreg(spark, sf):
    """Scaled pipeline-A features, L2 logistic regression (C = 1), test-row
    probabilities."""
    d = _pipeline_a_split(spark, sf)
    train = d.where(~F.col("is_test"))
    params = ML.fit_standard_scaler(train, A_FEATURES)
    d = ML.standard_scale(d, params)
    model = ML.logreg(d.where(~F.col("is_test")), A_FEATURES, "cloudburst")
    out = model.transform(ML.assemble(d.where(F.col("is_test")), A_FEATURES))
    return finish(out.select(*KEY, "cloudburst", ML.positive().alias("probability"),
                             F.col("prediction").cast("int").alias("prediction")))


def _rf(spark, sf, trees=200):
    d = _pipeline_a_split(spark, sf)
    model = ML.random_forest(d.where(~F.col("is_test")), A_FEATURES, "cloudburst", num_trees=trees)
    return d, model


@query("random_forest", section="2.10")
def q_random_forest(spark, sf):
    """Balanced-weight forest of 200 trees on pipeline-A features; test rows."""
    d, model = _rf(spark, sf)
    out = model.transform(ML.assemble(d.where(F.col("is_test")), A_FEATURES))
    return finish(out.select(*KEY, "cloudburst", ML.positive().alias("probability"),
                             F.col("prediction").cast("int").alias("prediction")))


_FORESTS: dict[tuple[str, str], tuple] = {}


def _rf_b(spark, sf, trees=200):
    """(rows with is_test, forest): pipeline B's 19 features, scaled on the training rows,
    with 20 % of each class held back; fitted once per session and table."""
    at = (spark.sparkContext.applicationId, sf)
    if at in _FORESTS:
        return _FORESTS[at]
    feats = C.pipeline_b_features(fx.raw_station(spark, sf))
    # no forecast column: the naive one that serving falls back to
    feats = feats.withColumn("forecast_30min", X.naive_forecast(F.lit(None).cast("double"), "rain_15"))
    checkpoint_dir(spark)
    d = ML.stratified_split(feats, "cloudburst", 0.2, KEY).checkpoint()
    d = ML.standard_scale(d, ML.fit_standard_scaler(d.where(~F.col("is_test")), B_FEATURES))
    _FORESTS[at] = d, ML.random_forest(d.where(~F.col("is_test")), B_FEATURES, "cloudburst", num_trees=trees)
    return _FORESTS[at]


@query("random_forest_b", section="2.10")
def q_random_forest_b(spark, sf):
    """Balanced-weight forest of 200 trees on pipeline B's features; test rows."""
    d, model = _rf_b(spark, sf)
    out = model.transform(ML.assemble(d.where(F.col("is_test")), B_FEATURES))
    return finish(out.select(*KEY, "cloudburst", ML.positive().alias("probability"),
                             F.col("prediction").cast("int").alias("prediction")))


@query("feature_importance_b", section="2.4")
def q_importance_b(spark, sf):
    """Importances of pipeline B's forest, greatest first."""
    _, model = _rf_b(spark, sf)
    return ML.feature_importance(model, B_FEATURES, spark)


@query("feature_importance", section="2.4")
def q_importance(spark, sf):
    d, model = _rf(spark, sf)
    return ML.feature_importance(model, A_FEATURES, spark)


_FITTED: dict[tuple[str, str], tuple] = {}


def _ensemble(spark, sf):
    """(training matrix, models, tuned threshold), fitted once per session and table."""
    at = (spark.sparkContext.applicationId, sf)
    if at not in _FITTED:
        checkpoint_dir(spark)
        m = _matrix(spark, sf).checkpoint(eager=True)
        models = ML.calibrated_ensemble(m, C.FEATURES, "cloudburst")
        fit = ML.ensemble_predict(m, models, C.FEATURES, "probability")
        best = ST.best_f1(ST.f1_sweep(fit, "probability", "cloudburst")).first()
        _FITTED[at] = m, models, float(best["best_f1_threshold"]) if best else X.DEFAULT_ALERT_THRESHOLD
    return _FITTED[at]


@query("calibrated_ensemble", section="2.10")
def q_calibrated(spark, sf):
    """5 seeds x 3 folds of boosted trees (800 rounds), each Platt-calibrated on its
    held-out fold: one row per model (trees, calibration slope, intercept)."""
    _, models, _ = _ensemble(spark, sf)
    rows = [(m["seed"], m["fold"], len(m["trees"].nodes), m["a"], m["b"]) for m in models]
    return spark.createDataFrame(rows, "seed int, fold int, trees int, platt_a double, platt_b double")


@query("platt_calibration", section="2.10")
def q_platt(spark, sf):
    """Boosted trees on two folds, sigmoid fitted on the third: calibrated
    probabilities of the rows of the first seed's first fold."""
    m, models, _ = _ensemble(spark, sf)
    first = [x for x in models if x["fold"] == 0][:1]
    held = ML.hashed_folds(m, 3, KEY, first[0]["seed"]).where(F.col("fold") == 0)
    out = ML.ensemble_predict(held, first, C.FEATURES, "calibrated_probability")
    return finish(out.select(*KEY, "cloudburst", "calibrated_probability"))


@query("ensemble_mean", section="2.10", sql=f"""
SELECT event_id, {r('(round(value / 500, 6) + round(value / 600, 6) + round(value / 700, 6)) / 3.0')} AS probability_mean
FROM events""")
def q_ensemble_mean(spark, sf):
    """Row mean of several models' positive-class probabilities (three
    given score columns per event)."""
    ev = fx.table(spark, sf, "events")
    cols = [F.round(F.col("value") / d, 6) for d in (500, 600, 700)]
    return finish(ev.select("event_id", ML.row_mean(cols).alias("probability_mean")))


@query("score_batch", section="2.7b")
def q_score_batch(spark, sf):
    """Model input for every reading -> calibrated ensemble mean -> risk
    level -> alert at the tuned best-F1 threshold -> rounded output."""
    _, models, thr = _ensemble(spark, sf)
    g = fx.sensor_grid(spark, sf)
    mi = C.model_input(g, J.fit_location_codes(g))
    scored = ML.ensemble_predict(mi, models, C.FEATURES, "probability")
    return scored.select("timestamp", "location_id", F.round("probability", 6).alias("probability"),
                         X.risk_level("probability").alias("risk_level"),
                         X.alert_flag("probability", thr).alias("alert"),
                         F.lit(thr).alias("used_threshold"))


@query("model_store", section="2.1")
def q_model_store(spark, sf):
    """Save ensemble, encoder, threshold and feature list in a new folder of the
    shared scratch, load them back and score with what was loaded."""
    train, models, thr = _ensemble(spark, sf)
    path = scratch_dir(spark, "models/ensemble")
    ML.save_models(spark, models, path, J.fit_location_codes(fx.sensor_grid(spark, sf)), {"best_f1": thr}, C.FEATURES)
    loaded, meta = ML.load_models(spark, path)
    out = ML.ensemble_predict(train, loaded, meta["features"], "probability")
    return out.select(*KEY, F.round("probability", 6).alias("probability"),
                      X.alert_flag("probability", meta["thresholds"]["best_f1"]).alias("alert"))


@query("weather_class", section="2.10")
def q_weather(spark, sf):
    et = ML.edge_training(spark, sf)
    model = ML.weather_class(et)
    return ML.weather_predict(model, et).select("location_id", "timestamp", "class_id", "weather", "confidence")


@query("load_or_train", section="2.1")
def q_load_or_train(spark, sf):
    """The temperature forecast, trained and stored by the first call and loaded by the
    second: predictions of the loaded one."""
    path, lags = scratch_dir(spark, "models/forecast"), []

    def train():
        model, rows = ML.temp_forecast(fx.sensor_grid(spark, sf))
        lags.append(rows)
        return model

    def model():
        return ML.load_or_train(spark, path, train, LinearRegressionModel.load, lambda m, p: m.write().overwrite().save(p))

    model()
    out = model().transform(ML.assemble(lags[0], ["lag_3", "lag_2", "lag_1"]))
    return out.select(*KEY, F.round("prediction", 2).alias("next_temperature"))


@query("isolation_forest", section="2.10")
def q_isolation(spark, sf):
    et = ML.edge_training(spark, sf)
    out = ML.isolation_forest(et, ML.EDGE_FEATURES)
    return out.select("location_id", "timestamp", "anomaly_score", "anomaly")


@query("temp_forecast", section="2.10")
def q_temp_forecast(spark, sf):
    """Next temperature from the three previous ones (linear regression)."""
    model, lags = ML.temp_forecast(fx.sensor_grid(spark, sf))
    out = model.transform(ML.assemble(lags, ["lag_3", "lag_2", "lag_1"]))
    return out.select(*KEY, F.round("prediction", 2).alias("next_temperature"))


@query("bootstrap_augment", section="2.10")
def q_bootstrap(spark, sf):
    """Edge rows grown to twice their number with noisy resampled copies."""
    et = ML.edge_training(spark, sf)
    return ML.bootstrap_augment(et, min_rows=2 * et.count())


@query("station_report", section="2.10")
def q_station_report(spark, sf):
    """One JSON document per reading: readings, weather class and
    confidence, anomaly flag and score, next temperature, time."""
    et = ML.edge_training(spark, sf)
    wc = ML.weather_predict(ML.weather_class(et), et)
    iso = ML.isolation_forest(et, ML.EDGE_FEATURES).select(*KEY, "anomaly", "anomaly_score")
    model, lags = ML.temp_forecast(fx.sensor_grid(spark, sf))
    nxt = model.transform(ML.assemble(lags, ["lag_3", "lag_2", "lag_1"])).select(
        *KEY, F.round("prediction", 2).alias("next_temperature"))
    j = wc.join(iso, KEY, "left").join(nxt, KEY, "left")
    doc = F.to_json(F.struct(
        F.struct("Temp", "Humidity", "Pressure").alias("readings"),
        F.struct(F.col("weather").alias("class"), "confidence").alias("weather"),
        F.struct("anomaly", F.col("anomaly_score").alias("score")).alias("anomaly"),
        "next_temperature", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("time")))
    return j.select(*KEY, doc.alias("report"))
