"""Rows-only operators: literal expectations and stream == batch checks."""

import math

import pytest
from pyspark.sql import functions as F

from cumulus.operators import ml as ML
from cumulus.operators import alerts as AL
from cumulus.operators import recursive as RC
from cumulus.operators import sky as SKY
from cumulus.operators import windows as W
from cumulus.operators.series import DEFAULT
from cumulus.sources import fixtures as fx
from cumulus.streaming import streams as SS
from conftest import SF001, rows

KEY = ["location_id", "timestamp"]
CAM = DEFAULT.with_(keys=("camera_id",))


def test_temp_forecast_on_a_ramp(spark):
    # a pure ramp: the fitted model predicts the next step exactly
    data = [("s", f"2024-07-01 00:{i:02d}:00", 20.0 + 0.1 * i) for i in range(40)]
    df = spark.createDataFrame(data, "location_id string, timestamp string, temperature double") \
        .withColumn("timestamp", F.to_timestamp("timestamp"))
    model, lags = ML.temp_forecast(df)
    pred = model.transform(ML.assemble(lags, ["lag_3", "lag_2", "lag_1"]))
    for r in pred.select("temperature", "prediction").collect():
        assert r["prediction"] == pytest.approx(r["temperature"], abs=1e-6)


def test_stratified_split_share(spark):
    m = ML.training_matrix(fx.sensor_grid(spark, "/root/testdata/sf0.01"))
    s = ML.stratified_split(m, "cloudburst", 0.25, KEY)
    for r in s.groupBy("cloudburst").agg(F.avg(F.col("is_test").cast("double")).alias("share")).collect():
        assert abs(r["share"] - 0.25) < 0.04


def test_folds_are_balanced(spark):
    df = spark.range(101).select("id", (F.col("id") % 7 == 0).cast("int").alias("y"))
    got = {}
    for r in ML.stratified_folds(df, "y", 3, ["id"]).groupBy("y", "fold").count().collect():
        got.setdefault(r.y, []).append(r["count"])
    assert all(len(v) == 3 and max(v) - min(v) <= 1 for v in got.values())
    s = ML.stratified_split(df, "y", 0.25, ["id"]).where("is_test").groupBy("y").count().collect()
    assert {r.y: r["count"] for r in s} == {0: 22, 1: 4}


def test_bootstrap_is_exact_with_repeated_rows(spark):
    df = spark.createDataFrame([(20.0, 50.0, 1000.0, 1)] * 90 + [(30.0, 60.0, 990.0, 2)] * 10,
                               "Temp double, Humidity double, Pressure double, Weather_Label int")
    out = ML.bootstrap_augment(df, min_rows=100 + 37)
    assert out.count() == 140
    copies = out.where("Temp not in (20.0, 30.0)")
    assert copies.count() == 40 and {r[0] for r in copies.select("Weather_Label").distinct().collect()} <= {1, 2}
    assert ML.bootstrap_augment(df, min_rows=50).count() == 100 and ML.bootstrap_augment(df.limit(0), 50).count() == 0


def test_isolation_forest_decision_values(spark):
    rows = [(f"k{i}", i, 20.0 + (i % 10) / 10, 50.0 + i % 7, 1000.0) for i in range(200)] + [("far", 1, 90.0, 5.0, 800.0)]
    df = spark.createDataFrame(rows, "location_id string, timestamp long, Temp double, Humidity double, Pressure double")
    out = ML.isolation_forest(df, ML.EDGE_FEATURES, n_trees=30)
    share = out.agg(F.avg("anomaly")).first()[0]
    assert 0.02 <= share <= 0.08
    assert out.where("(anomaly = 1) <> (anomaly_score < 0) and anomaly_score <> 0").count() == 0
    assert out.orderBy("anomaly_score").first().location_id == "far"


def test_boosting_learns_and_reads_back():
    import pickle

    import numpy as np

    from cumulus.operators import boosting as B
    rng = np.random.default_rng(1)
    X = rng.normal(size=(3000, 5))
    X[::50, 1] = np.nan
    y = ((X[:, 0] * np.nan_to_num(X[:, 1]) + X[:, 2]) > 0.5).astype(int)
    trees = B.fit(X[:2000], y[:2000], B.Settings(rounds=60), 3)
    z = trees.margin(X[2000:])
    rank = z.argsort().argsort() + 1
    pos = y[2000:].sum()
    auc = (rank[y[2000:] == 1].sum() - pos * (pos + 1) / 2) / (pos * (1000 - pos))
    assert auc > 0.93 and all(len(n) <= 2 * 48 - 1 for n in trees.nodes)
    assert np.array_equal(pickle.loads(pickle.dumps(trees)).margin(X[2000:]), z)
    # a plain walk down the nodes gives the same
    codes = B.bin_codes(X[2000:2050], trees.edges)
    for i in range(50):
        total = trees.start
        for nodes in trees.nodes:
            at = 0
            while nodes[at][0] >= 0:
                f, b, left, right, _ = nodes[at]
                at = int(right if codes[int(f), i] > b else left)
            total += nodes[at][4]
        assert total == pytest.approx(z[i], abs=1e-9)
    a, b = B.platt(z, y[2000:])
    assert a > 0


def test_ensemble_has_every_model(spark):
    df = spark.range(600).select(F.col("id").alias("timestamp"), F.lit("a").alias("location_id"),
                                 (F.col("id") % 10).cast("double").alias("x"), (F.col("id") % 3).cast("double").alias("z"),
                                 (F.col("id") % 10 > 6).cast("int").alias("cloudburst"))
    models = ML.calibrated_ensemble(df, ["x", "z"], "cloudburst", rounds=5)
    assert [(m["seed"], m["fold"]) for m in models] == [(s, f) for s in ML.ENSEMBLE_SEEDS for f in range(3)]
    p = ML.ensemble_predict(df, models, ["x", "z"], "p")
    assert p.where("cloudburst = 1").agg(F.min("p")).first()[0] > p.where("cloudburst = 0").agg(F.max("p")).first()[0]


def test_weather_class_names_and_confidence(spark):
    et = ML.edge_training(spark, SF001)
    out = ML.weather_predict(ML.weather_class(et, num_trees=10), et)
    assert out.where((F.col("confidence") < 0) | (F.col("confidence") > 100)).count() == 0
    names = {r[0] for r in out.select("weather").distinct().collect()}
    assert names <= {"Sunny", "Cloudy", "Light Rain", "Heavy Rain"}


def ended(df, name, key="location_id", shuffled=0, days=1):
    """df as files (in time order, or shuffled over so many) with an end mark."""
    if shuffled:
        path = SS._scratch(df.sparkSession, name) + "/in"
        for i in range(shuffled):
            df.where(F.pmod(F.xxhash64(*KEY if key == "location_id" else ("camera_id", "timestamp")), F.lit(shuffled)) == i
                     ).coalesce(1).write.mode("append").parquet(path)
    else:
        path = SS.stage_files(df, name)
    SS.end_mark(df, path, key, days=days)
    return SS.read_stream(df.sparkSession, path, df.schema, files_per_trigger=1 if shuffled else None)


def test_shuffled_files_within_the_watermark(spark):
    g = fx.sensor_grid(spark, SF001)
    cols = KEY + ["rain_last_5min", "rain_last_15min", "pressure_drop_5min", "pressure_drop_15min", "humidity_change"]
    batch = W.history_features_station(g).select(*cols)
    s = ended(g, "t_shuf", shuffled=5, days=60)
    out = SS.run_append(SS.station_history(s, watermark="40 days"), "t_shuf_out")
    assert rows(out, cols) == rows(batch, cols)
    s0 = fx.scored(spark, SF001).select(*KEY, "probability")
    s = ended(s0, "t_shuf2", shuffled=5, days=60)
    out = SS.run_append(SS.hysteresis_stream(s, 0.2, watermark="40 days"), "t_shuf2_out").select(*KEY, "alert")
    assert rows(out, KEY + ["alert"]) == rows(AL.alert_hysteresis(s0, threshold=0.2).select(*KEY, "alert"), KEY + ["alert"])


def test_late_rows_are_counted(spark):
    g = fx.sensor_grid(spark, SF001)
    s = ended(g, "t_late", shuffled=4)
    out = SS.run_append(SS.station_history(s, watermark="1 minute"), "t_late_out")
    path = out.inputFiles()[0].rsplit("/", 1)[0]
    late = SS.late_rows(spark, path)
    assert late > 0 and out.count() + late == g.count()


def test_rows_of_one_time_see_each_other(spark):
    data = [("a", "2024-07-01 00:00:00", 1.0, 1000.0, 50.0), ("a", "2024-07-01 00:01:00", 2.0, 990.0, 60.0),
            ("a", "2024-07-01 00:01:00", 4.0, 990.0, 60.0), ("a", "2024-07-01 00:20:00", None, None, None)]
    df = spark.createDataFrame(data, "location_id string, timestamp string, rainfall_mm double, pressure double, humidity double"
                               ).withColumn("timestamp", F.to_timestamp("timestamp"))
    out = SS.run_append(SS.station_history(ended(df, "t_ties")), "t_ties_out").orderBy("timestamp").collect()
    assert [r.rain_last_5min for r in out] == [1.0, 7.0, 7.0, 0.0]
    assert [r.pressure_drop_5min for r in out] == [0.0, 10.0, 10.0, 0.0]


def test_station_stream_equals_batch(spark):
    g = fx.sensor_grid(spark, SF001)
    batch = W.history_features_station(g).select(*KEY, "rain_last_5min", "rain_last_15min", "pressure_drop_5min",
                                                 "pressure_drop_15min", "humidity_change")
    stream = SS.run_append(SS.station_history(ended(g, "t_station")), "t_station_out")
    assert rows(stream, batch.columns) == rows(batch, batch.columns)


def test_serving_stream_equals_batch(spark):
    g = fx.sensor_raw(spark, SF001)
    cols = ["rain_last_5min", "rain_last_15min", "pressure_drop_15min", "humidity_change"]
    batch = W.history_features_predict(g).select(*KEY, *cols)
    stream = SS.run_append(SS.serving_history(ended(g, "t_serve")), "t_serve_out").select(*KEY, *cols)
    assert rows(stream, KEY + cols) == rows(batch, KEY + cols)


def test_sky_stream_equals_batch(spark):
    f = fx.frames(spark, SF001)
    e = RC.ema(f, ["brightness", "cloud_fraction", "texture_index"], 0.3, spec=CAM)
    e = W.trend20(e.withColumnRenamed("brightness", "b_raw").withColumnRenamed("brightness_ema", "brightness")
                   .withColumnRenamed("cloud_fraction", "c_raw").withColumnRenamed("cloud_fraction_ema", "cloud_fraction")
                   .withColumnRenamed("texture_index", "t_raw").withColumnRenamed("texture_index_ema", "texture_index"),
                  ["brightness", "cloud_fraction", "dark_fraction", "texture_index"], 20, spec=CAM)
    batch = e.select("camera_id", "timestamp", F.col("brightness").alias("brightness_ema"),
                     F.col("trend20_brightness_slope"), F.col("trend20_dark_fraction_slope"))
    vg = SKY.vertical_growth(f, CAM).select("camera_id", "timestamp", "darkening_rate", "vertical_growth_flag")
    out = SS.run_append(SS.sky_trend_stream(ended(f, "t_sky", "camera_id")), "t_sky_out")
    cols = ["camera_id", "timestamp", "brightness_ema", "trend20_brightness_slope", "trend20_dark_fraction_slope"]
    assert rows(out, cols) == rows(batch, cols)
    cols2 = ["camera_id", "timestamp", "darkening_rate", "vertical_growth_flag"]
    assert rows(out, cols2) == rows(vg, cols2)


def test_hysteresis_stream_equals_batch(spark):
    s0 = fx.scored(spark, SF001).select(*KEY, "probability")
    batch = AL.alert_hysteresis(s0, threshold=0.2).select(*KEY, "alert")
    stream = SS.run_append(SS.hysteresis_stream(ended(s0, "t_hyst"), 0.2), "t_hyst_out").select(*KEY, "alert")
    assert rows(stream, KEY + ["alert"]) == rows(batch, KEY + ["alert"])


def test_no_held_out_row_trains_the_fit(spark):
    """More rows than the fit samples: rows that a fit's fold holds out, in the whole
    table, are in no training part of the sample."""
    df = spark.range(3000).select((F.col("id") % 7).cast("string").alias("location_id"), F.col("id").alias("timestamp"),
                                  F.rand(1).alias("x"), (F.col("id") % 9 == 0).cast("int").alias("y"))
    keys = ["location_id", "timestamp"]
    dealt = ML.ensemble_rows(df, ["x"], "y", (42, 10), 3, keys, 400)
    assert 300 < dealt.count() / 6 < 500
    for seed in (42, 10):
        for held in range(3):
            own = dealt.where((F.col("_seed") == seed) & (F.col("_held") == held))
            trained, out = own.where(F.col("fold") != held), ML.hashed_folds(df, 3, keys, seed).where(F.col("fold") == held)
            assert trained.join(out, keys, "left_semi").count() == 0
            assert own.where(F.col("fold") == held).join(out, keys, "left_anti").count() == 0
            assert 800 < out.count() < 1200


def test_load_or_train(spark):
    from cumulus.session import scratch_dir
    path, calls = scratch_dir(spark, "models/test"), []

    def model(load=None):
        return ML.load_or_train(spark, path, lambda: calls.append(1) or 7.5,
                                load or (lambda p: spark.read.parquet(p).first()[0]),
                                lambda m, p: spark.createDataFrame([(m,)], "m double").write.mode("overwrite").parquet(p))

    assert [model(), model(), len(calls)] == [7.5, 7.5, 1]

    def damaged(p):
        raise OSError("damaged")
    assert model(damaged) == 7.5 and len(calls) == 2
