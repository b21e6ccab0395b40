"""Isolation forest: rows that trees draw are found by the same hash, paths are walked alike."""

import numpy as np
from pyspark.sql import functions as F

from cumulus.operators import ml as ML


def test_the_hash_is_sparks(spark):
    df = spark.range(300).select(F.xxhash64("id").alias("r"), (F.col("id") % 7).alias("t"))
    rows = df.withColumn("h", F.xxhash64("r", "t")).toPandas()
    with np.errstate(over="ignore"):
        own = ML._hash_long(rows["r"].to_numpy().view(np.uint64), np.uint64(42))
        got = ML._hash_long(rows["t"].to_numpy().astype(np.uint64), own).view(np.int64)
    assert np.array_equal(got, rows["h"].to_numpy())


def test_rows_that_no_tree_draws_are_dropped_and_no_others(spark):
    share, trees = 2_000_000, 20
    df = spark.range(20_000).select(F.xxhash64("id").alias("r"))
    drawn = F.exists(F.sequence(F.lit(0).cast("long"), F.lit(trees - 1).cast("long")),
                     lambda t: F.pmod(F.xxhash64("r", t), F.lit(1_000_000_000)) < share)
    want = {r[0] for r in df.where(drawn).collect()}
    assert 500 < len(want) < 1100 and {r[0] for r in df.where(ML._drawn(trees, share)("r")).collect()} == want


def test_forecast_rows_are_computed_once(spark):
    df = spark.range(200).select(F.lit("a").alias("location_id"), F.timestamp_seconds(F.col("id") * 60).alias("timestamp"),
                                 (F.col("id") % 17).cast("double").alias("temperature"))
    _, lags = ML.temp_forecast(df)
    assert lags.count() == 197 and "Window" not in lags._jdf.queryExecution().executedPlan().toString()
