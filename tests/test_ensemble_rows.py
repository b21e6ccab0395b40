"""The ensemble is fitted on all labelled rows, whatever their number."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from cumulus.operators import boosting as B
from cumulus.operators import ml as ML

KEYS = ["location_id", "timestamp"]


def readings(spark, n):
    return spark.range(n, numPartitions=5).select(
        (F.col("id") % 7).cast("string").alias("location_id"), F.col("id").alias("timestamp"),
        (F.pmod(F.xxhash64("id"), F.lit(1000)) / 10.0).alias("x"),
        F.when(F.col("id") % 50 > 0, (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(9))).cast("double")).alias("z"),
        F.when(F.col("id") % 20 > 0, (F.pmod(F.xxhash64("id"), F.lit(1000)) > 800).cast("int")).alias("y"))


def test_every_labelled_row_trains_or_calibrates_each_fit(spark):
    df, edges = readings(spark, 23_000), [np.array([50.0]), np.array([4.5])]
    parts = ML.ensemble_parts(df, ["x", "z"], "y", (42, 10), 3, KEYS, edges).toPandas()
    labelled = df.where("y is not null")
    n = labelled.count()
    assert n > 20_000 and set(parts.groupby("fit")["n"].sum()) == {n} and sorted(set(parts["fit"])) == list(range(6))
    for i, seed in enumerate((42, 10)):
        folds = {r.fold: r["count"] for r in ML.hashed_folds(labelled, 3, KEYS, seed).groupBy("fold").count().collect()}
        for held in range(3):
            own = parts[parts["fit"] == 3 * i + held]
            got = np.concatenate([np.frombuffer(x, dtype=np.uint8) for x in own["fold"]])
            assert dict(zip(*np.unique(got, return_counts=True))) == folds


def test_a_fit_equals_one_on_all_rows_at_once(spark):
    """15,200 labelled rows: above the 10,000 that a sample was bounded to."""
    df = readings(spark, 16_000)
    models = ML.calibrated_ensemble(df, ["x", "z"], "y", seeds=(42,), rounds=4)
    rows = (ML.hashed_folds(df.where("y is not null"), 3, KEYS, 42)
            .withColumn("o", F.xxhash64(*KEYS, "x", "z", "y")).toPandas().sort_values("o", kind="stable"))
    X, y = rows[["x", "z"]].to_numpy(dtype=float), rows["y"].to_numpy(dtype=int)
    edges = B.borders(df.where("y is not null"), ["x", "z"])
    for m in models:
        out = rows["fold"].to_numpy() == m["fold"]
        trees = B.fit_codes(B.bin_codes(X[~out], edges), edges, y[~out], B.Settings(rounds=4), 42 * 31 + m["fold"])
        assert all(np.array_equal(a, b) for a, b in zip(m["trees"].nodes, trees.nodes))
        assert np.allclose((m["a"], m["b"]), B.platt(trees.margin(X[out]), y[out]))


def test_no_labelled_rows_make_no_models(spark):
    assert ML.calibrated_ensemble(readings(spark, 100).withColumn("y", F.lit(None).cast("int")), ["x", "z"], "y", rounds=2) == []


def test_borders_come_from_all_rows(spark):
    rng = np.random.default_rng(1)
    few, many = rng.integers(0, 40, 9000).astype(float), rng.normal(size=9000)
    few[::9] = np.nan
    pdf = pd.DataFrame({"few": few, "many": many, "none": np.nan})
    df = spark.createDataFrame(pdf).withColumn("few", F.when(~F.isnan("few"), F.col("few"))).repartition(6)
    a, b, c = B.borders(df, ["few", "many", "none"])
    assert np.array_equal(a, B._edges(few)) and len(c) == 0
    assert len(b) == B.BINS - 1
    rank = lambda v: np.searchsorted(np.sort(many), v) / len(many)
    assert np.abs(rank(b) - rank(B._edges(many))).max() < 0.001


def test_histograms_of_two_features_at_once_are_those_of_one():
    rng = np.random.default_rng(2)
    codes = rng.integers(0, B.BINS, (5, 6000)).astype(np.uint8)
    grower, g, h = B.Grower(codes, B.Settings(), 1), rng.normal(size=6000), rng.random(6000)
    rows = np.arange(0, 6000, 2)
    got = grower.sums(rows, g, h)
    for f in range(5):
        for own, w in zip(got, (g, h, np.ones(6000))):
            assert np.allclose(own[f], np.bincount(codes[f, rows], w[rows], B.BINS))
    assert np.allclose(got, sum(grower.sums(r, g, h) for r in np.split(rows, 3)))  # small nodes: feature by feature
