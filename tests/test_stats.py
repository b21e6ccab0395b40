"""Exact distributed quantiles against numpy, forcing refinement passes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cumulus.operators import stats as ST


@pytest.mark.parametrize("final_rows", [1, 7, 100000])
def test_exact_quantiles_global(spark, final_rows):
    rng = np.random.default_rng(3)
    vals = np.concatenate([rng.normal(size=3000), np.full(500, 0.25), rng.exponential(size=700)])
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    qs = [0.0, 0.1, 0.5, 0.75, 0.999, 1.0]
    got = {r["q"]: r["value"] for r in ST.exact_quantiles(df, "v", qs, buckets=16,
                                                            final_rows=final_rows).collect()}
    for q in qs:
        assert got[q] == pytest.approx(float(np.quantile(vals, q)), rel=1e-12, abs=1e-12)


def test_exact_quantiles_grouped(spark):
    rng = np.random.default_rng(5)
    rows = [(int(k), float(v)) for k, v in zip(rng.integers(0, 4, 4000), rng.normal(size=4000))]
    rows += [(9, None)]
    df = spark.createDataFrame(rows, "k int, v double")
    got = {(r["k"], r["q"]): r["value"] for r in
           ST.exact_quantiles(df, "v", [0.5, 0.9], ["k"], buckets=8, final_rows=3).collect()}
    for k in range(4):
        vals = np.array([v for kk, v in rows if kk == k and v is not None])
        for q in (0.5, 0.9):
            assert got[(k, q)] == pytest.approx(float(np.quantile(vals, q)), rel=1e-12)
    assert (9, 0.5) not in got


def test_auc_of_scores_that_differ_in_the_eighth_digit(spark):
    df = spark.range(1000).select((F.col("id") * 1e-8).alias("probability"), (F.col("id") >= 500).cast("int").alias("label"))
    assert ST.roc_auc(df).first().auc == 1.0
    tied = spark.createDataFrame([(0.5, 1), (0.5, 0), (0.1, 0), (0.9, 1)], "probability double, label int")
    assert ST.roc_auc(tied).first().auc == 0.875
    assert ST.roc_auc(tied.where("label = 1")).first().auc is None
    assert ST.roc_auc(tied.limit(0)).first().auc is None


def test_quantiles_over_a_wide_range(spark):
    df = spark.range(400).select(F.when(F.col("id") == 200, 0.0).otherwise(F.signum(F.col("id") - 200.0) * F.pow(F.lit(10.0), F.abs(F.col("id") - 200) - 100)).alias("v"))
    got = ST.exact_quantiles(df, "v", [0.25], final_rows=1).first().value
    assert got == pytest.approx(float(np.quantile([0.0 if i == 200 else (1 if i > 200 else -1) * 10.0 ** (abs(i - 200) - 100) for i in range(400)], 0.25)))


def test_automatic_bins_follow_the_rule(spark):
    import numpy as np
    from cumulus.operators import stats as ST
    rng = np.random.default_rng(3)

    def bins(x):
        return ST.automatic_bins(spark.createDataFrame([(float(v),) for v in x] + [(None,)], "x double"), "x")

    for x in (rng.normal(size=400), rng.exponential(size=90), np.full(7, 3.0), np.arange(5.0)):
        assert bins(x) == len(np.histogram_bin_edges(x, "auto")) - 1
    assert bins(np.repeat([0.0, 1.0], [95, 5])) == 8  # no spread between the quartiles: log2(100) + 1, rounded up
    assert ST.automatic_bins(spark.createDataFrame([], "x double"), "x") == 1


def test_sketch_rank_error(spark):
    import numpy as np
    from cumulus.operators import stats as ST
    from pyspark.sql import functions as F
    n, accuracy = 200_000, 200
    df = spark.range(n).select((F.xxhash64("id") % 1_000_003).cast("double").alias("x"), (F.col("id") % 2).alias("g"))
    every = {g: np.sort([r.x for r in df.where(F.col("g") == g).collect()]) for g in (0, 1)}
    for r in ST.approximate_quantiles(df, ["x"], [0.01, 0.5, 0.99], ["g"], accuracy).collect():
        rank = np.searchsorted(every[r.g], r.value, side="right")
        assert abs(rank - r.q * len(every[r.g])) <= len(every[r.g]) / accuracy + 1
    plan = ST.approximate_quantiles(df, ["x"], [0.5], [], accuracy)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
