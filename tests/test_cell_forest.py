"""Forests over cells of equal binned rows: whole, few passes, the splits of plain search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cumulus.operators import boosting as B
from cumulus.operators import forest as CF
from cumulus.operators import ml as ML

COLS = ["a", "b", "c"]


def table(spark, n):
    h = [F.pmod(F.xxhash64("id", F.lit(i)), F.lit(m)).cast("double") for i, m in enumerate((500, 20, 7))]
    df = spark.range(n, numPartitions=3).select("id", *[x.alias(c) for x, c in zip(h, COLS)], F.lit(2.0).alias("w"))
    return df.withColumn("y", F.when((F.col("a") > 350) & (F.col("b") < 12), 1).when(F.col("c") > 5, 2).otherwise(0))


def test_all_rows_are_in_the_cells_and_cells_are_few(spark):
    df = table(spark, 30_000)
    edges = B.borders(df, COLS, CF.BINS)
    cells = CF.collected(CF.cells_of(df, COLS, "y", "w", edges), 3)
    assert cells.n.sum() == 30_000 and len(cells.n) < 10_000 and cells.weights.tolist() == [2.0]
    codes = CF.unpack(cells.longs, 3)
    rows = df.toPandas()
    want, times = np.unique(np.column_stack([CF.bin_codes(rows[COLS].to_numpy(), edges), rows["y"]]), axis=0, return_counts=True)
    got = np.column_stack([codes, cells.y])
    at = np.lexsort(got.T[::-1])
    assert np.array_equal(got[at], want) and np.array_equal(cells.n[at], times)


def test_a_forest_takes_few_passes(spark):
    """A job for each level of each 25 trees before."""
    spark.sparkContext.setJobGroup("forest", "forest")
    f = ML.grow_forest(table(spark, 4000), COLS, "y", 50, 30, 42, "w")
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("forest")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) < 30 and [p.getNumTrees for p in f.parts] == [25, 25]
    out = f.transform(ML.assemble(table(spark, 4000), COLS)).toPandas()
    assert (out["prediction"] == out["y"]).mean() > 0.97


def test_more_cells_than_a_task_holds_go_to_spark(spark, monkeypatch):
    monkeypatch.setattr(CF, "MOST_CELLS", 10)
    f = ML.grow_forest(table(spark, 500), COLS, "y", 4, 5, 42, "w")
    assert len(f.parts[0].trees) == 4 and f.parts[0].numClasses == 3
    assert f.transform(ML.assemble(table(spark, 500), COLS)).where("prediction = y").count() > 400


def test_rows_without_a_label_are_an_error(spark):
    with pytest.raises(ValueError):
        ML.grow_forest(table(spark, 50).withColumn("y", F.when(F.col("id") > 3, F.col("y"))), COLS, "y", 2, 3, 1)
    with pytest.raises(ValueError):
        ML.grow_forest(table(spark, 50).where("id < 0"), COLS, "y", 2, 3, 1)


def test_rows_without_a_value_are_an_error(spark):
    for odd in (None, float("nan"), float("inf")):
        with pytest.raises(ValueError):
            ML.grow_forest(table(spark, 50).withColumn("b", F.when(F.col("id") == 7, F.lit(odd)).otherwise(F.col("b"))), COLS, "y", 2, 3, 1)


def test_splits_are_the_best_ones():
    rng = np.random.default_rng(3)
    n, nodes, classes = 900, 40, 3
    node = np.sort(np.r_[np.arange(nodes), rng.integers(0, nodes, n - nodes)])
    code, y, w = rng.integers(0, 32, n), rng.integers(0, classes, n), rng.integers(1, 4, n) / 2
    dense, sparse = (f(nodes, node, code, y, w, classes) for f in (CF._best_dense, CF._best_sparse))
    for i in range(nodes):
        own = node == i
        total = np.bincount(y[own], w[own], classes)
        gini = lambda t: 1 - ((t / t.sum()) ** 2).sum()
        best = -np.inf
        for b in range(31):
            left = np.bincount(y[own & (code <= b)], w[own & (code <= b)], classes)
            if 0 < left.sum() < total.sum():
                right = total - left
                best = max(best, gini(total) - (left.sum() * gini(left) + right.sum() * gini(right)) / total.sum())
        for gain, bins, left in (dense, sparse):
            assert gain[i] == pytest.approx(best, abs=1e-9) if best > -np.inf else gain[i] == -np.inf
            if best > -np.inf:
                assert np.allclose(left[i], np.bincount(y[own & (code <= bins[i])], w[own & (code <= bins[i])], classes))


def grown(n, depth, seed=0):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, 4))
    X[::40, 1] = np.nan
    y = ((X[:, 0] > 0.3) & (rng.random(n) < 0.7)).astype(np.int16)
    edges = [np.sort(rng.choice(X[:, j][~np.isnan(X[:, j])], 31, replace=False)) for j in range(4)]
    codes = CF.bin_codes(X, edges)
    cells = CF.Cells(CF.pack(codes), y, np.array([1.0]), np.zeros(n, dtype=np.uint8), np.ones(n, dtype=np.int32), 4)
    return X, edges, codes, CF.grow(cells, codes, 2, 2, depth, [seed, 1])


def test_votes_walk_the_tree_and_nan_goes_right():
    X, edges, codes, tree = grown(3000, 30)
    assert (codes[::40, 1] == 31).all()
    out = np.zeros((3000, 2))
    tree.vote(codes, out)
    for i in range(0, 3000, 37):
        at = 0
        while tree.feature[at] >= 0:
            at = tree.left[at] + (codes[i, tree.feature[at]] > tree.bin[at])
        assert np.array_equal(out[i], tree.shares[tree.left[at]])
    # two leaves under one node never predict one class
    leaf = tree.feature < 0
    inner = np.flatnonzero(~leaf)
    low, high = tree.left[inner], tree.left[inner] + 1
    both = leaf[low] & leaf[high]
    assert (tree.shares[tree.left[low[both]]].argmax(axis=1) != tree.shares[tree.left[high[both]]].argmax(axis=1)).all()
    assert tree.importances.sum() == pytest.approx(1) and tree.importances.argmax() == 0


def test_depth_is_bounded():
    tree = grown(500, 2)[3]
    assert 1 < len(tree.feature) <= 7
    assert len(grown(500, 0)[3].feature) == 1


def test_few_rows_of_bins_are_scored_once():
    X, edges, codes, tree = grown(3000, 30)
    short = [e[:5] for e in edges]
    votes = CF.Votes([tree], short, 2)
    assert np.array_equal(votes.score(X), votes.shares(CF.bin_codes(X, short)))
    assert votes.table is not None and votes.__getstate__()["table"] is None
    wide = CF.Votes([tree], edges, 2)
    assert np.array_equal(wide.score(X), wide.shares(codes)) and wide.table is None
