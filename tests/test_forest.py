"""Forests grown in parts on rows that are dealt out; scoring spread over tasks."""

import numpy as np

from cumulus.operators import boosting as B
from cumulus.operators import ml as ML


def test_parts_vote_as_one_forest(spark):
    rows = [(float(i % 7), float(i % 11), int(i % 7 > 3), 1.0) for i in range(400)]
    df = spark.createDataFrame(rows, "a double, b double, y int, w double").coalesce(1)
    f = ML.grow_forest(df, ["a", "b"], "y", 30, 5, 42, "w")
    assert [m.getNumTrees for m in f.parts] == [25, 5]  # one fit of 30 before: all growing trees in the driver
    imp = f.featureImportances.toArray()
    assert abs(imp.sum() - 1) < 1e-9 and imp[0] > imp[1]
    out = f.transform(ML.assemble(df, ["a", "b"]))
    assert out.rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism  # 1 before
    got = out.collect()
    assert len(got) == 400 and all(abs(sum(r.probability) - 1) < 1e-9 for r in got)
    assert all(r.prediction == np.argmax(r.probability.toArray()) for r in got)
    assert sum(r.prediction == r.y for r in got) > 360
    one = f.parts[0].transform(ML.assemble(df, ["a", "b"])).head()
    two = f.parts[1].transform(ML.assemble(df, ["a", "b"])).head()
    same = [r for r in got if (r.a, r.b) == (one.a, one.b)][0]
    assert np.allclose(same.probability.toArray(), one.probability.toArray() * 25 / 30 + two.probability.toArray() * 5 / 30)


def test_scoring_side_by_side_equals_tree_after_tree():
    rng = np.random.default_rng(1)
    X = np.round(rng.normal(size=(3000, 5)), 1)
    X[::50, 2] = np.nan
    trees = B.fit(X, (X[:, 0] > 0.4).astype(int), B.Settings(rounds=130), 7)
    codes, want = B.bin_codes(X, trees.edges), np.full(len(X), trees.start)
    for nodes in trees.nodes:
        masks, values = B.leaf_masks(nodes, 5)
        want += values[B.walk(masks, codes)]
    assert np.array_equal(trees.margin(X), want)
    assert len(trees._groups) == 2  # a tree at a time before
    assert len(trees.margin(X[:0])) == 0
