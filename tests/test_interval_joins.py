"""Range and as-of joins of two tables against plain loops."""

import datetime as dt
import random

import pytest

from cumulus.operators import interval_joins as IJ
from cumulus.operators import series as S

T0 = dt.datetime(2024, 7, 1)
SEC = 1_000_000


def at(s):
    return None if s is None else T0 + dt.timedelta(seconds=s)


def tables(spark, seed=1):
    rnd = random.Random(seed)
    left = [(rnd.choice(["hot"] * 5 + ["a", "b", None]), rnd.randint(0, 900), n) for n in range(300)]
    left += [("a", None, 900), ("only-left", 5, 901), left[0]]
    right = [(rnd.choice(["hot"] * 4 + ["a", "b", None]), rnd.randint(0, 900), n) for n in range(120)]
    right += [("a", None, 500), ("only-right", 5, 501), right[0], ("hot", 450, 7), ("hot", 450, 9)]
    schema = "k string, t timestamp, v int"
    return (left, right, spark.createDataFrame([(k, at(t), v) for k, t, v in left], schema),
            spark.createDataFrame([(k, at(t), v) for k, t, v in right], schema))


def pairs(left, right, back, ahead):
    return [(a, b) for a in left for b in right if None not in (a[0], a[1], b[1]) and a[0] == b[0]
            and a[1] - back <= b[1] <= a[1] + ahead]


@pytest.mark.parametrize("back,ahead", [(30, 0), (30, 20), (0, 0), (0, 400)])
@pytest.mark.parametrize("part_rows", [5, 10 ** 6])
def test_range_join(spark, back, ahead, part_rows):
    left, right, l_df, r_df = tables(spark)
    want = [(a[0], at(a[1]), a[2], at(b[1]), b[2]) for a, b in pairs(left, right, back, ahead)]
    got = IJ.range_join(l_df, r_df, ["k"], "t", "t", back * SEC, ahead * SEC, part_rows=part_rows)
    assert got.columns == ["k", "t", "v", "t_right", "v_right"]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    matched = {a for a, _ in pairs(left, right, back, ahead)}
    want += [(k, at(t), v, None, None) for k, t, v in left if (k, t, v) not in matched]
    got = IJ.range_join(l_df, r_df, ["k"], "t", "t", back * SEC, ahead * SEC, "left", part_rows=part_rows)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("tolerance", [None, 25])
@pytest.mark.parametrize("spec", [S.DEFAULT, S.SeriesSpec(bucket_us=60 * SEC, chunk_rows=7)])
def test_asof_join(spark, tolerance, spec):
    left, right, l_df, r_df = tables(spark, 2)
    want = []
    for k, t, v in left:
        hits = [b for b in right if None not in (k, t, b[1]) and b[0] == k and b[1] <= t]
        best = max(hits, key=lambda b: (b[1], b[2]), default=None)
        if best and tolerance is not None and t - best[1] > tolerance:
            best = None
        want.append((k, at(t), v, at(best[1]) if best else None, best[2] if best else None))
    got = IJ.asof_join(l_df, r_df, ["k"], "t", "t", tolerance and tolerance * SEC, spec=spec)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_empty_sides(spark):
    _, _, l_df, r_df = tables(spark)
    assert IJ.range_join(l_df.limit(0), r_df, ["k"], "t", "t", SEC).count() == 0
    assert IJ.range_join(l_df, r_df.limit(0), ["k"], "t", "t", SEC).count() == 0
    assert IJ.asof_join(l_df.limit(0), r_df, ["k"], "t", "t").count() == 0
    assert IJ.asof_join(l_df, r_df.limit(0), ["k"], "t", "t").where("t_right is null").count() == l_df.count()
