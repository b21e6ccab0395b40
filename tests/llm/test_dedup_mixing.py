import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cumulus.llm import dedup, mixing

DOCS = [(1, "a  b"), (2, "a b"), (3, "a\t\nb"), (4, " a b"), (5, None), (6, ""), (None, "a b"), (None, "only"),
        (None, "only"), (7, "x"), (7, "x"), (8, "x"), (9, "a b"), (10, "y " * 50000), (0, "y\n" * 50000)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "doc_id long, text string, h string, body int")


@pytest.mark.parametrize("hash_fn", [dedup.hash128, lambda c: F.unhex(F.substring(F.md5(c.cast("binary")), 1, 2)),
                                     lambda c: F.lit(b"one")])
def test_exact_duplicates(spark, hash_fn):
    import hashlib
    import re
    groups = defaultdict(list)
    for i, t in DOCS:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    want = []
    for body, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep, first = min(known, default=None), True
        sha = hashlib.sha256(body.encode()).hexdigest()
        for i in sorted(ids, key=lambda i: (i is None, i)):
            want.append((i, keep, len(ids), first and i == keep, sha))
            first = first and i != keep
    df = frame(spark, DOCS)
    got = [tuple(r) for r in dedup.exact_duplicates(df, hash_fn=hash_fn).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()]
    key = str
    assert sorted(got, key=key) == sorted(want, key=key)
    kept = dedup.drop_exact_duplicates(df, hash_fn=hash_fn)
    assert kept.columns == df.columns and kept.count() == len(groups)
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(
        (min((i for i in v if i is not None), default=None) for v in groups.values()), key=str)


def test_exact_duplicates_of_nothing(spark):
    empty = frame(spark, DOCS).limit(0)
    assert dedup.exact_duplicates(empty).count() == 0 and dedup.drop_exact_duplicates(empty).count() == 0


def test_many_repeats_of_one_row(spark, monkeypatch):
    monkeypatch.setattr(dedup, "STEP", 7)
    df = spark.createDataFrame([(1, "a")] * 20 + [(2, "a")], "doc_id long, text string")
    got = dedup.exact_duplicates(df)
    assert got.count() == 21 and got.where("kept").count() == 1 and got.where("group_size = 21").count() == 21


def water_levels(sizes, weights, share, most):
    """Targets by pouring: fill, cap, share the rest again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, open_, left = {}, set(names), share * sum(sizes.values())
    while open_:
        level = left / sum(w[s] for s in open_)
        full = {s for s in open_ if level * w[s] >= most * sizes[s]}
        if not full:
            return target | {s: level * w[s] for s in open_}
        for s in full:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def test_mix(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.choice(["a", "b", "c", "é", None, "A"]), " ".join(["w"] * rnd.randint(0, 40))) for i in range(600)]
    rows += [(i, "hot", "w w\n\tw") for i in range(600, 1000)] + [(1000, "a", None), (None, "b", "x y"), (None, "b", "x y"),
                                                                  (7, "zero", ""), (8, "long", "w " * 30000)]
    df = spark.createDataFrame([(*r, -1.0) for r in rows], "doc_id long, source string, text string, target double")
    got = mixing.mix(df).collect()
    sizes = defaultdict(int)
    for _, s, t in rows:
        sizes[s] += len((t or "").split())
    want = water_levels(sizes, [5, 2, 1], 1.5, 2.0)
    taken = defaultdict(int)
    for r in got:
        assert r["size"] == len((r.text or "").split()) and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r["size"]
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in sizes)
    assert len(got) == len(rows)
    again = mixing.mix(df.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    # one source can't have several rows in part
    part = defaultdict(int)
    for r in got:
        part[r.source] += r["size"] > 0 and r.taken % r["size"] != 0
    assert max(part.values()) <= 1
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns and out.where("target = -1.0").count() == out.count()
    # whole texts only: the one at the cut as often as is nearest
    texts = Counter((r.source, r.text) for r in out.collect())
    want = Counter()
    for r in got:
        if r["size"]:
            want[r.source, r.text] += int(r.taken / r["size"] + 0.5)
    assert texts == +want


def test_mix_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, source string, text string")
    assert mixing.mix(df).count() == 0 and mixing.mixed_documents(df).count() == 0
    df = spark.createDataFrame([(1, "a", None), (2, None, " ")], "doc_id long, source string, text string")
    assert [(r["size"], r.taken) for r in mixing.mix(df).collect()] == [(0, 0)] * 2


def test_rows_without_id_spread_over_the_ranges(spark):
    """A third of the rows has no id: no range of the keys is far above the others."""
    df = spark.range(30000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.lit("hot").alias("source"),
                                   F.concat(F.lit("w "), F.col("id").cast("string")).alias("text"))
    key = mixing.random_key(F.col("doc_id"), F.col("text"), "mix-1")
    sizes = [r["count"] for r in df.groupBy(F.substring(key, 1, 2)).count().collect()]
    assert len(sizes) == 256 and max(sizes) < 3 * sorted(sizes)[128]
    got = mixing.mix(df)
    assert got.agg(F.sum("taken")).first()[0] == 90000
    # rows without an id are drawn as the others are, about half of them twice
    shares = {r[0]: r[1] for r in got.groupBy(F.col("doc_id").isNull()).agg(F.avg(F.col("taken") / F.col("size"))).collect()}
    assert abs(shares[True] - 1.5) < 0.05 and abs(shares[False] - 1.5) < 0.05
