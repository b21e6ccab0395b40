"""The stored table that a stream is merged into, and the start at the newest row."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cumulus.session import scratch_dir
from cumulus.sources.merge import Store, first_wins, last_wins
from cumulus.streaming import streams as SS

SCHEMA = "k string, v string, seq long"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def store(spark):
    return Store(spark, scratch_dir(spark, "store"), spark.createDataFrame([], SCHEMA).schema, ["k"], buckets=8)


def batch(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_upsert_and_replay(spark, store):
    resolve = last_wins(["k"], "seq")
    assert rows(store.read()) == []
    assert store.merge(batch(spark, ("a", "1", 1), ("b", "1", 2), ("a", "2", 3), (None, "n", 4)), 0, resolve)
    assert rows(store.read()) == [("a", "2", 3), ("b", "1", 2), (None, "n", 4)]
    assert store.merge(batch(spark, ("a", "old", 0), ("c", "3", 5), (None, "m", 6)), 1, resolve)
    after = [("a", "2", 3), ("b", "1", 2), ("c", "3", 5), (None, "m", 6)]
    assert rows(store.read()) == after
    folders = store.folders()
    assert not store.merge(batch(spark, ("z", "again", 9)), 1, resolve)  # a batch that comes again
    assert rows(store.read()) == after and store.folders() == folders
    assert store.merge(batch(spark), 2, resolve) and rows(store.read()) == after
    assert store.batches() == [0, 1, 2]


def test_only_touched_buckets_are_written(spark, store):
    resolve = last_wins(["k"], "seq")
    store.merge(batch(spark, *[(f"k{i}", "x", i) for i in range(40)]), 0, resolve)
    before = store.manifest()["current"]
    store.merge(batch(spark, ("k3", "y", 99)), 1, resolve)
    after = store.manifest()["current"]
    assert sum(before[b] != after[b] for b in before) == 1
    assert ("k3", "y", 99) in rows(store.read()) and store.read().count() == 40


def test_failure_before_the_manifest_leaves_the_old_table(spark, store):
    resolve = last_wins(["k"], "seq")
    store.merge(batch(spark, ("a", "1", 1)), 0, resolve)

    def breaks(stored, new):
        return stored.unionByName(new).withColumn("v", F.raise_error(F.lit("lost")))
    with pytest.raises(Exception, match="lost"):
        store.merge(batch(spark, ("a", "2", 2)), 1, breaks)
    assert rows(store.read()) == [("a", "1", 1)]
    assert store.merge(batch(spark, ("a", "2", 2)), 1, resolve)
    assert rows(store.read()) == [("a", "2", 2)]


def test_insert_or_ignore(spark, store):
    resolve = first_wins(["k"], ["seq"])
    store.merge(batch(spark, ("a", "first", 5), ("a", "later", 6)), 0, resolve)
    store.merge(batch(spark, ("a", "earlier but stored second", 1), ("b", "new", 7)), 1, resolve)
    assert rows(store.read()) == [("a", "first", 5), ("b", "new", 7)]


def test_newest_start(spark):
    base = scratch_dir(spark, "newest")
    t0 = dt.datetime(2024, 7, 1)

    def put(name, data):
        spark.createDataFrame([(k, t0 + dt.timedelta(minutes=m)) for k, m in data], "k string, t timestamp").write.parquet(
            f"{base}/in/{name}")

    def run():
        stream = SS.read_stream(spark, f"{base}/in/*", "k string, t timestamp")
        new = SS.start_at_newest(stream, spark.read.parquet(f"{base}/in/*"), base, ["k"], "t")
        new.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/chk").trigger(
            availableNow=True).start().awaitTermination()
        return sorted((r.k, int((r.t - t0).total_seconds() // 60)) for r in spark.read.parquet(f"{base}/out").collect())

    put("one", [("a", 1), ("a", 9), ("b", 4), ("b", 2)])
    assert run() == [("a", 9), ("b", 4)]
    put("two", [("a", 10), ("b", 3), ("b", 8), ("c", 5)])  # b's row at 3 is older than its start
    assert run() == [("a", 9), ("a", 10), ("b", 4), ("b", 8), ("c", 5)]
    assert run() == [("a", 9), ("a", 10), ("b", 4), ("b", 8), ("c", 5)]
