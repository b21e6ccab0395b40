"""Sources, store operations and sinks with literal expectations."""

import datetime as dt

from pyspark.sql import functions as F

from cumulus.sources import readers as RD
from cumulus.sources import sinks as SK
from cumulus.sources import store as ST


def test_parse_station_ts_day_first(spark):
    d = spark.createDataFrame([("01-07-2024 05:30",), ("31-12-2024 00:15",)], "t string")
    got = [r[0] for r in d.select(RD.parse_station_ts(F.col("t"))).collect()]
    assert got == [dt.datetime(2024, 7, 1, 0, 0), dt.datetime(2024, 12, 30, 18, 45)]


def test_validate_schema_quarantine(spark):
    rows = [("a", "2024-07-01 00:00:00", "1000.5", "0"), ("b", "2024-07-01 00:01:00", "abc", "1"),
            (None, "2024-07-01 00:02:00", "999", "0"), ("d", "not a time", "1001", "0"),
            ("e", "2024-07-01 00:03:00", "1002", "7")]
    d = spark.createDataFrame(rows, "location_id string, ts string, pressure string, label string")
    v = RD.validate_schema(d, ["location_id", "ts", "pressure"], ["pressure"], "label", "ts")
    got = {r.location_id: (r.valid, r.reason) for r in v.collect()}
    assert got["a"] == (True, "")
    assert got["b"] == (False, "bad pressure")
    assert got[None] == (False, "missing location_id")
    assert got["d"] == (False, "bad ts")
    assert got["e"] == (False, "bad label")


def test_insert_or_ignore_first_arrival_and_existing(spark):
    inc = spark.createDataFrame([("a", 1, 10.0, 0), ("a", 1, 99.0, 1), ("b", 1, 5.0, 0), ("c", 2, 7.0, 0)],
                                "loc string, t int, v double, arrival int")
    existing = spark.createDataFrame([("c", 2)], "loc string, t int")
    out = {(r.loc, r.t): r.v for r in ST.insert_or_ignore(inc, existing, ["loc", "t"], ["arrival"]).collect()}
    assert out == {("a", 1): 10.0, ("b", 1): 5.0}


def test_upsert_and_read_meta(spark):
    log = spark.createDataFrame([("k", "1", 1), ("k", "2", 3), ("k", "9", 2), ("j", "x", 5)], "key string, value string, seq long")
    t = ST.upsert_last_wins(log)
    assert {r.key: r.value for r in t.collect()} == {"k": "2", "j": "x"}
    assert ST.read_meta(t, "k", "0").first().value == "2"
    assert ST.read_meta(t, "missing", "0.2794").first().value == "0.2794"


def test_latest_reading(spark):
    d = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), 1.0), ("a", dt.datetime(2024, 1, 2), 2.0),
                               ("b", dt.datetime(2024, 1, 3), 3.0)], "location_id string, timestamp timestamp, v double")
    assert ST.latest_reading(d).first().v == 3.0
    per = {r.location_id: r.v for r in ST.latest_reading(d, keys=["location_id"]).collect()}
    assert per == {"a": 2.0, "b": 3.0}


def test_required_fields(spark):
    d = spark.createDataFrame([("ann", "123", "pw"), ("", "1", "p"), ("bo", None, "p")], "name string, phone string, pw string")
    assert [r.name for r in ST.required_fields(d, ["name", "phone", "pw"]).collect()] == ["ann"]


def test_error_log_empty_writes_nothing(spark, tmp_path):
    d = spark.createDataFrame([(1, False)], "id int, any_error boolean")
    path = str(tmp_path / "log")
    assert SK.error_log(d, path).count() == 0
    import os
    assert not os.path.exists(path)


def test_publish_survives_failing_subscriber(spark):
    d = spark.createDataFrame([(1,)], "id int")
    seen = []
    SK.publish_alerts(d, lambda b, i: seen.append(b.count()), 0)
    SK.publish_alerts(d, lambda b, i: 1 / 0, 1)
    assert seen == [1]
