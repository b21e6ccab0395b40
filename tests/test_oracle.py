"""Representative registered queries against their DuckDB oracle SQL on
the smallest scale (the full set runs in tools/check_oracle.py)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_oracle import TABLES, rows_of  # noqa: E402
from conftest import SF001  # noqa: E402

NAMES = ["history_features_station", "interpolate_limit", "error_filters", "savgol_11_2", "kalman_1d",
         "alert_hysteresis", "roc_auc", "f1_sweep", "insert_or_ignore", "pipeline_a_features", "periodogram",
         "stuck_sensor", "model_input", "optical_stats", "quantile_thresholds", "station_history_state",
         "alert_hysteresis_stream", "tip_pulse_tumbling", "dedup_stream", "stream_tail_csv", "publish_alerts",
         "stratified_split", "stratified_folds", "union_augmented", "label_histogram"]


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    from __spark_entry__ import oracle_sql, queries
    df = queries()[name](spark, SF001)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert got == rows_of(cols, cur.fetchall())
