"""Sinks: feature CSV in fixed column order, error log, prediction JSON,
alert publishing through a caller-supplied callback."""

from __future__ import annotations

import logging
from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOG = logging.getLogger(__name__)


def write_features_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    """Header once per file, columns in the given order, no index."""
    df.select(*columns).write.mode("overwrite").option("header", True).csv(path)


def error_log(df: DataFrame, path: str | None = None, flag: str = "any_error") -> DataFrame:
    """Rows with any error flag; written to ``path`` when it is given and
    the log is not empty (the caller persists ``df`` when it feeds two
    sinks)."""
    errs = df.where(F.col(flag))
    if path is not None and errs.limit(1).count() > 0:
        errs.write.mode("overwrite").parquet(path)
    return errs


PREDICTION_COLUMNS = ["timestamp", "location_id", "probability", "risk_level", "alert", "used_threshold"]


def latest_predictions(pred: DataFrame, key: str = "location_id", ts: str = "timestamp") -> DataFrame:
    """Newest prediction per station (partial max_by), probability to 6."""
    others = [c for c in PREDICTION_COLUMNS if c not in (key,)]
    g = pred.groupBy(key).agg(F.max_by(F.struct(*others), F.col(ts)).alias("_m"))
    out = g.select(key, *[F.col(f"_m.{c}").alias(c) for c in others])
    return out.withColumn("probability", F.round("probability", 6))


def write_predictions_json(pred: DataFrame, path: str) -> DataFrame:
    """Latest prediction per station as JSON documents."""
    latest = latest_predictions(pred)
    latest.select(*PREDICTION_COLUMNS).write.mode("overwrite").json(path)
    return latest


def publish_alerts(pred: DataFrame, callback: Callable[[DataFrame, int], None], batch_id: int = 0) -> bool:
    """Hand a result batch to a subscriber; True if it took it.  A failing
    subscriber is logged and does not stop the job."""
    try:
        callback(pred, batch_id)
    except Exception:  # noqa: BLE001 - whatever a subscriber raises, the job goes on
        LOG.exception("subscriber failed on batch %s", batch_id)
        return False
    return True


def alert_sink(*callbacks: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that hands every micro-batch to each subscriber."""
    def send(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            for c in callbacks:
                publish_alerts(batch, c, batch_id)
        finally:
            batch.unpersist()
    return send
