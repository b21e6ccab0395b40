"""Readers: typed reading tables from CSV / parquet, station-local text
timestamps, schema validation with a quarantine split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

READING = T.StructType([
    T.StructField("timestamp", T.TimestampType()), T.StructField("location_id", T.StringType()),
    *[T.StructField(c, T.DoubleType()) for c in ("rainfall_mm", "humidity", "pressure", "temperature",
                                                 "wind_gust", "satellite_precip", "radar_dbz")],
    T.StructField("cloudburst", T.IntegerType()),
    *[T.StructField(c, T.DoubleType()) for c in ("rain_last_5min", "rain_last_15min", "pressure_drop_15min",
                                                 "humidity_change", "forecast_30min")],
])


def scan_readings(spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "csv",
                  sort: bool = False) -> DataFrame:
    """Typed reading table (CSV with header, or parquet) with an explicit
    schema, no inference; optionally totally ordered by (location, time)."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        r = r.option("header", True)
    df = r.load(path)
    return df.orderBy("location_id", "timestamp") if sort else df


def parse_station_ts(col, tz: str = "Asia/Kolkata", fmt: str = "dd-MM-yyyy HH:mm"):
    """Station wall-clock text (day first) -> UTC instant."""
    return F.to_utc_timestamp(F.to_timestamp(col, fmt), tz)


def validate_schema(df: DataFrame, required: list[str], numeric: list[str], label: str | None = "cloudburst",
                    ts: str = "timestamp") -> DataFrame:
    """Adds ``valid`` and ``reason`` for text records: required fields
    present, numbers and the timestamp parse (``try_cast``), label in
    {0, 1}.  Split with ``where('valid')`` / ``where('not valid')``."""
    reasons = []
    for c in required:
        reasons.append(F.when(F.col(c).isNull() | (F.col(c).cast("string") == ""), F.lit(f"missing {c}")))
    for c in numeric:
        reasons.append(F.when(F.col(c).isNotNull() & F.expr(f"try_cast(`{c}` as double)").isNull(),
                              F.lit(f"bad {c}")))
    reasons.append(F.when(F.col(ts).isNotNull() & F.expr(f"try_cast(`{ts}` as timestamp)").isNull(),
                          F.lit(f"bad {ts}")))
    if label:
        reasons.append(F.when(F.col(label).isNotNull() & ~F.expr(f"try_cast(`{label}` as int)").isin(0, 1),
                              F.lit(f"bad {label}")))
    reason = F.concat_ws("; ", *reasons)
    return df.withColumn("reason", reason).withColumn("valid", F.col("reason") == "")
