"""Views over the given test tables that yield rows in the schemas the
operators expect (see FIXTURES.md).

These builders only reshape columns of ``events``, ``embeddings``,
``lineitem`` and ``nation``; they do none of an operator's work.  Each view
exists twice: as a Spark DataFrame builder and as a DuckDB CTE body, so the
oracle SQL reads exactly the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- Spark side

_GRID_SQL = [
    "concat('loc_', cast(event_id % 10 + 1 as string)) as location_id",
    "timestampadd(MINUTE, event_id div 10, timestamp'2024-07-01 00:00:00') as timestamp",
    "round(value / 10, 3) as rainfall_mm",
    "cast(get_json_object(props, '$.k') as double) as humidity",
    "1008.0D + (event_id * 7 % 80) / 10.0D as pressure",
    "16.0D + (event_id * 11 % 160) / 10.0D as temperature",
    "2.0D + (event_id * 13 % 280) / 10.0D as wind_gust",
    "case when event_id % 5 = 0 then null else value / 8 end as satellite_precip",
    "case when event_id % 7 = 0 then null else 15.0D + (event_id * 17 % 400) / 10.0D end as radar_dbz",
    "case when event_type = 'error' and value > 60 then 1 else 0 end as cloudburst",
]

GRID_COLUMNS = ["location_id", "timestamp", "rainfall_mm", "humidity", "pressure",
                "temperature", "wind_gust", "satellite_precip", "radar_dbz", "cloudburst"]


def _grid_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.selectExpr("event_id", "event_id div 10 as m", "value", "event_type", "user_id",
                         "cast(ts as timestamp) as ts", *_GRID_SQL)


def sensor_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regular one-minute readings for ten stations."""
    return _grid_base(spark, sf_dir).select(*GRID_COLUMNS)


def sensor_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sensor_grid`` with gaps, spikes, out-of-range and stuck values."""
    b = _grid_base(spark, sf_dir)
    return b.select(
        "location_id", "timestamp",
        F.expr("case when event_id % 97 = 0 then -1.0D else rainfall_mm end").alias("rainfall_mm"),
        F.expr("humidity * 1.2D").alias("humidity"),
        F.expr("case when m % 50 < 8 then null when m % 40 = 17 then pressure + 10.0D "
               "else pressure end").alias("pressure"),
        F.expr("case when m % 60 between 30 and 54 then 20.0D else temperature end").alias("temperature"),
        "wind_gust", "satellite_precip", "radar_dbz", "cloudburst")


def sensor_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Irregular readings: station from ``user_id``, time from ``ts``."""
    b = _grid_base(spark, sf_dir)
    return b.select(
        F.expr("concat('loc_', cast(user_id % 10 + 1 as string))").alias("location_id"),
        F.col("ts").alias("timestamp"),
        *[c for c in GRID_COLUMNS[2:]])


def raw_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pipeline-B logger columns (temp_C, humidity, pressure, rain_mm, wind_speed)."""
    d = sensor_dirty(spark, sf_dir)
    return d.select("location_id", "timestamp",
                    F.col("temperature").alias("temp_C"), "humidity", "pressure",
                    F.col("rainfall_mm").alias("rain_mm"),
                    F.col("wind_gust").alias("wind_speed"),
                    "satellite_precip", "cloudburst")


#: Seconds between the readings of the fast stations of mixed_rate.
FAST_GAP_S = 10


def mixed_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Temperature and pressure without gaps; three of the ten stations have a reading
    every ten seconds, the others one a minute."""
    b = _grid_base(spark, sf_dir)
    gap = F.expr(f"case when event_id % 10 < 3 then {FAST_GAP_S} else 60 end")
    return b.select("location_id", F.timestamp_micros(
        F.unix_micros(F.lit("2024-07-01 00:00:00").cast("timestamp")) + F.col("m") * gap * 1_000_000).alias("timestamp"),
        F.col("temperature").alias("temp_C"), "pressure")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station keys with a given probability and the label."""
    b = _grid_base(spark, sf_dir)
    return b.select("location_id", "timestamp",
                    F.expr("round(value / 500, 6)").alias("probability"),
                    F.col("cloudburst").alias("label"))


def events_keyed(spark: SparkSession, sf_dir: str, event_type: str) -> DataFrame:
    """``tips`` (click) or ``pulses`` (view): one row per counted event."""
    ev = table(spark, sf_dir, "events")
    return (ev.where(F.col("event_type") == event_type)
              .select(F.expr("concat('loc_', cast(user_id % 10 + 1 as string))").alias("location_id"),
                      F.col("ts").cast("timestamp").alias("timestamp")))


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """8x8 grey frames from ``embeddings``: (frame, y, x, v)."""
    em = table(spark, sf_dir, "embeddings")
    return (em.select("vec_id", F.posexplode("embedding").alias("pos", "e"))
              .select(F.col("vec_id").alias("frame"),
                      F.expr("pos div 8").cast("int").alias("y"),
                      F.expr("pos % 8").cast("int").alias("x"),
                      F.expr("cast(greatest(0, least(255, floor((cast(e as double) + 0.5D) * 255))) as int)")
                      .alias("v")))


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-frame sky features for ten cameras."""
    b = _grid_base(spark, sf_dir)
    return b.select(
        F.col("location_id").alias("camera_id"), "timestamp",
        F.expr("humidity * 2.5D").alias("brightness"),
        F.expr("humidity / 100.0D").alias("dark_fraction"),
        F.expr("cast(event_id % 100 as double) / 100.0D").alias("cloud_fraction"),
        F.expr("cast(event_id % 12 as double)").alias("texture_index"))


def flow_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("frame"),
                     (F.col("l_quantity") - 25.0).alias("vx"),
                     F.round(F.col("l_discount") * 100.0 - 5.0, 4).alias("vy"))


def location_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select(
        F.expr("concat('loc_', cast(n_nationkey + 1 as string))").alias("location_id"),
        F.expr("29.0D + n_nationkey / 10.0D").alias("latitude"),
        F.expr("78.0D + n_nationkey / 10.0D").alias("longitude"))


def meta_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("event_type").alias("key"), F.col("props").alias("value"),
                     F.col("event_id").alias("seq"))


def duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sensor_grid`` plus repeated arrivals of every third row."""
    b = _grid_base(spark, sf_dir)
    first = b.select(*GRID_COLUMNS, F.lit(0).alias("arrival"), F.col("event_id").alias("seq"))
    again = (b.where("event_id % 3 = 0")
              .select(*GRID_COLUMNS, F.lit(1).alias("arrival"), F.col("event_id").alias("seq")))
    return first.unionByName(again)


# ---------------------------------------------------------------- DuckDB side

_GRID_DUCK = """
  SELECT event_id, event_id // 10 AS m, value, event_type, user_id, ts,
    'loc_' || CAST(event_id % 10 + 1 AS VARCHAR) AS location_id,
    TIMESTAMP '2024-07-01 00:00:00' + to_minutes(CAST(event_id // 10 AS BIGINT)) AS timestamp,
    round(value / 10, 3) AS rainfall_mm,
    CAST(json_extract_string(props, '$.k') AS DOUBLE) AS humidity,
    CAST(1008.0 AS DOUBLE) + CAST(event_id * 7 % 80 AS DOUBLE) / CAST(10.0 AS DOUBLE) AS pressure,
    CAST(16.0 AS DOUBLE) + CAST(event_id * 11 % 160 AS DOUBLE) / CAST(10.0 AS DOUBLE) AS temperature,
    CAST(2.0 AS DOUBLE) + CAST(event_id * 13 % 280 AS DOUBLE) / CAST(10.0 AS DOUBLE) AS wind_gust,
    CASE WHEN event_id % 5 = 0 THEN NULL ELSE value / 8 END AS satellite_precip,
    CASE WHEN event_id % 7 = 0 THEN NULL
         ELSE CAST(15.0 AS DOUBLE) + CAST(event_id * 17 % 400 AS DOUBLE) / CAST(10.0 AS DOUBLE) END AS radar_dbz,
    CASE WHEN event_type = 'error' AND value > 60 THEN 1 ELSE 0 END AS cloudburst
  FROM events
"""

_G = "location_id, timestamp, rainfall_mm, humidity, pressure, temperature, wind_gust, " \
     "satellite_precip, radar_dbz, cloudburst"

DUCK_VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "grid_base": ((), _GRID_DUCK),
    "sensor_grid": (("grid_base",), f"SELECT {_G} FROM grid_base"),
    "sensor_dirty": (("grid_base",), """
      SELECT location_id, timestamp,
        CASE WHEN event_id % 97 = 0 THEN CAST(-1.0 AS DOUBLE) ELSE rainfall_mm END AS rainfall_mm,
        humidity * CAST(1.2 AS DOUBLE) AS humidity,
        CASE WHEN m % 50 < 8 THEN NULL WHEN m % 40 = 17 THEN pressure + CAST(10.0 AS DOUBLE)
             ELSE pressure END AS pressure,
        CASE WHEN m % 60 BETWEEN 30 AND 54 THEN CAST(20.0 AS DOUBLE) ELSE temperature END AS temperature,
        wind_gust, satellite_precip, radar_dbz, cloudburst
      FROM grid_base"""),
    "sensor_raw": (("grid_base",), """
      SELECT 'loc_' || CAST(user_id % 10 + 1 AS VARCHAR) AS location_id, ts AS timestamp,
        rainfall_mm, humidity, pressure, temperature, wind_gust, satellite_precip, radar_dbz, cloudburst
      FROM grid_base"""),
    "raw_station": (("sensor_dirty",), """
      SELECT location_id, timestamp, temperature AS temp_C, humidity, pressure,
             rainfall_mm AS rain_mm, wind_gust AS wind_speed, satellite_precip, cloudburst
      FROM sensor_dirty"""),
    "mixed_rate": (("grid_base",), f"""
      SELECT location_id, TIMESTAMP '2024-07-01 00:00:00'
               + to_seconds(CAST(m * CASE WHEN event_id % 10 < 3 THEN {FAST_GAP_S} ELSE 60 END AS BIGINT)) AS timestamp,
             temperature AS temp_C, pressure
      FROM grid_base"""),
    "scored": (("grid_base",), """
      SELECT location_id, timestamp, round(value / 500, 6) AS probability, cloudburst AS label
      FROM grid_base"""),
    "tips": ((), """
      SELECT 'loc_' || CAST(user_id % 10 + 1 AS VARCHAR) AS location_id, ts AS timestamp
      FROM events WHERE event_type = 'click'"""),
    "pulses": ((), """
      SELECT 'loc_' || CAST(user_id % 10 + 1 AS VARCHAR) AS location_id, ts AS timestamp
      FROM events WHERE event_type = 'view'"""),
    "pixels": ((), """
      SELECT vec_id AS frame, CAST((i - 1) // 8 AS INTEGER) AS y, CAST((i - 1) % 8 AS INTEGER) AS x,
             CAST(greatest(0, least(255, floor((CAST(embedding[i] AS DOUBLE) + 0.5) * 255))) AS INTEGER) AS v
      FROM embeddings, range(1, len(embedding) + 1) r(i)"""),
    "frames": (("grid_base",), """
      SELECT location_id AS camera_id, timestamp,
             humidity * CAST(2.5 AS DOUBLE) AS brightness, humidity / CAST(100.0 AS DOUBLE) AS dark_fraction,
             CAST(event_id % 100 AS DOUBLE) / CAST(100.0 AS DOUBLE) AS cloud_fraction,
             CAST(event_id % 12 AS DOUBLE) AS texture_index
      FROM grid_base"""),
    "flow_vectors": ((), """
      SELECT l_orderkey AS frame, l_quantity - CAST(25.0 AS DOUBLE) AS vx,
             round(l_discount * 100.0 - 5.0, 4) AS vy
      FROM lineitem"""),
    "location_dim": ((), """
      SELECT 'loc_' || CAST(n_nationkey + 1 AS VARCHAR) AS location_id,
             CAST(29.0 AS DOUBLE) + n_nationkey / CAST(10.0 AS DOUBLE) AS latitude,
             CAST(78.0 AS DOUBLE) + n_nationkey / CAST(10.0 AS DOUBLE) AS longitude
      FROM nation"""),
    "meta_log": ((), "SELECT event_type AS key, props AS value, event_id AS seq FROM events"),
    "duplicates": (("grid_base",), f"""
      SELECT {_G}, 0 AS arrival, event_id AS seq FROM grid_base
      UNION ALL
      SELECT {_G}, 1 AS arrival, event_id AS seq FROM grid_base WHERE event_id % 3 = 0"""),
}


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the CTEs of the named fixture views (and their inputs)."""
    order: list[str] = []

    def add(n: str) -> None:
        for dep in DUCK_VIEWS[n][0]:
            add(dep)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    ctes = ",\n".join(f"{n} AS ({DUCK_VIEWS[n][1]})" for n in order)
    sql = sql.strip()
    if sql.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes},\n{sql[15:]}"
    if sql.upper().startswith("WITH "):
        return f"WITH {ctes},\n{sql[5:]}"
    return f"WITH {ctes}\n{sql}"
