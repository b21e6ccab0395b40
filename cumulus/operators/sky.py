"""Sky-camera features from pixel tables, flow-vector tables and per-frame
feature series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cumulus.functions import scalar as X
from cumulus.operators import series as S
from cumulus.operators.series import DEFAULT, SeriesSpec

# ---------------------------------------------------------------------------
# Fixed camera-analysis values.
#   region of interest: top 0.7 of the frame rows; dark pixel < 90, cloud pixel < 200
#   flow vectors kept when 0.3 < magnitude < 20
#   vertical growth: darkening > 8 per min with brightness < 170; cloud growth
#   > 0.08 per min with cloud fraction > 0.60; texture growth > 1.5 per min with
#   texture > 6; and class THICK_CONVECTIVE; dt <= 0 -> 0.001 min
#   geometry: 640 px wide, 90 degree field of view, cloud base 2000 m
#   EMA factor 0.3; trend window 20 min; history 3 h
ROI_TOP_FRACTION = 0.7
DARK_THRESHOLD, CLOUD_THRESHOLD = 90, 200
MIN_FLOW_MAG, MAX_FLOW_MAG = 0.3, 20.0
VG = dict(dark_rate=8.0, bright_max=170.0, cloud_rate=0.08, cloud_min=0.60, tex_rate=1.5, tex_min=6.0)
WIDTH_PX, HFOV_DEG, CLOUD_HEIGHT_M = 640, 90.0, 2000.0
EMA_ALPHA = 0.3
# ---------------------------------------------------------------------------


def optical_stats(pixels: DataFrame, frame: str = "frame") -> DataFrame:
    """Per frame over the top 70 % of rows: mean, population std, share of
    pixels < 90 and < 200, mean absolute 4-neighbour Laplacian (borders
    reflected without repeating the edge), thickness class.  Windows are per
    (frame, row) and (frame, column): bounded by the image size."""
    h = Window.partitionBy(frame)
    x = pixels.withColumn("_h", F.max("y").over(h) + 1)
    x = x.where(F.col("y") < F.floor(F.col("_h") * F.lit(ROI_TOP_FRACTION)))
    wr = Window.partitionBy(frame, "y").orderBy("x")
    wc = Window.partitionBy(frame, "x").orderBy("y")
    v = F.col("v").cast("double")
    left = F.coalesce(F.lag(v, 1).over(wr), F.lead(v, 1).over(wr))
    right = F.coalesce(F.lead(v, 1).over(wr), F.lag(v, 1).over(wr))
    up = F.coalesce(F.lag(v, 1).over(wc), F.lead(v, 1).over(wc))
    down = F.coalesce(F.lead(v, 1).over(wc), F.lag(v, 1).over(wc))
    x = x.withColumn("_lap", left + right + up + down - F.lit(4.0) * v)
    agg = x.groupBy(frame).agg(
        F.avg(v).alias("brightness"), F.stddev_pop(v).alias("contrast"),
        F.avg((F.col("v") < DARK_THRESHOLD).cast("double")).alias("dark_fraction"),
        F.avg((F.col("v") < CLOUD_THRESHOLD).cast("double")).alias("cloud_fraction"),
        F.avg(F.abs("_lap")).alias("texture_index"))
    return agg.withColumn("thickness_class", X.thickness_class("brightness", "dark_fraction"))


def flow_summary(vectors: DataFrame, frame: str = "frame", dt_sec: float = 60.0,
                 m_per_px: float | None = None) -> DataFrame:
    """Per frame from its flow vectors: keep 0.3 < magnitude < 20, median
    vx, vy and magnitude (NULL when none kept); heading with y up, compass
    direction and speed in km/h.  A frame's vectors are bounded by its
    pixel count, so the exact per-frame median is a bounded aggregate."""
    if m_per_px is None:
        import math
        m_per_px = 2 * CLOUD_HEIGHT_M * math.tan(math.radians(HFOV_DEG) / 2.0) / WIDTH_PX
    mag = F.sqrt(F.col("vx") ** 2 + F.col("vy") ** 2)
    keep = (mag > MIN_FLOW_MAG) & (mag < MAX_FLOW_MAG)
    x = vectors.withColumn("_mag", mag).withColumn("_keep", keep)
    agg = x.groupBy(frame).agg(
        F.percentile(F.when(F.col("_keep"), F.col("vx")), F.lit(0.5)).alias("cloud_vx"),
        F.percentile(F.when(F.col("_keep"), F.col("vy")), F.lit(0.5)).alias("cloud_vy"),
        F.percentile(F.when(F.col("_keep"), F.col("_mag")), F.lit(0.5)).alias("_mmag"))
    dt = max(dt_sec, 1e-3)
    ang = F.degrees(F.atan2(-F.col("cloud_vy"), F.col("cloud_vx")))
    return agg.select(frame, "cloud_vx", "cloud_vy",
                      X.compass8(ang).alias("cloud_direction"),
                      (F.col("_mmag") / F.lit(dt) * F.lit(m_per_px) * F.lit(3.6)).alias("cloud_speed_kmh"))


def vertical_growth(frames: DataFrame, spec: SeriesSpec | None = None) -> DataFrame:
    """Per-minute rates between consecutive frames of a camera (darkening =
    prev - cur brightness, cloud / texture growth = cur - prev), dt <= 0 ->
    0.001 min, and the growth flag; the first frame has NULL rates, flag 0."""
    spec = spec or DEFAULT.with_(keys=("camera_id",))
    cols = ["brightness", "cloud_fraction", "texture_index"]

    def build(w):
        return [F.lag(F.struct(S.micros(spec.ts).alias("us"), *[F.col(c) for c in cols]), 1).over(w).alias("_p")]
    x = S.row_frames(frames, spec, build, back=1)
    dt = (S.micros(spec.ts) - F.col("_p.us")) / F.lit(float(S.US_PER_MINUTE))
    dt = F.when(dt <= 0, F.lit(1e-3)).otherwise(dt)
    dr = (F.col("_p.brightness") - F.col("brightness")) / dt
    cg = (F.col("cloud_fraction") - F.col("_p.cloud_fraction")) / dt
    tg = (F.col("texture_index") - F.col("_p.texture_index")) / dt
    thick = X.thickness_class("brightness", "dark_fraction")
    flag = ((dr > VG["dark_rate"]) & (F.col("brightness") < VG["bright_max"])
            & (cg > VG["cloud_rate"]) & (F.col("cloud_fraction") > VG["cloud_min"])
            & (tg > VG["tex_rate"]) & (F.col("texture_index") > VG["tex_min"])
            & (thick == "THICK_CONVECTIVE"))
    return (x.withColumn("darkening_rate", dr).withColumn("cloud_area_growth_rate", cg)
             .withColumn("texture_growth_rate", tg)
             .withColumn("vertical_growth_flag", F.coalesce(flag, F.lit(False)).cast("int"))
             .drop("_p"))


def clear_sky_anomaly(df: DataFrame, brightness: str = "brightness", ts: str = "timestamp") -> DataFrame:
    """Expected clear-sky brightness by hour of day and the anomaly of the
    (smoothed) brightness against it."""
    hf = X.hour_fraction(ts)
    return (df.withColumn("hour_local", hf)
              .withColumn("brightness_expected_clear", X.clear_sky_expected(hf))
              .withColumn("brightness_anomaly", F.col(brightness) - F.col("brightness_expected_clear")))
