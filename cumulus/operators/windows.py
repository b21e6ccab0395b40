"""Window operators over per-station series (time frames, row frames,
lags, as-of baselines, trends).  All go through ``series`` so no window is
ever partitioned by the station key alone."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cumulus.operators import series as S
from cumulus.operators.series import DEFAULT, POS, NROWS, US, Scan, SeriesSpec, minutes


def frame_bounds(w_us: int, closed: str) -> tuple[int, int]:
    """Micro-second range bounds for a window of width ``w_us`` ending at the
    current row.  ``right``: (t-w, t]; ``left``: [t-w, t); ``both``:
    [t-w, t]; ``neither``: (t-w, t)."""
    lo = -w_us if closed in ("left", "both") else -(w_us - 1)
    hi = 0 if closed in ("right", "both") else -1
    return lo, hi


# ---------------------------------------------------------------- time frames


def rolling_time(df: DataFrame, aggs: dict[str, tuple[str, str, float, str]],
                 spec: SeriesSpec = DEFAULT) -> DataFrame:
    """Generic time-window aggregates.  ``aggs[name] = (func, column,
    minutes, closed)``, func in sum/avg/stddev_samp/max/min/count."""
    look = max(minutes(m) for _, _, m, _ in aggs.values())

    def build(w):
        out = []
        for name, (fn, c, m, closed) in aggs.items():
            lo, hi = frame_bounds(minutes(m), closed)
            out.append(getattr(F, fn)(F.col(c)).over(w.rangeBetween(lo, hi)).alias(name))
        return out
    return S.time_frames(df, spec, build, look)


def rain_time_sums(df: DataFrame, col: str = "rainfall_mm", windows=(5, 15, 30),
                   closed: str = "right", prefix: str = "rain_",
                   spec: SeriesSpec = DEFAULT) -> DataFrame:
    """Sum of ``col`` over the last w minutes, (t-w, t] by default."""
    return rolling_time(df, {f"{prefix}{w}": ("sum", col, w, closed) for w in windows}, spec)


def sensor_stats_15(df: DataFrame, temp: str, hum: str, press: str, wind: str,
                    spec: SeriesSpec = DEFAULT) -> DataFrame:
    """15-minute mean / sample std / max and 30-minute pressure std over
    (t-w, t]; one window node for all of them."""
    aggs = {}
    if temp:
        aggs["temp_mean_15"] = ("avg", temp, 15, "right")
        aggs["temp_std_15"] = ("stddev_samp", temp, 15, "right")
    if hum:
        aggs["hum_mean_15"] = ("avg", hum, 15, "right")
        aggs["hum_std_15"] = ("stddev_samp", hum, 15, "right")
    if press:
        aggs["pressure_std_30"] = ("stddev_samp", press, 30, "right")
    if wind:
        aggs["wind_mean_15"] = ("avg", wind, 15, "right")
        aggs["wind_max_15"] = ("max", wind, 15, "right")
        aggs["wind_std_15"] = ("stddev_samp", wind, 15, "right")
    return rolling_time(df, aggs, spec)


def history_features_station(df: DataFrame, rain: str = "rainfall_mm", pressure: str = "pressure",
                             humidity: str = "humidity", spec: SeriesSpec = DEFAULT) -> DataFrame:
    """Station-logger features: rain totals over [t-w, t] (current reading
    included), pressure drop = oldest - current over the last 5 / 15 min
    (positive = drop) and humidity change = current - oldest, rounded to 3;
    0 when there is no earlier reading in the window."""
    m5, m15 = minutes(5), minutes(15)

    def build(w):
        b5 = w.rangeBetween(-m5, -1)
        b15 = w.rangeBetween(-m15, -1)
        r = F.coalesce(F.col(rain), F.lit(0.0))
        return [
            F.sum(r).over(w.rangeBetween(-m5, 0)).alias("_rain5"),
            F.sum(r).over(w.rangeBetween(-m15, 0)).alias("_rain15"),
            F.first(F.col(pressure)).over(b5).alias("_p5"),
            F.first(F.col(pressure)).over(b15).alias("_p15"),
            F.first(F.col(humidity)).over(b15).alias("_h15"),
        ]
    x = S.time_frames(df, spec, build, m15)
    p, h = F.col(pressure), F.col(humidity)
    return (x.withColumn("rain_last_5min", F.col("_rain5"))
             .withColumn("rain_last_15min", F.col("_rain15"))
             .withColumn("pressure_drop_5min", F.coalesce(F.round(F.col("_p5") - p, 3), F.lit(0.0)))
             .withColumn("pressure_drop_15min", F.coalesce(F.round(F.col("_p15") - p, 3), F.lit(0.0)))
             .withColumn("humidity_change", F.coalesce(F.round(h - F.col("_h15"), 3), F.lit(0.0)))
             .drop("_rain5", "_rain15", "_p5", "_p15", "_h15"))


def rain_total_since(df: DataFrame, minutes_back: float, rain: str = "rainfall_mm",
                     name: str = "rain_total", spec: SeriesSpec = DEFAULT) -> DataFrame:
    """Per reading: rain over [t-m, t] (earlier readings plus the current
    interval); NULL rain counts as 0."""
    m = minutes(minutes_back)

    def build(w):
        return [F.coalesce(F.sum(F.coalesce(F.col(rain), F.lit(0.0))).over(w.rangeBetween(-m, 0)),
                           F.lit(0.0)).alias(name)]
    return S.time_frames(df, spec, build, m)


def history_range_join(df: DataFrame, window_min: float = 15, rain: str = "rainfall_mm",
                       spec: SeriesSpec = DEFAULT) -> DataFrame:
    """For each reading at t, the readings of the same station with
    t - w <= ts < t (current excluded): how many, their rain total, and
    their first / last time."""
    m = minutes(window_min)

    def build(w):
        f = w.rangeBetween(-m, -1)
        return [F.count(F.lit(1)).over(f).alias("history_rows"),
                F.coalesce(F.sum(F.col(rain)).over(f), F.lit(0.0)).alias("history_rain"),
                F.min(F.col(spec.ts)).over(f).alias("history_first_ts"),
                F.max(F.col(spec.ts)).over(f).alias("history_last_ts")]

    def compute(rows, first, end):
        none = end <= first
        return {"history_rows": pa.array(end - first), "history_rain": pa.array(frame_sums(rows[rain], first, end)),
                "history_first_ts": rows[spec.ts].take(pa.array(first, mask=none)),
                "history_last_ts": rows[spec.ts].take(pa.array(end - 1, mask=none))}
    kind = df.schema[spec.ts].dataType.simpleString()
    return S.earlier_rows(df, spec, m, (), f"history_rows long, history_rain double, history_first_ts {kind}, "
                          f"history_last_ts {kind}", compute, build)


def frame_sums(values, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Sums of values[first:end], 0 for none; NULL adds nothing.  They are differences of running
    sums in extended precision; what is not finite is counted apart, so it reaches
    its own frames only."""
    v = pc.fill_null(pc.cast(values, pa.float64()), 0.0).to_numpy()

    def between(x, kind):
        total = np.concatenate([np.zeros(1, kind), np.cumsum(x, dtype=kind)])
        return total[end] - total[first]
    finite = np.isfinite(v)
    out = between(np.where(finite, v, 0.0), np.longdouble).astype(float)
    if not finite.all():
        up, down = between(v == np.inf, np.int64) > 0, between(v == -np.inf, np.int64) > 0
        out = np.where(up, np.inf, np.where(down, -np.inf, out))
        out[(between(np.isnan(v), np.int64) > 0) | (up & down)] = np.nan
    return out


def asof_baseline(df: DataFrame, window_min: float = 15, pressure: str = "pressure",
                  humidity: str = "humidity", spec: SeriesSpec = DEFAULT) -> DataFrame:
    """Earliest earlier reading inside [t-w, t): its pressure and humidity."""
    m = minutes(window_min)

    def build(w):
        f = w.rangeBetween(-m, -1)
        first = F.first(F.struct(F.col(pressure).alias("p"), F.col(humidity).alias("h"))).over(f)
        return [first["p"].alias("baseline_pressure"), first["h"].alias("baseline_humidity")]

    def compute(rows, first, end):
        at = pa.array(first, mask=end <= first)
        return {"baseline_pressure": rows[pressure].take(at), "baseline_humidity": rows[humidity].take(at)}
    p, h = (df.schema[c].dataType.simpleString() for c in (pressure, humidity))
    return S.earlier_rows(df, spec, m, (pressure, humidity), f"baseline_pressure {p}, baseline_humidity {h}", compute, build)


def asof_fallback(df: DataFrame, pressure: str = "pressure", humidity: str = "humidity",
                  spec: SeriesSpec = DEFAULT) -> DataFrame:
    """Last minus first value of all readings before t (NULL when none):
    the fallback used when the 15-minute window is empty."""
    ph = F.struct(F.col(pressure).alias("p"), F.col(humidity).alias("h"))
    x = S.with_positions(df, spec)
    x = S.scans(x, spec, [
        Scan("_prev", ph, "ffill", inclusive=False),
        Scan("_first", F.when(F.col(POS) == 0, ph), "ffill", inclusive=False),
    ])
    return (x.withColumn("fallback_pressure_change", F.col("_prev.p") - F.col("_first.p"))
             .withColumn("fallback_humidity_change", F.col("_prev.h") - F.col("_first.h"))
             .drop("_prev", "_first"))


def history_features_predict(df: DataFrame, rain: str = "rainfall_mm", pressure: str = "pressure",
                             humidity: str = "humidity", spec: SeriesSpec = DEFAULT) -> DataFrame:
    """Serving features over [t-w, t) (current reading excluded): rain
    totals over 5 and 15 min; pressure / humidity change = current - oldest
    in the last 15 min (negative = drop); with an empty window but earlier
    readings, last - first of all earlier readings; no earlier reading -> 0."""
    m5, m15 = minutes(5), minutes(15)

    def build(w):
        f5, f15 = w.rangeBetween(-m5, -1), w.rangeBetween(-m15, -1)
        return [F.coalesce(F.sum(F.col(rain)).over(f5), F.lit(0.0)).alias("_r5"),
                F.coalesce(F.sum(F.col(rain)).over(f15), F.lit(0.0)).alias("_r15"),
                F.count(F.lit(1)).over(f15).alias("_n15"),
                F.first(F.struct(F.col(pressure).alias("p"), F.col(humidity).alias("h"))).over(f15)
                .alias("_b")]
    x = S.time_frames(df, spec, build, m15)
    x = asof_fallback(x, pressure, humidity, spec)
    p, h = F.col(pressure), F.col(humidity)
    has_hist = F.col(POS) > 0
    pd_ = (F.when(~has_hist, F.lit(0.0))
            .when(F.col("_n15") > 0, p - F.col("_b.p"))
            .otherwise(F.col("fallback_pressure_change")))
    hd_ = (F.when(~has_hist, F.lit(0.0))
            .when(F.col("_n15") > 0, h - F.col("_b.h"))
            .otherwise(F.col("fallback_humidity_change")))
    return (x.withColumn("rain_last_5min", F.when(has_hist, F.col("_r5")).otherwise(0.0))
             .withColumn("rain_last_15min", F.when(has_hist, F.col("_r15")).otherwise(0.0))
             .withColumn("pressure_drop_15min", pd_)
             .withColumn("humidity_change", hd_)
             .drop("_r5", "_r15", "_n15", "_b", "fallback_pressure_change", "fallback_humidity_change"))


def history_retention(df: DataFrame, keep_min: float, spec: SeriesSpec = DEFAULT) -> DataFrame:
    """Keep the readings of each series within ``keep_min`` of its newest
    reading (the history buffer after the last update)."""
    latest = df.groupBy(*spec.keys).agg(F.max(F.col(spec.ts)).alias("_latest"))
    cutoff = F.col("_latest") - F.expr(f"make_dt_interval(0, 0, 0, {float(keep_min) * 60.0})")
    return (df.join(latest, list(spec.keys), "inner")
              .where(F.col(spec.ts) >= cutoff).drop("_latest"))


def trend20(df: DataFrame, features: list[str], window_min: float = 20,
            spec: SeriesSpec = DEFAULT) -> DataFrame:
    """Slope per minute between the oldest reading in [t-w, t] and the
    current one for each feature; NULL with fewer than two readings so far
    or dt <= 0."""
    m = minutes(window_min)

    def build(w):
        f = w.rangeBetween(-m, 0)
        st = F.struct(F.col(US).alias("_us"), *[F.col(c).alias(c) for c in features])
        return [F.first(st).over(f).alias("_old")]
    x = S.time_frames(df, spec, build, m)
    dt = (S.micros(spec.ts) - F.col("_old._us")) / F.lit(float(S.US_PER_MINUTE))
    outs = [F.when(dt > 0, (F.col(c) - F.col(f"_old.{c}")) / dt).alias(f"trend{int(window_min)}_{c}_slope")
            for c in features]
    return x.select("*", *outs).drop("_old")


# ---------------------------------------------------------------- row frames


def generated_rolling(df: DataFrame, rain: str = "rainfall_mm", pressure: str = "pressure",
                      humidity: str = "humidity", fill: bool = True,
                      spec: SeriesSpec = DEFAULT) -> DataFrame:
    """Training-set rolling columns, by rows: rain over the last 5 / 15
    readings incl. current (NULL if any missing, then 0); pressure drop
    15 rows (positive = drop) and humidity change 15 rows, else 0; mean of
    the next 30 readings for rows 29 <= i < n - 30, else 0."""

    def build(w):
        r = F.col(rain)
        f5, f15 = w.rowsBetween(-4, 0), w.rowsBetween(-14, 0)
        nxt = w.rowsBetween(1, 30)
        return [
            F.when(F.count(r).over(f5) == 5, F.sum(r).over(f5)).alias("_r5"),
            F.when(F.count(r).over(f15) == 15, F.sum(r).over(f15)).alias("_r15"),
            F.lag(F.col(pressure), 15).over(w).alias("_p15"),
            F.lag(F.col(humidity), 15).over(w).alias("_h15"),
            F.count(r).over(nxt).alias("_nf"),
            F.avg(r).over(nxt).alias("_mf"),
        ]
    x = S.row_frames(df, spec, build, back=15, ahead=30)
    pos, n = F.col(POS), F.col(NROWS)
    fc = F.when((pos >= 29) & (pos < n - 30) & (F.col("_nf") == 30), F.col("_mf"))
    if not fill:
        return (x.withColumn("rain_last_5min", F.col("_r5"))
                 .withColumn("rain_last_15min", F.col("_r15"))
                 .withColumn("pressure_drop_15min", -(F.col(pressure) - F.col("_p15")))
                 .withColumn("humidity_change", F.col(humidity) - F.col("_h15"))
                 .withColumn("forecast_30min", fc)
                 .drop("_r5", "_r15", "_p15", "_h15", "_nf", "_mf"))
    return (x.withColumn("rain_last_5min", F.coalesce(F.col("_r5"), F.lit(0.0)))
             .withColumn("rain_last_15min", F.coalesce(F.col("_r15"), F.lit(0.0)))
             .withColumn("pressure_drop_15min",
                         F.coalesce(-(F.col(pressure) - F.col("_p15")), F.lit(0.0)) + F.lit(0.0))
             .withColumn("humidity_change", F.coalesce(F.col(humidity) - F.col("_h15"), F.lit(0.0)))
             .withColumn("forecast_30min", F.coalesce(fc, F.lit(0.0)))
             .drop("_r5", "_r15", "_p15", "_h15", "_nf", "_mf"))


def lag_changes(df: DataFrame, pressure: str, humidity: str, periods: int = 3,
                style: str = "prev_minus_cur", spec: SeriesSpec = DEFAULT) -> DataFrame:
    """Changes over ``periods`` readings.  ``prev_minus_cur`` (pipeline A):
    pressure_prev_15, pressure_drop_15 = prev - cur (positive = drop),
    humidity_prev_15, humidity_change_15 = cur - prev.  ``diff`` (pipeline
    B): pressure_drop_15 = cur - prev under the same name."""

    def build(w):
        return [F.lag(F.col(pressure), periods).over(w).alias("_pp"),
                F.lag(F.col(humidity), periods).over(w).alias("_hp")]
    x = S.row_frames(df, spec, build, back=periods)
    if style == "prev_minus_cur":
        return (x.withColumn("pressure_prev_15", F.col("_pp"))
                 .withColumn("pressure_drop_15", F.col("_pp") - F.col(pressure))
                 .withColumn("humidity_prev_15", F.col("_hp"))
                 .withColumn("humidity_change_15", F.col(humidity) - F.col("_hp"))
                 .drop("_pp", "_hp"))
    return (x.withColumn("pressure_drop_15", F.col(pressure) - F.col("_pp"))
             .withColumn("hum_change_15", F.col(humidity) - F.col("_hp")).drop("_pp", "_hp"))


def diff_rows(df: DataFrame, cols: dict[str, str], periods: int = 3,
              spec: SeriesSpec = DEFAULT) -> DataFrame:
    """``out = col - lag(col, periods)`` for each (out -> col)."""

    def build(w):
        return [(F.col(c) - F.lag(F.col(c), periods).over(w)).alias(o) for o, c in cols.items()]
    return S.row_frames(df, spec, build, back=periods)


def median_mean_smooth(df: DataFrame, cols: list[str], suffix: str = "_smooth",
                       spec: SeriesSpec = DEFAULT) -> DataFrame:
    """Centred 3-row median then centred 5-row mean, partial windows allowed
    (NULLs ignored)."""

    def build(w):
        return [F.percentile(F.col(c), F.lit(0.5)).over(w.rowsBetween(-1, 1)).alias(f"_med_{c}")
                for c in cols]

    def build2(w):
        return [F.avg(F.col(f"_med_{c}")).over(w.rowsBetween(-2, 2)).alias(f"{c}{suffix}")
                for c in cols]
    x = S.row_frames(df, spec, [build, build2], back=3, ahead=3)
    return x.drop(*[f"_med_{c}" for c in cols])


def ar_lags(df: DataFrame, col: str, p: int = 3, spec: SeriesSpec = DEFAULT) -> DataFrame:
    """Autoregressive training rows: lag_1..lag_p of ``col`` and the target
    (the current value); rows without a full history are dropped."""

    def build(w):
        return [F.lag(F.col(col), k).over(w).alias(f"lag_{k}") for k in range(1, p + 1)]
    x = S.row_frames(df, spec, build, back=p)
    return x.na.drop(subset=[f"lag_{k}" for k in range(1, p + 1)] + [col])


def decimate(df: DataFrame, every: int = 3, spec: SeriesSpec = DEFAULT) -> DataFrame:
    """Every ``every``-th reading of each series plus its last one."""
    x = S.with_positions(df, spec)
    return x.where((F.col(POS) % every == 0) | (F.col(POS) == F.col(NROWS) - 1))


def minmax_scale(df: DataFrame, col: str, pad: float = 0.2, spec: SeriesSpec = DEFAULT) -> DataFrame:
    """Per series: range (0 -> 1), padded bounds and the scaled position of
    each value between them.  Min/max are a partial aggregate per key."""
    st = df.groupBy(*spec.keys).agg(F.min(col).alias("_mn"), F.max(col).alias("_mx"))
    x = df.join(st, list(spec.keys), "left")
    rng = F.when((F.col("_mx") - F.col("_mn")) == 0, F.lit(1.0)).otherwise(F.col("_mx") - F.col("_mn"))
    lo = F.col("_mn") - rng * F.lit(pad)
    hi = F.col("_mx") + rng * F.lit(pad)
    return (x.withColumn("series_min", F.col("_mn")).withColumn("series_max", F.col("_mx"))
             .withColumn("scale_low", lo).withColumn("scale_high", hi)
             .withColumn("scaled", (F.col(col) - lo) / (hi - lo))
             .drop("_mn", "_mx"))


def savgol_11_2(df: DataFrame, cols: list[str], suffix: str = "_sg",
                spec: SeriesSpec = DEFAULT) -> DataFrame:
    """Savitzky-Golay smoothing, window 11, degree 2, mirrored ends (the
    edge sample is not repeated); series shorter than 11 stay unchanged."""
    # Fixed coefficients of the 11-point quadratic smoother (divided by 429).
    coef = [-36, 9, 44, 69, 84, 89, 84, 69, 44, 9, -36]
    half = 5

    def shifts(w):
        out = []
        for c in cols:
            for k in range(-half, half + 1):
                if k == 0:
                    continue
                f = F.lead(F.col(c), k).over(w) if k > 0 else F.lag(F.col(c), -k).over(w)
                out.append(f.alias(f"_sh_{c}_{k + half}"))
        return out

    def term(near, pos, n):
        def at(j):
            k = (F.when(pos + j < 0, -(pos + j) - pos).when(pos + j > n - 1, 2 * (n - 1) - (pos + j) - pos)
                 .otherwise(j))
            weight = F.element_at(F.array(*[F.lit(float(v)) for v in coef]), j + half + 1)
            return weight * F.element_at(near, (k + half + 1).cast("int"))
        return at

    def combine(_w):
        pos, n = F.col(POS), F.col(NROWS)
        out = []
        for c in cols:
            def shifted(k):
                return F.col(c) if k == 0 else F.col(f"_sh_{c}_{k + half}")

            inside = None
            for j in range(-half, half + 1):
                t = F.lit(float(coef[j + half])) * shifted(j)
                inside = t if inside is None else inside + t
            # the few rows near an end: offsets beyond it are turned back.  Written out for
            # each such row, the expression is too long for the JVM to compile
            near = F.array(*[shifted(j) for j in range(-half, half + 1)])
            terms = F.transform(F.array(*[F.lit(j) for j in range(-half, half + 1)]), term(near, pos, n))
            turned = F.aggregate(terms, F.lit(0.0), lambda s, t: s + t)
            out.append(F.when(n < 11, F.col(c).cast("double"))
                       .when((pos >= half) & (pos < n - half), inside / F.lit(429.0))
                       .otherwise(turned / F.lit(429.0)).alias(f"{c}{suffix}"))
        return out
    x = S.row_frames(df, spec, [shifts, combine], back=half, ahead=half)
    return x.drop(*[f"_sh_{c}_{k}" for c in cols for k in range(2 * half + 1) if k != half])


def spike_flags(df: DataFrame, limits: dict[str, float], spec: SeriesSpec = DEFAULT) -> DataFrame:
    """abs(x - previous) > limit -> NULL the value (both edges of a one-sample
    spike); NULL neighbours never flag.  Adds ``<col>_spike``."""

    def build(w):
        out = []
        for c, lim in limits.items():
            d = F.abs(F.col(c) - F.lag(F.col(c), 1).over(w))
            out.append(F.coalesce(d > F.lit(lim), F.lit(False)).alias(f"{c}_spike"))
        return out
    x = S.row_frames(df, spec, build, back=1)
    for c in limits:
        x = x.withColumn(c, F.when(F.col(f"{c}_spike"), F.lit(None).cast("double")).otherwise(F.col(c)))
    return x


def stuck_flags(df: DataFrame, cols: list[str], run_threshold: int = 20,
                strict: bool = False, spec: SeriesSpec = DEFAULT) -> DataFrame:
    """Runs of identical consecutive values.  Default reproduces the
    reference rule: a NULL step counts as "same"; the first element of a run
    is not flagged, except in the series' first run, which counts one extra
    and is flagged entirely.  ``strict=True``: flag every element of a run
    of >= ``run_threshold`` equal values.  Adds ``<col>_stuck`` and NULLs
    flagged values.  Run lengths come from scans, so a run may span any
    number of chunks."""

    def build(w):
        out = []
        for c in cols:
            prev = F.lag(F.col(c), 1).over(w)
            if strict:
                out.append(F.coalesce(F.col(c) == prev, F.lit(False)).alias(f"_d_{c}"))
            else:
                out.append((F.coalesce(F.col(c) - prev, F.lit(0.0)) == 0).alias(f"_d_{c}"))
        return out
    x = S.row_frames(df, spec, build, back=1)
    items = []
    for c in cols:
        same = F.col(f"_d_{c}")
        chg = F.when(~same, F.col(POS))
        items.append(Scan(f"_st_{c}", chg, "ffill", inclusive=True))
        items.append(Scan(f"_nx_{c}", chg, "bfill", inclusive=False))
    x = S.scans(x, spec, items)
    for c in cols:
        same = F.col(f"_d_{c}")
        start = F.col(f"_st_{c}")
        end = F.coalesce(F.col(f"_nx_{c}"), F.col(NROWS)) - F.lit(1)
        if strict:
            count = end - F.coalesce(start, F.lit(0)) + F.lit(1)
            same = F.lit(True)
        else:
            count = F.when(start.isNull(), end + F.lit(2)).otherwise(end - start + F.lit(1))
        bad = (count >= F.lit(run_threshold)) & same
        x = (x.withColumn(f"{c}_stuck", bad)
              .withColumn(c, F.when(bad, F.lit(None).cast("double")).otherwise(F.col(c))))
    return x.drop(*[f"_{p}_{c}" for c in cols for p in ("d", "st", "nx")])


def spike_and_stuck(df: DataFrame, limits: dict[str, float], stuck_cols: list[str], run_threshold: int = 20,
                    spec: SeriesSpec = DEFAULT) -> DataFrame:
    """``spike_flags`` then ``stuck_flags`` with one row frame reaching two
    readings back: the previous reading's spike flag needs lag 2, so the
    spike-cleaned previous value is known without a second pass.  Adds
    ``<col>_spike`` and ``<col>_stuck`` and NULLs flagged values."""

    def build(w):
        out = []
        for c in set(limits) | set(stuck_cols):
            out += [F.lag(F.col(c), 1).over(w).alias(f"_l1_{c}"), F.lag(F.col(c), 2).over(w).alias(f"_l2_{c}")]
        return out
    x = S.row_frames(df, spec, build, back=2)
    cols = {}
    for c in set(limits) | set(stuck_cols):
        cur, l1, l2 = F.col(c), F.col(f"_l1_{c}"), F.col(f"_l2_{c}")
        if c in limits:
            lim = F.lit(limits[c])
            sp = F.coalesce(F.abs(cur - l1) > lim, F.lit(False))
            sp_prev = F.coalesce(F.abs(l1 - l2) > lim, F.lit(False))
            clean = F.when(sp, F.lit(None).cast("double")).otherwise(cur)
            clean_prev = F.when(sp_prev, F.lit(None).cast("double")).otherwise(l1)
            cols[f"{c}_spike"] = sp
        else:
            clean, clean_prev = cur, l1
        cols[c] = clean
        if c in stuck_cols:
            cols[f"_d_{c}"] = F.coalesce(clean - clean_prev, F.lit(0.0)) == 0
    x = x.withColumns(cols).drop(*[f"_l{k}_{c}" for c in set(limits) | set(stuck_cols) for k in (1, 2)])
    items = []
    for c in stuck_cols:
        chg = F.when(~F.col(f"_d_{c}"), F.col(POS))
        items.append(Scan(f"_st_{c}", chg, "ffill", inclusive=True))
        items.append(Scan(f"_nx_{c}", chg, "bfill", inclusive=False))
    x = S.scans(x, spec, items)
    out = {}
    for c in stuck_cols:
        same = F.col(f"_d_{c}")
        start = F.col(f"_st_{c}")
        end = F.coalesce(F.col(f"_nx_{c}"), F.col(NROWS)) - F.lit(1)
        count = F.when(start.isNull(), end + F.lit(2)).otherwise(end - start + F.lit(1))
        bad = (count >= F.lit(run_threshold)) & same
        out[f"{c}_stuck"] = bad
        out[c] = F.when(bad, F.lit(None).cast("double")).otherwise(F.col(c))
    x = x.withColumns({k: v for k, v in out.items() if k.endswith("_stuck")})
    x = x.withColumns({k: v for k, v in out.items() if not k.endswith("_stuck")})
    return x.drop(*[f"_{p}_{c}" for c in stuck_cols for p in ("d", "st", "nx")])
