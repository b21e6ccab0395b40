"""Row-level expressions, all built from Spark's own functions (JVM side,
inside whole-stage codegen).  Each returns a ``Column``."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that results depend on (taken from the behaviour we match).
#   risk bands: p < 0.10 LOW, < 0.30 MODERATE, < 0.60 HIGH, else CRITICAL
#   default alert threshold 0.5
#   Z-R relation: Z = 200 * r^1.6, dBZ = 10 log10 Z rounded to 2
#   label rule: rain > 70 and dBZ > 45 (strict variant also pressure drop > 2)
#   dew point: a = 17.27, b = 237.7, humidity clipped below at 1
#   compass order from 0 degrees counter-clockwise: E NE N NW W SW S SE
#   clear sky curve: 255 * sin((h - 6) / 12 * pi) for 6 <= h <= 18, else 0
#   thickness: THIN if b/255 > 0.7 and dark < 0.15; MEDIUM if 0.4 < b/255 <= 0.7
#              and dark < 0.40; else THICK_CONVECTIVE
#   AQI bands: <= 50 Good, <= 100 Moderate, else Unhealthy; shares pm25 0.4,
#              pm10 0.6, so2 0.1, no2 0.2; bar percent min(v / 300 * 100, 100)
#   UV: > 5 High else Moderate; daytime 6 < hour < 18
#   fallbacks: radar 10 log10(max(0.01, rain) + 1); satellite min(1, rain / 20);
#              forecast min(100, rain_15 / 15 * 30)
RISK_BANDS = ((0.10, "LOW"), (0.30, "MODERATE"), (0.60, "HIGH"))
RISK_TOP = "CRITICAL"
DEFAULT_ALERT_THRESHOLD = 0.5
COMPASS8 = ["E", "NE", "N", "NW", "W", "SW", "S", "SE"]
DEW_A, DEW_B = 17.27, 237.7
# ---------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def risk_level(p) -> Column:
    p = _c(p)
    expr = F.when(p.isNull(), F.lit(None).cast("string"))
    for bound, label in RISK_BANDS:
        expr = expr.when(p < F.lit(bound), F.lit(label))
    return expr.otherwise(F.lit(RISK_TOP))


def alert_flag(p, threshold=None) -> Column:
    thr = F.lit(DEFAULT_ALERT_THRESHOLD) if threshold is None else (
        F.lit(threshold) if isinstance(threshold, (int, float)) else _c(threshold))
    return (_c(p) >= thr).cast("int")


def radar_fallback(radar, rain) -> Column:
    return F.coalesce(_c(radar), F.lit(10.0) * F.log10(F.greatest(_c(rain), F.lit(0.01)) + F.lit(1.0)))


def satellite_fallback(sat, rain) -> Column:
    return F.coalesce(_c(sat), F.least(F.lit(1.0), _c(rain) / F.lit(20.0)))


def naive_forecast(forecast, rain_15) -> Column:
    return F.coalesce(_c(forecast), F.least(F.lit(100.0), _c(rain_15) / F.lit(15.0) * F.lit(30.0)))


def reflectivity_zr(rain) -> Column:
    r = _c(rain)
    return F.when(r > 0, F.round(F.lit(10.0) * F.log10(F.lit(200.0) * F.pow(r, F.lit(1.6))), 2)) \
            .otherwise(F.lit(0.0))


def cloudburst_rule(rain, dbz, pressure_drop=None) -> Column:
    cond = (_c(rain) > 70) & (_c(dbz) > 45)
    if pressure_drop is not None:
        cond = cond & (_c(pressure_drop) > 2)
    return F.coalesce(cond, F.lit(False)).cast("int")


def dew_point(temp, rh) -> tuple[Column, Column]:
    """(dew point, depression) from un-smoothed temperature and humidity."""
    T = _c(temp)
    RH = F.greatest(_c(rh), F.lit(1.0))
    alpha = F.lit(DEW_A) * T / (F.lit(DEW_B) + T) + F.ln(RH / F.lit(100.0))
    dp = F.lit(DEW_B) * alpha / (F.lit(DEW_A) - alpha)
    return dp, T - dp


def compass8(angle_deg) -> Column:
    a = F.pmod(_c(angle_deg) + F.lit(360.0), F.lit(360.0))
    idx = F.floor(F.pmod(a + F.lit(22.5), F.lit(360.0)) / F.lit(45.0)).cast("int")
    return F.when(idx.isNotNull(), F.element_at(F.array(*[F.lit(d) for d in COMPASS8]), idx + F.lit(1)))


def clear_sky_expected(hour_frac) -> Column:
    h = _c(hour_frac)
    v = F.greatest(F.lit(0.0), F.lit(255.0) * F.sin((h - F.lit(6.0)) / F.lit(12.0) * F.lit(math.pi)))
    return F.when((h < 6) | (h > 18), F.lit(0.0)).otherwise(v)


def hour_fraction(ts) -> Column:
    return F.hour(_c(ts)) + F.minute(_c(ts)) / F.lit(60.0)


# Fixed bands: name, brightness / 255 above and up to, dark fraction below.
THICKNESS = (("THIN", 0.7, float("inf"), 0.15), ("MEDIUM", 0.4, 0.7, 0.40))
THICK = "THICK_CONVECTIVE"


def thickness_class(brightness, dark_fraction) -> Column:
    bn = _c(brightness) / F.lit(255.0)
    d = _c(dark_fraction)
    found = [F.when((bn > above) & (bn <= upto) & (d < dark), F.lit(name)) for name, above, upto, dark in THICKNESS]
    return F.coalesce(*found, F.lit(THICK))


def meters_per_pixel(width_px, hfov_deg, cloud_height_m) -> Column:
    def lit(v):
        return F.lit(float(v)) if isinstance(v, (int, float)) else _c(v)
    return F.lit(2.0) * lit(cloud_height_m) * F.tan(F.radians(lit(hfov_deg)) / F.lit(2.0)) / lit(width_px)


def aqi_category(v) -> Column:
    v = _c(v)
    return F.when(v <= 50, "Good").when(v <= 100, "Moderate").otherwise("Unhealthy")


def uv_label(uv) -> Column:
    return F.when(_c(uv) > 5, "High").otherwise("Moderate")


def hour12_label(ts) -> Column:
    h = F.hour(_c(ts))
    num = F.when(h == 0, 12).when(h > 12, h - 12).otherwise(h)
    return F.concat(num.cast("string"), F.when(h >= 12, F.lit(" PM")).otherwise(F.lit(" AM")))


def is_day(ts) -> Column:
    h = F.hour(_c(ts))
    return (h > 6) & (h < 18)


def clamp(x, lo, hi) -> Column:
    return F.least(F.lit(hi), F.greatest(F.lit(lo), _c(x)))
