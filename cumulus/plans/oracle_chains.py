"""Generators of DuckDB CTE chains for the oracles of composed transforms.

Each function returns the body of one or more CTEs (``name AS (...)``)
written step by step as the reference orders them, independent of the
Spark implementation (separate interpolate / forward fill / backward fill,
self-join Savitzky-Golay, recursive-CTE Kalman)."""

from __future__ import annotations

W = "PARTITION BY location_id ORDER BY timestamp"
WLOC = "PARTITION BY location_id ORDER BY epoch_us(timestamp)"
MIN = 60_000_000
SG = [-36, 9, 44, 69, 84, 89, 84, 69, 44, 9, -36]


def positions(name: str, src: str) -> str:
    return (f"{name} AS (SELECT *, row_number() OVER ({W}) - 1 AS _pos, "
            f"count(*) OVER (PARTITION BY location_id) AS _n FROM {src})")


def interpolate(name: str, src: str, cols: list[str], k: int) -> str:
    """Linear by position, at most k from each side; edges nearest value
    within k.  ``src`` must carry ``_pos``."""
    look = []
    for c in cols:
        look += [
            f"last_value(CASE WHEN {c} IS NOT NULL THEN _pos END IGNORE NULLS) OVER (PARTITION BY location_id ORDER BY _pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS _p0_{c}",
            f"last_value({c} IGNORE NULLS) OVER (PARTITION BY location_id ORDER BY _pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS _v0_{c}",
            f"first_value(CASE WHEN {c} IS NOT NULL THEN _pos END IGNORE NULLS) OVER (PARTITION BY location_id ORDER BY _pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS _p1_{c}",
            f"first_value({c} IGNORE NULLS) OVER (PARTITION BY location_id ORDER BY _pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS _v1_{c}",
        ]
    rep = []
    for c in cols:
        p0, v0, p1, v1 = f"_p0_{c}", f"_v0_{c}", f"_p1_{c}", f"_v1_{c}"
        rep.append(f"""CASE WHEN {c} IS NOT NULL THEN {c}
          WHEN {p0} IS NOT NULL AND {p1} IS NOT NULL AND (_pos - {p0} <= {k} OR {p1} - _pos <= {k})
            THEN {v0} + ({v1} - {v0}) / CAST({p1} - {p0} AS DOUBLE) * CAST(_pos - {p0} AS DOUBLE)
          WHEN {p0} IS NULL AND {p1} IS NOT NULL AND {p1} - _pos <= {k} THEN {v1}
          WHEN {p1} IS NULL AND {p0} IS NOT NULL AND _pos - {p0} <= {k} THEN {v0} END AS {c}""")
    drop = ", ".join(f"_{t}_{c}" for c in cols for t in ("p0", "v0", "p1", "v1"))
    return (f"{name}_l AS (SELECT *, {', '.join(look)} FROM {src}),\n"
            f"{name} AS (SELECT * EXCLUDE ({drop}) REPLACE ({', '.join(rep)}) FROM {name}_l)")


def ffill(name: str, src: str, cols: list[str]) -> str:
    rep = ", ".join(f"coalesce({c}, last_value({c} IGNORE NULLS) OVER (PARTITION BY location_id ORDER BY _pos "
                    f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS {c}" for c in cols)
    return f"{name} AS (SELECT * REPLACE ({rep}) FROM {src})"


def bfill(name: str, src: str, cols: list[str]) -> str:
    rep = ", ".join(f"coalesce({c}, first_value({c} IGNORE NULLS) OVER (PARTITION BY location_id ORDER BY _pos "
                    f"ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {c}" for c in cols)
    return f"{name} AS (SELECT * REPLACE ({rep}) FROM {src})"


def zscore(name: str, src: str, cols: list[str], label: str | None, rain: str = "rainfall_mm") -> str:
    stats = ", ".join(f"avg({c}) AS _m_{c}, stddev_samp({c}) AS _s_{c}" for c in cols)
    flags = []
    for c in cols:
        f = f"coalesce(CASE WHEN _s_{c} > 0 THEN abs(({c} - _m_{c}) / _s_{c}) > 3 END, false)"
        if c == rain and label:
            f = f"({f} AND {label} = 0)"
        flags.append(f"{f} AS {c}_is_outlier")
    rep = ", ".join(f"CASE WHEN {c}_is_outlier THEN NULL ELSE {c} END AS {c}" for c in cols)
    drop = ", ".join(f"_m_{c}, _s_{c}" for c in cols)
    return (f"{name}_s AS (SELECT {stats} FROM {src}),\n"
            f"{name}_f AS (SELECT *, {', '.join(flags)} FROM {src}, {name}_s),\n"
            f"{name} AS (SELECT * EXCLUDE ({drop}) REPLACE ({rep}) FROM {name}_f)")


def median_mean(name: str, src: str, cols: list[str]) -> str:
    med = ", ".join(f"quantile_cont({c}, 0.5) OVER (PARTITION BY location_id ORDER BY _pos ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS _md_{c}" for c in cols)
    mean = ", ".join(f"avg(_md_{c}) OVER (PARTITION BY location_id ORDER BY _pos ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS {c}_smooth" for c in cols)
    drop = ", ".join(f"_md_{c}" for c in cols)
    return (f"{name}_m AS (SELECT *, {med} FROM {src}),\n"
            f"{name} AS (SELECT * EXCLUDE ({drop}), {mean} FROM {name}_m)")


def time_sums(name: str, src: str, col: str, windows: list[int], prefix: str = "rain_") -> str:
    s = ", ".join(f"sum({col}) OVER ({WLOC} RANGE BETWEEN {w * MIN - 1} PRECEDING AND CURRENT ROW) AS {prefix}{w}"
                  for w in windows)
    return f"{name} AS (SELECT *, {s} FROM {src})"


def savgol(name: str, src: str, cols: list[str], suffix: str = "_sg") -> str:
    """Savitzky-Golay 11/2 with mirrored ends by self-join on mirrored
    positions; series shorter than 11 unchanged.  ``src`` has _pos, _n."""
    vals = ", ".join(f"({j}, {w})" for j, w in zip(range(-5, 6), SG))
    sums = ", ".join(f"CASE WHEN min(i._n) < 11 THEN min(i.{c}) ELSE sum(i._w * b2.{c}) / 429.0 END AS {c}{suffix}"
                     for c in cols)
    keep = ", ".join(f"min(i.{c}) AS {c}" for c in cols)
    return f"""{name}_c(_j, _w) AS (VALUES {vals}),
{name}_i AS (SELECT s.*, c._w,
    CASE WHEN s._pos + c._j < 0 THEN -(s._pos + c._j)
         WHEN s._pos + c._j > s._n - 1 THEN 2 * (s._n - 1) - (s._pos + c._j)
         ELSE s._pos + c._j END AS _q
  FROM {src} s, {name}_c c),
{name}_g AS (SELECT i.location_id, i._pos, {sums}
  FROM {name}_i i JOIN {src} b2 ON b2.location_id = i.location_id AND b2._pos = i._q
  GROUP BY i.location_id, i._pos),
{name} AS (SELECT s.*, {', '.join(f'g.{c}{suffix}' for c in cols)}
  FROM {src} s JOIN {name}_g g ON s.location_id = g.location_id AND s._pos = g._pos)"""


def kalman(name: str, src: str, cols: list[str]) -> str:
    """Recursive CTE carrying (estimate, P) for every column; P is shared
    as it does not depend on the data."""
    init = ", ".join(f"{c} AS _x_{c}" for c in cols)
    step_k = "((k._P + 0.01) / ((k._P + 0.01) + 1.0))"
    step = ", ".join(f"k._x_{c} + {step_k} * (b.{c} - k._x_{c})" for c in cols)
    cl = ", ".join(f"_x_{c}" for c in cols)
    return f"""{name}_r(location_id, _pos, {cl}, _P) AS (
  SELECT location_id, _pos, {init}, CAST(1.0 AS DOUBLE) FROM {src} WHERE _pos = 0
  UNION ALL
  SELECT b.location_id, b._pos, {step}, (1 - {step_k}) * (k._P + 0.01)
  FROM {name}_r k JOIN {src} b ON b.location_id = k.location_id AND b._pos = k._pos + 1),
{name} AS (SELECT s.*, {', '.join(f'r._x_{c} AS {c.removesuffix("_sg")}_kalman' for c in cols)},
   {', '.join(f'CASE WHEN s._pos = 0 THEN 0.0 ELSE s.{c} - r._x_{c} END AS {c.removesuffix("_sg")}_kalman_resid' for c in cols)}
  FROM {src} s JOIN {name}_r r ON s.location_id = r.location_id AND s._pos = r._pos)"""


def resid_outliers(name: str, src: str, bases: list[str]) -> str:
    sd = ", ".join(f"stddev_pop({b}_kalman_resid) OVER (PARTITION BY location_id) AS _sd_{b}" for b in bases)
    fl = ", ".join(f"coalesce(CASE WHEN _sd_{b} > 0 THEN abs({b}_kalman_resid) > 3 * _sd_{b} END, false) AS {b}_kalman_outlier"
                   for b in bases)
    drop = ", ".join(f"_sd_{b}" for b in bases)
    return (f"{name}_s AS (SELECT *, {sd} FROM {src}),\n"
            f"{name} AS (SELECT * EXCLUDE ({drop}), {fl} FROM {name}_s)")
