"""Risk levels, rule-based alerts and alert hysteresis."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumulus.operators.stats import quantile_values

# Fixed rule: rain_15 above the positives' 75th percentile, pressure drop and
# humidity change above their medians (strict comparisons).
RULE_QUANTILES = {"rain_15": 0.75, "pressure_drop_15": 0.5, "humidity_change_15": 0.5}


def rule_thresholds(df: DataFrame, label: str = "cloudburst") -> dict[str, float]:
    """Quantile thresholds over the positive rows, for the columns present;
    one exact-quantile job for all of them."""
    pos = df.where(F.col(label) == 1)
    present = [c for c in RULE_QUANTILES if c in df.columns]
    if not present:
        return {}
    qs = sorted(set(RULE_QUANTILES[c] for c in present))
    vals = quantile_values(pos, present if len(present) > 1 else present[0], qs)
    if len(present) == 1:
        vals = {present[0]: vals}
    return {c: vals[c][qs.index(RULE_QUANTILES[c])] for c in present}


def rule_classifier(df: DataFrame, thresholds: dict[str, float] | None = None,
                    label: str = "cloudburst", out: str = "rule_prediction") -> DataFrame:
    """AND of strict ``column > threshold`` tests; absent columns are
    skipped, none left is an error; a threshold without a value (no positive
    rows) is never exceeded."""
    thr = rule_thresholds(df, label) if thresholds is None else thresholds
    conds = [F.lit(False) if v is None else F.col(c) > F.lit(v) for c, v in thr.items() if c in df.columns]
    if not conds:
        raise ValueError("no usable features for the rule")
    cond = conds[0]
    for c in conds[1:]:
        cond = cond & c
    return df.withColumn(out, F.coalesce(cond, F.lit(False)).cast("int"))


# ---------------------------------------------------------------- hysteresis
#
# Fixed service settings: hold 10 minutes after a trigger, clear only below
# threshold - 0.05 once the hold has passed.
HOLD_MINUTES = 10
CLEAR_MARGIN = 0.05

import numpy as np  # noqa: E402
import pandas as pd  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from cumulus.operators import series as S  # noqa: E402
from cumulus.operators.series import CH, DEFAULT, POS, SeriesSpec  # noqa: E402

# state codes: 0 inactive, 1 pending (active, until in the future), 2 expired
# (active, until passed: stays on until p < thr - margin)
INACTIVE, PENDING, EXPIRED = 0, 1, 2


def advance(state, until, t, p, thr, margin, hold):
    """(state, until) after a reading p at time t (microseconds, as hold and until); a NaN
    neither triggers nor clears."""
    if state == PENDING and t >= until:
        state = EXPIRED
    if state == EXPIRED:
        if p < thr - margin:
            return INACTIVE, None
        return EXPIRED, until
    if state == PENDING:
        if p >= thr:
            return PENDING, t + hold
        return PENDING, until
    if p >= thr:
        return PENDING, t + hold
    return INACTIVE, None


class Readings:
    """The machine over the readings of one chunk (times in order, microseconds), by whole
    episodes: an episode begins with a trigger, its hold is extended by the triggers that
    follow within a hold of each other, and it ends with the first low reading after that.
    An episode lasts at least one hold, so a walk has at most span / hold + 1 steps."""

    def __init__(self, t: np.ndarray, p: np.ndarray, threshold: float, margin: float, hold: int):
        self.t, self.n, self.hold = t, len(t), hold
        self.trigger = np.flatnonzero(p >= threshold)
        self.low = np.flatnonzero(p < threshold - margin)
        tt = t[self.trigger]
        # per trigger: the last one of its run, and the row at which its episode is off
        ends = np.append(np.flatnonzero(np.diff(tt) >= hold), len(tt) - 1) if len(tt) else np.empty(0, np.int64)
        self.end = ends[np.searchsorted(ends, np.arange(len(tt)))] if len(tt) else ends
        self.until = tt[self.end] + hold
        expired = np.maximum(np.searchsorted(t, self.until), self.trigger[self.end] + 1)
        self.off = self.low_from(expired)

    def low_from(self, row):
        """The first low reading at or after the row(s); n if there is none."""
        return np.append(self.low, self.n)[np.searchsorted(self.low, row)]

    def walk(self, row: int):
        """The episodes after an inactive reading (-1: from the start): the trigger's number each."""
        k = int(np.searchsorted(self.trigger, row, side="right"))
        while k < len(self.trigger):
            yield k
            if self.off[k] == self.n:
                return
            k = int(np.searchsorted(self.trigger, self.off[k], side="right"))

    def final(self, row: int) -> tuple[int, int | None]:
        """(state, until) after the last reading, if inactive after the given one."""
        last = None
        for last in self.walk(row):
            pass
        if last is None or self.off[last] < self.n:
            return INACTIVE, None
        return (PENDING if self.until[last] > self.t[-1] else EXPIRED), int(self.until[last])

    def summary(self) -> dict:
        """The outcome for every entering state, in a few numbers (see `through`)."""
        first = int(self.trigger[0]) if len(self.trigger) else self.n
        before = self.low[self.low < first]
        after = self.n if first == self.n else int(self.low_from(first))
        on, late = self.final(-1), (None, None)
        if after < self.n:
            late = self.final(after)
        return {"t_low": int(self.t[before[-1]]) if len(before) else None,
                "t_edge": int(self.t[min(first, self.n - 1)]), "triggered": first < self.n,
                "on_state": on[0], "on_until": on[1], "late_state": late[0], "late_until": late[1]}

    def states(self, state: int, until: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Alert (0/1) and until (0 where off) of every reading, from the entering state."""
        alert, untils = np.zeros(self.n, np.int32), np.zeros(self.n, np.int64)
        row = -1
        if state != INACTIVE:
            row = expired = 0 if state == EXPIRED else int(np.searchsorted(self.t, until))
            first = int(self.trigger[0]) if len(self.trigger) else self.n
            if first < expired:
                row, stop = first - 1, first
            else:
                row = stop = int(self.low_from(expired))
            alert[:stop], untils[:stop] = 1, until
        for k in self.walk(row):
            rows = slice(int(self.trigger[k]), int(self.off[k]))
            alert[rows] = 1
            reached = np.searchsorted(self.trigger, np.arange(rows.start, rows.stop), side="right") - 1
            untils[rows] = self.t[self.trigger[np.minimum(reached, self.end[k])]] + self.hold
        return alert, untils


SUMMARY = ("t_low long, t_edge long, triggered boolean, on_state int, on_until long, "
           "late_state int, late_until long")


def through(s: dict, state: int, until: int | None) -> tuple[int, int | None]:
    """(state, until) after a chunk of this summary, entered in the given state.

    t_low is the last low reading before the first trigger, t_edge the first trigger (or the
    last reading).  Off before the first trigger, or held until after it: as if inactive
    from the start.  Expired in between: off with the first low reading after the trigger,
    if any.  So the outcome as a function of `until` has three intervals."""
    if state == INACTIVE:
        return s["on_state"], s["on_until"]
    pending = state == PENDING and until > s["t_edge"]
    if pending and not s["triggered"]:
        return PENDING, until
    if pending or (s["t_low"] is not None and (state == EXPIRED or until <= s["t_low"])):
        return s["on_state"], s["on_until"]
    return (EXPIRED, until) if s["late_state"] is None else (s["late_state"], s["late_until"])


def alert_hysteresis(df: DataFrame, prob: str = "probability", threshold: float = 0.5,
                     margin: float = CLEAR_MARGIN, hold_minutes: float = HOLD_MINUTES,
                     spec: SeriesSpec = DEFAULT) -> DataFrame:
    """Alert state per series in event time: inactive and p >= thr -> on
    until now + hold; on and before the hold end: p >= thr extends it; on
    after the hold end: off only when p < thr - margin (else stays on, hold
    not extended).  Adds ``alert`` (0/1) and ``alert_until``.

    Readings of one time go by probability, those without one first, as in the stream.  A
    NULL or NaN probability neither triggers nor clears; a reading without a time takes no
    part and has NULL in both columns.

    Chunked exactly, in linear time: the outcome of a chunk for all entering states is a few
    numbers (`Readings.summary`), composed over the chunk summary; each chunk is then run
    by whole episodes from its true entering state."""
    keys = list(spec.keys)
    hold = int(hold_minutes * S.US_PER_MINUTE)
    p = F.nanvl(F.col(prob).cast("double"), F.lit(None).cast("double"))
    x, chunk = S.row_chunks(S.with_positions(df, spec, ties=[p]), spec)
    x = x.withColumn("_t", S.micros(spec.ts)).withColumn("_p", p)
    named = T.StructType([f for f in x.schema.fields if f.name in keys]
                         + [T.StructField(c, T.LongType()) for c in chunk])

    def readings(pdf: pd.DataFrame) -> Readings:
        return Readings(pdf["_t"].to_numpy(dtype="int64"), pdf["_p"].to_numpy(dtype="float64"), threshold, margin, hold)

    def outcomes(pdf: pd.DataFrame) -> pd.DataFrame:
        row = {c: pdf[c].iloc[0] for c in keys + chunk}
        return pd.DataFrame([row | readings(pdf.sort_values(POS)).summary()])

    parts = T.StructType(named.fields + T.StructType.fromDDL(SUMMARY).fields)
    summ = (x.where(F.col("_t").isNotNull()).select(*keys, *chunk, POS, "_t", "_p")
             .groupBy(*keys, *chunk).applyInPandas(outcomes, parts))

    def compose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(chunk)
        entered, now = [], (INACTIVE, None)
        for s in pdf.drop(columns=keys).to_dict("records"):
            entered.append(now)
            now = through({k: None if pd.isna(v) else v if k == "triggered" else int(v) for k, v in s.items()}, *now)
        out = pdf[keys + chunk].copy()
        out["in_state"] = np.array([e[0] for e in entered], dtype=np.int32)
        out["in_until"] = pd.array([e[1] for e in entered], dtype="Int64")
        return out

    entry = [T.StructField("in_state", T.IntegerType()), T.StructField("in_until", T.LongType())]
    entering = summ.groupBy(*keys).applyInPandas(compose, T.StructType(named.fields + entry))
    y = x.join(entering, keys + chunk, "left")
    out_schema = T.StructType(list(y.schema.fields) + [T.StructField("alert", T.IntegerType()),
                                                       T.StructField("_until", T.LongType())])

    def final(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(POS)
        timed = pdf["_t"].notna().to_numpy()
        alert = pd.array([None] * len(pdf), dtype="Int32")
        until = pd.array([None] * len(pdf), dtype="Int64")
        if timed.any():
            part = pdf[timed]
            at = part["in_until"].iloc[0]
            on, held = readings(part).states(int(part["in_state"].iloc[0]), None if pd.isna(at) else int(at))
            alert[timed] = on
            until[np.flatnonzero(timed)[on == 1]] = held[on == 1]
        pdf["alert"], pdf["_until"] = alert, until
        return pdf

    res = y.groupBy(*keys, *chunk).applyInPandas(final, out_schema)
    res = res.withColumn("alert_until", F.timestamp_micros("_until"))
    return res.drop("_t", "_p", "_until", "in_state", "in_until", CH)
