"""Per-series window machinery that never puts a whole series in one task.

A *series* is all rows of one key (``location_id`` by default) ordered by
event time.  A plain ``Window.partitionBy('location_id')`` sends every row of
a station to one task, so one hot station (a third of all rows, say) would
serialise the job.  Instead:

* **time frames** (``rangeBetween``) run over ``(key, time bucket)``; rows
  that fall within the look-back (look-ahead) of the next (previous) bucket
  are copied into it as a *halo*, windows are evaluated, and only the home
  rows are kept.  Exact as long as the frame is bounded.
* **row frames** (``rowsBetween``, ``lag``/``lead``) need each row's
  position in its series.  ``with_positions`` derives it with a count per
  (key, bucket), a prefix sum over that small summary and a ``row_number``
  inside the bucket.  Rows are then cut into chunks of a fixed number of
  rows (balanced whatever the key skew) with a row halo.
* **unbounded scans** (forward/backward fill, running sums) run inside each
  chunk and are completed with the carry of all earlier (later) chunks,
  taken from a per-chunk summary (one row per chunk).
* **linear recurrences** ``s = a*s_prev + b`` (EMA, Kalman) are solved per
  chunk in a grouped pandas map from a zero state, then corrected with the
  state entering each chunk, obtained by composing the per-chunk affine maps
  over the chunk summary.

The per-chunk summaries grow with rows / chunk_rows (or with time span /
bucket width), never with a single key's share of the data.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from typing import Callable, Iterable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

US_PER_SECOND = 1_000_000
US_PER_MINUTE = 60 * US_PER_SECOND
US_PER_DAY = 24 * 60 * US_PER_MINUTE

US = "_s_us"      # event time in microseconds
TB = "_s_tb"      # home time bucket
BK = "_s_b"       # bucket / chunk a (possibly halo) copy belongs to
POS = "_s_pos"    # 0-based position in the series
NROWS = "_s_n"    # series length
CH = "_s_c"       # home position chunk
PC = "_s_pc"      # time bucket of the positions step (a contiguous chunk)


@dataclass(frozen=True)
class SeriesSpec:
    """How rows form series: key columns, event-time column, and the sizes
    of the units of parallel work."""

    keys: tuple[str, ...] = ("location_id",)
    ts: str = "timestamp"
    bucket_us: int = US_PER_DAY
    chunk_rows: int = 1 << 17

    def with_(self, **kw) -> "SeriesSpec":
        return replace(self, **kw)


DEFAULT = SeriesSpec()


def minutes(n: float) -> int:
    return int(round(n * US_PER_MINUTE))


def micros(ts: str | Column) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(c.cast("timestamp"))


def _keys(spec: SeriesSpec) -> list[str]:
    return list(spec.keys)


def drop_helpers(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_s_")])


# --------------------------------------------------------------------------
# time frames


def _apply(x: DataFrame, build, w: Window) -> DataFrame:
    """Evaluate one builder, or a list of builders in sequence (later stages
    may use earlier columns; all share one partitioning, so no extra
    exchange)."""
    stages = build if isinstance(build, (list, tuple)) else [build]
    for st in stages:
        x = x.select("*", *list(st(w)))
    return x


def time_window(spec: SeriesSpec) -> Window:
    """Window to use inside ``time_frames``' builder (ordered by micros)."""
    return Window.partitionBy(*_keys(spec), BK).orderBy(US)


def time_frames(df: DataFrame, spec: SeriesSpec,
                build: Callable[[Window], Sequence[Column]],
                lookback_us: int, lookahead_us: int = 0) -> DataFrame:
    """Evaluate ``build(w)`` columns over range frames of at most
    ``lookback_us`` back and ``lookahead_us`` ahead, per (key, time bucket)
    with halo copies.  Output has the input rows once, plus the columns."""
    x = _apply(_with_halo(df, spec, lookback_us, lookahead_us), build, time_window(spec))
    out = x.where(F.col(BK).eqNullSafe(F.col(TB)))
    return out.drop(US, TB, BK)


def _with_halo(df: DataFrame, spec: SeriesSpec, lookback_us: int, lookahead_us: int = 0) -> DataFrame:
    """The rows with their home bucket and the bucket that this copy is for."""
    B = spec.bucket_us
    nb = max(0, math.ceil(lookback_us / B))
    na = max(0, math.ceil(lookahead_us / B))
    x = df.withColumn(US, micros(spec.ts)).withColumn(TB, F.floor(F.col(US) / F.lit(B)))
    if nb == 0 and na == 0:
        x = x.withColumn(BK, F.col(TB))
    else:
        us, tb = F.col(US), F.col(TB)
        targets = F.filter(
            F.sequence(tb - F.lit(na), tb + F.lit(nb)),
            lambda b: (b == tb)
            | ((b > tb) & (us >= b * F.lit(B) - F.lit(lookback_us)))
            | ((b < tb) & (us < (b + F.lit(1)) * F.lit(B) + F.lit(lookahead_us))))
        x = x.withColumn(BK, F.explode_outer(targets))
    return x


def earlier_rows(df: DataFrame, spec: SeriesSpec, lookback_us: int, ties: Sequence[str], added: str,
                 compute: Callable[[pa.Table, np.ndarray, np.ndarray], dict[str, pa.Array]],
                 build: Callable[[Window], Sequence[Column]]) -> DataFrame:
    """Columns over the rows in [t - lookback, t), in time that doesn't grow with the rows
    in a frame: Spark's sliding frames are computed anew for each row, which is quadratic
    where readings are dense.  Each (key, bucket) with its halo is sorted once (``ties`` order rows of
    one time) and ``compute(rows, first, end)`` gets the bounds of every row's frame; it
    returns the columns named in the schema ``added``.  Rows without a time take the window
    ``build``."""
    names = df.columns

    def frames(rows: pa.Table) -> pa.Table:
        rows = rows.take(pc.sort_indices(rows, [(c, "ascending") for c in (US, *ties)]))
        us = rows[US].to_numpy()
        found = compute(rows, np.searchsorted(us, us - lookback_us, "left"), np.searchsorted(us, us, "left"))
        out = rows.select(names)
        for name, values in found.items():
            out = out.append_column(name, values)
        return out.filter(pc.equal(rows[BK], rows[TB]))

    schema = T.StructType(df.schema.fields + T.StructType.fromDDL(added).fields)
    timed = _with_halo(df.where(micros(spec.ts).isNotNull()), spec, lookback_us)
    out = timed.groupBy(*_keys(spec), BK).applyInArrow(frames, schema)
    return out.unionByName(time_frames(df.where(micros(spec.ts).isNull()), spec, build, lookback_us))


# --------------------------------------------------------------------------
# positions and row frames


#: Bucket of rows without a time: after every real one.
NO_TIME = 1 << 40


def with_positions(df: DataFrame, spec: SeriesSpec = DEFAULT, ties: Sequence[Column] = ()) -> DataFrame:
    """Add ``_s_pos`` (0-based position in the series by event time) and
    ``_s_n`` (series length).  Ties in time are ordered by ``ties``, then by a row hash, so
    the numbering is the same on every recomputation.  Rows without a time come
    last; rows without a key belong to no series and are left out (take them
    out first with ``validate_schema``, which names them)."""
    if POS in df.columns:
        return df
    keys = _keys(spec)
    B = spec.bucket_us
    # rows without a time come after all others of their series, in a bucket of their own
    x = df.withColumn(US, micros(spec.ts)).withColumn(
        TB, F.coalesce(F.floor(F.col(US) / F.lit(B)), F.lit(NO_TIME)))
    counts = x.groupBy(*keys, TB).agg(F.count(F.lit(1)).alias("_s_cnt"))
    wk = Window.partitionBy(*keys).orderBy(TB)
    offs = counts.select(
        *keys, TB,
        F.coalesce(F.sum("_s_cnt").over(wk.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_s_off"),
        F.sum("_s_cnt").over(Window.partitionBy(*keys)).alias(NROWS))
    tie = F.xxhash64(*[F.col(c) for c in df.columns])
    wb = Window.partitionBy(*keys, TB).orderBy(US, *ties, tie)
    # numbered before the join, which then finds the rows sorted by its columns
    x = x.withColumn(POS, F.row_number().over(wb)).join(offs, on=keys + [TB], how="inner")
    x = x.withColumn(POS, F.col("_s_off") + F.col(POS) - F.lit(1))
    # keep the bucket as ``_s_pc``: a contiguous chunk of the series that the
    # data is already partitioned by, reused by scans and recurrences
    return x.withColumnRenamed(TB, PC).drop("_s_off", US)


def row_window(spec: SeriesSpec) -> Window:
    """Window to use inside ``row_frames``' builder (ordered by position)."""
    return Window.partitionBy(*_keys(spec), BK).orderBy(POS)


def row_frames(df: DataFrame, spec: SeriesSpec,
               build: Callable[[Window], Sequence[Column]],
               back: int, ahead: int = 0) -> DataFrame:
    """Evaluate ``build(w)`` over row frames / lags reaching at most ``back``
    rows back and ``ahead`` rows ahead.  Needs ``with_positions`` first
    (done here if missing).  ``_s_pos``/``_s_n`` stay available."""
    C = spec.chunk_rows
    x = with_positions(df, spec)
    x = x.withColumn(CH, F.floor(F.col(POS) / F.lit(C)))
    nb, na = math.ceil(back / C), math.ceil(ahead / C)
    if nb == 0 and na == 0:
        x = x.withColumn(BK, F.col(CH))
    else:
        pos, ch = F.col(POS), F.col(CH)
        targets = F.filter(
            F.sequence(ch - F.lit(na), ch + F.lit(nb)),
            lambda t: (t == ch)
            | ((t > ch) & (pos >= t * F.lit(C) - F.lit(back)))
            | ((t < ch) & (t >= F.lit(0)) & (pos < (t + F.lit(1)) * F.lit(C) + F.lit(ahead))))
        x = x.withColumn(BK, F.explode(targets))
    x = _apply(x, build, row_window(spec))
    out = x.where(F.col(BK) == F.col(CH))
    return out.drop(BK, CH)


# --------------------------------------------------------------------------
# unbounded scans


@dataclass(frozen=True)
class Scan:
    """One unbounded scan of a column (by name) or expression.  ``kind``: ``ffill`` =
    last non-null value at or before the row, ``bfill`` = first non-null at or after,
    ``cumsum`` = running sum; ``inclusive=False`` excludes the row itself.  Scans that
    are given the same expression object share one helper column."""

    name: str
    value: Column | str
    kind: str = "ffill"
    inclusive: bool = True


def scans(df: DataFrame, spec: SeriesSpec, items: Iterable[Scan]) -> DataFrame:
    """Run several unbounded scans in one pass: one window over
    (key, chunk), one per-chunk summary, one summary window, one join.

    The windows' sorts hold the whole rows, so a task's memory is the rows times their
    width: prefer plain values to structs, whose copies are several times as wide."""
    items = list(items)
    keys = _keys(spec)
    dealt = POS not in df.columns   # if numbered here, rows lie by (key, bucket)
    x, chunk = row_chunks(with_positions(df, spec), spec)
    own: dict[int, tuple[str, Column]] = {}
    given = [it.value if isinstance(it.value, str) else own.setdefault(id(it.value), (f"_s_v{len(own)}", it.value))[0]
             for it in items]
    x = x.withColumns(dict(own.values()))
    w = Window.partitionBy(*keys, *chunk).orderBy(POS)
    wd = Window.partitionBy(*keys, *chunk).orderBy(F.col(POS).desc())
    local, aggs, carries = [], [], []
    wc = Window.partitionBy(*keys).orderBy(*chunk)
    wcd = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in chunk])
    for i, it in enumerate(items):
        v = F.col(given[i])
        at = F.when(v.isNotNull(), F.col(POS))
        if it.kind == "ffill":
            fr = w.rowsBetween(Window.unboundedPreceding, 0 if it.inclusive else -1)
            local.append(F.last(v, ignorenulls=True).over(fr).alias(f"_s_l{i}"))
            aggs.append(F.max_by(v, at).alias(f"_s_a{i}"))
            carries.append(F.last(f"_s_a{i}", ignorenulls=True)
                           .over(wc.rowsBetween(Window.unboundedPreceding, -1)).alias(f"_s_k{i}"))
        elif it.kind == "bfill":
            # a backward scan is a forward scan in descending order: Spark
            # grows an (unbounded preceding, n) frame incrementally, while an
            # (n, unbounded following) frame is recomputed for every row
            fr = wd.rowsBetween(Window.unboundedPreceding, 0 if it.inclusive else -1)
            local.append(F.last(v, ignorenulls=True).over(fr).alias(f"_s_l{i}"))
            aggs.append(F.min_by(v, at).alias(f"_s_a{i}"))
            carries.append(F.last(f"_s_a{i}", ignorenulls=True)
                           .over(wcd.rowsBetween(Window.unboundedPreceding, -1)).alias(f"_s_k{i}"))
        elif it.kind == "cumsum":
            fr = w.rowsBetween(Window.unboundedPreceding, 0 if it.inclusive else -1)
            local.append(F.coalesce(F.sum(v).over(fr), F.lit(0)).alias(f"_s_l{i}"))
            aggs.append(F.coalesce(F.sum(v), F.lit(0)).alias(f"_s_a{i}"))
            carries.append(F.coalesce(F.sum(f"_s_a{i}").over(
                wc.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(f"_s_k{i}"))
        else:
            raise ValueError(it.kind)
    summ = x.groupBy(*keys, *chunk).agg(*aggs, F.min(POS).alias("_s_k_first"), F.max(POS).alias("_s_k_last"))
    summ = summ.select(*keys, *chunk, "_s_k_first", "_s_k_last", *carries)
    # one column: with each of its own, the join's code is one method too long for the JVM to compile
    summ = summ.select(*keys, *chunk, "_s_k_first", "_s_k_last",
                       F.struct(*[f"_s_k{i}" for i in range(len(items))]).alias("_s_k"))
    x = x.select("*", *local)
    if dealt:
        # a join on the piece too would deal the rows out anew: its positions name it
        on = keys + [PC]
        summ = summ.drop(CH).withColumnsRenamed({c: f"_s_k_{i}" for i, c in enumerate(on)})
        found = F.col(POS).between(F.col("_s_k_first"), F.col("_s_k_last"))
        for i, c in enumerate(on):
            found = found & (F.col(c) == F.col(f"_s_k_{i}"))
        x = x.join(summ, found)   # every row has one
    else:
        x = x.join(summ, on=keys + chunk, how="left")
    outs = []
    for i, it in enumerate(items):
        if it.kind == "cumsum":
            outs.append((F.col(f"_s_l{i}") + F.col(f"_s_k._s_k{i}")).alias(it.name))
        else:
            outs.append(F.coalesce(F.col(f"_s_l{i}"), F.col(f"_s_k._s_k{i}")).alias(it.name))
    x = x.select(*[c for c in x.columns if c not in {it.name for it in items}], *outs)
    tmp = [c for c in x.columns if c.startswith(("_s_v", "_s_l", "_s_k"))] + [CH]
    return x.drop(*tmp)


# --------------------------------------------------------------------------
# linear recurrences s_p = a_p * s_{p-1} + b_p  (s_{-1} = 0)

def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared checkpoint folder named
    by ``spark.checkpoint.dir`` (reliable, survives executor loss) and
    continue from the written copy."""
    from cumulus.session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def linear_recurrence(df: DataFrame, spec: SeriesSpec, a: Column, b: Column,
                      name: str) -> DataFrame:
    """Solve ``s_p = a_p*s_{p-1} + b_p`` along each series (``s_{-1} = 0``)."""
    return linear_recurrences(df, spec, [(a, b, name)])


def affine_scan(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For n steps of m recurrences ``s = a*s + b`` (arrays n x m): the states from a
    zero start and the running products of ``a``.  Steps are laid out in about
    sqrt(n) blocks that advance side by side; block ends are then chained."""
    n, m = a.shape
    width = max(1, math.isqrt(n))
    blocks = -(-n // width)
    fill = blocks * width - n
    av = np.concatenate([a, np.ones((fill, m))]).reshape(blocks, width, m)
    bv = np.concatenate([b, np.zeros((fill, m))]).reshape(blocks, width, m)
    state, product = np.zeros((blocks, m)), np.ones((blocks, m))
    states, products = np.empty_like(av), np.empty_like(av)
    for i in range(width):
        state = av[:, i] * state + bv[:, i]
        product = product * av[:, i]
        states[:, i], products[:, i] = state, product
    enter, before = np.zeros((blocks, m)), np.ones((blocks, m))
    for k in range(1, blocks):
        enter[k] = products[k - 1, -1] * enter[k - 1] + states[k - 1, -1]
        before[k] = products[k - 1, -1] * before[k - 1]
    states += products * enter[:, None]
    products *= before[:, None]
    return states.reshape(-1, m)[:n], products.reshape(-1, m)[:n]


def row_chunks(x: DataFrame, spec: SeriesSpec) -> tuple[DataFrame, list[str]]:
    """Adds the chunk of each row: a time bucket of the positions step (so the data is
    already dealt out by it), cut into pieces of at most ``chunk_rows`` rows.  Returns
    the columns that name a chunk, in series order."""
    cut = F.floor(F.col(POS) / F.lit(spec.chunk_rows)).cast("long")
    x = x.withColumn(CH, cut)
    return (x, [PC, CH]) if PC in x.columns else (x, [CH])


def linear_recurrences(df: DataFrame, spec: SeriesSpec,
                       items: list[tuple[Column, Column, str]]) -> DataFrame:
    """Solve several recurrences ``s_p = a_p*s_{p-1} + b_p`` (``s_{-1} = 0``)
    in one pass.  A row whose ``a`` or ``b`` is NULL keeps the state, and its own
    result is that state.

    Phase 1 solves each chunk (at most ``chunk_rows`` rows) from a zero state, records
    the running product of ``a`` and is stored once; phase 2 composes the per-chunk
    affine maps over the chunk summary (one row per chunk) to get the state
    entering every chunk; phase 3 is ``s = A*s_in + s_local`` in SQL."""
    from cumulus.operators.joins import attach
    keys = _keys(spec)
    m = len(items)
    x, chunk = row_chunks(with_positions(df, spec), spec)
    cols = {}
    for i, (a, b, _) in enumerate(items):
        known = a.isNotNull() & b.isNotNull()
        cols[f"_s_ra{i}"] = F.when(known, a.cast("double")).otherwise(1.0)
        cols[f"_s_rb{i}"] = F.when(known, b.cast("double")).otherwise(0.0)
    x = x.withColumns(cols)
    given = list(cols)
    kept = x.drop(*given)
    extra = [T.StructField(f"_s_{what}{i}", T.DoubleType()) for i in range(m) for what in ("loc", "cum")]
    out_schema = T.StructType(list(kept.schema.fields) + extra)

    def local(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(POS, kind="stable")
        loc, cum = affine_scan(pdf[[f"_s_ra{i}" for i in range(m)]].to_numpy(dtype="float64"),
                               pdf[[f"_s_rb{i}" for i in range(m)]].to_numpy(dtype="float64"))
        pdf = pdf.drop(columns=given)
        for i in range(m):
            pdf[f"_s_loc{i}"], pdf[f"_s_cum{i}"] = loc[:, i], cum[:, i]
        return pdf

    solved = materialize(x.groupBy(*keys, *chunk).applyInPandas(local, out_schema))
    last = F.max_by(F.struct(*[F.col(f"_s_cum{i}").alias(f"A{i}") for i in range(m)],
                             *[F.col(f"_s_loc{i}").alias(f"B{i}") for i in range(m)]), F.col(POS)).alias("m")
    summ = solved.groupBy(*keys, *chunk).agg(last)
    summ = summ.select(*keys, *chunk, *[F.col(f"m.A{i}").alias(f"_s_A{i}") for i in range(m)],
                       *[F.col(f"m.B{i}").alias(f"_s_B{i}") for i in range(m)])
    key_schema = T.StructType([f for f in x.schema.fields if f.name in keys]
                              + [T.StructField(c, T.LongType()) for c in chunk]
                              + [T.StructField(f"_s_in{i}", T.DoubleType()) for i in range(m)])

    def compose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(chunk)
        states, _ = affine_scan(pdf[[f"_s_A{i}" for i in range(m)]].to_numpy(dtype="float64"),
                                pdf[[f"_s_B{i}" for i in range(m)]].to_numpy(dtype="float64"))
        out = pdf[keys + chunk].copy()
        for i in range(m):
            out[f"_s_in{i}"] = np.concatenate([[0.0], states[:-1, i]])
        return out

    entering = summ.groupBy(*keys).applyInPandas(compose, key_schema)
    # one row per chunk: where that is small, the solved rows needn't be dealt out again
    res = attach(solved, entering, keys + chunk, "left")
    res = res.withColumns({name: F.col(f"_s_cum{i}") * F.coalesce(F.col(f"_s_in{i}"), F.lit(0.0))
                           + F.col(f"_s_loc{i}") for i, (_, _, name) in enumerate(items)})
    drop = [f"_s_{k}{i}" for i in range(m) for k in ("loc", "cum", "in")]
    return res.drop(*drop, CH)
