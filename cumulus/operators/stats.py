"""Statistics and metrics as aggregates: quantiles, correlations,
histograms, class balance, outliers, confusion counts, ROC AUC, F1 sweep,
precision@k."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cumulus.operators.joins import attach
from cumulus.operators.series import materialize
from cumulus.session import checkpoint_dir


# ---------------------------------------------------------------- quantiles

def _log_scale(v):
    """Monotone in v over all doubles, with even steps per order of magnitude."""
    return F.when(v == 0, F.lit(0.0)).otherwise(F.signum(v) * (F.log(F.abs(v)) + F.lit(745.0)))


def exact_quantiles(df: DataFrame, col, qs: list[float], keys: list[str] | tuple = (),
                    buckets: int = 4096, final_rows: int = 100_000) -> DataFrame:
    """Exact quantiles with linear interpolation (as numpy / pandas /
    ``percentile``), per group of ``keys`` and per column, without gathering
    a group in one task.

    Each target rank is bracketed by an interval of actual values; a pass
    histograms the values inside the interval into ``buckets`` bins
    (a partial aggregate), keeps the bin holding the rank, and narrows the
    interval to that bin's min / max.  Once a bin holds one distinct value or
    at most ``final_rows`` values, those few are ranked directly.  The state
    is one row per (group, column, quantile, rank) and is checkpointed each
    pass; the narrow (key, column, value) projection is persisted for the
    passes.  Output: keys..., ``column`` (if several), ``q``, ``value``."""
    from pyspark import StorageLevel
    cols = [col] if isinstance(col, str) else list(col)
    user_keys = list(keys)
    sp = df.sparkSession
    checkpoint_dir(sp)
    pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v")) for c in cols])
    x = df.select(*user_keys, F.explode(pairs).alias("_p"))
    x = x.select(*user_keys, F.col("_p.c").alias("_col"), F.col("_p.v").alias("_v"))
    x = x.where(F.col("_v").isNotNull() & ~F.isnan(F.col("_v")))
    keys = user_keys + ["_col"]
    x = x.persist(StorageLevel.MEMORY_AND_DISK)
    st = x.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_a"), F.max("_v").alias("_b"))
    targets = F.array(*[F.struct(F.lit(i).alias("qi"), F.lit(float(q)).alias("q"), F.lit(w).alias("w"))
                        for i, q in enumerate(qs) for w in (0, 1)])
    st = st.select(*keys, "_n", "_a", "_b", F.explode(targets).alias("_t"))
    h = F.col("_t.q") * (F.col("_n") - 1)
    st = st.select(*keys, "_n", F.col("_t.qi").alias("_qi"), F.col("_t.q").alias("_q"),
                   F.col("_t.w").alias("_w"), h.alias("_h"),
                   F.when(F.col("_t.w") == 0, F.floor(h)).otherwise(F.ceil(h)).cast("long").alias("_k"),
                   "_a", "_b", F.lit(0).cast("long").alias("_r"), F.col("_n").alias("_c"))
    tk = keys + ["_qi", "_w"]
    st = st.checkpoint(eager=True)
    # a pass puts the ends of an interval in two bins, so it always narrows: by
    # magnitude first, then evenly, some six passes for any doubles
    while True:
        open_ = st.where((F.col("_a") < F.col("_b")) & (F.col("_c") > final_rows))
        if open_.limit(1).count() == 0:
            break
        j = attach(x, open_.select(*tk, "_k", "_a", "_b", "_r"), keys, "inner")
        j = j.where((F.col("_v") >= F.col("_a")) & (F.col("_v") <= F.col("_b")))
        wide = ((F.col("_a") * F.col("_b") <= 0)
                | (F.greatest(F.abs("_a"), F.abs("_b")) > 16 * F.least(F.abs("_a"), F.abs("_b"))))
        share = F.when(wide, (_log_scale(F.col("_v")) - _log_scale(F.col("_a")))
                       / (_log_scale(F.col("_b")) - _log_scale(F.col("_a")))).otherwise(
            (F.col("_v") - F.col("_a")) / (F.col("_b") - F.col("_a")))
        bk = F.least(F.floor(share * buckets), F.lit(buckets - 1))
        hist = (j.withColumn("_bk", bk)
                 .groupBy(*tk, "_k", "_r", "_bk")
                 .agg(F.count(F.lit(1)).alias("_cnt"), F.min("_v").alias("_mn"), F.max("_v").alias("_mx")))
        w = Window.partitionBy(*tk).orderBy("_bk").rowsBetween(Window.unboundedPreceding, 0)
        hist = hist.withColumn("_cum", F.sum("_cnt").over(w))
        pick = hist.where((F.col("_r") + F.col("_cum") - F.col("_cnt") <= F.col("_k"))
                          & (F.col("_k") < F.col("_r") + F.col("_cum")))
        pick = pick.select(*tk, F.col("_mn").alias("_a2"), F.col("_mx").alias("_b2"),
                           (F.col("_r") + F.col("_cum") - F.col("_cnt")).alias("_r2"),
                           F.col("_cnt").alias("_c2"))
        st = (st.join(pick, tk, "left")
                .select(*keys, "_n", "_qi", "_q", "_w", "_h", "_k",
                        F.coalesce("_a2", "_a").alias("_a"), F.coalesce("_b2", "_b").alias("_b"),
                        F.coalesce("_r2", "_r").alias("_r"), F.coalesce("_c2", "_c").alias("_c"))
                .checkpoint(eager=True))
    # resolve: one distinct value left -> it; else rank the few candidates
    small = st.where(F.col("_a") < F.col("_b"))
    cand = attach(x, small.select(*tk, "_k", "_a", "_b", "_r"), keys, "inner")
    cand = cand.where((F.col("_v") >= F.col("_a")) & (F.col("_v") <= F.col("_b")))
    rn = F.row_number().over(Window.partitionBy(*tk).orderBy("_v")) - 1
    ranked = (cand.withColumn("_rn", rn).where(F.col("_rn") == F.col("_k") - F.col("_r"))
                  .select(*tk, F.col("_v").alias("_val")))
    res = st.join(ranked, tk, "left").withColumn(
        "_val", F.when(F.col("_a") == F.col("_b"), F.col("_a")).otherwise(F.col("_val")))
    lo = res.where(F.col("_w") == 0).select(*keys, "_qi", "_q", "_h", F.col("_val").alias("_lo"))
    hi = res.where(F.col("_w") == 1).select(*keys, "_qi", F.col("_val").alias("_hi"))
    out = lo.join(hi, keys + ["_qi"])
    frac = F.col("_h") - F.floor(F.col("_h"))
    value = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * frac
    sel = [*user_keys] + ([F.col("_col").alias("column")] if len(cols) > 1 else [])
    out = out.select(*sel, F.col("_q").alias("q"), value.alias("value")).checkpoint(eager=True)
    x.unpersist()
    return out


def quantile_values(df: DataFrame, col, qs: list[float]):
    """Global exact quantiles as Python numbers: a list per q for one
    column, or {column: [..]} for several."""
    res = exact_quantiles(df, col, qs).collect()
    if isinstance(col, str):
        got = {r["q"]: r["value"] for r in res}
        return [got.get(float(q)) for q in qs]
    out = {c: [None] * len(qs) for c in col}
    for r_ in res:
        out[r_["column"]][qs.index(r_["q"])] = r_["value"]
    return out


# ---------------------------------------------------------------- profiles

def class_balance(df: DataFrame, label: str = "cloudburst") -> DataFrame:
    """One row: rows, positives, negatives, scale_pos_weight = neg / max(1,
    pos), balanced weights n / (2 n_c) for each class."""
    a = df.agg(F.count(F.lit(1)).alias("rows"),
               F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("positives"),
               F.sum(F.when(F.col(label) == 0, 1).otherwise(0)).alias("negatives"))
    return a.select(
        "rows", "positives", "negatives",
        (F.col("negatives") / F.greatest(F.lit(1), F.col("positives"))).alias("scale_pos_weight"),
        (F.col("rows") / (F.lit(2.0) * F.col("negatives"))).alias("weight_negative"),
        (F.col("rows") / (F.lit(2.0) * F.col("positives"))).alias("weight_positive"))


def zscore_outliers(df: DataFrame, cols: list[str], label: str | None = "cloudburst",
                    rain_col: str = "rainfall_mm", z: float = 3.0) -> DataFrame:
    """Global mean and sample std per column (one aggregate row, read back
    as literals); abs(z) > 3 flags ``<col>_is_outlier`` and NULLs the value;
    rain is flagged only on label-0 rows; std 0 or undefined -> no flags."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_samp(c).alias(f"s_{c}")]
    st = df.agg(*aggs).first()
    x = df
    for c in cols:
        m, s = st[f"m_{c}"], st[f"s_{c}"]
        if m is None or s is None or s == 0 or np.isnan(s):
            flag = F.lit(False)
        else:
            flag = F.coalesce(F.abs((F.col(c) - F.lit(m)) / F.lit(s)) > F.lit(z), F.lit(False))
        if c == rain_col and label is not None and label in df.columns:
            flag = flag & (F.col(label) == 0)
        x = (x.withColumn(f"{c}_is_outlier", flag)
              .withColumn(c, F.when(F.col(f"{c}_is_outlier"), F.lit(None).cast("double")).otherwise(F.col(c))))
    return x


def correlation_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation of every pair in one aggregate, as rows
    (col_a, col_b, corr); pairs use the rows where both are present."""
    cols = [c for c in cols if c in df.columns]
    aggs = [F.corr(a, b).alias(f"{i}_{j}") for i, a in enumerate(cols) for j, b in enumerate(cols)]
    wide = df.agg(*aggs)
    pairs = ", ".join(f"'{a}', '{b}', `{i}_{j}`" for i, a in enumerate(cols) for j, b in enumerate(cols))
    return wide.selectExpr(f"stack({len(cols) ** 2}, {pairs}) as (col_a, col_b, corr)")


def automatic_bins(df: DataFrame, col: str) -> int:
    """Number of equal bins over min..max: the larger of Sturges' (log2 n + 1) and
    Freedman and Diaconis' (bins of 2 IQR / n^(1/3); not used when the IQR is 0)."""
    row = df.agg(F.count(col).alias("n"), F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    n, lo, hi = row["n"], row["lo"], row["hi"]
    if not n or hi <= lo:
        return 1
    q1, q3 = quantile_values(df, col, [0.25, 0.75])
    width = (hi - lo) / (math.log2(n) + 1.0)
    spread = 2.0 * (q3 - q1) / n ** (1.0 / 3.0)
    return max(1, math.ceil((hi - lo) / (min(width, spread) if spread > 0 else width)))


def approximate_quantiles(df: DataFrame, col, qs: list[float], keys: list[str] | tuple = (),
                          accuracy: int = 10_000) -> DataFrame:
    """Quantiles that are readings (the smallest with at least a share q of the others at
    or below it), per group and column, from one mergeable sketch each in a single
    scan: the rank is off by n / ``accuracy`` at most.  keys..., column, q, value."""
    cols = [col] if isinstance(col, str) else list(col)
    sketches = [F.percentile_approx(F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")),
                                    [float(q) for q in qs], accuracy).alias(f"_{i}") for i, c in enumerate(cols)]
    got = df.groupBy(*keys).agg(*sketches)
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(float(q)).alias("q"), F.col(f"_{i}")[k].alias("value"))
                     for i, c in enumerate(cols) for k, q in enumerate(qs)])
    return got.select(*keys, F.explode(rows).alias("_r")).select(*keys, "_r.column", "_r.q", "_r.value")


def label_histogram(df: DataFrame, col: str, label: str = "cloudburst", bins: int | str = 20) -> DataFrame:
    """Density histogram of ``col`` per label over common bins spanning the
    global min..max: density = count / (n_label * width).  ``bins`` is their number, or
    "auto" (see `automatic_bins`)."""
    if bins == "auto":
        bins = automatic_bins(df, col)
    mm = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    lo, hi = mm["lo"], mm["hi"]
    if lo is None:
        return df.sparkSession.createDataFrame([], "label int, bin int, bin_low double, bin_high double, count long, density double")
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((F.col(col) - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    x = df.where(F.col(col).isNotNull()).withColumn("bin", b)
    counts = x.groupBy(label, "bin").agg(F.count(F.lit(1)).alias("_c"))
    n = x.groupBy(label).agg(F.count(F.lit(1)).alias("_nl"))
    every = n.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    out = every.join(counts, [label, "bin"], "left").withColumn("count", F.coalesce("_c", F.lit(0)))
    return out.select(F.col(label).alias("label"), "bin",
                      (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_low"),
                      (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_high"),
                      "count", (F.col("count") / (F.col("_nl") * F.lit(width))).alias("density"))


# ---------------------------------------------------------------- classification metrics

def confusion_matrix(df: DataFrame, y: str = "label", yhat: str = "prediction",
                     classes: list[int] = (0, 1)) -> DataFrame:
    """Counts by (actual, predicted) pivoted to columns pred_<c>, zero-filled."""
    g = df.groupBy(F.col(y).alias("actual")).pivot(yhat, list(classes)).count().na.fill(0)
    for c in classes:
        g = g.withColumnRenamed(str(c), f"pred_{c}")
    return g


def accuracy(df: DataFrame, y: str = "label", yhat: str = "prediction") -> DataFrame:
    return df.agg(F.avg((F.col(y) == F.col(yhat)).cast("double")).alias("accuracy"),
                  F.count(F.lit(1)).alias("n"))


def classification_report(df: DataFrame, y: str = "label", yhat: str = "prediction",
                          digits: int = 3) -> DataFrame:
    """precision, recall, f1, support per class plus macro and weighted
    averages; 0/0 -> 0.  Built from one small count table."""
    c = df.groupBy(F.col(y).alias("y"), F.col(yhat).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    ys = c.groupBy(F.col("y").alias("cls")).agg(F.sum("n").alias("support"))
    ps = c.groupBy(F.col("p").alias("cls")).agg(F.sum("n").alias("predicted"))
    tp = c.where(F.col("y") == F.col("p")).select(F.col("y").alias("cls"), F.col("n").alias("tp"))
    per = (ys.join(ps, "cls", "full").join(tp, "cls", "left").na.fill(0, ["support", "predicted", "tp"]))
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("predicted")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support")), F.lit(0.0))
    per = per.select(F.col("cls").cast("string").alias("class"), prec.alias("precision"),
                     rec.alias("recall"), "support")
    per = per.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"),
                                                       F.col("precision") + F.col("recall")), F.lit(0.0)))
    macro = per.agg(F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"),
                    F.avg("recall").alias("recall"), F.sum("support").alias("support"), F.avg("f1").alias("f1"))
    t = F.sum("support")
    weighted = per.agg(F.lit("weighted avg").alias("class"),
                       (F.sum(F.col("precision") * F.col("support")) / t).alias("precision"),
                       (F.sum(F.col("recall") * F.col("support")) / t).alias("recall"),
                       t.alias("support"),
                       (F.sum(F.col("f1") * F.col("support")) / t).alias("f1"))
    out = per.select("class", "precision", "recall", "support", "f1").unionByName(macro).unionByName(weighted)
    return out.select("class", *[F.round(c, digits).alias(c) for c in ("precision", "recall", "f1")], "support")


def roc_auc(df: DataFrame, score: str = "probability", label: str = "label", ranges: int = 256) -> DataFrame:
    """Area under the ROC curve, exact, with tied scores at half credit (average
    ranks).  Rows are counted per score (a partial aggregate); the negatives below
    a score are those of the score ranges before plus a running sum inside its
    range, so no task sees all scores.  One class only -> NULL auc."""
    x = df.where(F.col(score).isNotNull()).select(F.col(score).cast("double").alias("s"), F.col(label).alias("y"))
    at = [i / ranges for i in range(1, ranges)]
    bounds = sorted(set(x.agg(F.percentile_approx("s", at).alias("b")).first()["b"] or []))
    cuts = F.array(*[F.lit(b) for b in bounds]) if bounds else F.array().cast("array<double>")
    g = (x.groupBy("s").agg(F.sum(F.when(F.col("y") == 1, 1).otherwise(0)).alias("pos"),
                            F.sum(F.when(F.col("y") == 1, 0).otherwise(1)).alias("neg"))
          .withColumn("range", F.size(F.filter(cuts, lambda b: b <= F.col("s")))))
    sums = g.groupBy("range").agg(F.sum("neg").alias("n"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    ahead = sums.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    w = Window.partitionBy("range").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    g = g.withColumn("below", F.coalesce(F.sum("neg").over(w), F.lit(0))).join(ahead, "range")
    a = g.agg(F.sum(F.col("pos") * (F.col("ahead") + F.col("below") + F.col("neg") * 0.5)).alias("u"),
              F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return a.select(F.when((F.col("P") > 0) & (F.col("N") > 0),
                           F.col("u") / (F.col("P") * F.col("N"))).alias("auc"),
                    F.col("P").alias("positives"), F.col("N").alias("negatives"))


def sweep_thresholds(n: int = 200, lo: float = 0.01, hi: float = 0.99) -> list[float]:
    """The threshold grid: n evenly spaced points from lo to hi inclusive."""
    return [float(t) for t in np.linspace(lo, hi, n)]


def f1_sweep(df: DataFrame, score: str = "probability", label: str = "label",
             thresholds: list[float] | None = None) -> DataFrame:
    """Precision, recall and F1 of ``score >= t`` for every grid threshold in
    one pass: each row's bucket = how many thresholds it reaches (exact
    comparison against the literal grid), counts per bucket, then reverse
    cumulative sums over at most len(grid) + 1 buckets."""
    ts = thresholds or sweep_thresholds()
    n = len(ts)
    arr = F.array(*[F.lit(t) for t in ts])
    step = (ts[-1] - ts[0]) / (n - 1) if n > 1 else 1.0
    p = F.col(score)
    guess = F.least(F.greatest(F.floor((p - F.lit(ts[0])) / F.lit(step)) + 1, F.lit(0)), F.lit(n)).cast("int")
    # fix the guess against the exact grid values (at most one step off)
    b = F.when((guess > 0) & (p < F.element_at(arr, F.greatest(guess, F.lit(1)))), guess - 1).otherwise(guess)
    b = F.when((b < n) & (p >= F.element_at(arr, F.least(b + 1, F.lit(n)))), b + 1).otherwise(b)
    x = df.where(p.isNotNull()).withColumn("_b", b)
    cnt = x.groupBy("_b").agg(F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("pos"),
                              F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).alias("neg"))
    cnt = materialize(cnt)  # read twice: the scores behind it may cost a lot
    spark = df.sparkSession
    P = cnt.agg(F.coalesce(F.sum("pos"), F.lit(0)).alias("P")).first()["P"]
    grid = spark.createDataFrame([(i, t) for i, t in enumerate(ts)], "i int, threshold double")
    # threshold i is reached by rows of bucket >= i + 1: reverse running sums
    j = grid.join(F.broadcast(cnt), F.col("_b") == F.col("i") + 1, "left")
    rev = Window.orderBy(F.col("i").desc()).rowsBetween(Window.unboundedPreceding, 0)
    out = j.select("i", "threshold",
                   F.sum(F.coalesce("pos", F.lit(0))).over(rev).alias("tp"),
                   F.sum(F.coalesce("neg", F.lit(0))).over(rev).alias("fp"))
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fp")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.lit(P)), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2.0 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + (F.lit(P) - F.col("tp"))),
                    F.lit(0.0))
    return out.select("i", "threshold", "tp", "fp", prec.alias("precision"), rec.alias("recall"), f1.alias("f1"))


def best_f1(sweep: DataFrame) -> DataFrame:
    """First threshold reaching the maximum F1."""
    return sweep.orderBy(F.col("f1").desc(), F.col("i").asc()).limit(1).select(
        F.col("threshold").alias("best_f1_threshold"), F.col("f1").alias("best_f1_value"))


def precision_at_k(df: DataFrame, score: str = "probability", label: str = "label", k: int = 100,
                   tiebreak: list[str] | None = None) -> DataFrame:
    """Mean label of the k highest scores (ties broken by ``tiebreak``
    columns) and the k-th score (NULL when fewer than k rows, where the
    precision is the overall mean).  Top-k is TakeOrderedAndProject."""
    order = [F.col(score).desc()] + [F.col(c).asc() for c in (tiebreak or [])]
    top = df.where(F.col(score).isNotNull()).orderBy(*order).limit(k)
    return top.agg(F.avg(F.col(label).cast("double")).alias("precision_at_k"),
                   F.when(F.count(F.lit(1)) >= k, F.min(score)).alias("kth_score"),
                   F.count(F.lit(1)).alias("k_used"))


def thresholds_table(df: DataFrame, score: str = "probability", label: str = "label",
                     k: int = 100, tiebreak: list[str] | None = None) -> DataFrame:
    """One row: precision_at_100, its k-th probability, best F1 threshold
    and value."""
    pk = precision_at_k(df, score, label, k, tiebreak).first()
    bf = best_f1(f1_sweep(df, score, label)).first()
    return df.sparkSession.createDataFrame(
        [(pk["precision_at_k"], pk["kth_score"], bf["best_f1_threshold"] if bf else None,
          bf["best_f1_value"] if bf else None)],
        f"precision_at_{k} double, precision_at_{k}_threshold_prob double, "
        "best_f1_threshold double, best_f1_value double")
