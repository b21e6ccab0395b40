"""Quality rules with risk-controlled thresholds.

Rules compare a ratio of counts with a cutoff.  The cutoffs come from labelled
documents: within each stratum (language) and for each rule the candidate
cutoffs are tested from the loosest to the strictest, and the strictest is taken
for which the exact binomial bound says that at most alpha / rules of the good
documents fall to it, with an error probability of delta / (rules x strata).
Testing in a fixed order and stopping at the first failure needs no further
correction for the number of cutoffs; rules and strata are corrected for
(Bonferroni).  A stratum with too few labels gets no cutoff for that rule, so
nothing is rejected there on thin evidence.

Only counts by (stratum, rule, cutoff) leave the documents; the choice runs as a
grouped map over strata.

Defined results: NULL and empty texts have no words and fail the base rule;
NULL languages are a stratum of their own; NULL ids match no label; labels that
repeat count once, as good only if all say so; with an empty table or no labels
only the base rules reject; other columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from cumulus.llm.common import checked_broadcast, fresh, small_batches, text_of

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent

NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper",
         "n_letters", "n_marks", "n_digits")
METRICS = T.StructType([T.StructField(m, T.LongType()) for m in NAMES])

#: rule -> (ratio, above which a document is rejected; cutoffs, loosest first)
RULES: dict[str, tuple[str, tuple[float, ...]]] = {
    "long_words": ("word_chars / n_words", (40, 30, 25, 20, 17, 15, 13)),
    "short_words": ("-word_chars / n_words", (-1.0, -1.5, -2.0, -2.5, -3.0)),
    "symbols": ("n_symbols / n_words", (2.0, 1.0, 0.8, 0.6, 0.5, 0.4, 0.3, 0.2)),
    "repeated_lines": ("n_dup_lines / n_lines", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4)),
    "repeated_words": ("n_repeat_words / n_words", (0.48, 0.45, 0.4, 0.35, 0.3)),
    "capitals": ("n_upper / n_letters", (0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4)),
    "marks": ("n_marks / n_words", (2.0, 1.0, 0.8, 0.6, 0.5, 0.4, 0.3)),
    "digits": ("n_digits / word_chars", (0.8, 0.6, 0.5, 0.4, 0.3)),
}


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more, the first included."""
    n = len(words)
    if n < 4:
        return 0
    code: dict[bytes, int] = {}
    a = np.fromiter((code.setdefault(w, len(code)) for w in words), dtype=np.int64, count=n)
    if len(code) == n:
        return 0
    v = len(code)
    pair = a[:-1] * v + a[1:]
    if v >= 2 ** 20:
        pair = np.unique(pair, return_inverse=True)[1]
    _, at, times = np.unique(pair[:-1] * v + a[2:], return_inverse=True, return_counts=True)
    again = times[at] > 1
    inside = np.zeros(n, dtype=bool)
    for k in range(3):
        inside[k:n - 2 + k] |= again
    return int(inside.sum())


def measure(text: str) -> tuple[int, ...]:
    raw = text.encode("utf-8", "replace")
    words = raw.split()  # exactly at the six white-space characters
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]

    def count(chars: bytes) -> int:
        return len(raw) - len(raw.translate(None, chars))

    upper, lower = count(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), count(b"abcdefghijklmnopqrstuvwxyz")
    return (len(words), len(text) - count(BLANKS.encode()), count(SYMBOLS.encode()),
            len(lines) - len(set(lines)), repeated_words(words), len(lines), upper, upper + lower,
            count(b"!?"), count(b"0123456789"))


@F.pandas_udf(METRICS)
def metrics(text: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([measure(text_of(t)) for t in text], columns=NAMES)


def stratum_of(col: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), col.cast("string")), F.lit("~"))


def base_failed(m: str = "") -> Column:
    n = F.col(f"{m}n_words")
    return (n < LEAST_WORDS) | (100 * F.col(f"{m}n_repeat_words") > MOST_REPEATED * n)


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             stratum_col: str = "lang") -> DataFrame:
    """doc_id, stratum and the metrics of every document."""
    small_batches(docs)
    m = docs.select(F.col(id_col).alias("doc_id"), stratum_of(F.col(stratum_col)).alias("stratum"),
                    metrics(F.col(text_col)).alias("m"))
    return m.select("doc_id", "stratum", "m.*")


def tail(n: int, k: int, p: float) -> float:
    """P(Binomial(n, p) <= k), exact up to rounding."""
    i = np.arange(1, k + 1, dtype=float)
    steps = np.cumsum(np.log((n - i + 1) / i)) if k else np.zeros(0)
    logs = np.concatenate([[0.0], steps + i * np.log(p / (1 - p))]) + n * np.log1p(-p)
    return float(min(1.0, np.exp(logs).sum()))


def choose(first_cut: np.ndarray, n: int, risk: float, error: float) -> int:
    """first_cut[k]: good documents that cutoff k is the first to reject, of n.  The
    strictest cutoff that keeps the risk, or -1."""
    best, lost = -1, 0
    for k, more in enumerate(first_cut):
        lost += int(more)
        if n == 0 or tail(n, lost, risk) > error:
            break
        best = k
    return best


def calibrate(measures: DataFrame, labels: DataFrame, alpha: float = 0.04, delta: float = 0.05) -> DataFrame:
    """One row per stratum: stratum, cutoffs (a map rule -> cutoff, without the rules
    that got none).  labels: doc_id, quality (1 good)."""
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    good = measures.where(~base_failed()).join(marks.where("quality = 1"), "doc_id")
    firsts = []
    for rule, (ratio, cuts) in RULES.items():
        value = F.expr(f"try_divide({ratio.split(' / ')[0]}, {ratio.split(' / ')[1]})")
        passed = sum((F.when(value > c, 0).otherwise(1) for c in cuts[1:]), F.when(value > cuts[0], 0).otherwise(1))
        firsts.append(F.struct(F.lit(rule).alias("rule"), passed.alias("first")))
    counts = (good.select("stratum", F.explode(F.array(*firsts)).alias("r"))
              .groupBy("stratum", "r.rule", "r.first").agg(F.count("*").alias("n")))
    strata = measures.select("stratum").distinct().count()
    risk, error = alpha / len(RULES), delta / (len(RULES) * max(1, strata))

    def pick(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        got = {}
        for rule, own in rows.groupby("rule"):
            cuts = RULES[rule][1]
            first = np.zeros(len(cuts) + 1, dtype=np.int64)
            np.add.at(first, own["first"].to_numpy(), own["n"].to_numpy())
            k = choose(first[:-1], int(first.sum()), risk, error)
            if k >= 0:
                got[rule] = float(cuts[k])
        return pd.DataFrame({"stratum": [key[0]], "cutoffs": [got]})

    return counts.groupBy("stratum").applyInPandas(pick, "stratum string, cutoffs map<string, double>")


def verdict(cutoffs: Column) -> Column:
    """True if no rule with a cutoff rejects the metrics in scope."""
    ok = F.lit(True)
    for rule, (ratio, _) in RULES.items():
        over = F.expr(f"try_divide({ratio.split(' / ')[0]}, {ratio.split(' / ')[1]})") > cutoffs[rule]
        ok = ok & ~F.coalesce(over, F.lit(False))
    return ok


def judge(measures: DataFrame, thresholds: DataFrame) -> DataFrame:
    """measures with base_failed and kept."""
    both = measures.join(checked_broadcast(thresholds), "stratum", "left")
    return both.withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & verdict(F.col("cutoffs"))).drop("cutoffs")


def keep_good(docs: DataFrame, thresholds: DataFrame, text_col: str = "text",
              stratum_col: str = "lang") -> DataFrame:
    """The documents that pass, with their columns; the metrics are taken again in
    this pass, so texts are not shuffled."""
    m, s, all_cols = fresh(docs, "m", "stratum", "all")
    rows = docs.select(F.struct(*docs.columns).alias(all_cols), metrics(F.col(text_col)).alias(m),
                       stratum_of(F.col(stratum_col)).alias("stratum"))
    wide = rows.select(all_cols, "stratum", f"{m}.*")
    return judge(wide, thresholds).where("kept").select(f"{all_cols}.*")
