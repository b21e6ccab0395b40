"""Positional access: the n-th row of the table sorted by (key, time)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cumulus.operators import series as S
from cumulus.operators.series import DEFAULT, POS, SeriesSpec


def row_by_index(df: DataFrame, n: int | None = None, spec: SeriesSpec = DEFAULT) -> DataFrame:
    """Row ``n`` (0-based; default the last) of the table sorted by key then
    time, with ``row_index``.  The global index is the key's offset (running
    sum of per-key counts over the small per-key table) plus the position in
    the series; only the one series holding the row is positioned.  Out of
    range -> no row."""
    keys = list(spec.keys)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.orderBy(*keys)
    offs = counts.select(*keys, "_cnt",
                         F.coalesce(F.sum("_cnt").over(w.rowsBetween(Window.unboundedPreceding, -1)),
                                    F.lit(0)).alias("_off"),
                         F.sum("_cnt").over(Window.partitionBy()).alias("_total"))
    target = F.lit(n) if n is not None else F.col("_total") - 1
    sel = (offs.withColumn("_target", target)
               .where((F.col("_off") <= F.col("_target")) & (F.col("_target") < F.col("_off") + F.col("_cnt"))
                      & (F.col("_target") >= 0))
               .select(*keys, "_off", "_target"))
    # at most one series contains the target row
    x = S.with_positions(df.join(F.broadcast(sel), keys, "inner"), spec)
    x = x.where(F.col(POS) == F.col("_target") - F.col("_off"))
    return x.withColumn("row_index", F.col("_target")).drop("_off", "_target")
