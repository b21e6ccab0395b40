"""Joins of two tables by key and time: rows within an interval, and the last row
at or before a time.

`range_join` deals both tables out by (key, time bucket); a right row is copied into
each bucket that holds left rows it can match (two at most when buckets are as wide as
the interval).  Buckets with many left rows are cut into parts, and the right
rows go to all of them, so a station that holds a third of all rows, or one busy hour of
it, is spread over many tasks.

`asof_join` merges both tables into one series per key and carries the last right row
forward: a scan in row-bounded chunks (see `series`), never a whole key in one task.

Defined results: rows without a key or a time match nothing (left rows stay, with
NULLs); several right rows of one time: all match in a range join, the largest one (by
its columns in order) is the as-of row; repeated left rows are each kept; column names
of the right table that the left one has as well get the suffix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cumulus.operators import series as S
from cumulus.operators.joins import attach

#: Left rows of a (key, bucket) that one task joins.
PART_ROWS = 200_000


def _renamed(right: DataFrame, left: DataFrame, keys: list[str], suffix: str) -> tuple[DataFrame, list[str]]:
    """right without clashing names, and the names of its columns but the keys."""
    have = {c.lower() for c in left.columns}
    names = {c: f"{c}{suffix}" if c.lower() in have else c for c in right.columns if c not in keys}
    return right.select(*keys, *[F.col(c).alias(n) for c, n in names.items()]), list(names.values())


def range_join(left: DataFrame, right: DataFrame, keys: list[str], left_ts: str, right_ts: str,
               back_us: int, ahead_us: int = 0, how: str = "inner", suffix: str = "_right",
               part_rows: int = PART_ROWS) -> DataFrame:
    """Pairs with equal keys and right time in [left time - back, left time + ahead]; with
    ``how="left"`` left rows without a match appear once, with NULLs."""
    if how not in ("inner", "left"):
        raise ValueError(how)
    width = max(back_us + ahead_us, 1)
    right, names = _renamed(right, left, keys, suffix)
    r_ts = f"{right_ts}{suffix}" if right_ts not in names else right_ts
    bucket = lambda us: F.floor(us / F.lit(width)).cast("long")
    own = left.withColumn("_s_us", S.micros(left_ts)).withColumn("_s_b", bucket(F.col("_s_us")))
    # a row number of its own tells the parts of a hot bucket apart
    many = own.groupBy(*keys, "_s_b").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > part_rows)
    many = S.materialize(many.select(*keys, "_s_b", F.ceil(F.col("_n") / F.lit(part_rows)).cast("int").alias("_s_parts")))
    us = S.micros(r_ts)
    copies = right.withColumn("_r_us", us).where(F.col("_r_us").isNotNull()).withColumn(
        "_s_b", F.explode(F.sequence(bucket(F.col("_r_us") - F.lit(ahead_us)), bucket(F.col("_r_us") + F.lit(back_us)))))
    if many.isEmpty():
        on = [*keys, "_s_b"]
    else:
        part = F.pmod(F.xxhash64(*[F.col(c) for c in left.columns], F.monotonically_increasing_id()),
                      F.coalesce("_s_parts", F.lit(1)))
        own = attach(own, many, [*keys, "_s_b"]).withColumn("_s_part", part.cast("int")).drop("_s_parts")
        copies = attach(copies, many, [*keys, "_s_b"]).withColumn("_s_part", F.explode(
            F.sequence(F.lit(0), F.coalesce("_s_parts", F.lit(1)) - 1))).drop("_s_parts")
        on = [*keys, "_s_b", "_s_part"]
    a, b = own.alias("a"), copies.alias("b")
    match = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in on] + [
        F.col("b._r_us") >= F.col("a._s_us") - F.lit(back_us), F.col("b._r_us") <= F.col("a._s_us") + F.lit(ahead_us)]
    return a.join(b, match, how).select(*[F.col(f"a.{c}") for c in left.columns], *[F.col(f"b.{c}") for c in names])


def asof_join(left: DataFrame, right: DataFrame, keys: list[str], left_ts: str, right_ts: str,
              tolerance_us: int | None = None, suffix: str = "_right",
              spec: S.SeriesSpec = S.DEFAULT) -> DataFrame:
    """Each left row once, with the last right row of its key at or before its time (and
    not more than the tolerance before it), or NULLs."""
    right, names = _renamed(right, left, keys, suffix)
    r_ts = f"{right_ts}{suffix}" if right_ts not in names else right_ts
    given = F.struct(*[F.col(c) for c in names])
    carried = right.where(S.micros(r_ts).isNotNull()).groupBy(*keys, S.micros(r_ts).alias("_at")).agg(
        F.max(given).alias("_given")) if _orderable(right, names) else right.select(
        *keys, S.micros(r_ts).alias("_at"), given.alias("_given")).where(F.col("_at").isNotNull())
    own = F.struct(*[F.col(c) for c in left.columns]).alias("_own")

    def event(at: Column, tag: int) -> Column:
        # right rows of a time come before left rows of that time
        return F.timestamp_micros(at * 2 + F.lit(tag)).alias("_t")

    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    known = known & S.micros(left_ts).isNotNull()
    here = left.where(known).select(*keys, event(S.micros(left_ts), 1), own)
    there = carried.select(*keys, event(F.col("_at"), 0), "_given", "_at")
    both = here.unionByName(there, allowMissingColumns=True)
    merged = spec.with_(keys=tuple(keys), ts="_t", bucket_us=2 * spec.bucket_us)
    value = F.when(F.col("_given").isNotNull(), F.struct("_given", "_at"))
    out = S.scans(both, merged, [S.Scan("_last", value)]).where(F.col("_own").isNotNull())
    near = F.lit(True) if tolerance_us is None else S.micros(F.col("_own")[left_ts]) - F.col("_last._at") <= tolerance_us
    found = [F.when(near, F.col(f"_last._given.{c}")).alias(c) for c in names]
    out = out.select(*[F.col(f"_own.{c}").alias(c) for c in left.columns], *found)
    lost = left.where(~F.coalesce(known, F.lit(False)))
    return out.unionByName(lost, allowMissingColumns=True)


def _orderable(df: DataFrame, names: list[str]) -> bool:
    return not any(df.schema[c].dataType.typeName() in ("map", "variant") for c in names)
