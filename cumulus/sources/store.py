"""Store-style operations on tables: insert-or-ignore, last-write-wins
upserts, latest reading, required fields, appends."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep the first arrival per key (``order`` ascending).  A partial
    aggregate (min of a struct) rather than a window: a key repeated a
    billion times still combines map-side."""
    others = [c for c in df.columns if c not in keys]
    st = F.struct(*[F.col(c) for c in order], *[F.col(c).alias(f"_v_{c}") for c in others])
    g = df.groupBy(*keys).agg(F.min(st).alias("_m"))
    return g.select(*keys, *[F.col(f"_m._v_{c}").alias(c) for c in others])


def insert_or_ignore(incoming: DataFrame, existing: DataFrame | None, keys: list[str],
                     order: list[str]) -> DataFrame:
    """Rows a UNIQUE(keys) INSERT OR IGNORE would add: the first arrival per
    key, minus keys already stored."""
    new = first_per_key(incoming, keys, order)
    if existing is not None:
        new = new.join(existing.select(*keys).distinct(), keys, "left_anti")
    return new


def upsert_last_wins(log: DataFrame, key: str = "key", value: str = "value", seq: str = "seq") -> DataFrame:
    """Key/value table after applying a log of writes: last write wins."""
    return log.groupBy(key).agg(F.max_by(F.col(value), F.col(seq)).alias(value),
                                F.max(F.col(seq)).alias("last_seq"))


def read_meta(table: DataFrame, key: str, default: str, key_col: str = "key",
              value_col: str = "value") -> DataFrame:
    """Point read with a default: one row (key, value)."""
    hit = table.where(F.col(key_col) == F.lit(key)).agg(F.max(F.col(value_col)).alias("_v"))
    return hit.select(F.lit(key).alias(key_col), F.coalesce("_v", F.lit(default)).alias(value_col))


def latest_reading(df: DataFrame, ts: str = "timestamp", keys: list[str] | None = None) -> DataFrame:
    """Newest row overall (TakeOrderedAndProject, a top-1 per partition then
    a merge) or, with ``keys``, the newest row per key (partial max_by)."""
    if not keys:
        return df.orderBy(F.col(ts).desc()).limit(1)
    others = [c for c in df.columns if c not in keys]
    g = df.groupBy(*keys).agg(F.max_by(F.struct(*others), F.col(ts)).alias("_m"))
    return g.select(*keys, *[F.col(f"_m.{c}").alias(c) for c in others])


def required_fields(df: DataFrame, cols: list[str]) -> DataFrame:
    """Records with every required text field present and non-empty."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull() & (F.col(c) != "")
    return df.where(cond)


def append_reading(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Append typed records stamped with ``created_at`` (UTC now)."""
    w = df.withColumn("created_at", F.current_timestamp()).write.mode("append").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
