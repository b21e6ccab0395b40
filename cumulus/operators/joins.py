"""Lookups and dictionary joins.

Dimension tables are broadcast only after their rows and bytes have been measured
against bounds; beyond them the join stays a shuffle join (and AQE may still
turn it into a broadcast from runtime sizes, or split skewed keys).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cumulus.operators.series import materialize

# Largest dimension we broadcast: both bounds hold.
MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 64 << 20
# What a row and a fixed-width value take, about, once broadcast.
ROW_BYTES, VALUE_BYTES = 32, 8


def measured(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of a table: fixed widths by the schema, others by their contents."""
    fixed = ROW_BYTES + VALUE_BYTES * len(df.columns)
    wide = F.lit(0).cast("long")
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            wide = wide + F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            wide = wide + F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`")))), F.lit(0))
    rows, contents = df.agg(F.count(F.lit(1)), F.sum(wide)).first()
    return rows, rows * fixed + (contents or 0)


def attach(big: DataFrame, small: DataFrame, on, how: str = "left",
           max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Join ``small`` onto ``big``: broadcast when ``small`` is within both bounds as
    measured, else a plain shuffle join.  ``small`` is computed once and cut."""
    small = materialize(small)
    rows, size = measured(small)
    if rows <= max_rows and size <= max_bytes:
        return big.join(F.broadcast(small), on, how)
    return big.join(small, on, how)


def location_dim_join(df: DataFrame, dim: DataFrame, key: str = "location_id") -> DataFrame:
    """location_id -> (latitude, longitude), unknown sites keep NULLs."""
    return attach(df, dim.select(key, "latitude", "longitude"), key, "left")


def fit_location_codes(df: DataFrame, key: str = "location_id") -> DataFrame:
    """Dictionary of codes: rank of each distinct value in sorted order,
    0-based.  The distinct step is a partial aggregate, so the window only
    sees one row per value."""
    distinct = df.where(F.col(key).isNotNull()).select(key).distinct()
    return distinct.select(key, (F.dense_rank().over(Window.orderBy(key)) - 1).alias(f"{key}_enc"))


def encode_location(df: DataFrame, codes: DataFrame, key: str = "location_id",
                    unseen: int = 0) -> DataFrame:
    """Apply a code dictionary; values missing from it get ``unseen``."""
    out = attach(df, codes, key, "left")
    return out.withColumn(f"{key}_enc", F.coalesce(F.col(f"{key}_enc"), F.lit(unseen)).cast("int"))


# Fixed class names of the edge weather model.
WEATHER_CLASSES = {0: "Sunny", 1: "Cloudy", 2: "Light Rain", 3: "Heavy Rain"}


def class_names(df: DataFrame, col: str, out: str = "class_name",
                names: dict[int, str] | None = None) -> DataFrame:
    """Class id -> name; ids without a name become their own text."""
    names = WEATHER_CLASSES if names is None else names
    m = F.create_map(*[x for k, v in sorted(names.items()) for x in (F.lit(k), F.lit(v))])
    return df.withColumn(out, F.coalesce(F.element_at(m, F.col(col)), F.col(col).cast("string")))


def anti_existing(incoming: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming rows whose key is not stored yet."""
    return incoming.join(existing.select(*keys), keys, "left_anti")
