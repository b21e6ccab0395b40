"""Helpers shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cumulus.operators.series import drop_helpers


def finish(df: DataFrame, digits: int = 6, cols: list[str] | None = None) -> DataFrame:
    """Drop helper columns, keep ``cols`` (if given) and round doubles, so
    the result compares equal across engines whatever the summation order."""
    df = drop_helpers(df)
    if cols is not None:
        df = df.select(*cols)
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(fround(F.col(f.name), digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def fround(c, digits: int = 6):
    """Round half up by binary arithmetic: floor(x * 10^d + 0.5) / 10^d.
    Both engines evaluate this identically (unlike decimal-string rounding,
    which differs on values whose shortest form ends in 5)."""
    s = float(10 ** digits)
    v = c.cast("double")
    return F.when(F.isnan(v), v).otherwise(F.floor(v * F.lit(s) + F.lit(0.5)) / F.lit(s))


def r(expr: str, digits: int = 6) -> str:
    """SQL snippet: the same rounding for the oracle."""
    s = float(10 ** digits)
    return f"(floor(CAST({expr} AS DOUBLE) * {s!r} + 0.5) / {s!r})"
