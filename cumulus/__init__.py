"""cumulus: weather-station analytics on Spark DataFrames.

Every operator is a plain function ``f(df, ...) -> DataFrame`` built from
Spark SQL expressions, windows and (where a recurrence forces it) grouped
pandas maps over bounded chunks of a series.
"""

from cumulus.session import get_session, checkpoint_dir  # noqa: F401

__all__ = ["get_session", "checkpoint_dir"]
