"""Registry of queries: name -> (Spark builder, oracle SQL, fixture views)."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from cumulus.sources.fixtures import with_views


@dataclass
class Entry:
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None
    views: tuple[str, ...] = field(default_factory=tuple)
    section: str = ""

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        return with_views(self.sql, *self.views) if self.views else self.sql.strip()


REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: str | None = None, views: tuple[str, ...] = (), section: str = ""):
    """Decorator registering ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(fn, sql, tuple(views), section)
        return fn
    return deco


def load_all() -> dict[str, Entry]:
    # Importing the modules registers their queries.
    from cumulus.plans import (q_sources, q_predicates, q_joins, q_aggregates,  # noqa: F401
                               q_windows, q_recursive, q_composed, q_ml, q_streaming)
    return REGISTRY
