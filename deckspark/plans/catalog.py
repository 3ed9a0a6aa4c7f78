"""Registry of the queries exposed through ``__spark_entry__``.

Each entry is a Spark builder ``fn(spark, sf_dir) -> DataFrame`` and, where
SQL can express it, the equivalent DuckDB SQL over the same tables.  Column
names are aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn

    return deco


def load_all() -> dict:
    # importing the modules registers their queries
    from . import q_core, q_deck, q_functions, q_io, q_stream, q_text_jobs  # noqa: F401  (registration)

    return REGISTRY
