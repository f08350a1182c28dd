"""All registered queries of the library proper with their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
FLAGSHIP = "shard_counts"


def query(sql: str | None = None) -> Callable:
    """Register a function (spark, sf_dir) -> DataFrame under its own name, with its SQL."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


from skein.plans import corpus, documents, states, upkeep  # noqa: E402, F401  (they register their queries)
