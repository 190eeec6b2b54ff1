"""Registry of the engine's queries and of the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with the SQL that gives the same rows."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load() -> None:
    """Import the modules that register queries."""
    from tallyfold.plans import evidence_queries, file_queries, history_queries, result_queries, review_queries, rule_queries, service_queries, source_queries, stream_queries, text_queries  # noqa: F401


load()
FLAGSHIP = QUERIES["growth_history_by_customer"]
