"""Registry of every query: name -> (spark, sf_dir) -> DataFrame, and name -> oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import analytics, loading_queries, oracle_analytics, oracle_loading, oracle_storage, storage_queries, stream_queries

QueryFn = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, QueryFn]:
    out: dict[str, QueryFn] = {}
    out.update(analytics.QUERIES)
    out.update(loading_queries.QUERIES)
    out.update(storage_queries.QUERIES)
    out.update(stream_queries.QUERIES)
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    out.update({name: oracle_analytics.oracle(name) for name in oracle_analytics.SQL})
    out.update({name: oracle_loading.oracle(name) for name in oracle_loading.SQL})
    out.update({name: oracle_storage.oracle(name) for name in oracle_storage.SQL})
    out.update(stream_queries.SQL)
    return out
