"""Registered queries: name -> job over the tables of a folder, and its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.adapters import Tables, sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable:
    """Register ``build(tables)`` as query ``name``, with SQL in terms of tables and roles."""

    def keep(build: Callable[[Tables], DataFrame]) -> Callable:
        QUERIES[name] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
        if oracle:
            ORACLE_SQL[name] = sql(oracle)
        return build

    return keep
