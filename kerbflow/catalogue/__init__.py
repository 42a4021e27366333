"""Named queries over the benchmark tables, each with an equivalent SQL statement."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    build: Build
    sql: str | None


_QUERIES: dict[str, Query] = {}


def register(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    def add(build: Build) -> Build:
        if name in _QUERIES:
            raise ValueError(f"query {name} registered twice")
        _QUERIES[name] = Query(build, sql)
        return build

    return add


def all_queries() -> dict[str, Query]:
    from kerbflow.catalogue import (  # noqa: F401
        basics,
        dimension_queries,
        energy_queries,
        parking_queries,
        run_queries,
        storage_queries,
        streaming_queries,
        traffic_queries,
    )

    return dict(_QUERIES)
