"""A small registry: query name -> (Spark callable, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Runner = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    run: Runner
    sql: str | None
    covers: str


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None, covers: str = "") -> Callable[[Runner], Runner]:
    def deco(fn: Runner) -> Runner:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, covers)
        return fn

    return deco
