"""Query registry: name → (Spark callable, oracle SQL or None)."""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lendspark.functions.exprs import present


@dataclass
class Registered:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: Callable[[], str] | None
    operators: str


REGISTRY: dict[str, Registered] = {}


def query(name: str, operators: str, sql: Callable[[], str] | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame``; output doubles are rounded
    for presentation (``present``)."""

    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            return present(fn(spark, sf_dir))

        build.__name__ = fn.__name__
        build.__doc__ = fn.__doc__
        REGISTRY[name] = Registered(name, build, sql, operators)
        return fn

    return deco
