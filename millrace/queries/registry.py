"""Query registry."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..session import spread

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


class Tables:
    """The input tables of one folder, read lazily by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLE_NAMES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def spread(self, name: str) -> DataFrame:
        """The table dealt out to all cores, for heavy work on each row."""
        return spread(getattr(self, name))


@dataclass(frozen=True)
class Query:
    name: str
    ops: tuple[str, ...]
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, ops: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``.

    ``ops`` lists the operator ids the query covers; ``sql`` is the oracle.
    """

    def add(fn: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(
            name, tuple(ops.split()), lambda spark, folder: fn(Tables(spark, folder)), sql
        )
        return fn

    return add
