"""Shared bits of the query registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrimtally.session import tune

Query = Callable[[SparkSession, str], DataFrame]
DIGITS = 6


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six digits: the last bits of a sum depend on the order of its terms."""
    return df.select(
        *[F.round(c, DIGITS).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


def r(expr: str, name: str) -> str:
    """The SQL form of ``rounded`` for one column."""
    return f"ROUND({expr}, {DIGITS}) AS {name}"


def rs(*names: str) -> str:
    return ", ".join(r(n, n) for n in names)


def avgs(*names: str, prefix: str = "avg_", table: str = "") -> str:
    return ", ".join(r(f"AVG({table}{n})", f"{prefix}{n}") for n in names)


class Registry:
    """Named queries with their oracle, where there is one."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, query: Query, sql: str | None = None) -> None:
        if name in self.queries:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            tune(spark)
            return rounded(query(spark, sf_dir))

        self.queries[name] = run
        if sql is not None:
            self.sql[name] = sql
