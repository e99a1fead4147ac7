"""Tables of a scale folder, and the registry type of query modules."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.session import ship

Query = Callable[[SparkSession, str], DataFrame]


def shipped(queries: dict[str, Query]) -> dict[str, Query]:
    """queries, each of which first sees to it that the workers have this package."""

    def with_code(query: Query) -> Query:
        @functools.wraps(query)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship(spark)
            return query(spark, folder)

        return run

    return {name: with_code(query) for name, query in queries.items()}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
