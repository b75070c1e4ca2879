"""Query registry and the fixtures that queries share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.plans.feed import crash_feed


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(fn, sql)
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crash_feed(table(spark, sf_dir, "events"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with a fixed score ``p`` and an unrelated 0/1 target ``y``."""
    return table(spark, sf_dir, "lineitem").select(
        "*",
        F.round(F.col("l_quantity") / 50 + F.col("l_tax"), 2).alias("p"),
        F.when(F.col("l_partkey") * 37 % 29 < 2, 1).otherwise(0).alias("y"),
    )


def planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items whose 0/1 target ``y`` depends on the return flag and the quantity."""
    draw = F.col("l_partkey") * 37 % 100
    limit = F.when(F.col("l_returnflag") == "R", 20).when(F.col("l_returnflag") == "A", 5).otherwise(2)
    steep = F.when(F.col("l_quantity") > 25, 30).otherwise(5)
    return table(spark, sf_dir, "lineitem").select(
        "*",
        F.when(draw < limit, 1).otherwise(0).alias("y"),
        F.when(draw < steep, 1).otherwise(0).alias("y_quantity"),
    )


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double, so that both engines show the same figures."""
    return df.select(
        *[
            F.round(F.col(c), digits).alias(c) if kind == "double" else F.col(c)
            for c, kind in df.dtypes
        ]
    )
