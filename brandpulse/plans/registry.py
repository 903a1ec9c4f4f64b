"""Query registry shared by the per-area query modules."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brandpulse.plans import adapters as AD
from brandpulse.plans.oracle import AS_OF_SQL


@dataclass(frozen=True)
class Query:
    name: str
    ids: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, ids: str, sql: str | None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query name {name}")
        REGISTRY[name] = Query(name, ids, fn, sql)
        return fn
    return deco


AS_OF = AD.AS_OF
BRAND = AD.BRAND


def window_sql(col: str, hours: int, as_of_sql: str = AS_OF_SQL) -> str:
    return f"{col} BETWEEN {as_of_sql} - INTERVAL {hours} HOUR AND {as_of_sql}"


def positioned(df: DataFrame) -> DataFrame:
    """Adds each row's place in the order in which ``df`` returns its (few) rows."""
    return (df.withColumn("_at", F.monotonically_increasing_id())
            .withColumn("position", F.row_number().over(Window.orderBy("_at"))).drop("_at"))
