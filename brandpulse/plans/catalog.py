"""The registered queries: one Spark callable ``(spark, sf_dir) -> DataFrame`` and, where the
result is a relation, an equivalent DuckDB SQL over the driver's tables.

Every query reads whole driver tables (through the adapters); nothing is sampled,
capped or filtered by id. Limits appear only in top-k reports, where they are the feature,
and those carry full tie-breaks in both engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from brandpulse.plans import q_ingest, q_jobs, q_serving, q_storage, q_text  # noqa: F401  (registration side effects)
from brandpulse.plans.registry import REGISTRY, Query  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q.run for name, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q.sql for name, q in REGISTRY.items() if q.sql}
