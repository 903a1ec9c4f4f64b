"""Composed maintenance jobs (A6 A7 A14): a pure job, its writer, and the number of rows it wrote.

The count is observed on the staged write, so no job runs a second time for it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from brandpulse import schemas as S
from brandpulse.operators import jobs as JB
from brandpulse.sources import tables as TB


@dataclass(frozen=True)
class Done:
    """What a job wrote."""
    rows: int
    written: DataFrame


def run_hourly_rollup(spark: SparkSession, sentiment: DataFrame, path: str, as_of, lookback_hours: float = 2, **options) -> Done:
    """The hours that are complete at ``as_of``, upserted into the table at ``path`` (partitioned by
    ``hour_day``). ``rows`` is the number of hour, label and source groups computed."""
    new = JB.hourly_rollup(sentiment, as_of, lookback_hours, **options).withColumn("hour_day", F.to_date("hour_bucket"))
    seen = Observation()
    written = TB.upsert_table(spark, new, path, S.SENTIMENT_HOURLY_KEY, ["hour_day"], seen)
    return Done(seen.get["rows"], written)


def run_shift_detection(spark: SparkSession, topic: DataFrame, path: str, as_of, **options) -> Done:
    """Shifts at ``as_of`` that no stored alert suppresses, appended to the alerts at ``path``.
    ``rows`` is the number of alerts appended; a run of the same clock appends nothing."""
    bare = JB.detect_shift(topic, as_of, **options)
    stored = TB.stored(spark, path, bare.schema)
    alerts = bare if stored is None else JB.detect_shift(topic, as_of, alerts=stored, **options)
    seen = Observation()
    written = TB.append_if_absent(spark, alerts, path, S.ANOMALIES_KEY, observation=seen)
    return Done(seen.get["rows"], written)
