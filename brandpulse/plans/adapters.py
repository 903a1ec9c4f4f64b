"""Adapters from the driver's tables to the pipeline's silver tables.

The driver tables hold no posts, so the silver tables are *derived* from them with
plain projections (no filters, no sampling): every ``events`` row becomes one analysed
post, every ``documents`` row one text. The same expressions are written a second time
as DuckDB SQL in :mod:`brandpulse.plans.oracle` so that each registered query can be
compared with an independent engine.

Derived columns (both engines):

=================  ==============================================================
post_id            ``CAST(event_id AS STRING)``
content            ``props``
source             ``event_type``
brand              ``'brand_' || CAST(user_id % 7 AS STRING)``
created_at         ``ts`` (TIMESTAMP_NTZ, same as DuckDB TIMESTAMP)
analyzed_at        ``ts + (event_id % 60) minutes``
sentiment_score    ``value / (value + 50.0)``
sentiment_label    F12 on ``2 * score - 1``
confidence         ``abs(2 * score - 1)``
topic              topic ``user_id % 8`` of the 8-topic vocabulary, plus topic
                   ``event_id % 8`` when it differs (multi-topic posts)
=================  ==============================================================
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brandpulse import schemas as S
from brandpulse.functions.scoring import compound_from_score, label_from_compound

# Fixed test clock: the events span 2024-01-01 .. 2024-01-30 23:57.
AS_OF = "2024-01-31 00:00:00"
BRAND = "brand_1"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _score_columns(score):
    compound = compound_from_score(score)
    return [
        label_from_compound(compound).alias("sentiment_label"),
        score.alias("sentiment_score"),
        F.abs(compound).alias("confidence"),
    ]


def sentiment_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """silver.sentiment over ``events`` (one analysis per post)."""
    ev = read(spark, sf_dir, "events")
    score = F.col("value") / (F.col("value") + F.lit(50.0))
    return ev.select(
        F.col("event_id").cast("string").alias("post_id"),
        F.col("props").alias("content"),
        *_score_columns(score),
        (F.col("ts") + F.make_dt_interval(mins=(F.col("event_id") % 60).cast("int"))).alias("analyzed_at"),
        F.col("ts").alias("created_at"),
        F.col("event_type").alias("source"),
        F.concat(F.lit("brand_"), (F.col("user_id") % 7).cast("string")).alias("brand"),
    )


def second_pass_sentiment_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second analysis of every post: one hour later for even ids, one hour earlier for
    odd ids, score scaled by 0.9 (a replayed stream scored by a newer model)."""
    first = sentiment_table(spark, sf_dir)
    shift = F.when(F.col("post_id").cast("long") % 2 == 0, F.lit(1)).otherwise(F.lit(-1))
    score = F.col("sentiment_score") * F.lit(0.9)
    return first.select(
        "post_id", "content", *_score_columns(score),
        (F.col("analyzed_at") + F.make_dt_interval(hours=shift)).alias("analyzed_at"),
        "created_at", "source", "brand",
    )


def reanalyzed_sentiment_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """silver.sentiment with every post analysed twice, so "latest analysis per post" and
    the join fan-out have real work."""
    return sentiment_table(spark, sf_dir).unionByName(second_pass_sentiment_table(spark, sf_dir))


def topic_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """silver.topic over ``events``: one or two topics per post."""
    ev = read(spark, sf_dir, "events")
    names = F.array(*[F.lit(t) for t in S.TOPICS])
    score = F.col("value") / (F.col("value") + F.lit(50.0))
    t1 = F.element_at(names, (F.col("user_id") % 8 + 1).cast("int"))
    t2 = F.when(F.col("event_id") % 8 != F.col("user_id") % 8,
                F.element_at(names, (F.col("event_id") % 8 + 1).cast("int")))
    return ev.select(
        F.col("event_id").cast("string").alias("post_id"),
        F.explode(F.filter(F.array(t1, t2), lambda x: x.isNotNull())).alias("topic"),
        F.abs(compound_from_score(score)).alias("confidence"),
        score.alias("sentiment_score"),
        (F.col("ts") + F.make_dt_interval(mins=(F.col("event_id") % 60).cast("int"))).alias("analyzed_at"),
        F.col("ts").alias("created_at"),
        F.concat(F.lit("brand_"), (F.col("user_id") % 7).cast("string")).alias("brand"),
    )


def texts_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts with real prose: ``documents`` (post_id = doc_id, brand = lang)."""
    d = read(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").cast("string").alias("post_id"),
        F.col("source"),
        F.col("lang").alias("brand"),
        F.col("text").alias("content"),
    )


def as_of_datetime() -> _dt.datetime:
    return _dt.datetime.fromisoformat(AS_OF)
