import datetime as dt
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from clock import AS_OF  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    existing = SparkSession.getActiveSession()
    if existing is None:
        from brandpulse.session import get_spark
        extra = {"spark.checkpoint.dir": tempfile.mkdtemp(prefix="brandpulse-tests-")}
        s = get_spark("local[4]", shuffle_partitions=8, extra=extra)
    else:
        s = existing
    yield s


@pytest.fixture(scope="session")
def seeds(spark):
    """The three seed posts (created_at pinned relative to AS_OF; analyzed_at = created_at)."""
    from pyspark.sql import functions as F
    base = dt.datetime.fromisoformat(AS_OF)
    rows = [
        ("reddit_001", "This product exceeded my expectations! Excellent customer service too.", "POSITIVE", 0.92,
         base - dt.timedelta(hours=2), "Customer Service"),
        ("reddit_002", "Terrible quality. Broke after one week. Waste of money.", "NEGATIVE", 0.08,
         base - dt.timedelta(hours=1.5), "Product Quality"),
        ("reddit_003", "Product is okay. Nothing special but does the job.", "NEUTRAL", 0.52,
         base - dt.timedelta(hours=1), "Product Quality"),
    ]
    df = spark.createDataFrame(
        [(p, c, lab, s, t.isoformat(sep=" "), tp) for p, c, lab, s, t, tp in rows],
        "post_id string, content string, sentiment_label string, sentiment_score double, ts string, topic string")
    df = df.withColumn("created_at", F.col("ts").cast("timestamp_ntz")).drop("ts")
    sentiment = df.select("post_id", "content", "sentiment_label", "sentiment_score",
                          F.lit(None).cast("double").alias("confidence"),
                          F.col("created_at").alias("analyzed_at"), "created_at",
                          F.lit("reddit").alias("source"), F.lit(None).cast("string").alias("brand"))
    topic = df.select("post_id", "topic", F.lit(None).cast("double").alias("confidence"), "sentiment_score",
                      F.col("created_at").alias("analyzed_at"), "created_at",
                      F.lit(None).cast("string").alias("brand"))
    return sentiment, topic
