"""Schemas, enums and fixed vocabularies.

Everything a stream or table carries is declared here; nothing is inferred at read time.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------------------
# Fixed values (must equal the monitored pipeline's values for matching results)
# --------------------------------------------------------------------------------------
# Sentiment labels and the compound thresholds (inclusive) that choose them.
POSITIVE, NEUTRAL, NEGATIVE = "POSITIVE", "NEUTRAL", "NEGATIVE"
LABELS = [NEGATIVE, NEUTRAL, POSITIVE]
COMPOUND_POSITIVE_AT = 0.05
COMPOUND_NEGATIVE_AT = -0.05
# Blank / missing text scores as (label, score, confidence):
BLANK_RESULT = (NEUTRAL, 0.5, 0.0)

# Anomaly severities, from mildest to worst; thresholds on percent change (strictly greater).
SEVERITIES = ["LOW", "MEDIUM", "HIGH", "CRITICAL"]
SHIFT_SEVERITY_CUTS = [(30.0, "CRITICAL"), (20.0, "HIGH"), (10.0, "MEDIUM")]
SHIFT_THRESHOLD_PCT = 15.0
ANOMALY_TYPE_DROP = "SENTIMENT_DROP"
ALERT_COOLDOWN_MINUTES = 30

# Daily topic trend values.
TRENDS = ["IMPROVING", "STABLE", "DECLINING"]

# Topic vocabulary: topic -> keywords, in this order (output keeps topic order).
TOPIC_KEYWORDS = [
    ("Customer Service", ["customer service", "support", "help", "response", "complaint"]),
    ("Pricing", ["price", "cost", "expensive", "affordable", "cheap"]),
    ("Product Quality", ["quality", "durability", "defect", "broken", "recall", "performance"]),
    ("Shipping", ["shipping", "delivery", "package", "arrived", "tracking"]),
    ("Innovation", ["innovation", "new feature", "update", "software", "design"]),
    ("Corporate", ["earnings", "stock", "CEO", "leadership", "acquisition"]),
    ("Marketing", ["advertisement", "campaign", "sponsorship", "brand image"]),
    ("Environment", ["sustainability", "green", "carbon", "environmental"]),
]
TOPICS = [t for t, _ in TOPIC_KEYWORDS]

# Brands polled by the news feeds, and the dashboard's fallback list when none are stored.
MONITORED_BRANDS = ["Apple", "Tesla", "Amazon", "Nike", "Coca-Cola", "Samsung", "Microsoft"]
FALLBACK_BRANDS = ["Apple", "Tesla", "Amazon"]

# Dashboard time ranges in hours.
TIME_RANGES_HOURS = [24, 168, 720]

# Column length caps (constraint report).
LENGTH_CAPS = {
    "post_id": 255, "source": 50, "title": 500, "author": 255, "url": 500,
    "sentiment_label": 20, "brand": 100, "topic": 255,
}

# Feed normaliser: default source name and entries kept per feed.
DEFAULT_FEED_SOURCE = "google_news"
FEED_ENTRIES_KEPT = 10

# Stream defaults: watermark delay and window width.
STREAM_WATERMARK = "10 minutes"
STREAM_WINDOW = "1 minute"

# --------------------------------------------------------------------------------------
# Stream element and source records
# --------------------------------------------------------------------------------------
POST_MESSAGE = T.StructType([
    T.StructField("post_id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("raw_metadata", T.StructType([T.StructField("brand_monitored", T.StringType())])),
])

FEED_ENTRY = T.StructType([
    T.StructField("feed_url", T.StringType()),
    T.StructField("feed_title", T.StringType()),
    T.StructField("feed_author", T.StringType()),
    T.StructField("position", T.IntegerType()),
    T.StructField("id", T.StringType()),
    T.StructField("link", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("summary", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("published", T.StringType()),
    T.StructField("updated", T.StringType()),
])

# --------------------------------------------------------------------------------------
# Tables (natural keys; surrogate ids are not used)
# --------------------------------------------------------------------------------------
POSTS = T.StructType([
    T.StructField("post_id", T.StringType(), False),
    T.StructField("source", T.StringType(), False),
    T.StructField("title", T.StringType()),
    T.StructField("content", T.StringType(), False),
    T.StructField("author", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("ingested_at", T.TimestampType()),
    T.StructField("raw_metadata", T.StringType()),
])
POSTS_KEY = ["post_id"]

SENTIMENT = T.StructType([
    T.StructField("post_id", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("sentiment_label", T.StringType(), False),
    T.StructField("sentiment_score", T.DoubleType(), False),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("analyzed_at", T.TimestampType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("source", T.StringType()),
    T.StructField("brand", T.StringType()),
])
SENTIMENT_KEY = ["post_id", "analyzed_at"]

TOPIC = T.StructType([
    T.StructField("post_id", T.StringType()),
    T.StructField("topic", T.StringType(), False),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("sentiment_score", T.DoubleType()),
    T.StructField("analyzed_at", T.TimestampType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("brand", T.StringType()),
])
TOPIC_KEY = ["post_id", "topic", "analyzed_at"]

SENTIMENT_HOURLY = T.StructType([
    T.StructField("hour_bucket", T.TimestampType(), False),
    T.StructField("sentiment_label", T.StringType()),
    T.StructField("count", T.LongType()),
    T.StructField("avg_sentiment_score", T.DoubleType()),
    T.StructField("min_sentiment_score", T.DoubleType()),
    T.StructField("max_sentiment_score", T.DoubleType()),
    T.StructField("source", T.StringType()),
])
SENTIMENT_HOURLY_KEY = ["hour_bucket", "sentiment_label", "source"]

TOPIC_DAILY = T.StructType([
    T.StructField("date_bucket", T.DateType(), False),
    T.StructField("topic", T.StringType()),
    T.StructField("mention_count", T.LongType()),
    T.StructField("avg_sentiment", T.DoubleType()),
    T.StructField("sentiment_trend", T.StringType()),
])
TOPIC_DAILY_KEY = ["date_bucket", "topic"]

ANOMALIES = T.StructType([
    T.StructField("detected_at", T.TimestampType()),
    T.StructField("anomaly_type", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("sentiment_drop_percentage", T.DoubleType()),
    T.StructField("affected_topic", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("affected_records", T.LongType()),
    T.StructField("recommended_action", T.StringType()),
    T.StructField("acknowledged", T.BooleanType()),
])
ANOMALIES_KEY = ["affected_topic", "detected_at"]

LEXICON = T.StructType([
    T.StructField("term", T.StringType(), False),
    T.StructField("valence", T.DoubleType(), False),
])


def topic_keywords_rows(vocabulary=None):
    """(ordinal, topic, keyword) rows of a vocabulary, for the keyword table."""
    vocabulary = vocabulary or TOPIC_KEYWORDS
    return [(i, topic, kw) for i, (topic, kws) in enumerate(vocabulary) for kw in kws]
