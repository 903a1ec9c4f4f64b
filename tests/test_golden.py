"""Golden outputs on the seed rows (FIXTURES §6)."""

from clock import AS_OF

from brandpulse.operators import jobs as JB
from brandpulse.operators import serving as SV


def test_overview_last_24h(seeds):
    sentiment, _ = seeds
    rows = {r.sentiment_label: (r["count"], r.avg_score, r.percentage)
            for r in SV.sentiment_overview(sentiment, AS_OF, hours=24).collect()}
    assert rows == {"NEGATIVE": (1, 0.08, 33.3), "NEUTRAL": (1, 0.52, 33.3), "POSITIVE": (1, 0.92, 33.3)}


def test_top_topics_7d(seeds):
    _, topic = seeds
    rows = [(r.topic, r.mentions, r.avg_sentiment, r.positive_mentions, r.negative_mentions)
            for r in SV.top_topics_7d_view(topic, AS_OF).collect()]
    assert rows == [("Product Quality", 2, 0.3, 0, 1), ("Customer Service", 1, 0.92, 1, 0)]


def test_hourly_rollup(seeds):
    sentiment, _ = seeds
    rows = sorted((str(r.hour_bucket), r.sentiment_label, r["count"], r.avg_sentiment_score,
                   r.min_sentiment_score, r.max_sentiment_score)
                  for r in JB.hourly_rollup(sentiment, AS_OF, lookback_hours=3).collect())
    assert rows == [("2024-01-30 10:00:00", "POSITIVE", 1, 0.92, 0.92, 0.92),
                    ("2024-01-30 11:00:00", "NEGATIVE", 1, 0.08, 0.08, 0.08),
                    ("2024-01-30 11:00:00", "NEUTRAL", 1, 0.52, 0.52, 0.52)]


def test_shift_both_directions(seeds):
    _, topic = seeds
    rows = JB.detect_shift(topic, AS_OF, direction="both", details=True).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.affected_topic, r.pct_change, r.severity, r.sentiment_drop_percentage, r.affected_records) == \
        ("Product Quality", -550.0, "LOW", 550.0, 1)
    assert r.description == "Significant drop in Product Quality sentiment"
    assert r.anomaly_type == "SENTIMENT_DROP" and r.acknowledged is False


def test_shift_drop_only_default(seeds):
    _, topic = seeds
    assert JB.detect_shift(topic, AS_OF).count() == 0
