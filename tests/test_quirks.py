"""One test per decided behaviour and the CASE-style functions."""

import datetime as dt

import pytest
from clock import AS_OF
from pyspark.sql import functions as F

from brandpulse import schemas as S
from brandpulse.functions import scoring as SC
from brandpulse.functions.time import parse_event_time
from brandpulse.operators import jobs as JB
from brandpulse.operators import serving as SV
from brandpulse.operators import topics as TP


def _one(spark, expr, value, dtype="double"):
    return spark.createDataFrame([(value,)], f"x {dtype}").select(expr(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize("c,label", [(0.05, "POSITIVE"), (-0.05, "NEGATIVE"), (0.0499, "NEUTRAL"),
                                     (-0.0499, "NEUTRAL"), (0.9, "POSITIVE"), (-1.0, "NEGATIVE")])
def test_label_thresholds_inclusive(spark, c, label):
    assert _one(spark, SC.label_from_compound, c) == label


@pytest.mark.parametrize("pct,sev", [(30.0, "HIGH"), (30.01, "CRITICAL"), (20.0, "MEDIUM"), (15.0, "MEDIUM"),
                                     (10.0, "LOW"), (-550.0, "LOW")])
def test_shift_severity_cuts(spark, pct, sev):
    assert _one(spark, SC.shift_severity, pct) == sev


@pytest.mark.parametrize("score,sev", [(0.19, "CRITICAL"), (0.2, "HIGH"), (0.3, "MEDIUM")])
def test_mention_severity(spark, score, sev):
    assert _one(spark, SC.mention_severity, score) == sev


def test_bands_differ_only_at_point_four(spark):
    assert _one(spark, SC.score_band, 0.4) == "mid"
    assert _one(spark, SC.kpi_band, 0.4) == "bad"
    assert _one(spark, SC.score_band, 0.6) == "mid" and _one(spark, SC.kpi_band, 0.6) == "mid"


def test_all_four_severities_ranked(spark):
    got = [_one(spark, SC.severity_rank, s, "string") for s in S.SEVERITIES]
    assert got == [1, 2, 3, 4]
    assert _one(spark, SC.alert_band, "CRITICAL", "string") == "red"     # Q25 fix


@pytest.mark.parametrize("text,expected", [
    ("Mon, 06 Jan 2025 10:00:00 GMT", "2025-01-06 10:00:00"),
    ("Mon, 06 Jan 2025 10:00:00 +0000", "2025-01-06 10:00:00"),
    ("Mon, 6 Jan 2025 10:00:00 GMT", "2025-01-06 10:00:00"),
    ("6 Jan 2025 12:00:00 +0200", "2025-01-06 10:00:00"),
    ("2025-01-06T10:00:00Z", "2025-01-06 10:00:00"),
    ("2025-01-06 10:00:00", "2025-01-06 10:00:00"),
    ("junk", None), ("", None), (None, None),
])
def test_event_time_parsing_is_total(spark, text, expected):     # Q1
    got = _one(spark, lambda c: parse_event_time(c).cast("timestamp_ntz").cast("string"), text, "string")
    assert got == expected


def test_null_event_time_has_no_window(spark):                    # Q2
    from brandpulse.streaming.flows import window_counts
    df = spark.createDataFrame([(None, "POSITIVE", 0.9, "x")],
                               "created_at timestamp, sentiment_label string, sentiment_score double, source string")
    assert window_counts(df).count() == 0


def _tags(spark, text, **kw):
    df = spark.createDataFrame([("1", text)], "post_id string, content string")
    return TP.tag_topics(df, **kw).first().topics


def test_keyword_case(spark):                                     # Q3
    assert _tags(spark, "The CEO resigned") == ["Corporate"]
    assert _tags(spark, "The CEO resigned", lower_keywords=False) == []


def test_substring_and_whole_word(spark):                         # Q4
    assert _tags(spark, "enterprise deals at Costco") == ["Pricing"]
    assert _tags(spark, "enterprise deals at Costco", whole_word=True) == []
    assert _tags(spark, "the price is fine", whole_word=True) == ["Pricing"]


def test_topics_in_vocabulary_order_once(spark):
    t = _tags(spark, "Shipping was slow, price too high, support helped, support again")
    assert t == ["Customer Service", "Pricing", "Shipping"]
    assert _tags(spark, None) == [] and _tags(spark, "nothing relevant") == []


def test_trie_equals_expression(spark):
    text = "Great support but the price; new feature and carbon neutral, CEO update"
    assert _tags(spark, text, method="trie") == _tags(spark, text, method="expr")
    assert _tags(spark, text, method="trie", whole_word=True) == _tags(spark, text, method="expr", whole_word=True)


def _topic_rows(spark, rows):
    return spark.createDataFrame(
        [(p, t, s, dt.datetime.fromisoformat(c)) for p, t, s, c in rows],
        "post_id string, topic string, sentiment_score double, created_at timestamp_ntz")


def test_zero_baseline_is_not_an_alert(spark):                   # Q11
    t = _topic_rows(spark, [("a", "X", 0.0, "2024-01-30 11:00:00"), ("b", "X", 0.5, "2024-01-30 11:45:00")])
    assert JB.detect_shift(t, AS_OF, direction="both").count() == 0


def test_shift_counts_pairs_and_skips_null_topic(spark):         # Q10
    t = _topic_rows(spark, [("a", "X", 0.8, "2024-01-30 10:40:00"), ("b", "X", 0.8, "2024-01-30 11:10:00"),
                            ("c", "X", 0.4, "2024-01-30 11:40:00"), ("d", "X", 0.4, "2024-01-30 11:50:00"),
                            ("e", "X", None, "2024-01-30 11:55:00"), ("f", None, 0.1, "2024-01-30 11:50:00")])
    r = JB.detect_shift(t, AS_OF, details=True).first()
    assert (r.affected_topic, r.pct_change, r.severity, r.affected_records) == ("X", 50.0, "CRITICAL", 6)


def test_cooldown_suppresses_recent_alert_topics(spark):         # J3
    t = _topic_rows(spark, [("a", "X", 0.8, "2024-01-30 10:40:00"), ("c", "X", 0.4, "2024-01-30 11:40:00"),
                            ("g", "Y", 0.8, "2024-01-30 10:40:00"), ("h", "Y", 0.4, "2024-01-30 11:40:00")])
    assert {r.affected_topic for r in JB.detect_shift(t, AS_OF).collect()} == {"X", "Y"}
    prior = spark.createDataFrame(
        [("X", dt.datetime(2024, 1, 30, 12, 0, 0)),      # exactly 30 min before: suppresses
         ("Y", dt.datetime(2024, 1, 30, 11, 59, 59))],   # older than the cool-down: does not
        "affected_topic string, detected_at timestamp_ntz")
    got = {r.affected_topic for r in JB.detect_shift(t, AS_OF, alerts=prior).collect()}
    assert got == {"Y"}


def test_grid_backfill_equals_single_runs(spark):
    t = _topic_rows(spark, [(str(i), "XY"[i % 2], 0.1 + (i * 37 % 80) / 100, f"2024-01-30 {8 + i // 12:02d}:{i * 5 % 60:02d}:00")
                            for i in range(60)])
    grid = JB.detect_shift_series(t, "2024-01-30 09:00:00", "2024-01-30 14:00:00", direction="both", details=True)
    got = sorted((str(r.detected_at), r.affected_topic, r.pct_change, r.affected_records) for r in grid.collect())
    want = []
    for h in range(9, 15):
        a = f"2024-01-30 {h:02d}:00:00"
        want += [(a, r.affected_topic, r.pct_change, r.affected_records)
                 for r in JB.detect_shift(t, a, direction="both", details=True).collect()]
    assert got == sorted(want) and got


def test_rollup_alignment(spark, seeds):                          # Q12
    sentiment, _ = seeds
    aligned = JB.hourly_rollup(sentiment, "2024-01-30 12:40:00", lookback_hours=2)
    unaligned = JB.hourly_rollup(sentiment, "2024-01-30 12:40:00", lookback_hours=2, align=False)
    assert aligned.count() == 3 and unaligned.count() == 2      # 10:30 row falls before 10:40


def test_kpis_weighted_and_unweighted(spark, seeds):             # Q13, A9
    sentiment, _ = seeds
    r = SV.kpi_summary(sentiment, AS_OF).first()
    assert r.score_unweighted == pytest.approx((0.92 + 0.08 + 0.52) / 3)
    assert r.score_weighted == pytest.approx((0.92 + 0.08 + 0.52) / 3)
    assert (r.total_mentions, r.positive_pct, r.kpi_band) == (3, 33.3, "mid")
    empty = SV.kpi_summary(sentiment, "2024-02-05 00:00:00", hours=1).first()   # no rows in range
    assert empty.total_mentions == 0 and empty.positive_pct == 0.0


def test_brand_filter_escapes_like_metacharacters(spark):        # Q19
    a = spark.createDataFrame(
        [(dt.datetime(2024, 1, 30, 12), "Significant drop in 100% cotton_line sentiment", "HIGH", 25.0),
         (dt.datetime(2024, 1, 30, 12), "Significant drop in 100x cottonXline sentiment", "HIGH", 25.0),
         (dt.datetime(2024, 1, 30, 11), "O'Brien's drop", "CRITICAL", 40.0)],
        "detected_at timestamp_ntz, description string, severity string, sentiment_drop_percentage double")
    assert [r.description for r in SV.recent_alerts(a, AS_OF, brand="0% COTTON_").collect()] == \
        ["Significant drop in 100% cotton_line sentiment"]
    assert SV.recent_alerts(a, AS_OF, brand="o'brien").first().alert_band == "red"


def test_available_brands_skip_null(spark, seeds):
    sentiment, _ = seeds
    assert SV.available_brands(sentiment).count() == 0


def test_latest_per_post_and_negative_mentions(spark):
    rows = [("p1", "a", "NEGATIVE", 0.1, "2024-01-30 10:00:00", "x", "b"),
            ("p1", "a", "NEGATIVE", 0.3, "2024-01-30 11:00:00", "x", "b"),
            ("p2", "c", "NEGATIVE", 0.05, "2024-01-30 09:00:00", "y", "b"),
            ("p3", "d", "POSITIVE", 0.9, "2024-01-30 09:00:00", "y", "b")]
    df = spark.createDataFrame(rows, "post_id string, content string, sentiment_label string, sentiment_score double,"
                                     " analyzed_at string, source string, brand string") \
        .withColumn("analyzed_at", F.col("analyzed_at").cast("timestamp_ntz"))
    got = [(r.post_id, r.sentiment_score) for r in SV.negative_mentions(df, AS_OF, brand="b").collect()]
    assert got == [("p2", 0.05), ("p1", 0.3)]
    cards = SV.mention_cards(df, AS_OF, brand="b").collect()
    assert [(c.severity, c.score_text, c.source_text) for c in cards] == [("CRITICAL", "0.050", "Y"),
                                                                          ("MEDIUM", "0.300", "X")]
