"""Serving queries over the silver tables (the dashboard's questions).

All functions take DataFrames and return DataFrames; filters come first so that
Catalyst pushes them into the scan, and every global sort runs on grouped output or
behind a limit (top-k reports). ``as_of`` replaces the server clock.

Aggregates use map-side partial aggregation, so a hot key (one brand or topic holding
a large share of the rows) is combined inside each task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brandpulse import schemas as S
from brandpulse.functions import scoring as SC
from brandpulse.functions import time as TM


def _scope(df: DataFrame, as_of, hours: float, brand: str | None, time_col: str) -> DataFrame:
    """P5 + P8: last ``hours`` before ``as_of`` on ``time_col``, optional brand equality."""
    cond = TM.within_last(df, time_col, as_of, hours)
    if brand is not None:
        cond = cond & (F.col("brand") == F.lit(brand))
    return df.filter(cond)


def _avg3(c: str) -> Column:
    return F.round(F.avg(c), 3)


# -------------------------------------------------------------------------------- A1 W1
def _overview_groups(sentiment: DataFrame, as_of, hours: float, brand: str | None, time_col: str) -> DataFrame:
    g = (_scope(sentiment, as_of, hours, brand, time_col)
         .groupBy("sentiment_label")
         .agg(F.count(F.lit(1)).alias("count"),
              _avg3("sentiment_score").alias("avg_score"),
              F.sum("sentiment_score").alias("_sum_score"),
              F.count("sentiment_score").alias("_n_score")))
    # Share of the grouped total. The window runs on <= one row per label, after grouping.
    total = F.sum("count").over(Window.partitionBy())
    return g.withColumn("percentage", F.round(F.col("count").cast("double") * F.lit(100.0) / total, 1))


def sentiment_overview(sentiment: DataFrame, as_of, hours: float = 24, brand: str | None = None,
                       time_col: str = "analyzed_at") -> DataFrame:
    """A1: count, avg score (3 dp) and share % (1 dp) per label, most frequent first."""
    return (_overview_groups(sentiment, as_of, hours, brand, time_col)
            .select("sentiment_label", "count", "avg_score", "percentage")
            .orderBy(F.desc("count"), "sentiment_label"))


def sentiment_last24h_view(sentiment: DataFrame, as_of, hours: float = 24) -> DataFrame:
    """A1 as the stored view: on created_at, no brand, stamped with ``computed_at``."""
    return (sentiment_overview(sentiment, as_of, hours, None, "created_at")
            .withColumn("computed_at", TM.ts_lit(as_of, TM.col_type(sentiment, "created_at"))))


def kpi_summary(sentiment: DataFrame, as_of, hours: float = 24, brand: str | None = None,
                time_col: str = "analyzed_at") -> DataFrame:
    """A9 (+ Q13): one row of KPIs over the overview groups.

    ``score_unweighted`` is the mean of the rounded label averages (dashboard parity);
    ``score_weighted`` is the true mean score over all mentions.
    """
    g = _overview_groups(sentiment, as_of, hours, brand, time_col)
    out = g.agg(
        F.avg("avg_score").alias("score_unweighted"),
        (F.sum("_sum_score") / F.sum("_n_score")).alias("score_weighted"),
        F.sum("count").alias("total_mentions"),
        F.coalesce(F.max(F.when(F.col("sentiment_label") == F.lit(S.POSITIVE), F.col("percentage"))),
                   F.lit(0.0)).alias("positive_pct"),
    )
    return out.select(
        F.round("score_unweighted", 6).alias("score_unweighted"),
        F.round("score_weighted", 6).alias("score_weighted"),
        F.coalesce(F.col("total_mentions"), F.lit(0).cast("long")).alias("total_mentions"),
        "positive_pct",
        SC.kpi_band("score_unweighted").alias("kpi_band"),
        F.format_number(F.coalesce(F.col("total_mentions"), F.lit(0).cast("long")), 0).alias("total_mentions_text"),
        F.format_string("%.2f", F.round("score_unweighted", 6)).alias("score_text"),
        F.concat(F.format_string("%.1f", F.col("positive_pct")), F.lit("%")).alias("positive_text"),
    )


# -------------------------------------------------------------------------------- A2 A10
def hourly_series(sentiment: DataFrame, as_of, hours: float = 24, brand: str | None = None,
                  time_col: str = "analyzed_at") -> DataFrame:
    """A2: count and avg score (3 dp) per (hour, label), newest hour first."""
    base = _scope(sentiment, as_of, hours, brand, time_col)
    return (base.groupBy(TM.hour_bucket(base, time_col).alias("hour"), "sentiment_label")
            .agg(F.count(F.lit(1)).alias("count"), _avg3("sentiment_score").alias("avg_score"))
            .orderBy(F.desc("hour"), "sentiment_label"))


def sentiment_trend(sentiment: DataFrame, as_of, hours: float = 24, brand: str | None = None,
                    time_col: str = "analyzed_at") -> DataFrame:
    """A10 (+ Q14): per hour, total mentions and the *unweighted* mean of label averages;
    ``avg_weighted`` is the true hourly mean."""
    base = _scope(sentiment, as_of, hours, brand, time_col)
    per_label = (base.groupBy(TM.hour_bucket(base, time_col).alias("hour"), "sentiment_label")
                 .agg(F.count(F.lit(1)).alias("count"), _avg3("sentiment_score").alias("avg_score"),
                      F.sum("sentiment_score").alias("_s"), F.count("sentiment_score").alias("_n")))
    return (per_label.groupBy("hour")
            .agg(F.sum("count").alias("total_mentions"),
                 F.round(F.avg("avg_score"), 6).alias("avg_sentiment"),
                 F.round(F.sum("_s") / F.sum("_n"), 6).alias("avg_weighted"))
            .orderBy("hour"))


# -------------------------------------------------------------------------------- A3 J1 L2
def top_topics(topic: DataFrame, sentiment: DataFrame, as_of, hours: float = 24, brand: str | None = None,
               limit: int = 10, time_col: str = "analyzed_at") -> DataFrame:
    """A3 + J1: topics by mentions of posts scored in range, with the posts' avg score.

    Exact rewrite of ``topic JOIN sentiment USING (post_id) GROUP BY topic``: the
    sentiment side is first reduced to one row per post (count, sum, non-null count),
    so repeated analyses of a post never multiply rows in the join; pair counts and
    pair averages are rebuilt from those partial sums.
    """
    s = (_scope(sentiment, as_of, hours, brand, time_col)
         .groupBy("post_id")
         .agg(F.count(F.lit(1)).alias("_ns"), F.sum("sentiment_score").alias("_ss"),
              F.count("sentiment_score").alias("_cs")))
    t = topic.select("post_id", "topic").filter(F.col("post_id").isNotNull())
    j = t.join(s, "post_id")
    g = (j.groupBy("topic")
         .agg(F.sum("_ns").alias("mentions"),
              F.round(F.sum("_ss") / F.sum("_cs"), 3).alias("avg_sentiment")))
    return g.orderBy(F.desc("mentions"), "topic").limit(limit)


def topic_bubble(topic: DataFrame, sentiment: DataFrame, as_of, hours: float = 24, brand: str | None = None,
                 limit: int = 10, time_col: str = "analyzed_at") -> DataFrame:
    """A3 + F7 + L6: top topics with bubble size ``sqrt(mentions) * 3``, ascending by mentions."""
    tt = top_topics(topic, sentiment, as_of, hours, brand, limit, time_col)
    return (tt.withColumn("bubble_size", F.round(F.sqrt("mentions") * F.lit(3.0), 6))
              .withColumn("score_band", SC.score_band("avg_sentiment"))
              .orderBy("mentions", "topic"))


def top_topics_7d_view(topic: DataFrame, as_of, days: float = 7, limit: int = 10) -> DataFrame:
    """A5 (stored view): mentions, avg (3 dp), >0.6 and <0.4 counts per topic on created_at."""
    base = topic.filter(TM.within_last(topic, "created_at", as_of, days * 24))
    g = (base.groupBy("topic")
         .agg(F.count(F.lit(1)).alias("mentions"),
              _avg3("sentiment_score").alias("avg_sentiment"),
              F.count_if(F.col("sentiment_score") > F.lit(0.6)).alias("positive_mentions"),
              F.count_if(F.col("sentiment_score") < F.lit(0.4)).alias("negative_mentions")))
    return (g.withColumn("computed_at", TM.ts_lit(as_of, TM.col_type(topic, "created_at")))
             .orderBy(F.desc("mentions"), "topic").limit(limit))


# -------------------------------------------------------------------------------- A4 A11
def sentiment_by_source(sentiment: DataFrame, as_of, hours: float = 24, brand: str | None = None,
                        time_col: str = "analyzed_at") -> DataFrame:
    """A4: counts per (source, label), ordered by source then label."""
    return (_scope(sentiment, as_of, hours, brand, time_col)
            .groupBy("source", "sentiment_label").agg(F.count(F.lit(1)).alias("count"))
            .orderBy("source", "sentiment_label"))


def source_label_pivot(sentiment: DataFrame, as_of, hours: float = 24, brand: str | None = None,
                       time_col: str = "analyzed_at") -> DataFrame:
    """Source x label matrix of counts, missing cells 0. The label list is passed
    explicitly, so no extra job is run to discover the pivot values."""
    by = sentiment_by_source(sentiment, as_of, hours, brand, time_col)
    return (by.groupBy("source").pivot("sentiment_label", S.LABELS).agg(F.sum("count"))
              .fillna(0, subset=S.LABELS).orderBy("source"))


# -------------------------------------------------------------------------------- W2 L3
def latest_per_post(sentiment: DataFrame, order_col: str = "analyzed_at") -> DataFrame:
    """The latest analysis of every post (rn = 1 by ``order_col`` desc).

    Planned as ``WindowGroupLimit`` (partial top-1 per post before the shuffle), so a
    post replayed many times sends at most one row per task across the network.
    Ties on ``order_col`` are broken by score, then content, for deterministic output.
    """
    w = Window.partitionBy("post_id").orderBy(F.desc(order_col), F.desc("sentiment_score"), F.asc("content"))
    return sentiment.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def negative_mentions(sentiment: DataFrame, as_of, hours: float = 24, brand: str | None = None,
                      limit: int = 10, time_col: str = "analyzed_at") -> DataFrame:
    """W2 + L3: the ``limit`` most negative posts (latest analysis each), score asc,
    newest first; the analysis time is reported as ``created_at`` (dashboard naming)."""
    base = _scope(sentiment, as_of, hours, brand, time_col).filter(F.col("sentiment_label") == F.lit(S.NEGATIVE))
    latest = latest_per_post(base.select("post_id", "content", "sentiment_score", "source", time_col), time_col)
    return (latest.select("post_id", "content", "sentiment_score", "source", F.col(time_col).alias("created_at"))
            .orderBy(F.asc("sentiment_score"), F.desc("created_at"), F.asc("post_id"))
            .limit(limit))


def mention_cards(sentiment: DataFrame, as_of, hours: float = 24, brand: str | None = None,
                  limit: int = 10, time_col: str = "analyzed_at", preview_chars: int = 50) -> DataFrame:
    """Negative mentions with their display fields: F10 severity, F4 time text, F14 upper
    source, the whole content with its F18 preview, F21 score texts (3 and 2 digits)."""
    nm = negative_mentions(sentiment, as_of, hours, brand, limit, time_col)
    return nm.select(
        "post_id", "sentiment_score", "created_at",
        SC.mention_severity("sentiment_score").alias("severity"),
        F.date_format("created_at", "yyyy-MM-dd HH:mm").alias("time_text"),
        F.upper("source").alias("source_text"),
        "content",
        F.substring("content", 1, preview_chars).alias("preview"),
        F.format_string("%.3f", F.col("sentiment_score")).alias("score_text"),
        F.format_string("%.2f", F.col("sentiment_score")).alias("score_short"),
        # the cards' order as a column (over at most ``limit`` rows)
        F.row_number().over(Window.orderBy(F.asc("sentiment_score"), F.desc("created_at"), F.asc("post_id"))).alias("card"),
    )


# -------------------------------------------------------------------------------- A13
def available_brands(sentiment: DataFrame) -> DataFrame:
    """Distinct non-null brands, sorted. The fallback list is the caller's choice
    (``schemas.FALLBACK_BRANDS``) and is not injected into the data."""
    return sentiment.select("brand").filter(F.col("brand").isNotNull()).distinct().orderBy("brand")


# -------------------------------------------------------------------------------- alerts
def _ilike_pattern(text: str) -> str:
    """``%text%`` with LIKE metacharacters escaped (backslash is the escape)."""
    esc = text.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return f"%{esc}%"


def recent_alerts(anomalies: DataFrame, as_of, hours: float = 24, brand: str | None = None,
                  limit: int = 5) -> DataFrame:
    """P9 + L4 + F4 + F22: latest alerts whose description contains ``brand`` (case-insensitive)."""
    cond = TM.within_last(anomalies, "detected_at", as_of, hours)
    if brand is not None:
        cond = cond & F.col("description").ilike(_ilike_pattern(brand))
    a = anomalies.filter(cond)
    return (a.select("detected_at", "sentiment_drop_percentage", "severity", "description",
                     SC.alert_band("severity").alias("alert_band"),
                     F.date_format("detected_at", "HH:mm").alias("time_text"))
             .orderBy(F.desc("detected_at"), F.desc(SC.severity_rank("severity")), "description")
             .limit(limit))
