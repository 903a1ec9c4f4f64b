"""Registered serving queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from brandpulse.operators import serving as SV
from brandpulse.plans import adapters as AD
from brandpulse.plans.oracle import AS_OF_SQL, REANALYZED_CTE, SENTIMENT_CTE, TOPIC_CTE, with_
from brandpulse.plans.registry import AS_OF, BRAND, positioned, register
from brandpulse.plans.registry import window_sql as _window_sql

# ======================================================================== serving
@register("sentiment_overview", "A1 W1 P5 P8 F3 L1", with_(SENTIMENT_CTE) + f"""
SELECT sentiment_label, count(*) AS count, round(avg(sentiment_score), 3) AS avg_score,
       round(CAST(count(*) AS DOUBLE) * 100 / sum(count(*)) OVER (), 1) AS percentage,
       row_number() OVER (ORDER BY count(*) DESC, sentiment_label)::INT AS position
FROM sentiment
WHERE {_window_sql('analyzed_at', 168)} AND brand = '{BRAND}'
GROUP BY sentiment_label
""")
def q_sentiment_overview(spark, sf_dir):
    return positioned(SV.sentiment_overview(AD.sentiment_table(spark, sf_dir), AS_OF, hours=168, brand=BRAND))


@register("sentiment_last24h_view", "A1 S12", with_(SENTIMENT_CTE) + f"""
SELECT sentiment_label, count(*) AS count, round(avg(sentiment_score), 3) AS avg_score,
       round(CAST(count(*) AS DOUBLE) * 100 / sum(count(*)) OVER (), 1) AS percentage,
       {AS_OF_SQL} AS computed_at
FROM sentiment
WHERE {_window_sql('created_at', 24)}
GROUP BY sentiment_label
""")
def q_sentiment_last24h_view(spark, sf_dir):
    return SV.sentiment_last24h_view(AD.sentiment_table(spark, sf_dir), AS_OF, hours=24)


@register("sentiment_hourly_series", "A2 F2", with_(SENTIMENT_CTE) + f"""
SELECT date_trunc('hour', analyzed_at) AS hour, sentiment_label, count(*) AS count,
       round(avg(sentiment_score), 3) AS avg_score,
       row_number() OVER (ORDER BY date_trunc('hour', analyzed_at) DESC, sentiment_label)::INT AS position
FROM sentiment
WHERE {_window_sql('analyzed_at', 720)} AND brand = '{BRAND}'
GROUP BY 1, 2
""")
def q_sentiment_hourly_series(spark, sf_dir):
    return positioned(SV.hourly_series(AD.sentiment_table(spark, sf_dir), AS_OF, hours=720, brand=BRAND))


@register("sentiment_trend", "A10 Q14", with_(SENTIMENT_CTE) + f"""
, per_label AS (
  SELECT date_trunc('hour', analyzed_at) AS hour, sentiment_label, count(*) AS count,
         round(avg(sentiment_score), 3) AS avg_score, sum(sentiment_score) AS s, count(sentiment_score) AS n
  FROM sentiment
  WHERE {_window_sql('analyzed_at', 720)} AND brand = '{BRAND}'
  GROUP BY 1, 2
)
SELECT hour, CAST(sum(count) AS BIGINT) AS total_mentions, round(avg(avg_score), 6) AS avg_sentiment,
       round(sum(s) / sum(n), 6) AS avg_weighted
FROM per_label GROUP BY hour
""")
def q_sentiment_trend(spark, sf_dir):
    return SV.sentiment_trend(AD.sentiment_table(spark, sf_dir), AS_OF, hours=720, brand=BRAND)


@register("kpi_summary", "A9 F11 F21 Q13", with_(SENTIMENT_CTE) + f"""
, g AS (
  SELECT sentiment_label, count(*) AS count, round(avg(sentiment_score), 3) AS avg_score,
         sum(sentiment_score) AS s, count(sentiment_score) AS n,
         round(CAST(count(*) AS DOUBLE) * 100 / sum(count(*)) OVER (), 1) AS percentage
  FROM sentiment
  WHERE {_window_sql('analyzed_at', 168)} AND brand = '{BRAND}'
  GROUP BY sentiment_label
)
SELECT round(avg(avg_score), 6) AS score_unweighted, round(sum(s) / sum(n), 6) AS score_weighted,
       CAST(coalesce(sum(count), 0) AS BIGINT) AS total_mentions,
       coalesce(max(CASE WHEN sentiment_label = 'POSITIVE' THEN percentage END), 0.0) AS positive_pct,
       CASE WHEN avg(avg_score) > 0.6 THEN 'good' WHEN avg(avg_score) > 0.4 THEN 'mid' ELSE 'bad' END AS kpi_band,
       format('{{:,}}', CAST(coalesce(sum(count), 0) AS BIGINT)) AS total_mentions_text,
       printf('%.2f', round(avg(avg_score), 6)) AS score_text,
       printf('%.1f', coalesce(max(CASE WHEN sentiment_label = 'POSITIVE' THEN percentage END), 0.0)) || '%' AS positive_text
FROM g
""")
def q_kpi_summary(spark, sf_dir):
    return SV.kpi_summary(AD.sentiment_table(spark, sf_dir), AS_OF, hours=168, brand=BRAND)


def _top_topics_sql(table: str, limit: int) -> str:
    """Each post's analyses in range as partial sums, then per topic of the post."""
    return f"""
SELECT topic.topic, sum(p.n)::BIGINT AS mentions, round(sum(p.total) / sum(p.scored), 3) AS avg_sentiment
FROM topic, (SELECT post_id, count(*) AS n, sum(sentiment_score) AS total, count(sentiment_score) AS scored FROM {table}
             WHERE brand = '{BRAND}' AND {_window_sql('analyzed_at', 168)} GROUP BY ALL) p
WHERE topic.post_id = p.post_id GROUP BY topic.topic ORDER BY mentions DESC, topic.topic LIMIT {limit}"""


def _latest_sql(name: str, table: str, where: str, columns: list[str]) -> str:
    """The greatest (time, score) of every post, with the columns that go with it."""
    fields = ", ".join(f"{c} := {c}" for c in ["analyzed_at", "sentiment_score", *columns])
    return f"""{name} AS (SELECT post_id, unnest(max(struct_pack({fields}))) FROM {table} WHERE {where} GROUP BY post_id)"""


_NEGATIVE = f"sentiment_label = 'NEGATIVE' AND brand = '{BRAND}' AND {_window_sql('analyzed_at', 720)}"


@register("top_topics", "A3 J1 L2",
          with_(REANALYZED_CTE, TOPIC_CTE) + _top_topics_sql("sentiment2", 5))
def q_top_topics(spark, sf_dir):
    # Replayed analyses on the sentiment side: the join fans out (reference semantics).
    return SV.top_topics(AD.topic_table(spark, sf_dir), AD.reanalyzed_sentiment_table(spark, sf_dir),
                         AS_OF, hours=168, brand=BRAND, limit=5)


@register("topic_bubble", "A3 F7 F11 L6", with_(SENTIMENT_CTE, TOPIC_CTE) + f"""
, tt AS ({_top_topics_sql("sentiment", 10)})
SELECT topic, mentions, avg_sentiment, round(sqrt(mentions) * 3, 6) AS bubble_size,
       CASE WHEN avg_sentiment > 0.6 THEN 'good' WHEN avg_sentiment < 0.4 THEN 'bad' ELSE 'mid' END AS score_band,
       row_number() OVER (ORDER BY mentions, topic)::INT AS position
FROM tt
""")
def q_topic_bubble(spark, sf_dir):
    return positioned(SV.topic_bubble(AD.topic_table(spark, sf_dir), AD.sentiment_table(spark, sf_dir),
                                      AS_OF, hours=168, brand=BRAND, limit=10))


@register("top_topics_7d_view", "A5 L2 S12", with_(SENTIMENT_CTE, TOPIC_CTE) + f"""
SELECT topic, count(*) AS mentions, round(avg(sentiment_score), 3) AS avg_sentiment,
       count(CASE WHEN sentiment_score > 0.6 THEN 1 END) AS positive_mentions,
       count(CASE WHEN sentiment_score < 0.4 THEN 1 END) AS negative_mentions,
       {AS_OF_SQL} AS computed_at
FROM topic
WHERE {_window_sql('created_at', 168)}
GROUP BY topic
ORDER BY mentions DESC, topic
LIMIT 10
""")
def q_top_topics_7d_view(spark, sf_dir):
    return SV.top_topics_7d_view(AD.topic_table(spark, sf_dir), AS_OF, days=7, limit=10)


@register("sentiment_by_source", "A4 L5", with_(SENTIMENT_CTE) + f"""
SELECT source, sentiment_label, count(*) AS count, row_number() OVER (ORDER BY source, sentiment_label)::INT AS position
FROM sentiment
WHERE {_window_sql('analyzed_at', 720)} AND brand = '{BRAND}'
GROUP BY source, sentiment_label
""")
def q_sentiment_by_source(spark, sf_dir):
    return positioned(SV.sentiment_by_source(AD.sentiment_table(spark, sf_dir), AS_OF, hours=720, brand=BRAND))


@register("source_label_pivot", "A11", with_(SENTIMENT_CTE) + f"""
SELECT source,
       CAST(coalesce(sum(CASE WHEN sentiment_label = 'NEGATIVE' THEN 1 END), 0) AS BIGINT) AS NEGATIVE,
       CAST(coalesce(sum(CASE WHEN sentiment_label = 'NEUTRAL' THEN 1 END), 0) AS BIGINT) AS NEUTRAL,
       CAST(coalesce(sum(CASE WHEN sentiment_label = 'POSITIVE' THEN 1 END), 0) AS BIGINT) AS POSITIVE
FROM sentiment
WHERE {_window_sql('analyzed_at', 720)} AND brand = '{BRAND}'
GROUP BY source
""")
def q_source_label_pivot(spark, sf_dir):
    return SV.source_label_pivot(AD.sentiment_table(spark, sf_dir), AS_OF, hours=720, brand=BRAND)


@register("negative_mentions", "W2 L3", with_(REANALYZED_CTE) + f"""
, {_latest_sql("latest", "sentiment2", _NEGATIVE, ["content", "source"])}
SELECT post_id, content, sentiment_score, source, analyzed_at AS created_at FROM latest
ORDER BY sentiment_score, created_at DESC, post_id LIMIT 25
""")
def q_negative_mentions(spark, sf_dir):
    return SV.negative_mentions(AD.reanalyzed_sentiment_table(spark, sf_dir), AS_OF, hours=720,
                                brand=BRAND, limit=25)


@register("latest_analysis_per_post", "W2", with_(REANALYZED_CTE) + f"""
, {_latest_sql("latest", "sentiment2", "true", ["content", "sentiment_label", "confidence", "created_at", "source", "brand"])}
SELECT post_id, content, sentiment_label, round(sentiment_score, 9) AS sentiment_score,
       round(confidence, 9) AS confidence, analyzed_at, created_at, source, brand
FROM latest
""")
def q_latest_analysis_per_post(spark, sf_dir):
    df = SV.latest_per_post(AD.reanalyzed_sentiment_table(spark, sf_dir))
    return df.select("post_id", "content", "sentiment_label", F.round("sentiment_score", 9).alias("sentiment_score"),
                     F.round("confidence", 9).alias("confidence"), "analyzed_at", "created_at", "source", "brand")


@register("mention_cards", "F4 F10 F14 F18 F21", with_(REANALYZED_CTE) + f"""
, {_latest_sql("latest", "sentiment2", _NEGATIVE, ["content", "source"])},
nm AS (SELECT *, analyzed_at AS created_at, row_number() OVER (ORDER BY sentiment_score, analyzed_at DESC, post_id)::INT AS card
       FROM latest QUALIFY card <= 25)
SELECT post_id, sentiment_score, created_at,
       CASE WHEN sentiment_score < 0.2 THEN 'CRITICAL' WHEN sentiment_score < 0.3 THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
       strftime(created_at, '%Y-%m-%d %H:%M') AS time_text, upper(source) AS source_text,
       content, substr(content, 1, 50) AS preview, printf('%.3f', sentiment_score) AS score_text,
       printf('%.2f', sentiment_score) AS score_short, card
FROM nm
""")
def q_mention_cards(spark, sf_dir):
    return SV.mention_cards(AD.reanalyzed_sentiment_table(spark, sf_dir), AS_OF, hours=720, brand=BRAND, limit=25)


@register("available_brands", "A13 P10", with_(SENTIMENT_CTE) + """
SELECT brand, row_number() OVER (ORDER BY brand)::INT AS position FROM (SELECT DISTINCT brand FROM sentiment WHERE brand IS NOT NULL)
""")
def q_available_brands(spark, sf_dir):
    return positioned(SV.available_brands(AD.sentiment_table(spark, sf_dir)))
