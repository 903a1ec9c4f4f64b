"""DuckDB SQL twins of the adapters (see :mod:`brandpulse.plans.adapters`).

Each registered query's oracle is ``WITH <adapters> <query>``; the tables named here
are the driver's pre-registered views.
"""

from __future__ import annotations

from brandpulse import schemas as S

AS_OF_SQL = "TIMESTAMP '2024-01-31 00:00:00'"

_TOPIC_LIST = "[" + ", ".join(f"'{t}'" for t in S.TOPICS) + "]"

_LABEL_CASE = ("CASE WHEN 2 * s - 1 >= 0.05 THEN 'POSITIVE' "
               "WHEN 2 * s - 1 <= -0.05 THEN 'NEGATIVE' ELSE 'NEUTRAL' END")

SENTIMENT_CTE = f"""
ev AS (SELECT *, value / (value + 50.0e0) AS s FROM events),
sentiment AS (
  SELECT CAST(event_id AS VARCHAR) AS post_id, props AS content,
         {_LABEL_CASE} AS sentiment_label,
         s AS sentiment_score, abs(2 * s - 1) AS confidence,
         ts + to_minutes(CAST(event_id % 60 AS INTEGER)) AS analyzed_at,
         ts AS created_at, event_type AS source,
         'brand_' || CAST(user_id % 7 AS VARCHAR) AS brand
  FROM ev
)"""

REANALYZED_CTE = SENTIMENT_CTE + f""",
second_pass AS (
  SELECT post_id, content, s2 AS sentiment_score, abs(2 * s2 - 1) AS confidence,
         CASE WHEN 2 * s2 - 1 >= 0.05 THEN 'POSITIVE' WHEN 2 * s2 - 1 <= -0.05 THEN 'NEGATIVE'
              ELSE 'NEUTRAL' END AS sentiment_label,
         analyzed_at + to_hours(CASE WHEN CAST(post_id AS BIGINT) % 2 = 0 THEN 1 ELSE -1 END) AS analyzed_at,
         created_at, source, brand
  FROM (SELECT *, sentiment_score * 0.9e0 AS s2 FROM sentiment)
),
sentiment2 AS (
  SELECT post_id, content, sentiment_label, sentiment_score, confidence, analyzed_at, created_at, source, brand
  FROM sentiment
  UNION ALL
  SELECT post_id, content, sentiment_label, sentiment_score, confidence, analyzed_at, created_at, source, brand
  FROM second_pass
)"""

TOPIC_CTE = f"""
topic AS (
  SELECT CAST(event_id AS VARCHAR) AS post_id, {_TOPIC_LIST}[CAST(user_id % 8 + 1 AS INTEGER)] AS topic,
         abs(2 * s - 1) AS confidence, s AS sentiment_score,
         ts + to_minutes(CAST(event_id % 60 AS INTEGER)) AS analyzed_at, ts AS created_at,
         'brand_' || CAST(user_id % 7 AS VARCHAR) AS brand
  FROM ev
  UNION ALL
  SELECT CAST(event_id AS VARCHAR), {_TOPIC_LIST}[CAST(event_id % 8 + 1 AS INTEGER)],
         abs(2 * s - 1), s, ts + to_minutes(CAST(event_id % 60 AS INTEGER)), ts,
         'brand_' || CAST(user_id % 7 AS VARCHAR)
  FROM ev WHERE event_id % 8 <> user_id % 8
)"""

TEXTS_CTE = """
texts AS (
  SELECT CAST(doc_id AS VARCHAR) AS post_id, source, lang AS brand, text AS content FROM documents
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip().rstrip(",") for c in ctes) + "\n"
