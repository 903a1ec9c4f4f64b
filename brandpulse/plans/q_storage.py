"""Registered queries over stored tables: compaction, key index, composed jobs, metrics, co-bucketed joins."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from brandpulse import schemas as S
from brandpulse.functions import scoring as SC
from brandpulse.operators import jobs as JB
from brandpulse.operators import quality as QA
from brandpulse.operators import sentiment as SE
from brandpulse.operators import serving as SV
from brandpulse.plans import adapters as AD
from brandpulse.plans.oracle import AS_OF_SQL, REANALYZED_CTE, SENTIMENT_CTE, TOPIC_CTE, with_
from brandpulse.plans.q_ingest import EVENT_TEXTS_CTE, NUMBER_LEXICON, _messages, _stream_dirs
from brandpulse.plans.q_jobs import SHIFT_BANDS, _grid_alerts_sql, _rollup_sql, _shift_sql
from brandpulse.plans.q_serving import _top_topics_sql
from brandpulse.plans.q_text import _lexicon_sql_body
from brandpulse.plans.registry import AS_OF, BRAND, register, window_sql
from brandpulse.session import work_dir
from brandpulse.sources import ingest as IN
from brandpulse.sources import layout as LY
from brandpulse.sources import maintenance as MT
from brandpulse.sources import tables as TB
from brandpulse.sources import views as VW
from brandpulse.streaming import flows as FL

SILVER_DAY = "created_at"


def silver_batches(spark, sf_dir, root: str, parts: int = 4, compact_after: int = 2) -> None:
    """silver.sentiment as the stream leaves it: batches by post, folded into days after some, one replayed."""
    s = AD.sentiment_table(spark, sf_dir)
    for n in range(parts):
        batch = s.where(F.col("post_id").cast("long") % parts == n)
        LY.write_batch(batch, root, n, SILVER_DAY)
        if n + 1 == compact_after:
            LY.compact(spark, root, s.schema, SILVER_DAY)
            LY.write_batch(batch, root, n, SILVER_DAY)      # replayed: its folder is there
            LY.write_batch(batch, root, 0, SILVER_DAY)      # replayed from long ago: the manifest has it


@register("overview_compacted", "S6 S8 A1 (batch folders folded into day partitions, replays)", with_(SENTIMENT_CTE) + f"""
SELECT sentiment_label, count(*) AS count, round(avg(sentiment_score), 3) AS avg_score,
       round(CAST(count(*) AS DOUBLE) * 100 / sum(count(*)) OVER (), 1) AS percentage
FROM sentiment WHERE {window_sql('created_at', 168)} AND brand = '{BRAND}' GROUP BY sentiment_label
""")
def q_overview_compacted(spark, sf_dir):
    root = work_dir(spark, "q-compact") + "/silver_sentiment"
    silver_batches(spark, sf_dir, root)
    live = LY.read_live(spark, root, AD.sentiment_table(spark, sf_dir).schema, SILVER_DAY)
    return SV.sentiment_overview(live, AS_OF, hours=168, brand=BRAND, time_col=SILVER_DAY)


@register("top_topics_bucketed", "J1 A3 (stored tables of one bucketing)", with_(REANALYZED_CTE, TOPIC_CTE) + _top_topics_sql("sentiment2", 5))
def q_top_topics_bucketed(spark, sf_dir):
    base, name = work_dir(spark, "q-bucketed"), uuid.uuid4().hex[:8]
    topic = TB.write_bucketed(AD.topic_table(spark, sf_dir), f"topic_{name}", f"{base}/topic", "post_id", 8)
    sentiment = TB.write_bucketed(AD.reanalyzed_sentiment_table(spark, sf_dir), f"sentiment_{name}", f"{base}/sentiment", "post_id", 8)
    return SV.top_topics(topic, sentiment, AS_OF, hours=168, brand=BRAND, limit=5)


# ------------------------------------------------------------------------------------ streams
@register("stream_minute_counts_update", "T3 S11 A8 (update mode, keyed merge, two runs)",
          "WITH " + EVENT_TEXTS_CTE.strip() + _lexicon_sql_body(NUMBER_LEXICON) + """
SELECT date_trunc('minute', e.ts) AS hour_bucket, date_trunc('minute', e.ts) + INTERVAL 1 MINUTE AS window_end,
       r.sentiment_label, count(*) AS count, round(sum(r.sentiment_score), 6) / count(*) AS avg_sentiment_score, r.source
FROM result r JOIN events e ON r.post_id = CAST(e.event_id AS VARCHAR) WHERE e.event_type <> 'error'
GROUP BY 1, 2, 3, r.source
""")
def q_stream_minute_counts_update(spark, sf_dir):
    base, inp, tables, ck = _stream_dirs(spark, "stream-updates")
    lex = SE.lexicon_frame(spark, NUMBER_LEXICON)
    _messages(spark, sf_dir).write.mode("append").text(inp)
    src = IN.posts_source(spark, "files", inp)
    FL.run_to_end(FL.start_ingest(src, tables, f"{ck}/ingest", lex, tier=1, now=AS_OF, query_name=None))
    gold = f"{tables}/gold_minute_counts"
    for _ in range(2):    # the second run finds nothing new
        FL.run_to_end(FL.start_window_counts_update(spark, f"{tables}/silver_sentiment", gold, f"{ck}/minutes", query_name=None))
    g = spark.read.parquet(gold)
    avg = SC.round_binary(F.col("avg_sentiment_score") * F.col("count"), 6) / F.col("count")
    return g.select(F.col("hour_bucket").cast("timestamp_ntz").alias("hour_bucket"), F.col("window_end").cast("timestamp_ntz").alias("window_end"),
                    "sentiment_label", "count", avg.alias("avg_sentiment_score"), "source")


@register("stream_batch_metrics", "T11 (listener, two runs)", """
WITH m AS (SELECT count(*) AS n, count(*) FILTER (WHERE event_type <> 'error') AS valid FROM events)
SELECT 1 AS run, 2 * n AS rows, 2 * valid AS valid_rows, valid AS stored FROM m
UNION ALL SELECT 2, n, valid, 0 FROM m
""")
def q_stream_batch_metrics(spark, sf_dir):
    """Figures that the listener kept of two runs, the second a replay, with the posts that bronze took."""
    base, inp, tables, ck = _stream_dirs(spark, "stream-metrics")
    lex = SE.lexicon_frame(spark, NUMBER_LEXICON)
    metrics = FL.BatchMetrics(f"{base}/metrics")
    spark.streams.addListener(metrics)
    try:
        msgs = _messages(spark, sf_dir)
        for rows in (msgs.unionAll(msgs), msgs):
            rows.write.mode("append").text(inp)
            FL.run_to_end(FL.start_ingest(IN.posts_source(spark, "files", inp), tables, f"{ck}/ingest", lex, tier=1, now=AS_OF, query_name=None))
            metrics.flush(spark)
    finally:
        spark.streams.removeListener(metrics)
    kept = spark.read.schema(metrics.SCHEMA).parquet(metrics.path).groupBy("batch_id").agg(F.sum("rows").alias("rows"), F.sum("valid_rows").alias("valid_rows"))
    bronze = spark.read.parquet(f"{tables}/bronze").groupBy("batch_id").agg(F.count(F.lit(1)).alias("stored"))
    return kept.join(bronze, "batch_id", "left").selectExpr(
        "CAST(row_number() OVER (ORDER BY batch_id) AS INT) AS run", "rows", "valid_rows", "coalesce(stored, 0) AS stored")


# ------------------------------------------------------------------------------------ jobs
ROLLUP_RUNS = ("2024-01-20 12:30:00", "2024-01-21 06:10:00")


@register("rollup_job_two_runs", "A6 A14 S11 (stored table of two overlapping runs, rows written)", with_(SENTIMENT_CTE) + f"""
, a AS ({_rollup_sql("sentiment", f"TIMESTAMP '{ROLLUP_RUNS[0]}'", 300)}),
b AS ({_rollup_sql("sentiment", f"TIMESTAMP '{ROLLUP_RUNS[1]}'", 48)}),
both_ AS (SELECT * FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.hour_bucket = a.hour_bucket AND b.sentiment_label = a.sentiment_label AND b.source = a.source)
          UNION ALL SELECT * FROM b)
SELECT *, (SELECT count(*) FROM a) AS first_rows, (SELECT count(*) FROM b) AS second_rows FROM both_
""")
def q_rollup_job_two_runs(spark, sf_dir):
    path = work_dir(spark, "q-rollup-job") + "/hourly"
    s = AD.sentiment_table(spark, sf_dir)
    done = [MT.run_hourly_rollup(spark, s, path, as_of, hours) for as_of, hours in zip(ROLLUP_RUNS, (300, 48))]
    table = TB.read_table(spark, path, done[0].written.schema).drop("hour_day")
    return table.withColumns({"first_rows": F.lit(done[0].rows).cast("long"), "second_rows": F.lit(done[1].rows).cast("long")})


SHIFT_RUNS = ("2024-01-30 23:40:00", "2024-01-30 23:40:00", AS_OF)


@register("shift_job_three_runs", "A7 A14 J3 (stored alerts suppress later runs, rows appended)", with_(SENTIMENT_CTE, TOPIC_CTE) + f"""
, a AS ({_shift_sql(f"TIMESTAMP '{SHIFT_RUNS[0]}'", **SHIFT_BANDS)}),
c AS (SELECT * FROM ({_shift_sql(AS_OF_SQL, (300, 0), (600, 300))}) n
      WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.affected_topic = n.affected_topic)),
every AS (SELECT * FROM a UNION ALL SELECT * FROM c)
SELECT *, (SELECT count(*) FROM a) AS first_rows, 0 AS again_rows, (SELECT count(*) FROM c) AS last_rows FROM every
""")
def q_shift_job_three_runs(spark, sf_dir):
    path = work_dir(spark, "q-shift-job") + "/alerts"
    topic = AD.topic_table(spark, sf_dir)
    bands = (SHIFT_BANDS, SHIFT_BANDS, {"recent": (300, 0), "baseline": (600, 300)})
    done = [MT.run_shift_detection(spark, topic, path, as_of, direction="both", **b) for as_of, b in zip(SHIFT_RUNS, bands)]
    counts = dict(zip(("first_rows", "again_rows", "last_rows"), (d.rows for d in done)))
    return TB.read_table(spark, path, done[0].written.schema).withColumns(
        {k: F.lit(n).cast("int" if k == "again_rows" else "long") for k, n in counts.items()})


DENSE = ("2024-01-29 00:00:00", AS_OF)


@register("shift_alert_backfill_dense", "A7 J3 (10-minute grid whose runs suppress each other)", with_(SENTIMENT_CTE, TOPIC_CTE).replace("WITH ", "WITH RECURSIVE ", 1) + ", "
          + _grid_alerts_sql(f"TIMESTAMP '{DENSE[0]}'", AS_OF_SQL, step_minutes=10) + """,
nxt AS (SELECT a.affected_topic, a.detected_at, min(b.detected_at) AS then_at FROM alerts a LEFT JOIN alerts b
        ON b.affected_topic = a.affected_topic AND b.detected_at > a.detected_at + INTERVAL 30 MINUTE GROUP BY ALL),
kept AS (SELECT affected_topic, min(detected_at) AS detected_at FROM alerts GROUP BY affected_topic
         UNION ALL SELECT k.affected_topic, n.then_at FROM kept k JOIN nxt n USING (affected_topic, detected_at) WHERE n.then_at IS NOT NULL)
SELECT alerts.* FROM alerts JOIN kept USING (affected_topic, detected_at)
""")
def q_shift_alert_backfill_dense(spark, sf_dir):
    return JB.detect_shift_series(AD.topic_table(spark, sf_dir), *DENSE, step_minutes=10, direction="both", details=True)


# ------------------------------------------------------------------------------------ D1 D2 D3 D4 D5
@register("constraint_violations", "D1 D2 D3 D4 D5 (rows)", with_(SENTIMENT_CTE) + """
, s2 AS (
  SELECT post_id, CASE WHEN source = 'error' THEN NULL ELSE source END AS source, content,
         CASE WHEN source = 'purchase' THEN 'MIXED' ELSE sentiment_label END AS label2, brand FROM sentiment
  UNION ALL SELECT post_id, source, content, sentiment_label, brand FROM sentiment WHERE source = 'click'
)
SELECT 'not_null(source)' AS rule, post_id AS key, NULL AS value FROM s2 WHERE source IS NULL
UNION ALL SELECT 'max_length(content)', post_id, content FROM s2 WHERE length(content) > 8
UNION ALL SELECT 'in_set(label2)', post_id, label2 FROM s2 WHERE label2 NOT IN ('NEGATIVE', 'NEUTRAL', 'POSITIVE')
UNION ALL SELECT 'unique(post_id)', post_id, CAST(count(*) AS VARCHAR) FROM s2 WHERE post_id IS NOT NULL GROUP BY post_id HAVING count(*) > 1
UNION ALL SELECT 'foreign_key(brand)', post_id, brand FROM s2 WHERE brand NOT IN ('brand_0', 'brand_1', 'brand_2', 'brand_3', 'brand_4')
""")
def q_constraint_violations(spark, sf_dir):
    s = AD.sentiment_table(spark, sf_dir)
    s2 = s.select("post_id", F.when(F.col("source") != "error", F.col("source")).alias("source"), "content",
                  F.when(F.col("source") == "purchase", F.lit("MIXED")).otherwise(F.col("sentiment_label")).alias("label2"), "brand")
    s2 = s2.unionByName(s.filter(F.col("source") == "click").select("post_id", "source", "content", F.col("sentiment_label").alias("label2"), "brand"))
    brands = spark.range(5).select(F.concat(F.lit("brand_"), F.col("id").cast("string")).alias("brand"))
    rules = [QA.not_null("source"), QA.max_length("content", 8), QA.in_set("label2", S.LABELS), QA.unique("post_id"), QA.foreign_key("brand", brands)]
    return QA.violations(s2, rules, "post_id")


# ------------------------------------------------------------------------------------ S12 A5
VIEW_CLOCKS = ("2024-01-29 10:20:00", "2024-01-29 23:10:00", "2024-01-30 02:40:00", "2024-01-30 20:40:00")


@register("top_topics_7d_incremental", "A5 S12 (view refreshed by what entered and left its window)", with_(SENTIMENT_CTE, TOPIC_CTE) + f"""
SELECT topic, count(*) AS mentions, round(avg(sentiment_score), 3) AS avg_sentiment,
       count(CASE WHEN sentiment_score > 0.6 THEN 1 END) AS positive_mentions,
       count(CASE WHEN sentiment_score < 0.4 THEN 1 END) AS negative_mentions, TIMESTAMP '{VIEW_CLOCKS[-1]}' AS computed_at
FROM topic WHERE created_at BETWEEN TIMESTAMP '{VIEW_CLOCKS[-1]}' - INTERVAL 168 HOUR AND TIMESTAMP '{VIEW_CLOCKS[-1]}'
GROUP BY topic
""")
def q_top_topics_7d_incremental(spark, sf_dir):
    root = work_dir(spark, "q-sliding") + "/topics"
    view = VW.SlidingView("topic", 168)
    for clock in VIEW_CLOCKS:
        view.refresh(AD.topic_table(spark, sf_dir), root, clock)
    return VW.read_view(spark, root)
