"""Registered ingest, table-maintenance, data-quality and streaming queries.

S2 S3 S9 S10 S6 P1 P2 P4 P13 F1 F16 F17 F20 W4 J4 J5 D1-D5 A8 T1-T6 T11.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from brandpulse import schemas as S
from brandpulse.functions import scoring as SC
from brandpulse.operators import quality as QA
from brandpulse.operators import sentiment as SE
from brandpulse.plans import adapters as AD
from brandpulse.plans.oracle import SENTIMENT_CTE, with_
from brandpulse.plans.q_text import _lexicon_sql_body, _topics_sql
from brandpulse.plans.registry import AS_OF, register
from brandpulse.session import work_dir
from brandpulse.sources import ingest as IN
from brandpulse.sources import tables as TB
from brandpulse.streaming import flows as FL

# ====================================================================== message fixtures
# Posts built from ``events``: title/author/url/feed fields are derived, created_at is an
# ISO-8601 UTC text with microseconds (parsed back exactly).
FEED_URL_SQL = "'https://news.example.com/rss/search?q=' || 'brand_' || CAST(user_id % 7 AS VARCHAR) || '&hl=en-US'"


def _event_posts(spark, sf_dir):
    ev = AD.read(spark, sf_dir, "events")
    brand = F.concat(F.lit("brand_"), (F.col("user_id") % 7).cast("string"))
    return ev.select(
        F.col("event_id").cast("string").alias("post_id"),
        F.col("event_type").alias("source"),
        F.concat(F.lit("Post "), F.col("event_id").cast("string")).alias("title"),
        F.col("props").alias("content"),
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("author"),
        F.concat(F.lit("https://example.com/p/"), F.col("event_id").cast("string")).alias("url"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("created_at"),
        F.lit("2024-01-31T00:00:00").alias("ingested_at"),
        F.struct(F.concat(F.lit("https://news.example.com/rss/search?q="), brand, F.lit("&hl=en-US")).alias("feed_url"),
                 F.concat(brand, F.lit(" - Google News")).alias("feed_title"),
                 brand.alias("brand_monitored")).alias("raw_metadata"),
        F.col("event_type"),
    )


def _messages(spark, sf_dir, malformed_errors: bool = True, spread: bool = False):
    """JSON messages for every event; 'error' events are sent as broken JSON when asked.
    ``spread`` lays them over the task slots like the partitions of a message-bus topic."""
    p = _event_posts(spark, sf_dir)
    if spread:
        p = p.repartition(spark.sparkContext.defaultParallelism)
    good = IN.to_messages(p.drop("event_type"), key_col=None)
    if not malformed_errors:
        return good
    value = F.when(p["event_type"] == F.lit("error"), F.concat(F.lit('{"post_id": '), F.col("content")))
    return p.select(F.coalesce(value, F.to_json(F.struct(*[F.col(c) for c in p.columns if c != "event_type"])))
                    .alias("value"))


# ====================================================================== S2 P1 P2 P4 F20
@register("decode_messages", "S2 P1 P2 P4 F1 F20", with_(SENTIMENT_CTE) + """
SELECT CASE WHEN event_type = 'error' THEN NULL ELSE CAST(event_id AS VARCHAR) END AS post_id,
       CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS source,
       CASE WHEN event_type = 'error' THEN NULL ELSE 'Post ' || CAST(event_id AS VARCHAR) END AS title,
       CASE WHEN event_type = 'error' THEN NULL ELSE props END AS content,
       CASE WHEN event_type = 'error' THEN NULL ELSE ts END AS created_at,
       CASE WHEN event_type = 'error' THEN NULL ELSE 'brand_' || CAST(user_id % 7 AS VARCHAR) END AS brand,
       event_type <> 'error' AS is_valid
FROM events
""")
def q_decode_messages(spark, sf_dir):
    d = IN.decode_posts(_messages(spark, sf_dir, spread=True), now=AS_OF)
    return d.select("post_id", "source", "title", "content", F.col("created_at").cast("timestamp_ntz").alias("created_at"),
                    "brand", F.col("post_id").isNotNull().alias("is_valid"))


# ====================================================================== F1 (Q1)
_TIME_TEXT_CASES = 7


def _time_text_spark():
    k = F.col("event_id") % _TIME_TEXT_CASES
    ts = F.col("ts")
    return (F.when(k == 0, F.concat(F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT")))
             .when(k == 1, F.concat(F.date_format(ts, "EEE, d MMM yyyy HH:mm:ss"), F.lit(" +0200")))
             .when(k == 2, F.concat(F.date_format(ts, "d MMM yyyy HH:mm:ss"), F.lit(" GMT")))
             .when(k == 3, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
             .when(k == 4, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
             .when(k == 5, F.lit("not a date"))
             .otherwise(F.lit("")))


@register("event_time_parse", "F1 Q1", """
SELECT CAST(event_id AS VARCHAR) AS post_id,
       CASE event_id % 7
         WHEN 0 THEN strftime(ts, '%a, %d %b %Y %H:%M:%S') || ' GMT'
         WHEN 1 THEN strftime(ts, '%a, %-d %b %Y %H:%M:%S') || ' +0200'
         WHEN 2 THEN strftime(ts, '%-d %b %Y %H:%M:%S') || ' GMT'
         WHEN 3 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
         WHEN 4 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
         WHEN 5 THEN 'not a date'
         ELSE '' END AS created_at_text,
       CASE WHEN event_id % 7 = 1 THEN date_trunc('second', ts) - INTERVAL 2 HOUR
            WHEN event_id % 7 IN (5, 6) THEN NULL
            ELSE date_trunc('second', ts) END AS created_at
FROM events
""")
def q_event_time_parse(spark, sf_dir):
    ev = AD.read(spark, sf_dir, "events")
    t = ev.select(F.col("event_id").cast("string").alias("post_id"), _time_text_spark().alias("created_at_text"))
    from brandpulse.functions.time import parse_event_time
    return t.select("post_id", "created_at_text",
                    parse_event_time("created_at_text").cast("timestamp_ntz").alias("created_at"))


# ====================================================================== S3 W4 F16 F17
def _feed_entries(spark, sf_dir):
    pg = AD.read(spark, sf_dir, "pages")
    pid = F.col("page_id")
    site = F.regexp_extract("url", r"://(?:m\.)?([^./]+)", 1)
    t = F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")) + F.make_dt_interval(hours=(pid % 100_000).cast("int"))
    return pg.select(
        F.concat(F.lit("https://news.example.com/rss/search?q="), site, F.lit("&hl=en-US")).alias("feed_url"),
        F.when(pid % 5 != 0, F.concat(site, F.lit(" - Google News"))).alias("feed_title"),
        F.lit("newsroom").alias("feed_author"),
        (pid % 20).cast("int").alias("position"),
        F.floor(pid / 20).alias("poll"),
        F.when(pid % 4 != 0, F.concat(F.lit("page-"), pid.cast("string"))).alias("id"),
        F.col("url").alias("link"),
        F.regexp_extract("html", "<title>(.*?)</title>", 1).alias("title"),
        F.when(pid % 3 != 0, F.col("html")).alias("summary"),
        F.concat(F.lit("desc "), pid.cast("string")).alias("description"),
        F.when(pid % 2 != 0, F.lit("staff")).alias("author"),
        F.when(pid % 3 != 0, F.date_format(t, "EEE, dd MMM yyyy HH:mm:ss 'GMT'")).alias("published"),
        F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("updated"),
    )


@register("normalize_feed", "S3 F16 F17 W4", r"""
WITH e AS (
  SELECT 'https://news.example.com/rss/search?q=' || regexp_extract(url, '://(?:m\.)?([^./]+)', 1) || '&hl=en-US' AS feed_url,
         CASE WHEN page_id % 5 <> 0 THEN regexp_extract(url, '://(?:m\.)?([^./]+)', 1) || ' - Google News' END AS feed_title,
         'newsroom' AS feed_author, page_id % 20 AS position, page_id // 20 AS poll,
         CASE WHEN page_id % 4 <> 0 THEN 'page-' || CAST(page_id AS VARCHAR) END AS id,
         url AS link, regexp_extract(html, '<title>(.*?)</title>', 1) AS title,
         CASE WHEN page_id % 3 <> 0 THEN html END AS summary,
         'desc ' || CAST(page_id AS VARCHAR) AS description,
         CASE WHEN page_id % 2 <> 0 THEN 'staff' END AS author,
         CASE WHEN page_id % 3 <> 0 THEN strftime(TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(page_id % 100000 AS INTEGER)),
                                                   '%a, %d %b %Y %H:%M:%S GMT') END AS published,
         strftime(TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(page_id % 100000 AS INTEGER)), '%Y-%m-%dT%H:%M:%SZ') AS updated
  FROM pages
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY feed_url, poll ORDER BY position, link) AS rn FROM e
)
SELECT coalesce(id, link) AS post_id,
       list_extract(string_split(coalesce(feed_title, 'google_news'), ' - '), -1) AS source,
       coalesce(title, '') AS title, coalesce(summary, description, '') AS content,
       coalesce(author, feed_author, '') AS author, coalesce(link, '') AS url,
       coalesce(published, updated, '') AS created_at,
       split_part(split_part(feed_url, 'q=', 2), '&', 1) AS brand_monitored,
       coalesce(feed_title, '') AS feed_title
FROM ranked WHERE rn <= 10
""")
def q_normalize_feed(spark, sf_dir):
    n = IN.normalize_feed(_feed_entries(spark, sf_dir), now=AS_OF, poll_cols=("poll",))
    return n.select("post_id", "source", "title", "content", "author", "url", "created_at",
                    F.col("raw_metadata.brand_monitored").alias("brand_monitored"),
                    F.col("raw_metadata.feed_title").alias("feed_title"))


# ====================================================================== S9 S10 J5 P13
@register("insert_if_absent", "S9 S10 J5 P13", with_(SENTIMENT_CTE) + """
, target AS (SELECT post_id, source, content, created_at FROM sentiment WHERE created_at < TIMESTAMP '2024-01-20 00:00:00'),
batch AS (SELECT post_id, source, content, created_at FROM sentiment WHERE created_at >= TIMESTAMP '2024-01-15 00:00:00'),
new_rows AS (SELECT * FROM batch b WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.post_id = b.post_id))
SELECT *, true AS existed FROM target
UNION ALL
SELECT *, false AS existed FROM new_rows
""")
def q_insert_if_absent(spark, sf_dir):
    s = AD.sentiment_table(spark, sf_dir).select("post_id", "source", "content", "created_at")
    target = s.filter(F.col("created_at") < F.to_timestamp_ntz(F.lit("2024-01-20 00:00:00")))
    batch = s.filter(F.col("created_at") >= F.to_timestamp_ntz(F.lit("2024-01-15 00:00:00")))
    batch = batch.unionByName(batch)      # the same batch delivered twice
    new = TB.append_new(batch, target, S.POSTS_KEY)
    return target.withColumn("existed", F.lit(True)).unionByName(new.withColumn("existed", F.lit(False)))


# ====================================================================== J4 D1-D5
@register("orphan_posts", "J4 D3 Q22", with_(SENTIMENT_CTE) + """
SELECT s.post_id, s.source, s.created_at FROM sentiment s
WHERE NOT EXISTS (SELECT 1 FROM events e WHERE CAST(e.event_id AS VARCHAR) = s.post_id AND e.event_type <> 'error')
""")
def q_orphan_posts(spark, sf_dir):
    # raw.posts holds every post except those whose producer reported an error.
    posts = AD.read(spark, sf_dir, "events").filter(F.col("event_type") != F.lit("error")) \
        .select(F.col("event_id").cast("string").alias("post_id"))
    child = AD.sentiment_table(spark, sf_dir).select("post_id", "source", "created_at")
    return QA.orphans(child, posts, "post_id")


@register("constraint_report", "D1 D2 D3 D4 D5", with_(SENTIMENT_CTE) + f"""
, s2 AS (
  SELECT post_id, CASE WHEN source = 'error' THEN NULL ELSE source END AS source, content, sentiment_label,
         CASE WHEN source = 'purchase' THEN 'MIXED' ELSE sentiment_label END AS label2, brand
  FROM sentiment
  UNION ALL
  SELECT post_id, source, content, sentiment_label, sentiment_label, brand FROM sentiment WHERE source = 'click'
)
SELECT 'not_null' AS rule, 'source' AS column_name, count(*) FILTER (WHERE source IS NULL) AS violations FROM s2
UNION ALL SELECT 'not_null', 'content', count(*) FILTER (WHERE content IS NULL) FROM s2
UNION ALL SELECT 'max_length', 'content', count(*) FILTER (WHERE length(content) > 8) FROM s2
UNION ALL SELECT 'in_set', 'label2', count(*) FILTER (WHERE label2 IS NOT NULL AND label2 NOT IN ('NEGATIVE', 'NEUTRAL', 'POSITIVE')) FROM s2
UNION ALL SELECT 'unique', 'post_id', CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (SELECT post_id, count(*) AS n FROM s2 WHERE post_id IS NOT NULL GROUP BY post_id HAVING count(*) > 1)
UNION ALL SELECT 'foreign_key', 'brand', count(*) FROM s2 WHERE brand IS NOT NULL AND brand NOT IN ('brand_0', 'brand_1', 'brand_2', 'brand_3', 'brand_4')
""")
def q_constraint_report(spark, sf_dir):
    s = AD.sentiment_table(spark, sf_dir)
    s2 = s.select("post_id", F.when(F.col("source") == "error", F.lit(None)).otherwise(F.col("source")).alias("source"),
                  "content", "sentiment_label",
                  F.when(F.col("source") == "purchase", F.lit("MIXED")).otherwise(F.col("sentiment_label")).alias("label2"),
                  "brand")
    s2 = s2.unionByName(s.filter(F.col("source") == "click").select(
        "post_id", "source", "content", "sentiment_label", F.col("sentiment_label").alias("label2"), "brand"))
    brands = spark.range(5).select(F.concat(F.lit("brand_"), F.col("id").cast("string")).alias("brand"))
    rules = [QA.not_null("source"), QA.not_null("content"), QA.max_length("content", 8),
             QA.in_set("label2", S.LABELS), QA.unique("post_id"), QA.foreign_key("brand", brands)]
    return QA.constraint_report(s2, rules)


# ====================================================================== A8 batch form
@register("windowed_minute_counts", "A8 T2 (batch)", with_(SENTIMENT_CTE) + """
SELECT date_trunc('minute', created_at) AS hour_bucket, date_trunc('minute', created_at) + INTERVAL 1 MINUTE AS window_end,
       sentiment_label, count(*) AS count, round(avg(sentiment_score), 6) AS avg_sentiment_score, source
FROM sentiment GROUP BY 1, 2, 3, source
""")
def q_windowed_minute_counts(spark, sf_dir):
    w = FL.window_counts(AD.sentiment_table(spark, sf_dir))
    return w.withColumn("avg_sentiment_score", F.round("avg_sentiment_score", 6))


# ====================================================================== streams
# Fixed test lexicon for event posts (content is '{"k": n}'): numbers 0..99 get a valence
# from a rule, so labels vary.
NUMBER_LEXICON = [(str(n), ((n * 7) % 9 - 4) * 0.5) for n in range(100)]

EVENT_TEXTS_CTE = """
texts AS (
  SELECT CAST(event_id AS VARCHAR) AS post_id, event_type AS source,
         'brand_' || CAST(user_id % 7 AS VARCHAR) AS brand, props AS content
  FROM events
)"""


def _stream_dirs(spark, name):
    base = work_dir(spark, name)
    return base, f"{base}/input", f"{base}/tables", f"{base}/checkpoints"


@register("stream_dedup_sink", "S6 S10 T4 T5 T6 T10 T11 (two runs, replayed input)",
          "WITH " + EVENT_TEXTS_CTE.strip() + _lexicon_sql_body(NUMBER_LEXICON) + """
SELECT r.post_id, r.source, r.sentiment_label, r.sentiment_score, r.confidence, e.ts AS created_at, r.brand
FROM result r JOIN events e ON r.post_id = CAST(e.event_id AS VARCHAR)
WHERE e.event_type <> 'error'
""")
def q_stream_dedup_sink(spark, sf_dir):
    base, inp, tables, ck = _stream_dirs(spark, "stream-dedup")
    lex = SE.lexicon_frame(spark, NUMBER_LEXICON)
    msgs = _messages(spark, sf_dir)
    # Run 1: every message twice in the same batch.
    msgs.unionAll(msgs).write.mode("append").text(inp)
    src = IN.posts_source(spark, "files", inp)
    FL.run_to_end(FL.start_ingest(src, tables, f"{ck}/ingest", lex, tier=1, now=AS_OF, query_name=None))
    # Run 2 (restart from the same checkpoint): the whole stream is replayed.
    msgs.write.mode("append").text(inp)
    src = IN.posts_source(spark, "files", inp)
    FL.run_to_end(FL.start_ingest(src, tables, f"{ck}/ingest", lex, tier=1, now=AS_OF, query_name=None))
    out = spark.read.schema(FL.SENTIMENT_STREAM).parquet(f"{tables}/silver_sentiment")
    return out.select("post_id", "source", "sentiment_label", "sentiment_score", "confidence",
                      F.col("created_at").cast("timestamp_ntz").alias("created_at"), "brand")


LATER = ("2024-03-15 00:00:00", "2024-03-16 00:00:00")


def _replayed(spark, sf_dir, name, vocabulary=None):
    """Three runs over the same messages: the second is weeks after the deduplication horizon and
    moves the watermark past the first, so the third finds nothing of it in the state store."""
    base, inp, tables, ck = _stream_dirs(spark, name)
    lex = SE.lexicon_frame(spark, NUMBER_LEXICON)
    for now in (AS_OF, *LATER):
        _messages(spark, sf_dir).write.mode("append").text(inp)
        src = IN.posts_source(spark, "files", inp)
        FL.run_to_end(FL.start_ingest(src, tables, f"{ck}/ingest", lex, vocabulary, tier=1, now=now, query_name=None))
    return tables


@register("stream_replay_after_horizon", "T5 S10 (bronze as the authority)", """
SELECT CAST(event_id AS VARCHAR) AS post_id, event_type AS source, 'Post ' || CAST(event_id AS VARCHAR) AS title,
       props AS content, ts AS created_at, TIMESTAMP '2024-01-31 00:00:00' AS ingested_at,
       'brand_' || CAST(user_id % 7 AS VARCHAR) AS brand
FROM events WHERE event_type <> 'error'
""")
def q_stream_replay_after_horizon(spark, sf_dir):
    tables = _replayed(spark, sf_dir, "stream-replay")
    names = ["post_id", "source", "title", "content", "created_at", "ingested_at", "brand"]
    b = spark.read.parquet(f"{tables}/bronze").select(*names)
    return b.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c.endswith("_at") else F.col(c) for c in names])


EVENT_VOCABULARY = [("Sevens", ["7"]), ("Tens", ["0}"]), ("Teens", [": 1"])]


@register("stream_topic_sink", "S6 U5 F19 (topic rows of the stream)", "WITH " + EVENT_TEXTS_CTE.strip() + f"""
, tagged AS (SELECT t.post_id, e.ts, t.brand, unnest({_topics_sql(EVENT_VOCABULARY)}) AS topic
             FROM texts t JOIN events e ON t.post_id = CAST(e.event_id AS VARCHAR) WHERE e.event_type <> 'error')
SELECT post_id, topic, ts AS created_at, TIMESTAMP '2024-01-31 00:00:00' AS analyzed_at, brand FROM tagged
""")
def q_stream_topic_sink(spark, sf_dir):
    tables = _replayed(spark, sf_dir, "stream-topics", EVENT_VOCABULARY)
    t = spark.read.schema(FL.TOPIC_STREAM).parquet(f"{tables}/silver_topic")
    return t.select("post_id", "topic", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("created_at", "analyzed_at")], "brand")


@register("stream_quarantine", "P2 S6 (malformed messages, equal ones kept once per horizon)", """
SELECT DISTINCT '{"post_id": ' || props AS raw, clock AS ingested_at
FROM events, (VALUES (TIMESTAMP '2024-01-31 00:00:00'), (TIMESTAMP '2024-03-16 00:00:00')) v(clock)
WHERE event_type = 'error'
""")
def q_stream_quarantine(spark, sf_dir):
    q = spark.read.parquet(f"{_replayed(spark, sf_dir, 'stream-quarantine')}/quarantine")
    return q.select("raw", F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at"))


@register("stream_minute_counts", "A8 T1 T2 T3 (file stream, availableNow, open windows excluded)",
          "WITH " + EVENT_TEXTS_CTE.strip() + _lexicon_sql_body(NUMBER_LEXICON) + """
, ev_scored AS (
  SELECT r.sentiment_label, r.sentiment_score, r.source, e.ts AS created_at
  FROM result r JOIN events e ON r.post_id = CAST(e.event_id AS VARCHAR) WHERE e.event_type <> 'error'
)
SELECT date_trunc('minute', created_at) AS hour_bucket,
       date_trunc('minute', created_at) + INTERVAL 1 MINUTE AS window_end,
       sentiment_label, count(*) AS count, round(sum(sentiment_score), 6) / count(*) AS avg_sentiment_score, source
FROM ev_scored
GROUP BY 1, 2, 3, source
HAVING date_trunc('minute', created_at) + INTERVAL 1 MINUTE
       <= (SELECT max(ts) FROM events WHERE event_type <> 'error') - INTERVAL 10 MINUTE
""")
def q_stream_minute_counts(spark, sf_dir):
    base, inp, tables, ck = _stream_dirs(spark, "stream-minutes")
    lex = SE.lexicon_frame(spark, NUMBER_LEXICON)
    _messages(spark, sf_dir).write.mode("append").text(inp)
    src = IN.posts_source(spark, "files", inp)
    FL.run_to_end(FL.start_ingest(src, tables, f"{ck}/ingest", lex, tier=1, now=AS_OF, query_name=None))
    gold = f"{tables}/gold_minute_counts"
    FL.run_to_end(FL.start_window_counts(spark, f"{tables}/silver_sentiment", gold, f"{ck}/minutes",
                                         query_name=None))
    g = spark.read.parquet(gold)
    avg = SC.round_binary(F.col("avg_sentiment_score") * F.col("count"), 6) / F.col("count")
    return g.select(F.col("hour_bucket").cast("timestamp_ntz").alias("hour_bucket"),
                    F.col("window_end").cast("timestamp_ntz").alias("window_end"),
                    "sentiment_label", "count", avg.alias("avg_sentiment_score"), "source")
