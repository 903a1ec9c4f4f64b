"""Sources: message-bus / file readers, message decoding, feed-entry normalisation.

* S1 / T7 / T8: ``posts_source`` reads a Kafka topic (or, where no connector is on the
  classpath, a folder of JSON-lines files) as a stream of ``value`` strings.
* S2 / P1 / P2 / P3 / F1 / F20: ``decode_posts`` parses the fixed message schema; bad
  JSON gives a row of NULLs, which ``split_quarantine`` routes away from the tables.
* S3 / W4 / F16 / F17: ``normalize_feed`` turns feed entries into post messages with the
  poller's fallback rules, keeping the first ``FEED_ENTRIES_KEPT`` entries per feed.
* S4: ``to_messages`` + ``kafka_sink_options`` write rows back as JSON messages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brandpulse import schemas as S
from brandpulse.functions import time as TM


# ------------------------------------------------------------------------------ S1 T7 T8
def kafka_source_options(bootstrap: str, topic: str, starting_offsets: str = "latest",
                         max_offsets_per_trigger: int | None = None, fail_on_data_loss: bool = True,
                         extra: dict | None = None) -> dict[str, str]:
    """Options for ``readStream.format("kafka")``. The rate cap is ``maxOffsetsPerTrigger``
    (the DStream-era per-partition rate key has no effect on Structured Streaming)."""
    o = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic, "startingOffsets": starting_offsets,
         "failOnDataLoss": str(fail_on_data_loss).lower()}
    if max_offsets_per_trigger is not None:
        o["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    o.update(extra or {})
    return o


def kafka_sink_options(bootstrap: str, topic: str, acks: str = "all", retries: int = 3,
                       extra: dict | None = None) -> dict[str, str]:
    """Options for ``write(Stream).format("kafka")``: acks=all and retries, as the producer."""
    o = {"kafka.bootstrap.servers": bootstrap, "topic": topic, "kafka.acks": acks, "kafka.retries": str(retries)}
    o.update(extra or {})
    return o


def posts_source(spark: SparkSession, kind: str = "kafka", path: str | None = None,
                 options: dict[str, str] | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame with one string column ``value`` per message.

    ``kind="kafka"`` needs the Kafka connector on the classpath; ``kind="files"`` reads
    JSON-lines files dropped into ``path`` (one message per line).
    """
    if kind == "kafka":
        r = spark.readStream.format("kafka").options(**(options or {}))
        return r.load().select(F.col("value").cast("string").alias("value"))
    if kind == "files":
        r = spark.readStream.format("text")
        if max_files_per_trigger is not None:
            r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
        return r.load(path).select(F.col("value"))
    raise ValueError(f"unknown source kind {kind!r}")


# ------------------------------------------------------------------------------ S2 P1-P3 F1
def decode_posts(df: DataFrame, value_col: str = "value", now=None, keep_raw: bool = True) -> DataFrame:
    """Decode JSON messages to post columns (unknown keys dropped, malformed -> NULLs).

    ``created_at`` is parsed totally (F1/Q1 fix), ``ingested_at`` is ``now`` (or the
    processing clock), ``brand`` comes from ``raw_metadata.brand_monitored`` (P2).
    ``raw`` keeps the message text for the bronze table (Q20).
    """
    text = F.col(value_col).cast("string")
    data = F.from_json(text, S.POST_MESSAGE, {"mode": "PERMISSIVE"})
    clock = F.current_timestamp() if now is None else TM.ts_lit(now)
    cols = [
        F.col("_m.post_id").alias("post_id"), F.col("_m.source").alias("source"),
        F.col("_m.title").alias("title"), F.col("_m.content").alias("content"),
        F.col("_m.author").alias("author"), F.col("_m.url").alias("url"),
        TM.parse_event_time(F.col("_m.created_at")).alias("created_at"),
        F.col("_m.created_at").alias("created_at_text"),
        clock.alias("ingested_at"),
        F.col("_m.raw_metadata.brand_monitored").alias("brand"),
    ]
    if keep_raw:
        cols.append(text.alias("raw"))
    return df.select(data.alias("_m"), *([F.col(value_col)] if keep_raw else [])).select(*cols)


def split_quarantine(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows (a post_id is present) and quarantined rows (malformed / missing id)."""
    ok = F.col("post_id").isNotNull()
    return decoded.filter(ok), decoded.filter(~ok)


# ------------------------------------------------------------------------------ S4 F20
def to_messages(df: DataFrame, key_col: str | None = "post_id") -> DataFrame:
    """Rows -> (key, value) JSON messages for a Kafka / file sink."""
    cols = [F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value")]
    if key_col:
        cols.insert(0, F.col(key_col).cast("string").alias("key"))
    return df.select(*cols)


# ------------------------------------------------------------------------------ S3 W4 F16 F17
def brand_from_feed_url(url: Column) -> Column:
    """F16: text between the first ``q=`` and the next ``&`` (empty when absent)."""
    return F.split_part(F.split_part(url, F.lit("q="), F.lit(2)), F.lit("&"), F.lit(1))


def normalize_feed(entries: DataFrame, now=None, keep: int = S.FEED_ENTRIES_KEPT,
                   poll_cols: tuple[str, ...] = ()) -> DataFrame:
    """S3: feed entries (``schemas.FEED_ENTRY``) -> post messages.

    W4 keeps the first ``keep`` entries of each poll of a feed by ``position``; ``poll_cols``
    name what tells polls apart in a table of many (without them the entries are one poll). It is
    planned as a group limit, applied inside each task before the shuffle, so a feed with
    very many entries never sends more than ``keep`` rows per task.
    F17: a key that is *present* wins even when it is an empty string; only missing
    (NULL) keys fall back.
    """
    w = Window.partitionBy("feed_url", *poll_cols).orderBy(F.col("position").asc_nulls_last(), F.col("link"))
    first = entries.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= keep).drop("_rn")
    clock = F.current_timestamp() if now is None else TM.ts_lit(now)
    feed_title = F.col("feed_title")
    return first.select(
        F.coalesce(F.col("id"), F.col("link")).alias("post_id"),
        F.element_at(F.split(F.coalesce(feed_title, F.lit(S.DEFAULT_FEED_SOURCE)), " - "), -1).alias("source"),
        F.coalesce(F.col("title"), F.lit("")).alias("title"),
        F.coalesce(F.col("summary"), F.col("description"), F.lit("")).alias("content"),
        F.coalesce(F.col("author"), F.col("feed_author"), F.lit("")).alias("author"),
        F.coalesce(F.col("link"), F.lit("")).alias("url"),
        F.coalesce(F.col("published"), F.col("updated"), F.lit("")).alias("created_at"),
        clock.alias("ingested_at"),
        F.struct(F.col("feed_url"), F.coalesce(feed_title, F.lit("")).alias("feed_title"),
                 brand_from_feed_url(F.col("feed_url")).alias("brand_monitored")).alias("raw_metadata"),
    )


def write_kafka(df: DataFrame, options: dict[str, str], key_col: str | None = "post_id") -> None:
    """S4 (batch): send rows as JSON messages (``kafka_sink_options`` gives acks / retries)."""
    to_messages(df, key_col).write.format("kafka").options(**options).save()


def start_kafka_sink(df: DataFrame, options: dict[str, str], checkpoint: str, key_col: str | None = "post_id",
                     trigger: dict | None = None):
    """S4 (stream): continuously send a streaming DataFrame's rows as JSON messages."""
    w = (to_messages(df, key_col).writeStream.format("kafka").options(**options)
         .option("checkpointLocation", checkpoint))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
