"""Structured Streaming: the ingest hop and the windowed-count hop.

Hop 1 — ``start_ingest`` (S1 S2 S6 S10 T4 T5 T6 T9-T11, U1 U5 in the batch body):
    source -> decode -> watermark on ingest time -> ``dropDuplicatesWithinWatermark``
    (post ids seen within the horizon are dropped, in the RocksDB state store; malformed
    rows are keyed by their text, so equal ones within the horizon are kept once) ->
    ``foreachBatch``: persist once, then publish quarantine, bronze, its key index, silver.sentiment
    and silver.topic, the last two in day partitions. Every write is one ``batch_id=N`` folder that appears
    whole and is skipped if it is there (:mod:`brandpulse.sources.layout`), so a replayed batch never writes
    twice, and folders stay append-only for the next hop's file source. Errors propagate (Q6):
    a failed batch is retried, never committed half-done.

Hop 2 — ``start_window_counts`` (A8 T1 T2 T3): a file stream over silver.sentiment,
    10-minute watermark on ``created_at``, 1-minute tumbling windows per (label, source),
    append mode: a window is emitted once the watermark passes its end, late rows dropped.

Scoring is done in hop 1's batch body because the per-post aggregate of U1 would be a
stateful streaming aggregate inside a stream; in ``foreachBatch`` it is a batch plan.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from brandpulse import schemas as S
from brandpulse.functions import time as TM
from brandpulse.operators import sentiment as SE
from brandpulse.operators import topics as TP
from brandpulse.session import state_store
from brandpulse.sources import ingest as IN
from brandpulse.sources import layout as LY
from brandpulse.sources import tables as TB

BATCH_COL = LY.BATCH_COL
#: Where the rows of a batch wait between its writes: a batch may be larger than the executors' heaps, which blocks
#: in memory would fill up to the share that Spark grants them, beside the tasks' own buffers.
KEPT = StorageLevel.DISK_ONLY


def with_batch_col(schema: T.StructType, time_col: str | None = None) -> T.StructType:
    day = [T.StructField(LY.day_column(time_col), T.DateType())] if time_col else []
    return T.StructType([*schema.fields, T.StructField(BATCH_COL, T.LongType()), *day])


SENTIMENT_STREAM = with_batch_col(S.SENTIMENT, "created_at")
TOPIC_STREAM = with_batch_col(S.TOPIC, "created_at")


def write_batch_folder(df: DataFrame, root: str, batch_id: int, time_col: str | None = None) -> bool:
    """Publishes ``df`` as ``root/batch_id=N`` unless that batch is committed. Returns whether it
    wrote. Readers see ``batch_id`` (and the day of ``time_col``) as partition columns."""
    return LY.write_batch(df, root, batch_id, time_col)


def window_counts(df: DataFrame, time_col: str = "created_at", width: str = S.STREAM_WINDOW,
                  watermark: str | None = None, label_col: str = "sentiment_label",
                  source_col: str = "source") -> DataFrame:
    """Tumbling-window count and mean score per (window, label, source).
    ``hour_bucket`` is the window start (the original column name). Batch or stream."""
    if watermark is not None:
        df = df.withWatermark(time_col, watermark)
    g = (df.groupBy(F.window(time_col, width).alias("_w"), label_col, source_col)
         .agg(F.count(F.lit(1)).alias("count"), F.avg("sentiment_score").alias("avg_sentiment_score")))
    return g.select(F.col("_w.start").alias("hour_bucket"), F.col("_w.end").alias("window_end"), label_col,
                    "count", "avg_sentiment_score", source_col)


def _fan_out(base: str, lexicon: DataFrame, vocabulary, tier: int, rules, now):
    def run(batch: DataFrame, batch_id: int) -> None:
        b = batch.persist(KEPT)      # one evaluation of the micro-batch feeds every write
        staged = unknown = None
        try:
            if b.isEmpty():          # P12: an empty micro-batch writes nothing
                return
            good, bad = IN.split_quarantine(b)
            # Bronze is the authority on what has been ingested: posts of earlier batches are
            # dropped however long ago they came. Only index folders that may hold them are read.
            known = LY.known_keys(good.select("post_id"), f"{base}/bronze_keys", batch_id)
            if known is not None:
                unknown = good.join(known.select(F.col("key").alias("post_id")), "post_id", "left_anti").persist(KEPT)
            kept = good if unknown is None else unknown
            write_batch_folder(bad.select("raw", "ingested_at"), f"{base}/quarantine", batch_id)
            write_batch_folder(
                kept.select("post_id", "source", "title", "content", "author", "url", "created_at",
                            "ingested_at", F.col("raw").alias("raw_metadata"), "brand"),
                f"{base}/bronze", batch_id)
            LY.index_keys(kept.select("post_id"), f"{base}/bronze_keys", batch_id)
            posts = kept.select("post_id", "content", "source", "brand", "created_at", "ingested_at")
            scored = SE.score_sentiment(posts, lexicon, tier=tier, rules=rules)
            sentiment = scored.select(
                "post_id", "content", "sentiment_label", "sentiment_score", "confidence",
                # the stamp is the batch's own, so a retried batch writes the same rows
                (F.col("ingested_at") if now is None else TM.ts_lit(now)).alias("analyzed_at"), "created_at", "source", "brand")
            # Scored rows are kept once and feed both silver tables; a lost block is
            # recomputed from the persisted batch (deterministic: fixed clock, pure scoring).
            staged = sentiment.persist(KEPT)
            days = LY.with_day(staged, "created_at", kept.count())   # topics stay where their posts lie
            write_batch_folder(days, f"{base}/silver_sentiment", batch_id, "created_at")
            topics = TP.explode_topics(TP.tag_topics(days, vocabulary=vocabulary))
            write_batch_folder(
                topics.select("post_id", "topic", "confidence", "sentiment_score", "analyzed_at",
                              "created_at", "brand", LY.day_column("created_at")),
                f"{base}/silver_topic", batch_id, "created_at")
        finally:
            for d in (staged, unknown):
                if d is not None:
                    d.unpersist()
            b.unpersist()
    return run


def start_ingest(source: DataFrame, base: str, checkpoint: str, lexicon: DataFrame, vocabulary=None,
                 tier: int = 3, rules: SE.Rules | None = None, dedup_horizon: str = "7 days", now=None,
                 query_name: str = "brandpulse_ingest", trigger: dict | None = None) -> StreamingQuery:
    """Start hop 1 on a stream of ``value`` messages (see :func:`brandpulse.sources.ingest.posts_source`).

    ``dedup_horizon`` bounds the state store alone, which keeps repeats out of the batch body;
    what comes again after it is dropped against bronze. Tiers above 1 need ``rules`` with the
    negation and degree words: without them "not good" would score as "good".
    """
    if tier >= 2 and (rules is None or not rules.negations or not rules.degree):
        raise ValueError("tier 2 and 3 need rules with negation and degree words")
    decoded = IN.decode_posts(source, now=now)
    keyed = decoded.withColumn("_key", F.coalesce(F.col("post_id"), F.concat(F.lit("#"), F.sha2("raw", 256))))
    observed = keyed.observe((query_name or "ingest") + "_metrics", F.count(F.lit(1)).alias("rows"),
                             F.count("post_id").alias("valid_rows"))    # T11
    deduped = (observed.withWatermark("ingested_at", dedup_horizon)
               .dropDuplicatesWithinWatermark(["_key"]))               # T4 + T5
    w = deduped.drop("_key").writeStream
    if query_name:
        w = w.queryName(query_name)
    w = (w.option("checkpointLocation", checkpoint)                     # T6: one folder per query
         .foreachBatch(_fan_out(base, lexicon, vocabulary, tier, rules, now)))
    w = w.trigger(**(trigger or {"availableNow": True}))
    with state_store(source.sparkSession):
        return w.start()


def start_window_counts(spark: SparkSession, silver_sentiment: str, out_path: str, checkpoint: str,
                        width: str = S.STREAM_WINDOW, watermark: str = S.STREAM_WATERMARK,
                        query_name: str = "brandpulse_window_counts",
                        trigger: dict | None = None, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start hop 2: windowed counts over the silver sentiment folders, appended to parquet."""
    r = spark.readStream.schema(SENTIMENT_STREAM)
    if max_files_per_trigger is not None:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    src = r.parquet(silver_sentiment)
    agg = window_counts(src, watermark=watermark, width=width)
    w = agg.writeStream
    if query_name:
        w = w.queryName(query_name)
    return (w.format("parquet").option("path", out_path)
            .option("checkpointLocation", checkpoint).outputMode("append")
            .trigger(**(trigger or {"availableNow": True})).start())


MINUTE_KEY = ["hour_bucket", "sentiment_label", "source"]


def _merge_counts(out_path: str):
    """Replaces the groups of a micro-batch in the stored table. An update row holds its group's whole
    aggregate, so merging a replayed batch again changes nothing. A null label or source is stored as the empty text."""
    def run(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumns({k: F.coalesce(k, F.lit("")) for k in MINUTE_KEY[1:]}).withColumn(LY.day_column("hour_bucket"), F.to_date("hour_bucket"))
        b = rows.persist()
        try:
            if not b.isEmpty():
                TB.upsert_table(b.sparkSession, b, out_path, MINUTE_KEY, [LY.day_column("hour_bucket")])
        finally:
            b.unpersist()
    return run


def start_window_counts_update(spark: SparkSession, silver_sentiment: str, out_path: str, checkpoint: str,
                               width: str = S.STREAM_WINDOW, watermark: str = S.STREAM_WATERMARK,
                               query_name: str | None = "brandpulse_window_updates",
                               trigger: dict | None = None, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Hop 2 in update mode: every window that changed is merged into a keyed table at once, so the table
    holds open windows too (T3 emits them only when the watermark has passed them)."""
    r = spark.readStream.schema(SENTIMENT_STREAM)
    if max_files_per_trigger is not None:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    w = window_counts(r.parquet(silver_sentiment), watermark=watermark, width=width).writeStream.outputMode("update")
    if query_name:
        w = w.queryName(query_name)
    return (w.option("checkpointLocation", checkpoint).foreachBatch(_merge_counts(out_path))
            .trigger(**(trigger or {"availableNow": True})).start())


class BatchMetrics(StreamingQueryListener):
    """Keeps the figures that a query observes (``rows``, ``valid_rows``) as a table, one row per
    micro-batch that had input. Rows wait on the driver until :meth:`flush` appends them."""

    SCHEMA = "query string, run_id string, batch_id long, at string, observed string, rows long, valid_rows long"

    def __init__(self, path: str):
        self.path = path
        self.waiting: list[tuple] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        for name, row in (p.observedMetrics or {}).items():
            figures = row.asDict()
            if figures.get("rows"):
                self.waiting.append((p.name, str(p.runId), int(p.batchId), p.timestamp, name, int(figures["rows"]), int(figures.get("valid_rows", 0))))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def flush(self, spark: SparkSession) -> int:
        """Appends what waits, once the listener bus has delivered it."""
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
        rows, self.waiting = self.waiting, []
        if rows:
            spark.createDataFrame(rows, self.SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
        return len(rows)


def start_console(source: DataFrame, rows: int = 5, query_name: str = "brandpulse_console",
                  checkpoint: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """A second, independent query printing decoded posts (5 rows, untruncated)."""
    decoded = IN.decode_posts(source, keep_raw=False)
    w = (decoded.select("post_id", "source", "title", "brand", "created_at", "ingested_at")
         .writeStream.queryName(query_name).format("console")
         .option("truncate", "false").option("numRows", str(rows)))
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def run_to_end(*queries: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait for availableNow queries to finish, then make sure they are stopped."""
    for q in queries:
        q.awaitTermination(timeout_s)
        exc = q.exception()
        if exc is not None:
            raise exc
        q.stop()
