"""Structured Streaming: dedup across batches and restarts, late rows, concurrent queries, metrics."""

import json

from pyspark.sql import functions as F

from brandpulse.operators import sentiment as SE
from brandpulse.session import STATE_STORE, state_store, work_dir
from brandpulse.sources import ingest as IN
from brandpulse.streaming import flows as FL

LEX = [("great", 2.0), ("awful", -2.0)]


def _msg(pid, ts, text="great", brand="B"):
    return json.dumps({"post_id": pid, "source": "news", "title": "t", "content": text, "author": "",
                       "url": "u", "created_at": ts, "raw_metadata": {"brand_monitored": brand, "feed_url": "f"}})


def _write(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)


def test_ingest_dedup_restart_and_quarantine(spark):
    base = work_dir(spark, "t-ingest")
    inp, tables, ck = f"{base}/in", f"{base}/tables", f"{base}/ck"
    lex = SE.lexicon_frame(spark, LEX)
    _write(spark, inp, [_msg("p1", "Mon, 06 Jan 2025 10:00:00 GMT"), _msg("p1", "Mon, 06 Jan 2025 10:00:00 GMT"),
                        _msg("p2", "2025-01-06T10:01:00Z", "awful"), "{broken"])
    q = FL.start_ingest(IN.posts_source(spark, "files", inp), tables, ck, lex, tier=1, now="2025-01-06 11:00:00",
                        query_name="t_ingest")
    FL.run_to_end(q)
    progress = [p for p in q.recentProgress if p.get("observedMetrics")]
    assert progress and progress[0]["observedMetrics"]["t_ingest_metrics"]["rows"] == 4      # T11
    # restart on the same checkpoint with a replay and one new post
    _write(spark, inp, [_msg("p1", "Mon, 06 Jan 2025 10:00:00 GMT"), _msg("p3", "Mon, 6 Jan 2025 10:02:00 +0000")])
    FL.run_to_end(FL.start_ingest(IN.posts_source(spark, "files", inp), tables, ck, lex, tier=1, now="2025-01-06 11:00:00",
                                  query_name="t_ingest"))
    s = spark.read.schema(FL.SENTIMENT_STREAM).parquet(f"{tables}/silver_sentiment")
    got = sorted((r.post_id, r.sentiment_label, str(r.created_at)) for r in s.collect())
    assert got == [("p1", "POSITIVE", "2025-01-06 10:00:00"), ("p2", "NEGATIVE", "2025-01-06 10:01:00"),
                   ("p3", "POSITIVE", "2025-01-06 10:02:00")]
    assert spark.read.parquet(f"{tables}/quarantine").count() == 1
    assert spark.read.parquet(f"{tables}/bronze").count() == 3


def test_replayed_batch_is_not_written_twice(spark):
    base = work_dir(spark, "t-batch")
    df = spark.createDataFrame([("a",)], "x string")
    assert FL.write_batch_folder(df, base, 7) is True
    assert FL.write_batch_folder(df, base, 7) is False
    assert spark.read.parquet(base).count() == 1


def test_window_counts_drop_late_rows(spark):
    base = work_dir(spark, "t-window")
    silver, out, ck = f"{base}/silver", f"{base}/out", f"{base}/ck"

    def batch(rows, bid):
        df = spark.createDataFrame(rows, "post_id string, ts string, sentiment_label string, sentiment_score double")
        df = df.select("post_id", F.lit("c").alias("content"), "sentiment_label", "sentiment_score",
                       F.lit(None).cast("double").alias("confidence"), F.lit(None).cast("timestamp").alias("analyzed_at"),
                       F.col("ts").cast("timestamp").alias("created_at"), F.lit("s").alias("source"),
                       F.lit("b").alias("brand"))
        FL.write_batch_folder(df, silver, bid)

    batch([("1", "2025-01-06 10:00:10", "POSITIVE", 0.9), ("2", "2025-01-06 10:00:59", "POSITIVE", 0.7),
           ("3", "2025-01-06 10:01:00", "NEGATIVE", 0.1), ("4", "2025-01-06 10:30:00", "NEUTRAL", 0.5)], 0)
    FL.run_to_end(FL.start_window_counts(spark, silver, out, ck))
    # a row later than the watermark (10:20) for the 10:00 window, and a row that moves time on
    batch([("5", "2025-01-06 10:00:30", "POSITIVE", 0.1), ("6", "2025-01-06 11:00:00", "NEUTRAL", 0.5)], 1)
    FL.run_to_end(FL.start_window_counts(spark, silver, out, ck))
    got = sorted((str(r.hour_bucket), r.sentiment_label, r["count"], r.avg_sentiment_score)
                 for r in spark.read.parquet(out).collect())
    assert got == [("2025-01-06 10:00:00", "POSITIVE", 2, 0.8), ("2025-01-06 10:01:00", "NEGATIVE", 1, 0.1),
                   ("2025-01-06 10:30:00", "NEUTRAL", 1, 0.5)]


def test_console_and_ingest_run_side_by_side(spark):
    base = work_dir(spark, "t-two")
    inp = f"{base}/in"
    _write(spark, inp, [_msg("p9", "2025-01-06T10:00:00Z")])
    q1 = FL.start_console(IN.posts_source(spark, "files", inp), checkpoint=f"{base}/ck_console")
    q2 = FL.start_ingest(IN.posts_source(spark, "files", inp), f"{base}/tables", f"{base}/ck_ingest",
                         SE.lexicon_frame(spark, LEX), tier=1, now="2025-01-06 11:00:00", query_name=None)
    FL.run_to_end(q1, q2)
    assert not q1.isActive and not q2.isActive
    assert spark.read.parquet(f"{base}/tables/silver_sentiment").count() == 1


def test_empty_batch_writes_nothing(spark):
    base = work_dir(spark, "t-empty")
    run = FL._fan_out(base, SE.lexicon_frame(spark, LEX), None, 1, None, "2025-01-06 11:00:00")
    empty = IN.decode_posts(spark.createDataFrame([], "value string"), now="2025-01-06 11:00:00")
    run(empty, 0)
    import os
    assert not os.path.exists(base.replace("file:", "") + "/silver_sentiment")


def test_dedup_state_is_off_the_heap_in_any_session(spark):
    """A session that :func:`get_spark` didn't make names no provider; Spark's own keeps all keys on the heap."""
    base = work_dir(spark, "t-state")
    _write(spark, f"{base}/in", [_msg("p1", "2025-01-06T10:00:00Z"), _msg("p1", "2025-01-06T10:00:00Z")])
    provider = "spark.sql.streaming.stateStore.providerClass"
    was = {k: spark.conf.get(k, None) for k in STATE_STORE}
    try:
        for k in STATE_STORE:
            spark.conf.unset(k)
        q = FL.start_ingest(IN.posts_source(spark, "files", f"{base}/in"), f"{base}/tables", f"{base}/ck",
                            SE.lexicon_frame(spark, LEX), tier=1, now="2025-01-06 11:00:00", query_name=None)
        assert all(spark.conf.get(k, None) is None for k in STATE_STORE)     # the session is as it was
        FL.run_to_end(q)
        # a submitter's own choice holds
        spark.conf.set(provider, "other")
        with state_store(spark):
            assert spark.conf.get(provider) == "other"
        assert spark.conf.get(provider) == "other"
    finally:
        for k, v in was.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    state = q.recentProgress[0]["stateOperators"][0]
    assert state["numRowsTotal"] == 1 and any(m.startswith("rocksdb") for m in state["customMetrics"])
    assert spark.read.parquet(f"{base}/tables/bronze").count() == 1


def test_rows_of_a_batch_wait_on_disk(spark, monkeypatch):
    base = work_dir(spark, "t-kept")
    sc = spark.sparkContext._jsc.sc()
    others = {i.id() for i in sc.getRDDStorageInfo()}
    seen, real = [], FL.write_batch_folder

    def write(df, root, *a):
        done = real(df, root, *a)
        seen.append([(i.memSize(), i.diskSize()) for i in sc.getRDDStorageInfo() if i.id() not in others])
        return done

    monkeypatch.setattr(FL, "write_batch_folder", write)
    run = FL._fan_out(f"{base}/tables", SE.lexicon_frame(spark, LEX), None, 1, None, "2025-01-06 11:00:00")
    for batch_id, ids in enumerate((("p1", "p2"), ("p2", "p3"))):      # p2 is known to bronze the second time
        rows = spark.createDataFrame([(_msg(p, "2025-01-06T10:00:00Z"),) for p in ids], "value string")
        run(IN.decode_posts(rows, now="2025-01-06 11:00:00"), batch_id)
    assert len(seen) == 8 and all(kept and all(mem == 0 < disk for mem, disk in kept) for kept in seen)
    assert max(map(len, seen[:4])) == 2      # what bronze has nothing of isn't kept a second time
    assert sorted(r.post_id for r in spark.read.parquet(f"{base}/tables/bronze").collect()) == ["p1", "p2", "p3"]
