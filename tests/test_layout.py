"""Published batches, compaction, the key index, composed jobs, update mode."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from brandpulse.operators import jobs as JB
from brandpulse.operators import quality as QA
from brandpulse.operators import serving as SV
from brandpulse.plans import adapters as AD
from brandpulse.plans import catalog
from brandpulse.plans import q_storage as QS
from brandpulse.session import work_dir
from brandpulse.sources import layout as LY
from brandpulse.sources import maintenance as MT
from brandpulse.sources import tables as TB
from brandpulse.streaming import flows as FL

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_published_folder_is_never_rewritten(spark):
    base = work_dir(spark, "t-publish") + "/t"
    assert LY.publish(spark.range(3), f"{base}/batch_id=1") and not LY.publish(spark.range(9), f"{base}/batch_id=1")
    assert spark.read.parquet(base).count() == 3 and LY.numbered(spark, base, "batch_id") == [1]
    # a write that died leaves nothing that readers see
    with pytest.raises(Exception):
        LY.publish(spark.range(3).select(F.raise_error(F.lit("dead")).cast("string").alias("id")), f"{base}/batch_id=2")
    assert LY.numbered(spark, base, "batch_id") == [1] and spark.read.parquet(base).count() == 3
    assert LY.publish(spark.range(4), f"{base}/batch_id=2") and spark.read.parquet(base).count() == 7


def test_compaction_keeps_rows_readers_and_replays(spark):
    root = work_dir(spark, "t-compact") + "/silver"
    s = AD.sentiment_table(spark, SF)
    parts = [s.where(F.col("post_id").cast("long") % 3 == n) for n in range(3)]
    LY.write_batch(parts[0], root, 0, "created_at")
    LY.write_batch(parts[1], root, 1, "created_at")
    opened = LY.read_live(spark, root, s.schema, "created_at")
    want = parts[0].union(parts[1])
    assert LY.compact(spark, root, s.schema, "created_at") == 1
    live = LY.read_live(spark, root, s.schema, "created_at")
    for df in (opened, live):      # before and after
        assert df.select(*s.columns).exceptAll(want).count() == 0 and df.count() == want.count()
    assert LY.compact(spark, root, s.schema, "created_at") == 1            # nothing new
    assert not LY.write_batch(parts[1], root, 1, "created_at") and LY.committed(spark, root, 0)
    assert LY.write_batch(parts[2], root, 2, "created_at")
    assert LY.read_live(spark, root, s.schema, "created_at").count() == s.count()
    assert LY.compact(spark, root, s.schema, "created_at") == 2
    assert LY.read_live(spark, root, s.schema, "created_at").select(*s.columns).exceptAll(s).count() == 0
    LY.write_batch(parts[0].limit(5), root, 3, "created_at")
    assert LY.compact(spark, root, s.schema, "created_at", whole=True) == 3
    live = LY.read_live(spark, root, s.schema, "created_at")
    assert live.count() == s.count() + 5 and live.select("batch_id").distinct().count() == 4
    old = LY.covered_folders(spark, root)
    assert len(old) == 6 and not any(f.replace("file:", "").split("_days/")[-1] in x for f in old for x in live.inputFiles() if "_days/" in f)


def test_day_partitions_prune_the_overview(spark):
    root = work_dir(spark, "t-prune") + "/silver"
    QS.silver_batches(spark, SF, root)
    s = AD.sentiment_table(spark, SF)
    live = LY.read_live(spark, root, s.schema, "created_at")
    df = SV.sentiment_overview(live, AD.AS_OF, hours=24, time_col="created_at")
    plan = _plan(df)
    scans = [x for x in plan.split("FileScan")[1:]]
    assert len(scans) == 2 and all("created_at_day" in x.split("PartitionFilters: [")[1].split("]")[0] for x in scans)
    assert {r.sentiment_label: r["count"] for r in df.collect()} == {
        r.sentiment_label: r["count"] for r in SV.sentiment_overview(s, AD.AS_OF, hours=24, time_col="created_at").collect()}


def test_index_reads_in_proportion_to_the_batch(spark, monkeypatch):
    monkeypatch.setattr(LY, "SLOT_KEYS", 500)
    root = work_dir(spark, "t-index") + "/keys"

    def keys(a, b):
        return spark.range(a, b).select(F.concat(F.lit("post-"), F.col("id")).alias("post_id"))

    assert LY.known_keys(keys(0, 10), root, 0) is None
    for n in range(6):
        LY.index_keys(keys(n * 4000, (n + 1) * 4000), root, n)
        LY.index_keys(keys(0, 1), root, n)        # replayed: nothing is added
    every = 6 * 8      # buckets
    replay = LY.may_hold(keys(8000, 12_000).toDF("key"), root, 6)
    assert {f"{root}/batch_id=2/keys/bucket={b}" for b in range(8)} <= {f.replace("file:", "file:") for f in replay} or len(
        [f for f in replay if "batch_id=2/" in f]) == 8
    few = LY.may_hold(keys(8000, 8003).toDF("key"), root, 6)
    assert 1 <= len([f for f in few if "batch_id=2/" in f]) <= 3 and len(few) <= 5 < every
    fresh = LY.may_hold(keys(10**6, 10**6 + 3).toDF("key"), root, 6)
    assert len(fresh) <= 3
    known = LY.known_keys(keys(8000, 8003), root, 6)
    assert {r.key for r in known.collect()} >= {"post-8000", "post-8001", "post-8002"}
    assert len(known.inputFiles()) <= 5
    assert LY.known_keys(keys(8000, 8003), root, 2) is None or "post-8000" not in {r.key for r in LY.known_keys(keys(8000, 8003), root, 2).collect()}
    # folded: one generation instead of five batches, the last stays for replays
    assert LY.fold_index(spark, root) == 1 and len(LY._parts(spark, root, 6)) == 2
    both = LY.known_keys(keys(3998, 4002).union(keys(20_000, 20_002)), root, 6)
    assert {r.key for r in both.collect()} >= {"post-3998", "post-4001", "post-20000"}
    assert LY.fold_index(spark, root) == 1


def test_stored_tables_of_one_bucketing_join_without_an_exchange(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    was = spark.conf.get(key)
    spark.conf.set(key, -1)
    try:
        df = catalog.REGISTRY["top_topics_bucketed"].run(spark, SF)
        df.collect()
        plan = _plan(df).split("Initial Plan")[0]
    finally:
        spark.conf.set(key, was)
    below = plan[plan.index("SortMergeJoin"):] if "SortMergeJoin" in plan else plan[plan.index("Join"):]
    assert "Exchange" not in below


def test_jobs_return_what_they_wrote(spark):
    base = work_dir(spark, "t-jobs")
    s, topic = AD.sentiment_table(spark, SF), AD.topic_table(spark, SF)
    one = MT.run_hourly_rollup(spark, s, f"{base}/h", AD.AS_OF, 48)
    assert one.rows == JB.hourly_rollup(s, AD.AS_OF, 48).count() == spark.read.parquet(f"{base}/h").count()
    assert MT.run_hourly_rollup(spark, s, f"{base}/h", AD.AS_OF, 48).rows == one.rows
    assert spark.read.parquet(f"{base}/h").count() == one.rows
    first = MT.run_shift_detection(spark, topic, f"{base}/a", AD.AS_OF, recent=(600, 0), baseline=(1200, 600), threshold=0.0)
    assert first.rows == first.written.count() > 0
    assert MT.run_shift_detection(spark, topic, f"{base}/a", AD.AS_OF, recent=(600, 0), baseline=(1200, 600), threshold=0.0).rows == 0


def test_series_equals_runs_one_after_another(spark):
    topic = AD.topic_table(spark, SF).cache()
    start, options = dt.datetime(2024, 1, 30, 12), {"recent": (120, 0), "baseline": (600, 120), "threshold": 1.0, "cooldown_minutes": 45}
    clocks = [start + dt.timedelta(minutes=20 * k) for k in range(10)]
    alerts, got = None, set()
    for clock in clocks:
        new = JB.detect_shift(topic, clock, alerts=alerts, **options).select("detected_at", "affected_topic").collect()
        got |= {(r.detected_at, r.affected_topic) for r in new}
        alerts = spark.createDataFrame(sorted(got), "detected_at timestamp_ntz, affected_topic string") if got else None
    series = JB.detect_shift_series(topic, start, clocks[-1], step_minutes=20, **options).select("detected_at", "affected_topic")
    assert {(r.detected_at, r.affected_topic) for r in series.collect()} == got and got
    topic.unpersist()


def test_update_mode_survives_a_replayed_batch(spark):
    base = work_dir(spark, "t-update")
    rows = [("2025-01-06 10:00:00", "2025-01-06 10:01:00", "POSITIVE", 2, 0.5, None)]
    df = spark.createDataFrame(rows, "hour_bucket string, window_end string, sentiment_label string, count long, avg_sentiment_score double, source string")
    df = df.withColumns({c: F.col(c).cast("timestamp") for c in ("hour_bucket", "window_end")})
    merge = FL._merge_counts(f"{base}/t")
    for n, times in ((0, 1), (1, 3), (1, 3)):     # the group grows, then its batch is replayed
        merge(df.withColumn("count", F.col("count") * times), n)
    assert [(r["count"], r.source) for r in spark.read.parquet(f"{base}/t").collect()] == [(6, "")]
    merge(df.limit(0), 2)


def test_violations_are_one_scan(spark):
    s = AD.sentiment_table(spark, SF)
    rules = [QA.not_null(c) for c in ("source", "content", "brand")] + [QA.max_length("content", n) for n in (5, 6, 7)] + [QA.in_set("sentiment_label", ["X"])]
    df = QA.violations(s, rules, "post_id")
    assert _plan(df).count("FileScan") == 1 and "Exchange" not in _plan(df)
    assert df.where("rule = 'in_set(sentiment_label)'").count() == s.count()


def test_a_view_slides_by_what_entered_and_left(spark, monkeypatch):
    from brandpulse.sources import views as VW
    root = work_dir(spark, "t-view") + "/v"
    topic = AD.topic_table(spark, SF)
    view = VW.SlidingView("topic", 48)
    clocks = ["2024-01-20 10:20:00", "2024-01-20 10:50:00", "2024-01-20 13:05:00", "2024-01-22 09:00:00", "2024-02-20 00:00:00", "2024-01-21 00:00:00"]
    read, opened = [], None
    real = VW.SlidingView.stored_partials

    def seen(self, s, r, low, high):
        read.append((low, high))
        return real(self, s, r, low, high)

    monkeypatch.setattr(VW.SlidingView, "stored_partials", seen)
    for n, clock in enumerate(clocks, 1):
        read.clear()
        assert view.refresh(topic, root, clock) == n
        want = SV.top_topics_7d_view(topic, clock, days=2, limit=99).collect()
        got = VW.read_view(spark, root).collect()
        cols = ["topic", "mentions", "avg_sentiment", "positive_mentions", "negative_mentions"]
        assert sorted(tuple(r[c] for c in cols) for r in got) == sorted(tuple(r[c] for c in cols) for r in want), clock
        if n == 1:
            opened, first = VW.read_view(spark, root), sorted(map(tuple, got))
        if n in (2, 3):    # none and three hours entered; none and three left
            assert sum(b - a for a, b in read) == {2: 0, 3: 6}[n]
    assert sorted(map(tuple, opened.collect())) == first
    view.refresh(topic.limit(0), root, clocks[-1], rebuild=True)
    assert VW.read_view(spark, root).count() == 0


def _files(root):
    return sorted(os.path.relpath(os.path.join(d, f), root) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet"))


def test_batches_of_a_stream_lie_in_few_files(spark):
    """A stateful stream's batches run without adaptive execution, where Spark drops the rebalance hint."""
    root = work_dir(spark, "t-stream-files")
    rows = spark.range(24_000, numPartitions=8).select(F.concat(F.lit("k"), F.col("id")).alias("key"), F.expr(
        "timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, id % 3)").alias("at"))
    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        LY.index_keys(rows.select("key"), f"{root}/keys", 0)
        known = LY.known_keys(rows.select("key"), f"{root}/keys", 1)
        assert known.count() == known.distinct().count() == 24_000
        LY.write_batch(LY.with_day(rows, "at", 24_000), f"{root}/known", 0, "at")
        LY.write_batch(rows, f"{root}/unknown", 0, "at")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)
    buckets = [f.split("/")[0] for f in _files(f"{root}/keys/batch_id=0/keys")]
    assert len(buckets) == len(set(buckets)) == 16                   # one file to a bucket: 16 filters of 2,500 keys
    assert len(_files(f"{root}/keys/batch_id=0/filters")) > 1        # made where their keys lie, not in one task
    assert len(_files(f"{root}/known")) == 3                         # one file to a day
    days = [f.split("/")[1] for f in _files(f"{root}/unknown")]
    assert len(set(days)) == 3 < len(days) <= 8 + 2                  # a day takes several tasks, a task few days
    for name in ("known", "unknown"):
        assert spark.read.parquet(f"{root}/{name}").select("key").distinct().count() == 24_000
