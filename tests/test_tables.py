"""Table writers: insert-if-absent, upsert (DataFrame and on disk), quality report, options."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brandpulse.operators import quality as QA
from brandpulse.session import work_dir
from brandpulse.sources import ingest as IN
from brandpulse.sources import tables as TB

KEYS = ["k1", "k2"]


def _df(spark, rows):
    return spark.createDataFrame(rows, "k1 string, k2 int, v double")


def _key(r):
    return tuple((x is None, "" if x is None else x) for x in r)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=_key)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 3), st.floats(0, 1)), max_size=8),
       st.lists(st.tuples(st.sampled_from(["a", "c"]), st.integers(0, 3), st.floats(0, 1)), max_size=8,
                unique_by=lambda r: (r[0], r[1])))
def test_merge_upsert_semantics(spark, target, new):
    out = _rows(TB.merge_upsert(_df(spark, target), _df(spark, new), KEYS))
    new_keys = {(k1, k2) for k1, k2, _ in new}
    expect = sorted([r for r in target if (r[0], r[1]) not in new_keys or r[0] is None] + list(new), key=_key)
    assert out == expect
    # idempotent: applying the same batch again changes nothing
    again = _rows(TB.merge_upsert(TB.merge_upsert(_df(spark, target), _df(spark, new), KEYS), _df(spark, new), KEYS))
    assert again == out


def test_null_keys_never_conflict(spark):
    target = _df(spark, [(None, 1, 0.1)])
    new = _df(spark, [(None, 1, 0.1), (None, 1, 0.2), ("a", 1, 0.3)])
    assert len(_rows(TB.append_new(new, target, KEYS))) == 3


def test_upsert_keeps_padded_string_partitions(spark):
    path = work_dir(spark, "test-padded") + "/t"
    TB.upsert_table(spark, _df(spark, [("007", 1, 0.1), ("010", 1, 0.2)]), path, KEYS, ["k1"])
    TB.upsert_table(spark, _df(spark, [("007", 1, 0.9)]), path, KEYS, ["k1"])
    got = _rows(TB.read_table(spark, path, "k1 string, k2 int, v double").select("k1", "k2", "v"))
    assert got == [("007", 1, 0.9), ("010", 1, 0.2)]


def test_upsert_rejects_a_repeated_key(spark):
    path = work_dir(spark, "test-repeat") + "/t"
    with pytest.raises(Exception, match="two rows of one key"):
        TB.upsert_table(spark, _df(spark, [("a", 1, 0.1), ("a", 1, 0.2)]), path, KEYS, ["k1"])


def test_an_unreadable_table_is_not_taken_for_an_absent_one(spark):
    base = work_dir(spark, "test-odd")
    spark.createDataFrame([("x",)], "s string").write.text(f"{base}/t")
    with pytest.raises(Exception):
        TB.upsert_table(spark, _df(spark, [("a", 1, 0.1)]), f"{base}/t", KEYS, ["k1"])
    assert spark.read.text(f"{base}/t").count() == 1


def test_append_new_keeps_one_row_per_new_key(spark):
    target = _df(spark, [("a", 1, 0.1)])
    new = _df(spark, [("a", 1, 0.9), ("b", 2, 0.5), ("b", 2, 0.2), ("c", 3, None)])
    assert _rows(TB.append_new(new, target, KEYS)) == [("b", 2, 0.2), ("c", 3, None)]
    assert len(_rows(TB.insert_if_absent(new, target, KEYS))) == 3


def test_upsert_table_on_disk(spark):
    path = work_dir(spark, "test-upsert") + "/t"
    first = _df(spark, [("a", 1, 0.1), ("a", 2, 0.2), ("b", 1, 0.3)])
    TB.upsert_table(spark, first, path, KEYS, ["k1"])
    TB.upsert_table(spark, _df(spark, [("a", 2, 0.9), ("c", 1, 1.0)]), path, KEYS, ["k1"])
    TB.upsert_table(spark, _df(spark, [("a", 2, 0.9), ("c", 1, 1.0)]), path, KEYS, ["k1"])   # replay
    got = sorted((r.k1, r.k2, r.v) for r in spark.read.parquet(path).collect())
    assert got == [("a", 1, 0.1), ("a", 2, 0.9), ("b", 1, 0.3), ("c", 1, 1.0)]


def test_append_if_absent_on_disk(spark):
    path = work_dir(spark, "test-append") + "/t"
    TB.append_if_absent(spark, _df(spark, [("a", 1, 0.1)]), path, KEYS)
    TB.append_if_absent(spark, _df(spark, [("a", 1, 0.5), ("b", 1, 0.2)]), path, KEYS)
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [("a", 1, 0.1), ("b", 1, 0.2)]


def test_append_if_absent_returns_the_appended_rows(spark):
    path = work_dir(spark, "test-append-ret") + "/t"
    TB.append_if_absent(spark, _df(spark, [("a", 1, 0.1), ("b", 1, 0.3)]), path, KEYS, ["k1"])
    got = TB.append_if_absent(spark, _df(spark, [("a", 1, 0.5), ("c", 2, 0.2)]), path, KEYS, ["k1"])
    assert _rows(got.select("k1", "k2", "v")) == [("c", 2, 0.2)]
    stored = sorted((r.k1, r.k2, r.v) for r in spark.read.parquet(path).collect())
    assert stored == [("a", 1, 0.1), ("b", 1, 0.3), ("c", 2, 0.2)]


def test_constraint_report(spark):
    df = spark.createDataFrame([("p1", "x" * 60, "POSITIVE"), ("p1", None, "MAYBE"), ("p2", "ok", None)],
                               "post_id string, source string, sentiment_label string")
    parents = spark.createDataFrame([("p1",)], "post_id string")
    rep = {(r.rule, r.column_name): r.violations for r in QA.constraint_report(df, [
        QA.not_null("source"), QA.max_length("source", 50), QA.in_set("sentiment_label", ["POSITIVE"]),
        QA.unique("post_id"), QA.foreign_key("post_id", parents)]).collect()}
    assert rep == {("not_null", "source"): 1, ("max_length", "source"): 1, ("in_set", "sentiment_label"): 1,
                   ("unique", "post_id"): 1, ("foreign_key", "post_id"): 1}


def test_defaults_fill_nulls(spark):
    df = spark.createDataFrame([(None,), (True,)], "acknowledged boolean")
    got = [r.acknowledged for r in QA.apply_defaults(df, {"acknowledged": F.lit(False)}).collect()]
    assert got == [False, True]


def test_connector_options():
    k = IN.kafka_source_options("h:9092", "posts", max_offsets_per_trigger=100000)
    assert k["subscribe"] == "posts" and k["startingOffsets"] == "latest" and k["maxOffsetsPerTrigger"] == "100000"
    s = IN.kafka_sink_options("h:9092", "posts")
    assert s["kafka.acks"] == "all" and s["kafka.retries"] == "3"
    j = TB.jdbc_options("jdbc:postgresql://h/db", "processed.sentiment", user="u", password="p", num_partitions=8)
    assert j["dbtable"] == "processed.sentiment" and j["numPartitions"] == "8"


def test_normalize_feed_fallbacks(spark):
    rows = [("http://n?q=Nike&hl=en", "Nike - Google News", "fa", i, None if i == 0 else f"id{i}", f"http://x/{i}",
             "T", "" if i == 1 else None, "d", None, None, "2025-01-06T10:00:00Z") for i in range(12)]
    from brandpulse import schemas as S
    out = IN.normalize_feed(spark.createDataFrame(rows, S.FEED_ENTRY), now="2025-01-06 11:00:00")
    got = {r.post_id: r for r in out.collect()}
    assert len(got) == 10                                        # W4: first 10 per feed
    assert "http://x/0" in got                                   # id missing -> link
    assert got["id1"].content == ""                              # present empty summary wins
    assert got["id2"].content == "d"                             # missing summary -> description
    assert got["id2"].author == "fa" and got["id2"].source == "Google News"
    assert got["id2"].raw_metadata.brand_monitored == "Nike"
    assert got["id2"].created_at == "2025-01-06T10:00:00Z"


def test_decode_quarantines_malformed(spark):
    msgs = spark.createDataFrame([('{"post_id":"p1","content":"x","raw_metadata":{"brand_monitored":"B"},"extra":1}',),
                                  ("{not json",), ('{"content":"no id"}',)], "value string")
    good, bad = IN.split_quarantine(IN.decode_posts(msgs, now="2025-01-06 10:00:00"))
    assert [(r.post_id, r.brand) for r in good.collect()] == [("p1", "B")]
    assert bad.count() == 2


class _StubContext:
    def __init__(self, master="local[4]"):
        self.dir, self.master = None, master

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = f"file:{d}/ctx"


class _StubConf:
    def get(self, key, default=None):
        return default

    def set(self, key, value):   # the real session refuses: a core setting
        raise AssertionError("spark.checkpoint.dir cannot be changed at run time")


class _StubSession:
    def __init__(self):
        self.conf = _StubConf()
        self.sparkContext = _StubContext()


def test_scratch_root_when_checkpoint_dir_unset():
    from brandpulse.session import checkpoint_root
    s = _StubSession()
    first = checkpoint_root(s)
    assert s.sparkContext.dir is not None and s.sparkContext.dir.startswith(f"file:{first}")
    assert checkpoint_root(s) == s.sparkContext.dir       # later calls reuse the context's folder


def test_a_cluster_without_checkpoint_dir_is_an_error():
    from brandpulse.session import checkpoint_root
    for master in ("spark://host:7077", "local-cluster[2,1,1024]", "yarn"):
        s = _StubSession()
        s.sparkContext = _StubContext(master)
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            checkpoint_root(s)


def test_upsert_table_keeps_rows_of_a_null_partition(spark):
    path = work_dir(spark, "test-upsert-null") + "/t"
    TB.upsert_table(spark, _df(spark, [(None, 1, 0.1), ("a", 1, 0.2)]), path, KEYS, ["k1"])
    TB.upsert_table(spark, _df(spark, [(None, 1, 0.5), ("a", 1, 0.7)]), path, KEYS, ["k1"])
    got = sorted(((r.k1 or ""), r.k2, r.v) for r in spark.read.parquet(path).collect())
    # NULL keys never conflict: both NULL-partition rows stay; ("a", 1) is replaced
    assert got == [("", 1, 0.1), ("", 1, 0.5), ("a", 1, 0.7)]


def test_upsert_table_prunes_the_target_scan(spark):
    path = work_dir(spark, "test-upsert-prune") + "/t"
    TB.upsert_table(spark, _df(spark, [("a", 1, 0.1), ("b", 1, 0.2), ("c", 1, 0.3)]), path, KEYS, ["k1"])
    TB.upsert_table(spark, _df(spark, [("b", 1, 0.9)]), path, KEYS, ["k1"])
    got = sorted((r.k1, r.k2, r.v) for r in spark.read.parquet(path).collect())
    assert got == [("a", 1, 0.1), ("b", 1, 0.9), ("c", 1, 0.3)]
