"""Physical-plan checks: pushdown, top-k, group limit, no Python in the hot path, shuffles."""

import pytest

from brandpulse.operators import jobs as JB
from brandpulse.operators import sentiment as SE
from brandpulse.operators import serving as SV
from brandpulse.operators import topics as TP
from brandpulse.plans import adapters as AD
from brandpulse.plans import catalog

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_time_filter_reaches_the_scan(spark):
    s = AD.sentiment_table(spark, SF)
    plan = _plan(SV.sentiment_last24h_view(s, AD.AS_OF))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,value:double>" in plan       # column pruning


def test_band_filter_reaches_the_scan(spark):
    t = AD.topic_table(spark, SF)
    plan = _plan(JB.detect_shift(t, AD.AS_OF))
    assert "GreaterThanOrEqual(ts," in plan and "LessThan(ts," in plan


def test_top_k_is_take_ordered(spark):
    plan = _plan(SV.top_topics_7d_view(AD.topic_table(spark, SF), AD.AS_OF))
    assert "TakeOrderedAndProject" in plan


def test_latest_per_post_is_group_limited(spark):
    df = SV.latest_per_post(AD.reanalyzed_sentiment_table(spark, SF))
    df._jdf.queryExecution().executedPlan()        # force planning
    assert "WindowGroupLimit" in df._jdf.queryExecution().sparkPlan().toString()


def test_shift_is_one_aggregation_no_join(spark):
    plan = _plan(JB.detect_shift(AD.topic_table(spark, SF), AD.AS_OF))
    assert "Join" not in plan


def test_top_topics_reduces_sentiment_side_before_join(spark):
    df = SV.top_topics(AD.topic_table(spark, SF), AD.reanalyzed_sentiment_table(spark, SF), AD.AS_OF, hours=168)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.rindex("Aggregate")


@pytest.mark.parametrize("name", ["sentiment_overview", "top_topics", "sentiment_shift", "lexicon_sentiment",
                                  "topic_tagging", "negative_mentions", "hourly_rollup"])
def test_no_python_udf_in_hot_path(spark, name):
    plan = _plan(catalog.REGISTRY[name].run(spark, SF))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_lexicon_scoring_sums_numbers_by_hash(spark):
    plan = _plan(catalog.REGISTRY["lexicon_sentiment"].run(spark, SF))
    assert "SortAggregate" not in plan
    # what is exploded to tokens carries no text
    tokens = [x for x in plan.splitlines() if "Generate explode" in x]
    assert tokens and not any("content" in x.split("Generate")[1].split("],")[0] for x in tokens)


def test_backfill_range_reaches_the_scan(spark):
    topic = AD.topic_table(spark, SF)
    plan = _plan(JB.detect_shift_series(topic, "2024-01-10 00:00:00", "2024-01-12 00:00:00"))
    assert "GreaterThanOrEqual(ts,2024-01-09T22:00)" in plan and "LessThan(ts," in plan


def test_building_a_batch_query_starts_no_job(spark):
    texts, topic, sentiment = AD.texts_table(spark, SF), AD.topic_table(spark, SF), AD.sentiment_table(spark, SF)
    lex = SE.lexicon_frame(spark, [("the", 1.0)])
    spark.sparkContext.setJobGroup("build-only", "no job may start")
    SE.score_sentiment(texts, lex)
    TP.tag_topics(texts)
    TP.tag_topics(texts, method="trie")
    JB.detect_shift_series(topic, "2024-01-10 00:00:00", "2024-01-12 00:00:00")
    SV.top_topics(topic, sentiment, AD.AS_OF)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("build-only")
    spark.sparkContext.setJobGroup("tests", "tests")


def test_topic_explode_evaluates_tagging_once(spark):
    # no filter inferred from the explode may carry a second copy of the tagging expression
    plan = catalog.REGISTRY["topic_tagging_explode_counts"].run(spark, SF)._jdf.queryExecution().optimizedPlan()
    filters = [l for l in plan.toString().splitlines() if "Filter" in l]
    assert not any("Contains" in l for l in filters)


@pytest.mark.parametrize("name", ["lexicon_sentiment", "lexicon_sentiment_rules", "lexicon_sentiment_phrases", "label_distribution_by_lang"])
def test_tokens_meet_the_lexicon_without_a_shuffle(spark, name):
    df = catalog.REGISTRY[name].run(spark, SF)
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    plan = _plan(df)
    final = plan.split("Initial Plan")[0]
    exchanges = [x for x in final.splitlines() if "Exchange hashpartitioning" in x]
    assert exchanges and not any("term" in x for x in exchanges)
    # and what is joined back is narrow
    assert not any("content" in x for x in final.splitlines() if "Exchange" in x)
    assert "BroadcastHashJoin" in final


def test_a_large_lexicon_is_shuffled(spark):
    texts = AD.texts_table(spark, SF)
    lex = SE.lexicon_frame(spark, [("the", 1.0)])
    key = "spark.sql.autoBroadcastJoinThreshold"
    was = spark.conf.get(key)
    spark.conf.set(key, -1)
    try:
        plan = _plan(SE.score_sentiment(texts, lex, tier=1))
    finally:
        spark.conf.set(key, was)
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
