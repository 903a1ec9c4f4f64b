"""Tagging by a trie of keywords equals tagging by one search per keyword."""

import random

import pytest

from brandpulse.functions.text import trie_pattern
from brandpulse.operators import topics as TP

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("whole_word", [False, True])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_trie_equals_expression(spark, seed, whole_word):
    rnd = random.Random(seed)
    letters = "ab" if seed == 1 else "abé .+*(^-]"
    words = {"".join(rnd.choices(letters, k=rnd.randint(1, 6))) for _ in range(60)} | {"new", "new york", "newt", "york", "日本", "日"}
    vocab = [(f"t{i}", rnd.sample(sorted(words), 5) + ([""] if seed == 3 and i == 4 else [])) for i in range(9)]
    texts = ["".join(rnd.choices(letters + " ", k=rnd.randint(0, 60))) for _ in range(80)]
    texts += [None, "", "New York", "newt york", "a newyork", "日本語", "x 日 本", "new-york new york"]
    df = spark.createDataFrame(list(enumerate(texts)), "post_id int, content string")
    got = [{r.post_id: r.topics for r in TP.tag_topics(df, vocabulary=vocab, whole_word=whole_word, method=m).collect()} for m in ("expr", "trie")]
    assert got[0] == got[1]
    assert any(got[0].values())


def test_pattern_shares_beginnings():
    assert trie_pattern(["over", "overt", "oven"]) == "ove(?:n|r(?:t|))"
    many = trie_pattern([f"{a}{b}{c}" for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh"])
    assert many.count("(?:") == 1 + 8 + 64


def test_trie_explodes_and_shuffles_nothing(spark):
    from brandpulse.plans import catalog
    for name in ("topic_tagging_trie", "topic_tagging_large_vocab", "topic_tagging_trie_whole_word"):
        plan = catalog.REGISTRY[name].run(spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Exchange", "Generate", "Join", "from_json", "EvalPython"))
