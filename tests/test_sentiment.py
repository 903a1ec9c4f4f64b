"""Lexicon sentiment (U1-U4): hand-computed cases per tier."""

import math

import pytest

from brandpulse.operators import sentiment as SE

LEX = [("good", 1.9), ("bad", -2.5), ("great", 3.1), ("terrible", -2.1)]
RULES = SE.Rules(degree={"very": 0.293, "slightly": -0.293}, negations=("not", "never"))


def _compound(s):
    return round(s / math.sqrt(s * s + 15), 4)


def _score(spark, text, tier):
    df = spark.createDataFrame([("1", text)], "post_id string, content string")
    r = SE.score_sentiment(df, SE.lexicon_frame(spark, LEX), tier=tier, rules=RULES, details=True).first()
    return r


CASES = [
    ("good", 1, 1.9),
    ("good and bad", 1, 1.9 - 2.5),
    ("very good", 2, 1.9 + 0.293),
    ("very nice good", 2, 1.9 + 0.293 * 0.95),
    ("not good", 2, 1.9 * -0.74),
    ("slightly bad", 2, -2.5 + 0.293),           # a dampener moves toward zero
    ("GOOD product", 2, 1.9 + 0.733),            # ALL-CAPS with mixed-case text
    ("GOOD", 2, 1.9),                            # no caps differential when everything is caps
    ("bad but good", 3, -2.5 * 0.5 + 1.9 * 1.5),
    ("good!!", 3, 1.9 + 2 * 0.292),
    ("good!!!!!!", 3, 1.9 + 4 * 0.292),          # at most four exclamation marks count
    ("bad??", 3, -2.5 - 2 * 0.18),
    ("bad????", 3, -2.5 - 0.96),
]


@pytest.mark.parametrize("tier", [1, 2, 3])
def test_compound(spark, tier):
    cases = [(str(i), t, s) for i, (t, tr, s) in enumerate(CASES) if tr == tier]
    df = spark.createDataFrame([(i, t) for i, t, _ in cases], "post_id string, content string")
    got = {r.post_id: r for r in SE.score_sentiment(df, SE.lexicon_frame(spark, LEX), tier=tier, rules=RULES,
                                                    details=True).collect()}
    for i, text, s in cases:
        r = got[i]
        assert r.compound == pytest.approx(_compound(s), abs=1e-9), text
        assert r.sentiment_score == pytest.approx((_compound(s) + 1) / 2), text
        want = "POSITIVE" if _compound(s) >= 0.05 else "NEGATIVE" if _compound(s) <= -0.05 else "NEUTRAL"
        assert r.sentiment_label == want, text


def test_shares_and_confidence(spark):
    r = _score(spark, "good day and bad night", 1)
    pos, neg, neu = 2.9, -3.5, 3
    total = pos + abs(neg) + neu
    assert (r.pos, r.neg, r.neu) == (round(pos / total, 3), round(abs(neg) / total, 3), round(neu / total, 3))
    assert r.confidence == max(r.pos, r.neg, r.neu)


def test_blank_and_tokenless_are_neutral(spark):
    texts = [None, "", "   ", "\t\n", "!!! ???"]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "post_id string, content string")
    out = SE.score_sentiment(df, SE.lexicon_frame(spark, LEX), tier=3, rules=RULES)
    got = sorted((r.post_id, r.sentiment_label, r.sentiment_score, r.confidence) for r in out.collect())
    assert got == [(str(i), "NEUTRAL", 0.5, 0.0) for i in range(len(texts))]


def test_whole_text_is_scored(spark):
    text = ("filler " * 5000) + "terrible"
    assert _score(spark, text, 1).compound == pytest.approx(_compound(-2.1))


def test_other_columns_pass_through(spark):
    df = spark.createDataFrame([("1", "good", "src", None), ("2", "bad", None, "b")],
                               "post_id string, content string, source string, brand string")
    out = SE.score_sentiment(df, SE.lexicon_frame(spark, LEX), tier=1)
    assert out.columns == ["post_id", "content", "source", "brand", "sentiment_label", "sentiment_score", "confidence"]
    rows = {r.post_id: (r.source, r.brand, r.sentiment_label) for r in out.collect()}
    assert rows == {"1": ("src", None, "POSITIVE"), "2": (None, "b", "NEGATIVE")}


def test_large_lexicon_uses_shuffle_join(spark):
    df = spark.createDataFrame([("1", "good")], "post_id string, content string")
    out = SE.score_sentiment(df, SE.lexicon_frame(spark, LEX), tier=1)
    assert out.first().sentiment_label == "POSITIVE"


def test_no_python_in_plan(spark):
    df = spark.createDataFrame([("1", "good")], "post_id string, content string")
    plan = SE.score_sentiment(df, SE.lexicon_frame(spark, LEX), rules=RULES)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


PHRASE_LEX = LEX + [(":)", 2.0), (":-))", 2.4), ("To  die for", 2.9), ("die", -2.9), ("die for", -1.0), ("for good", 1.5)]
PHRASE_CASES = [
    ("it is to die for", 2.9), ("to die,for", -2.9), ("to DIE\n for it", 2.9), ("die for good", -1.0 + 1.9), ("for good", 1.5),
    ("fine:)", 2.0), ("fine :-)) :)", 2.4 + 2.0), (": )", 0.0), ("not to die for", 2.9 * -0.74), ("undie for", 0.0), ("never was a :)", 2.0 * -0.74),
    ("very to die for", 2.9 + 0.293),
]


def test_phrases_are_single_tokens(spark):
    lex = SE.lexicon_frame(spark, PHRASE_LEX)
    phrases = SE.phrase_terms(lex)
    assert phrases == [":)", ":-))", "To  die for", "die for", "for good"]
    df = spark.createDataFrame([(str(i), t) for i, (t, _) in enumerate(PHRASE_CASES)], "post_id string, content string")
    got = {r.post_id: r.compound for r in SE.score_sentiment(df, lex, tier=2, rules=RULES, details=True, phrases=phrases).collect()}
    for i, (text, s) in enumerate(PHRASE_CASES):
        assert got[str(i)] == pytest.approx(_compound(s), abs=1e-9), text


def test_rows_that_repeat_share_their_sums(spark):
    df = spark.createDataFrame([("1", "good"), ("1", "good"), ("1", "bad"), (None, "good day"), (None, "x"), ("2", None)], "post_id string, content string")
    rows = SE.score_sentiment(df, SE.lexicon_frame(spark, LEX), tier=1, details=True).collect()
    assert sorted((r.post_id or "", r.content or "", r.compound, r.neu) for r in rows) == [
        ("", "good day", _compound(1.9), round(1 / 3.9, 3)), ("", "x", 0.0, 1.0), ("1", "bad", _compound(-2.5), 0.0),
        ("1", "good", _compound(1.9), 0.0), ("1", "good", _compound(1.9), 0.0), ("2", "", 0.0, 0.0)]
