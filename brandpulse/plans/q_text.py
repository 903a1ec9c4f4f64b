"""Registered text-analytics queries over ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from brandpulse import schemas as S
from brandpulse.functions import scoring as SC
from brandpulse.functions.text import TOKEN_SPLIT, whole_word_pattern
from brandpulse.operators import sentiment as SE
from brandpulse.operators import topics as TP
from brandpulse.plans import adapters as AD
from brandpulse.plans.oracle import TEXTS_CTE, with_
from brandpulse.plans.registry import register

# Fixed test parameters: a lexicon and a topic vocabulary of words that occur in the
# invented multilingual prose (the production vocabulary matches almost nothing there).
TEST_LEXICON = [
    ("the", 0.4), ("and", 0.9), ("und", 1.2), ("la", 0.6), ("que", 1.5), ("pour", 2.0),
    ("y", 0.8), ("of", -0.7), ("der", -1.1), ("de", -0.3), ("les", -1.4), ("was", -1.9),
    ("to", -0.2), ("it", -0.5), ("sich", -2.2),
]
TEST_VOCABULARY = [
    ("Connectors", ["and ", " und ", " et ", " y "]),
    ("Relatives", ["that", "que", "dass"]),
    ("Shouting", ["!!"]),
    ("Endings", ["tion the", "ononst", "rewh", "hehely"]),
    ("Articles", ["THE", "DER"]),
]


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _lexicon_values_sql(rows) -> str:
    return "lex(term, valence) AS (VALUES " + ", ".join(f"({_sql_str(t)}, {float(v)!r}e0)".replace(".0e0", ".0e0")
                                                        for t, v in rows) + ")"


def _lexicon_sql_body(rows) -> str:
    return f"""
, {_lexicon_values_sql(rows)},
lexg AS (SELECT lower(term) AS term, avg(valence) AS valence FROM lex GROUP BY 1),
toks AS (
  SELECT post_id, unnest(regexp_split_to_array(coalesce(content, ''), {_sql_str(TOKEN_SPLIT)})) AS tok FROM texts
),
tv AS (
  SELECT t.post_id, coalesce(l.valence, 0.0) AS v
  FROM toks t LEFT JOIN lexg l ON lower(t.tok) = l.term
  WHERE t.tok <> ''
),
agg AS (
  SELECT post_id, round(sum(v), 6) + 0.0 AS s, round(sum(CASE WHEN v > 0 THEN v + 1 ELSE 0 END), 6) + 0.0 AS pos_sum,
         round(sum(CASE WHEN v < 0 THEN v - 1 ELSE 0 END), 6) + 0.0 AS neg_sum,
         count(*) FILTER (WHERE v = 0) AS neu_n
  FROM tv GROUP BY post_id
),
sc AS (
  SELECT post_id, round(s / sqrt(s * s + 15), 4) + 0.0 AS compound,
         coalesce(round(abs(pos_sum / nullif(pos_sum + abs(neg_sum) + neu_n, 0)), 3) + 0.0, 0.0) AS pos,
         coalesce(round(abs(neu_n / nullif(pos_sum + abs(neg_sum) + neu_n, 0)), 3) + 0.0, 0.0) AS neu,
         coalesce(round(abs(neg_sum / nullif(pos_sum + abs(neg_sum) + neu_n, 0)), 3) + 0.0, 0.0) AS neg
  FROM agg
),
scored AS (
  SELECT x.post_id, x.brand, x.source,
         coalesce(trim(x.content), '') = '' AS blank, coalesce(sc.compound, 0.0) AS c,
         coalesce(sc.pos, 0.0) AS pos, coalesce(sc.neu, 0.0) AS neu, coalesce(sc.neg, 0.0) AS neg
  FROM texts x LEFT JOIN sc ON x.post_id = sc.post_id
),
result AS (
  SELECT post_id, brand, source,
         CASE WHEN blank THEN 'NEUTRAL' WHEN c >= 0.05 THEN 'POSITIVE' WHEN c <= -0.05 THEN 'NEGATIVE'
              ELSE 'NEUTRAL' END AS sentiment_label,
         CASE WHEN blank THEN 0.5 ELSE (c + 1.0) / 2.0 END AS sentiment_score,
         CASE WHEN blank THEN 0.0 ELSE greatest(pos, neu, neg) END AS confidence,
         CASE WHEN blank THEN 0.0 ELSE c END AS compound,
         CASE WHEN blank THEN 0.0 ELSE pos END AS pos,
         CASE WHEN blank THEN 0.0 ELSE neu END AS neu,
         CASE WHEN blank THEN 0.0 ELSE neg END AS neg
  FROM scored
)"""


def _scored_texts(spark, sf_dir, tier=1):
    texts = AD.texts_table(spark, sf_dir)
    lex = SE.lexicon_frame(spark, TEST_LEXICON)
    return SE.score_sentiment(texts, lex, tier=tier, details=True)


@register("lexicon_sentiment", "U1 U2 U3 U4 F8 F12 F13 J6", with_(TEXTS_CTE) + _lexicon_sql_body(TEST_LEXICON) + """
SELECT post_id, brand, sentiment_label, sentiment_score, confidence, compound, pos, neu, neg FROM result
""")
def q_lexicon_sentiment(spark, sf_dir):
    return _scored_texts(spark, sf_dir).select(
        "post_id", "brand", "sentiment_label", "sentiment_score", "confidence", "compound", "pos", "neu", "neg")


@register("label_distribution_by_lang", "U1 A4", with_(TEXTS_CTE) + _lexicon_sql_body(TEST_LEXICON) + """
SELECT brand AS lang, sentiment_label, count(*) AS count, round(sum(sentiment_score), 6) / count(*) AS avg_score
FROM result GROUP BY 1, 2
""")
def q_label_distribution_by_lang(spark, sf_dir):
    return (_scored_texts(spark, sf_dir)
            .groupBy(F.col("brand").alias("lang"), "sentiment_label")
            .agg(F.count(F.lit(1)).alias("count"),
                 (SC.round_binary(F.sum("sentiment_score"), 6) / F.count(F.lit(1))).alias("avg_score")))


# Test modifier words that occur in the prose, so every rule fires on real text.
TEST_RULES = SE.Rules(degree={"is": 0.293, "in": 0.293, "die": 0.293, "le": -0.293, "en": -0.293},
                      negations=("a", "zu", "el", "un"), but_word="for")


_WORD_TOKENS_SQL = f"""
tk AS (
  SELECT post_id, coalesce(content, '') AS c,
         list_filter(regexp_split_to_array(coalesce(content, ''), {_sql_str(TOKEN_SPLIT)}), lambda t: t <> '') AS toks
  FROM texts
),"""


def _phrase_tokens_sql(phrases) -> str:
    """Tokens with phrases, from pieces (a word or one other character, with the white space before it): matches
    are runs of pieces, and a fold over a text's matches keeps those that begin behind the last one kept."""
    values = ", ".join(f"({_sql_str(p)})" for p in phrases)
    return rf"""
ph(term) AS (VALUES {values}),
phk AS (SELECT term, len(regexp_extract_all(term, '[ \t\r\n\f]*(?:[\p{{L}}\p{{N}}'']+|[^\p{{L}}\p{{N}}'' \t\r\n\f])')) AS k FROM ph),
pcs AS (SELECT post_id, coalesce(content, '') AS c,
               regexp_extract_all(coalesce(content, ''), '[ \t\r\n\f]*(?:[\p{{L}}\p{{N}}'']+|[^\p{{L}}\p{{N}}'' \t\r\n\f])') AS raw FROM texts),
pcn AS (SELECT post_id, c, list_transform(raw, lambda x: regexp_replace(x, '^[ \t\r\n\f]+', ' ')) AS p FROM pcs),
pos AS (SELECT post_id, unnest(generate_series(1, len(p))) AS i, p FROM pcn),
hit AS (SELECT post_id, i, max(phk.k) AS k FROM pos, phk
        WHERE lower(ltrim(array_to_string(p[i:i + phk.k - 1], ''))) = phk.term GROUP BY ALL),
seq AS (SELECT post_id, list_prepend({{'i': 0::BIGINT, 'k': 0::BIGINT, 'e': 0::BIGINT, 'kept': []::BIGINT[]}},
                 list({{'i': i::BIGINT, 'k': k::BIGINT, 'e': 0::BIGINT, 'kept': []::BIGINT[]}} ORDER BY i)) AS m FROM hit GROUP BY post_id),
kept AS (SELECT post_id, unnest(list_reduce(m, lambda a, x: CASE WHEN x.i >= a.e
           THEN {{'i': 0::BIGINT, 'k': 0::BIGINT, 'e': x.i + x.k, 'kept': list_append(a.kept, x.i)}} ELSE a END).kept) AS i FROM seq),
took AS (SELECT post_id, i, k FROM kept JOIN hit USING (post_id, i)),
cover AS (SELECT post_id, unnest(generate_series(i, i + k - 1)) AS i FROM took),
toked AS (
  SELECT post_id, i, ltrim(array_to_string(p[i:i + k - 1], '')) AS t FROM took JOIN pos USING (post_id, i)
  UNION ALL
  SELECT post_id, i, ltrim(p[i]) FROM pos ANTI JOIN cover USING (post_id, i) WHERE regexp_matches(ltrim(p[i]), '^[\p{{L}}\p{{N}}'']')
),
tkl AS (SELECT post_id, list(t ORDER BY i) AS toks FROM toked GROUP BY post_id),
tk AS (SELECT post_id, c, coalesce(toks, []) AS toks FROM pcs LEFT JOIN tkl USING (post_id)),"""


def _rules_sql(rows, rules: SE.Rules, tokens_sql: str = _WORD_TOKENS_SQL) -> str:
    """Tiers 2-3 in SQL: per-token steps in the same order and arithmetic as the Spark job."""
    r = rules
    f1, f2, f3 = (float(x) for x in r.distance_factors)
    deg_values = ", ".join(f"({_sql_str(k.lower())}, {float(v)!r}e0)" for k, v in sorted(r.degree.items()))
    neg_values = ", ".join(f"({_sql_str(n.lower())})" for n in r.negations)
    sgn = "(CASE WHEN {v} >= 0 THEN 1.0 ELSE -1.0 END)"

    def deg_step(src, dst, p, f):
        return (f"{dst} AS (SELECT x.*, CASE WHEN x.{p} IS NOT NULL AND x.v <> 0 THEN x.v + coalesce(d.scalar, 0.0) * "
                f"{sgn.format(v='x.v')} * {f!r} ELSE x.v END AS v2 FROM {src} x LEFT JOIN deg d ON x.{p} = d.term),\n"
                f"{dst}n AS (SELECT * EXCLUDE (v, v2), CASE WHEN {p} IN (SELECT term FROM negs) AND v2 <> 0 "
                f"THEN v2 * {float(r.negation_scalar)!r} ELSE v2 END AS v FROM {dst})")
    return f"""
, {_lexicon_values_sql(rows)},
lexg AS (SELECT lower(term) AS term, avg(valence) AS valence FROM lex GROUP BY 1),
deg(term, scalar) AS (VALUES {deg_values}),
negs(term) AS (VALUES {neg_values}),{tokens_sql}
tk2 AS (
  SELECT post_id, toks, list_transform(toks, lambda t: lower(t)) AS low,
         len(list_filter(toks, lambda t: t = upper(t) AND t <> lower(t))) AS n_caps,
         length(c) - length(replace(c, '!', '')) AS n_excl, length(c) - length(replace(c, '?', '')) AS n_q
  FROM tk
),
idx AS (
  SELECT post_id, toks, low, n_excl, n_q, n_caps > 0 AND n_caps < len(toks) AS cap_diff,
         coalesce(list_position(low, {_sql_str(r.but_word.lower())}), 0) - 1 AS but_pos,
         unnest(generate_series(1, len(toks))) AS i
  FROM tk2
),
t0 AS (
  SELECT post_id, n_excl, n_q, cap_diff, but_pos, i - 1 AS pos, low[i] AS term,
         toks[i] = upper(toks[i]) AND toks[i] <> lower(toks[i]) AS caps,
         CASE WHEN i > 1 THEN low[i - 1] END AS p1, CASE WHEN i > 2 THEN low[i - 2] END AS p2,
         CASE WHEN i > 3 THEN low[i - 3] END AS p3
  FROM idx
),
t1 AS (SELECT t0.*, coalesce(l.valence, 0.0) AS v0 FROM t0 LEFT JOIN lexg l ON t0.term = l.term),
tc AS (SELECT * EXCLUDE (v0), CASE WHEN caps AND cap_diff AND v0 <> 0 THEN v0 + {sgn.format(v='v0')} * {float(r.caps_increment)!r}
       ELSE v0 END AS v FROM t1),
{deg_step("tc", "k1", "p1", f1)},
{deg_step("k1n", "k2", "p2", f2)},
{deg_step("k2n", "k3", "p3", f3)},
tb AS (SELECT * EXCLUDE (v), CASE WHEN but_pos >= 0 AND pos < but_pos THEN v * {float(r.but_before)!r}
       WHEN but_pos >= 0 AND pos > but_pos THEN v * {float(r.but_after)!r} ELSE v END AS v FROM k3n),
agg0 AS (
  SELECT post_id, round(sum(v), 6) + 0.0 AS s, round(sum(CASE WHEN v > 0 THEN v + 1.0 ELSE 0.0 END), 6) + 0.0 AS ps,
         round(sum(CASE WHEN v < 0 THEN v - 1.0 ELSE 0.0 END), 6) + 0.0 AS ns,
         count(*) FILTER (WHERE v = 0) AS neu_n, max(n_excl) AS n_excl, max(n_q) AS n_q
  FROM tb GROUP BY post_id
),
amp AS (
  SELECT *, least(n_excl, {int(r.exclamation_max)}) * {float(r.exclamation_increment)!r}
            + CASE WHEN n_q <= 1 THEN 0.0 WHEN n_q <= 3 THEN n_q * {float(r.question_increment)!r}
                   ELSE {float(r.question_cap)!r} END AS a
  FROM agg0
),
agg AS (
  SELECT post_id, neu_n,
         round(CASE WHEN s > 0 THEN s + a WHEN s < 0 THEN s - a ELSE s END, 6) + 0.0 AS s,
         round(CASE WHEN ps > abs(ns) THEN ps + a ELSE ps END, 6) + 0.0 AS pos_sum,
         round(CASE WHEN ps < abs(ns) THEN ns - a ELSE ns END, 6) + 0.0 AS neg_sum
  FROM amp
),
sc AS (
  SELECT post_id, round(s / sqrt(s * s + {float(r.alpha)!r}), 4) + 0.0 AS compound,
         coalesce(round(abs(pos_sum / nullif(pos_sum + abs(neg_sum) + neu_n, 0)), 3) + 0.0, 0.0) AS pos,
         coalesce(round(abs(neu_n / nullif(pos_sum + abs(neg_sum) + neu_n, 0)), 3) + 0.0, 0.0) AS neu,
         coalesce(round(abs(neg_sum / nullif(pos_sum + abs(neg_sum) + neu_n, 0)), 3) + 0.0, 0.0) AS neg
  FROM agg
),
scored AS (
  SELECT x.post_id, x.brand, x.source,
         coalesce(trim(x.content), '') = '' AS blank, coalesce(sc.compound, 0.0) AS c,
         coalesce(sc.pos, 0.0) AS pos, coalesce(sc.neu, 0.0) AS neu, coalesce(sc.neg, 0.0) AS neg
  FROM texts x LEFT JOIN sc ON x.post_id = sc.post_id
)"""


@register("lexicon_sentiment_rules", "U1 tiers 2-3 (caps, degree, negation, contrast word, punctuation)",
          with_(TEXTS_CTE) + _rules_sql(TEST_LEXICON, TEST_RULES) + """
SELECT post_id, brand,
       CASE WHEN blank THEN 'NEUTRAL' WHEN c >= 0.05 THEN 'POSITIVE' WHEN c <= -0.05 THEN 'NEGATIVE'
            ELSE 'NEUTRAL' END AS sentiment_label,
       CASE WHEN blank THEN 0.5 ELSE (c + 1.0) / 2.0 END AS sentiment_score,
       CASE WHEN blank THEN 0.0 ELSE greatest(pos, neu, neg) END AS confidence,
       CASE WHEN blank THEN 0.0 ELSE c END AS compound
FROM scored
""")
def q_lexicon_sentiment_rules(spark, sf_dir):
    """Full rule set on whole texts (tiers 2 and 3)."""
    texts = AD.texts_table(spark, sf_dir)
    lex = SE.lexicon_frame(spark, TEST_LEXICON)
    return SE.score_sentiment(texts, lex, tier=3, rules=TEST_RULES, details=True).select(
        "post_id", "brand", "sentiment_label", "sentiment_score", "confidence", "compound")


# Phrases and symbols, one within another, with texts that end in some of them.
PHRASE_LEXICON = TEST_LEXICON + [
    (":)", 2.0), (":-(", -1.9), ("to die for", 2.9), ("die", -2.9), ("die for", -1.1), ("of the", 1.3), ("of the th", -0.9),
    ("and the", -1.2), ("!", 0.3), ("que la", 1.1), ("der und", 0.7), ("...", -0.4)]
PHRASES = [t for t, _ in PHRASE_LEXICON if " " in t or not t[0].isalnum()]
_ENDINGS = ["to die for :)", "Not TO  DIE\tfor!:-(", "to die, for", "die for of the the... :-)", ""]


def _phrase_texts(spark, sf_dir):
    t = AD.texts_table(spark, sf_dir)
    ends = F.array(*[F.lit(e) for e in _ENDINGS])
    at = (F.col("post_id").cast("long") % len(_ENDINGS)).cast("int")
    return t.withColumn("content", F.concat_ws(" ", "content", F.get(ends, at)))


_PHRASE_TEXTS_CTE = """
texts AS (
  SELECT CAST(doc_id AS VARCHAR) AS post_id, source, lang AS brand,
         concat_ws(' ', text, [""" + ", ".join("'" + e.replace("\t", "' || chr(9) || '") + "'" for e in _ENDINGS) + f"""][doc_id % {len(_ENDINGS)} + 1]) AS content
  FROM documents
)"""


@register("lexicon_sentiment_phrases", "U1 J6 tiers 1-3 (terms of several words and symbols)",
          with_(_PHRASE_TEXTS_CTE) + _rules_sql(PHRASE_LEXICON, TEST_RULES, _phrase_tokens_sql(PHRASES)) + """
SELECT post_id, brand,
       CASE WHEN blank THEN 'NEUTRAL' WHEN c >= 0.05 THEN 'POSITIVE' WHEN c <= -0.05 THEN 'NEGATIVE'
            ELSE 'NEUTRAL' END AS sentiment_label,
       CASE WHEN blank THEN 0.5 ELSE (c + 1.0) / 2.0 END AS sentiment_score,
       CASE WHEN blank THEN 0.0 ELSE greatest(pos, neu, neg) END AS confidence,
       CASE WHEN blank THEN 0.0 ELSE c END AS compound
FROM scored
""")
def q_lexicon_sentiment_phrases(spark, sf_dir):
    lex = SE.lexicon_frame(spark, PHRASE_LEXICON)
    return SE.score_sentiment(_phrase_texts(spark, sf_dir), lex, tier=3, rules=TEST_RULES, details=True, phrases=PHRASES).select(
        "post_id", "brand", "sentiment_label", "sentiment_score", "confidence", "compound")


# ------------------------------------------------------------------------------------ U5
def _topics_sql(vocabulary, lower_keywords=True, whole_word=False) -> str:
    items = []
    for topic, kws in vocabulary:
        conds = []
        for kw in kws:
            k = kw.lower() if lower_keywords else kw
            if whole_word:
                conds.append(f"regexp_matches(lower(coalesce(content, '')), {_sql_str(whole_word_pattern(k))})")
            else:
                conds.append(f"contains(lower(coalesce(content, '')), {_sql_str(k)})")
        items.append(f"CASE WHEN {' OR '.join(conds)} THEN {_sql_str(topic)} END")
    return "list_filter([" + ", ".join(items) + "], lambda x: x IS NOT NULL)"


def _tagging_sql(vocabulary, **kw) -> str:
    return with_(TEXTS_CTE) + f"""
, tagged AS (SELECT post_id, brand, {_topics_sql(vocabulary, **kw)} AS topics FROM texts)
SELECT post_id, array_to_string(topics, '|') AS topics, CAST(len(topics) AS BIGINT) AS n_topics FROM tagged
"""


def _tagged(spark, sf_dir, vocabulary=None, **kw):
    t = TP.tag_topics(AD.texts_table(spark, sf_dir), vocabulary=vocabulary, **kw)
    return t.select("post_id", F.array_join("topics", "|").alias("topics"),
                    F.size("topics").cast("long").alias("n_topics"))


@register("topic_tagging", "U5 F13 Q3", _tagging_sql(S.TOPIC_KEYWORDS))
def q_topic_tagging(spark, sf_dir):
    return _tagged(spark, sf_dir)


@register("topic_tagging_test_vocab", "U5 F13 Q4", _tagging_sql(TEST_VOCABULARY))
def q_topic_tagging_test_vocab(spark, sf_dir):
    return _tagged(spark, sf_dir, TEST_VOCABULARY)


@register("topic_tagging_whole_word", "U5 Q4 (whole words)", _tagging_sql(TEST_VOCABULARY, whole_word=True))
def q_topic_tagging_whole_word(spark, sf_dir):
    return _tagged(spark, sf_dir, TEST_VOCABULARY, whole_word=True)


@register("topic_tagging_trie", "U5 J6 (large-vocabulary path)", _tagging_sql(TEST_VOCABULARY))
def q_topic_tagging_trie(spark, sf_dir):
    return _tagged(spark, sf_dir, TEST_VOCABULARY, method="trie")


@register("topic_tagging_trie_whole_word", "U5 J6 Q4 (large-vocabulary path, whole words)", _tagging_sql(TEST_VOCABULARY, whole_word=True))
def q_topic_tagging_trie_whole_word(spark, sf_dir):
    return _tagged(spark, sf_dir, TEST_VOCABULARY, whole_word=True, method="trie")


# Rule: every ordered pair of these syllables is a keyword, 1,296 in all; a topic per first one.
_SYLLABLES = ("th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of", "or", "nt",
              "ea", "ti", "to", "it", "st", "io", "le", "is", "ou", "ar", "as", "de", "rt", "ve", "ei", "ch",
              "qu", "au", "ie", "ci")
LARGE_VOCABULARY = [(f"{a}-", [a + b for b in _SYLLABLES]) for a in _SYLLABLES]


@register("topic_tagging_large_vocab", "U5 J6 (1,296 keywords)", _tagging_sql(LARGE_VOCABULARY))
def q_topic_tagging_large_vocab(spark, sf_dir):
    return _tagged(spark, sf_dir, LARGE_VOCABULARY, method="trie")


@register("topic_tagging_explode_counts", "U5 F19 A3", with_(TEXTS_CTE) + f"""
, tagged AS (SELECT post_id, brand, {_topics_sql(TEST_VOCABULARY)} AS topics FROM texts),
rows_ AS (SELECT brand, unnest(topics) AS topic FROM tagged)
SELECT topic, brand AS lang, count(*) AS mentions FROM rows_ GROUP BY 1, 2
""")
def q_topic_tagging_explode_counts(spark, sf_dir):
    t = TP.explode_topics(TP.tag_topics(AD.texts_table(spark, sf_dir), vocabulary=TEST_VOCABULARY))
    return t.groupBy("topic", F.col("brand").alias("lang")).agg(F.count(F.lit(1)).alias("mentions"))

