r"""Quality rules: line-first cleaning, with DataFrame functions only.

Every line of a text is judged by itself: punctuation (a run of words must end a sentence
somewhere), navigation (menu separators between most words) and boilerplate (known phrases,
shouting, words wrapped in symbols). Lines that fail are taken out, and a document that loses too
much of its text that way is rejected. Base rules (too few words, most words in repeated
three-word windows) reject a document before that.

A line with words that equals an earlier line of its text is taken out too. It isn't counted as
lost, as its first place stays, and so enters no verdict (nor does it in ``OP7_SQL``).

Nothing is shuffled: one pass over the table, all work inside the row. Repeated three-word
windows are found by sorting the 64-bit hashes of a text's windows, so long texts stay at
n log n; only texts that have a repeated window sort their positions. Repeated lines are found
by sorting the lines of a text that has any.

A null text counts as the empty one: no words, base rules fail, cleaned text empty. Lines
without a word are kept as they are and judged by no rule.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brandpulse.llm.common import ROW, SPACE, WORD, boxed, documents, unboxed

MIN_WORDS = 50
MAX_REPEAT_PCT = 50
#: A document is rejected when its failing lines hold more than this share of its non-space characters.
MAX_LOST = 0.3
#: Lines of fewer words are headings or list items: no sentence end is asked of them.
SENTENCE_WORDS = 20
#: Shares of a line's words from which a rule fails.
NAVIGATION_SHARE = 0.25
SYMBOL_SHARE = 0.25
SHOUT_SHARE = 0.5
#: Up to so many different repeated windows are looked up one by one.
FEW = 32
SYMBOLS = "#*$%&|<>"
BOILERPLATE = (
    "lorem ipsum", "enable javascript", "javascript is disabled", "cookie policy", "privacy policy",
    "terms of use", "terms of service", "all rights reserved", "click here to", "sign up for our newsletter",
    "skip to content", "skip to main content", "back to top",
)


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def line_fails(line: Column) -> Column:
    """Whether a line with words breaks a rule. Null lines don't occur."""
    n = _count(line, r"[^\x20\x09-\x0D]+")
    navigation = _count(line, r"(?:^|[\x20\x09-\x0D])[|»›·>]+(?=[\x20\x09-\x0D]|$)")
    symbols = _count(line, r"[#*$%&|<>]{2,}(?=[\x20\x09-\x0D.,;:!?]|$)")
    shout = _count(line, r"(?:^|[\x20\x09-\x0D])[\p{Lu}\p{P}]*\p{Lu}[\p{Lu}\p{P}]*!(?=[\x20\x09-\x0D]|$)")
    # the array binds the lowered line, so that it is made once
    phrase = F.exists(F.array(F.lower(line)), lambda low: reduce(Column.__or__, [low.contains(x) for x in BOILERPLATE]))
    # a rule is only worked out where its characters occur: most lines have none of them
    sentence = line.contains(".") | line.contains("!") | line.contains("?") | line.rlike(r"[…。！？؟।]")
    return ((~sentence & (n >= SENTENCE_WORDS))
            | (line.rlike(r"[|»›·>]") & (navigation >= n * NAVIGATION_SHARE))
            | (line.rlike(r"[#*$%&|<>]{2}") & (symbols >= n * SYMBOL_SHARE))
            | (line.contains("!") & (shout >= n * SHOUT_SHARE)) | phrase)


def _shifted(array: Column, by: int) -> Column:
    """The array without its first ``by`` elements."""
    return F.slice(array, by + 1, F.greatest(F.size(array) - by, F.lit(0)))


def _repeat_words(d: DataFrame) -> DataFrame:
    """Adds ``_rep``: words of ``_words`` covered by three-word windows that occur twice or more.

    Every intermediate array is a column of its own, so that it is computed once.
    """
    d = d.withColumn("_h", F.transform("_words", lambda w: F.xxhash64(w)))
    d = d.withColumn("_h", F.zip_with("_h", _shifted(F.col("_h"), 1), lambda a, b: F.xxhash64(a, b)))
    # two equal overlapping pairs make equal windows; the last pair has no successor
    d = d.withColumn("_h", F.zip_with("_h", _shifted(F.col("_h"), 1), lambda a, b: F.xxhash64(a, b)))
    d = d.withColumn("_h", F.slice("_h", 1, F.greatest(F.size("_words") - 2, F.lit(0))))
    repeated = F.size(F.array_distinct("_h")) < F.size("_h")
    d = d.withColumn("_s", F.when(repeated, F.sort_array("_h")))
    d = d.withColumn("_two", F.array_distinct(F.filter(
        F.zip_with("_s", _shifted(F.col("_s"), 1), lambda a, b: F.when(a == b, a)), lambda x: x.isNotNull())))
    few = F.size("_two") <= FEW
    d = d.withColumn("_p", F.when(few, F.filter(
        F.transform("_h", lambda h, i: F.when(F.array_contains("_two", h), i)), lambda i: i.isNotNull())))
    # many repeated windows: sort positions with their hashes instead of looking each hash up
    d = d.withColumn("_s", F.when(~few, F.array_sort(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    d = d.withColumn("_same", F.zip_with("_s", _shifted(F.col("_s"), 1), lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False))))
    d = d.withColumn("_same", F.zip_with("_same", F.concat(F.array(F.lit(False)), "_same"), lambda a, b: a | b))
    d = d.withColumn("_q", F.sort_array(F.filter(
        F.zip_with("_s", "_same", lambda p, r: F.when(r, p["i"])), lambda i: i.isNotNull())))
    d = d.withColumn("_p", F.coalesce("_p", "_q"))
    steps = F.zip_with("_p", _shifted(F.col("_p"), 1), lambda a, b: F.coalesce(F.least(b - a, F.lit(3)), F.lit(3)))
    rep = F.aggregate(steps, F.lit(0).cast("long"), lambda s, x: s + x)
    return d.withColumn("_rep", F.coalesce(rep, F.lit(0).cast("long"))).drop("_h", "_s", "_two", "_p", "_q", "_same")


def _seen_lines(d: DataFrame) -> DataFrame:
    """Adds ``_seen``: whether each of ``_lines`` has words and equals an earlier one. Null if
    ``_dup`` is 0."""
    d = d.withColumn("_o", F.when(F.col("_dup") > 0, F.array_sort(
        F.transform("_lines", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))))
    # equal lines are in order of their places
    d = d.withColumn("_b", F.concat(F.array(F.lit(None).cast("string")), F.transform(F.slice("_o", 1, F.size("_lines") - 1), lambda p: p["x"])))
    d = d.withColumn("_o", F.array_sort(F.zip_with("_o", "_b", lambda p, b: F.struct(
        p["i"].alias("i"), (F.coalesce(p["x"] == b, F.lit(False)) & p["x"].rlike(WORD)).alias("again")))))
    return d.withColumn("_seen", F.transform("_o", lambda p: p["again"])).drop("_o", "_b")


def judge(docs: DataFrame) -> DataFrame:
    """``docs`` with the figures, ``base_failed``, ``lost`` (share of characters), ``kept`` and
    ``cleaned`` (the text without failing lines and repeated ones).

    Column names of ``docs`` that clash with the new ones are replaced.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    d = boxed(docs, F.filter(F.split(text, SPACE), lambda w: w != "").alias("_words"),
              F.split(text, "\n").alias("_lines"), text.alias("_text"))
    d = d.withColumn("_chars", F.aggregate("_words", F.lit(0).cast("long"), lambda n, w: n + F.length(w)))
    d = _repeat_words(d).withColumn("_n", F.size("_words").cast("long")).drop("_words")
    d = d.withColumn("_full", F.filter("_lines", lambda x: x.rlike(WORD)))
    d = d.withColumn("_fails", F.transform("_lines", lambda x: x.rlike(WORD) & line_fails(x)))
    d = d.withColumn("_gone", F.filter(F.zip_with("_lines", "_fails", lambda x, f: F.when(f, x)), lambda x: x.isNotNull()))
    d = _seen_lines(d.withColumn("_dup", (F.size("_full") - F.size(F.array_distinct("_full"))).cast("long")))
    d = d.withColumn("_out", F.coalesce(F.zip_with("_fails", "_seen", lambda f, s: f | s), "_fails"))
    good = F.filter(F.zip_with("_lines", "_out", lambda x, o: F.when(~o, x)), lambda x: x.isNotNull())
    gone = F.aggregate("_gone", F.lit(0).cast("long"), lambda n, x: n + F.length(F.regexp_replace(x, SPACE, "")))
    base = (F.col("_n") < MIN_WORDS) | (F.col("_rep") * 100 > F.col("_n") * MAX_REPEAT_PCT)
    d = d.select(
        ROW, F.col("_n").alias("n_words"), F.col("_chars").alias("word_chars"),
        F.regexp_count("_text", F.lit("[" + SYMBOLS + "]")).cast("long").alias("n_symbols"),
        F.col("_dup").alias("n_dup_lines"),
        F.col("_rep").alias("n_repeat_words"), base.alias("base_failed"),
        F.when(F.col("_chars") > 0, gone / F.col("_chars")).otherwise(0.0).alias("lost"),
        F.array_join(good, "\n").alias("cleaned"))
    d = d.withColumn("kept", ~F.col("base_failed") & (F.col("lost") <= MAX_LOST))
    return unboxed(d, docs.columns, *RESULT)


RESULT = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "lost", "kept", "cleaned"]


def op7_quality(spark, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


OP7_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
tri AS (
  SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i, unnest(list_transform(range(1, len(ws) - 1),
         lambda k: ws[k:k + 2])) AS g FROM w WHERE len(ws) > 2),
rep AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM tri) WHERE c > 1),
cov AS (
  SELECT doc_id, count(DISTINCT p)::BIGINT AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM rep)
  GROUP BY doc_id),
ln AS (
  SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d),
lw AS (
  SELECT doc_id, x, regexp_extract_all(x, '[^\x20\x09-\x0D]+') AS ws FROM ln),
lines AS (
  SELECT doc_id, x, length(array_to_string(ws, '')) AS chars, len(ws) AS n,
    (len(ws) >= 20 AND NOT regexp_matches(x, '[.!?…。！？؟।]'))
    OR len(list_filter(ws, lambda v: regexp_full_match(v, '[|»›·>]+'))) >= len(ws) * 0.25
    OR len(regexp_extract_all(x, '[#*$%&|<>]{2,}(?:[\x20\x09-\x0D.,;:!?]|$)')) >= len(ws) * 0.25
    OR len(list_filter(ws, lambda v: regexp_full_match(v, '[\p{Lu}\p{P}]*\p{Lu}[\p{Lu}\p{P}]*!'))) >= len(ws) * 0.5
    OR regexp_matches(lower(x), '__PHRASES__') AS bad
  FROM lw),
per AS (
  SELECT doc_id, sum(chars)::BIGINT AS chars, coalesce(sum(chars) FILTER (WHERE n > 0 AND bad), 0)::BIGINT AS gone,
         (count(*) FILTER (WHERE n > 0) - count(DISTINCT x) FILTER (WHERE n > 0))::BIGINT AS dup
  FROM lines GROUP BY doc_id),
f AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words, per.chars AS word_chars,
         (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
         dup AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words, per.chars, per.gone
  FROM w JOIN per USING (doc_id) LEFT JOIN cov USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
         AND CASE WHEN chars > 0 THEN gone::DOUBLE / chars ELSE 0 END <= 0.3 AS kept
FROM f
""".replace("__PHRASES__", "|".join(BOILERPLATE))


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with the columns of ``docs``: ``text`` without its
    failing and repeated lines, ``n_chars`` its length. Extra columns pass through."""
    tagged = judge(boxed(docs, "text")).withColumn("_id", F.monotonically_increasing_id())
    # a predicate on the id is not pushed down, and so doesn't take a second copy of all rules with it
    tagged = tagged.where("kept and _id >= 0")
    new = {"text": F.col("cleaned"), "n_chars": F.length("cleaned").cast("long")}
    return tagged.select(*[new.get(c, F.col(ROW).getField(c)).alias(c) for c in docs.columns])
