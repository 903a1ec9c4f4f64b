"""Keyword topic tagging.

``tag_topics`` adds ``topics: array<string>`` — the vocabulary's topics, in vocabulary
order, each at most once, whose keywords occur in the lower-cased text. Both ways run on
the JVM and give the same rows; the caller chooses:

* ``method="expr"`` (default): one expression per row, ``filter(array(when(contains.., topic),
  ..))``. No join and no shuffle; its cost grows with the number of keywords.
* ``method="trie"``: for vocabularies of thousands of keywords. One pattern holds all keywords by
  their common beginnings and finds, inside the row, the longest one at every place of the text; a table
  of hash buckets in the plan maps it to the topics of all keywords it begins with. Its cost
  grows with the text, hardly with the vocabulary, and nothing is exploded, joined or shuffled.

Q3: the original lower-cases the text but not the keywords, so "CEO" never matches;
``lower_keywords=True`` (default) fixes it, ``False`` reproduces it.
Q4: containment is substring-based ("price" hits "enterprise"); ``whole_word=True``
requires word boundaries.
"""

from __future__ import annotations

import json
import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brandpulse import schemas as S
from brandpulse.functions.text import keyword_match, trie_pattern


def _prepared(vocabulary, lower_keywords: bool):
    return [(topic, [k.lower() if lower_keywords else k for k in kws]) for topic, kws in vocabulary]


def lowered_text(text) -> Column:
    return F.lower(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def topics_expr(text, vocabulary=None, lower_keywords: bool = True, whole_word: bool = False,
                already_lowered: bool = False) -> Column:
    """The tagging expression (array<string>, empty for null text). ``already_lowered``:
    ``text`` is a column computed by :func:`lowered_text`."""
    vocab = _prepared(vocabulary or S.TOPIC_KEYWORDS, lower_keywords)
    lowered = (F.col(text) if isinstance(text, str) else text) if already_lowered else lowered_text(text)
    items = []
    for topic, kws in vocab:
        cond = None
        for kw in kws:
            m = keyword_match(lowered, kw, whole_word)
            cond = m if cond is None else (cond | m)
        items.append(F.when(cond, F.lit(topic)))
    return F.filter(F.array(*items), lambda x: x.isNotNull())


def _keyword_topics(vocab, whole_word: bool) -> dict[str, list[int]]:
    """The topics of every keyword: its own and those of the keywords that begin it (as whole words,
    if asked for)."""
    own: dict[str, set[int]] = {}
    for i, (_, kws) in enumerate(vocab):
        for kw in kws:
            own.setdefault(kw, set()).add(i)
    out = {}
    for kw in own:
        heads = (kw[:n] for n in range(1, len(kw) + 1) if not whole_word or n == len(kw) or not kw[n].isalnum())
        out[kw] = sorted(set().union(*[own.get(h, ()) for h in heads]))
    return out


def _looked_up(found: Column, topics: dict[str, list[int]]) -> Column:
    """The topics of the keywords in ``found``. A keyword's bucket is its checksum's; a bucket holds
    a few, so that looking one up takes the same time in any vocabulary."""
    n = max(1, len(topics) // 2)
    buckets: list[dict] = [{} for _ in range(n)]
    for kw, ids in topics.items():
        buckets[zlib.crc32(kw.encode()) % n][kw] = ids
    table = F.from_json(F.lit(json.dumps(buckets)), "array<map<string,array<int>>>")   # folded into the plan
    return F.flatten(F.transform(found, lambda k: F.try_element_at(F.get(table, F.pmod(F.crc32(k.cast("binary")), F.lit(n)).cast("int")), k)))


def _tag_by_trie(df: DataFrame, text_col: str, vocab, whole_word: bool, out_col: str) -> DataFrame:
    topics = [t for t, _ in vocab]
    blank = keyword_match(F.col("_lowered_text"), "", whole_word)    # the empty keyword is in every text
    always = F.array_compact(F.array(*[F.when(blank, F.lit(i)) for i, (_, kws) in enumerate(vocab) if "" in kws])).cast("array<int>")
    known = _keyword_topics([(t, [k for k in kws if k]) for t, kws in vocab], whole_word)
    if known:
        firsts = "".join(sorted({"\\" + k[0] if k[0] in "[]^-&\\" else k[0] for k in known}))
        edge = r"[\p{L}\p{N}]"
        before, after = (f"(?<!{edge})", f"(?!{edge})") if whole_word else ("", "")
        # a look ahead takes no characters, so keywords may overlap
        pattern = f"{before}(?=[{firsts}])(?=({trie_pattern(known)}){after})"
        found = F.array_distinct(F.regexp_extract_all(F.col("_lowered_text"), F.lit(pattern), F.lit(1)))
        ids = F.concat(_looked_up(found, known), always)
    else:
        ids = always
    names = F.array(*[F.lit(t) for t in topics])
    return (df.withColumn("_lowered_text", lowered_text(text_col))
            .withColumn(out_col, F.transform(F.array_sort(F.array_distinct(ids)), lambda i: F.element_at(names, i + 1)))
            .drop("_lowered_text"))


def tag_topics(df: DataFrame, text_col: str = "content", vocabulary=None, lower_keywords: bool = True,
               whole_word: bool = False, method: str = "expr", out_col: str = "topics") -> DataFrame:
    """Add ``out_col`` with the matched topics."""
    vocab = _prepared(vocabulary or S.TOPIC_KEYWORDS, lower_keywords)
    if method == "expr":
        # The lower-cased text is its own projection: inside the OR / CASE chains Catalyst
        # does not share it, and lower-casing a whole text once per keyword doubles the cost.
        lc = "_lowered_text"
        return (df.withColumn(lc, lowered_text(text_col))
                .withColumn(out_col, topics_expr(lc, vocab, lower_keywords=False, whole_word=whole_word,
                                                 already_lowered=True))
                .drop(lc))
    if method == "trie":
        return _tag_by_trie(df, text_col, vocab, whole_word, out_col)
    raise ValueError(f"unknown method {method!r}")


def explode_topics(df: DataFrame, topics_col: str = "topics", out_col: str = "topic") -> DataFrame:
    """one row per (row, topic); rows with no topic produce nothing (P10: no null topic).

    ``explode_outer`` + the null filter gives the same rows as ``explode``, but keeps
    Catalyst from inferring ``size(topics) > 0`` and pushing that copy of the whole tagging
    expression below the input spread into the scan (where it would run a second time)."""
    return (df.withColumn(out_col, F.explode_outer(topics_col)).drop(topics_col)
            .filter(F.col(out_col).isNotNull()))


def keyword_table(spark, vocabulary=None) -> DataFrame:
    """The vocabulary as a table ``(ordinal, topic, keyword)``."""
    return spark.createDataFrame(S.topic_keywords_rows(vocabulary), "ordinal int, topic string, keyword string")
