"""Lexicon sentiment as a Spark job (no per-row Python).

The scorer follows the published lexicon-and-rules method (Hutto & Gilbert, ICWSM 2014)
with the lexicon as a *table argument* ``(term string, valence double)``; the modifier word
lists are parameters too. Constants are the published defaults and can be overridden.

Plan shape:

1. per-post features computed in-row from the whole text (tokens, each token's three
   predecessors, ALL-CAPS differential, first "but", ``!`` and ``?`` counts);
2. ``explode`` to one narrow row per token, which carries the post's key and never its text, and one
   header row per post, which carries its counts; an *inner* join with the lexicon keeps the headers and the
   tokens that have a valence. The lexicon's size is known (:func:`lexicon_frame`, or a
   stored table), so Spark broadcasts it up to its threshold and shuffles it beyond;
3. modifier rules as column arithmetic on what is left, one projection per rule;
4. sums of numbers per key: a hash aggregate whose partial half collapses a post's tokens in
   the task that made them, so about one narrow row per post is shuffled. Tokens without
   valence are neutral: they are the header's count without the others;
5. one join with the posts on the key.

Terms of several words and symbols (":)", "to die for") are ``phrases``: the tokenizer takes the longest
one at a place as one token, from left to right, so a phrase covers the words in it, and rules see
it as the one word it stands for. Blanks in a phrase match any white space.
:func:`phrase_terms` lists those of a lexicon.

Tiers: 1 = lexicon sum + normalisation (SQL-checkable); 2 = + ALL-CAPS emphasis, degree
words and negation over the three preceding tokens; 3 = + contrastive "but" and ``!``/``?``
emphasis. The key is the id with a hash of the text, so rows that share an id but not a text
are scored each by itself, and rows that share both get one score each.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brandpulse import schemas as S
from brandpulse.functions import scoring as SC
from brandpulse.functions.text import WORD_CHAR, count_char, tokens, trie_pattern

SPACES = r"[ \t\r\n\f]+"


@dataclass(frozen=True)
class Rules:
    # Fixed values of the published method (defaults; each can be overridden).
    alpha: float = 15.0                 # compound = s / sqrt(s*s + alpha)
    caps_increment: float = 0.733       # ALL-CAPS emphasis of a sentiment word
    negation_scalar: float = -0.74      # valence multiplier per negation among the 3 preceding tokens
    distance_factors: tuple = (1.0, 0.95, 0.9)   # degree-word effect at distance 1, 2, 3
    but_before: float = 0.5
    but_after: float = 1.5
    but_word: str = "but"
    exclamation_increment: float = 0.292
    exclamation_max: int = 4
    question_increment: float = 0.18
    question_cap: float = 0.96          # when more than 3 question marks
    # Word lists (parameters; supply your own). Degree words: term -> signed scalar.
    degree: dict = field(default_factory=dict)
    negations: tuple = ()


def _literal_map(d: dict) -> Column | None:
    if not d:
        return None
    kv = []
    for k, v in sorted(d.items()):
        kv += [F.lit(k.lower()), F.lit(float(v))]
    return F.create_map(*kv)


#: What stands for a post's header row in the lexicon: no token is empty.
_HEADER = ""


def _tokens(text: Column, phrases) -> Column:
    """The tokens of a text; the longest phrase at a place is one, its white space single blanks."""
    phrases = {" ".join(p.lower().split()) for p in phrases} - {""}
    if not phrases:
        return tokens(text)
    inside = r"[\p{L}\p{N}']"
    words = [p for p in phrases if WORD_CHAR.match(p[0])]
    parts = [f"(?<!{inside}){trie_pattern(words, f'(?!{inside})', SPACES)}"] if words else []
    if len(words) < len(phrases):
        parts.append(trie_pattern(phrases.difference(words), f"(?!{inside})", SPACES))
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"(?iu)(?:{'|'.join(parts)})|{inside}+"), F.lit(0))
    return F.transform(found, lambda t: F.regexp_replace(t, SPACES, " "))


def _token_rows(posts: DataFrame, id_col: str, text_col: str, but_word: str = "but", tier: int = 3, phrases=()) -> DataFrame:
    """One row per token with the post's key, and a header row per post (its
    ``pos`` is minus the number of tokens, less one).

    Built in stages so that the token array is computed once per post, and every per-post
    value used after the explode is a number (an array column kept across ``explode`` would
    be copied into every token row)."""
    text = F.col(text_col)
    base = posts.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_text"), _tokens(text, phrases).alias("_toks"))
    feats = base.withColumn("_low", F.transform("_toks", F.lower))
    if tier >= 2:
        n_caps = F.size(F.filter("_toks", lambda t: (t == F.upper(t)) & (t != F.lower(t))))
        feats = feats.withColumns({
            "_cap_diff": (n_caps > 0) & (n_caps < F.size("_toks")),
            "_but_pos": F.array_position(F.col("_low"), F.lit(but_word.lower())) - F.lit(1)})  # -1: none

    def element(t, i):
        before = [F.get(F.col("_low"), i - k).alias(f"p{k}") for k in (1, 2, 3)] if tier >= 2 else []
        caps = [((t == F.upper(t)) & (t != F.lower(t))).alias("caps")] if tier >= 2 else []
        return F.struct(i.alias("pos"), F.get(F.col("_low"), i).alias("term"), *caps, *before)

    none = F.lit(None).cast("string")
    extra = [F.lit(False).alias("caps"), *[none.alias(f"p{k}") for k in (1, 2, 3)]] if tier >= 2 else []
    header = F.array(F.struct((-F.size("_toks") - 1).alias("pos"), F.lit(_HEADER).alias("term"), *extra))
    kept = ["_cap_diff", "_but_pos"] if tier >= 2 else []
    return feats.select("_id", "_text", *kept, F.explode(F.concat(header, F.transform("_toks", element))).alias("_t"))


def _adjusted_valence(df: DataFrame, rules: Rules, tier: int) -> DataFrame:
    """Apply the modifier rules to ``_v``; each rule is one projection reading the previous
    value as a column, so the expression stays linear in the number of rules."""
    if tier < 2:
        return df
    v = F.col("_v")

    def sign(c):
        return F.when(c >= F.lit(0.0), F.lit(1.0)).otherwise(F.lit(-1.0))

    caps = F.col("_t.caps") & F.col("_cap_diff")
    df = df.withColumn("_v", F.when(caps & (v != F.lit(0.0)), v + sign(v) * F.lit(rules.caps_increment))
                       .otherwise(v))
    deg = _literal_map(rules.degree)
    negs = [n.lower() for n in rules.negations]
    for k, factor in zip((1, 2, 3), rules.distance_factors):
        p = F.col(f"_t.p{k}")
        if deg is not None:
            scalar = F.coalesce(F.try_element_at(deg, p), F.lit(0.0))
            df = df.withColumn("_v", F.when(p.isNotNull() & (v != F.lit(0.0)),
                                            v + scalar * sign(v) * F.lit(factor)).otherwise(v))
        if negs:
            df = df.withColumn("_v", F.when(p.isin(negs) & (v != F.lit(0.0)), v * F.lit(rules.negation_scalar))
                               .otherwise(v))
    if tier >= 3:
        bp = F.col("_but_pos")
        pos = F.col("_t.pos")
        df = df.withColumn("_v", F.when((bp >= 0) & (pos < bp), v * F.lit(rules.but_before))
                           .when((bp >= 0) & (pos > bp), v * F.lit(rules.but_after))
                           .otherwise(v))
    return df


def score_sentiment(posts: DataFrame, lexicon: DataFrame, text_col: str = "content", id_col: str = "post_id",
                    tier: int = 3, rules: Rules | None = None, details: bool = False, phrases=()) -> DataFrame:
    """``posts`` + ``sentiment_label``, ``sentiment_score`` (0..1), ``confidence``
    (+ ``compound``, ``pos``, ``neu``, ``neg`` when ``details``). ``phrases``: the lexicon's terms that
    are not one word, see :func:`phrase_terms`; without them such terms match nothing."""
    rules = rules or Rules()
    term = F.regexp_replace(F.trim(F.lower("term")), SPACES, " ")
    one = lexicon.groupBy(term.alias("_term")).agg(F.avg("valence").alias("_v")).where(F.col("_term") != _HEADER)
    lex = one.unionByName(lexicon.sparkSession.range(1).select(F.lit(_HEADER).alias("_term"), F.lit(0.0).alias("_v")))
    toks = _token_rows(posts, id_col, text_col, rules.but_word, tier, phrases)
    scored = _adjusted_valence(toks.join(lex, F.col("_t.term") == F.col("_term")), rules, tier)
    is_header = F.col("_t.pos") < 0
    # One row per key; numbers only, so both halves are hash aggregates.
    agg = (scored.groupBy("_id", "_text")
           .agg(F.sum("_v").alias("_s"),
                F.sum(F.when(F.col("_v") > 0, F.col("_v") + F.lit(1.0)).otherwise(F.lit(0.0))).alias("_pos"),
                F.sum(F.when(F.col("_v") < 0, F.col("_v") - F.lit(1.0)).otherwise(F.lit(0.0))).alias("_neg"),
                (F.sum(F.when(is_header, -F.col("_t.pos") - 1).otherwise(0)) - F.count_if(F.col("_v") != 0)).alias("_neu"),
                F.count_if(is_header).alias("_rows")))
    # rows that repeat id and text are summed together: each has its share
    agg = agg.select("_id", "_text", *[(F.col(c) / F.col("_rows")).alias(c) for c in ("_s", "_pos", "_neg", "_neu")])
    base_cols = [c for c in posts.columns if c != id_col]
    # what the result needs of the text is worked out before the join, which moves it only if it is asked for
    text = F.col(text_col)
    keyed = posts.withColumns({"_hash": F.xxhash64(text), "_blank": SC.is_blank(text), "_n_excl": count_char(text, "!"), "_n_q": count_char(text, "?")})
    agg = keyed.join(agg, keyed[id_col].eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_text")), "left").select(
        id_col, *base_cols, "_blank", "_n_excl", "_n_q", F.coalesce("_neu", F.lit(0.0)).alias("_neu"), F.coalesce("_s", F.lit(0.0)).alias("_s"),
        F.coalesce("_pos", F.lit(0.0)).alias("_pos"), F.coalesce("_neg", F.lit(0.0)).alias("_neg"))
    # Sums are snapped to a 1e-6 grid so that summation order (task layout) can change
    # neither the sign tests below nor the rounded outputs.
    snap = lambda c: SC.round_binary(c, 6)
    agg = agg.select(id_col, *base_cols, "_blank", "_neu", "_n_excl", "_n_q",
                     F.coalesce(snap(F.col("_s")), F.lit(0.0)).alias("_s"),
                     snap(F.col("_pos")).alias("_pos"), snap(F.col("_neg")).alias("_neg"))
    if tier >= 3:
        s, pos_sum, neg_sum = F.col("_s"), F.col("_pos"), F.col("_neg")
        ep = F.least(F.col("_n_excl"), F.lit(rules.exclamation_max)) * F.lit(rules.exclamation_increment)
        qm = F.col("_n_q")
        qp = (F.when(qm <= 1, F.lit(0.0))
               .when(qm <= 3, qm * F.lit(rules.question_increment))
               .otherwise(F.lit(rules.question_cap)))
        amp = ep + qp
        abs_neg = F.abs(neg_sum)
        agg = agg.select(id_col, *base_cols, "_blank", "_neu",
                         snap(F.when(s > 0, s + amp).when(s < 0, s - amp).otherwise(s)).alias("_s"),
                         snap(F.when(pos_sum > abs_neg, pos_sum + amp).otherwise(pos_sum)).alias("_pos"),
                         snap(F.when(pos_sum < abs_neg, neg_sum - amp).otherwise(neg_sum)).alias("_neg"))
    compound = SC.round_binary(F.col("_s") / F.sqrt(F.col("_s") * F.col("_s") + F.lit(rules.alpha)), 4)
    total = F.col("_pos") + F.abs(F.col("_neg")) + F.col("_neu")
    share = lambda c: F.coalesce(SC.round_binary(F.abs(F.try_divide(c, total)), 3), F.lit(0.0))
    joined = agg.select(id_col, *base_cols, "_blank", compound.alias("compound"), share(F.col("_pos")).alias("pos"),
                        share(F.col("_neu")).alias("neu"), share(F.col("_neg")).alias("neg"))
    blank = F.col("_blank")
    comp = F.coalesce(F.col("compound"), F.lit(0.0))
    label = F.when(blank, F.lit(S.BLANK_RESULT[0])).otherwise(SC.label_from_compound(comp))
    score = F.when(blank, F.lit(S.BLANK_RESULT[1])).otherwise(SC.rescale_compound(comp))
    conf = F.when(blank, F.lit(S.BLANK_RESULT[2])).otherwise(
        F.coalesce(SC.confidence_of("pos", "neu", "neg"), F.lit(0.0)))
    out_cols = [F.col(c) for c in posts.columns] + [
        label.alias("sentiment_label"), score.alias("sentiment_score"), conf.alias("confidence")]
    if details:
        out_cols += [F.when(blank, F.lit(0.0)).otherwise(comp).alias("compound"),
                     *[F.when(blank, F.lit(0.0)).otherwise(F.coalesce(F.col(c), F.lit(0.0))).alias(c)
                       for c in ("pos", "neu", "neg")]]
    return joined.select(*out_cols)


def unmatched_terms(lexicon: DataFrame) -> DataFrame:
    """The lexicon's terms that no word can equal: several words, symbols, blanks."""
    t = tokens(F.lower(F.col("term")))
    return lexicon.where(F.col("term").isNotNull() & ((F.size(t) != 1) | (t[0] != F.lower(F.col("term")))))


def phrase_terms(lexicon: DataFrame) -> list[str]:
    """The phrases and symbols of a lexicon, for ``score_sentiment(phrases=...)``: part of its plan, as the
    keywords of a vocabulary are."""
    return sorted(r.term for r in unmatched_terms(lexicon).select("term").distinct().collect() if r.term.strip())


def lexicon_frame(spark, rows) -> DataFrame:
    """A lexicon DataFrame from ``(term, valence)`` pairs, of known size."""
    rows = list(rows)
    table = pa.table({"term": pa.array([str(t) for t, _ in rows], pa.string()), "valence": pa.array([float(v) for _, v in rows], pa.float64())})
    return spark.createDataFrame(table)
