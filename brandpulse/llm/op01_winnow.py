"""Document fingerprints by winnowing, with DataFrame functions only.

A text's words are hashed, and the hash of every ``k`` consecutive words is built from overlapping
shorter ones (one, two, four words, then ``k``), so each gram costs a few steps whatever ``k`` is.
Of every ``w`` consecutive grams the one of the smallest hash is chosen, the rightmost of equals;
the chosen grams and their positions are the fingerprint. Two texts that share ``k + w - 1``
consecutive words share a chosen gram, and its positions say where.

Grams are compared by the upper 33 bits of their hash and then from the right, packed with the
position in one number; so the choice depends on the window's words alone, in any text. Window
minima also come from doubling. Everything happens inside a row, linear in the text.

A null or blank text has no grams and an empty fingerprint. A text of fewer than ``k`` words has
one gram over all of them; fewer than ``w`` grams are one window. The likeness of two fingerprints
is the Jaccard similarity of their hashes, 1 for two empty ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brandpulse.llm.common import ROW, boxed, documents, unboxed, words, written
from brandpulse.llm.ordering import ordered, with_position

K = 5
W = 8
_POS = (1 << 31) - 1


def _later(array: Column, by: int) -> Column:
    return F.slice(array, by + 1, F.greatest(F.size(array) - by, F.lit(0)))


def _steps(n: int) -> list[int]:
    """Shifts that widen a span of one to a span of n, doubling while that fits."""
    out, have = [], 1
    while have < n:
        out.append(min(have, n - have))
        have += out[-1]
    return out


def fingerprint(df: DataFrame, text: str, out: str, k: int = K, w: int = W) -> DataFrame:
    """Adds ``<out>_hashes`` and ``<out>_positions`` (arrays of bigint and int, by position); columns
    of these names are replaced, all others stay."""
    new = f"{out}_hashes", f"{out}_positions"
    return unboxed(_winnowed(boxed(df, F.col(f"`{text}`").alias("_t")), "_t", out, k, w), df.columns, *new)


def _winnowed(d: DataFrame, text: str, out: str, k: int = K, w: int = W) -> DataFrame:
    """:func:`fingerprint` of a frame whose column names are this module's."""
    g, v = "_grams", "_window"
    d = d.withColumn(g, F.transform(words(F.col(text)), lambda x: F.xxhash64(x)))
    grams = F.when(F.size(g) == 0, 0).otherwise(F.greatest(F.size(g) - (k - 1), F.lit(1)))
    d = d.withColumn("_n", grams)
    for step in _steps(k):  # past the end there is nothing to add
        d = d.withColumn(g, F.zip_with(g, _later(F.col(g), step), lambda a, b: F.xxhash64(a, b)))
    d = d.withColumn(g, F.slice(g, 1, F.col("_n")))
    d = d.withColumn(v, F.transform(g, lambda x, i: x.bitwiseAND(~_POS).bitwiseOR(F.lit(_POS).cast("long") - i)))
    for step in _steps(w):
        d = d.withColumn(v, F.zip_with(v, _later(F.col(v), step), lambda a, b: F.least(a, b)))
    d = d.withColumn(v, F.array_distinct(F.slice(v, 1, F.least(F.col("_n"), F.greatest(F.col("_n") - (w - 1), F.lit(1))))))
    d = d.withColumn(f"{out}_positions", F.transform(v, lambda x: (F.lit(_POS).cast("long") - x.bitwiseAND(_POS)).cast("int")))
    d = d.withColumn(f"{out}_hashes", F.transform(f"{out}_positions", lambda p: F.get(g, p)))
    return d.drop(g, v, "_n")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays of hashes."""
    every = F.size(F.array_union(a, b))
    return F.when(every == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / every)


def digest(name: str) -> Column:
    """A fingerprint as one short text."""
    parts = [F.col(f"{name}_hashes"), F.col(f"{name}_positions")]
    return F.lower(F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(seed), *parts)), 16, "0") for seed in (1, 2)]))


def successors(docs: DataFrame) -> DataFrame:
    """``doc_id, next_id, half``: the next document in descending doc_id (after the last: the
    first) and half the code points of the longest text with that id. Null ids come last, and
    equal ids count as one document."""
    ids = written(docs.select("doc_id", F.length(F.coalesce("text", F.lit(""))).alias("n")), "winnow-ids")
    ids = ids.groupBy("doc_id").agg(F.floor(F.max("n") / 2).cast("int").alias("half"))
    t = written(with_position(ordered(ids, [F.col("doc_id")], "winnow-order")).select(
        "doc_id", "half", "_pos"), "winnow-line")
    total = t.count()
    after = t.select(F.col("doc_id").alias("next_id"), ((F.col("_pos") + 1) % max(total, 1)).alias("_pos"))
    return t.join(after, "_pos").drop("_pos")


_NEW = ("n_chars", "edited", "own_hashes", "own_positions", "next_hashes", "edited_hashes", "edited_positions")


def edited(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` (``doc_id, text``, others), each text's length and fingerprint, the next
    document's hashes, the edited text and its fingerprint; input columns of those names are replaced.

    Of several rows with one id the smallest text stands for the id as the next document.
    Texts are shuffled once by id, in one exchange that both joins read where ``docs`` has no other
    columns; what a document needs from the next, the start of its text and its hashes, is sent to it.
    Null ids count as one id that comes last, a null text is empty, an empty table gives no rows.
    """
    # ids and texts move as they are and once; only the other columns are boxed
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    box = [F.struct(*[F.col(f"`{c}`") for c in rest]).alias(ROW)] if rest else []
    rows = docs.select(*box, F.col("doc_id").alias("id"), F.col("text").alias("given"))
    src = rows.select("id", "given")
    link = written(successors(src.toDF("doc_id", "text")), "winnow-link")
    if link.count() < src.count():  # some ids occur more than once
        src = src.groupBy("id").agg(F.min(F.coalesce("given", F.lit(""))).alias("given"))
    heard = link.select(F.col("next_id").alias("at"), F.col("doc_id").alias("to"), "half")
    met = src.join(heard, src["id"].eqNullSafe(F.col("at"))).withColumn("text", F.coalesce("given", F.lit("")))
    far = _winnowed(met, "text", "next")
    sent = far.select("to", F.substring("text", F.lit(1), F.col("half")).alias("begin"),
                      F.array_distinct("next_hashes").alias("next_hashes"))
    d = rows.join(sent, rows["id"].eqNullSafe(F.col("to"))).withColumn("text", F.coalesce("given", F.lit("")))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    d = d.withColumn("n_chars", n.cast("long")).withColumn("edited", F.concat(
        F.substring("text", F.lit(1), n - half), F.substring("begin", F.lit(1), half)))
    d = d.select(*([ROW] if rest else []), "id", "given", "text", "n_chars", "edited", "next_hashes")
    d = _winnowed(_winnowed(d, "text", "own"), "edited", "edited")
    taken = {"doc_id": "id", "text": "given"}
    old = [F.col(taken[c]).alias(c) if c in taken else F.col(ROW).getField(c).alias(c) for c in docs.columns if c.lower() not in _NEW]
    return d.select(*old, *_NEW)


def op1_fingerprints(spark, sf_dir: str) -> DataFrame:
    d = edited(documents(spark, sf_dir).select("doc_id", "text"))
    return d.select("doc_id", "n_chars", F.sha2(F.encode("edited", "utf-8"), 256).alias("edited_sha256"),
                    digest("own").alias("fingerprint"), digest("edited").alias("edited_fingerprint"),
                    likeness(F.col("own_hashes"), F.col("edited_hashes")).alias("near_edited"),
                    likeness(F.col("own_hashes"), F.col("next_hashes")).alias("near_next"),
                    F.col("own_hashes").alias("hashes"), F.col("own_positions").alias("positions"))
