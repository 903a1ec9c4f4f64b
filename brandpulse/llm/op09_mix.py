"""Mixing sources to target weights by systematic sampling, with DataFrame functions only.

A source's target is its share of the wanted words, cut at ``cap`` times what it holds, the
excess going to the others by weight. Every document of a source expects target / size copies.
These expectations are prefix-summed within the source over documents sorted by size, one
random offset is added, and a document is emitted once per integer boundary its interval
crosses. Sorting by size spreads the choice over all lengths, so the words taken miss the
target by one document's length at most; long documents go first, and the expectation of the
others makes up for what they took. The sums are whole numbers of 2**-24 copies, hence
exact, and reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brandpulse.llm.common import ROW, WORD, boxed, documents, null_key, unboxed, written
from brandpulse.llm.ordering import ordered, with_prefix_sum

SEED = 7_041_776
WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
LARGE = 64
_BITS = 24
_UNIT = 1 << _BITS


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """``source, source_size`` (one row per source) with ``target``.

    Weights repeat over the sources in code-point order, null last. Sources are taken by the
    level at which they reach their cap; the first that stays below it fixes the level of all
    the rest. All sizes zero give targets of zero. The windows run over one row per source.
    """
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((nth - 1) % len(weights) + 1).cast("int"))
    s = sizes.withColumn("_w", pick).withColumn("_cap", F.col("source_size") * float(cap))
    level = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    past = level.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    s = (s.withColumn("_rank", F.row_number().over(level))
         .withColumn("_full", F.coalesce(F.sum("_cap").over(past), F.lit(0.0)))
         .withColumn("_rest", F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(past), F.lit(0.0)))
         .withColumn("_level", (F.sum("source_size").over(every) * share - F.col("_full")) / F.col("_rest")))
    open_ = F.when(F.col("_cap") > F.col("_level") * F.col("_w"), F.struct("_rank", "_level"))
    s = s.withColumn("_at", F.min(open_).over(every))
    below = F.col("_at").isNotNull() & (F.col("_rank") >= F.col("_at._rank"))
    return s.select("source", "source_size",
                    F.when(below, F.col("_at._level") * F.col("_w")).otherwise(F.col("_cap")).alias("target"))


def copies(rows: DataFrame, source: str, expected: str, by: list[Column], seed: int = SEED) -> DataFrame:
    """``rows`` with ``copies``: systematic sampling of ``expected`` copies within ``source``.

    ``expected`` is a double of 0 or more (null: 0). The offset is a hash of seed and source.
    Repeated rows are rows of their own; a null source is a source.
    """
    unit = F.round(F.greatest(F.coalesce(F.col(expected), F.lit(0.0)), F.lit(0.0)) * _UNIT).cast("long")
    order = [c.alias(f"_order{i}") for i, c in enumerate(by)]
    keyed = boxed(rows, null_key(F.col(source).cast("string")).alias("_source"), unit.alias("_unit"), *order)
    t = ordered(keyed, [F.col("_source"), *[F.col(f"_order{i}") for i in range(len(by))]], "mix-order")
    t = with_prefix_sum(t, "_unit", "_sum", ["_source"])
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("_source"))), 1, 6), 16, 10).cast("long")
    low = F.col("_sum") + offset
    taken = F.shiftright(low + F.col("_unit"), _BITS) - F.shiftright(low, _BITS)
    return unboxed(t.withColumn("copies", taken), rows.columns, "copies")


def mix(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies`` for each row of ``docs``.

    Size is the number of words (null or blank text: 0). Documents above 1/``LARGE`` of their
    source's target are sampled first; the expectation of the others is what is left of the
    target over what is left of the source, so one long document in a small source is made up
    for. The narrow rows are written once; texts are read once and never moved.
    """
    size = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long")
    rows = written(docs.select("doc_id", "source", size.alias("size")), "mix-sizes")
    goal = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"))).withColumnRenamed("source", "_s")
    placed = rows.join(goal, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    large = F.col("size") * LARGE > F.col("target")
    mixed = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))))
    by = [F.col("size"), mixed, F.col("doc_id")]
    e = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    first = written(copies(placed.where(large).withColumn("expected", e), "source", "expected", by, seed), "mix-large")
    had = first.groupBy("source").agg(F.sum("size").alias("_size"), F.sum(F.col("copies") * F.col("size")).alias("_took"))
    had = had.withColumnRenamed("source", "_s")
    left = placed.where(~large).join(had, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    rest = F.col("source_size") - F.coalesce(F.col("_size"), F.lit(0))
    want = (F.col("target") - F.coalesce(F.col("_took"), F.lit(0))) / rest
    left = left.withColumn("expected", F.when(rest > 0, F.least(F.greatest(want, F.lit(0.0)), F.lit(float(CAP))))
                           .otherwise(0.0)).drop("_size", "_took")
    return first.unionByName(copies(left, "source", "expected", by, seed))


def mixed_documents(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; its columns stay as they are."""
    tagged = written(boxed(docs, F.monotonically_increasing_id().alias("_rid")), "mix-rows")
    row = F.col(ROW)
    chosen = mix(tagged.select(F.col("_rid").alias("doc_id"), row["source"].alias("source"), row["text"].alias("text")), seed)
    keep = chosen.where("copies > 0").select(F.col("doc_id").alias("_rid"), "copies")
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return unboxed(tagged.join(keep, "_rid").withColumn("_again", again), docs.columns)


def op9_mixing(spark, sf_dir: str) -> DataFrame:
    m = mix(documents(spark, sf_dir).select("doc_id", "source", "text"))
    return m.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"),
                    "copies", "source")


OP9_SQL = f"""
WITH rows AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size
  FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM rows GROUP BY source),
w AS (
  SELECT source, source_size, 2.0::DOUBLE * source_size AS cap,
         [5.0::DOUBLE, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3] AS wt
  FROM per),
lv AS (
  SELECT *, row_number() OVER o AS rk,
         (1.5::DOUBLE * (SELECT sum(source_size) FROM per)
            - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / ((SELECT sum(wt) FROM w)
            - coalesce(sum(wt) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM w WINDOW o AS (ORDER BY cap / wt, source ASC NULLS LAST)),
first_open AS (SELECT rk, level FROM lv WHERE cap > level * wt ORDER BY rk LIMIT 1),
goal AS (
  SELECT lv.source, source_size,
         CASE WHEN f.rk IS NOT NULL AND lv.rk >= f.rk THEN f.level * wt ELSE cap END AS target
  FROM lv LEFT JOIN first_open f ON true),
placed AS (
  SELECT r.doc_id, r.size, r.source, g.source_size, g.target, r.size * {LARGE} > g.target AS large,
         ('0x' || substr(md5('{SEED}:' || CASE WHEN r.source IS NULL THEN 'n' ELSE 's' || r.source END), 1, 6))::BIGINT AS off,
         md5('{SEED}:' || coalesce(r.doc_id::VARCHAR, '-')) AS mixed
  FROM rows r JOIN goal g ON r.source IS NOT DISTINCT FROM g.source),
unit1 AS (
  SELECT *, CASE WHEN source_size > 0 THEN round(target / source_size * {_UNIT}) ELSE 0 END::BIGINT AS u
  FROM placed WHERE large),
run1 AS (
  SELECT *, sum(u) OVER (PARTITION BY source ORDER BY size, mixed, doc_id
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS upto FROM unit1),
had AS (
  SELECT source, sum(size)::BIGINT AS sz, sum((((off + upto) >> {_BITS}) - ((off + upto - u) >> {_BITS})) * size)::BIGINT AS took
  FROM run1 GROUP BY source),
unit2 AS (
  SELECT p.*, CASE WHEN p.source_size - coalesce(h.sz, 0) > 0
    THEN round(least(greatest((p.target - coalesce(h.took, 0)) / (p.source_size - coalesce(h.sz, 0)), 0.0), {CAP}.0::DOUBLE) * {_UNIT})
    ELSE 0 END::BIGINT AS u
  FROM placed p LEFT JOIN had h ON p.source IS NOT DISTINCT FROM h.source WHERE NOT large),
run AS (
  SELECT * FROM run1 UNION ALL BY NAME
  SELECT *, sum(u) OVER (PARTITION BY source ORDER BY size, mixed, doc_id
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS upto FROM unit2)
SELECT doc_id, size, source_size, target, (((off + upto) >> {_BITS}) - ((off + upto - u) >> {_BITS})) * size AS taken,
       ((off + upto) >> {_BITS}) - ((off + upto - u) >> {_BITS}) AS copies, source
FROM run
"""
