"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seeded hash within each source; the row of rank r among n has the
fractional rank (r + 1/2) / n. All rows sorted by it carry the mixture of the whole table in
any stretch, and cutting that order into equal runs gives shards of one mixture whose counts
differ by one at most. Texts never move: only ids, sizes and hashes are sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brandpulse.llm.common import ROW, boxed, documents, null_key, unboxed, written
from brandpulse.llm.ordering import ordered, with_position

SEED = 20_240_601
SHARDS = 8


def interleave(rows: DataFrame, stratum: Column, key: Column, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``rows`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0 in a shard).

    A null stratum is a source of its own; equal keys keep a fixed order within a written
    table; an empty table gives no rows; input columns of these names are replaced. With fewer rows than shards some shards stay empty.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    keyed = boxed(rows, null_key(stratum.cast("string")).alias("_stratum"),
                  F.xxhash64(F.lit(seed), key).alias("_mix"), key.alias("_key"))
    t = with_position(ordered(keyed, [F.col("_stratum"), F.col("_mix"), F.col("_key")], "interleave-rank"))
    strata = t.groupBy("_stratum").agg(F.count("*").alias("_n"), F.min("_pos").alias("_first"))
    ranked = t.join(strata, "_stratum").withColumn(
        "_frac", (F.col("_pos") - F.col("_first") + F.lit(0.5)) / F.col("_n"))
    by = [F.col("_frac"), F.col("_stratum"), F.col("_mix"), F.col("_key")]
    line = with_position(ordered(ranked.select(ROW, "_frac", "_stratum", "_mix", "_key"), by, "interleave-cut"))
    total = line.agg(F.count("*").alias("_total"))
    shard = F.expr(f"(_pos * {shards}) div _total")
    first = F.expr(f"(shard * _total + {shards - 1}) div {shards}")
    placed = (line.join(F.broadcast(total)).withColumn("shard", shard).withColumn("slot", F.col("_pos") - first)
              .withColumn("shard", F.col("shard").cast("int")))
    return unboxed(placed, rows.columns, "shard", "slot")


def write_shards(rows: DataFrame, stratum: str, key: str, path: str, shards: int = SHARDS, seed: int = SEED) -> None:
    """Writes whole rows as one folder per shard, each file sorted by slot; ``shard`` and ``slot`` replace
    input columns of those names.

    Only the stratum, the key and a hash of each row are sorted. Rows meet their places by key, hash and, as rows
    may repeat, a number among equals; so every row is written once, whatever its key."""
    equal = Window.partitionBy("_k", "_h").orderBy(F.lit(0))
    told = boxed(rows, F.col(f"`{stratum}`").alias("_s"), F.col(f"`{key}`").alias("_k"), F.xxhash64(F.struct(*[F.col(f"`{c}`") for c in rows.columns])).alias("_h"))
    narrow = written(told.select("_s", "_k", "_h"), "interleave-rows")
    placed = written(interleave(narrow, F.col("_s"), F.col("_k"), shards, seed), "interleave-placed")
    places = placed.withColumn("_nth", F.row_number().over(equal)).alias("p")
    whole = told.withColumn("_nth", F.row_number().over(equal)).alias("w")
    same = F.col("w._k").eqNullSafe(F.col("p._k")) & (F.col("w._h") == F.col("p._h")) & (F.col("w._nth") == F.col("p._nth"))
    out = unboxed(whole.join(places, same).select(ROW, "shard", "slot"), rows.columns, "shard", "slot")
    (out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))


def op6_sharding(spark, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = written(documents(spark, sf_dir).select(
        "doc_id", "source", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "utf-8")).alias("text_crc32")), "op6-rows")
    placed = interleave(rows, F.col("source"), F.col("doc_id"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "source")
