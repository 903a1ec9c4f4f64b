"""Global positions and prefix sums over a sorted table, without one task seeing all rows.

The rows are dealt by range and sorted inside each partition, and the result is written to the
shared folder, so row numbers stay as they are when an executor is lost. A partition's number
and a row's place in it come from ``monotonically_increasing_id``; what lies before a partition
is a sum over one row per partition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brandpulse.llm.common import partitions, shared_dir

_BITS = 33
_MASK = (1 << _BITS) - 1


def ordered(df: DataFrame, by: list[Column], name: str) -> DataFrame:
    """``df`` sorted by ``by`` over all partitions, with ``_pid`` (partition) and ``_row``.

    Equal keys are dealt out by the place at which they were read, so that one key that holds
    most rows still spreads over many partitions.
    """
    return ordered_path(df, by, shared_dir(df.sparkSession, name))


def ordered_path(df: DataFrame, by: list, path: str, codec: str = "snappy",
                 then: Callable[[DataFrame], DataFrame] = lambda d: d) -> DataFrame:
    """:func:`ordered`, written to ``path``; ``then`` maps the sorted rows one to one, in order."""
    spark = df.sparkSession
    keyed = df.select("*", *[(F.col(c) if isinstance(c, str) else c).alias(f"_by{i}") for i, c in enumerate(by)],
                      F.monotonically_increasing_id().alias("_tie"))
    keys = [f"_by{i}" for i in range(len(by))] + ["_tie"]
    dealt = keyed.repartitionByRange(partitions(spark), *keys).sortWithinPartitions(*keys)
    rows = then(dealt.select(*df.columns))
    cols = rows.columns
    out = rows.select("*", F.monotonically_increasing_id().alias("_at"))
    out.write.option("compression", codec).parquet(path)
    return spark.read.schema(out.schema).parquet(path).select(
        *cols, F.shiftright("_at", _BITS).cast("int").alias("_pid"), F.col("_at").bitwiseAND(_MASK).alias("_row"))


def with_position(t: DataFrame, out: str = "_pos") -> DataFrame:
    """Adds the 0-based position of each row of an :func:`ordered` table."""
    sizes = t.groupBy("_pid").agg(F.count("*").alias("_n"))
    # one row per partition of the sorted table
    before = sizes.select("_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_before"))
    return t.join(F.broadcast(before), "_pid").withColumn(out, F.col("_before") + F.col("_row")).drop("_before")


def with_prefix_sum(t: DataFrame, value: str, out: str, within: list[str] | None = None) -> DataFrame:
    """Adds the sum of ``value`` over the rows before each row, per ``within`` (non-null keys)."""
    keys = within or []
    here = Window.partitionBy("_pid", *keys).orderBy("_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = t.groupBy("_pid", *keys).agg(F.sum(value).alias("_s"))
    over = Window.partitionBy(*keys).orderBy("_pid") if keys else Window.orderBy("_pid")
    before = sums.select("_pid", *keys, (F.sum("_s").over(over) - F.col("_s")).alias("_before"))
    local = t.withColumn("_local", F.sum(value).over(here) - F.col(value))
    joined = local.join(before, ["_pid", *keys])
    return joined.withColumn(out, F.col("_before") + F.col("_local")).drop("_before", "_local")
