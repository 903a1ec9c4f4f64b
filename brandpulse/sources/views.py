"""Views over a sliding window that are refreshed by what entered and what left it.

What a group counts in one whole hour is a mergeable partial: rows, exact sum of scores, scored rows, and
rows above and below the score marks. A view keeps the totals of the whole hours in its window. A refresh
reads the source for the hours that are new, the stored partials of those that left, adds the one and takes
away the other, and reads the source once more for the broken hours at both ends of the window. So its cost
follows the step of the clock, not the length of the window.

Every refresh publishes its totals and its view as folders of their own and names them in a manifest, the
pointer that readers follow: none sees a half-written view, and one that has an older view open keeps it. Rows
that arrive later for an hour that is folded are seen by a refresh with ``rebuild=True``.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brandpulse.functions import time as TM
from brandpulse.sources import layout as LY

_MEASURES = ("n", "total", "scored", "high", "low")
_HOUR = _dt.timedelta(hours=1)
_EPOCH = _dt.datetime(1970, 1, 1)


@dataclass(frozen=True)
class SlidingView:
    key: str
    hours: int
    time_col: str = "created_at"
    score_col: str = "sentiment_score"
    high: float = 0.6
    low: float = 0.4

    # -------------------------------------------------------------------------------- partials
    def _between(self, source: DataFrame, low: _dt.datetime, high: _dt.datetime, closed: bool = False) -> Column:
        kind = TM.col_type(source, self.time_col)
        c, day = F.col(self.time_col), f"{self.time_col}_day"
        inside = (c >= TM.ts_lit(low, kind)) & ((c <= TM.ts_lit(high, kind)) if closed else (c < TM.ts_lit(high, kind)))
        return inside & F.col(day).between(F.lit(low.date()), F.lit(high.date())) if day in source.columns else inside

    def _counted(self, rows: DataFrame, *by) -> DataFrame:
        """Measures per key; sums are decimal, so that what is added can be taken away again exactly."""
        score = F.col(self.score_col)
        return rows.groupBy(*by, F.col(self.key).alias("key")).agg(
            F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(score.cast("decimal(18,15)")), F.lit(0)).cast("decimal(38,15)").alias("total"),
            F.count(score).alias("scored"), F.count_if(score > self.high).alias("high"), F.count_if(score < self.low).alias("low"))

    def _hourly(self, source: DataFrame, low: _dt.datetime, high: _dt.datetime) -> DataFrame:
        hour = F.floor(F.unix_micros(F.col(self.time_col).cast("timestamp")) / 3_600_000_000).cast("int").alias("h")
        return self._counted(source.where(self._between(source, low, high)), hour)

    def stored_partials(self, spark: SparkSession, root: str, low: int, high: int) -> DataFrame | None:
        """The stored partials of the hours ``low`` to ``high`` - 1 (since 1970), from their folders alone."""
        folders = [f"{root}/partials/h={h}" for h in LY.numbered(spark, f"{root}/partials", "h") if low <= h < high]
        return spark.read.parquet(*folders) if folders else None

    def _store(self, partials: DataFrame, root: str, hours: range) -> DataFrame:
        """Publishes each hour's partials; hours without rows have no folder."""
        spark = partials.sparkSession
        stage = f"{root}/_staged/partials-{uuid.uuid4().hex[:12]}"
        partials.repartition("h").write.partitionBy("h").parquet(stage)
        fs, _ = LY._fs(spark, root)
        path = spark._jvm.org.apache.hadoop.fs.Path
        fs.mkdirs(path(f"{root}/partials"))
        for h in LY.numbered(spark, stage, "h"):
            if not LY.exists(spark, f"{root}/partials/h={h}"):
                fs.rename(path(f"{stage}/h={h}"), path(f"{root}/partials/h={h}"))
        found = self.stored_partials(spark, root, hours.start, hours.stop)
        return partials.drop("h").limit(0) if found is None else found

    # -------------------------------------------------------------------------------- refresh
    def refresh(self, source: DataFrame, root: str, as_of, rebuild: bool = False) -> int:
        """Publishes the view of the window that ends at ``as_of`` and returns its version."""
        spark, root = source.sparkSession, root.rstrip("/")
        end = _dt.datetime.fromisoformat(TM._as_text(as_of))
        start = end - _HOUR * self.hours
        last = end.replace(minute=0, second=0, microsecond=0)
        first = start.replace(minute=0, second=0, microsecond=0)
        first += _HOUR if first < start else _dt.timedelta()
        lo, hi = (first - _EPOCH) // _HOUR, (last - _EPOCH) // _HOUR
        version, was = _pointer(spark, root)
        parts = []
        if was is None or rebuild or lo >= was.hi or hi < was.hi or lo < was.lo:
            # the first refresh, or one that shares no hours with the last: the window as it is
            stored = f"{root}/rebuilt-{uuid.uuid4().hex[:8]}" if rebuild else root
            parts.append(self._store(self._hourly(source, first, last), stored, range(lo, hi)))
        else:
            stored = was.partials
            parts.append(spark.read.parquet(was.totals))
            if hi > was.hi:
                parts.append(self._store(self._hourly(source, _EPOCH + _HOUR * was.hi, last), stored, range(was.hi, hi)))
            gone = self.stored_partials(spark, stored, was.lo, lo)
            if gone is not None:
                parts.append(gone.select("key", *[(-F.col(m)).alias(m) for m in _MEASURES]))
        totals = _summed(parts).where("n > 0")
        folder = f"{root}/totals/{version + 1}-{uuid.uuid4().hex[:8]}"
        LY.publish(totals, folder)
        ends = source.where(self._between(source, start, first) | self._between(source, last, end, closed=True))
        view = _summed([spark.read.parquet(folder), self._counted(ends)]).where("n > 0").select(
            F.col("key").alias(self.key), F.col("n").alias("mentions"), F.round(F.col("total").cast("double") / F.col("scored"), 3).alias("avg_sentiment"),
            F.col("high").alias("positive_mentions"), F.col("low").alias("negative_mentions"),
            TM.ts_lit(as_of, TM.col_type(source, self.time_col)).alias("computed_at"))
        shown = f"{root}/view/{version + 1}-{uuid.uuid4().hex[:8]}"
        LY.publish(view, shown)
        row = spark.createDataFrame([(lo, hi, folder, shown, stored)], _POINTER).coalesce(1)
        if not LY.publish(row, f"{root}/pointer/version={version + 1}"):
            raise RuntimeError("another refresh came first; its view holds")
        return version + 1


_POINTER = "lo int, hi int, totals string, view string, partials string"


def _summed(parts: list[DataFrame]) -> DataFrame:
    rows = parts[0].select("key", *_MEASURES)
    for p in parts[1:]:
        rows = rows.unionByName(p.select("key", *_MEASURES))
    return rows.groupBy("key").agg(*[F.sum(m).cast("decimal(38,15)" if m == "total" else "long").alias(m) for m in _MEASURES])


def _pointer(spark: SparkSession, root: str):
    versions = LY.numbered(spark, f"{root}/pointer", "version")
    return (versions[-1], spark.read.schema(_POINTER).parquet(f"{root}/pointer/version={versions[-1]}").first()) if versions else (0, None)


def read_view(spark: SparkSession, root: str) -> DataFrame | None:
    """The newest view, or None before the first refresh."""
    _, row = _pointer(spark, root.rstrip("/"))
    return None if row is None else spark.read.parquet(row.view)
