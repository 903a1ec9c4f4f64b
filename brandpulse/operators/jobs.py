"""Maintenance jobs: hourly roll-up, sentiment-shift alerts, daily topic stats, view refresh.

Each job is a pure ``DataFrame -> DataFrame`` function (what would be written); the
writers in :mod:`brandpulse.sources.tables` apply append / upsert / overwrite.
"""

from __future__ import annotations

import datetime as _dt
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brandpulse import schemas as S
from brandpulse.functions import scoring as SC
from brandpulse.functions import time as TM


# ------------------------------------------------------------------------------------ A6
def hourly_rollup(sentiment: DataFrame, as_of, lookback_hours: float = 2, align: bool = True,
                  time_col: str = "created_at") -> DataFrame:
    """Count, avg (3 dp), min, max per (hour, label, source) for complete hours in
    ``[as_of - lookback, date_trunc('hour', as_of))``.

    Q12: with ``align=True`` (default) the lower bound is truncated to the hour too, so a
    re-run never recomputes a partial oldest hour; ``align=False`` reproduces the original
    unaligned bound.
    """
    dtype = TM.col_type(sentiment, time_col)
    a = TM.as_of_for(sentiment, time_col, as_of)
    lo = TM.hours_before(a, lookback_hours)
    if align:
        lo = TM.truncate("hour", lo, dtype)
    hi = TM.truncate("hour", a, dtype)
    c = F.col(time_col)
    base = sentiment.filter((c >= lo) & (c < hi))
    return (base.groupBy(TM.hour_bucket(base, time_col).alias("hour_bucket"), "sentiment_label", "source")
            .agg(F.count(F.lit(1)).alias("count"),
                 F.round(F.avg("sentiment_score"), 3).alias("avg_sentiment_score"),
                 F.min("sentiment_score").alias("min_sentiment_score"),
                 F.max("sentiment_score").alias("max_sentiment_score"))
            .select("hour_bucket", "sentiment_label", "count", "avg_sentiment_score",
                    "min_sentiment_score", "max_sentiment_score", "source"))


# ------------------------------------------------------------------------------------ A7
DEFAULT_RECENT = (60, 30)      # minutes before as_of: [as_of - 60m, as_of - 30m)
DEFAULT_BASELINE = (120, 60)   # [as_of - 120m, as_of - 60m)


def _shift_filter(raw_pct: Column, threshold: float, direction: str) -> Column:
    if direction == "both":       # Q9 parity: rises are admitted too
        return F.abs(raw_pct) > F.lit(threshold)
    if direction == "drop":
        return raw_pct > F.lit(threshold)
    if direction == "rise":
        return raw_pct < F.lit(-threshold)
    raise ValueError(f"direction must be 'drop', 'rise' or 'both', got {direction!r}")


def _alerts_from_band_stats(g: DataFrame, detected_at: Column, threshold: float, direction: str,
                            details: bool) -> DataFrame:
    """Band statistics per (.., topic) -> alert rows. ``g`` has topic, n_recent, n_base,
    avg_recent, avg_base. Q11: a zero baseline mean gives NULL, never an error or alert."""
    raw = F.try_divide(F.col("avg_base") - F.col("avg_recent"), F.col("avg_base")) * F.lit(100.0)
    g = (g.filter((F.col("n_recent") > 0) & (F.col("n_base") > 0))   # inner-join semantics
          .withColumn("_raw", raw)
          .filter(_shift_filter(F.col("_raw"), threshold, direction))
          .withColumn("pct_change", F.round("_raw", 2)))
    cols = [
        detected_at.alias("detected_at"),
        F.lit(S.ANOMALY_TYPE_DROP).alias("anomaly_type"),
        SC.shift_severity(F.col("pct_change")).alias("severity"),
        F.abs("pct_change").alias("sentiment_drop_percentage"),
        F.col("topic").alias("affected_topic"),
        F.concat(F.lit("Significant drop in "), F.col("topic"), F.lit(" sentiment")).alias("description"),
        (F.col("n_recent") * F.col("n_base")).alias("affected_records"),   # Q10: pair count
        F.lit(None).cast("string").alias("recommended_action"),
        F.lit(False).alias("acknowledged"),
    ]
    if details:
        cols += [F.col("pct_change"), F.col("n_recent").alias("recent_count"),
                 F.col("n_base").alias("baseline_count")]
    return g.select(*cols)


def detect_shift(topic: DataFrame, as_of, alerts: DataFrame | None = None,
                 recent: tuple[float, float] = DEFAULT_RECENT, baseline: tuple[float, float] = DEFAULT_BASELINE,
                 threshold: float = S.SHIFT_THRESHOLD_PCT, direction: str = "drop",
                 cooldown_minutes: float = S.ALERT_COOLDOWN_MINUTES, time_col: str = "created_at",
                 details: bool = False) -> DataFrame:
    """Per-topic percent change of mean score between a recent and a baseline band.

    The original self-joins the topic table on topic (J2) and averages over the pair
    product; since each recent row repeats ``n_base`` times and each baseline row
    ``n_recent`` times, pair averages equal plain averages and the pair count is
    ``n_recent * n_base``. So one scan, one aggregation per topic (O(n) instead of
    O(n1*n2) rows; map-side combine absorbs a hot topic).

    J3: topics with an alert in ``[as_of - cooldown, as_of]`` (from ``alerts``) are skipped;
    alerts after ``as_of`` don't count, as in a run of that time.
    """
    rb = TM.in_band(topic, time_col, as_of, *recent)
    bb = TM.in_band(topic, time_col, as_of, *baseline)
    score = F.col("sentiment_score")
    g = (topic.filter(F.col("topic").isNotNull() & (rb | bb))
         .groupBy("topic")
         .agg(F.count_if(rb).alias("n_recent"), F.count_if(bb).alias("n_base"),
              F.avg(F.when(rb, score)).alias("avg_recent"), F.avg(F.when(bb, score)).alias("avg_base")))
    out = _alerts_from_band_stats(g, TM.as_of_for(topic, time_col, as_of), threshold, direction, details)
    if alerts is not None:
        a = TM.as_of_for(alerts, "detected_at", as_of)
        recent_alerts = (alerts.filter((F.col("detected_at") >= TM.minutes_before(a, cooldown_minutes))
                                       & (F.col("detected_at") <= a))
                         .select(F.col("affected_topic")).distinct())
        out = out.join(recent_alerts, "affected_topic", "left_anti")
    return out


def _epoch_micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def detect_shift_series(topic: DataFrame, start, end, step_minutes: float = 60,
                        alerts: DataFrame | None = None,
                        recent: tuple[float, float] = DEFAULT_RECENT, baseline: tuple[float, float] = DEFAULT_BASELINE,
                        threshold: float = S.SHIFT_THRESHOLD_PCT, direction: str = "drop",
                        cooldown_minutes: float = S.ALERT_COOLDOWN_MINUTES, time_col: str = "created_at",
                        details: bool = False) -> DataFrame:
    """Backfill: the result of :func:`detect_shift` run at every ``as_of`` on the grid
    ``start, start + step, ..., <= end``, in one job.

    The range that any band can reach is a plain predicate, so it is pushed to the scan.
    Rows are then combined to (topic, bucket), a bucket being as wide as the greatest common
    divisor of the step and the band limits; every band is a run of whole buckets. Only
    buckets are routed to the grid points whose bands contain them — no cross join with the grid.
    Alerts already in ``alerts`` suppress the grid points within ``cooldown`` after them. With
    ``step <= cooldown`` runs suppress each other too: of a topic's candidates, in time order, one is
    kept if the last one kept is further back than the cool-down, as in runs made one after another.
    """
    dtype = TM.col_type(topic, time_col)
    s0 = TM._as_text(start)
    step = int(round(step_minutes * 60e6))          # microseconds
    start_c = TM.ts_lit(s0, dtype)
    n_points = int((_dt.datetime.fromisoformat(TM._as_text(end)) - _dt.datetime.fromisoformat(s0)).total_seconds()
                   * 1e6 // step)
    width = math.gcd(step, *[int(round(m * 60e6)) for m in (*recent, *baseline)])
    far, near = max(recent[0], baseline[0]), min(recent[1], baseline[1])
    last = TM.ts_lit((_dt.datetime.fromisoformat(s0) + _dt.timedelta(microseconds=n_points * step)), dtype)
    c = F.col(time_col)
    score = F.col("sentiment_score")
    at = F.floor((_epoch_micros(c) - _epoch_micros(start_c)) / F.lit(width)).cast("long")
    buckets = (topic.filter(F.col("topic").isNotNull() & (c >= TM.minutes_before(start_c, far))
                            & (c < TM.minutes_before(last, near)))
               .groupBy("topic", at.alias("_at"))
               .agg(F.count(F.lit(1)).alias("_n"), F.sum(score).alias("_s"), F.count(score).alias("_c")))

    def points(band):   # grid indexes k with  start + k*step - band[0] <= bucket < start + k*step - band[1]
        rel = F.col("_at") * F.lit(width)
        lo = F.floor((rel + F.lit(int(round(band[1] * 60e6)))) / F.lit(step)) + F.lit(1)
        hi = F.floor((rel + F.lit(int(round(band[0] * 60e6)))) / F.lit(step))
        lo = F.greatest(lo, F.lit(0)).cast("int")
        hi = F.least(hi, F.lit(n_points)).cast("int")
        return F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))

    rows = buckets.select(
        "topic", "_n", "_s", "_c",
        F.transform(points(recent), lambda k: F.struct(k.alias("k"), F.lit(True).alias("r"))).alias("_r"),
        F.transform(points(baseline), lambda k: F.struct(k.alias("k"), F.lit(False).alias("r"))).alias("_b"),
    ).select("topic", "_n", "_s", "_c", F.explode(F.concat("_r", "_b")).alias("_p"))
    rb = F.col("_p.r")

    def total(col, cond):
        return F.coalesce(F.sum(F.when(cond, F.col(col))), F.lit(0))

    g = (rows.groupBy(F.col("_p.k").alias("k"), "topic")
         .agg(total("_n", rb).alias("n_recent"), total("_n", ~rb).alias("n_base"),
              F.try_divide(F.sum(F.when(rb, F.col("_s"))), total("_c", rb)).alias("avg_recent"),
              F.try_divide(F.sum(F.when(~rb, F.col("_s"))), total("_c", ~rb)).alias("avg_base")))
    detected = start_c + F.make_dt_interval(secs=(F.col("k").cast("long") * F.lit(step) / F.lit(1_000_000))
                                            .cast("decimal(18,6)"))
    out = _alerts_from_band_stats(g.withColumn("detected_at_", detected), F.col("detected_at_"), threshold,
                                  direction, details)
    if alerts is not None:
        # An existing alert at d suppresses grid points g with d >= g - cooldown, d <= g.
        a = alerts.select("affected_topic", "detected_at")
        a_rel = _epoch_micros(F.col("detected_at")) - _epoch_micros(TM.ts_lit(s0, TM.col_type(alerts, "detected_at")))
        lo = F.greatest(F.ceil(a_rel / F.lit(step)), F.lit(0)).cast("int")
        hi = F.least(F.floor((a_rel + F.lit(int(cooldown_minutes * 60e6))) / F.lit(step)),
                     F.lit(n_points)).cast("int")
        blocked = (a.filter(lo <= hi)
                   .select("affected_topic", F.explode(F.sequence(lo, hi)).alias("k"))
                   .select("affected_topic", (start_c + F.make_dt_interval(
                       secs=(F.col("k").cast("long") * F.lit(step) / F.lit(1_000_000)).cast("decimal(18,6)")))
                           .alias("detected_at"))
                   .distinct())
        out = out.join(blocked, ["affected_topic", "detected_at"], "left_anti")
    return _kept_in_turn(out, cooldown_minutes) if step_minutes <= cooldown_minutes else out


def _kept_in_turn(candidates: DataFrame, cooldown_minutes: float) -> DataFrame:
    """The alerts that runs made one after another would raise: a fold over each topic's candidates,
    which are no more than the grid has points."""
    row = F.struct("detected_at", *[c for c in candidates.columns if c not in ("detected_at", "affected_topic")])
    by = candidates.groupBy("affected_topic").agg(F.array_sort(F.collect_list(row)).alias("_rows"))
    kind = by.schema["_rows"].dataType
    gap = F.lit(_dt.timedelta(minutes=cooldown_minutes))
    none = F.array().cast(kind)

    def step(kept, x):
        last = F.try_element_at(kept, F.lit(-1))["detected_at"]
        return F.when((F.size(kept) == 0) | (x["detected_at"] > last + gap), F.concat(kept, F.array(x))).otherwise(kept)

    kept = by.select("affected_topic", F.explode(F.aggregate("_rows", none, step)).alias("_r"))
    return kept.select("affected_topic", "_r.*").select(*candidates.columns)


# ------------------------------------------------------------------------------------ A12 W3
def topic_daily_stats(topic: DataFrame, eps: float = 0.05, time_col: str = "created_at",
                      as_of=None, days: float | None = None) -> DataFrame:
    """A12 + W3 (+ Q15): per (day, topic) mention count, avg sentiment (3 dp) and trend.

    Trend rule (ours; the table only names the values): change vs the topic's previous
    day > +eps IMPROVING, < -eps DECLINING, else STABLE; a topic's first day is STABLE.
    The window runs on the daily aggregate (days x topics rows), never on base rows.
    """
    base = topic
    if as_of is not None and days is not None:
        base = base.filter(TM.within_last(base, time_col, as_of, days * 24))
    g = (base.groupBy(F.to_date(time_col).alias("date_bucket"), "topic")
         .agg(F.count(F.lit(1)).alias("mention_count"),
              F.round(F.avg("sentiment_score"), 3).alias("avg_sentiment")))
    prev = F.lag("avg_sentiment").over(Window.partitionBy("topic").orderBy("date_bucket"))
    delta = F.col("avg_sentiment") - prev
    trend = (F.when(delta > F.lit(eps), F.lit("IMPROVING"))
              .when(delta < F.lit(-eps), F.lit("DECLINING"))
              .otherwise(F.lit("STABLE")))
    return g.withColumn("sentiment_trend", trend)


# ------------------------------------------------------------------------------------ P3
def stamp(df: DataFrame, column: str, as_of, dtype: T.DataType | None = None) -> DataFrame:
    """Add a fixed clock column (``computed_at``, ``analyzed_at``...)."""
    return df.withColumn(column, TM.ts_lit(as_of, dtype or T.TimestampType()))
