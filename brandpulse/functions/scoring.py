"""CASE-style column expressions: labels, bands, severities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from brandpulse import schemas as S


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def label_from_compound(compound) -> Column:
    """compound >= 0.05 POSITIVE, <= -0.05 NEGATIVE, else NEUTRAL (both ends inclusive)."""
    c = _c(compound)
    return (F.when(c >= F.lit(S.COMPOUND_POSITIVE_AT), F.lit(S.POSITIVE))
             .when(c <= F.lit(S.COMPOUND_NEGATIVE_AT), F.lit(S.NEGATIVE))
             .otherwise(F.lit(S.NEUTRAL)))


def rescale_compound(compound) -> Column:
    """Compound in [-1, 1] -> score in [0, 1]."""
    return (_c(compound) + F.lit(1.0)) / F.lit(2.0)


def compound_from_score(score) -> Column:
    return F.lit(2.0) * _c(score) - F.lit(1.0)


def is_blank(text) -> Column:
    """U3 guard: null, empty or whitespace-only text."""
    return F.coalesce(F.trim(_c(text)), F.lit("")) == F.lit("")


def shift_severity(pct) -> Column:
    """severity of a percent change (strict '>' cuts, LOW otherwise)."""
    p = _c(pct)
    out = None
    for cut, name in S.SHIFT_SEVERITY_CUTS:
        out = F.when(p > F.lit(cut), F.lit(name)) if out is None else out.when(p > F.lit(cut), F.lit(name))
    return out.otherwise(F.lit("LOW"))


def mention_severity(score) -> Column:
    """< 0.2 CRITICAL, < 0.3 HIGH, else MEDIUM."""
    s = _c(score)
    return (F.when(s < F.lit(0.2), F.lit("CRITICAL"))
             .when(s < F.lit(0.3), F.lit("HIGH"))
             .otherwise(F.lit("MEDIUM")))


def score_band(score) -> Column:
    """F11 (chart colour): > 0.6 good, < 0.4 bad, else mid (0.4 itself is mid)."""
    s = _c(score)
    return F.when(s > F.lit(0.6), F.lit("good")).when(s < F.lit(0.4), F.lit("bad")).otherwise(F.lit("mid"))


def kpi_band(score) -> Column:
    """F11 (KPI badge): > 0.6 good, > 0.4 mid, else bad (0.4 itself is bad)."""
    s = _c(score)
    return F.when(s > F.lit(0.6), F.lit("good")).when(s > F.lit(0.4), F.lit("mid")).otherwise(F.lit("bad"))


def severity_rank(severity) -> Column:
    """Q25 fix: rank all four severities (LOW 1 .. CRITICAL 4); unknown -> 0."""
    s = _c(severity)
    out = F.when(s == F.lit(S.SEVERITIES[0]), F.lit(1))
    for i, name in enumerate(S.SEVERITIES[1:], start=2):
        out = out.when(s == F.lit(name), F.lit(i))
    return out.otherwise(F.lit(0))


def alert_band(severity) -> Column:
    """F22 with the Q25 fix: HIGH and CRITICAL -> red, MEDIUM -> amber, else green."""
    r = severity_rank(severity)
    return F.when(r >= F.lit(3), F.lit("red")).when(r == F.lit(2), F.lit("amber")).otherwise(F.lit("green"))


def confidence_of(pos, neu, neg) -> Column:
    """F8: the largest of the three shares."""
    return F.greatest(_c(pos), _c(neu), _c(neg))


def round_binary(c, digits: int) -> Column:
    """Round half away from zero on the binary value (``x * 10^d`` then nearest integer),
    as C's ``round`` and most SQL engines do; Spark's ``round`` instead rounds the shortest
    decimal string, which differs on values just below a tie. ``+ 0.0`` folds -0.0 to 0.0."""
    x = _c(c)
    m = F.lit(float(10 ** digits))
    return F.signum(x) * F.floor(F.abs(x) * m + F.lit(0.5)) / m + F.lit(0.0)
