"""Data quality: table constraints as operators.

``constraint_report`` evaluates every row-level rule (NOT NULL, length cap, enum domain)
in **one** aggregation over the table, and key rules (UNIQUE, foreign key) as one
aggregation / anti join each; the result is a small table ``(rule, column_name, violations)``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    kind: str                      # not_null | max_length | in_set | unique | foreign_key
    columns: tuple[str, ...]
    arg: object = None             # max length, allowed values, or (parent DataFrame, parent column)

    @property
    def label(self) -> str:
        return ",".join(self.columns)


def not_null(col: str) -> Rule:
    return Rule("not_null", (col,))


def max_length(col: str, n: int) -> Rule:
    return Rule("max_length", (col,), int(n))


def in_set(col: str, values) -> Rule:
    return Rule("in_set", (col,), tuple(values))


def unique(*cols: str) -> Rule:
    return Rule("unique", tuple(cols))


def foreign_key(col: str, parent: DataFrame, parent_col: str | None = None) -> Rule:
    return Rule("foreign_key", (col,), (parent, parent_col or col))


def _row_violation(r: Rule) -> Column:
    c = F.col(r.columns[0])
    if r.kind == "not_null":
        return c.isNull()
    if r.kind == "max_length":
        return F.length(c) > F.lit(r.arg)
    if r.kind == "in_set":
        return c.isNotNull() & ~c.isin(list(r.arg))
    raise ValueError(r.kind)


def orphans(child: DataFrame, parent: DataFrame, col: str, parent_col: str | None = None) -> DataFrame:
    """Child rows whose key has no parent row (NULL keys are not orphans, as in SQL)."""
    pk = parent.select(F.col(parent_col or col).alias(col)).distinct()
    return child.filter(F.col(col).isNotNull()).join(pk, col, "left_anti")


def duplicate_keys(df: DataFrame, cols) -> DataFrame:
    """Keys that occur more than once, with their row counts (NULL keys are exempt)."""
    cols = list(cols)
    nn = None
    for c in cols:
        nn = F.col(c).isNotNull() if nn is None else (nn & F.col(c).isNotNull())
    return df.filter(nn).groupBy(*cols).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def constraint_report(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per rule with the number of violating rows."""
    row_rules = [r for r in rules if r.kind in ("not_null", "max_length", "in_set")]
    parts = []
    if row_rules:
        agg = df.agg(*[F.count_if(_row_violation(r)).alias(f"_r{i}") for i, r in enumerate(row_rules)])
        stack = ", ".join(f"'{r.kind}', '{r.label}', _r{i}" for i, r in enumerate(row_rules))
        parts.append(agg.selectExpr(f"stack({len(row_rules)}, {stack}) AS (rule, column_name, violations)"))
    for r in rules:
        if r.kind == "unique":
            d = duplicate_keys(df, r.columns)
            parts.append(d.agg(F.coalesce(F.sum(F.col("rows") - F.lit(1)), F.lit(0)).cast("long").alias("violations"))
                         .select(F.lit("unique").alias("rule"), F.lit(r.label).alias("column_name"), "violations"))
        elif r.kind == "foreign_key":
            parent, pcol = r.arg
            o = orphans(df, parent, r.columns[0], pcol)
            parts.append(o.agg(F.count(F.lit(1)).alias("violations"))
                         .select(F.lit("foreign_key").alias("rule"), F.lit(r.label).alias("column_name"), "violations"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def violations(df: DataFrame, rules: list[Rule], key: str) -> DataFrame:
    """One row ``(rule, key, value)`` per violation; ``key`` names the rows of ``df``.

    All row rules are one array per row, emptied of what holds before it is exploded: any number of
    rules is one pass over the table. A UNIQUE rule gives a row per repeated key (``value``: its number of
    rows), a foreign key one per orphan.
    """
    text = lambda c: F.col(c).cast("string")
    parts = []
    row_rules = [r for r in rules if r.kind in ("not_null", "max_length", "in_set")]
    if row_rules:
        every = F.array(*[F.when(_row_violation(r), F.struct(F.lit(f"{r.kind}({r.label})").alias("rule"), text(key).alias("key"),
                                                             text(r.columns[0]).alias("value"))) for r in row_rules])
        parts.append(df.select(F.explode(F.array_compact(every)).alias("_v")).select("_v.*"))
    for r in rules:
        name = F.lit(f"{r.kind}({r.label})").alias("rule")
        if r.kind == "unique":
            parts.append(duplicate_keys(df, r.columns).select(name, F.concat_ws("|", *[text(c) for c in r.columns]).alias("key"),
                                                              F.col("rows").cast("string").alias("value")))
        elif r.kind == "foreign_key":
            parent, pcol = r.arg
            parts.append(orphans(df, parent, r.columns[0], pcol).select(name, text(key).alias("key"), text(r.columns[0]).alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def apply_defaults(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Fill NULLs with column defaults on write (a server default never applies to an
    explicit NULL; this does, which is what the tables' NOT NULL columns need)."""
    return df.select(*[F.coalesce(F.col(c), defaults[c]).alias(c) if c in defaults else F.col(c)
                       for c in df.columns])
