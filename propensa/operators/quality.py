"""Data-quality checks (Q1-Q9).  Each check returns the failing rows; an
empty result is a pass.

The suite folds every row-level check on one table into a single
aggregation pass (``count_if`` per check), so a table is scanned once
however many checks it has; uniqueness is one ``groupBy`` and a foreign
key one left-anti join.  Only the per-check counts (a handful of rows)
ever leave the executors.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unique(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once (NULL keys are the not_null check's)."""
    return (df.filter(F.col(key).isNotNull()).groupBy(key)
            .agg(F.count(F.lit(1)).alias("row_count"))
            .filter(F.col("row_count") > 1))


def not_null(df: DataFrame, column: str, key: str = "clinician_id") -> DataFrame:
    cols = [key, column] if key != column else [column]
    return df.filter(F.col(column).isNull()).select(*cols)


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the accepted set, with their counts."""
    return (df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*values))
            .groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n_records")))


def relationships(child: DataFrame, parent: DataFrame, key: str = "clinician_id",
                  parent_key: str | None = None) -> DataFrame:
    """Child keys with no parent row (orphans)."""
    pk = parent_key or key
    parents = parent.select(F.col(pk).alias(key))
    return child.filter(F.col(key).isNotNull()).select(key).join(parents, key, "left_anti")


def expression_is_true(df: DataFrame, expression: str | Column) -> DataFrame:
    """Rows where the expression is false (NULL is not a failure, as in SQL
    ``WHERE NOT (expr)``)."""
    cond = F.expr(expression) if isinstance(expression, str) else expression
    return df.filter(~cond)


def in_range(df: DataFrame, column: str, lo: float, hi: float, key: str = "clinician_id") -> DataFrame:
    return df.filter((F.col(column) < lo) | (F.col(column) > hi)).select(key, column)


def aggregate_is(df: DataFrame, aggregate: Column, expected, name: str = "actual") -> DataFrame:
    """Table-level check: one row (the actual value) when the aggregate
    differs from ``expected``, none when it holds."""
    return df.agg(aggregate.alias(name)).filter(~F.col(name).eqNullSafe(F.lit(expected)))


@dataclass
class TableChecks:
    """Checks of one table.  Row checks are boolean failure conditions."""
    name: str
    df: DataFrame
    row_checks: dict[str, Column] = field(default_factory=dict)
    unique_keys: list[str] = field(default_factory=list)
    foreign_keys: list[tuple[str, DataFrame, str]] = field(default_factory=list)
    aggregates: dict[str, Column] = field(default_factory=dict)


def not_null_failure(column: str) -> Column:
    return F.col(column).isNull()


def accepted_failure(column: str, values: Sequence[str]) -> Column:
    return F.col(column).isNotNull() & ~F.col(column).isin(*values)


def range_failure(column: str, lo: float, hi: float) -> Column:
    return (F.col(column) < lo) | (F.col(column) > hi)


def expression_failure(expression: str | Column) -> Column:
    cond = F.expr(expression) if isinstance(expression, str) else expression
    return F.coalesce(~cond, F.lit(False))


def run_suite(tables: Sequence[TableChecks]) -> DataFrame:
    """All checks -> (test_name, model, failures)."""
    parts: list[DataFrame] = []
    for t in tables:
        checks = dict(t.row_checks)
        aggs = [F.count_if(cond).cast("bigint").alias(f"c{i}") for i, cond in enumerate(checks.values())]
        aggs += [F.coalesce(a, F.lit(0)).cast("bigint").alias(f"a{i}") for i, a in enumerate(t.aggregates.values())]
        if aggs:
            row = t.df.agg(*aggs)
            names = [*checks.keys(), *t.aggregates.keys()]
            cols = [f"c{i}" for i in range(len(checks))] + [f"a{i}" for i in range(len(t.aggregates))]
            stacked = row.select(F.explode(F.array(*[
                F.struct(F.lit(n).alias("test_name"), F.col(c).alias("failures")) for n, c in zip(names, cols)
            ])).alias("r")).select("r.test_name", "r.failures")
            parts.append(stacked.withColumn("model", F.lit(t.name)))
        for key in t.unique_keys:
            dup = unique(t.df, key).agg(F.count(F.lit(1)).cast("bigint").alias("failures"))
            parts.append(dup.select(F.lit(f"unique_{t.name}_{key}").alias("test_name"), "failures",
                                    F.lit(t.name).alias("model")))
        for key, parent, parent_name in t.foreign_keys:
            orphans = relationships(t.df, parent, key).agg(F.count(F.lit(1)).cast("bigint").alias("failures"))
            parts.append(orphans.select(F.lit(f"relationships_{t.name}_{key}__{parent_name}").alias("test_name"),
                                        "failures", F.lit(t.name).alias("model")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("test_name", "model", "failures")
