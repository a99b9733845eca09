"""Data-quality checks.  Each returns the violations; an empty frame is a pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; nulls are not values."""
    return unique_combination(df.where(F.col(column).isNotNull()), [column])


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Value combinations that occur more than once, with their count."""
    return df.groupBy(*columns).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list, with their count; nulls pass."""
    stray = df.where(_stray(column, values))
    return stray.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))


def accepted_range(df: DataFrame, column: str, low, high) -> DataFrame:
    """Values below ``low`` or above ``high``; nulls pass."""
    return df.where(_outside(column, low, high)).select(column)


def relationships(
    child: DataFrame, column: str, parent: DataFrame, field: str
) -> DataFrame:
    """Child values without a parent, with their count; nulls pass.

    Child values are reduced to distinct ones before the join, so a value with a
    third of all rows is one row of it.
    """
    values = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("n"))
    )
    keys = parent.select(F.col(field).alias("value"))
    return values.join(keys, "value", "left_anti")


def _stray(column: str, values: Sequence) -> Column:
    return F.col(column).isNotNull() & ~F.col(column).isin(*values)


def _outside(column: str, low, high) -> Column:
    return (F.col(column) < low) | (F.col(column) > high)


@dataclass
class Suite:
    """Checks to run over one table."""

    name: str
    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    unique_combinations: Sequence[Sequence[str]] = ()
    accepted_values: dict[str, Sequence] = field(default_factory=dict)
    accepted_range: dict[str, tuple] = field(default_factory=dict)
    relationships: dict[str, tuple[DataFrame, str]] = field(default_factory=dict)


def run_suite(df: DataFrame, suite: Suite) -> DataFrame:
    """(table, check, column, violations) for every check of the suite.

    All row-level checks share one pass over the table.  Checks that compare rows
    add one grouped aggregate each.
    """
    flags: dict[tuple[str, str], Column] = {}
    for c in suite.not_null:
        flags["not_null", c] = F.col(c).isNull()
    for c, values in suite.accepted_values.items():
        flags["accepted_values", c] = _stray(c, values)
    for c, (low, high) in suite.accepted_range.items():
        flags["accepted_range", c] = _outside(c, low, high)
    parts: list[DataFrame] = []
    if flags:
        counted = df.agg(*[F.count_if(flag).alias(f"c{i}") for i, flag in enumerate(flags.values())])
        entries = [
            F.struct(
                F.lit(check).alias("check"),
                F.lit(c).alias("column"),
                F.col(f"c{i}").alias("violations"),
            )
            for i, (check, c) in enumerate(flags)
        ]
        parts.append(counted.select(F.inline(F.array(*entries))))

    def counted_rows(violations: DataFrame, check: str, column: str) -> DataFrame:
        return violations.agg(F.count("*").alias("violations")).select(
            F.lit(check).alias("check"), F.lit(column).alias("column"), "violations"
        )

    for c in suite.unique:
        parts.append(counted_rows(unique(df, c), "unique", c))
    for columns in suite.unique_combinations:
        parts.append(
            counted_rows(unique_combination(df, columns), "unique_combination", ",".join(columns))
        )
    for c, (parent, parent_key) in suite.relationships.items():
        missing = relationships(df, c, parent, parent_key)
        total = missing.agg(F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("violations"))
        parts.append(
            total.select(F.lit("relationships").alias("check"), F.lit(c).alias("column"), "violations")
        )
    report = reduce(DataFrame.unionByName, parts)
    return report.select(F.lit(suite.name).alias("table"), "check", "column", "violations")
