"""Ranks and top rows over already aggregated tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def rank_within(df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str = "rnk"):
    """Row number within each key.  Meant for aggregates, where a key has few rows."""
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def top_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows; Spark keeps n per task and merges, without a full sort."""
    return df.orderBy(*order).limit(n)
