"""One row per key, chosen by a stated order.

Both functions are grouped aggregates over a struct, so rows are reduced before the
shuffle and a key with a third of all rows costs no more than any other.  A ranking
window would instead sort all rows of that key in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], best) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    lead = [c for c in order if c in rest]
    tail = [c for c in rest if c not in lead]
    if not rest:
        return df.select(*keys).distinct()
    chosen = df.groupBy(*keys).agg(best(F.struct(*lead, *tail)).alias("_row"))
    return chosen.select(*keys, "_row.*").select(*df.columns)


def first_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row that sorts first by ``order``; equal rows fall back to the other columns."""
    return _pick(df, keys, order, F.min)


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row that sorts last by ``order``; equal rows fall back to the other columns."""
    return _pick(df, keys, order, F.max)


def level_codes(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Distinct non-null levels of each categorical column with a zero-based code.

    Integer columns are ordered as numbers, text as text.  The ranking sees levels,
    never rows.
    """
    kinds = dict(df.dtypes)
    entries: list[Column] = []
    for name in features:
        whole = kinds[name] in ("tinyint", "smallint", "int", "bigint")
        entries.append(
            F.struct(
                F.lit(name).alias("feature"),
                F.col(name).cast("string").alias("level"),
                (F.col(name).cast("bigint") if whole else F.lit(None).cast("bigint")).alias("n"),
            )
        )
    levels = (
        df.select(F.inline(F.array(*entries))).where(F.col("level").isNotNull()).distinct()
    )
    w = Window.partitionBy("feature").orderBy("n", "level")
    return levels.select("feature", "level", (F.row_number().over(w) - 1).alias("code"))
