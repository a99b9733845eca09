"""Exact medians per group without gathering a group in one place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from punctua.session import stored

SPLITTERS = 63


def _holding_middle(sizes: DataFrame, group: Sequence[str], within: Sequence[str]) -> DataFrame:
    """Of ``(group, within, _slot, _slot_n, _values, _skipped, _first, _second)`` the slots with a middle row.

    ``_skipped`` rows of the group lie below all its slots here; the result has the number
    below each slot as ``_before``, which tells the slots of a group apart from now on.
    """
    running = (
        Window.partitionBy(*group, *within)
        .orderBy("_slot")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    through = F.col("_skipped") + F.sum("_slot_n").over(running)
    return (
        sizes.select("*", through.alias("_through"), (through - F.col("_slot_n")).alias("_before"))
        .where((F.col("_before") <= F.col("_second")) & (F.col("_through") > F.col("_first")))
        .select(*group, *within, "_slot", "_before", "_first", "_second", "_values")
    )


def _split(middle: DataFrame, group: Sequence[str], most: int) -> DataFrame:
    """``middle`` with slots of over ``most`` values narrowed to the parts that hold a middle row.

    A quantile sketch of a slot's distinct values, merged from partial sketches, gives
    splitters of about equal depth, so a split leaves some 1 / 64 of a slot whatever its values.
    """
    slot = [*group, "_before"]
    shares = [F.lit(k / (SPLITTERS + 1)) for k in range(1, SPLITTERS + 1)]
    wide = middle.where(F.col("_values") > most)
    splitters = wide.groupBy(*slot).agg(F.percentile_approx("_v", F.array(*shares), 10_000).alias("_splitters"))
    parts = wide.join(splitters, slot).select(
        *group,
        F.col("_before").alias("_skipped"),
        "_first",
        "_second",
        "_v",
        "_n",
        F.size(F.filter("_splitters", lambda s: s <= F.col("_v"))).alias("_slot"),
    )
    # The middle rows are the same all over a slot, so grouping by them parts nothing further.
    sizes = parts.groupBy(*group, "_skipped", "_slot", "_first", "_second").agg(
        F.sum("_n").alias("_slot_n"), F.count("*").alias("_values")
    )
    kept = _holding_middle(sizes, group, ["_skipped"]).drop("_first", "_second")
    narrowed = parts.join(kept, [*group, "_skipped", "_slot"]).drop("_skipped", "_slot")
    return middle.where(F.col("_values") <= most).unionByName(narrowed)


def exact_medians(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], bins: int = 4096, most: int = 1_000_000
) -> DataFrame:
    """Median of each column per key, averaging the two middle values.

    The built-in exact median holds every distinct value of a group in one buffer.
    Here equal values are counted first, a histogram of ``bins`` slots per group
    locates the slots with the middle rows, and only those slots are kept.  While one of
    them holds over ``most`` distinct values, as beside an outlier that stretches the
    histogram, it is split at its own quantiles (:func:`_split`); then they are put in
    order, so no task sorts more than ``most`` rows of a slot.
    Null keys form groups like any other value.  The slots kept are a written table.
    """
    # The keys travel as one struct, which is never null: joins on it keep null keys.
    group = ["_keys", "_metric"]
    values = df.select(
        F.struct(*keys).alias("_keys"),
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("_metric"), F.col(c).cast("double").alias("_v"))
                    for c in columns
                ]
            )
        ),
    ).where(F.col("_v").isNotNull())
    counts = values.groupBy(*group, "_v").agg(F.count("*").alias("_n"))
    # Every count is positive; asking for it keeps both uses of the counts identical,
    # so that they are shuffled once.
    span = (
        counts.where(F.col("_n") > 0)
        .groupBy(*group)
        .agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    )
    share = (F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))
    slot = F.when(
        F.col("_hi") > F.col("_lo"), F.least(F.floor(share * bins), F.lit(bins - 1))
    ).otherwise(0)
    slotted = counts.join(span, group).select(*group, "_v", "_n", slot.alias("_slot"))

    total = Window.partitionBy(*group)
    sizes = slotted.groupBy(*group, "_slot").agg(F.sum("_n").alias("_slot_n"), F.count("*").alias("_values"))
    sizes = sizes.select(
        *group,
        "_slot",
        "_slot_n",
        "_values",
        F.lit(0).cast("bigint").alias("_skipped"),
        ((F.sum("_slot_n").over(total) - 1) / 2).cast("bigint").alias("_first"),
        (F.sum("_slot_n").over(total) / 2).cast("bigint").alias("_second"),
    )
    middle = stored(slotted.join(_holding_middle(sizes, group, []), [*group, "_slot"]).drop("_slot"))
    while not middle.where(F.col("_values") > most).isEmpty():
        middle = stored(_split(middle, group, most))
    in_slot = Window.partitionBy(*group, "_before").orderBy("_v").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    ordered = (
        middle
        .withColumn("_end", F.col("_before") + F.sum("_n").over(in_slot))
        .withColumn("_start", F.col("_end") - F.col("_n"))
    )

    def at(position: str):
        here = (F.col("_start") <= F.col(position)) & (F.col("_end") > F.col(position))
        return F.max(F.when(here, F.col("_v")))

    found = ordered.groupBy(*group).agg(((at("_first") + at("_second")) / 2).alias("_median"))
    wide = found.groupBy("_keys").agg(
        *[
            F.max(F.when(F.col("_metric") == c, F.col("_median"))).alias(f"median_{c}")
            for c in columns
        ]
    )
    return wide.select("_keys.*", *[f"median_{c}" for c in columns])
