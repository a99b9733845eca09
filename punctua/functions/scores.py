"""Expressions over probabilities and per-feature contributions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from punctua.contract import RISK_EDGES


def risk_band(p: Column) -> Column:
    low, high = RISK_EDGES
    return F.when(p < low, "low").when(p < high, "moderate").when(p >= high, "high")


def bin_edges(n_bins: int) -> list[float]:
    """Evenly spaced float edges; the third of ten is 0.30000000000000004."""
    step = 1.0 / n_bins
    return [k * step for k in range(n_bins)] + [1.0]


def bin_index(p: Column, n_bins: int) -> Column:
    """Bin of ``p`` by comparing with the edges themselves, ends clipped.

    Multiplying by the bin count instead would round differently at the edges.
    """
    inner = bin_edges(n_bins)[1:-1]
    return reduce(lambda a, e: a + (p >= F.lit(e)).cast("int"), inner, F.lit(0))


def round6(x: Column) -> Column:
    return F.round(x, 6)


def elapsed_estimate(distance_miles: Column) -> Column:
    """Scheduled minutes guessed from the distance: seven miles a minute plus 40."""
    return F.round(distance_miles / 7.0 + 40.0, 0)


def factor(feature: str, value: Column, contribution: Column) -> Column:
    """One (feature, value, contribution, direction) entry."""
    return F.struct(
        F.lit(feature).alias("feature"),
        value.cast("string").alias("value"),
        F.round(contribution, 6).alias("contribution"),
        F.when(contribution >= 0, "increases").otherwise("decreases").alias("direction"),
    )


def top_factors(entries: list[tuple[str, Column, Column]], k: int = 3) -> Column:
    """The ``k`` entries with the largest absolute contribution, largest first.

    Works inside the row on an array as long as the feature list, of sizes and names
    only; the entries of the ``k`` picked are written out afterwards.  Equal sizes fall
    back to the feature name, so the result does not depend on the order in which
    features are listed.
    """
    keyed = F.array(
        *[
            F.struct((-F.abs(contribution)).alias("size"), F.lit(feature).alias("name"), F.lit(at).alias("at"))
            for at, (feature, _, contribution) in enumerate(entries)
        ]
    )

    def entry(x: Column) -> Column:
        *others, last = (factor(*e) for e in entries)
        if not others:
            return last
        cases = F.when(x["at"] == 0, others[0])
        for at, other in enumerate(others[1:], 1):
            cases = cases.when(x["at"] == at, other)
        return cases.otherwise(last)

    return F.transform(F.slice(F.sort_array(keyed), 1, k), entry)
