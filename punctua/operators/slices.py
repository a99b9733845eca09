"""Splitting rows by time: whole years, and positions within a training period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from punctua.contract import CALIB_FRACTION, TEST_YEARS, TRAIN_YEARS, VALID_FRACTION


def temporal_split(
    df: DataFrame,
    train_years: Sequence[int] = TRAIN_YEARS,
    test_years: Sequence[int] = TEST_YEARS,
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by calendar year; the year lists must not overlap."""
    if "year" not in df.columns:
        raise ValueError("a temporal split needs a year column")
    shared = set(train_years) & set(test_years)
    if shared:
        raise ValueError(f"years in both train and test: {sorted(shared)}")
    return df.where(F.col("year").isin(*train_years)), df.where(F.col("year").isin(*test_years))


def split_counts(df: DataFrame, train_years: Sequence[int], test_years: Sequence[int]) -> DataFrame:
    """Row counts of both sides in one pass, for the check that neither is empty."""
    return df.agg(
        F.count_if(F.col("year").isin(*train_years)).alias("train_rows"),
        F.count_if(F.col("year").isin(*test_years)).alias("test_rows"),
    )


def slice_cuts(n: Column, valid: float, calib: float) -> tuple[Column, Column]:
    """Positions where the validation and calibration slices begin."""
    one = F.lit(1).cast("bigint")
    n_calib = F.greatest(one, F.floor(n * F.lit(calib)))
    n_valid = F.greatest(one, F.floor(n * F.lit(valid)))
    fifth = F.greatest(one, F.floor(n / 5))
    tiny = n_calib + n_valid >= n
    n_calib = F.when(tiny, fifth).otherwise(n_calib)
    n_valid = F.when(tiny, fifth).otherwise(n_valid)
    return n - n_valid - n_calib, n - n_calib


def spread_key(ties: Sequence[str]) -> Column:
    """Three hex digits drawn from the tie columns: 4096 shares of a day."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ties])
    return F.substring(F.md5(text), 1, 3)


def temporal_slices(
    df: DataFrame,
    ties: Sequence[str],
    day: str = "flight_date",
    valid: float = VALID_FRACTION,
    calib: float = CALIB_FRACTION,
    out: str = "slice",
) -> DataFrame:
    """Label rows ``fit``, ``valid`` or ``calib`` by their position in time.

    ``ties`` orders the rows of one day.  Within a day the order is (three hex digits of
    a hash of ``ties``, ``ties``, a hash of all other columns), since the position inside
    a day has no meaning of its own.  So rows that differ anywhere have one order, however
    they are partitioned.  Rows equal in every column have none; where a cut falls between
    such copies they are dealt out to its two sides in the proportion of the cut.

    The rows are never sorted.  Each cut is located as an order key in three counting
    steps: days (bounded by the calendar), hash shares of the day that holds the cut
    (4096), and the keys of one share of that day.  Every row then compares itself
    with the two cut keys.
    """
    # Names of their own, so that no column of the caller can clash with them.
    tie_keys = [f"_t{i}" for i in range(len(ties))]
    own = [F.col(c).alias(t) for c, t in zip(ties, tie_keys)]
    # Rows that agree on ties are told apart by all else that can be hashed.
    rest = sorted(f.name for f in df.schema if f.name not in (day, *ties) and "map<" not in f.dataType.simpleString())
    if rest:
        tie_keys.append("_rest")
        own.append(F.xxhash64(*rest).alias("_rest"))
    up_to_here = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    days = (
        df.groupBy(F.col(day).alias("_day"))
        .agg(F.count("*").alias("_n"))
        .select("_day", "_n", F.sum("_n").over(up_to_here).alias("_end"))
        .withColumn("_total", F.max("_end").over(Window.partitionBy()))
    )
    first, second = slice_cuts(F.col("_total"), valid, calib)
    start = F.col("_end") - F.col("_n")
    cut_days = (
        days.select(
            "_day",
            start.alias("_start"),
            "_end",
            F.inline(
                F.array(
                    F.struct(F.lit(1).alias("_cut"), first.alias("_position")),
                    F.struct(F.lit(2).alias("_cut"), second.alias("_position")),
                )
            ),
        )
        .where((F.col("_start") <= F.col("_position")) & (F.col("_position") < F.col("_end")))
        .select("_cut", "_day", (F.col("_position") - F.col("_start")).alias("_left"))
    )

    # At most two rows on the small side: the day, then the share, of each cut.
    rows = df.select(F.col(day).alias("_day"), spread_key(ties).alias("_share"), *own)
    on_cut_days = rows.join(F.broadcast(cut_days), "_day")
    shares = _locate(on_cut_days, ["_cut", "_day"], ["_share"])
    on_cut_shares = on_cut_days.drop("_left").join(
        F.broadcast(shares.drop("_n")), ["_cut", "_day", "_share"]
    )
    cuts = _locate(on_cut_shares, ["_cut", "_day", "_share"], tie_keys)

    # One row, two keys: a single subquery that both comparisons share.
    part = (F.col("_left") / F.col("_n")).alias("_part")
    key = F.struct("_day", "_share", *tie_keys, part)
    keys = cuts.agg(
        F.struct(
            *[F.max(F.when(F.col("_cut") == n, key)).alias(f"c{n}") for n in (1, 2)]
        ).alias("keys")
    ).scalar()
    mine = F.struct(spread_key(ties).alias("_share"), *own)

    def before(which: int) -> Column:
        cut = keys[f"c{which}"]
        place = F.struct(*[cut[c].alias(c) for c in ("_share", *tie_keys)])
        copy = (mine == place) & (F.col("_deal") < cut["_part"])
        return (F.col(day) < cut["_day"]) | ((F.col(day) == cut["_day"]) & ((mine < place) | copy))

    deal = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(2**30)) / F.lit(2.0**30)
    return (
        df.withColumn("_deal", deal)
        .withColumn(out, F.when(before(1), "fit").when(before(2), "valid").otherwise("calib"))
        .drop("_deal")
    )


def _locate(rows: DataFrame, within: list[str], order: list[str]) -> DataFrame:
    """The ``order`` value that covers position ``_left`` within each group."""
    w = Window.partitionBy(*within).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    counted = rows.groupBy(*within, *order, "_left").agg(F.count("*").alias("_n"))
    placed = counted.withColumn("_end", F.sum("_n").over(w)).withColumn(
        "_start", F.col("_end") - F.col("_n")
    )
    inside = (F.col("_start") <= F.col("_left")) & (F.col("_left") < F.col("_end"))
    return placed.where(inside).select(
        *within, *order, (F.col("_left") - F.col("_start")).alias("_left"), "_n"
    )
