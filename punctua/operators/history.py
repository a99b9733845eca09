"""Rates that a row could have known: label means over strictly earlier days.

Rows are first added up per entity and day, all kinds of entity in one pass.  Windows then run
over entity-days, whose number per entity is bounded by the calendar, so an entity with a third
of all rows is as cheap as any other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from punctua.contract import HISTORY, LABEL, MIN_ROUTE_FLIGHTS
from punctua.functions.timeparts import epoch_day
from punctua.session import stored

DAY = "day_num"
# Stand-ins that keep the totals free of nulls: one for codes, one for days, which
# sorts before every date.
NO_CODE = "\u0000"
NO_DAY = -(2**40)


def _code(key: str) -> Column:
    return F.coalesce(F.col(key).cast("string"), F.lit(NO_CODE))


def _day(day: str) -> Column:
    return F.coalesce(epoch_day(F.col(day)), F.lit(NO_DAY))


def daily_totals(
    facts: DataFrame, keys: Sequence[str], label: str = LABEL, day: str = "flight_date"
) -> DataFrame:
    """Label sum, row count and count of labelled rows per key and day; codes and days are never null."""
    return (
        facts.select(*[_code(k).alias(k) for k in keys], _day(day).alias(DAY), F.col(label))
        .groupBy(*keys, DAY)
        .agg(F.sum(label).alias("_sum"), F.count("*").alias("_cnt"), F.count(label).alias("_known"))
    )


def overall_rate(daily: DataFrame) -> Column:
    """Mean label of all labelled rows as a scalar subquery; 0 when there are none."""
    mean = F.sum("_sum").cast("double") / F.nullif(F.sum("_known"), F.lit(0))
    return daily.agg(F.coalesce(mean, F.lit(0.0)).alias("rate")).scalar()


def _rates(totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(*keys, day, _rate)``: mean label of the days before each; null for the first."""
    earlier = Window.partitionBy(*keys).orderBy(DAY).rangeBetween(Window.unboundedPreceding, -1)
    count = F.sum("_cnt").over(earlier)
    rate = F.sum("_sum").over(earlier).cast("double") / F.nullif(count, F.lit(0))
    known = reduce(lambda a, b: a & b, [F.col(k) != NO_CODE for k in keys])
    return totals.select(*keys, DAY, F.when(known, rate).alias("_rate"))


def prior_rate(totals: DataFrame, keys: Sequence[str], out: str, prior: Column) -> DataFrame:
    """Mean label over the days before each (key, day); ``prior`` with no such day."""
    return _rates(totals, keys).select(*keys, DAY, F.coalesce("_rate", prior).alias(out))


def entity_days(
    facts: DataFrame,
    entities: Mapping[str, Sequence[str]] = HISTORY,
    label: str = LABEL,
    day: str = "flight_date",
) -> DataFrame:
    """Daily totals of every kind of entity, and of all rows: one scan, one grouping-sets aggregate.

    A row has the codes of its own kind; ``_set`` tells which (``set_of``).  Each kind is as
    small as its codes times the calendar, however many rows and combinations there are.
    The totals are stored, since every rate and the overall prior read them.
    """
    keys = _all_keys(entities)
    sets = list(dict.fromkeys([*[tuple(ks) for ks in entities.values()], ()]))
    rows = facts.select(*[_code(k).alias(k) for k in keys], _day(day).alias(DAY), F.col(label).alias("_label"))
    return stored(
        rows.groupingSets([[*ks, DAY] for ks in sets], *keys, DAY).agg(
            F.grouping_id().alias("_set"),
            F.sum("_label").alias("_sum"),
            F.count("*").alias("_cnt"),
            F.count("_label").alias("_known"),
        )
    )


def _all_keys(entities: Mapping[str, Sequence[str]]) -> list[str]:
    return list(dict.fromkeys(k for ks in entities.values() for k in ks))


def of_entity(totals: DataFrame, entities: Mapping[str, Sequence[str]], keys: Sequence[str]) -> DataFrame:
    """The daily totals of one kind of entity: those grouped by exactly ``keys``."""
    names = _all_keys(entities)
    bits = "".join("0" if k in keys else "1" for k in names) + "0"
    own = totals.where(F.col("_set") == int(bits, 2))
    return own.select(*keys, DAY, "_sum", "_cnt", "_known")


def prior_of(
    totals: DataFrame,
    entities: Mapping[str, Sequence[str]] = HISTORY,
    years: Sequence[int] | None = None,
) -> Column:
    """Mean label of all labelled rows, of some years if asked, from the stored totals."""
    days = of_entity(totals, entities, ())
    if years is not None:
        date = F.date_from_unix_date(F.col(DAY).cast("int"))
        days = days.where((F.col(DAY) > NO_DAY) & F.year(date).isin(*years))
    return overall_rate(days)


def rates_as_of(
    asked: DataFrame,
    totals: DataFrame,
    entities: Mapping[str, Sequence[str]] = HISTORY,
    day: str = "flight_date",
) -> DataFrame:
    """``asked`` with one rate per entity over the days before its own; null where there is none.

    An as-of join without a join of days: the distinct (entity, day) pairs asked for stand
    beside the entity's totals in one union, and a range window over it adds up what came
    earlier.  A back-dated row sees only days before it, a row beyond the last day sees all.
    Per entity the window holds asked days and known days, both bounded by the calendar;
    rows without a date see nothing.
    """
    out = asked
    for name, keys in entities.items():
        earlier = Window.partitionBy(*keys).orderBy(DAY).rangeBetween(Window.unboundedPreceding, -1)
        days = asked.select(*[_code(k).alias(k) for k in keys], _day(day).alias(DAY)).distinct()
        own = of_entity(totals, entities, keys).where(F.col(DAY) > NO_DAY)
        both = own.select(*keys, DAY, "_sum", "_cnt", F.lit(False).alias("_asked")).unionByName(
            days.withColumns({"_sum": F.lit(None).cast("bigint"), "_cnt": F.lit(None).cast("bigint"), "_asked": F.lit(True)})
        )
        rate = F.sum("_sum").over(earlier).cast("double") / F.nullif(F.sum("_cnt").over(earlier), F.lit(0))
        known = reduce(lambda a, b: a & b, [F.col(k) != NO_CODE for k in keys])
        found = both.withColumn("_rate", F.when(known, rate)).where("_asked")
        out = _with_rate(out, found, keys, day, name)
    return out


def _with_rate(rows: DataFrame, rates: DataFrame, keys: Sequence[str], day: str, out: str) -> DataFrame:
    """``rows`` with ``_rate`` of their entity and day as ``out``; an unknown entity has none."""
    carried = rates.where("_rate is not null").select(
        *[F.col(c).alias(f"_{c}") for c in (*keys, DAY)], F.col("_rate").alias(out)
    )
    same = [_code(k) == F.col(f"_{k}") for k in keys] + [_day(day) == F.col(f"_{DAY}")]
    return rows.join(carried, same, "left").drop(*[f"_{c}" for c in (*keys, DAY)])


def with_history(
    facts: DataFrame,
    entities: Mapping[str, Sequence[str]] = HISTORY,
    label: str = LABEL,
    day: str = "flight_date",
    prior_years: Sequence[int] | None = None,
    totals: DataFrame | None = None,
) -> DataFrame:
    """Facts with one prior-rate column per entity.

    The facts are aggregated once, for all kinds of entity together (``entity_days``; pass
    ``totals`` to share them).  Rates are windows over these small tables and each joins the
    facts by its own keys: the kinds with few codes are broadcast while their size allows it,
    which adaptive execution checks.  ``prior_years`` restricts the overall prior to some
    years, for training sets that must not look at test years.
    """
    if totals is None:
        totals = entity_days(facts, entities, label, day)
    prior = prior_of(totals, entities, prior_years)
    rows = facts
    for name, keys in entities.items():
        rows = _with_rate(rows, _rates(of_entity(totals, entities, keys), keys), keys, day, name)
    return rows.withColumns({name: F.coalesce(name, prior) for name in entities})


def fit_base_rates(
    train: DataFrame,
    keys: Sequence[str] = ("origin", "dest"),
    label: str = LABEL,
    min_count: int = MIN_ROUTE_FLIGHTS,
) -> DataFrame:
    """Mean label per route with enough training rows."""
    return (
        train.groupBy(*keys)
        .agg(F.avg(F.col(label).cast("double")).alias("base_rate"), F.count(label).alias("n"))
        .where(F.col("n") >= min_count)
    )


def score_base_rate(
    rows: DataFrame,
    rates: DataFrame,
    prior: Column,
    keys: Sequence[str] = ("origin", "dest"),
    out: str = "baseline_probability",
) -> DataFrame:
    """Route rate of each row, the overall rate for unseen or thin routes."""
    return (
        rows.join(rates.select(*keys, "base_rate"), list(keys), "left")
        .withColumn(out, F.coalesce("base_rate", prior))
        .drop("base_rate")
    )


def mean_label(rows: DataFrame, label: str = LABEL) -> Column:
    """Mean label as a scalar subquery; 0 when there is nothing to average."""
    mean = F.coalesce(F.avg(F.col(label).cast("double")), F.lit(0.0))
    return rows.agg(mean.alias("rate")).scalar()
