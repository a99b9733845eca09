"""Keeping stored partitions complete and of one schema."""

from __future__ import annotations

import logging
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from punctua.contract import FLIGHT_TYPES
from punctua.sources.tables import enforce_types, write_table

log = logging.getLogger(__name__)


def month_grid(spark: SparkSession, years: list[int], months: list[int] | None = None) -> DataFrame:
    """Requested (year, month) pairs."""
    pairs = [(y, m) for y in years for m in (months or range(1, 13))]
    return spark.createDataFrame(pairs, "year int, month int")


def pending_partitions(
    requested: DataFrame, existing: DataFrame, keys: list[str], overwrite: bool = False
) -> DataFrame:
    """Requested partition keys that are not stored yet (all of them on overwrite).

    ``existing`` may be the stored table itself: reading only its partition columns
    and taking their distinct values costs no data scan beyond the listing.
    """
    wanted = requested.select(*keys).distinct()
    if overwrite:
        return wanted
    return wanted.join(existing.select(*keys).distinct(), keys, "left_anti")


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Folders below ``path`` that hold parquet files: the listing only, no data."""
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(path)
        .select(F.regexp_replace("path", "/[^/]*$", "").alias("folder"))
        .distinct()
        .orderBy("folder")
    )
    return [r.folder for r in listing.toLocalIterator()]


def _by_layout(spark: SparkSession, source: str) -> tuple[dict[str, list[str]], list[str]]:
    """Partition folders grouped by the column types in their footers.

    Folders that disagree on types cannot share a scan, but there are only a few
    distinct layouts however many folders there are.  Also returns the folders whose
    footers cannot be read.
    """
    layouts: dict[str, list[str]] = {}
    unreadable: list[str] = []
    for folder in _folders(spark, source):
        try:
            layout = spark.read.parquet(folder).schema.simpleString()
        except Exception as problem:  # a broken footer must not stop the other folders
            log.warning("skipping unreadable %s: %s", folder, str(problem)[:200])
            unreadable.append(folder)
            continue
        layouts.setdefault(layout, []).append(folder)
    return layouts, unreadable


def _rewrite(
    spark: SparkSession,
    source: str,
    target: str,
    partition_by: list[str],
    fix: Callable[[DataFrame], DataFrame],
) -> tuple[int, list[str]]:
    """Write ``source`` to ``target`` with ``fix`` applied, one job per layout found.

    The result goes to a new path for the caller to swap in: a job that dies half way
    harms nothing and can simply run again.  Returns how many folders were written
    and the unreadable ones.
    """
    layouts, unreadable = _by_layout(spark, source)
    # Partition values stay the text they are, or a code such as 007 would come back as 7.
    with _setting(spark, "spark.sql.sources.partitionColumnTypeInference.enabled", "false"):
        for folders in layouts.values():
            df = spark.read.option("basePath", source).parquet(*folders)
            write_table(fix(df), target, partition_by=partition_by)
    return sum(map(len, layouts.values())), unreadable


def repair_types(
    spark: SparkSession,
    source: str,
    target: str,
    partition_by: list[str],
    types: dict[str, str] = FLIGHT_TYPES,
) -> tuple[int, list[str]]:
    """Rewrite drifted partitions so that every one has the same column types."""
    return _rewrite(spark, source, target, partition_by, lambda df: enforce_types(df, types))


def _as_micros(column: str, sql_type: str) -> Column:
    """Nanoseconds read as a long become microseconds by integer division."""
    c = F.col(column)
    return F.timestamp_micros(F.expr(f"`{column}` div 1000")) if sql_type == "bigint" else c


def repair_timestamps(
    spark: SparkSession, source: str, target: str, partition_by: list[str], column: str = "time"
) -> tuple[int, list[str]]:
    """Rewrite nanosecond timestamps as microseconds; other partitions are copied as is."""

    def fix(df: DataFrame) -> DataFrame:
        kinds = dict(df.dtypes)
        if column not in kinds:
            return df
        return df.withColumn(column, _as_micros(column, kinds[column]))

    with _setting(spark, "spark.sql.legacy.parquet.nanosAsLong", "true"):
        return _rewrite(spark, source, target, partition_by, fix)
