"""Reading and writing layered tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

FORMATS = ("parquet", "delta")


def _checked(fmt: str) -> str:
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, got {fmt!r}")
    return fmt


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None):
    """Directory table with partition discovery.  A schema skips footer inference."""
    reader = spark.read.format(_checked(fmt))
    if schema:
        reader = reader.schema(schema)
    return reader.load(path)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    cluster: bool = True,
) -> None:
    """Write a directory table, replacing only the partitions present in ``df``.

    With ``cluster`` rows are first brought together by partition value, so that a
    thousand tasks do not each leave a small file in every partition.  The rebalance
    hint lets adaptive execution split a value that holds much of the table over
    several files; a plain repartition would send it to one task.
    """
    out = df.hint("rebalance", *partition_by) if partition_by and cluster else df
    writer = out.write.format(_checked(fmt)).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.save(path)


def save_table(
    df: DataFrame,
    name: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    comment: str | None = None,
) -> None:
    """Managed table, replaced with its schema, optionally commented."""
    spark = df.sparkSession
    writer = df.write.format(_checked(fmt)).mode("overwrite").option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    if comment:
        comment_table(spark, name, comment)


def create_schema(spark: SparkSession, name: str, comment: str = "") -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name} COMMENT '{_quoted(comment)}'")


def comment_table(spark: SparkSession, name: str, comment: str) -> None:
    spark.sql(f"COMMENT ON TABLE {name} IS '{_quoted(comment)}'")


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def union_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    """One frame from many, matched by column name; absent columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Exactly the wanted columns, so that a scan reads no others; missing ones raise."""
    wanted = list(dict.fromkeys(columns))
    absent = [c for c in wanted if c not in df.columns]
    if absent:
        raise ValueError(f"table lacks required columns: {absent}")
    return df.select(*wanted)


def number(text: Column, sql_type: str) -> Column:
    """Text or number to a numeric type; whatever cannot be read becomes null.

    Whole numbers may arrive as ``1.0`` (a file once written with nulls in an
    integer column), which an integer cast alone would reject.
    """
    if sql_type in ("int", "bigint"):
        return F.coalesce(text.try_cast(sql_type), text.try_cast("double").try_cast(sql_type))
    return text.try_cast(sql_type)


def enforce_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Bring the listed columns that are present to their stable types."""
    return df.select(
        *[
            (number(F.col(c), types[c]) if types.get(c, "string") != "string"
             else F.col(c).cast("string") if c in types else F.col(c)).alias(c)
            for c in df.columns
        ]
    )


def fill_missing(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Add columns that are absent as typed nulls and cast the present ones."""
    have = set(df.columns)
    return df.withColumns(
        {c: (F.col(c) if c in have else F.lit(None)).cast(t) for c, t in types.items()}
    )
