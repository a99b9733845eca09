"""Airport dimension from the headerless public file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from punctua.contract import AIRPORT_FILE_SCHEMA, AIRPORT_PATCH
from punctua.operators.keyed import first_by_key

AIRPORT_COLUMNS = ("iata", "name", "city", "lat", "lon", "tz", "zone")


def read_airports_dat(spark: SparkSession, path: str, country: str = "United States") -> DataFrame:
    """Airports of one country with a three-letter code and a usable position.

    ``tz`` is the hour offset as the file gives it and ``zone`` the zone name; the
    backslash-N marker is null.  A repeated code keeps the row with the lowest file id.
    """
    raw = (
        spark.read.schema(AIRPORT_FILE_SCHEMA)
        .option("header", False)
        .option("nullValue", "\\N")
        .option("escape", '"')
        .csv(path)
    )
    rows = raw.where(
        (F.col("country") == country) & F.col("iata").rlike("^[A-Za-z]{3}$")
    ).select(
        F.col("id").try_cast("bigint").alias("id"),
        "iata",
        "name",
        "city",
        F.col("lat").try_cast("double").alias("lat"),
        F.col("lon").try_cast("double").alias("lon"),
        F.col("utc_offset").alias("tz"),
        "zone",
    )
    usable = rows.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    return first_by_key(usable, ["iata"], ["id"]).select(*AIRPORT_COLUMNS)


def patch_rows(spark: SparkSession) -> DataFrame:
    """Contract rows for airports the public file lacks.  Their ``tz`` is a zone name."""
    return spark.createDataFrame(
        AIRPORT_PATCH, "iata string, name string, city string, lat double, lon double, tz string"
    ).withColumn("zone", F.col("tz"))


def append_absent(dim: DataFrame, patch: DataFrame, key: str = "iata") -> DataFrame:
    """``dim`` plus the patch rows whose key it does not have."""
    extra = patch.join(dim.select(key).distinct(), key, "left_anti")
    return dim.unionByName(extra, allowMissingColumns=True)


def airports_table(spark: SparkSession, path: str) -> DataFrame:
    """The whole step: read, filter, patch."""
    return append_absent(read_airports_dat(spark, path), patch_rows(spark))
