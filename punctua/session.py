"""Spark session settings this library relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings, safe to apply to a session somebody else started.  Adaptive
# execution picks the join strategy from measured sizes and splits skewed join
# partitions; forcing the split keeps it active below a grouped aggregate too.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A join whose measured partitions are all this small on one side needs no sort.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Only at session start: no call-site record for every column built from Python.
STATIC = {"spark.python.sql.dataFrameDebugging.enabled": "false"}

# For streaming jobs: keyed state on disk, so that it may outgrow executor memory.
STREAMING = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app: str = "punctua", master: str | None = None, **extra) -> SparkSession:
    """Create (or get) a session.  Memory and cores are the submitter's business."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME, **STATIC, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder, which every executor must be able to see.

    Taken from ``spark.checkpoint.dir``.  Where that is unset, a single-machine
    session gets a temporary folder; on a cluster that would lose data with the
    machine, so it is an error there.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder is None:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="checkpoint-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Store ``df`` once in the checkpoint folder and go on from the stored rows.

    For results that are read many times, such as a training set.  Unlike a cache,
    the stored rows outlive the executors that computed them.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table below the checkpoint folder and read it back.

    For a result that several parts of one plan read, each its own few columns: a
    column store serves them better than a checkpoint of whole rows.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
