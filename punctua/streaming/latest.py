"""Latest value per key, kept as a table that a stream maintains.

Each micro-batch is reduced to one row per key and written to a folder of its own; then an
entry in the table's manifest commits it.  Folder and entry are named by run and batch: a run
is a checkpoint, so a retried batch replaces itself and a new checkpoint never meets the
batches of an old one.  A compaction writes what it has read to one more folder, whose entry
lists the entries it replaces.  Batches committed meanwhile are not in that list and stay, so
there is nothing to swap and no moment at which a reader sees less.  ``purge`` removes what
has been replaced.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from punctua.contract import CACHED_TTL_SECONDS, LIVE_TTL_SECONDS
from punctua.operators.keyed import latest_by_key

DATA, MANIFEST, FOLD = "data", "manifest", "fold-"


class Store:
    """Small files beside a table, through Hadoop's file systems, as Spark itself writes."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def put(self, name: str, text: str) -> None:
        """A file that is there whole or not at all."""
        part, whole = self._path(f"{self.path}/_part/{uuid.uuid4().hex}"), self._path(f"{self.path}/{name}")
        out = self._fs.create(part, True)
        out.write(text.encode())
        out.close()
        self._fs.mkdirs(whole.getParent())
        self._fs.delete(whole, False)
        if not self._fs.rename(part, whole):
            raise OSError(f"could not write {whole}")

    def get(self, name: str) -> str:
        source = self._fs.open(self._path(f"{self.path}/{name}"))
        try:
            return bytes(source.readAllBytes()).decode()
        finally:
            source.close()

    def names(self, folder: str) -> list[str]:
        at = self._path(f"{self.path}/{folder}")
        if not self._fs.exists(at):
            return []
        return sorted(f.getPath().getName() for f in self._fs.listStatus(at))

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._path(f"{self.path}/{name}"))

    def drop(self, name: str) -> None:
        self._fs.delete(self._path(f"{self.path}/{name}"), True)


def entries(store: Store) -> tuple[list[str], list[str]]:
    """Committed entries that count, and those another entry replaces."""
    all_names = store.names(MANIFEST)
    gone = {old for name in all_names for old in json.loads(store.get(f"{MANIFEST}/{name}"))["replaces"]}
    return [n for n in all_names if n not in gone], [n for n in all_names if n in gone]


def commit(rows: DataFrame, path: str, name: str, replaces: list[str] = ()) -> None:
    """Write ``rows`` under ``name``, then let readers see them.  Safe to repeat."""
    store = Store(rows.sparkSession, path)
    rows.write.mode("overwrite").parquet(f"{store.path}/{DATA}/{name}")
    store.put(f"{MANIFEST}/{name}", json.dumps({"replaces": list(replaces)}))


def store_batch(batch: DataFrame, batch_id: int, path: str, key: str, order: list[str], run: str = "run") -> None:
    """Reduce one micro-batch and commit it, unless a compaction has already taken it in."""
    name = f"{run}-{batch_id:012d}"
    if name in entries(Store(batch.sparkSession, path))[1]:
        return
    commit(latest_by_key(batch, [key], order), path, name)


def run_id(spark: SparkSession, checkpoint: str) -> str:
    """The name of the run that a checkpoint stands for; made up once, when it is new."""
    store = Store(spark, checkpoint)
    if not store.exists("run-id"):
        store.put("run-id", uuid.uuid4().hex)
    return store.get("run-id")


def maintain_latest(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    key: str,
    order: list[str],
    name: str = "latest",
    available_now: bool = False,
) -> StreamingQuery:
    """Start the stream that maintains the table at ``path``."""
    run = run_id(rows.sparkSession, f"{checkpoint}-run")
    writer = (
        rows.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .queryName(name)
        .foreachBatch(lambda df, n: store_batch(df, n, path, key, order, run))
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def latest_with_timeout(
    rows: DataFrame, key: str, order: str, ttl: int = LIVE_TTL_SECONDS, event: str = "event_time", watermark: str = "1 minute"
) -> DataFrame:
    """Streaming latest row per key that forgets keys: update rows, and a last one when a key expires.

    A key's state is its latest row by ``order`` (a whole number; ties by the row's text).  Once
    the watermark passes that row's event time by ``ttl`` seconds, the key is dropped from the
    state and sent once more with ``expired`` set, so state holds what is alive, however many
    keys have ever been seen.  Late rows of an expired key are expired at once.
    """
    kinds = T.StructType([f for f in rows.schema.fields if f.name != key])
    plain = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    body = F.to_json(F.struct(*kinds.names), plain)
    slim = rows.withWatermark(event, watermark).select(
        F.col(key).alias("k"), F.col(order).cast("bigint").alias("o"), body.alias("body"), F.col(event).alias("at")
    )

    def fold(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        def out(body: str, expired: bool) -> pd.DataFrame:
            return pd.DataFrame({"k": [k[0]], "body": [body], "expired": [expired]})

        if state.hasTimedOut:
            held = state.get
            state.remove()
            yield out(held[1], True)
            return
        best = state.getOption
        for f in frames:
            ends = [(int(o), b, int(at.timestamp() * 1000)) for o, b, at in zip(f["o"], f["body"], f["at"])]
            best = max([*ends, tuple(best)] if best else ends)
        due = best[2] + ttl * 1000
        if due <= state.getCurrentWatermarkMs():
            if state.exists:
                state.remove()
            yield out(best[1], True)
            return
        state.update(best)
        state.setTimeoutTimestamp(due)
        yield out(best[1], False)

    key_type = rows.schema[key].dataType.simpleString()
    told = slim.where("o is not null and at is not null").groupBy("k").applyInPandasWithState(
        fold, f"k {key_type}, body string, expired boolean", "o bigint, body string, at bigint", "update", GroupStateTimeout.EventTimeTimeout)
    return told.select(F.col("k").alias(key), F.from_json("body", kinds, plain).alias("r"), "expired").select(key, "r.*", "expired")


def latest_state(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Streaming latest row per key in Spark's state store (update mode)."""
    rest = [c for c in rows.columns if c != key]
    lead = [c for c in order if c in rest] + [c for c in rest if c not in order]
    best = rows.groupBy(key).agg(F.max(F.struct(*lead)).alias("_row"))
    return best.select(key, "_row.*")


def read_latest(spark: SparkSession, path: str, key: str, order: list[str]) -> DataFrame:
    """The latest row per key over all committed folders."""
    return _latest_of(spark, path, entries(Store(spark, path))[0], key, order)


def _latest_of(spark: SparkSession, path: str, names: list[str], key: str, order: list[str]) -> DataFrame:
    if not names:
        raise FileNotFoundError(f"nothing has been committed at {path}")
    rows = spark.read.parquet(*[f"{path.rstrip('/')}/{DATA}/{n}" for n in names])
    return latest_by_key(rows, [key], order)


def served(
    latest: DataFrame, now: Column, event_ts: str = "event_ts", cached: bool = False
) -> DataFrame:
    """Rows that have not expired: the short-lived live view, or the long-lived copy
    relabelled as cached."""
    ttl, source = (CACHED_TTL_SECONDS, "cached") if cached else (LIVE_TTL_SECONDS, "live")
    fresh = latest.where(now - F.col(event_ts) < ttl)
    return fresh.withColumns(
        {"source": F.lit(source), "expires_at": F.col(event_ts) + F.lit(ttl)}
    )


def with_ttls(latest: DataFrame, now: Column, event_ts: str = "event_ts") -> DataFrame:
    """Rows by what they may still be shown as: live, then cached; beyond both, gone."""
    age = now - F.col(event_ts)
    source = F.when(age < LIVE_TTL_SECONDS, "live").when(age < CACHED_TTL_SECONDS, "cached")
    ttl = F.when(age < LIVE_TTL_SECONDS, LIVE_TTL_SECONDS).otherwise(CACHED_TTL_SECONDS)
    return latest.where(age < CACHED_TTL_SECONDS).withColumns(
        {"source": source, "expires_at": F.col(event_ts) + ttl}
    )


def compact(
    spark: SparkSession, path: str, key: str, order: list[str], keep: Column | None = None
) -> None:
    """Fold all committed folders into one, beside a running stream; ``keep`` lets rows expire."""
    now, gone = entries(Store(spark, path))
    rows = _latest_of(spark, path, now, key, order)
    commit(rows if keep is None else rows.where(keep), path, f"{FOLD}{uuid.uuid4().hex}", now + gone)


def purge(spark: SparkSession, path: str) -> int:
    """Remove what compactions have replaced, once no reader from before them is left.

    Of each run the last entry stays in the manifest without its data: it is the one batch
    that a restarted stream may repeat, and must then find taken in.  Compactions and purges
    of a table run one at a time.
    """
    store = Store(spark, path)
    gone = entries(store)[1]
    last = {n.rsplit("-", 1)[0]: n for n in gone if not n.startswith(FOLD)}
    for name in sorted(gone, key=lambda n: n.startswith(FOLD)):  # lists of the replaced go last
        store.drop(f"{DATA}/{name}")
        if last.get(name.rsplit("-", 1)[0]) != name:
            store.drop(f"{MANIFEST}/{name}")
    return len(gone)
