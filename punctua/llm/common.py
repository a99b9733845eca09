"""Shared storage, row batching and text helpers of the llm operators."""

from __future__ import annotations

import ctypes
import sys
import tempfile
import types
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

# The separators of words, as the near-duplicate contract has them.
WORD_GAP = r"[ \t-\r]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir`` of the session.

    Unset, a single-process session (tests) gets a temporary folder; anything that
    has executors of its own gets an error, since a local folder would be lost.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


class Workspace:
    """Tables of one run below the shared folder, removed one by one or all together.

    Written tables cut lineage and survive lost executors; ``drop`` frees those that no
    later step reads.  The table a returned frame reads stays until its reader ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
        self._n = 0

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.base}/{name}-{self._n}"

    def store(self, df: DataFrame, name: str) -> DataFrame:
        where = self.path(name)
        df.write.parquet(where)
        out = self.spark.read.schema(df.schema).parquet(where)
        out._stored_at = where
        return out

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            where = self.spark._jvm.org.apache.hadoop.fs.Path(df._stored_at)
            where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


def per_process(key: str, make):
    """``make()``, kept for the life of this Python process: tasks of one worker share it."""
    held = sys.modules.setdefault("punctua_llm_held", types.ModuleType("punctua_llm_held")).__dict__
    if key not in held:
        held[key] = make()
    return held[key]


def tidy(run):
    """``run`` over Arrow batches, then freed memory goes back to the machine.

    A worker process outlives its task; what it keeps in free lists would be missing in
    the stages that run beside it.
    """
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)
    return wrapped


def frames_of(batches: Iterator[pa.RecordBatch], most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches with about ``most_bytes`` each, one row at least."""
    for b in batches:
        n = b.num_rows
        if not n:
            continue
        step = max(1, int(n * most_bytes / max(1, b.nbytes)))
        for at in range(0, n, step):
            yield b.slice(at, step)


def ascii_lower(texts: pa.Array) -> pa.Array:
    """A-Z lower-cased, nothing else."""
    return pc.ascii_lower(texts)


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words of each text: (codes of all words in order, offsets by text, distinct words).

    Words are what lies between ASCII blanks, ``WORD_GAP`` as a pattern; null texts have none.
    """
    texts = texts.fill_null("").cast(pa.large_string())
    parts = pc.ascii_split_whitespace(texts)
    if isinstance(parts, pa.ChunkedArray):
        parts = parts.combine_chunks()
    flat = pc.list_flatten(parts)
    counts = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = flat.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(len(counts)), counts)
    blank = pc.equal(coded.dictionary, "").to_numpy(zero_copy_only=False)
    if blank.any():
        keep = ~blank[codes]
        codes, owner = codes[keep], owner[keep]
    offsets = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(np.bincount(owner, minlength=len(counts)), out=offsets[1:])
    return codes, offsets, coded.dictionary


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A full-avalanche permutation of 64-bit values (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start .. start + length - 1 of every range, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
