"""A corpus from raw documents: toxic ones out, repeated lines out, near copies out, packed.

Each stage takes (spark, docs, sf_dir) and returns a frame that ``run`` stores as Parquet
below the shared folder and hands, read again, to the next.  All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from punctua.llm import linechunks, minhash, packing, toxicity
from punctua.llm.common import Workspace
from punctua.llm.queries import held_out, tokenizer


def unused(docs: DataFrame, name: str) -> str:
    """``name``, underlined until no column of ``docs`` has it."""
    while name in docs.columns:
        name += "_"
    return name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose restored text scores below the cut stay, null and empty ones too."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out("doc_id"))
    model = toxicity.fit_toxicity(docs, labels, Workspace(spark, "toxicity"))
    score = unused(docs, "toxic_score")
    return toxicity.marked(docs, model, out=score).where(F.col(score) < 0.3).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages whose content-defined chunks repeat leave the texts; a document of which nothing is left goes as well."""
    work, gone = Workspace(spark, "lines"), unused(docs, "removed")
    # Stored before it is filtered: else the filter would compute every text once more.
    out = work.store(linechunks.dedup_passages(docs, work, out=(unused(docs, "n_lines"), gone)), "cleaned")
    out = out.where(~F.coalesce((F.col(gone) > 0) & (F.trim("text") == ""), F.lit(False)))
    if "n_chars" in docs.columns:
        n = F.when(F.col(gone) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", n)
    return out.select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of every near-duplicate group stays, and rows without an id."""
    groups = minhash.near_duplicates(docs, Workspace(spark, "near"))
    gone = groups.where("not kept and doc_id is not null").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, Workspace(spark, "packing"), tokenizer("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("minhash near-dedup", drop_near_copies),
    ("packing", pack_windows),
]

# Learned scores and token ids are beyond SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    work = Workspace(spark, "pipeline")
    for name, stage in STAGES:
        docs = work.store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
