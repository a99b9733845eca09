"""Toxicity scores of restored texts, learned from labelled documents."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from punctua.llm.charlm import Restorer, count_grams, log_model
from punctua.llm.common import Workspace, frames_of, mix, tidy, words_of

SLOTS = 1 << 20
FRONTS = (3, 4, 5, 6, 7)
TOPS = (0, 1, 2, 4, 7)
LEVELS = (0.7, 1.5, 2.5, 3.5)
_DOUBLE = re.compile(r"(.)\1")
_RUN = re.compile(r"([$!@|])\1\1+$")
_OUTER = ".,;:?\"'()[]#%&*<>"


@dataclass
class ToxicityModel:
    """What scoring needs, all of bounded size: language model, unit weights, regression."""

    language: np.ndarray
    units: np.ndarray
    middle: np.ndarray
    scale: np.ndarray
    beta: np.ndarray


def _restored(w: str, restorer: Restorer) -> str:
    """One word as it was meant; words of letters alone, none twice in a row, are as they stand."""
    if w.isalpha() and not _DOUBLE.search(w):
        return w
    return restorer.word(_RUN.sub("", w.strip(_OUTER)).rstrip("!"))


def _slots(words: list[str]) -> np.ndarray:
    """Slots of each word and of its beginnings; SLOTS where a word has no such unit.

    Characters are mixed with their places and added up, so that one running sum gives
    the hash of every beginning.
    """
    size = np.fromiter(map(len, words), np.int64, len(words))
    chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    begin = np.cumsum(size) - size
    place = np.arange(len(chars)) - np.repeat(begin, size)
    total = np.r_[np.uint64(0), np.cumsum(mix(chars.astype(np.uint64) ^ (place.astype(np.uint64) << np.uint64(21))))]
    out = np.full((len(words), 1 + len(FRONTS)), SLOTS, np.int64)
    for k, n in enumerate((0, *FRONTS)):  # 0 stands for the whole word
        has = np.flatnonzero(size > n)
        end = begin[has] + (n or size[has])
        out[has, k] = (mix(total[end] - total[begin[has]], n) % np.uint64(SLOTS)).astype(np.int64)
    return out


def _units(words: pa.Array, restorer: Restorer) -> np.ndarray:
    """Slots of each word's units: the restored word and its beginnings; SLOTS pads."""
    parts = [np.zeros((0, 1 + len(FRONTS)), np.int64)]
    for at in range(0, len(words), 1 << 15):
        parts.append(_slots([_restored(w, restorer) for w in words.slice(at, 1 << 15).to_pylist()]))
    return np.concatenate(parts)


def _occurrences(texts: list, restorer: Restorer):
    """(text, word) of every distinct word in every text, and the words' units."""
    codes, offsets, distinct = words_of(pa.array([restorer.text((x or "").lower()) for x in texts], pa.large_string()))
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
    both = np.unique(owner * max(1, len(distinct)) + codes)
    return both // max(1, len(distinct)), both % max(1, len(distinct)), _units(distinct, restorer)


def pooled(texts: list, restorer: Restorer, weights: np.ndarray) -> np.ndarray:
    """Features of each text: its highest word weights and how many words pass given levels.

    A word weighs as much as its heaviest unit.  Zeros for texts without words.
    """
    n = len(texts)
    owner, word, units = _occurrences(texts, restorer)
    v = np.append(weights, 0.0)[units].max(1)[word] if len(word) else np.zeros(0)
    order = np.lexsort((-v, owner))
    v, owner = v[order], owner[order]
    at = np.searchsorted(owner, np.arange(n + 1))
    top = np.zeros((n, len(TOPS)))
    for k, place in enumerate(TOPS):
        has = at[:-1] + place < at[1:]
        top[has, k] = v[(at[:-1] + place)[has]]
    size = np.diff(at)
    passed = np.stack([np.bincount(owner[v > x], minlength=n) for x in LEVELS], 1).astype(float)
    length = np.log1p(size)[:, None]
    x = np.concatenate([top, length, np.log1p(passed), passed / np.sqrt(size + 1)[:, None]], 1)
    return np.concatenate([x, x * length / 5], 1)


def _unit_counts(language):
    """Documents with each unit by half and label: columns n00, n01 (half 0), n10, n11."""
    def run(batches):
        restorer, n = Restorer(language.value), np.zeros((4, SLOTS + 1), np.int64)
        for b in frames_of(batches):
            kind = 2 * b.column(2).to_numpy() + b.column(1).to_numpy()
            owner, word, units = _occurrences(b.column(0).to_pylist(), restorer)
            seen = np.unique((owner[:, None] * (SLOTS + 1) + units[word]).ravel())
            for k in range(4):
                n[k] += np.bincount(seen[kind[seen // (SLOTS + 1)] == k] % (SLOTS + 1), minlength=SLOTS + 1)
        has = np.flatnonzero(n[:, :SLOTS].sum(0))
        yield pa.RecordBatch.from_arrays([pa.array(has), *(pa.array(x[has]) for x in n)], names=["slot", "n00", "n01", "n10", "n11"])
    return tidy(run)


def _features(language, halves):
    """Pooled features of each text under the weights of the half it is not in."""
    def run(batches):
        restorer = Restorer(language.value)
        for b in frames_of(batches):
            half, texts = b.column(2).to_numpy(), b.column(0).to_pylist()
            for h in (0, 1):
                rows = np.flatnonzero(half == h)
                if len(rows):
                    x = pooled([texts[i] for i in rows], restorer, halves.value[1 - h])
                    yield pa.RecordBatch.from_arrays(
                        [b.column(1).take(pa.array(rows)), pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel()))],
                        names=["y", "x"])
    return tidy(run)


def _log_odds(slot, n0, n1, all0: int, all1: int, prior: float) -> np.ndarray:
    """Weight of each unit's slot; 0 for units in fewer than three documents."""
    out = np.zeros(SLOTS)
    base = (n0 + n1) / max(1, all0 + all1)
    w = np.log((n1 + prior * base + 1e-9) / (all1 + prior)) - np.log((n0 + prior * base + 1e-9) / (all0 + prior))
    out[slot] = np.where(n0 + n1 >= 3, w, 0.0)
    return out


def _regression(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 40):
    middle, scale = x.mean(0), x.std(0) + 1e-6
    z = np.column_stack([(x - middle) / scale, np.ones(len(x))])
    beta = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        slope = z.T @ (p - y) + ridge * beta
        curve = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(beta))
        beta = beta - np.linalg.solve(curve, slope)
    return middle, scale, beta


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, work: Workspace, most_labelled: int = 40_000, prior: float = 50.0,
    id_col: str = "doc_id", text: str = "text", label: str = "toxic",
) -> ToxicityModel:
    """Learn from ``labels(id, label)`` which texts are toxic.

    The character model counts all ``docs``.  The score is fitted on at most
    ``most_labelled`` labelled rows, those of lowest id hash.  Units weigh their log odds,
    damped by ``prior`` rows at the overall rate; the regression sees each row's pooled
    weights as the other half of the rows has them, so that it learns how far to trust
    weights of words a text was not learned from.  Null labels, ids and texts are not learned from; with
    one class only, or no labels, every score is that class's share (0 without any).
    """
    sc = docs.sparkSession.sparkContext
    language = log_model(count_grams(docs, text))
    shared = sc.broadcast(language)
    known = (
        labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull())
        .select(F.col(id_col).cast("long").alias("id"), F.col(label).cast("int").alias("y"))
        .groupBy("id").agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("id"), "id").limit(most_labelled))
    texts = docs.where(F.col(text).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    # Its rows are bounded by most_labelled: a broadcast spares shuffling all texts.
    held = work.store(
        texts.join(F.broadcast(known), "id").withColumn("half", F.pmod(F.xxhash64("id", F.lit(3)), F.lit(2))), "labelled")
    kinds = ("n00", "n01", "n10", "n11")
    rows = held.select("text", "y", F.col("half").cast("int").alias("half"))
    counts = rows.mapInArrow(_unit_counts(shared), "slot bigint, n00 bigint, n01 bigint, n10 bigint, n11 bigint")
    found = counts.groupBy("slot").agg(*(F.sum(k).alias(k) for k in kinds)).where("n00 + n01 + n10 + n11 >= 3").toArrow()
    slot, *n = (found.column(i).to_numpy() for i in range(5))
    size = np.zeros(4, np.int64)
    for r in held.groupBy("half", "y").agg(F.count("*").alias("n")).collect():
        size[2 * r["half"] + r["y"]] = r["n"]
    halves = [_log_odds(slot, n[2 * h], n[2 * h + 1], size[2 * h], size[2 * h + 1], prior) for h in (0, 1)]
    weights = _log_odds(slot, n[0] + n[2], n[1] + n[3], size[0] + size[2], size[1] + size[3], prior)
    x = rows.mapInArrow(_features(shared, sc.broadcast(halves)), "y int, x array<double>").toArrow()
    work.drop(held)
    y, bad = x.column(0).to_numpy(), size[1] + size[3]
    width = 2 * (len(TOPS) + 1 + 2 * len(LEVELS))
    if not 0 < bad < size.sum():
        share = np.clip(bad / max(1, size.sum()), 1e-9, 1 - 1e-9)
        return ToxicityModel(language, weights, np.zeros(width), np.ones(width), np.append(np.zeros(width), np.log(share / (1 - share))))
    return ToxicityModel(language, weights, *_regression(np.stack(x.column(1).to_pylist()), y))


def _scores(model):
    def run(batches):
        m = model.value
        restorer = Restorer(m.language)
        for b in frames_of(batches):
            x = (pooled(b.column(1).to_pylist(), restorer, m.units) - m.middle) / m.scale
            p = 1 / (1 + np.exp(-np.clip(x @ m.beta[:-1] + m.beta[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p)], names=["doc_id", "score"])
    return tidy(run)


def toxicity(docs: DataFrame, model: ToxicityModel, cut: float = 0.3, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, score, predicted)`` for every row, from its restored whole text alone.

    Null and empty texts get the score of a text without words; ids may be null or repeat.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    scored = src.mapInArrow(_scores(shared), "doc_id bigint, score double")
    return scored.withColumn("predicted", (F.col("score") >= cut).cast("int"))


def marked(docs: DataFrame, model: ToxicityModel, cut: float = 0.3, text: str = "text", out: str = "toxic_score") -> DataFrame:
    """All columns of ``docs`` and the score ``out``: what a filter needs without a join.

    Null and empty texts get the score of no words; repeated rows score alike; an empty table
    stays empty; an input column named ``out`` is replaced.
    """
    docs = docs.drop(out)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches):
        m = shared.value
        restorer = Restorer(m.language)
        for b in frames_of(batches):
            x = (pooled(b.column(at).to_pylist(), restorer, m.units) - m.middle) / m.scale
            p = 1 / (1 + np.exp(-np.clip(x @ m.beta[:-1] + m.beta[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(p)], names=[*b.schema.names, out])

    schema = docs.withColumn(out, F.lit(0.0)).schema
    return docs.mapInArrow(tidy(run), schema)
