"""Exact top-k inner-product search over vector-approximation blocks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StructField, StructType, LongType, IntegerType

FOUND = StructType([
    StructField("query_id", LongType()), StructField("vec_id", LongType()), StructField("score", LongType()),
])
SAFE = 1 << 24  # below it, sums of thousands of products are exact in double precision


def usable(vector) -> F.Column:
    """Not null, and no component null, infinite or not a number."""
    v = F.col(vector) if isinstance(vector, str) else vector
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return v.isNotNull() & ~F.coalesce(bad, F.lit(True))


def scaled(vectors: pd.Series, scale: float) -> np.ndarray:
    """Floor of scale * component; float matrix, exact for whole numbers below 2**53."""
    return np.floor(np.stack([np.asarray(v, np.float64) for v in vectors]) * scale)


class Approximation:
    """The vector-approximation file of one block of whole-number vectors.

    Every dimension's range is cut into ``2**bits`` equal cells and each vector is kept
    as cell numbers of a byte.  The inner product with the cells' centres, plus and minus
    the query's share of half a cell in each dimension, bounds the true score.
    """

    def __init__(self, exact: np.ndarray, bits: int):
        low, high = exact.min(0), exact.max(0)
        self.width = np.maximum(np.ceil((high - low + 1) / (1 << bits)), 1.0)
        self.cells = ((exact - low) // self.width).astype(np.uint8)
        self.centre, self.exact = low + (self.width - 1) / 2, exact

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(middle of each vector's score range by query, half its length by query)"""
        middle = (queries * self.width) @ self.cells.T.astype(np.float64) + (queries @ self.centre)[:, None]
        return middle, np.abs(queries) @ ((self.width - 1) / 2)


def _scores(rows: np.ndarray, query: np.ndarray) -> list[int] | np.ndarray:
    if max(np.abs(rows).max(initial=0), np.abs(query).max(initial=0)) < SAFE:
        return (rows @ query).astype(np.int64)
    whole = [int(x) for x in query]  # beyond exact doubles: Python's whole numbers
    top = 2**63 - 1
    return np.array([max(-top, min(top, sum(int(a) * b for a, b in zip(r, whole)))) for r in rows], np.int64)


def search_block(ids, exact, query_ids, queries, k: int, bits: int) -> tuple[list, list, list]:
    """The exact k best of one block for each query: (query ids, vector ids, scores)."""
    va = Approximation(exact, bits)
    out_q, out_v, out_s = [], [], []
    for at in range(0, len(queries), 256):
        part = queries[at:at + 256]
        middle, half = va.bounds(part)
        for i, q in enumerate(part):
            m = middle[i]
            own = np.flatnonzero(ids == query_ids[at + i])
            m[own] = -np.inf
            n = len(m) - len(own)
            if n <= 0:
                continue
            take = min(k, n)
            # A vector whose upper bound is below the take-th lower bound cannot be among the best.
            floor = np.partition(m, len(m) - take)[len(m) - take] - half[i]
            slack = 1e-9 * (abs(floor) + half[i] + 1)
            near = np.flatnonzero(m + half[i] >= floor - slack)
            near = near[np.argsort(-m[near], kind="stable")]
            best_s, best_v, done = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
            while done < len(near):
                # Read exact vectors in the order of their bounds until the kth is certain.
                if len(best_s) >= take and m[near[done]] + half[i] < best_s[take - 1] - slack:
                    break
                step = near[done:done + 4 * take]
                done += len(step)
                best_s = np.concatenate([best_s, _scores(exact[step], q)])
                best_v = np.concatenate([best_v, ids[step]])
                order = np.lexsort((best_v, -best_s))[:take]
                best_s, best_v = best_s[order], best_v[order]
            out_q += [int(query_ids[at + i])] * len(best_s)
            out_v += best_v.tolist()
            out_s += best_s.tolist()
    return out_q, out_v, out_s


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int, scale: float = 256.0, bits: int = 5,
    block: int = 8192, query_block: int = 2048, id_col: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k candidates of highest inner product.

    Components count as floor(scale * x).  Candidates are dealt over blocks of about
    ``block`` rows by a hash of the id, queries over blocks of ``query_block``; one task
    takes one pair of blocks, so its memory is bounded whatever the tables hold.  Each
    task returns its block's exact k best, and the merge ranks k rows a block.

    Defined cases: vectors that are null, empty or have a null or non-finite component
    take no part; vectors of another dimension than the query's are no candidates; ties
    go to the smaller id; rows with an equal id are one another's own row; scores beyond
    64 bits stop at their ends; empty tables give no rows.
    """
    def keyed(df):
        ok = df.where(F.col(id_col).isNotNull() & usable(vector) & (F.size(vector) > 0))
        return ok.select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"),
                         F.size(vector).alias("dim"))

    c, q = keyed(vectors), keyed(queries)
    blocks = max(1, -(-vectors.count() // block))
    parts = max(1, -(-queries.count() // query_block))
    c = c.withColumn("cb", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).withColumn(
        "qb", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    q = q.withColumn("qb", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")).withColumn(
        "cb", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def pair(left, right):
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        found = search_block(left["id"].to_numpy(), scaled(left["v"], scale), right["id"].to_numpy(),
                             scaled(right["v"], scale), k, bits)
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), found))).astype("int64")

    keys = ("cb", "qb", "dim")
    found = c.groupBy(*keys).cogroup(q.groupBy(*keys)).applyInPandas(pair, FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
