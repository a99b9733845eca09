"""Embedding near-duplicates: one small-world graph per shard, every shard queried."""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from punctua.llm.common import Workspace
from punctua.llm.components import components, local_forest
from punctua.llm.topk import usable

GRAPH = "shard int, dim int, graph binary"
FOUND = "id bigint, links bigint, other bigint"


class SmallWorld:
    """A hierarchical navigable small-world graph, searched for many queries in step.

    ``layers[l]`` holds each node's neighbours on layer ``l`` (-1: none); a node's top
    layer is drawn from a geometric law.  Nodes enter in batches: every batch searches
    the graph so far, meets its own members by one matrix product, and links both ways,
    keeping neighbours that are nearer to the node than to one another.
    """

    def __init__(self, unit: np.ndarray, width: int = 12, seed: int = 7, beam: int = 32):
        self.x, n = unit.astype(np.float32), len(unit)
        rng = np.random.default_rng(seed)
        self.top = np.minimum(np.floor(-np.log(rng.random(n) + 1e-12) / np.log(width)), 8).astype(np.int64)
        self.top[:1] = self.top.max(initial=0)
        self.layers = [np.full((n, width * (2 if l == 0 else 1)), -1, np.int32) for l in range(self.top.max(initial=0) + 1)]
        at, size = 1, 16
        while at < n:
            self._insert(np.arange(at, min(n, at + size)), beam)
            at, size = at + size, min(512, size * 2)

    def _insert(self, batch: np.ndarray, beam: int) -> None:
        q = self.x[batch]
        entry = np.zeros((len(batch), 1), np.int64)
        near = q @ q.T
        np.fill_diagonal(near, -np.inf)
        for layer in range(len(self.layers) - 1, -1, -1):
            ids, sims = self._beam(q, entry, layer, beam if layer == 0 else 8)
            entry = ids
            rows = np.flatnonzero(self.top[batch] >= layer)
            if not len(rows):
                continue
            mates = near[np.ix_(rows, rows)]
            m = min(self.layers[layer].shape[1], len(rows) - 1)
            pick = np.argsort(-mates, axis=1)[:, :m]
            ids = np.concatenate([ids[rows], batch[rows[pick]]], axis=1)
            sims = np.concatenate([sims[rows], np.take_along_axis(mates, pick, 1)], axis=1)
            links = self.layers[layer]
            links[batch[rows]] = self._choose(ids, sims, links.shape[1])
            self._link_back(layer, batch[rows])

    def _choose(self, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
        order = np.argsort(-sims, axis=1, kind="stable")[:, : most * 2]
        ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        vecs = self.x[np.maximum(ids, 0)]
        between = vecs @ vecs.transpose(0, 2, 1)
        valid = (ids >= 0) & np.isfinite(sims)
        kept = np.zeros_like(valid)
        for j in range(ids.shape[1]):
            shadowed = (kept & (between[:, j] > sims[:, j, None])).any(1)
            kept[:, j] = valid[:, j] & ~shadowed & (kept.sum(1) < most)
        rank = np.where(kept, 0, np.where(valid, 1, 2))
        order = np.argsort(rank, axis=1, kind="stable")[:, :most]
        out = np.where(np.take_along_axis(rank, order, 1) < 2, np.take_along_axis(ids, order, 1), -1)
        return np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1) if out.shape[1] < most else out

    def _link_back(self, layer: int, nodes: np.ndarray) -> None:
        links = self.layers[layer]
        most = links.shape[1]
        to, source = links[nodes].ravel(), np.repeat(nodes, most)
        ok = to >= 0
        to, source = to[ok].astype(np.int64), source[ok]
        sims = np.einsum("ij,ij->i", self.x[to], self.x[source])
        order = np.lexsort((-sims, to))
        to, source, sims = to[order], source[order], sims[order]
        first = np.r_[True, to[1:] != to[:-1]]
        place = np.arange(len(to)) - np.maximum.accumulate(np.where(first, np.arange(len(to)), 0))
        target, row = to[first], np.cumsum(first) - 1
        wide = place < most  # more new links than a list holds: the nearest ones
        new = np.full((len(target), most), -1, np.int64)
        new[row[wide], place[wide]] = source[wide]
        old = links[target].astype(np.int64)
        new[(new[:, :, None] == old[:, None, :]).any(2)] = -1
        ids = np.concatenate([old, new], axis=1)
        s = np.einsum("tmd,td->tm", self.x[np.maximum(ids, 0)], self.x[target])
        s[ids < 0] = -np.inf
        links[target] = self._choose(ids, s, most)

    def _beam(self, q: np.ndarray, entry: np.ndarray, layer: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` best nodes met from the entries on, for each query: (ids, similarities)."""
        n, links = len(q), self.layers[layer]
        ids = np.full((n, beam), -1, np.int64)
        sims = np.full((n, beam), -np.inf, np.float32)
        entry = entry[:, :beam]
        ids[:, : entry.shape[1]] = entry
        first = np.einsum("bmd,bd->bm", self.x[np.maximum(entry, 0)], q)
        first[entry < 0] = -np.inf
        sims[:, : entry.shape[1]] = first
        done = np.zeros((n, beam), bool)
        live = np.arange(n)
        while len(live):
            open_sims = np.where(done[live] | (ids[live] < 0), -np.inf, sims[live])
            best = open_sims.argmax(1)
            go = open_sims[np.arange(len(live)), best] > -np.inf
            live, best = live[go], best[go]
            if not len(live):
                break
            done[live, best] = True
            near = links[ids[live, best]].astype(np.int64)
            have = ids[live]
            near[(near[:, :, None] == have[:, None, :]).any(2)] = -1
            s = (self.x[np.maximum(near, 0)] @ q[live][:, :, None])[:, :, 0]
            s[near < 0] = -np.inf
            all_ids = np.concatenate([have, near], axis=1)
            all_sims = np.concatenate([sims[live], s], axis=1)
            all_done = np.concatenate([done[live], np.zeros(near.shape, bool)], axis=1)
            keep = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
            ids[live] = np.take_along_axis(all_ids, keep, 1)
            sims[live] = np.take_along_axis(all_sims, keep, 1)
            done[live] = np.take_along_axis(all_done, keep, 1)
        ids[~np.isfinite(sims)] = -1
        return ids, sims

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        q = q.astype(np.float32)
        entry = np.zeros((len(q), 1), np.int64)
        for layer in range(len(self.layers) - 1, 0, -1):
            entry, _ = self._beam(q, entry, layer, 4)
        return self._beam(q, entry, 0, beam)

    def dump(self, **more: np.ndarray) -> bytes:
        out = io.BytesIO()
        np.savez(out, top=self.top, n=len(self.layers), **{f"layer{i}": a for i, a in enumerate(self.layers)}, **more)
        return out.getvalue()

    @classmethod
    def load(cls, raw: bytes) -> tuple["SmallWorld", dict]:
        held = np.load(io.BytesIO(raw))
        out = cls.__new__(cls)
        out.top, out.layers = held["top"], [held[f"layer{i}"] for i in range(int(held["n"]))]
        out.x = held["unit"].astype(np.float32)
        return out, {"ids": held["ids"], "unit": held["unit"]}


def unit_rows(vectors: pd.Series) -> np.ndarray:
    v = np.stack([np.asarray(x, np.float64) for x in vectors])
    v /= np.abs(v).max(1, keepdims=True)  # before the norm, so that no square overflows or vanishes
    return v / np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]


def planted(unit: np.ndarray, least: float, most: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``most`` rows of a shard, evenly spaced, and for each a vector just over ``least`` alike in a random direction."""
    at = np.unique(np.linspace(0, len(unit) - 1, min(most, len(unit))).astype(np.int64))
    aside = np.random.default_rng(11).normal(size=(len(at), unit.shape[1]))
    aside -= np.einsum("ij,ij->i", aside, unit[at])[:, None] * unit[at]
    aside /= np.maximum(np.sqrt(np.einsum("ij,ij->i", aside, aside)), 1e-12)[:, None]
    alike = min(1.0, least + 1e-3)
    return at, alike * unit[at] + np.sqrt(1 - alike**2) * aside


def links_in_shard(graph, ids, unit, query_ids, queries, least: float, recall: float, beam: int, audit: int):
    """Links of the queries with one shard: (counts by query, pairs' query ids, pairs' ids).

    The audit doubles the beam until the wanted share is found of two sets: the links of
    every ``audit``-th query, chosen by position, with other ids, known from an exact scan;
    and the links planted just over the threshold (:func:`planted`), which are there
    however few near copies the table has.  A beam that ends full of links may hide more:
    those queries scan the shard exactly.  Rows sharing an id count as one vector.
    """
    close = least - 1e-4  # the graph works in single precision
    probe = np.arange(0, len(queries), audit)
    truth = unit @ queries[probe].T >= least if len(probe) else np.zeros((len(ids), 0), bool)
    truth &= ids[:, None] != query_ids[probe][None, :]
    source, near_source = planted(unit, least)
    while True:
        near, sims = graph.search(near_source, min(beam, len(ids)))
        seen = ((near == source[:, None]).any(1) | (sims >= close).all(1)).sum()
        if beam < len(ids) and seen < recall * len(source):
            beam *= 2
            continue
        found_q, found_v = [], []
        for at in range(0, len(queries), 1024):
            part = queries[at:at + 1024]
            near, sims = graph.search(part, min(beam, len(ids)))
            full = (sims >= close).all(1) & (sims.shape[1] < len(ids))
            r, c = np.nonzero((sims >= close) & (near >= 0) & ~full[:, None])
            v = near[r, c]
            true = np.einsum("ij,ij->i", part[r], unit[v]) >= least
            found_q.append(at + r[true])
            found_v.append(v[true])
            wide = np.flatnonzero(full)
            for w in range(0, len(wide), 256):
                r, v = np.nonzero(part[wide[w:w + 256]] @ unit.T >= least)
                found_q.append(at + wide[w + r])
                found_v.append(v)
        q, v = np.concatenate(found_q or [probe]), np.concatenate(found_v or [probe])
        other = ids[v] != query_ids[q]
        q, v = q[other], v[other]
        in_probe = q % audit == 0
        if beam >= len(ids) or in_probe.sum() >= recall * truth.sum():
            break
        beam *= 2
    first, of = np.unique(query_ids, return_index=True)[1], np.searchsorted(np.unique(query_ids), query_ids)
    if len(first) < len(query_ids) or len(np.unique(ids)) < len(ids):
        _, once = np.unique(np.stack([query_ids[q], ids[v]]), axis=1, return_index=True)
        q, v = first[of[q[once]]], v[once]
    return np.bincount(q, minlength=len(queries)), q, v


def embedding_groups(
    vectors: DataFrame, work: Workspace, least: float = 0.95, shards: int = 8, shard_rows: int = 50_000,
    block_rows: int = 65_536, recall: float = 0.995, beam: int = 24, audit: int = 50,
    id_col: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` by links of cosine ``least`` or more.

    Rows are dealt over shards by a hash of the id: ``shards`` of them, more once a shard
    would pass ``shard_rows`` (a memory bound).  Each shard's graph is built once and
    stored.  All rows, in blocks, query every shard; a task holds one graph and one
    block.  Cosines are confirmed in double precision on the stored vectors.  A task
    returns link counts and a spanning forest of its links, never the pairs.

    Defined cases: vectors that are null, empty, zero or hold a null or non-finite
    component link with nothing (0 links, their own component); vectors of different
    dimension never link; rows sharing an id are one vector, linked with what any of them
    is near (other ids, each counted once for each dimension); a null id
    takes no part and gets a null component, not kept; an empty table gives no rows.
    """
    n = vectors.count()
    shards, blocks = max(shards, -(-n // shard_rows)), max(1, -(-n // block_rows))
    ok = usable(vector) & F.exists(vector, lambda x: x != 0)
    rows = vectors.where(F.col(id_col).isNotNull() & ok).select(
        F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"),
        F.size(vector).alias("dim"))

    def build(key, part):
        part = part.sort_values("id", kind="stable")
        unit = unit_rows(part["v"])
        raw = SmallWorld(unit).dump(ids=part["id"].to_numpy(), unit=unit)
        return pd.DataFrame({"shard": [key[0]], "dim": [key[1]], "graph": [raw]})

    shard_of = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(shards)).cast("int")
    graphs = work.store(
        rows.withColumn("shard", shard_of).groupBy("shard", "dim").applyInPandas(build, GRAPH), "graphs")

    def query(key, graph, part):
        if not len(graph) or not len(part):
            return pd.DataFrame({"id": [], "links": [], "other": []}).astype("int64")
        world, held = SmallWorld.load(graph["graph"][0])
        part = part.sort_values("id", kind="stable")
        ids = part["id"].to_numpy()
        counts, q, v = links_in_shard(world, held["ids"], held["unit"], ids, unit_rows(part["v"]),
                                      least, recall, beam, audit)
        has = np.flatnonzero(counts)
        a, b = local_forest(ids[q], held["ids"][v])
        out = pd.DataFrame({"id": np.concatenate([ids[has], a]),
                            "links": np.concatenate([counts[has], np.zeros(len(a), np.int64)]),
                            "other": pd.array(np.concatenate([np.zeros(len(has), np.int64), b]), "Int64")})
        out.loc[: len(has) - 1, "other"] = pd.NA
        return out

    block_of = F.pmod(F.xxhash64("id", F.lit(2)), F.lit(blocks)).cast("int")
    left = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = rows.withColumn("block", block_of).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    keys = ("shard", "dim", "block")
    found = work.store(left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(query, FOUND), "found")
    counts = found.where("other is null").groupBy("id").agg(F.sum("links").alias("n"))
    classes = components(found.where("other is not null").select(F.col("id").alias("a"), F.col("other").alias("b")), work)
    out = (
        vectors.select(F.col(id_col).cast("long").alias("id"))
        .join(counts, "id", "left").join(classes, "id", "left")
    )
    component = F.coalesce("component", "id")
    return out.select(
        F.col("id").alias("vec_id"), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"))
