"""Boosted trees, MLlib's, grown on binned columns.

MLlib passes over one object per row for every level of a tree.  Here the rows are binned
once, by MLlib's own split candidates, into blocks of columns of a byte a value.  A level is
one Spark job: tasks count what the nodes of that level hold per feature and bin, Spark adds
the counts up, and the driver picks the splits.  Rows drawn, features tried, gains, stopping
and the model's classes are MLlib's, so its trees come out, up to the last digits of sums.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, functions as F

from punctua.session import stored

BLOCK = 1 << 18  # rows that are held together
CHUNK = 1 << 16  # rows that are counted together: their columns fit a core's cache
PACK = float(1 << 26)  # a row of label 1 in a sum of counts; a task's blocks have fewer rows
LANE = 64  # random numbers drawn one after the other
MOST = 1 << 21  # rows of a task, unless a block has more
EPSILON = 2.0**-52  # MLlib's impurity of a pure node
ROUNDING = 1e-13  # a gain of less than this share of the squared targets, or above another gain, is one of rounding


# --- random numbers ------------------------------------------------------------------

MASK = (1 << 64) - 1


def hashed_seed(seed: int) -> int:
    """Spark's start of a random sequence: MurmurHash3 of the seed's bytes, twice."""

    def murmur(data: bytes, h: int) -> int:
        turn = lambda x, r: (x << r | x >> 32 - r) & 0xFFFFFFFF
        for i in (0, 4):
            k = turn(int.from_bytes(data[i : i + 4], "little") * 0xCC9E2D51 & 0xFFFFFFFF, 15)
            h = turn(h ^ (k * 0x1B873593 & 0xFFFFFFFF), 13) * 5 + 0xE6546B64 & 0xFFFFFFFF
        h ^= 8
        h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
        h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
        return h ^ h >> 16

    data = (seed & MASK).to_bytes(8, "big")
    low = murmur(data, 0x3C074A61)
    return murmur(data, low) << 32 | low


def _next(s):
    """The next state of Spark's XORShift sequence, of one or of many."""
    many = isinstance(s, np.ndarray)
    up, down, last = (np.uint64(21), np.uint64(35), np.uint64(4)) if many else (21, 35, 4)
    s = s ^ (s << up if many else s << up & MASK)
    s = s ^ s >> down
    return s ^ (s << last if many else s << last & MASK)


@cache
def _steps(power: int) -> tuple[int, ...]:
    """What 2**power steps make of each single bit; steps are linear in the bits."""
    if not power:
        return tuple(_next(1 << i) for i in range(64))
    half = _steps(power - 1)
    return tuple(_applied(half, x) for x in half)


def _applied(steps: tuple[int, ...], s: int) -> int:
    out = 0
    while s:
        low = s & -s
        out ^= steps[low.bit_length() - 1]
        s ^= low
    return out


def uniform(seed: int, start: int, n: int) -> np.ndarray:
    """The doubles from ``start`` on of Spark's random sequence of ``seed``; each takes two steps."""
    state = hashed_seed(seed)
    for power in range((2 * start).bit_length()):
        if 2 * start >> power & 1:
            state = _applied(_steps(power), state)
    if n <= LANE:
        out = np.empty(n)
        for i in range(n):
            high = _next(state)
            state = _next(high)
            out[i] = ((high & (1 << 26) - 1) << 27) + (state & (1 << 27) - 1)
        return out * 2.0**-53
    # Lanes start LANE numbers apart and then step together.
    states = np.array([state], dtype=np.uint64)
    lanes, power = -(-n // LANE), (2 * LANE).bit_length() - 1
    while len(states) < lanes:
        further = np.zeros_like(states)
        for bit, moved in enumerate(_steps(power)):
            further ^= np.where(states >> np.uint64(bit) & np.uint64(1), np.uint64(moved), np.uint64(0))
        states, power = np.concatenate([states, further]), power + 1
    states = states[:lanes]
    out = np.empty((LANE, lanes))
    for i in range(LANE):
        high = _next(states)
        states = _next(high)
        whole = ((high & np.uint64((1 << 26) - 1)) << np.uint64(27)) + (states & np.uint64((1 << 27) - 1))
        out[i] = whole * 2.0**-53
    return out.T.ravel()[:n]


def drawn_features(width: int, k: int, seed: int) -> list[int]:
    """``k`` of ``width`` features, as Spark's reservoir holds them."""
    held = list(range(k))
    for item, u in zip(range(k, width), uniform(seed, 0, width - k) if width > k else ()):
        at = int(u * (item + 1))
        if at < k:
            held[at] = item
    return held


# --- candidates and blocks --------------------------------------------------------------


@dataclass
class Candidates:
    """MLlib's split candidates: thresholds of a number (None for a category), bins, features tried per node."""

    thresholds: list[np.ndarray | None]
    bins: list[int]
    tried: int

    @property
    def widest(self) -> int:
        return max(self.bins)

    @property
    def small(self) -> np.dtype:
        return np.dtype(np.uint8 if self.widest <= 256 else np.uint16 if self.widest <= 1 << 16 else np.int32)


def candidates(booster: GBTClassifier, fit: DataFrame) -> Candidates:
    """Asks MLlib for the split candidates that its own trees would use on ``fit``."""
    jvm, ml = SparkSession.active()._jvm, SparkSession.active()._jvm.org.apache.spark.ml
    single = lambda package, name: getattr(getattr(package, f"{name}$"), "MODULE$")
    booster._transfer_params_to_java()
    inner = booster._java_obj
    columns = fit.select(booster.getFeaturesCol(), booster.getLabelCol(), booster.getWeightCol())
    width = fit.schema[booster.getFeaturesCol()].metadata["ml_attr"]["num_attrs"]
    empty = columns.withColumn(booster.getFeaturesCol(), array_to_vector(F.array_repeat(F.lit(0.0), width)))
    field_ = columns._jdf.schema().apply(booster.getFeaturesCol())
    mllib = jvm.org.apache.spark.mllib.tree
    strategy = inner.getOldBoostingStrategy(
        ml.util.MetadataUtils.getCategoricalFeatures(field_), mllib.configuration.Algo.Classification()
    ).treeStrategy().copy()
    strategy.setAlgo(mllib.configuration.Algo.Regression())
    strategy.setImpurity(single(mllib.impurity, "Variance"))
    instances = lambda df: single(ml.util, "DatasetUtils").extractInstances(inner, df._jdf, jvm.scala.Some(2))
    # Rows and weights are counted beside empty features, which is all that the description needs of them.
    told = ml.tree.impl.DecisionTreeMetadata.buildMetadata(
        instances(empty), strategy, 1, booster.getFeatureSubsetStrategy()
    )
    splits = single(ml.tree.impl, "RandomForest").findSplits(instances(columns), told, booster.getSeed())
    numbers = [told.isContinuous(f) for f in range(told.numFeatures())]
    thresholds = [np.array([s.threshold() for s in splits[f]], dtype=float) if n else None for f, n in enumerate(numbers)]
    bins = [told.numBins()[f] if t is None else len(t) + 1 for f, t in enumerate(thresholds)]
    return Candidates(thresholds, bins, told.numFeaturesPerNode())


@dataclass
class Block:
    """Up to ``BLOCK`` rows of one partition: fitted ones, which know their place in it, or validation rows."""

    valid: bool
    part: int
    start: int
    bins: np.ndarray  # feature x row
    y: np.ndarray  # -1 or 1
    margin: np.ndarray
    drawn: np.ndarray | None = None


def binned(rows: DataFrame, columns: Sequence[str], label: str, valid: str, cand: Candidates) -> DataFrame:
    """Blocks of rows as a table.  Rows keep their partition and order, which decide what is drawn."""
    def of(column: np.ndarray, f: int) -> np.ndarray:
        cuts = cand.thresholds[f]
        return (column if cuts is None else np.searchsorted(cuts, column)).astype(cand.small)

    def to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start = TaskContext.get().partitionId(), 0
        waiting = {False: [], True: []}

        def flush(kind: bool) -> pa.RecordBatch:
            nonlocal start
            bins, y = (np.concatenate(x, axis=-1) for x in zip(*waiting[kind]))
            waiting[kind] = []
            row = {"valid": [kind], "part": [part], "start": [start], "bins": [bins.tobytes()], "y": [y.tobytes()]}
            start += 0 if kind else len(y)
            return pa.RecordBatch.from_pydict(row, schema)

        for batch in batches:
            y = batch.column(label).to_numpy(zero_copy_only=False)
            if not np.isin(y, (0.0, 1.0)).all():
                raise ValueError(f"labels must be 0 or 1: {y[~np.isin(y, (0.0, 1.0))][:1]}")
            bins = np.stack([of(batch.column(c).to_numpy(zero_copy_only=False), f) for f, c in enumerate(columns)])
            of_valid = batch.column(valid).to_numpy(zero_copy_only=False).astype(bool)
            for kind in (False, True):
                mine = of_valid == kind
                if mine.any():
                    waiting[kind].append((bins[:, mine], (2 * y[mine] - 1).astype(np.int8)))
                    if sum(len(x[1]) for x in waiting[kind]) >= BLOCK:
                        yield flush(kind)
        for kind in (False, True):
            if waiting[kind]:
                yield flush(kind)

    schema = pa.schema([("valid", pa.bool_()), ("part", pa.int32()), ("start", pa.int64()), ("bins", pa.binary()), ("y", pa.binary())])
    return rows.select(*columns, label, valid).mapInArrow(
        to_blocks, "valid boolean, part int, start bigint, bins binary, y binary"
    )


STATE = "valid boolean, part int, start bigint, bins binary, y binary, margin binary, drawn binary, root binary"


def blocks_in(batch: pa.RecordBatch, width: int, small: np.dtype) -> Iterator[Block]:
    """The blocks of a record batch, as views of it."""
    get = {c: batch.column(c) for c in batch.schema.names}
    view = lambda c, i, kind: np.frombuffer(get[c][i].as_buffer(), kind) if c in get and get[c][i].is_valid else None
    for i in range(batch.num_rows):
        y, margin = view("y", i, np.int8), view("margin", i, float)
        yield Block(
            get["valid"][i].as_py(), get["part"][i].as_py(), get["start"][i].as_py(), view("bins", i, small).reshape(width, -1),
            y, np.zeros(len(y)) if margin is None else margin, view("drawn", i, bool),
        )


# --- one tree ------------------------------------------------------------------------------


@dataclass
class Tree:
    """Nodes of a growing tree.  Children follow each other: left, then right; -1 for a leaf."""

    feature: list[int] = field(default_factory=lambda: [0])
    goes_left: list[np.ndarray | None] = field(default_factory=lambda: [None])
    child: list[int] = field(default_factory=lambda: [-1])
    sums: list[tuple[float, float, float]] = field(default_factory=lambda: [(0.0, 0.0, 0.0)])  # rows, weight, weighted target
    squares: list[float] = field(default_factory=lambda: [0.0])
    split: list[tuple | None] = field(default_factory=lambda: [None])
    gain: list[float] = field(default_factory=lambda: [np.nan])

    def add(self, sums: tuple[float, float, float]) -> int:
        for values, x in ((self.feature, 0), (self.goes_left, None), (self.child, -1), (self.sums, sums),
                          (self.squares, 0.0), (self.split, None), (self.gain, np.nan)):
            values.append(x)
        return len(self.child) - 1

    def prediction(self, at: int) -> float:
        _, weight, target = self.sums[at]
        return target / weight if weight else 0.0

    def impurity(self, at: int) -> float:
        _, weight, target = self.sums[at]
        return (self.squares[at] - target * target / weight) / weight if weight else 0.0

    def paths(self, widest: int) -> Paths:
        right = np.zeros((len(self.child), widest), dtype=np.int32)
        for at, left in enumerate(self.goes_left):
            right[at] = at if left is None else self.child[at] + 1 - left
        return Paths(np.array(self.feature, dtype=np.int32), right, max(0, self.depth()),
                     np.array([self.prediction(at) for at in range(len(self.child))]))

    def depth(self) -> int:
        deep = [0] * len(self.child)
        for at, c in enumerate(self.child):
            if c >= 0:
                deep[c] = deep[c + 1] = deep[at] + 1
        return max(deep)


@dataclass
class Paths:
    """A tree as tasks walk it: the feature a node asks, where each bin leads, and the nodes' values."""

    feature: np.ndarray
    leads: np.ndarray  # node x bin; a leaf leads to itself
    depth: int
    value: np.ndarray

    def ends(self, bins: np.ndarray) -> np.ndarray:
        """The node each row has come to."""
        n = bins.shape[1]
        node, leads, widest = np.zeros(n, dtype=np.int32), self.leads.ravel(), self.leads.shape[1]
        if self.depth:
            node = self.leads[0].take(bins[self.feature[0]])
        flat, row = bins.ravel(), np.arange(n)
        for _ in range(self.depth - 1):
            at = self.feature.take(node).astype(np.int64)
            at *= n
            at += row
            step = node * widest
            step += flat.take(at)
            node = leads.take(step)
        return node


def targets(y: np.ndarray, margin: np.ndarray, first: bool) -> np.ndarray:
    """What the trees of a round are fitted to: labels at first, then the slope of MLlib's log loss."""
    return y.astype(float) if first else 4.0 * y / (1.0 + np.exp(2.0 * y * margin))


@dataclass
class Counts:
    """Sums over rows: per built node, feature and bin the packed counts and targets; per node the squared targets."""

    bins: np.ndarray  # built node x feature x (bin) x 2
    squares: np.ndarray
    loss: float = 0.0
    weight: float = 0.0

    def __add__(self, other: Counts) -> Counts:
        return Counts(self.bins + other.bins, self.squares + other.squares, self.loss + other.loss, self.weight + other.weight)


def counted(block: Block, paths: Paths | None, build: np.ndarray, widest: int, positive: float, first: bool) -> Counts:
    """The sums of the drawn rows of a block; ``build`` gives a node's place among those built, or -1."""
    width, n = block.bins.shape
    places = int(build.max()) + 1
    out = Counts(np.zeros((places, width, widest, 2)), np.zeros(len(build)))
    if block.valid:
        return out
    for a in range(0, n, CHUNK):
        bins, y = block.bins[:, a : a + CHUNK], block.y[a : a + CHUNK]
        drawn = block.drawn[a : a + CHUNK]
        g = targets(y, block.margin[a : a + CHUNK], first)
        wg = g * np.where(y > 0, positive, 1.0)
        wg[~drawn] = 0.0
        packed = np.where(y > 0, 1.0 + PACK, 1.0)
        packed[~drawn] = 0.0
        if paths is None or not paths.depth:
            out.squares[0] += np.dot(wg, g)
            base = None
        else:
            bins = np.ascontiguousarray(bins)
            node = paths.ends(bins)
            out.squares += np.bincount(node, wg * g, len(build))
            place = build.take(node)
            place[~drawn] = -1
            rows = np.flatnonzero(place >= 0)
            base, wg, packed = place.take(rows).astype(np.int64) * widest, wg.take(rows), packed.take(rows)
        for f in range(width):
            at = bins[f].astype(np.int64) if base is None else base + bins[f].take(rows)
            out.bins[:, f, :, 0] += np.bincount(at, packed, places * widest).reshape(places, widest)
            out.bins[:, f, :, 1] += np.bincount(at, wg, places * widest).reshape(places, widest)
    return out


def summed(table: DataFrame, of_batch, tasks: int) -> Counts:
    """The sums of all blocks: added up per task, then where tasks are many by a few more, then here."""

    def told(counts: Iterator[Counts]) -> Iterator[pa.RecordBatch]:
        total = None
        for c in counts:
            total = c if total is None else total + c
        if total is not None:
            yield pa.RecordBatch.from_pydict({"sums": pa.array([pickle.dumps(unpacked(total))], pa.binary())})

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return told(c for batch in batches for c in of_batch(batch))

    def of_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return told(pickle.loads(x.as_py()) for batch in batches for x in batch.column("sums"))

    sums = table.mapInArrow(of_task, "sums binary")
    if tasks > 64:
        sums = sums.repartition(8).mapInArrow(of_sums, "sums binary")
    return sum_of([pickle.loads(r.sums) for r in sums.collect()])


def sum_of(counts: list[Counts]) -> Counts:
    total = counts[0]
    for c in counts[1:]:
        total = total + c
    return total


def unpacked(c: Counts) -> Counts:
    """Counts of rows and of rows of label 1 apart, so that sums over tasks stay exact."""
    if c.bins.shape[-1] == 2:
        ones = np.floor(c.bins[..., 0] / PACK)
        c.bins = np.stack([c.bins[..., 0] - ones * PACK, ones, c.bins[..., 1]], axis=-1)
    return c


def best_split(counts: np.ndarray, tried: Sequence[int], cand: Candidates, positive: float, booster: GBTClassifier):
    """The split of most gain: gain, split, bins that go left, sums of both sides; None if none is allowed.

    Features that part the rows alike, as one column and its half do, have gains that differ by
    rounding at most: of these the first tried is taken, however the sums were added up.
    """
    least, min_gain, best = booster.getMinInstancesPerNode(), booster.getMinInfoGain(), None
    for f in tried:
        n_bins = cand.bins[f]
        if n_bins < 2:
            continue
        rows, ones, target = counts[f, :n_bins].T
        weight = rows - ones + positive * ones
        order = np.arange(n_bins)
        if cand.thresholds[f] is None:
            means = np.divide(target, weight, out=np.full(n_bins, np.inf), where=weight > 0)
            order = np.argsort(means, kind="stable")
        n, w, t = (np.cumsum(x[order]) for x in (rows, weight, target))
        ln, lw, lt = n[:-1], w[:-1], t[:-1]
        rn, rw, rt = n[-1] - ln, w[-1] - lw, t[-1] - lt
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = (lt * lt / lw + rt * rt / rw - t[-1] * t[-1] / w[-1]) / w[-1]
        gain[~((ln >= least) & (rn >= least) & (gain >= min_gain))] = -np.inf
        at = int(np.argmax(gain))
        if gain[at] > (best[0] + ROUNDING * abs(best[0]) if best else -np.inf):
            left = np.zeros(cand.widest, dtype=bool)
            left[order[: at + 1]] = True
            cut = [float(c) for c in order[: at + 1]] if cand.thresholds[f] is None else float(cand.thresholds[f][at])
            best = (float(gain[at]), (f, cut), left, (ln[at], lw[at], lt[at]), (rn[at], rw[at], rt[at]))
    return best


def grown(blocks: DataFrame, tasks: int, root: Counts, cand: Candidates, positive: float, first: bool, seed: int, booster: GBTClassifier) -> Tree:
    """One tree: a job per level.  Of two children the smaller is counted; the other is the rest of its parent."""
    draws = SparkSession.active()._jvm.java.util.Random(seed)
    width, tree = len(cand.bins), Tree()
    rows, ones, target = root.bins[0, 0].sum(axis=0)
    tree.sums[0], tree.squares[0] = (rows, rows - ones + positive * ones, target), root.squares[0]
    held, level = {0: root.bins[0]}, [0]
    for depth in range(booster.getMaxDepth()):
        below = []
        for at in level:
            tried = range(width)
            if cand.tried < width:
                tried = drawn_features(width, cand.tried, draws.nextLong())
            best = best_split(held[at], tried, cand, positive, booster)
            if best is None or best[0] <= ROUNDING * tree.squares[at] / tree.sums[at][1]:
                tree.gain[at] = -np.inf if best is None else best[0]
                continue
            tree.gain[at], tree.split[at], tree.goes_left[at], left, right = best
            tree.feature[at], tree.child[at] = best[1][0], tree.add(left)
            tree.add(right)
            below += [(at, tree.child[at]), (at, tree.child[at] + 1)]
        if not below or depth + 1 == booster.getMaxDepth():
            break
        build = np.full(len(tree.child), -1, dtype=np.int32)
        smaller = {}
        for at, c in below[::2]:
            smaller[at] = c if tree.sums[c][0] <= tree.sums[c + 1][0] else c + 1
            build[smaller[at]] = len(smaller) - 1
        paths = tree.paths(cand.widest)

        def of_batch(batch: pa.RecordBatch, paths=paths, build=build) -> Iterator[Counts]:
            return (counted(b, paths, build, cand.widest, positive, first) for b in blocks_in(batch, width, cand.small))

        got = summed(blocks, of_batch, tasks)
        held_below = {}
        for at, c in below:
            part = got.bins[build[smaller[at]]]
            held_below[c] = part if c == smaller[at] else held[at] - part
            tree.squares[c] = got.squares[c]
        # MLlib takes the nodes of a level last in, first out, and splits no pure one.
        held = held_below
        level = [c for _, c in reversed(below) if abs(tree.impurity(c)) >= EPSILON]
    return tree


# --- the forest -----------------------------------------------------------------------------


def stepped(block: Block, paths: Paths | None, rate: float, share: float, seed: int, positive: float, first: bool, widest: int):
    """The block after a tree, with the rows drawn for the next; what the next tree's root holds, squares of the ends, loss."""
    n = len(block.y)
    squares, margin, was = np.zeros(1), block.margin, block.drawn
    if paths is not None:
        squares, margin = np.zeros(len(paths.value)), block.margin.copy()
        for a in range(0, n, CHUNK):
            rows = slice(a, a + CHUNK)
            node = paths.ends(np.ascontiguousarray(block.bins[:, rows]))
            if was is not None:
                y = block.y[rows]
                g = targets(y, block.margin[rows], first)
                squares += np.bincount(node, g * g * np.where(y > 0, positive, 1.0) * was[rows], len(squares))
            margin[rows] += rate * paths.value.take(node)
    drawn = None
    if not block.valid:
        drawn = uniform(seed + block.part + 1, block.start, n) < share if share < 1 else np.ones(n, dtype=bool)
    new = Block(block.valid, block.part, block.start, block.bins, block.y, margin, drawn)
    root = counted(new, None, np.zeros(1, dtype=np.int32), widest, positive, paths is None)
    root.squares = np.concatenate([root.squares, squares])
    if block.valid:
        w = np.where(block.y > 0, positive, 1.0)
        root.loss, root.weight = float(np.dot(w, 2.0 * np.logaddexp(0.0, -2.0 * block.y * margin))), float(w.sum())
    return new, root


def stepped_table(table: DataFrame, width: int, small: np.dtype, **how) -> DataFrame:
    """The state after a tree, stored; a row is a block and what it tells of the next root."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in blocks_in(batch, width, small):
                new, root = stepped(b, widest=widest, **how)
                yield pa.RecordBatch.from_pydict({
                    "valid": [new.valid], "part": pa.array([new.part], pa.int32()), "start": [new.start],
                    "bins": pa.array([new.bins.tobytes()], pa.binary()), "y": pa.array([new.y.tobytes()], pa.binary()),
                    "margin": pa.array([new.margin.tobytes()], pa.binary()),
                    "drawn": pa.array([None if new.drawn is None else new.drawn.tobytes()], pa.binary()),
                    "root": pa.array([pickle.dumps(unpacked(root))], pa.binary()),
                })

    widest = how.pop("widest")
    return stored(table.mapInArrow(step, STATE))


def removed(table: DataFrame) -> None:
    """Deletes a stored table that nothing will read again."""
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(table.inputFiles()[0]).getParent()
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def roots_in(batch: pa.RecordBatch) -> Iterator[Counts]:
    return (pickle.loads(x.as_py()) for x in batch.column("root"))


def grow_forest(booster: GBTClassifier, blocks: DataFrame, cand: Candidates, positive: float, rounds: int, stop) -> list[Tree]:
    """Trees until ``stop`` (asked after each round for the losses so far) says how many are to stay, or all rounds are used."""
    trees, losses, width = [], [], len(cand.bins)
    rate, share, seed = booster.getStepSize(), booster.getSubsamplingRate(), booster.getSeed()
    told = blocks.agg(F.count("*"), F.sum(F.length("y"))).first()
    tasks = max(min(told[0], 2 * blocks.sparkSession.sparkContext.defaultParallelism), told[1] // MOST, 1)
    state, paths = blocks.repartition(tasks), None
    while True:
        n = len(trees)
        after = stepped_table(state, width, cand.small, paths=paths, rate=1.0 if n == 1 else rate, share=share, seed=seed + n,
                              positive=positive, first=n == 1, widest=cand.widest)
        if n:
            removed(state)
        state = after
        root = summed(state.select("root"), roots_in, tasks)
        if n:
            tree, ends = trees[-1], root.squares[1:]
            for at, c in enumerate(tree.child):
                if c < 0:
                    tree.squares[at] = ends[at]
            losses.append(root.loss / root.weight if root.weight else np.nan)
            keep = stop(losses) if root.weight else None
            if keep or n >= rounds:
                removed(state)
                return trees[: keep or (stop(losses, True) if root.weight else n)]
        root.squares = root.squares[:1]
        rows = state.where(~F.col("valid")).drop("root")
        trees.append(grown(rows, tasks, root, cand, positive, not n, seed + n, booster))
        paths = trees[-1].paths(cand.widest)


def as_model(booster: GBTClassifier, trees: Sequence[Tree], cand: Candidates) -> GBTClassificationModel:
    """The trees as MLlib's model, with the settings of ``booster``."""
    spark = SparkSession.active()
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    nodes, regression = jvm.org.apache.spark.ml.tree, jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel

    def doubles(values):
        array = gateway.new_array(jvm.double, len(values))
        for i, x in enumerate(values):
            array[i] = float(x)
        return array

    def node(t: Tree, at: int):
        """The node and, of a leaf, its value: two leaves of one value are one, as MLlib prunes."""
        rows, weight, target = t.sums[at]
        stats = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(doubles((weight, target, t.squares[at])), int(rows))
        value, impurity = t.prediction(at), float(t.impurity(at))
        if t.child[at] < 0:
            return nodes.LeafNode(value, -1.0 if t.gain[at] == -np.inf else impurity, stats), value
        (left, a), (right, b) = node(t, t.child[at]), node(t, t.child[at] + 1)
        if a is not None and a == b:
            return nodes.LeafNode(value, impurity, stats), value
        f, cut = t.split[at]
        split = nodes.CategoricalSplit(f, doubles(cut), cand.bins[f]) if isinstance(cut, list) else nodes.ContinuousSplit(f, cut)
        return nodes.InternalNode(value, impurity, float(t.gain[at]), left, right, split, stats), None

    array, weights = gateway.new_array(regression, len(trees)), gateway.new_array(jvm.double, len(trees))
    for n, t in enumerate(trees):
        array[n] = regression(node(t, 0)[0], len(cand.bins))
        weights[n] = 1.0 if n == 0 else float(booster.getStepSize())
    booster._transfer_params_to_java()
    model = jvm.org.apache.spark.ml.classification.GBTClassificationModel(booster.uid, array, weights, len(cand.bins), 2)
    # Settings are copied within the JVM: through Python a long would come back as an int.
    return GBTClassificationModel(model.copy(booster._java_obj.extractParamMap()))


def fit_boosted(
    booster: GBTClassifier, rows: DataFrame, columns: Sequence[str], valid: str, positive: float, rounds: int, stop
) -> GBTClassificationModel:
    """The boosted trees of the rows that are not ``valid``; ``columns`` are the features one by one, ``positive``
    the weight of label 1."""
    cand = candidates(booster, rows.where(~F.col(valid)))
    table = stored(binned(rows, columns, booster.getLabelCol(), valid, cand))
    trees = grow_forest(booster, table, cand, positive, rounds, stop)
    return as_model(booster, trees, cand)
