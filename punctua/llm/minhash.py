"""MinHash near-duplicates by an inverted join over signature coordinates."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from punctua.llm.common import Workspace, ascii_lower, frames_of, mix, ragged, words_of
from punctua.llm.components import components, local_forest

SIGNED = "doc_id bigint, n bigint, digest binary, sketch binary, tokens array<bigint>"
PAIRS = "a bigint, b bigint"
POSTS = "id bigint, n bigint, weight double, sketch binary, low binary, t bigint"
OPEN = "t bigint, i bigint, j bigint, id bigint, c bigint, own int, n bigint, sketch binary, low binary"


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): the distinct ``width``-word shingles of each text, sorted.

    A shingle is known by 64 bits mixed from its words' hashes.  A text of fewer words
    has its whole sequence as the one shingle; one without words has none.
    """
    codes, offsets, distinct = words_of(ascii_lower(texts))
    known = np.fromiter((xxhash.xxh64_intdigest(w) for w in distinct.to_pylist()), np.uint64, len(distinct))
    words = known[codes]
    counts = np.diff(offsets)
    n = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    owner = np.repeat(np.arange(len(counts)), n)
    at = ragged(offsets[:-1], n)
    span = np.minimum(width, counts)[owner]
    h = np.zeros(len(at), np.uint64)
    for j in range(width):
        inside = span > j
        h[inside] = mix(h[inside] ^ words[at[inside] + j], j)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    first = np.r_[True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])] if len(h) else np.zeros(0, bool)
    h, owner = h[first], owner[first]
    out = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(np.bincount(owner, minlength=len(counts)), out=out[1:])
    return h, out


def signatures(hashes: np.ndarray, offsets: np.ndarray, coordinates: int) -> np.ndarray:
    """Least hash under each of the permutations, by set; (sets, coordinates), 0 for empty sets."""
    out = np.zeros((len(offsets) - 1, coordinates), np.uint64)
    has = np.flatnonzero(np.diff(offsets))
    if len(has):
        seeds = mix(np.arange(2 * coordinates))
        with np.errstate(over="ignore"):
            for k in range(coordinates):
                turned = (hashes * (seeds[2 * k] | np.uint64(1)) + seeds[2 * k + 1])
                turned ^= turned >> np.uint64(32)
                turned *= np.uint64(0xD6E8FEB86659FD93)
                out[has, k] = np.minimum.reduceat(turned, offsets[has])
    return out


def _sign(width: int, coordinates: int):
    def run(batches):
        for b in frames_of(batches):
            h, at = shingle_sets(b.column(1), width)
            sig = signatures(h, at, coordinates)
            n = np.diff(at)
            raw = [None if s == e else hashlib.blake2b(h[s:e].tobytes(), digest_size=16).digest() for s, e in zip(at[:-1], at[1:])]
            tokens = mix(sig, 1) ^ mix(np.arange(coordinates), 2)
            bytes_ = (sig >> np.uint64(40)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array(n), pa.array(raw, pa.binary()), pa.array([r.tobytes() for r in bytes_], pa.binary()),
                pa.ListArray.from_arrays(np.arange(0, (len(n) + 1) * coordinates, coordinates, dtype=np.int32), pa.array(tokens.view(np.int64).ravel())),
            ], names=["doc_id", "n", "digest", "sketch", "tokens"])
    return run


def _sets(width: int):
    def run(batches):
        for b in frames_of(batches):
            h, at = shingle_sets(b.column(1), width)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.ListArray.from_arrays(at.astype(np.int32), pa.array(h.view(np.int64)))], names=["id", "set"])
    return run


def _matrix(column: pa.Array) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, np.uint8).reshape(len(column), -1)


def _agreeing(least: int):
    """Keeps pairs (a, b, sketch a, sketch b) whose sketches agree in ``least`` coordinates."""
    def run(batches):
        for b in frames_of(batches, 8 << 20):
            same = (_matrix(b.column(2)) == _matrix(b.column(3))).sum(1) >= least
            kept = b.select([0, 1, 4]).rename_columns(["a", "b", "w"]).filter(pa.array(same))
            if kept.num_rows:
                yield kept
    return run


def _posted(batches):
    """One row for each prefix token: its id, and the token's low half by coordinate (0: not in the prefix)."""
    for b in frames_of(batches):
        tokens = pc.list_flatten(b.column(4)).to_numpy().reshape(b.num_rows, -1)
        size = pc.list_value_length(b.column(5)).to_numpy().astype(np.int64)
        own = np.repeat(np.arange(b.num_rows), size)
        prefix = pc.list_flatten(b.column(5)).to_numpy()
        inside = np.zeros(tokens.shape, bool)
        np.logical_or.at(inside, own, tokens[own] == prefix[:, None])
        low = np.where(inside, np.maximum(tokens.view(np.uint64) & np.uint64(0xFFFFFFFF), np.uint64(1)), np.uint64(0)).astype("<u4")
        rows = b.select([0, 1, 2, 3]).take(pa.array(own))
        marks = pa.array([x.tobytes() for x in low], pa.binary()).take(pa.array(own))
        yield pa.RecordBatch.from_arrays([*rows.columns, marks, pa.array(prefix)], names=["id", "n", "weight", "sketch", "low", "t"])


def _runs(batches, columns: int):
    """Row groups of equal (t, i, j) as batches of whole groups; rows come sorted by these."""
    rest = None
    for b in batches:
        if not b.num_rows:
            continue
        b = pa.Table.from_batches([b]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([b])])
        key = np.stack([b.column(k).to_numpy() for k in range(3)], 1)
        same = (key == key[-1]).all(1)
        last = 0 if same.all() else len(same) - int(same[::-1].argmin())
        rest = b.slice(last)
        if last:
            yield key[:last], b.slice(0, last).combine_chunks()
    if rest is not None and rest.num_rows:
        yield np.stack([rest.column(k).to_numpy() for k in range(3)], 1), rest.combine_chunks()


class Candidates:
    """Pairs of one batch of whole runs that may be links: different components, sizes and
    sketches that allow it, and met here for the first time.

    A pair meets under every prefix token both hold.  Only the least of their common
    tokens counts, so each pair is looked at once.
    """

    def __init__(self, least: int, percent: int, most_pairs: int = 1 << 17):
        self.least, self.percent, self.most = least, percent, most_pairs

    def of(self, key: np.ndarray, rows: pa.Table):
        comp, own, n = (rows.column(k).to_numpy() for k in ("c", "own", "n"))
        sketch = _matrix(rows.column("sketch"))
        low = _matrix(rows.column("low")).view("<u4")
        here = np.maximum(key[:, 0].view(np.uint64) & np.uint64(0xFFFFFFFF), np.uint64(1)).astype(np.uint32)
        split = key[:, 1] != key[:, 2]
        start = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(1)])
        size = np.diff(np.r_[start, len(key)])
        later = np.repeat(start + size, size) - np.arange(len(key)) - 1  # rows of the run after each
        row, total = 0, np.cumsum(later)
        while row < len(key):
            upto = max(row + 1, int(np.searchsorted(total, (total[row - 1] if row else 0) + self.most, "right")))
            i = np.repeat(np.arange(row, upto), later[row:upto])
            j = ragged(np.arange(row, upto) + 1, later[row:upto])
            row = upto
            ok = (comp[i] != comp[j]) & (~split[i] | (own[i] != own[j]))
            ok &= 100 * np.minimum(n[i], n[j]) >= self.percent * np.maximum(n[i], n[j])
            i, j = i[ok], j[ok]
            ok = (sketch[i] == sketch[j]).sum(1) >= self.least
            i, j = i[ok], j[ok]
            common = np.where(low[i] == low[j], low[i], 0) - np.uint32(1)  # 0, no token, becomes the largest
            ok = common.min(1, initial=2**32 - 1) == here[i] - 1
            if ok.any():
                yield i[ok], j[ok]


def _flagged(candidates: Candidates):
    """The rows that take part in any candidate pair; never more than came in."""
    def run(batches):
        for key, rows in _runs(batches, 3):
            seen = np.zeros(len(key), bool)
            for i, j in candidates.of(key, rows):
                seen[i] = seen[j] = True
            if seen.any():
                yield from rows.filter(pa.array(seen)).to_batches()
    return run


def shared_sizes(sets: pa.Array, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Intersection sizes of the pairs of rows of a list column of sorted, distinct hashes."""
    offsets = np.r_[0, np.cumsum(pc.list_value_length(sets).to_numpy(zero_copy_only=False))]
    flat = pc.list_flatten(sets).to_numpy()
    used, at = np.unique(np.concatenate([i, j]), return_inverse=True)
    if len(i) < 4 * len(used):
        part = lambda r: flat[offsets[r]:offsets[r + 1]]
        return np.array([len(np.intersect1d(part(a), part(b), assume_unique=True)) for a, b in zip(i, j)], np.int64)
    # Many pairs among few sets: products of their incidence matrices, some columns at a time.
    owner = np.repeat(np.arange(len(used)), np.diff(offsets)[used])
    values = flat[ragged(offsets[used], np.diff(offsets)[used])]
    _, place, times = np.unique(values, return_inverse=True, return_counts=True)
    keep = times[place] > 1
    dense = np.cumsum(times > 1) - 1
    owner, place = owner[keep], dense[place[keep]]
    both = np.zeros((len(used), len(used)), np.float32)
    for lo in range(0, int((times > 1).sum()), 4096):
        inside = (place >= lo) & (place < lo + 4096)
        m = np.zeros((len(used), 4096), np.float32)
        m[owner[inside], place[inside] - lo] = 1
        both += m @ m.T
    return both[at[:len(i)], at[len(i):]].astype(np.int64)


def _linked(candidates: Candidates):
    """Links confirmed on full sets, as a spanning forest of each batch of runs."""
    def run(batches):
        for key, rows in _runs(batches, 3):
            ids, n, sets = rows.column("id").to_numpy(), rows.column("n").to_numpy(), rows.column("set").combine_chunks()
            found = []
            for i, j in candidates.of(key, rows):
                both = shared_sizes(sets, i, j)
                ok = 100 * both >= candidates.percent * (n[i] + n[j] - both)
                found.append((ids[i[ok]], ids[j[ok]]))
            if found:
                a, b = local_forest(*(np.concatenate(x) for x in zip(*found)))
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
    return run


def near_duplicates(
    docs: DataFrame, work: Workspace, width: int = 5, percent: int = 80, coordinates: int = 64, least: int = 36,
    block: int = 512, id_col: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` by links of Jaccard ``percent`` / 100 or more.

    1. Documents with equal shingle sets (by a 128-bit digest of the whole set) form a
       class; its least id stands for it from here on.
    2. Every class posts itself under each coordinate-value pair of its signature.  Two
       signatures that agree in ``least`` coordinates share one of the rarest
       ``c - least + 1`` pairs of either (c: pairs that anyone else holds too), so only
       that prefix is merged; the longest lists are skipped and merely counted in.
    3. Each class meets the most central member of its lists first, and the link is
       confirmed on full sets.  So a large group of near copies is one component after
       about as many checks as it has members.
    4. Then members of different components meet within each list, lists of over ``block``
       in pairs of blocks (those of its largest component not with each other); agreement
       is counted over the whole signature.  Rows that have
       a candidate are given their full sets, and the lists meet again to confirm.  What a
       task returns is its rows, or a spanning forest of its links, never pairs.

    A link of similarity 0.8 has under 1 chance in 100,000 to agree in fewer than 36 of 64
    coordinates; more similar ones far less.  No list, candidate or partner is cut off.

    Defined cases: null or wordless texts have 0 shingles and link with nothing; a null
    id takes no part and gets a null component, not kept; rows sharing an id are one
    document with each of its texts; an empty table gives no rows.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    signed = work.store(src.mapInArrow(_sign(width, coordinates), SIGNED), "signed")
    classes = work.store(
        signed.where("digest is not null and doc_id is not null").groupBy("digest")
        .agg(F.min(F.struct("doc_id", "n", "sketch", "tokens")).alias("r"))
        .select("digest", "r.*").withColumnRenamed("doc_id", "id"), "classes")

    tokens = classes.select("id", F.explode("tokens").alias("t"))
    shared = tokens.groupBy("t").agg(F.count("*").alias("df")).where("df > 1")
    held = tokens.join(shared, "t").groupBy("id").agg(
        F.array_sort(F.collect_list(F.struct("df", "t"))).alias("held"), F.sum(F.log("df")).alias("weight"))
    prefix = F.transform(F.slice("held", 1, F.size("held") - F.lit(least - 1)), lambda x: x["t"])
    posts = work.store(
        held.where(F.size("held") >= least).join(classes.select("id", "n", "sketch", "tokens"), "id")
        .select("id", "n", "weight", "sketch", "tokens", prefix.alias("prefix")).mapInArrow(_posted, POSTS), "posts")

    def alike(x, y):
        return 100 * F.least(x, y) >= percent * F.greatest(x, y)

    def sets_of(ids: DataFrame, name: str) -> DataFrame:
        # Both sides grow with the corpus, so no plan that works for a short id list only.
        needed = ids.distinct().hint("merge")
        return work.store(src.join(needed, "doc_id", "left_semi").mapInArrow(_sets(width), "id bigint, set array<bigint>"), name)

    centre = F.max(F.struct("weight", (-F.col("id")).alias("minus"), "n", "sketch")).alias("f")
    first = posts.groupBy("t").agg(centre).select("t", (-F.col("f.minus")).alias("a"), F.col("f.n").alias("na"), F.col("f.sketch").alias("sa"), F.col("f.weight").alias("wa"))
    stars = (
        posts.join(first, "t").where((F.col("id") != F.col("a")) & alike(F.col("n"), F.col("na")))
        .select("a", F.col("id").alias("b"), "sa", F.col("sketch").alias("sb"), "wa").mapInArrow(_agreeing(least), PAIRS + ", w double")
        .groupBy("b").agg(F.max(F.struct("w", (-F.col("a")).alias("a"))).alias("f")).select((-F.col("f.a")).alias("a"), "b"))
    stars = work.store(stars, "stars")
    sets = sets_of(stars.select(F.col("a").alias("doc_id")).union(stars.select("b")), "star-sets")
    left, right = sets.select(F.col("id").alias("a"), F.col("set").alias("x")), sets.select(F.col("id").alias("b"), F.col("set").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    links = work.store(
        stars.join(left, "a").join(right, "b")
        .where(100 * both >= percent * (F.size("x") + F.size("y") - both)).select("a", "b"), "links")
    work.drop(stars, sets)
    label = work.store(components(links, work), "label")

    # Lists whose members are all of one component are through.  In a longer list than a
    # block, only members outside its largest component meet every block; those inside
    # meet the blocks of the others, so a list costs its rows times the others' blocks.
    marked = posts.join(label, "id", "left").withColumn("c", F.coalesce("component", "id"))
    largest = F.max(F.struct("inside", "c")).alias("top")
    mixed = (marked.groupBy("t", "c").agg(F.count("*").alias("inside"))
             .groupBy("t").agg(largest, F.sum("inside").alias("size"), F.count("*").alias("parts")).where("parts > 1")
             .select("t", "size", F.col("top.inside").alias("inside"), F.col("top.c").alias("main")))
    open_ = marked.join(mixed, "t")
    short, main = F.col("size") <= block, F.col("c") == F.col("main")
    n_main, n_rest = (F.ceil(x / block).cast("int") for x in (F.col("inside"), F.col("size") - F.col("inside")))
    own = F.when(short, 0).when(main, F.pmod(F.xxhash64("id"), n_main)).otherwise(n_main + F.pmod(F.xxhash64("id"), n_rest)).cast("int")
    begin = F.when(short | ~main, 0).otherwise(n_main)
    end = F.when(short, 0).otherwise(n_main + n_rest - 1)
    open_ = open_.withColumn("own", own).withColumn("other", F.explode(F.sequence(begin, end)))
    open_ = open_.select(
        "t", F.least("own", "other").cast("long").alias("i"), F.greatest("own", "other").cast("long").alias("j"),
        "id", "c", "own", "n", "sketch", "low")
    rest = Candidates(least, percent)
    lists = lambda df: df.repartition("t", "i", "j").sortWithinPartitions("t", "i", "j")
    flagged = work.store(lists(open_).mapInArrow(_flagged(rest), OPEN), "flagged")
    sets = sets_of(flagged.select(F.col("id").alias("doc_id")), "sets")
    more = work.store(lists(flagged.join(sets, "id").select(flagged["*"], "set")).mapInArrow(_linked(rest), PAIRS), "more")
    groups = work.store(components(links.union(more), work), "groups")
    work.drop(flagged, sets)
    work.drop(posts)

    ids = signed.select("doc_id", "n", "digest")
    out = ids.join(classes.select("digest", F.col("id").alias("rep")), "digest", "left").join(
        groups.select(F.col("id").alias("rep"), "component"), "rep", "left")
    component = F.coalesce("component", "rep", "doc_id")
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(False)).alias("kept"))
