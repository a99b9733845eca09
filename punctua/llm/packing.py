"""Lexical retrieval packing: windows filled from a BM25 inverted index, sharded by wording."""

from __future__ import annotations

import os
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from punctua.llm.common import Workspace, ascii_lower, frames_of, mix, per_process, ragged, tidy, words_of

CUT = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, crc bigint, ids binary, tokens array<int>, df array<bigint>"
PIECES = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
          "sequence_id bigint, offset bigint")


MEMORY = 800_000
# After letters that stay single letters when normalised; İ, for one, does not.
TRAILING = r"([0-9A-Za-zÀ-ÖØ-öø-ÿ])([.,]+)([ \t-\r]|$)"


class WordIds:
    """Token ids of texts, each distinct word being tokenised once.

    Right for tokenizers whose pre-tokenizer drops white space and parts letters and
    digits from punctuation, as the word-end BPE here does: a text's ids are those of its
    words, one after another, and full stops or commas at a word's end mostly count as a
    word of their own.  Where the tokenizer lower-cases, A-Z are lower-cased beforehand.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core

        self.tok = Tokenizer.from_file(path)
        self.size = self.tok.get_vocab_size()
        normal = self.tok.normalizer
        self.lower = normal is not None and normal.normalize_str("A") == "a"
        self.known = pa.array([], pa.large_string())
        self.flat, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def _ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        flat, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for at in range(0, len(words), 512):
            part = words[at:at + 512]
            made = self.tok.encode(part, is_pretokenized=True, add_special_tokens=False)
            flat.append(np.array(made.ids, np.int32))
            sizes.append(np.bincount(np.array(made.word_ids, np.int64), minlength=len(part)))
        return np.concatenate(flat), np.concatenate(sizes)

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, offsets by text), ``end_id`` after each text; null counts as empty.

        The first ``MEMORY`` distinct words are remembered from call to call.
        """
        texts = ascii_lower(texts) if self.lower else texts
        codes, at, distinct = words_of(pc.replace_substring_regex(texts, TRAILING, r"\1 \2\3"))
        slot = pc.index_in(distinct, value_set=self.known)
        new = distinct.filter(pc.is_null(slot))
        more, counts = self._ids(new.to_pylist())
        flat, sizes = np.concatenate([self.flat, more]), np.concatenate([self.sizes, counts])
        slot = slot.fill_null(-1).to_numpy().astype(np.int64)
        slot[slot < 0] = len(self.sizes) + np.arange(len(new))
        if len(sizes) <= MEMORY:
            self.known = pa.concat_arrays([self.known, new])
            self.flat, self.sizes = flat, sizes
        begin = np.cumsum(sizes) - sizes
        n = sizes[slot][codes]
        body = flat[ragged(begin[slot][codes], n)]
        ends = np.r_[0, np.cumsum(n)][at]
        n = np.diff(ends) + 1
        offsets = np.r_[0, np.cumsum(n)]
        out = np.empty(offsets[-1], np.int64)
        last = np.zeros(len(out), bool)
        last[offsets[1:] - 1] = True
        out[last], out[~last] = end_id, body
        return out, offsets


def _cut(path: str, window: int, end_id: int):
    """Full windows of each document (their checksum only), its tail with ids, and token counts."""
    def run(batches):
        words = per_process("words " + path, lambda: WordIds(path))
        df = np.zeros(max(words.size, end_id + 1), np.int64)
        for b in frames_of(batches):
            ids, at = words.encode(b.column(1), end_id)
            packed = ids.astype("<u4")
            small = ids.astype(np.uint16) if len(df) <= 1 << 16 else ids  # two bytes sort in linear time
            names = b.column(0).to_pylist()
            rows = []
            for i, (s, e) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
                sorted_ = np.sort(small[s:e], kind="stable")
                df[sorted_[np.r_[True, sorted_[1:] != sorted_[:-1]]]] += 1
                for start in range(0, e - s, window):
                    part = packed[s + start:min(e, s + start + window)]
                    whole = len(part) == window
                    raw = part.tobytes()
                    rows.append((names[i], start, len(part), e - s, zlib.crc32(raw) if whole else None, None if whole else raw))
            cols = [pa.array(c, t) for c, t in zip(zip(*rows), (*[pa.int64()] * 5, pa.binary()))]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.nulls(len(rows), pa.list_(pa.int32())), pa.nulls(len(rows), pa.list_(pa.int64()))], names=NAMES)
        has = np.flatnonzero(df)
        one = [pa.nulls(1, t) for t in (*[pa.int64()] * 5, pa.binary())]
        yield pa.RecordBatch.from_arrays(
            [*one, pa.array([has], pa.list_(pa.int32())), pa.array([df[has]], pa.list_(pa.int64()))], names=NAMES)
    return tidy(run)


NAMES = [c.split()[0] for c in CUT.split(", ")]


class Sketches:
    """Short unit vectors of tails: random projections of their term weights.

    Terms of one document only connect nothing and weigh nothing.
    """

    def __init__(self, idf: np.ndarray, df: np.ndarray, width: int = 128):
        self.idf = np.where(df > 1, idf, 0.0).astype(np.float32)
        self.signs = np.random.default_rng(11).integers(0, 2, (len(idf), width)).astype(np.float32) * 2 - 1

    def of(self, tails: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(tails), self.signs.shape[1]), np.float32)
        for i, t in enumerate(tails):
            token, count = np.unique(t, return_counts=True)
            v = (self.idf[token] * (count / (count + 1.2)).astype(np.float32)) @ self.signs[token]
            out[i] = v / max(1e-9, float(np.sqrt(v @ v)))
        return out


class WordingTree:
    """Parts sketches into 2 ** ``depth`` leaves of about equal size and alike wording.

    Each node halves its sample at the median of its principal direction.  Sketches that
    lie on the median, as copies of one text do, are dealt out by ``coin``, so that no
    group of copies makes a leaf large.
    """

    def __init__(self, x: np.ndarray, coin: np.ndarray, depth: int):
        self.depth = depth
        self.axis, self.middle = np.zeros((1 << depth, x.shape[1]), np.float32), np.zeros(1 << depth, np.float32)
        node = np.ones(len(x), np.int64)
        for level in range(depth):
            order = np.argsort(node, kind="stable")
            for k, rows in zip(*self._groups(node[order], order)):
                centred = x[rows] - x[rows].mean(0)
                self.axis[k] = np.linalg.eigh(centred.T @ centred)[1][:, -1]
                self.middle[k] = np.median(np.einsum("ij,j->i", x[rows], self.axis[k]))
            node = self._down(x, node, coin, level)

    @staticmethod
    def _groups(nodes: np.ndarray, order: np.ndarray):
        ids, first = np.unique(nodes, return_index=True)
        return ids.tolist(), np.split(order, first[1:])

    def _down(self, x, node, coin, level):
        s = np.einsum("ij,ij->i", x, self.axis[node]) - self.middle[node]
        toss = (mix(coin, level) & np.uint64(1)).astype(bool)
        return 2 * node + np.where(np.abs(s) <= 1e-5, toss, s > 0)

    def leaf(self, x: np.ndarray, coin: np.ndarray) -> np.ndarray:
        node = np.ones(len(x), np.int64)
        for level in range(self.depth):
            node = self._down(x, node, coin, level)
        return node - (1 << self.depth)


def halvings(n: int, size: int) -> int:
    """How often to halve ``n`` rows for parts of about ``size``."""
    return max(0, round(np.log2(max(1, n) / size)))


class InvertedIndex:
    """BM25 postings of one shard's tails, by token: documents and their term weights."""

    def __init__(self, tails: list[np.ndarray], idf: np.ndarray, mean: float, k1: float = 1.2, b: float = 0.75):
        size = np.array([len(t) for t in tails], np.int64)
        owner = np.repeat(np.arange(len(tails)), size)
        both, count = np.unique(owner * len(idf) + np.concatenate(tails), return_counts=True)
        doc, token = both // len(idf), both % len(idf)
        weight = idf[token] * count * (k1 + 1) / (count + k1 * (1 - b + b * size[doc] / mean))
        order = np.argsort(token, kind="stable")
        self.doc, self.weight = doc[order], weight[order].astype(np.float32)
        self.start = np.searchsorted(token[order], np.arange(len(idf) + 1))
        self.terms = np.split(token, np.cumsum(np.bincount(doc, minlength=len(tails)))[:-1])
        self.n = len(tails)
        # Terms that an eighth of the tails hold have rows of weights instead of postings.
        held = np.diff(self.start)
        self.row = np.full(len(idf), -1)
        common = np.flatnonzero(8 * held > self.n)
        self.row[common] = np.arange(len(common))
        self.rows = np.zeros((len(common), self.n), np.float32)
        at = np.flatnonzero(self.row[token] >= 0)
        self.rows[self.row[token[at]], doc[at]] = weight[at]

    def scores(self, seed: int) -> np.ndarray:
        row = self.row[self.terms[seed]]
        terms = self.terms[seed][row < 0]
        at = ragged(self.start[terms], self.start[terms + 1] - self.start[terms])
        rare = np.bincount(self.doc[at], weights=self.weight[at], minlength=self.n)
        return rare + self.rows[row[row >= 0]].sum(0)


def fill(sizes: np.ndarray, index: InvertedIndex, window: int) -> list[list[tuple[int, int, int]]]:
    """Windows of (tail, from, length): the longest unused tail seeds each one.

    The seed's neighbours follow in order of score (ties: first come) as long as they fit
    whole; the best of the rest is cut to fill the window, its end staying unused in the
    index.  Only the last window can come out short.
    """
    left, begin, out = sizes.copy(), np.zeros_like(sizes), []
    while (seed := int(left.argmax())) >= 0 and left[seed] > 0:
        row, room = [(seed, int(begin[seed]), int(left[seed]))], window - int(left[seed])
        left[seed] = 0
        if room:
            rank = np.argsort(-np.where(left > 0, index.scores(seed), -1), kind="stable")
            rank = rank[left[rank] > 0]
            for i in rank.tolist():
                if left[i] <= room:
                    row.append((i, int(begin[i]), int(left[i])))
                    room -= int(left[i])
                    left[i] = 0
                    if not room:
                        break
            if room:
                for i in rank.tolist():
                    if left[i]:
                        row.append((i, int(begin[i]), room))
                        begin[i] += room
                        left[i] -= room
                        break
        out.append(row)
    return out


def in_powers(row: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """A short window parted into rows of 1, 2, 4 ... tokens, largest first: no padding."""
    total = sum(r[2] for r in row)
    out, rest = [], list(row)
    for bit in reversed(range(total.bit_length())):
        room = (total >> bit & 1) << bit
        part = []
        while room:
            i, begin, n = rest.pop(0)
            take = min(n, room)
            part.append((i, begin, take))
            room -= take
            if take < n:
                rest.insert(0, (i, begin + take, n - take))
        if part:
            out.append(part)
    return out


def pack(
    docs: DataFrame, work: Workspace, path: str, window: int = 2048, shard_docs: int = 1024, end_id: int = 1, sample: int = 20_000,
    id_col: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Pieces ``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)``.

    A document's ids (``end_id`` last) are cut at every ``window``: full pieces are
    sequences of their own.  What is left of each document goes to a shard of about
    ``shard_docs`` tails of alike wording with an inverted index of its own: a tree fitted
    on at most about ``sample`` tails parts all tails, and a task parts what is still larger.
    Term weights use document counts over all whole documents (bounded by the vocabulary
    on the driver).  A shard's last, short window is parted into powers of two, so nothing
    is padded.

    Defined cases: null and empty texts are the end id alone; ids may be null or repeat,
    each row being a document; an empty table gives no rows.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    cut = work.store(src.mapInArrow(_cut(path, window, end_id), CUT), "cut")
    counts = (
        cut.where("tokens is not null").select(F.explode(F.arrays_zip("tokens", "df")).alias("x"))
        .groupBy("x.tokens").agg(F.sum("x.df").alias("n")).toArrow())
    pieces = cut.where("tokens is null")
    total = pieces.agg(F.count_if(F.col("start") == 0).alias("docs"), F.count("ids").alias("tails"),
                       F.sum(F.when(F.col("ids").isNotNull(), F.col("length"))).alias("ids")).first()
    token, n = counts.column(0).to_numpy(), counts.column(1).to_numpy()
    df = np.zeros(int(token.max(initial=end_id)) + 1, np.int64)
    df[token] = n
    sc = docs.sparkSession.sparkContext
    idf = np.log1p((total["docs"] - df + 0.5) / (df + 0.5))
    mean = (total["ids"] or 0) / max(1, total["tails"])
    shared = sc.broadcast((idf, Sketches(idf, df)))
    pieces = pieces.select("doc_id", "start", "length", "doc_tokens", "crc", "ids").withColumn(
        "coin", F.xxhash64("doc_id", "start", "doc_tokens"))
    shares = max(1, -(-total["tails"] // sample))
    held = (
        pieces.where(F.col("ids").isNotNull() & (F.pmod(F.xxhash64("coin"), F.lit(shares)) == 0)).select("ids", "coin")
        .mapInArrow(_sketched(shared), "x binary, coin bigint").toArrow().sort_by([("coin", "ascending"), ("x", "ascending")]))
    x = np.frombuffer(b"".join(held.column(0).to_pylist()), np.float32).reshape(held.num_rows, -1) if held.num_rows else np.zeros((0, 1), np.float32)
    # A leaf of under 16 sampled tails would be fitted to chance.
    depth = min(halvings(total["tails"], shard_docs), halvings(held.num_rows, 16))
    tree = sc.broadcast(WordingTree(x, held.column(1).to_numpy(), depth))

    def packed(key, part):
        part = part.sort_values(["doc_id", "start", "length", "doc_tokens"], kind="stable", na_position="first")
        full, tail = part[part["ids"].isna()], part[part["ids"].notna()]
        first = key[0] << 32
        whole = pd.DataFrame({
            "doc_id": full["doc_id"].astype("Int64"), "start": full["start"], "length": full["length"], "ids_crc32": full["crc"].astype("int64"),
            "doc_tokens": full["doc_tokens"], "sequence_id": first + np.arange(len(full)), "offset": 0})
        if not len(tail):
            return whole
        idf, sketches = shared.value
        ids = [np.frombuffer(x, "<u4").astype(np.int64) for x in tail["ids"]]
        lots, more = [np.arange(len(ids))], halvings(len(ids), shard_docs)
        if more:
            x, coin = sketches.of(ids), tail["coin"].to_numpy()
            leaf = WordingTree(x, coin, more).leaf(x, coin)
            lots = [np.flatnonzero(leaf == k) for k in np.unique(leaf)]
        out, names, starts, totals = [], tail["doc_id"].tolist(), tail["start"].tolist(), tail["doc_tokens"].tolist()
        k = first + len(full)
        for lot in lots:
            own = [ids[i] for i in lot]
            rows = fill(np.array([len(x) for x in own], np.int64), InvertedIndex(own, idf, mean), window)
            if sum(r[2] for r in rows[-1]) < window:
                rows[-1:] = in_powers(rows[-1])
            for row in rows:
                offset = 0
                for j, begin, size in row:
                    i = lot[j]
                    crc = zlib.crc32(ids[i][begin:begin + size].astype("<u4").tobytes())
                    out.append((names[i], starts[i] + begin, size, crc, totals[i], k, offset))
                    offset += size
                k += 1
        made = pd.DataFrame(out, columns=list(whole.columns))
        made["doc_id"] = made["doc_id"].astype("Int64")
        return pd.concat([whole, made])

    return (
        pieces.mapInArrow(_dealt(shared, tree), pieces.withColumn("shard", F.lit(0).cast("long")).schema)
        .groupBy("shard").applyInPandas(packed, PIECES))


def _tails(ids: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, "<u4").astype(np.int64) for x in ids.to_pylist()]


def _sketched(shared):
    def run(batches):
        for b in frames_of(batches):
            x = shared.value[1].of(_tails(b.column(0)))
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary()), b.column(1)], names=["x", "coin"])
    return tidy(run)


def _dealt(shared, tree):
    """Pieces with their shard: full windows by their coin alone, tails by their wording."""
    def run(batches):
        for b in frames_of(batches):
            coin, ids = b.column("coin").to_numpy(), b.column("ids")
            shard = (mix(coin) % np.uint64(1 << tree.value.depth)).astype(np.int64)
            has = np.flatnonzero(ids.is_valid().to_numpy(zero_copy_only=False))
            if len(has) and tree.value.depth:
                shard[has] = tree.value.leaf(shared.value[1].of(_tails(ids.take(pa.array(has)))), coin[has])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shard)], names=[*b.schema.names, "shard"])
    return tidy(run)
