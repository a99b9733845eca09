"""SentencePiece encoding and decoding by vectorised merge rounds."""

from __future__ import annotations

import hashlib
import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from punctua.llm.common import frames_of, per_process, ragged

GAP = "▁"
NONE = np.int64(2**62)
ROUNDS = 64  # words still merging after so many rounds go on one by one


class PieceModel:
    """The vocabulary of a SentencePiece BPE model as numpy tables.

    ``keys`` holds every pair of pieces whose join is a piece, as left * base + right,
    sorted; ``into`` the piece it makes and ``rank`` its place by score (equal scores
    share one, and are then told apart by position alone).
    """

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.base = sp.get_piece_size() + 0x110000  # ids past the vocabulary: unknown characters
        self.size, self.unk, self.bos, self.eos = sp.get_piece_size(), sp.unk_id(), sp.bos_id(), sp.eos_id()
        plain = {}
        self.bytes_ = np.full(256, self.unk, np.int64)
        self.is_byte, self.surface = np.zeros(self.size, bool), []
        for i in range(self.size):
            p = sp.id_to_piece(i)
            if sp.IsByte(i):
                self.bytes_[int(p[3:-1], 16)] = i
                self.is_byte[i] = True
                self.surface.append(bytes([int(p[3:-1], 16)]))
            elif sp.IsControl(i):
                self.surface.append(b"")
            elif sp.IsUnknown(i):
                self.surface.append(" ⁇ ".encode())
            else:
                plain[p] = i
                self.surface.append(p.replace(GAP, " ").encode())
        self.byte_fallback = bool(self.is_byte.all() or self.is_byte.sum() == 256)
        self.char = np.arange(0x110000, dtype=np.int64) + self.size
        for p, i in plain.items():
            if len(p) == 1:
                self.char[ord(p)] = i
        level = {s: r for r, s in enumerate(sorted({sp.get_score(i) for i in plain.values()}, reverse=True))}
        made = []
        for p, i in plain.items():
            for k in range(1, len(p)):
                left, right = (self._part(x, plain) for x in (p[:k], p[k:]))
                if left is not None and right is not None:
                    made.append((left * self.base + right, i, level[sp.get_score(i)]))
        made.sort()
        self.keys, self.into, self.rank = (np.array(x, np.int64) for x in zip(*made))
        self.spans = any(GAP in p.lstrip(GAP) for p in plain)  # a piece may run over a word's start
        self.lengths = np.array([len(s) for s in self.surface], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.text = np.frombuffer(b"".join(self.surface), np.uint8)

    def _part(self, s, plain):
        if s in plain:
            return plain[s]
        return ord(s) + self.size if len(s) == 1 else None

    def pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, piece) of each pair's join; rank NONE where there is none."""
        key = left * self.base + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.rank[at], NONE), np.where(hit, self.into[at], -1)

    def merge(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of words given as one flat symbol array: (flat ids, ids by word).

        Each round takes every word's least pair rank and merges, leftmost first, all
        its places that do not overlap, at once.  A merge whose product could itself
        merge at that rank or a lower one with the symbol beside it ends the word's
        round there, since a one-by-one merger would turn to that pair next.  Words
        without a pair left drop out, so the arrays shrink from round to round.
        """
        n = len(sizes)
        word = np.repeat(np.arange(n), sizes)
        done_word, done_sym = [], []
        for _ in range(ROUNDS):
            if not len(symbols):
                break
            rank, into = self.pair(symbols[:-1], symbols[1:]) if len(symbols) > 1 else (np.zeros(0, np.int64),) * 2
            rank = np.append(np.where(word[:-1] == word[1:], rank, NONE), NONE)
            into = np.append(into, -1)
            start = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            least = np.minimum.reduceat(rank, start)
            row = np.cumsum(np.r_[False, word[1:] != word[:-1]])
            least = least[row]
            out = least == NONE
            if out.any():
                done_word.append(word[out])
                done_sym.append(symbols[out])
                stay = ~out
                symbols, word, rank, into, least, row = (x[stay] for x in (symbols, word, rank, into, least, row))
                if not len(symbols):
                    break
                row = np.cumsum(np.r_[False, word[1:] != word[:-1]])
            at = np.flatnonzero(rank == least)
            # Of overlapping places take every other one, counted from the left.
            new = np.r_[True, np.diff(at) != 1]
            run = np.arange(len(at)) - np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
            at = at[run % 2 == 0]
            made, r = into[at], rank[at]
            left_of = np.where(at > 0, symbols[np.maximum(at - 1, 0)], -1)
            joined = np.r_[False, (at[1:] - at[:-1]) == 2]
            left_of = np.where(joined, np.r_[-1, made[:-1]], left_of)
            has_left = (at > 0) & (word[np.maximum(at - 1, 0)] == word[at])
            right = np.minimum(at + 2, len(symbols) - 1)
            has_right = (at + 2 < len(symbols)) & (word[right] == word[at])
            risky = (has_left & (self.pair(left_of, made)[0] <= r)) | (has_right & (self.pair(made, symbols[right])[0] <= r))
            if risky.any():
                owner = row[at]
                first = np.r_[True, owner[1:] != owner[:-1]]
                before = np.cumsum(risky) - risky
                before -= np.maximum.accumulate(np.where(first, before, 0))
                ok = before == 0
                at, made = at[ok], made[ok]
            symbols[at] = made
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, word = symbols[keep], word[keep]
        for w in np.unique(word) if len(symbols) else ():
            got = self._one_by_one(symbols[word == w].tolist())
            done_word.append(np.full(len(got), w))
            done_sym.append(np.array(got, np.int64))
        word = np.concatenate(done_word) if done_word else np.zeros(0, np.int64)
        sym = np.concatenate(done_sym) if done_sym else np.zeros(0, np.int64)
        order = np.argsort(word, kind="stable")
        word, sym = word[order], sym[order]
        sym, word = self._fallback(sym, word)
        return sym, np.bincount(word, minlength=n)

    def _one_by_one(self, s: list[int]) -> list[int]:
        """The same merges with a heap, for words that would need very many rounds."""
        nxt, prv, heap = list(range(1, len(s))) + [-1], list(range(-1, len(s) - 1)), []
        table = self.__dict__.setdefault("_pairs", dict(zip(self.keys.tolist(), zip(self.rank.tolist(), self.into.tolist()))))

        def push(i, j):
            if i >= 0 and j >= 0 and (hit := table.get(s[i] * self.base + s[j])):
                heapq.heappush(heap, (hit[0], i, j, s[i], s[j], hit[1]))

        for i in range(len(s) - 1):
            push(i, i + 1)
        while heap:
            _, i, j, a, b, made = heapq.heappop(heap)
            if s[i] != a or s[j] != b or nxt[i] != j:
                continue
            s[i], s[j], nxt[i] = made, -1, nxt[j]
            if nxt[i] >= 0:
                prv[nxt[i]] = i
            push(prv[i], i)
            push(i, nxt[i])
        return [x for x in s if x >= 0]

    def _fallback(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Unknown characters become their UTF-8 bytes' pieces (or the unknown id)."""
        odd = np.flatnonzero(sym >= self.size)
        if not len(odd):
            return sym, word
        if not self.byte_fallback:
            sym = sym.copy()
            sym[odd] = self.unk
            return sym, word
        reps = np.ones(len(sym), np.int64)
        raw = [chr(int(c) - self.size).encode("utf-8", "surrogatepass") for c in sym[odd]]
        reps[odd] = [len(x) for x in raw]
        out, at = np.repeat(sym, reps), np.repeat(np.arange(len(sym)), reps)
        out[sym[at] >= self.size] = self.bytes_[np.frombuffer(b"".join(raw), np.uint8)]
        return out, word[at]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, offsets by text), begin and end ids included; null counts as empty.

        Each distinct word (a run of gaps and what follows up to the next) is merged once.
        """
        n = len(texts)
        texts = pc.replace_substring(texts.fill_null("").cast(pa.large_string()), GAP, " ")
        full = np.flatnonzero(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        part = texts.take(pa.array(full))
        if self.spans:
            words = [GAP + x.replace(" ", GAP) for x in part.to_pylist()]
            unit, count = np.arange(len(words)), np.ones(len(full), np.int64)
        else:
            unit, count, words = self._words(part)
        symbols = self.char[np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)]
        flat, sizes = self.merge(symbols, np.array([len(w) for w in words], np.int64))
        begin = np.cumsum(sizes) - sizes
        body = flat[ragged(begin[unit], sizes[unit])]
        by_text = np.zeros(n, np.int64)
        owner = np.repeat(full, count)
        np.add.at(by_text, owner, sizes[unit])
        offsets = np.zeros(n + 1, np.int64)
        np.cumsum(by_text + 2, out=offsets[1:])
        ids = np.empty(offsets[-1], np.int64)
        ids[offsets[:-1]], ids[offsets[1:] - 1] = self.bos, self.eos
        inner = np.ones(len(ids), bool)
        inner[offsets[:-1]] = inner[offsets[1:] - 1] = False
        ids[inner] = body
        return ids, offsets

    def _words(self, texts: pa.Array):
        """(word of each place, places by text, distinct words)"""
        parts = pc.split_pattern(texts, " ")
        count = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = pc.list_flatten(parts).dictionary_encode()
        code, names = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_pylist()
        owner = np.repeat(np.arange(len(texts)), count)
        blank = np.array([x == "" for x in names], bool)[code] if len(code) else np.zeros(0, bool)
        last = np.r_[owner[1:] != owner[:-1], True] if len(owner) else np.zeros(0, bool)
        ends = ~blank | last  # a word ends at a filled part or with the text
        stop = np.flatnonzero(ends)
        gaps = np.diff(np.r_[-1, stop])  # parts in the word: one gap each
        key = gaps * max(1, len(names)) + code[stop]
        distinct, unit = np.unique(key, return_inverse=True)
        words = [GAP * int(k // len(names)) + names[int(k % len(names))] for k in distinct]
        return unit, np.bincount(owner[stop], minlength=len(texts)), words

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """UTF-8 text of each id sequence.

        Control ids vanish, the first gap is dropped, byte ids that form no valid
        character become U+FFFD one by one.
        """
        lengths = self.lengths[ids]
        raw = self.text[ragged(self.starts[ids], lengths)].tobytes()
        ends = np.r_[0, np.cumsum(lengths)][offsets]
        odd = np.add.reduceat(np.append(self.is_byte[ids], False), np.minimum(offsets[:-1], len(ids))) > 0 if len(offsets) > 1 else []
        out = []
        for i, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
            s = raw[a:b]
            if odd[i] and offsets[i + 1] > offsets[i]:
                inner = ids[offsets[i]:offsets[i + 1]]
                try:
                    s.decode()
                    whole = not (self.lengths[inner[1:-1]] == 0).any()  # a control id parts the bytes beside it
                except UnicodeDecodeError:
                    whole = False
                s = s if whole else self._mended(inner)
            seq = ids[offsets[i]:offsets[i + 1]]
            seq = seq[self.lengths[seq] > 0]
            first = len(seq) and not self.is_byte[seq[0]] and seq[0] != self.unk
            out.append(s[1:] if first and s[:1] == b" " else s)
        return out

    def _mended(self, ids: np.ndarray) -> bytes:
        out, held = [], b""
        for i in [*ids.tolist(), None]:
            if i is not None and self.is_byte[i]:
                held += self.surface[i]
                continue
            while held:
                for k in (1, 2, 3, 4):
                    try:
                        held[:k].decode()
                    except UnicodeDecodeError:
                        continue
                    if k <= len(held):
                        out.append(held[:k])
                        held = held[k:]
                        break
                else:
                    out.append("�".encode())
                    held = held[1:]
            if i is not None:
                out.append(self.surface[i])
        return b"".join(out)


def _model(path: str) -> PieceModel:
    return per_process("pieces " + path, lambda: PieceModel(path))


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, ids)``: every whole text's ids with begin and end; null text as empty."""
    def run(batches):
        model = _model(path)
        for b in frames_of(batches, 8 << 20):
            ids, at = model.encode(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(at.astype(np.int32), pa.array(ids.astype(np.int32)))], names=["doc_id", "ids"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id bigint, ids array<int>")


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """``(doc_id, text)`` of ``rows(doc_id, ids)``; null ids give a null text."""
    def run(batches):
        model = _model(path)
        for b in frames_of(batches, 8 << 20):
            seqs = b.column(1)
            size = pc.fill_null(pc.list_value_length(seqs), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = pc.list_flatten(seqs).to_numpy(zero_copy_only=False).astype(np.int64)
            texts = model.decode(flat, np.r_[0, np.cumsum(size)])
            texts = [x.decode() if ok else None for x, ok in zip(texts, seqs.is_valid().to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``: one pass, ids never leave the task."""
    def run(batches):
        model = _model(path)
        for b in frames_of(batches, 8 << 20):
            ids, at = model.encode(b.column(1))
            packed = ids.astype("<u4")
            texts = model.decode(ids, at)
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array(np.diff(at)),
                pa.array([hashlib.sha256(packed[s:e].tobytes()).hexdigest() for s, e in zip(at[:-1], at[1:])]),
                pa.array([hashlib.sha256(x).hexdigest() for x in texts]),
            ], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
