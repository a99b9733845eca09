"""Noisy-channel deobfuscation: a character language model and a Viterbi decoder."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from punctua.llm.common import frames_of, tidy

# The letters the model knows (others share one class) and what a symbol may stand for.
LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l"}
SPACE, OTHER, SIZE = len(LETTERS), len(LETTERS) + 1, len(LETTERS) + 2
CODE = {c: i for i, c in enumerate(LETTERS)} | {" ": SPACE}
_L = re.escape(LETTERS)
_S = re.escape("".join(LEET))
# What may be disguised: a letter and a look-alike, digits among symbols, a letter twice in a row.
ODD = re.compile(rf"[{_L}].*[{_S}]|[{_S}].*[{_L}]|[0-9].*[@$!|+(]{{2}}|[@$!|+(]{{2}}.*[0-9]|([{_L}])\1", re.DOTALL)
SPACED = re.compile(rf"(?<![^\s])(?:[{_L}@$!|0-9](?:[ .\-_*]+|\n))(?:[{_L}@$!|0-9][ .\-_*]+)+[{_L}@$!|0-9](?![^\s.,;:!?])")


def _table() -> np.ndarray:
    out = np.full(0x110000, OTHER, np.uint8)
    for c, i in CODE.items():
        out[ord(c)] = i
    for c in "\t\n\r\v\f":
        out[ord(c)] = SPACE
    return out


def _count(batches):
    table, total = _table(), np.zeros(SIZE**3, np.int64)
    for b in frames_of(batches):
        text = "  ".join(x.lower() for x in b.column(0).to_pylist() if x)
        codes = table[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)].astype(np.int64)
        total += np.bincount((codes[:-2] * SIZE + codes[1:-1]) * SIZE + codes[2:], minlength=SIZE**3)
    has = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(has), pa.array(total[has])], names=["gram", "n"])


def count_grams(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Character trigram counts over every whole text, as a (SIZE, SIZE, SIZE) array.

    A partition sends its counts once; what meets on the driver is bounded by the
    alphabet, not by the texts.  Null texts count nothing.
    """
    rows = (
        docs.select(F.col(text).cast("string").alias("text")).mapInArrow(tidy(_count), "gram bigint, n bigint")
        .groupBy("gram").agg(F.sum("n").alias("n")).collect()
    )
    out = np.zeros(SIZE**3, np.int64)
    for r in rows:
        out[r["gram"]] = r["n"]
    return out.reshape(SIZE, SIZE, SIZE)


def log_model(grams: np.ndarray, share: float = 0.1) -> np.ndarray:
    """Log probability of a character after two others, mixed with shorter contexts."""
    two, one = grams.sum(0).astype(float), grams.sum((0, 1)).astype(float)
    p1 = (one + 1) / (one.sum() + SIZE)
    p2 = (two + 5 * p1) / (two.sum(1, keepdims=True) + 5)
    p3 = (grams + 5 * p2[None]) / (grams.sum(2, keepdims=True) + 5)
    return np.log((1 - share) * p3 + share * p2[None]).astype(np.float32)


class Restorer:
    """Restores leetspeak, stretched and spaced-out words in lower-cased text.

    The channel writes a letter as itself, as a look-alike symbol, several times, or with
    separators after it; each costs a fixed amount.  Viterbi decoding over the lattice of
    readings, scored by the trigram model, gives the likeliest restored text.  A text
    without such spots has one path only and is returned as it is.
    """

    SWAP, DROP, TWICE, JOIN, KEEP = 1.0, 0.7, 8.0, 0.3, 12.0

    def __init__(self, model: np.ndarray):
        self.model, self.known = model, {}

    def _edges(self, s: str, spaced: bool):
        """By position: [(next position, text out, cost)]."""
        out = []
        for i, c in enumerate(s):
            j = i + 1
            while j < len(s) and s[j] == c:
                j += 1
            here = [(i + 1, c, 0.0 if c in CODE else self.KEEP)]
            here += [(i + 1, x, self.SWAP) for x in LEET.get(c, "")]
            if j - i > 2 and c in CODE and (i == 0 or s[i - 1] != c):
                here = [(j, c, self.DROP), (j, c * 2, self.DROP)] + ([] if spaced or j - i > 3 else [(j, s[i:j], self.DROP)])
            elif j - i == 2 and c in CODE and not spaced:
                here += [(j, c, self.TWICE)]
            if spaced and not c.isalnum() and c not in "@$!|":
                here = [(j, "", self.JOIN), (j, " ", self.DROP)]
            out.append(here)
        return out

    def decode(self, s: str) -> str:
        if s in self.known:
            return self.known[s]
        spaced = any(x in s for x in " .-_*\n")
        best = [None] * (len(s) + 1)
        best[0] = {(SPACE, SPACE): (0.0, None, "")}
        for i, here in enumerate(self._edges(s, spaced)):
            if not best[i]:
                continue
            for state, (cost, _, _) in best[i].items():
                for j, text, extra in here:
                    a, b = state
                    total = cost + extra
                    for c in text:
                        k = CODE.get(c, OTHER)
                        total -= float(self.model[a, b, k])
                        a, b = b, k
                    into = best[j] = best[j] or {}
                    if (a, b) not in into or total < into[a, b][0]:
                        into[a, b] = (total, (i, state), text)
        end = best[len(s)] or {}
        if not end:
            return s
        state = min(end, key=lambda k: end[k][0] - float(self.model[k[0], k[1], SPACE]))
        at, parts = len(s), []
        while at:
            _, back, text = best[at][state]
            parts.append(text)
            at, state = back
        out = "".join(reversed(parts))
        if len(self.known) < 200_000:
            self.known[s] = out
        return out

    def word(self, w: str) -> str:
        """The restored form of one lower-cased word without outer punctuation."""
        return self.decode(w) if ODD.search(w) else w

    def text(self, s: str) -> str:
        """Lower-cased text with spaced-out words joined."""
        return SPACED.sub(lambda m: self.decode(m[0]), s)
