"""Conversation structure repair: grammar-compressed role/fault sequences, min-plus matrices with audit ropes.

Every row of a conversation is one of 16 symbols: its role's kind and its fault.  Sequences
of symbols are compressed by Re-Pair rules found over all conversations together.  A symbol's
transfer matrix says, for every pair of states of the wanted grammar ``(s?(ua)+)?``, the
cheapest edits of that row; a rule's matrix is the min-plus product of its two parts, so each
rule is evaluated once, bottom-up, whatever the number of conversations that use it.

Ties go to the ASCII-least audit.  Inserts stand before the row they precede, so audits of the
same rows between the same states never begin one another, and the order of two audits stays
the same with anything put before or after them: the least of a product is the product of the
least, and the product is associative, which lets a long conversation be cut anywhere.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cached_property
from itertools import zip_longest

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from punctua.llm.common import Workspace, tidy

# Blanks, and the costs of edits.
BLANKS = " \t\n\x0b\f\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
ROLES = "sua?"                                  # kinds of role: system, user, assistant, anything else
FAULTS = ("", "blank", "duplicate", "truncated")
STATES = 4                                      # nothing yet, after s, after u, after a
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
FINAL = (0, 3)
WANTED = "uuau"                                 # the role that may be written in each state by an insert or a rerole
NAME = {"u": "user", "a": "assistant"}
BASE, RULE = 0x41, 0xE000                       # code points of the first symbol and of the first rule


def symbol(role: Column, fault: Column) -> Column:
    """The symbol of a row from its role's kind (0 to 3) and fault (0 to 3)."""
    return F.char(F.lit(BASE) + 4 * role + fault)


# ------------------------------------------------------------------ rows to entries

def damaged(rows: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, copies)`` of a conversation table after a reproducible damage.

    By crc32 of ``conv_id:turn`` modulo 20, a row is dropped (0), emptied (1), loses its
    sentence ends (2), stands twice (3) or becomes the user's (4).  Null roles and texts are
    one space; a null id or turn is one space in the checksum and stays null as a value.
    """
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    how = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    text = F.when(how == 1, "").when(how == 2, F.translate(part("text"), ".!?", "")).otherwise(part("text"))
    return rows.where(how != 0).select(
        "conv_id", "turn", F.when(how == 4, "user").otherwise(part("role")).alias("role"), text.alias("text"),
        F.when(how == 3, 2).otherwise(1).alias("copies"))


def _narrow(rows: DataFrame) -> DataFrame:
    """Distinct rows without their texts, in the terms of the grammar; ``n`` counts equal ones."""
    tail = F.right(F.rtrim(F.translate(F.col("text"), BLANKS, " ")), F.lit(1))
    own = F.when(tail == "", 1).when(F.length(F.translate(tail, ".!?", "")) > 0, 3).otherwise(0)
    kind = F.when(F.startswith("role", F.lit("s")), 0).when(F.startswith("role", F.lit("u")), 1).when(
        F.startswith("role", F.lit("a")), 2).otherwise(3)
    return (
        rows.select("conv_id", "turn", "role", F.unhex(F.md5("text")).alias("digest"), kind.alias("kind"), own.alias("own"), "copies")
        .groupBy("conv_id", "turn", "role", "digest", "kind", "own").agg(F.sum("copies").alias("n")))


ORDER = ("conv_id", "turn", "role", "digest")


def _entries(narrow: DataFrame, work: Workspace, most: int) -> DataFrame:
    """``(conv_id, at, symbols)``: rows in order, equal ones as a run; ``at`` grows along each conversation.

    A row repeats an earlier one if role and text are equal; the first of them is found by a
    grouped minimum and joined back, so a text that a third of all rows share is no group of
    one task.  Range partitions over all sort columns spread a conversation of any length.
    """
    place = F.struct(F.col("turn").isNotNull().alias("some"), F.coalesce("turn", F.lit(0)).alias("turn"))
    first = (narrow.groupBy("conv_id", "role", "digest").agg(F.min(place).alias("first"), F.count("*").alias("times"))
             .where("times > 1").select(*[F.col(c).alias(f"_{c}") for c in ("conv_id", "role", "digest")], "first"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest"))
    seen = narrow.join(first, same, "left")
    again = F.coalesce(place != F.col("first"), F.lit(False))
    fault = F.when(F.col("own") == 1, 1).when(again, 2).otherwise(F.col("own"))
    more = F.when(F.col("own") == 1, 1).otherwise(2)
    ordered = (
        seen.select(*ORDER, "n", symbol(F.col("kind"), fault).alias("one"), symbol(F.col("kind"), more).alias("more"))
        .repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
        .select("conv_id", F.monotonically_increasing_id().alias("at"), "n", "one", "more"))
    # A run of copies longer than a block comes in parts.
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {most}"))).alias("part")
    length = F.least(F.col("n") - F.col("part") * most, F.lit(most)).cast("int")
    cut = work.store(ordered, "ordered").select("conv_id", "at", "one", "more", "n", part)
    run = F.when(F.col("part") == 0, F.concat("one", F.repeat("more", length - 1))).otherwise(F.repeat("more", length))
    return cut.select("conv_id", "at", "part", run.alias("symbols"))


def sequences(entries: DataFrame, most: int) -> DataFrame:
    """``(conv_id, place, sequence)``: each conversation's symbols in blocks of ``most`` entries at most.

    ``place`` orders the blocks of a conversation.
    """
    low = F.expr(f"(at & {2**33 - 1}) div {most}")
    high = F.expr("shiftright(at, 33)")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "part", "symbols"))), lambda e: e["symbols"]), "")
    return (entries.groupBy("conv_id", high.alias("high"), low.alias("low")).agg(joined.alias("sequence"))
            .select("conv_id", F.struct("high", "low").alias("place"), "sequence"))


# ------------------------------------------------------------------ grammar

def grammar(words: DataFrame, work: Workspace, most_rules: int = 2000, rounds: int = 12) -> tuple[dict[str, str], DataFrame]:
    """Re-Pair rules over ``words(sequence)``: ``{symbol: pair}`` and ``(sequence, packed)``.

    Each round counts all adjacent pairs in one aggregate and replaces the most frequent ones
    that share no symbol, so that the replacements of a round cannot meet.  The driver sees
    pairs of symbols only: no more than the square of their number.  Rules only shorten the
    work; sequences that keep many symbols are evaluated all the same.
    """
    rules: dict[str, str] = {}
    packed = work.store(words.select("sequence", F.col("sequence").alias("packed")), "packed")
    for _ in range(rounds):
        chars = F.split("packed", "")
        pairs = F.transform(F.sequence(F.lit(1), F.size(chars) - 1), lambda i: F.concat(F.get(chars, i - 1), F.get(chars, i)))
        counts = (packed.where(F.length("packed") > 1).select(F.explode(pairs).alias("pair")).groupBy("pair").count()
                  .where("count > 1").orderBy(F.desc("count"), "pair").limit(4096).collect())
        taken: dict[str, str] = {}
        used: set[str] = set()
        for r in counts:
            if not used & set(r["pair"]) and len(rules) + len(taken) < most_rules:
                taken[chr(RULE + len(rules) + len(taken))] = r["pair"]
                used |= set(r["pair"])
        if not taken:
            break
        rules |= taken
        out = F.col("packed")
        for name, pair in taken.items():
            out = F.replace(out, F.lit(pair), F.lit(name))
        older, packed = packed, work.store(packed.select("sequence", out.alias("packed")), "packed")
        work.drop(older)
    return rules, packed


# ------------------------------------------------------------------ matrices

class Rope:
    """An audit as a tree over shared parts: joining two costs the same whatever their lengths."""

    __slots__ = ("left", "right", "text")

    def __init__(self, text: str = "", left: Rope | None = None, right: Rope | None = None):
        self.text, self.left, self.right = text, left, right

    def __add__(self, other: Rope) -> Rope:
        return Rope(None, self, other)

    def parts(self) -> Iterator[str]:
        todo = [self]
        while todo:
            r = todo.pop()
            if r.text is not None:
                yield r.text
            else:
                todo += (r.right, r.left)

    def letters(self) -> Iterator[str]:
        for p in self.parts():
            yield from p

    def __lt__(self, other: Rope) -> bool:
        for a, b in zip_longest(self.letters(), other.letters(), fillvalue=""):
            if a != b:
                return a < b
        return False

    def __str__(self) -> str:
        return "".join(self.parts())


Cell = tuple[int, Rope] | None


def better(a: Cell, b: Cell) -> Cell:
    if a is None or b is None:
        return a or b
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return b if a[1] is not b[1] and b[1] < a[1] else a


def product(a: list[list[Cell]], b: list[list[Cell]]) -> list[list[Cell]]:
    out: list[list[Cell]] = [[None] * STATES for _ in a]
    for i, row in enumerate(a):
        for k, x in enumerate(row):
            if x is not None:
                for j, y in enumerate(b[k]):
                    if y is not None:
                        out[i][j] = better(out[i][j], (x[0] + y[0], x[1] + y[1]))
    return out


def inserts(state: int) -> Iterator[tuple[int, int, str]]:
    """``(state reached, cost, audit)`` by inserting rows, without coming back to a state."""
    cost, audit, seen = 0, "", set()
    while state not in seen:
        yield state, cost, audit
        seen.add(state)
        state, cost, audit = NEXT[state, WANTED[state]], cost + INSERT, audit + "I"


def base_matrix(char: str) -> list[list[Cell]]:
    """Edits of one row, with the inserts before it."""
    kind, fault = divmod(ord(char) - BASE, 4)
    doomed, extra = fault in (1, 2), TRUNCATED * (fault == 3)
    out: list[list[Cell]] = [[None] * STATES for _ in range(STATES)]
    for begin in range(STATES):
        for state, cost, audit in inserts(begin):
            options = [(state, DELETE, "D")]
            if not doomed:
                options.append((NEXT[state, WANTED[state]], REROLE + extra, "R"))
                if (state, ROLES[kind]) in NEXT:
                    options.append((NEXT[state, ROLES[kind]], KEEP + extra, "K"))
            for end, more, letter in options:
                out[begin][end] = better(out[begin][end], (cost + more, Rope(audit + letter)))
    return out


class Matrices:
    """Transfer matrices of symbols and rules, each evaluated once."""

    def __init__(self, rules: dict[str, str]):
        self.rules, self._held = rules, {}

    @cached_property
    def order(self) -> list[str]:
        return sorted(self.rules)

    def __call__(self, char: str) -> list[list[Cell]]:
        if not self._held and self.rules:
            for name in self.order:               # rules only use older rules
                a, b = self.rules[name]
                self._held[name] = product(self._get(a), self._get(b))
        return self._get(char)

    def _get(self, char: str) -> list[list[Cell]]:
        if char not in self._held:
            self._held[char] = base_matrix(char)
        return self._held[char]

    def of(self, packed: str) -> list[list[Cell]]:
        out = self(packed[0])
        for char in packed[1:]:
            out = product(out, self(char))
        return out


def ended(row: list[Cell]) -> Cell:
    """The cheapest end in a final state, with the inserts that lead there."""
    best: Cell = None
    for state, cell in enumerate(row):
        if cell is not None:
            for end, cost, audit in inserts(state):
                if end in FINAL:
                    best = better(best, (cell[0] + cost, cell[1] + Rope(audit)))
    return best


CELLS = "sequence string, costs array<bigint>, audits array<string>"


def evaluated(packed: DataFrame, rules: dict[str, str]) -> DataFrame:
    """``CELLS`` of every distinct sequence: its matrix, row by row; cells that cannot be are null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Matrices(rules)
        for b in batches:
            names, costs, audits = [], [], []
            for name, word in zip(b.column("sequence").to_pylist(), b.column("packed").to_pylist()):
                cells = [c for row in known.of(word) for c in row]
                names.append(name)
                costs.append([None if c is None else c[0] for c in cells])
                audits.append([None if c is None else str(c[1]) for c in cells])
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(costs, pa.list_(pa.int64())), pa.array(audits, pa.list_(pa.string()))],
                ["sequence", "costs", "audits"])

    return packed.mapInArrow(run, CELLS)


def _folded(blocks: DataFrame, id_type: T.DataType) -> DataFrame:
    """``(conv_id, cost, audit)`` from matrices of blocks, in the order of their places.

    A stream over sorted rows: a conversation holds the four audits it may still end with,
    not its blocks.
    """
    rows = blocks.repartition("conv_id").sortWithinPartitions("conv_id", "place").select("conv_id", "costs", "audits")
    kinds = T.StructType([T.StructField("conv_id", id_type), T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, vector, some = None, None, False
        for b in batches:
            done: list[tuple] = []
            for conv, costs, audits in zip(*(b.column(k).to_pylist() for k in range(3))):
                if not some or conv != now:
                    if some:
                        done.append((now, ended(vector[0])))
                    now, vector, some = conv, [[(0, Rope()), None, None, None]], True
                cells = [None if c is None else (c, Rope(a)) for c, a in zip(costs, audits)]
                vector = product(vector, [cells[k:k + STATES] for k in range(0, STATES * STATES, STATES)])
            if done:
                yield _answers(done, b.schema.field(0).type)
        if some:
            yield _answers([(now, ended(vector[0]))], b.schema.field(0).type)

    return rows.mapInArrow(tidy(run), kinds)


def _answers(done: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([c for c, _ in done], kind), pa.array([x[0] for _, x in done], pa.int64()), pa.array([str(x[1]) for _, x in done], pa.string())],
        ["conv_id", "cost", "audit"])


# ------------------------------------------------------------------ applying the edits

class Editor:
    """Applies an audit to the rows of a conversation as they come; yields (role, text)."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, 0

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            yield NAME[self._go(WANTED[self.state])], ""

    def _go(self, letter: str) -> str:
        self.state, self.at = NEXT[self.state, letter], self.at + 1
        return letter

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        edit = self.audit[self.at]
        if edit == "D":
            self.at += 1
        elif edit == "R":
            yield NAME[self._go(WANTED[self.state])], text
        else:
            self._go(role[0])
            yield role, text


def edited(rows: DataFrame, audits: DataFrame, digests: bool = False) -> DataFrame:
    """Repaired rows ``(conv_id, place, role, text)``, or with ``digests`` one SHA-256 of each conversation.

    Rows and audits of a conversation meet in one sorted partition and are read as a stream:
    what is held is its audit and one batch.  The digest of a conversation is a chain over
    its bytes, so one task reads it, however long it is; nothing is gathered for that.
    """
    id_type = rows.schema["conv_id"].dataType
    digest = F.unhex(F.md5("text"))
    heads = audits.select("conv_id", F.lit(False).alias("is_row"), F.lit(None).cast("bigint").alias("turn"), F.lit("").alias("role"),
                          F.lit(None).cast("binary").alias("digest"), F.col("audit").alias("text"), F.lit(1).alias("copies"))
    body = rows.select("conv_id", F.lit(True).alias("is_row"), F.col("turn").cast("bigint").alias("turn"), "role", digest.alias("digest"), "text",
                       F.col("copies").cast("int").alias("copies"))
    both = (heads.unionByName(body).repartition("conv_id").sortWithinPartitions("conv_id", "is_row", "turn", "role", "digest")
            .select("conv_id", "is_row", "role", "text", "copies"))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """``(conv, None)`` as a conversation begins, then ``(conv, (role, text))`` for its rows."""
        now, editor = None, None
        for b in batches:
            for conv, is_row, role, text, copies in zip(*(c.to_pylist() for c in b.columns)):
                if not is_row:
                    if editor:
                        yield from ((now, line) for line in editor.inserted())
                    now, editor = conv, Editor(text)
                    yield now, None
                    continue
                for _ in range(copies):
                    yield from ((now, line) for line in editor.row(role, text))
        if editor:
            yield from ((now, line) for line in editor.inserted())

    kind = T.StructType([T.StructField("conv_id", id_type)])
    arrow_id = pa.int64() if isinstance(id_type, T.LongType) else None

    def hashed(batches):
        done, now, sha, begun = [], None, None, False
        for conv, line in stream(batches):
            if line is None:
                if sha:
                    done.append((now, sha.hexdigest()))
                now, sha, begun = conv, hashlib.sha256(), False
            else:
                sha.update(f"{chr(10) if begun else ''}{line[0]}:{line[1]}".encode())
                begun = True
            if len(done) >= 4096:
                yield made(done, ["conv_id", "repaired_sha256"])
                done = []
        if sha:
            yield made(done + [(now, sha.hexdigest())], ["conv_id", "repaired_sha256"])

    def written(batches):
        done, now, place, held = [], None, 0, 0
        for conv, line in stream(batches):
            if line is None:
                now, place = conv, 0
                continue
            done.append((now, place, *line))
            place, held = place + 1, held + len(line[1])
            if held > 1 << 22 or len(done) >= 4096:
                yield made(done, ["conv_id", "place", "role", "text"])
                done, held = [], 0
        if done:
            yield made(done, ["conv_id", "place", "role", "text"])

    def made(done, names):
        columns = list(zip(*done))
        return pa.RecordBatch.from_arrays([pa.array(columns[0], arrow_id), *[pa.array(c) for c in columns[1:]]], names)

    if digests:
        return both.mapInArrow(tidy(hashed), kind.add("repaired_sha256", T.StringType()))
    return both.mapInArrow(tidy(written), kind.add("place", T.LongType()).add("role", T.StringType()).add("text", T.StringType()))


# ------------------------------------------------------------------ the whole

def audited(rows: DataFrame, work: Workspace, every: DataFrame | None = None, block: int = 1024) -> DataFrame:
    """Per conversation of ``rows(conv_id, turn, role, text, copies)``: gaps, faults, cost and audit.

    ``every`` names conversations that may have no rows (left).
    """
    narrow = work.store(_narrow(rows), "narrow")
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    turns = narrow.groupBy("conv_id", "turn").agg(F.count("*").alias("_")).groupBy("conv_id").agg(
        F.max("turn").alias("hi"), F.min("turn").alias("lo"), F.count("turn").alias("n"))
    gaps = turns.select("conv_id", F.coalesce((wide("hi") - wide("lo") + 1 - F.col("n")).cast("long"), F.lit(0)).alias("gaps"))
    parts = work.store(sequences(_entries(narrow, work, block), block), "sequences")
    rules, packed = grammar(parts.select("sequence").distinct(), work)
    cells = work.store(evaluated(packed, rules), "cells")
    audits = _folded(parts.join(cells, "sequence"), rows.schema["conv_id"].dataType)
    found = _matched(_matched(audits, faults(parts)), gaps)
    if every is not None:
        found = _matched(every.select("conv_id").distinct(), found, "left")
        found = found.fillna(0, [c for c in found.columns if c not in ("conv_id", "audit")]).fillna("", ["audit"])
    return found.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def _matched(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Both sides' columns by conversation, the one without an id included."""
    return left.join(right.withColumnRenamed("conv_id", "_conv"), F.col("conv_id").eqNullSafe(F.col("_conv")), how).drop("_conv")


def faults(parts: DataFrame) -> DataFrame:
    """Faults per conversation and adjacent roles that may not meet, block by block and across their seams."""
    code = lambda c: F.ascii(c) - BASE
    chars = F.split("sequence", "")
    held = lambda f: F.length("sequence") - F.length(F.translate("sequence", "".join(chr(BASE + 4 * k + f) for k in range(4)), ""))
    # Pairs of kinds su, ua, au: 0-1, 1-2, 2-1.
    legal = lambda a, b: ((b == 1) & ((a == 0) | (a == 2))) | ((a == 1) & (b == 2))
    kind = lambda c: F.floor(code(c) / 4)
    inside = F.size(F.filter(F.sequence(F.lit(1), F.size(chars)), lambda i: (i < F.size(chars)) & ~legal(
        kind(F.get(chars, i - 1)), kind(F.get(chars, i)))))
    each = parts.select(
        "conv_id", "place", *[held(f).alias(FAULTS[f]) for f in (1, 2, 3)], inside.alias("illegal"),
        kind(F.substring("sequence", 1, 1)).alias("first"), kind(F.right("sequence", F.lit(1))).alias("last"))
    seam = F.lag("last").over(Window.partitionBy("conv_id").orderBy("place"))
    each = each.withColumn("seam", F.when(seam.isNull() | legal(seam, F.col("first")), 0).otherwise(1))
    return each.groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in FAULTS[1:]], F.sum(F.col("illegal") + F.col("seam")).alias("illegal"))


def repaired(rows: DataFrame, work: Workspace, every: DataFrame | None = None, block: int = 1024) -> DataFrame:
    """``audited`` and the digest of each repaired conversation, ``role:text`` lines joined.

    Defined cases: rows are ordered by turn, nulls first, then role, then a digest of the
    text; equal rows are copies of each other; null ids are one conversation; conversations
    without rows have zeros, an empty audit and the digest of nothing; roles of other initials
    can only be deleted or rerolled; gaps and turns are whole numbers of any size; an empty
    table stays empty; other columns are not read.
    """
    found = work.store(audited(rows, work, every, block), "found")
    return _matched(found, edited(rows, found.select("conv_id", "audit"), digests=True))
