"""Line dedup: content-defined chunks of lines, removed where they repeat globally."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from punctua.llm.common import Workspace


def _bound(value: Column, body) -> Column:
    """``body(x)`` with ``x`` standing for ``value``, evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def line_hash(line: Column) -> Column:
    """A line's 32 bits: the first eight hexadecimal digits of its MD5."""
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def word_count(line: Column) -> Column:
    return F.size(F.filter(F.split(line, " "), lambda w: w != ""))


def _ended(lines: Column, one_in: int, long_line: int) -> Column:
    """Struct of the lines ``l``, their numbers of words ``w`` and the lines (from 1) that end a chunk, ``e``."""
    parts = F.struct(lines.alias("l"), F.transform(lines, line_hash).alias("h"), F.transform(lines, word_count).alias("w"))

    def ended(s):
        n = F.size(s["l"])

        def last(i):
            rolling = F.get(s["h"], i - 1) + 31 * F.coalesce(F.get(s["h"], i - 2), F.lit(0))
            return ((i == n) | (rolling % one_in == 0) | (F.get(s["w"], i - 1) >= long_line)
                    | F.coalesce(F.get(s["w"], i) >= long_line, F.lit(False)))

        return F.struct(s["l"].alias("l"), s["w"].alias("w"), F.filter(F.sequence(F.lit(1), n), last).alias("e"))

    return _bound(parts, ended)


def chunks(text: Column, one_in: int = 4, long_line: int = 50) -> Column:
    """Array of (text, lines, words): the chunks of a text, in order.

    A rolling hash over the last two line hashes ends a chunk after one line in
    ``one_in`` on average; since it sees nothing else, an inserted line moves no boundary
    but those beside it.  A line of ``long_line`` words or more is a chunk of its own.
    """
    def sliced(s):
        def one(end, k):
            begin = F.coalesce(F.get(s["e"], k - 1), F.lit(0))
            own, words = F.slice(s["l"], begin + 1, end - begin), F.slice(s["w"], begin + 1, end - begin)
            return F.struct(
                F.array_join(own, "\n").alias("text"), (end - begin).alias("lines"),
                F.aggregate(words, F.lit(0), lambda a, b: a + b).alias("words"))

        return F.transform(s["e"], one)

    return _bound(_ended(F.split(F.coalesce(text, F.lit("")), "\n"), one_in, long_line), sliced)


def _repeats(keyed: DataFrame, src: DataFrame, cut, at, work: Workspace) -> DataFrame:
    """``(id, gone)``: the set of (k, h) of units of a document that stand before it as well.

    ``keyed(id, k, h)`` are the units' places and digests, ``at(k)`` is the text of a unit
    in a row of ``cut(src)``.  Digests, ids and places are grouped first; texts of units whose
    digest occurs once never leave their rows.
    """
    keyed = work.store(keyed, "keyed")
    again = work.store(
        keyed.groupBy("h").agg(F.count("*").alias("n"), F.min(F.struct("id", "k")).alias("first")).where("n > 1")
        .select("h", "first"), "again")
    marks = work.store(
        keyed.join(again, "h").groupBy("id")
        .agg(F.collect_set(F.struct("k", "h", (F.struct("id", "k") == F.col("first")).alias("first"))).alias("marks")), "marks")
    work.drop(keyed, again)
    texts = work.store(
        cut(src.join(marks, "id"))
        .select("id", F.explode(F.transform("marks", lambda m: F.struct(
            m["k"].alias("k"), m["h"].alias("h"), m["first"].alias("first"), at(m["k"]).alias("t")))).alias("m"))
        .select("id", "m.*").where("unhex(md5(t)) = h"), "texts")
    first = texts.where("first").select("h", F.col("t").alias("t0"), F.col("id").alias("id0"), F.col("k").alias("k0"))
    gone = work.store(
        texts.where("not first").join(first, "h").where("t = t0").groupBy("id")
        .agg(F.collect_set(F.struct("k", "h")).alias("gone")), "gone")
    work.drop(marks, texts)
    return gone


def _beside(docs: DataFrame, gone: DataFrame, id_col: str, text: str) -> DataFrame:
    """Every row of ``docs`` as a struct ``row`` and its text ``t``, so that no input name can clash, with ``gone``."""
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text])
    rows = docs.select(others.alias("row"), F.col(id_col).alias("at"), F.col(text).alias("t"))
    return rows.join(gone.select(F.col("id").alias("gone_at"), "gone"), F.col("at") == F.col("gone_at"), "left")


def _shown(docs: DataFrame, both: DataFrame, text: str, names: tuple[str, str]) -> DataFrame:
    """The input's columns with the text of ``x``, then its two counts; an input column named like a count is replaced."""
    kept = [F.col("x.text").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in names]
    return both.select(*kept, *[F.col(f"x.{k}").alias(c) for k, c in zip(("n", "removed"), names)])


def _proven(gone: Column, unit) -> Column:
    """Places of ``gone`` whose unit in this very text has the digest: rows sharing an id may differ."""
    own = F.filter(gone, lambda g: F.coalesce(g["h"] == F.unhex(F.md5(unit(g["k"]))), F.lit(False)))
    return F.array_distinct(F.transform(own, lambda g: g["k"]))


def _except(n: Column, places: Column) -> Column:
    """0 to n - 1 without ``places``, in order."""
    return F.sort_array(F.array_except(F.sequence(F.lit(0), n - 1), places))


def dedup_lines(
    docs: DataFrame, work: Workspace, one_in: int = 4, long_line: int = 50, least_words: int = 20,
    id_col: str = "doc_id", text: str = "text", out: tuple[str, str] = ("n_chunks", "removed"),
) -> DataFrame:
    """``docs`` with globally repeated chunks taken out of ``text``; adds ``n_chunks`` and ``removed``.

    A chunk counts as repeated if another chunk of the same bytes stands before it (by
    document id, then place), and it has two lines and ``least_words`` words at least, or
    ``long_line`` words.  Shorter common phrases stay.

    A repeated chunk's bytes are compared with those of the first occurrence, and only
    equal ones go, so a digest collision removes nothing.

    Defined cases: null texts stay null with 1 empty chunk; empty texts stay; rows sharing
    an id count as one document, whose copies keep the same chunks; a null id takes no
    part and keeps its text; text may become empty; an empty table stays empty; any column
    names may occur, those of ``out`` are replaced.
    """
    cut = lambda df: df.withColumn("_chunks", chunks(F.col("t"), one_in, long_line))
    qualifies = "words >= {0} or (lines >= 2 and words >= {1})".format(long_line, least_words)
    src = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text).alias("t"))
    keyed = (
        cut(src).select("id", F.posexplode("_chunks").alias("k", "c")).select("id", "k", "c.*").where(qualifies)
        .select("id", "k", F.unhex(F.md5("text")).alias("h")))
    gone = _repeats(keyed, src, cut, lambda k: F.get("_chunks", k)["text"], work)

    def cleaned(s):
        left = F.transform(_except(F.size(s["c"]), _proven(s["gone"], lambda k: F.get(s["c"], k)["text"])), lambda k: F.get(s["c"], k)["text"])
        return F.struct(F.array_join(left, "\n").alias("text"), F.size(s["c"]).alias("n"), (F.size(s["c"]) - F.size(left)).alias("removed"))

    whole = F.struct(F.col("t").alias("text"), F.size(chunks(F.col("t"), one_in, long_line)).alias("n"), F.lit(0).alias("removed"))
    parts = F.struct(chunks(F.col("t"), one_in, long_line).alias("c"), F.col("gone"))
    both = _beside(docs, gone, id_col, text).withColumn("x", F.when(F.col("gone").isNull(), whole).otherwise(_bound(parts, cleaned)))
    return _shown(docs, both, text, out)


NO_UNITS = "array<struct<k:bigint,h:binary>>"


def _span(begin: Column, n: Column) -> Column:
    """The place of a unit of ``n`` lines; places are in order of their first line, from 0."""
    return F.shiftleft(begin.cast("bigint"), 32) + n


def _begin(k: Column) -> Column:
    return F.shiftright(k, 32).cast("int")


def _lines_in(k: Column) -> Column:
    return k.bitwiseAND(F.lit(2**32 - 1)).cast("int")


def _unit(lines: Column, k: Column) -> Column:
    """Text of the unit at ``k``."""
    return F.array_join(F.slice(lines, _begin(k) + 1, _lines_in(k)), "\n")


def _units(lines: Column, one_in: int, long_line: int) -> Column:
    """Array of (whole, inner, beside): what of each content-defined chunk can be looked up, as (k, h).

    ``whole`` is the chunk, if it has three lines or a long one; ``inner`` has its pairs of
    adjacent lines (a chunk of two lines is one) and ``beside`` the pair around its end.
    """
    def listed(s):
        def pair(i):
            text = F.concat(F.get(s["l"], i), F.lit("\n"), F.get(s["l"], i + 1))
            return F.struct(_span(i, F.lit(2)).alias("k"), F.unhex(F.md5(text)).alias("h"))

        def one(end, j):
            begin = F.coalesce(F.get(s["e"], j - 1), F.lit(0))
            n, k = end - begin, _span(begin, end - begin)
            whole = F.struct(k.alias("k"), F.unhex(F.md5(_unit(s["l"], k))).alias("h"))
            return F.struct(
                F.when((n > 2) | ((n == 1) & (F.get(s["w"], begin) >= long_line)), whole).alias("whole"),
                F.when(n > 1, F.transform(F.sequence(begin, end - 2), pair)).otherwise(F.array().cast(NO_UNITS)).alias("inner"),
                F.when(end < F.size(s["l"]), pair(end - 1)).alias("beside"))

        return F.transform(s["e"], one)

    return _bound(_ended(lines, one_in, long_line), listed)


def _asked(listed: DataFrame, work: Workspace) -> DataFrame:
    """``(id, k, h)`` to look up: every chunk, and the pairs that no repeated chunk answers.

    A chunk that stands before holds only pairs that stand before, so its own are left
    out.  The first place of a pair is never in such a chunk, hence no pair misses it.
    """
    chunk = listed.where("whole is not null")
    wholes = chunk.select("id", "whole.k", "whole.h")
    again = work.store(
        wholes.groupBy("h").agg(F.count("*").alias("n"), F.min(F.struct("id", "k")).alias("first")).where("n > 1")
        .select(F.col("h").alias("again"), "first"), "chunks")
    here = chunk.join(again, F.col("whole.h") == F.col("again"), "left")
    copy = F.col("first").isNotNull() & (F.struct("id", F.col("whole.k").alias("k")) != F.col("first"))
    none = F.array().cast(NO_UNITS)
    beside = F.when(F.col("beside").isNotNull(), F.array("beside")).otherwise(none)
    pairs = here.select("id", F.concat(F.when(copy, none).otherwise(F.col("inner")), beside).alias("u")).unionByName(
        listed.where("whole is null").select("id", F.concat("inner", beside).alias("u")))
    return wholes.unionByName(pairs.select("id", F.explode("u").alias("u")).select("id", "u.*"))


def dedup_passages(
    docs: DataFrame, work: Workspace, long_line: int = 50, least_words: int = 20, id_col: str = "doc_id", text: str = "text",
    out: tuple[str, str] = ("n_lines", "removed"), one_in: int = 4,
) -> DataFrame:
    """``docs`` with globally repeated passages taken out of ``text``; adds ``n_lines`` and ``removed``.

    Content-defined chunks, as ``dedup_lines`` cuts them, are looked up whatever their words.
    A passage need not begin or end with one: where a chunk does not repeat as a whole, and
    between chunks, pairs of adjacent lines are looked up as well.  A passage is a maximal
    run of lines joined by repeated chunks and pairs: each of its adjacent pairs stands
    earlier (by document id, then place).  Runs of ``least_words`` words go, however short
    their lines, and so do repeated lines of ``long_line`` words, each a chunk of its own.
    A line's first occurrence is in no repeated pair, so each distinct line stays somewhere.
    Whatever ``dedup_lines`` takes out is inside such a run; ``one_in`` changes the work only.

    Bytes are compared and the cases defined as in ``dedup_lines``; texts of one line and
    null texts have 1 line.
    """
    cut = lambda df: df.withColumn("_lines", F.split(F.coalesce("t", F.lit("")), "\n"))
    src = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text).alias("t"))
    listed = work.store(
        cut(src).select("id", F.explode(_units(F.col("_lines"), one_in, long_line)).alias("u")).select("id", "u.*"), "listed")
    gone = _repeats(_asked(listed, work), src, cut, lambda k: _unit(F.col("_lines"), k), work)
    work.drop(listed)

    # One expression, bound step by step: nothing in it can be inlined into its lambdas by
    # a later filter, and each step is linear in the lines of the text but for one sort.
    def runs(s):
        n, own = F.size(s["l"]), s["own"]
        linked = F.flatten(F.transform(
            F.filter(own, lambda k: _lines_in(k) > 1), lambda k: F.sequence(_begin(k) + 1, _begin(k) + _lines_in(k) - 1)))
        alone = F.transform(F.filter(own, lambda k: _lines_in(k) == 1), _begin)
        return F.struct(s["l"].alias("l"), alone.alias("alone"), F.concat(_except(n, linked), F.array(n)).alias("begins"))

    def leaving(s):
        begins = s["begins"]

        def one(i, j):
            end = F.get(begins, j + 1)
            words = F.aggregate(F.slice(s["l"], i + 1, end - i), F.lit(0), lambda a, l: a + word_count(l))
            return F.when((end - i > 1) & (words >= least_words), F.sequence(i, end - 1)).otherwise(F.array().cast("array<int>"))

        many = F.flatten(F.transform(F.slice(begins, 1, F.size(begins) - 1), one))
        # A long line on its own: it begins a run and the next line begins another.
        single = F.transform(F.array_intersect(F.transform(F.array_intersect(s["alone"], begins), lambda i: i + 1), begins), lambda i: i - 1)
        return F.struct(s["l"].alias("l"), F.concat(many, single).alias("out"))

    def cleaned(s):
        left = F.transform(_except(F.size(s["l"]), s["out"]), lambda i: F.get(s["l"], i))
        return F.struct(left.alias("left"), F.size(s["l"]).alias("n"), (F.size(s["l"]) - F.size(left)).alias("removed"))

    def owned(s):
        return F.struct(s["l"].alias("l"), _proven(s["gone"], lambda k: _unit(s["l"], k)).alias("own"))

    lines = F.split(F.coalesce("t", F.lit("")), "\n")
    steps = _bound(_bound(_bound(_bound(F.struct(lines.alias("l"), F.col("gone")), owned), runs), leaving), cleaned)
    found = _bound(steps, lambda s: F.struct(F.when(s["removed"] == 0, F.col("t")).otherwise(F.array_join(s["left"], "\n")).alias("text"), s["n"].alias("n"), s["removed"].alias("removed")))
    whole = F.struct(F.col("t").alias("text"), F.size(lines).alias("n"), F.lit(0).alias("removed"))
    both = _beside(docs, gone, id_col, text).withColumn("x", F.when(F.col("gone").isNull(), whole).otherwise(found))
    return _shown(docs, both, text, out)
