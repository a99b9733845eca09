"""Quality rules under weak supervision: votes, accuracies by expectation-maximisation, posterior verdicts."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from punctua.llm.common import WORD_GAP
from punctua.llm.linechunks import _bound

# The separators of words, and what counts as a symbol.
BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "[#*$%&|<>]+"
NO_LETTERS = r"[!-@\[-`{-~]+"


def words_in(text: Column) -> Column:
    """What lies between blanks, in order."""
    return F.array_remove(F.split(text, WORD_GAP), "")


def _left(x: Column, bits: Column) -> Column:
    return F.call_function("shiftleft", x, bits)


def _right(x: Column, bits: Column) -> Column:
    return F.call_function("shiftright", x, bits)


def repeated_words(words: Column, width: int = 3) -> Column:
    """Words inside windows of ``width`` words that stand twice or more in ``words``.

    A window's hash and place share one long, so one sort brings alike windows together
    whatever the length of the text; only windows whose hash part meets another's are sorted
    again by their words, which makes the count exact.
    """
    n = F.size(words) - (width - 1)

    def packed(bits):
        place = lambda i: _left(F.xxhash64(*[F.get(words, i + d) for d in range(width)]), bits).bitwiseOR(i.cast("long"))
        return F.struct(bits.alias("bits"), F.sort_array(F.transform(F.sequence(F.lit(0), n - 1), place)).alias("a"))

    def near(s):
        part = lambda j: _right(F.get(s["a"], j), s["bits"])
        meets = lambda x, j: F.coalesce(_right(x, s["bits"]) == part(j), F.lit(False))
        same = lambda x, j: meets(x, j - 1) | meets(x, j + 1)
        low = _left(F.lit(1).cast("long"), s["bits"]) - 1
        return F.transform(F.filter(s["a"], same), lambda x: x.bitwiseAND(low).cast("int"))

    def exact(at):
        spelled = lambda i: F.struct(
            F.xxhash64(*[F.get(words, i + d) for d in range(width)]).alias("h"),
            F.concat_ws(" ", *[F.get(words, i + d) for d in range(width)]).alias("w"), i.alias("i"))
        return F.sort_array(F.transform(at, spelled))

    def twice(s):
        w = lambda j: F.get(s, j)["w"]
        return F.sort_array(F.transform(
            F.filter(s, lambda x, j: F.coalesce(x["w"] == w(j - 1), F.lit(False)) | F.coalesce(x["w"] == w(j + 1), F.lit(False))),
            lambda x: x["i"]))

    def covered(at):
        zero = F.struct(F.lit(0).alias("n"), F.lit(-width).alias("p"))
        step = lambda acc, i: F.struct((acc["n"] + F.least(i - acc["p"], F.lit(width))).alias("n"), i.alias("p"))
        return F.aggregate(at, zero, step, lambda acc: acc["n"])

    bits = F.ceil(F.log2(n.cast("double") + 1)).cast("int")
    steps = _bound(_bound(_bound(_bound(_bound(bits, packed), near), exact), twice), covered)
    return F.when(n >= 2, steps).otherwise(0).cast("long")


def measured(docs: DataFrame, text: str = "text", out: str = "quality") -> DataFrame:
    """``docs`` with one struct of counts over the whole text; a column named ``out`` is replaced.

    All of it is one expression bound step by step, so no later filter can make a part of it
    run once per word.  Null texts count as empty.
    """
    t = F.coalesce(F.col(text), F.lit(""))

    def lost(text, pattern):
        return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")

    def counts(s):
        w, lines, solid = s["words"], s["lines"], s["solid"]
        ends = F.filter(lines, lambda l: F.right(F.rtrim(l, F.lit(BLANKS)), F.lit(1)).isin(".", "!", "?"))
        chars = F.length(solid).cast("long")
        return F.struct(
            F.size(w).cast("long").alias("n_words"), chars.alias("word_chars"), lost(solid, SYMBOLS).alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            repeated_words(w).alias("n_repeat_words"),
            F.size(lines).cast("long").alias("n_lines"), F.size(ends).cast("long").alias("n_ended_lines"),
            F.size(F.array_distinct(w)).cast("long").alias("n_distinct"),
            F.size(F.filter(w, lambda x: ~F.regexp_like(x, F.lit(r"[\p{L}\p{N}]")))).cast("long").alias("n_lone"),
             (chars - lost(solid, NO_LETTERS)).alias("n_letters"))

    def solid(s):
        return F.struct(s["words"].alias("words"), s["lines"].alias("lines"), F.array_join(s["words"], "").alias("solid"))

    lines = F.filter(F.split(t, "\n"), lambda l: F.ltrim(l, F.lit(BLANKS)) != "")
    parts = F.struct(words_in(t).alias("words"), lines.alias("lines"))
    return docs.withColumn(out, _bound(_bound(parts, solid), counts))


def base_failed(q: Column) -> Column:
    return (q["n_words"] < 50) | (100 * q["n_repeat_words"] > 50 * q["n_words"])


def votes(q: Column) -> list[Column]:
    """The rules' votes, in order: 1 good, 0 bad, null abstains.  All shares are whole-number comparisons."""
    def rule(good, bad):
        return F.when(bad, 0).when(good, 1)

    n = q["n_words"]
    return [
        rule(n >= 100, n < 20),
        rule(50 * q["n_symbols"] <= n, 10 * q["n_symbols"] >= n),
        rule(10 * q["n_dup_lines"] <= q["n_lines"], 10 * q["n_dup_lines"] >= 3 * q["n_lines"]),
        rule(10 * q["n_repeat_words"] <= n, 10 * q["n_repeat_words"] >= 3 * n),
        rule(10 * q["n_distinct"] >= 4 * n, 10 * q["n_distinct"] < 2 * n),
        rule((q["word_chars"] >= 3 * n) & (q["word_chars"] <= 8 * n), (2 * q["word_chars"] < 5 * n) | (q["word_chars"] > 12 * n)),
        rule(100 * q["n_letters"] >= 85 * q["word_chars"], 100 * q["n_letters"] < 75 * q["word_chars"]),
        rule(20 * q["n_lone"] <= n, 5 * q["n_lone"] >= n),
        rule(10 * q["n_ended_lines"] >= 8 * q["n_lines"], 2 * q["n_ended_lines"] < q["n_lines"]),
    ]


@dataclass
class RuleModel:
    """Share of good documents, and per rule how often its vote is right on good and on bad ones."""

    prior: float
    right_good: list[float]
    right_bad: list[float]


def _odds(v: Sequence[Column], m: RuleModel) -> Column:
    """Log-odds of a good document; an abstention says nothing."""
    out = F.lit(math.log(m.prior / (1 - m.prior)))
    for vote, g, b in zip(v, m.right_good, m.right_bad):
        out = out + F.when(vote == 1, math.log(g / (1 - b))).when(vote == 0, math.log((1 - g) / b)).otherwise(0.0)
    return out


def _step(m: Column, seen: Column, rules: int, start: tuple[float, float], good: float, damp: float, least: float) -> Column:
    """One round over ``seen``, an array of (n, votes): expected labels, then the rates they imply."""
    each, zero = F.sequence(F.lit(0), F.lit(rules - 1)), F.lit(0.0)

    def posterior(w):
        def odds(row):
            add = lambda a, j: a + F.when(F.get(row["v"], j) == 1, F.get(w["yes"], j)).when(
                F.get(row["v"], j) == 0, F.get(w["no"], j)).otherwise(0.0)
            return F.struct(row["n"].alias("n"), row["v"].alias("v"), (1 / (1 + F.exp(-F.aggregate(each, w["odds"], add)))).alias("p"))

        return F.transform(seen, odds)

    def rates(rows):
        def right(vote, start, share):
            def one(j):
                def add(a, r):
                    cast, weight = F.get(r["v"], j), r["n"] * share(r)
                    return F.struct((a["x"] + F.when(cast == vote, weight).otherwise(0.0)).alias("x"),
                                    (a["y"] + F.when(cast >= 0, weight).otherwise(0.0)).alias("y"))

                return F.aggregate(rows, F.struct(zero.alias("x"), zero.alias("y")), add,
                                   lambda a: F.greatest((a["x"] + damp * start) / (a["y"] + damp), F.lit(least)))

            return F.transform(each, one)

        total = lambda f: F.aggregate(rows, zero, lambda a, r: a + f(r))
        prior = (total(lambda r: r["n"] * r["p"]) + damp * good) / (total(lambda r: r["n"]) + damp)
        return F.struct(prior.alias("prior"), right(1, start[0], lambda r: r["p"]).alias("g"),
                        right(0, start[1], lambda r: 1 - r["p"]).alias("b"))

    weights = F.struct(
        F.log(m["prior"] / (1 - m["prior"])).alias("odds"),
        F.transform(m["g"], lambda g, j: F.log(g / (1 - F.get(m["b"], j)))).alias("yes"),
        F.transform(m["b"], lambda b, j: F.log((1 - F.get(m["g"], j)) / b)).alias("no"))
    return _bound(_bound(weights, posterior), rates)


def fit_rules(rows: DataFrame, rounds: int = 30, right_good: float = 0.95, right_bad: float = 0.5, good: float = 0.8,
              damp: float = 10.0, least: float = 0.1, quality: str = "quality") -> RuleModel:
    """Rule accuracies from the votes alone, without labels.

    Documents are first counted per pattern of votes, with partial sums: at most 3 to the
    number of rules of patterns, 19683, whatever the input.  Rounds of expectation-maximisation
    run over that one bounded row: expected good documents, then each rule's expected share of
    right votes on either side.

    Junk comes in kinds, and most rules pass each kind, so rules start as nearly always right
    on good documents and right half the time on bad ones; ``damp`` votes of that accuracy
    weigh in, and no accuracy falls below ``least``.  Documents that fail the base are decided
    without rules and are not counted.  Without any rows the model is its starting point.
    """
    v = votes(F.col(quality))
    cast = F.array(*[F.coalesce(x, F.lit(-1)) for x in v])
    seen = rows.where(~base_failed(F.col(quality))).groupBy(cast.alias("v")).agg(F.count("*").cast("double").alias("n"))
    seen = seen.agg(F.array_sort(F.collect_list(F.struct("v", "n"))).alias("seen"))
    held = lambda rate: F.array_repeat(F.lit(rate), len(v))
    begin = F.struct(F.lit(good).alias("prior"), held(right_good).alias("g"), held(right_bad).alias("b"))
    step = lambda m, _: _step(m, F.col("seen"), len(v), (right_good, right_bad), good, damp, least)
    fitted = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), begin, step)
    m = seen.select(fitted.alias("m")).first()["m"]
    return RuleModel(m["prior"], list(m["g"]), list(m["b"]))


def judged(rows: DataFrame, model: RuleModel, cut: float = 0.5, quality: str = "quality") -> DataFrame:
    """``rows`` of ``measured`` with ``good_probability``, ``base_failed`` and ``kept`` in the quality struct.

    A document stays if it does not fail the base and its posterior probability of being good
    is ``cut`` or more.

    Defined cases: null, empty and blank texts have no words, so they fail the base; null ids
    and repeated rows are judged like any other; an empty table stays empty; columns of any
    other name are carried along.
    """
    q = F.col(quality)
    p = 1 / (1 + F.exp(-_odds(votes(q), model)))
    verdict = q.withField("good_probability", p).withField("base_failed", base_failed(q)).withField("kept", ~base_failed(q) & (p >= cut))
    return rows.withColumn(quality, verdict)
