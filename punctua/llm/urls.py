"""URL filters: rules by host and path, and boosted trees on lexical features."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from punctua.llm.common import Workspace

# The rules of the registered query.
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEXICAL = ("length", "host_length", "path_length", "depth", "labels", "digits", "digit_ratio", "dashes", "entropy", "parameters",
           "suffix_rows", "suffix_rate")


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column, labels: int = 2) -> Column:
    """The last labels of a host."""
    return F.substring_index(host, ".", -labels)


def rule_of(host: Column, path: Column, rules) -> Column:
    """The longest rule that fits, or null: its host or a subdomain, and the path's beginning."""
    out = None
    for rule, _ in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        out = F.when(fits, rule) if out is None else out.when(fits, rule)
    return F.lit(None).cast("string") if out is None else out


def _held(s: Column, what: str) -> Column:
    return F.length(s) - F.length(F.replace(s, F.lit(what), F.lit("")))


def lexical(urls: DataFrame, url: str = "url") -> DataFrame:
    """``urls`` with host, path, suffix and the numeric features of ``LEXICAL`` but the suffix's."""
    u, host, path = F.coalesce(F.col(url), F.lit("")), F.col("host"), F.col("path")
    size = F.greatest(F.length(u), F.lit(1))
    share = F.transform(F.array_distinct(F.filter(F.split(u, ""), lambda c: c != "")),
                        lambda c: (F.length(u) - F.length(F.replace(u, c, F.lit("")))) / size)
    return (
        urls.withColumn("host", host_of(F.col(url))).withColumn("path", path_of(F.col(url)))
        .withColumn("suffix", suffix_of(host))
        .withColumn("length", F.length(u).cast("double")).withColumn("host_length", F.length(host).cast("double"))
        .withColumn("path_length", F.length(path).cast("double")).withColumn("depth", _held(path, "/").cast("double"))
        .withColumn("labels", _held(host, ".").cast("double"))
        .withColumn("digits", F.length(F.regexp_replace(u, "[^0-9]", "")).cast("double"))
        .withColumn("digit_ratio", F.col("digits") / size).withColumn("dashes", _held(host, "-").cast("double"))
        .withColumn("entropy", F.aggregate(share, F.lit(0.0), lambda a, p: a - p * F.log2(p)))
        .withColumn("parameters", F.when(F.contains(u, F.lit("?")), 1 + _held(u, "&")).otherwise(0).cast("double")))


@dataclass
class UrlModel:
    """Fitted trees (none: a constant), and the labelled rows and bad share of each suffix."""

    trees: GBTClassificationModel | None
    suffixes: DataFrame
    share: float


def _with_suffix(rows: DataFrame, suffixes: DataFrame, share: float) -> DataFrame:
    known = suffixes.select(F.col("suffix").alias("_suffix"), "suffix_rows", "suffix_rate")
    out = rows.join(known, F.col("suffix") == F.col("_suffix"), "left").drop("_suffix")
    return out.fillna({"suffix_rows": 0.0, "suffix_rate": share})


def fit_urls(labelled: DataFrame, work: Workspace, most_labelled: int = 20_000, rounds: int = 12, depth: int = 4, damp: float = 20.0) -> UrlModel:
    """Boosted trees from ``labelled(url, bad)``, bad being 1 or 0.

    Suffix statistics use every labelled row (grouped, partial sums first), damped by
    ``damp`` rows at the overall share.  Trees use at most ``most_labelled`` rows, those of
    lowest url hash.  Null urls and labels are not learned from; with one class or no
    labels the model is that class's share (0 without any).
    """
    rows = lexical(work.store(labelled.where("url is not null and bad in (0, 1)").select("url", "bad"), "labelled"))
    seen = rows.agg(F.count("*").alias("n"), F.sum("bad").alias("bad")).first()
    share = (seen["bad"] or 0) / max(1, seen["n"])
    suffixes = work.store(rows.groupBy("suffix").agg(
        F.log1p(F.count("*")).alias("suffix_rows"),
        ((F.sum("bad") + damp * share) / (F.count("*") + damp)).alias("suffix_rate")), "suffixes")
    if not 0 < share < 1:
        return UrlModel(None, suffixes, share)
    sample = rows.orderBy(F.xxhash64("url"), "url", "bad").limit(most_labelled)
    sample = VectorAssembler(inputCols=list(LEXICAL), outputCol="x").transform(_with_suffix(sample, suffixes, share))
    trees = GBTClassifier(featuresCol="x", labelCol="bad", maxIter=rounds, maxDepth=depth, stepSize=0.2, seed=7,
                          maxMemoryInMB=64).fit(sample.select("x", F.col("bad").cast("double").alias("bad")).coalesce(1))
    return UrlModel(trees, suffixes, share)


def judge_urls(urls: DataFrame, model: UrlModel, rules=RULES, cut: float = 0.5, id_col: str = "page_id") -> DataFrame:
    """``(page_id, host, path, rule, verdict, bad_score)`` for every row.

    The longest fitting rule decides; without one, ``block`` if the trees' probability of a
    bad url is ``cut`` or more.  Null urls and urls without ``://`` have empty host and
    path, fit no rule and are judged by their (empty or short) lexical features.
    """
    rows = lexical(urls.select(F.col(id_col).alias("page_id"), F.col("url").cast("string").alias("url")))
    if model.trees is None:
        rows = rows.withColumn("bad_score", F.lit(float(model.share)))
    else:
        rows = VectorAssembler(inputCols=list(LEXICAL), outputCol="x").transform(_with_suffix(rows, model.suffixes, model.share))
        rows = model.trees.transform(rows).withColumn("bad_score", F.get(vector_to_array("probability"), F.lit(1)))
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    own = F.when(F.col("bad_score") >= cut, "block").otherwise("allow")
    given = F.lit(None).cast("string")
    for rule, verdict in rules:
        given = F.when(F.col("rule") == rule, verdict).otherwise(given)
    return rows.select("page_id", "host", "path", "rule", F.coalesce(given, own).alias("verdict"), "bad_score")
