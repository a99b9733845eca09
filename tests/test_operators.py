from __future__ import annotations

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from punctua import session
from punctua.operators import joins, keyed, medians, metrics, quality, slices
from punctua.operators.history import fit_base_rates, mean_label, score_base_rate


def test_first_and_latest(spark):
    rows = [("a", 3, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", 5, None), (None, 1, "n")]
    df = spark.createDataFrame(rows, "k string, t int, v string")
    assert {(r.k, r.t, r.v) for r in keyed.first_by_key(df, ["k"], ["t"]).collect()} == {
        ("a", 1, "y"), ("b", 5, None), (None, 1, "n")}
    assert {(r.k, r.t, r.v) for r in keyed.latest_by_key(df, ["k"], ["t"]).collect()} == {
        ("a", 3, "x"), ("b", 5, None), (None, 1, "n")}
    assert keyed.first_by_key(df.select("k"), ["k"], []).count() == 3


def test_deduplication_does_not_rank_raw_rows(spark):
    plan = keyed.first_by_key(
        spark.range(10).withColumn("k", F.col("id") % 2), ["k"], ["id"]
    )._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_min" in plan


def test_level_codes(spark):
    df = spark.createDataFrame([("b", 10), ("a", 9), ("a", 10), (None, None)], "c string, h int")
    got = {(r.feature, r.level, r.code) for r in keyed.level_codes(df, ["c", "h"]).collect()}
    assert got == {("c", "a", 0), ("c", "b", 1), ("h", "9", 0), ("h", "10", 1)}


def test_nearby_counts_equal_brute_force(spark):
    rng = random.Random(5)
    places = [(f"P{i}", round(rng.uniform(24, 50), 2), round(rng.uniform(-125, -66), 2)) for i in range(40)]
    points = [(round(rng.uniform(22, 52), 2), round(rng.uniform(-127, -64), 2)) for _ in range(3000)]
    points += [(la + dx, lo + dy) for _, la, lo in places for dx in (-1.5, 1.5) for dy in (-1.5, 0.0)]
    points += [(places[0][1], places[0][2])] * 500 + [(None, 1.0)]
    dim = spark.createDataFrame(places, "iata string, lat double, lon double")
    pos = spark.createDataFrame(points, "lat double, lon double")
    out = joins.nearby_counts(dim, pos)
    got = {r.iata: (r.aircraft_nearby, r.level) for r in out.collect()}
    for iata, la, lo in places:
        n = sum(1 for a, b in points if a is not None and abs(a - la) <= 1.5 and abs(b - lo) <= 1.5)
        assert got[iata] == (n, "high" if n >= 30 else "moderate" if n >= 10 else "low")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_a_crowded_cell_is_counted_before_the_join(spark):
    """Half of all positions in one cell: inside a place's reach it is one row, at the border its distinct spots."""
    rng = random.Random(8)
    points = [(40.0 + rng.random() / 10, -99.9 + rng.random() / 10) for _ in range(4000)]
    points += [(41.5, -100.0)] * 3000 + [(rng.uniform(36, 44), rng.uniform(-104, -96)) for _ in range(1000)]
    points += [(float("nan"), -100.0), (40.0, None), (float("inf"), 0.0)]
    places = [("A", 40.0, -100.0), ("B", 40.0, -98.5), ("N", None, -100.0), ("A", 40.0, -100.0)]
    dim = spark.createDataFrame(places, "iata string, lat double, lon double")
    pos = spark.createDataFrame(points, "lat double, lon double")
    out = joins.nearby_counts(dim, pos)
    reach = {k: sum(1 for a, b in points if b is not None and abs(a - la) <= 1.5 and abs(b - lo) <= 1.5)
             for k, la, lo in places[:2]}
    assert sorted((r.iata, r.aircraft_nearby) for r in out.collect()) == [
        ("A", 2 * reach["A"]), ("A", 2 * reach["A"]), ("B", reach["B"]), ("N", 0)]
    a_only = joins.nearby_counts(dim.where("iata = 'A'"), pos)
    a_only.collect()
    joined, nodes = [], [a_only._jdf.queryExecution().executedPlan().executedPlan()]
    while nodes:
        node = nodes.pop()
        if "Join" in node.nodeName():
            joined.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
        if node.nodeName().endswith("QueryStage"):
            nodes.append(node.plan())
    assert joined and max(joined) < 1000


def test_joins_force_no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        dim = spark.createDataFrame([("A",), ("A",), ("B",)], "iata string")
        facts = spark.createDataFrame([("A", "B", 1), ("A", "C", 2), (None, "A", 3)], "origin string, dest string, n int")
        kept = joins.keep_known(facts, dim, ["origin", "dest"], "iata")
        assert "Broadcast" not in kept._jdf.queryExecution().executedPlan().toString()
        assert [r.n for r in kept.collect()] == [1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_airports_in_use(spark):
    facts = spark.createDataFrame(
        list(zip(["ATL", "ATL", "ORD", "JFK"], ["ORD", "ATL", "ATL", "ATL"])), "origin string, dest string")
    dim = spark.createDataFrame([("ATL",), ("ORD",), ("JFK",), ("SEA",)], "iata string")
    used = {r.iata: r.flights for r in joins.airports_in_use(facts, dim).collect()}
    assert used == {"ATL": 5, "ORD": 2, "JFK": 1}
    assert [r.iata for r in joins.airports_in_use(facts, dim, 1).collect()] == ["ATL"]
    assert joins.airports_in_use(facts.where("false"), dim).count() == 4
    assert joins.airports_in_use(None, dim).count() == 4


def test_exact_medians_keep_null_keys(spark):
    rows = [(None, None, 1.0), (None, None, 4.0), (None, "a", 2.0), ("b", "a", 7.0)]
    df = spark.createDataFrame(rows, "o string, d string, x double")
    got = {(r.o, r.d): r.median_x for r in medians.exact_medians(df, ["o", "d"], ["x"]).collect()}
    assert got == {(None, None): 2.5, (None, "a"): 2.0, ("b", "a"): 7.0}


def test_slices_with_repeated_ties_do_not_depend_on_partitions(spark):
    df = spark.range(20000).selectExpr("id", "id % 50 as tie", "date'2024-01-01' as flight_date")
    first, second = (slices.temporal_slices(d, ["tie"]) for d in (df, df.repartition(7)))
    assert first.exceptAll(second).count() == 0
    sizes = {r["slice"]: r["count"] for r in first.groupBy("slice").count().collect()}
    n_valid, n_calib = int(20000 * slices.VALID_FRACTION), int(20000 * slices.CALIB_FRACTION)
    assert sizes == {"fit": 20000 - n_valid - n_calib, "valid": n_valid, "calib": n_calib}


def test_exact_medians_equal_brute_force(spark):
    rng = random.Random(3)
    rows = [("hot", "d", rng.choice([1.0, 2.5, rng.uniform(0, 1e6)]), None) for _ in range(2001)]
    rows += [("two", "d", 1.0, 5.0), ("two", "d", 2.0, 5.0), ("one", "d", 7.0, None), ("none", "d", None, 1.0)]
    df = spark.createDataFrame(rows, "o string, d string, x double, y double")
    got = {r.o: (r.median_x, r.median_y) for r in medians.exact_medians(df, ["o", "d"], ["x", "y"], bins=16).collect()}
    for key in ("hot", "two", "one", "none"):
        for i, col in ((2, 0), (3, 1)):
            values = [r[i] for r in rows if r[0] == key and r[i] is not None]
            want = statistics.median(values) if values else None
            assert got[key][col] == want


@pytest.mark.parametrize("most", [4, 100])
def test_medians_beside_an_outlier_sort_no_full_slot(spark, monkeypatch, most):
    """One far value puts all others of its group into one slot; the slot is split until it is small."""
    rng = random.Random(4)
    rows = [("far", rng.uniform(0, 1)) for _ in range(4000)] + [("far", 1e300)]
    rows += [("skewed", math.exp(rng.uniform(-200, 200))) for _ in range(1999)] + [("skewed", 0.5)] * 1500
    rows += [("not", float(k)) for k in (3, 1, 2)] + [(None, 5.0), (None, 7.0)]
    kept = []
    monkeypatch.setattr(medians, "stored", lambda df: kept.append(session.stored(df)) or kept[-1])
    df = spark.createDataFrame(rows, "o string, x double")
    got = {r.o: r.median_x for r in medians.exact_medians(df, ["o"], ["x"], bins=8, most=most).collect()}
    assert got == {k: statistics.median(x for o, x in rows if o == k) for k in ("far", "skewed", "not", None)}
    largest = [t.groupBy("_keys", "_before").count().agg(F.max("count")).first()[0] for t in kept]
    assert largest[0] > 3000 and largest[-1] <= most


def test_base_rates(spark):
    rows = [("A", "B", i % 2) for i in range(30)] + [("A", "C", 1)] * 29 + [("D", "E", 0)] * 41
    train = spark.createDataFrame(rows, "origin string, dest string, dep_del15 int")
    rates = fit_base_rates(train)
    assert {(r.origin, r.dest, r.base_rate, r.n) for r in rates.collect()} == {
        ("A", "B", 0.5, 30), ("D", "E", 0.0, 41)}
    test = spark.createDataFrame([("A", "B"), ("A", "C"), ("X", "Y")], "origin string, dest string")
    scored = {(r.origin, r.dest): r.baseline_probability
              for r in score_base_rate(test, rates, mean_label(train)).collect()}
    assert scored == {("A", "B"): 0.5, ("A", "C"): 0.44, ("X", "Y"): 0.44}


def test_temporal_split(spark):
    df = spark.createDataFrame([(2022,), (2024,), (2025,), (2020,)], "year int")
    train, test = slices.temporal_split(df)
    assert (train.count(), test.count()) == (2, 1)
    with pytest.raises(ValueError, match="both"):
        slices.temporal_split(df, [2024], [2024])
    with pytest.raises(ValueError, match="year"):
        slices.temporal_split(df.withColumnRenamed("year", "y"))
    assert slices.split_counts(df, [2020], [1999]).first().test_rows == 0


@pytest.mark.parametrize("n,sizes", [(100, (70, 15, 15)), (5, (3, 1, 1)), (3, (1, 1, 1)), (20, (14, 3, 3))])
def test_slice_sizes(spark, n, sizes):
    df = spark.range(n).select(F.col("id"), F.expr("date_add(DATE'2024-01-01', cast(id div 4 as int))").alias("flight_date"))
    out = slices.temporal_slices(df, ["id"])
    counts = {r.slice: r["count"] for r in out.groupBy("slice").count().collect()}
    assert (counts["fit"], counts["valid"], counts["calib"]) == sizes
    bounds = {r.slice: (r.lo, r.hi) for r in out.groupBy("slice").agg(
        F.min("flight_date").alias("lo"), F.max("flight_date").alias("hi")).collect()}
    assert bounds["fit"][1] <= bounds["valid"][0] and bounds["valid"][1] <= bounds["calib"][0]


def test_slices_with_one_hot_day(spark):
    """Every row on one day: the cut falls between hash shares of that day."""
    df = spark.range(5000).select(F.col("id"), F.to_date(F.lit("2024-01-01")).alias("flight_date"))
    out = slices.temporal_slices(df, ["id"])
    counts = {r.slice: r["count"] for r in out.groupBy("slice").count().collect()}
    assert counts == {"fit": 3500, "valid": 750, "calib": 750}
    again = slices.temporal_slices(df.repartition(7), ["id"])
    assert out.exceptAll(again).count() == 0


def brute_auc(pairs):
    pos = [p for p, y in pairs if y == 1]
    neg = [p for p, y in pairs if y == 0]
    if not pos or not neg:
        return None
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


def brute_ap(pairs):
    total = sum(y for _, y in pairs)
    if not total:
        return None
    out, last = 0.0, 0.0
    for cut in sorted({p for p, _ in pairs}, reverse=True):
        hits = [y for p, y in pairs if p >= cut]
        recall = sum(hits) / total
        out += (recall - last) * sum(hits) / len(hits)
        last = recall
    return out


def test_rank_metrics_equal_brute_force(spark):
    rng = random.Random(11)
    groups = {
        "ties": [(rng.randrange(5) / 4, rng.randrange(2)) for _ in range(300)],
        "fine": [(rng.random(), int(rng.random() < 0.3)) for _ in range(400)],
        "close": [(0.5 + i * 1e-9, i % 3 == 0) for i in range(50)],
        "outside": [(-1.0, 0), (2.5, 1), (0.2, 1), (3.5, 0)],
        "single": [(0.1, 1), (0.4, 1)],
    }
    rows = [(g, float(p), int(y)) for g, pairs in groups.items() for p, y in pairs]
    df = spark.createDataFrame(rows, "name string, p double, y int")
    got = {r.name: r for r in metrics.rank_metrics(df).collect()}
    for g, pairs in groups.items():
        pairs = [(float(p), int(y)) for p, y in pairs]
        auc, ap = brute_auc(pairs), brute_ap(pairs)
        assert got[g].roc_auc == (pytest.approx(auc) if auc is not None else None)
        assert got[g].average_precision == pytest.approx(ap)


def test_reliability_curve(spark):
    df = spark.createDataFrame([(0.3, 1), (0.3, 0), (0.05, 0), (1.0, 1)], "p double, y int")
    got = {r.bin: (r.mean_predicted, r.fraction_positive, r.n)
           for r in metrics.reliability_curve(df, "p", "y").collect()}
    assert len(got) == 10
    assert got[2] == (0.3, 0.5, 2) and got[0] == (0.05, 0.0, 1) and got[9] == (1.0, 1.0, 1)
    assert got[5] == (None, None, 0)


def test_class_weight(spark):
    def weight(labels):
        df = spark.createDataFrame([(y,) for y in labels], "y int")
        return metrics.class_weight(df, "y").first().scale_pos_weight
    assert weight([0, 0, 0, 1]) == 3.0
    assert weight([1, 1, 0]) == 1.0
    assert weight([0, 0]) == 1.0


def test_evaluation_table(spark):
    df = spark.createDataFrame(
        [(0.9, 0.8, 0.5, 1), (0.2, 0.3, 0.5, 0), (0.4, 0.6, 0.5, 1), (0.3, 0.2, 0.5, 0)],
        "raw_probability double, delay_probability double, baseline_probability double, y int")
    row = metrics.evaluation_table(df, "y").first()
    assert (row.n_test, row.test_positive_rate, row.model_roc_auc, row.baseline_roc_auc) == (4, 0.5, 1.0, 0.5)
    assert row.model_brier_raw == pytest.approx((0.01 + 0.04 + 0.36 + 0.09) / 4)
    assert row.beats_baseline and row.roc_auc_lift == 0.5 and row.baseline_brier == 0.25


def test_quality_checks(spark):
    df = spark.createDataFrame(
        [(1, "a", 5), (1, "b", 50), (None, "b", None), (None, None, 7)], "id int, c string, x int")
    assert quality.not_null(df, "id").count() == 2
    assert [(r.id, r.n) for r in quality.unique(df, "id").collect()] == [(1, 2)]
    assert [(r.value, r.n) for r in quality.accepted_values(df, "c", ["a"]).collect()] == [("b", 2)]
    assert [r.x for r in quality.accepted_range(df, "x", 5, 7).collect()] == [50]
    parent = spark.createDataFrame([("a",), (None,)], "k string")
    assert [(r.value, r.n) for r in quality.relationships(df, "c", parent, "k").collect()] == [("b", 2)]
    assert quality.unique_combination(df.unionByName(df.limit(1)), ["id", "c"]).count() == 1
    suite = quality.Suite("t", not_null=["id", "c"], unique=["id"], unique_combinations=[["id", "c"]],
                          accepted_values={"c": ["a"]}, accepted_range={"x": (5, 7)},
                          relationships={"c": (parent, "k")})
    report = {(r.check, r.column): r.violations for r in quality.run_suite(df, suite).collect()}
    assert report == {
        ("not_null", "id"): 2, ("not_null", "c"): 1, ("unique", "id"): 1,
        ("unique_combination", "id,c"): 0, ("accepted_values", "c"): 2,
        ("accepted_range", "x"): 1, ("relationships", "c"): 2}
