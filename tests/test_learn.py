from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from punctua.contract import FEATURES, LABEL
from punctua.operators.metrics import long_scores, rank_metrics
from punctua.plans import boosting, learn


@pytest.fixture(scope="module")
def table(spark):
    """Flights whose delays follow gusts and evening hours; five years of a hundred days."""
    h = lambda salt, n: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n))
    df = spark.range(6000).withColumn("year", (F.lit(2021) + h("y", 5)).cast("int"))
    df = df.withColumns({
        "flight_date": F.date_add(F.make_date("year", F.lit(1), F.lit(1)), h("d", 100).cast("int")),
        "origin": F.concat(F.lit("O"), h("o", 6)), "dest": F.concat(F.lit("D"), h("e", 6)),
        "carrier": F.concat(F.lit("C"), h("c", 4)), "dep_hour": h("h", 24).cast("int"),
        "day_of_week": (h("w", 7) + 1).cast("int"), "month": (h("m", 12) + 1).cast("int"),
        "distance": 200.0 + h("x", 2000), "crs_elapsed_time": 40.0 + h("l", 300),
        "is_holiday_window": h("v", 2).cast("int"), "origin_wind_gusts": h("g", 60).cast("double"),
    })
    df = df.withColumn("time_of_day_bucket", F.when(F.col("dep_hour") >= 18, "evening").otherwise("day"))
    rest = [c for c in FEATURES if c not in df.columns]
    df = df.withColumns({c: (h(c, 100) / 100).cast("double") for c in rest})
    risk = F.lit(0.08) + F.when(F.col("origin_wind_gusts") > 40, 0.5).otherwise(0.0) + F.when(
        F.col("dep_hour") >= 18, 0.25).otherwise(0.0)
    return df.withColumn(LABEL, (h("luck", 1000) / 1000 < risk).cast("int")).drop("id").cache()


@pytest.fixture(scope="module")
def trained(table):
    boosting = learn.Boosting(rounds=8, learning_rate=0.2, max_depth=4, min_rows_per_leaf=20)
    return learn.train_bundle(table, [2021, 2022, 2023, 2024], [2025], boosting)


def test_model_beats_baseline(trained):
    row = trained[1].first()
    assert row.beats_baseline and row.model_roc_auc > 0.7 and row.roc_auc_lift > 0.1
    assert row.calib_brier_after <= row.calib_brier_before
    assert row.model_brier_calibrated < row.baseline_brier


def test_the_best_round_is_kept_with_patience():
    assert learn.best_round([5, 4, 3, 4, 5, 6, 7], 3) == (3, True)
    assert learn.best_round([5, 4, 3, 4, 5], 3) == (3, False)
    assert learn.best_round([3, 4, 5, 2, 1], 2) == (1, True)
    assert learn.best_round([1.0], 5) == (1, False)


def test_boosting_stops_by_the_validation_slice(table):
    """Pure noise beyond few rounds: far fewer trees than allowed stay, and they are the first of the longer forest."""
    boosting = learn.Boosting(rounds=40, learning_rate=0.5, max_depth=5, min_rows_per_leaf=5, patience=5)
    rows = table.where("year < 2025").withColumn("slice", F.when(F.col("year") < 2024, "fit").otherwise("valid"))
    pipeline = learn.train_model(rows, rows, boosting)
    trees = pipeline.stages[-1]
    assert 1 <= trees.getNumTrees < 40
    longer = learn.train_model(rows, rows, learn.Boosting(rounds=trees.getNumTrees + 1, learning_rate=0.5, max_depth=5, min_rows_per_leaf=5, patience=40)).stages[-1]
    for n in range(min(trees.getNumTrees, longer.getNumTrees)):
        assert trees.trees[n].toDebugString.split("\n", 1)[1] == longer.trees[n].toDebugString.split("\n", 1)[1]
    scored = learn.raw_scores(pipeline, table.where("year = 2025").limit(20)).collect()
    assert len(scored) == 20 and all(0 <= r["raw_probability"] <= 1 for r in scored)
    assert trees.getOrDefault("maxDepth") == 5 and trees.numFeatures == longer.numFeatures


def test_scores_survive_saving(spark, table, trained, tmp_path):
    bundle = trained[0]
    learn.save_bundle(bundle, str(tmp_path / "b"))
    loaded = learn.load_bundle(spark, str(tmp_path / "b"))
    rows = table.where("year = 2025").limit(50).withColumn("carrier", F.when(F.col("dep_hour") < 12, "NEW").otherwise(F.col("carrier")))
    keys = ["flight_date", "origin", "dest", "distance", "crs_elapsed_time"]
    def scores(b):
        return {tuple(r[k] for k in keys): (r.delay_probability, r.risk_band, r.baseline_probability)
                for r in learn.batch_score(b, rows, explain=False).collect()}
    assert scores(bundle) == scores(loaded) and len(scores(loaded)) == 50
    assert loaded.calibrator.brier_after == bundle.calibrator.brier_after


def test_batch_score_columns(table, trained):
    row = learn.batch_score(trained[0], table.where("year = 2025"), k=3).first()
    assert row.calibrated and 0 <= row.delay_probability <= 1 and len(row.top_factors) == 3
    sizes = [abs(f.contribution) for f in row.top_factors]
    assert sizes == sorted(sizes, reverse=True)
    assert {f.direction for f in row.top_factors} <= {"increases", "decreases"}
    assert {f.feature for f in row.top_factors} <= set(FEATURES)
    assert row.beats_baseline == (abs(row.delay_probability - row.baseline_probability) > 1e-6)


def test_contributions_add_up_to_the_log_odds(table, trained):
    pipeline = trained[0].pipeline
    scored = learn.raw_scores(pipeline, table.where("year = 2025").limit(200))
    rows = learn.with_contributions(pipeline, scored).select("raw_probability", "contributions", "base").collect()
    total = np.array([sum(r.contributions) + r.base for r in rows])
    p = np.array([r.raw_probability for r in rows])
    assert np.allclose(1 / (1 + np.exp(-total)), p, atol=1e-9)
    gusts = list(FEATURES).index("origin_wind_gusts")
    assert np.mean([abs(r.contributions[gusts]) for r in rows]) > 0.1


@pytest.mark.parametrize("method", ["isotonic", "sigmoid"])
def test_calibration(spark, method):
    df = spark.range(4000).select(
        (F.pmod(F.xxhash64("id"), F.lit(100)) / 100).alias("raw_probability"),
        (F.pmod(F.xxhash64("id", F.lit("y")), F.lit(1000)) / 1000).alias("u"))
    df = df.withColumn(LABEL, (F.col("u") < F.col("raw_probability") / 2).cast("int"))
    cal = learn.fit_calibrator(df, method=method)
    assert cal.brier_after < cal.brier_before
    got = cal.transform(spark.createDataFrame([(0.0,), (0.4,), (0.99,), (1.0,)], "r double"), "r", "p").orderBy("r").collect()
    assert [r.p for r in got] == sorted(r.p for r in got) and all(0 <= r.p <= 1 for r in got)
    assert got[1].p == pytest.approx(0.2, abs=0.06)
    with pytest.raises(ValueError):
        learn.fit_calibrator(df, method="other")


def test_quality_gate(spark):
    runs = spark.createDataFrame(
        [(1, 0.50), (2, 0.60), (3, 0.58), (4, 0.60), (5, 0.59), (6, 0.61), (7, None)], "run int, roc_auc double")
    got = {r.run: r.published for r in learn.quality_gate(runs).collect()}
    assert got == {1: False, 2: True, 3: False, 4: False, 5: False, 6: True, 7: False}


def test_empty_test_year_is_refused(table):
    with pytest.raises(ValueError, match="empty side"):
        learn.train_bundle(table, [2021], [2030])


def test_auc_agrees_with_mllib(table):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    df = table.select((F.col("origin_wind_gusts") / 60).alias("p"), F.col(LABEL).cast("double").alias("y"))
    ours = rank_metrics(long_scores(df, ["p"], "y")).first().roc_auc
    theirs = BinaryClassificationEvaluator(rawPredictionCol="p", labelCol="y", numBins=0).evaluate(df)
    assert ours == pytest.approx(theirs, abs=1e-9)


def test_random_numbers_are_sparks(spark):
    got = [r[0] for r in spark.range(0, 2000, 1, 1).select(F.rand(23)).collect()]
    assert got == list(boosting.uniform(23, 0, 2000)) and got[777:790] == list(boosting.uniform(23, 777, 13))


@pytest.fixture(scope="module")
def encoded(spark):
    """Two categories, a constant and numbers, over five partitions; a fifth of the rows are for validation."""
    from pyspark.ml.feature import StringIndexer, VectorAssembler

    h = lambda salt, n: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n))
    df = spark.range(0, 8000, 1, 5).select(
        h("a", 12).cast("string").alias("a"), h("b", 40).cast("string").alias("b"), F.lit(1.0).alias("k"),
        *[(h(f"x{i}", 997) / 997).alias(f"x{i}") for i in range(4)], (h("v", 5) == 0).alias("_valid"), h("l", 1000).alias("l"))
    risk = 0.15 + 0.4 * (F.col("x0") > 0.5).cast("int") + 0.2 * (F.col("a") == "3").cast("int") - 0.1 * F.col("x1")
    # Nobody of b = 7 is late and everybody of b = 8 is: nodes without variance come up.
    y = F.when(F.col("b") == "7", 0).when(F.col("b") == "8", 1).otherwise((F.col("l") / 1000 < risk).cast("int"))
    df = df.withColumns({"_y": y.cast("double"), "_w": F.when(y == 1, 1.7).otherwise(1.0)})
    codes = StringIndexer(inputCols=["a", "b"], outputCols=["ac", "bc"], handleInvalid="keep").fit(df).transform(df)
    columns = ["ac", "bc", "k", *[f"x{i}" for i in range(4)]]
    return VectorAssembler(inputCols=columns, outputCol="features").transform(codes).cache(), columns


def booster(rounds, **settings):
    from pyspark.ml.classification import GBTClassifier

    return GBTClassifier(
        labelCol="_y", weightCol="_w", predictionCol="_cls", maxBins=48, maxIter=rounds,
        **{"seed": 17, "stepSize": 0.2, "maxDepth": 6, "minInstancesPerNode": 50, "subsamplingRate": 0.85, "featureSubsetStrategy": "0.7", **settings})


@pytest.mark.parametrize("settings", [{}, {"subsamplingRate": 1.0, "featureSubsetStrategy": "all", "maxDepth": 1}])
def test_trees_are_those_of_mllib(encoded, monkeypatch, settings):
    """Same splits, node by node, same values and losses; also where a partition makes several blocks.

    With far fewer rows a node, features may tie, and rounding would choose."""
    rows, columns = encoded
    monkeypatch.setattr(boosting, "BLOCK", 300)
    told = []

    def stop(losses, last=False):
        told[:] = losses
        return len(losses) if last else None

    theirs = booster(5, **settings).fit(rows.where("not _valid"))
    ours = boosting.fit_boosted(booster(5, **settings), rows, columns, "_valid", 1.7, 5, stop)
    assert ours.getNumTrees == 5 and ours.treeWeights == theirs.treeWeights
    nodes = lambda t: [x.split("Predict:") for x in t.toDebugString.split("\n")[1:]]
    for a, b in zip(ours.trees, theirs.trees):
        assert [x[0] for x in nodes(a)] == [x[0] for x in nodes(b)]
        values = lambda t: [float(x[1]) for x in nodes(t) if len(x) > 1]
        assert values(a) == pytest.approx(values(b), abs=1e-12)
    assert told == pytest.approx(theirs.evaluateEachIteration(rows.where("_valid")), abs=1e-12)
    assert list(ours.featureImportances) == pytest.approx(list(theirs.featureImportances), abs=1e-9)
    assert ours._java_obj.getMaxDepth() == settings.get("maxDepth", 6) and ours._java_obj.getSeed() == 17


def test_features_that_part_rows_alike_are_taken_in_order():
    """The second feature's gain is larger by the rounding of its sums alone."""
    one = np.array([[30.0, 10, 0.1], [30, 20, 30.3], [0, 0, 0]])
    other = one * [1, 1, 1 + 4e-16]
    cand = boosting.Candidates([np.array([0.0, 1.0])] * 2, [3, 3], 2)
    for first, second in ((one, other), (other, one)):
        for tried in ((0, 1), (1, 0)):
            best = boosting.best_split(np.stack([first, second]), tried, cand, 1.7, booster(1, minInstancesPerNode=5))
            assert best[1] == (tried[0], 0.0) and best[3][0] == 30


def test_no_round_is_grown_beyond_patience(encoded, monkeypatch):
    rows, columns = encoded
    grown, one = [], boosting.grown
    monkeypatch.setattr(boosting, "grown", lambda *a: grown.append(1) or one(*a))
    settings = learn.Boosting(rounds=60, patience=4)
    kept = learn.fit_patiently(booster(60, stepSize=1.0, minInstancesPerNode=1), rows, columns, 1.7, settings).getNumTrees
    assert len(grown) == kept + 4 < 60


def test_without_validation_rows_all_rounds_stay(encoded):
    rows, columns = encoded
    model = learn.fit_patiently(booster(3), rows.withColumn("_valid", F.lit(False)), columns, 1.7, learn.Boosting(rounds=3))
    assert model.getNumTrees == 3


def test_labels_other_than_0_and_1_are_refused(encoded):
    rows, columns = encoded
    odd = rows.withColumn("_y", F.when(F.col("_valid"), 2.0).otherwise(F.col("_y")))
    with pytest.raises(Exception, match="labels must be 0 or 1"):
        learn.fit_patiently(booster(3), odd, columns, 1.7, learn.Boosting(rounds=3))
