"""Training, calibrating, explaining and scoring the delay model on MLlib.

Fitting runs Spark jobs by nature; everything else in here is lazy.  What reaches
the driver is the model: category levels, trees, and a calibration curve on a grid
of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    LogisticRegressionModel,
)
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from punctua.contract import (
    AUC_FLOOR,
    CATEGORICAL,
    FEATURES,
    LABEL,
    NUMERIC,
    TEST_YEARS,
    TRAIN_YEARS,
)
from punctua.functions.scores import risk_band, round6, top_factors
from punctua.operators.history import fit_base_rates, score_base_rate
from punctua.operators.metrics import class_weight, evaluation_table
from punctua.operators.slices import split_counts, temporal_slices, temporal_split
from punctua.plans.boosting import fit_boosted
from punctua.session import cut
from punctua.sources.tables import require_columns

MISSING = -9999.0
GRID = 1_000_000
TIES = ("carrier", "origin", "dest", "dep_hour", "distance", "crs_elapsed_time")


@dataclass(frozen=True)
class Boosting:
    """Settings of the boosted trees.  Depth bounds a tree where leaves would."""

    rounds: int = 800
    learning_rate: float = 0.05
    max_depth: int = 6
    min_rows_per_leaf: int = 50
    row_share: float = 0.85
    feature_share: str = "0.85"
    min_gain: float = 0.0
    patience: int = 50
    seed: int = 17


@dataclass
class Calibrator:
    """Raw score to honest probability, with its error on the calibration slice."""

    method: str
    model: IsotonicRegressionModel | LogisticRegressionModel
    brier_before: float
    brier_after: float

    def transform(self, df: DataFrame, raw: str, out: str) -> DataFrame:
        if self.method == "isotonic":
            scored = self.model.transform(df.withColumn("_raw", F.col(raw)))
            return scored.withColumn(
                out, F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("_calibrated")))
            ).drop("_raw", "_calibrated")
        scored = self.model.transform(df.withColumn("_raw", array_to_vector(F.array(raw))))
        return scored.withColumn(out, vector_to_array("_p")[1]).drop("_raw", "_p", "_margin", "_cls")


@dataclass
class Bundle:
    """All that scoring needs."""

    pipeline: PipelineModel
    calibrator: Calibrator
    base_rates: DataFrame
    prior: float


# --- encoding ------------------------------------------------------------------------


def prepared(df: DataFrame) -> DataFrame:
    """Text categories and plain doubles; an unknown number becomes a value of its own."""
    return df.withColumns(
        {
            **{f"{c}_txt": F.col(c).cast("string") for c in CATEGORICAL},
            **{
                f"{c}_num": F.coalesce(F.col(c).try_cast("float").cast("double"), F.lit(MISSING))
                for c in NUMERIC
            },
        }
    )


def encoder() -> list:
    """Categories by code (unseen ones get a code of their own) and the feature vector."""
    indexer = StringIndexer(
        inputCols=[f"{c}_txt" for c in CATEGORICAL],
        outputCols=[f"{c}_code" for c in CATEGORICAL],
        handleInvalid="keep",
        stringOrderType="alphabetAsc",
    )
    assembler = VectorAssembler(
        inputCols=[f"{c}_code" for c in CATEGORICAL] + [f"{c}_num" for c in NUMERIC],
        outputCol="features",
    )
    return [indexer, assembler]


# --- training ------------------------------------------------------------------------


def train_model(
    train: DataFrame, fit_and_valid: DataFrame, boosting: Boosting, label: str = LABEL
) -> PipelineModel:
    """Encoder from all training rows, trees from the fit slice, stopping on the valid one."""
    indexer, assembler = encoder()
    codes = indexer.fit(prepared(train.select(*FEATURES)))
    widest = max(len(levels) for levels in codes.labelsArray) + 1
    fit_rows = fit_and_valid.where(F.col("slice") == "fit")
    weight = class_weight(fit_rows, label).first()["scale_pos_weight"]
    rows = fit_and_valid.select(
        *FEATURES,
        F.col(label).cast("double").alias("_y"),
        F.when(F.col(label) == 1, F.lit(float(weight))).otherwise(1.0).alias("_w"),
        (F.col("slice") == "valid").alias("_valid"),
    )
    encoded = assembler.transform(codes.transform(prepared(rows)))
    booster = GBTClassifier(
        labelCol="_y",
        weightCol="_w",
        featuresCol="features",
        predictionCol="_cls",
        stepSize=boosting.learning_rate,
        maxDepth=boosting.max_depth,
        maxBins=max(32, widest),
        minInstancesPerNode=boosting.min_rows_per_leaf,
        minInfoGain=boosting.min_gain,
        subsamplingRate=boosting.row_share,
        featureSubsetStrategy=boosting.feature_share,
        seed=boosting.seed,
    )
    booster.setProbabilityCol("_p").setRawPredictionCol("_margin")
    trees = fit_patiently(booster, encoded, assembler.getInputCols(), float(weight), boosting)
    return PipelineModel([codes, assembler, trees])


def fit_patiently(
    booster: GBTClassifier, encoded: DataFrame, columns: Sequence[str], weight: float, boosting: Boosting
) -> GBTClassificationModel:
    """The trees up to the round of least validation loss, once no better one has come for ``patience`` rounds.

    No round is grown beyond these.  Without validation rows all rounds are kept.
    """

    def stop(loss: Sequence[float], last: bool = False) -> int | None:
        best, stopped = best_round(loss, boosting.patience)
        return best if stopped or last else None

    return fit_boosted(booster, encoded, columns, "_valid", weight, boosting.rounds, stop)


def best_round(loss: Sequence[float], patience: int) -> tuple[int, bool]:
    """The round (from 1) of least loss before ``patience`` rounds without a better one, and whether these came."""
    best = 0
    for n, x in enumerate(loss):
        if x < loss[best]:
            best = n
        elif n - best >= patience:
            return best + 1, True
    return best + 1, False


def raw_scores(pipeline: PipelineModel, rows: DataFrame, out: str = "raw_probability") -> DataFrame:
    """Uncalibrated probability; the feature vector stays for the explanation."""
    scored = pipeline.transform(prepared(rows)).withColumn(out, vector_to_array("_p")[1])
    return scored.select(*rows.columns, "features", out)


def fit_calibrator(
    scored: DataFrame, label: str = LABEL, raw: str = "raw_probability", method: str = "isotonic"
) -> Calibrator:
    """Calibration map from the most recent slice.

    The isotonic fit finishes on the driver, so it is given scores on a grid of a
    millionth with their label means and counts: at most a million and one rows,
    however large the slice.
    """
    y = F.col(label).cast("double")
    if method == "isotonic":
        grid = (
            scored.groupBy((F.round(F.col(raw) * GRID, 0) / GRID).alias("_raw"))
            .agg(F.avg(y).alias("_y"), F.count("*").cast("double").alias("_n"))
        )
        model = IsotonicRegression(
            featuresCol="_raw", labelCol="_y", weightCol="_n", predictionCol="_calibrated"
        ).fit(grid)
    elif method == "sigmoid":
        rows = scored.select(array_to_vector(F.array(raw)).alias("_raw"), y.alias("_y"))
        model = LogisticRegression(
            featuresCol="_raw",
            labelCol="_y",
            predictionCol="_cls",
            probabilityCol="_p",
            rawPredictionCol="_margin",
            maxIter=1000,
            regParam=1.0 / max(1, rows.count()),
            standardization=False,
        ).fit(rows)
    else:
        raise ValueError(f"calibration method must be isotonic or sigmoid, got {method!r}")
    calibrator = Calibrator(method, model, float("nan"), float("nan"))
    both = calibrator.transform(scored, raw, "_p1").agg(
        F.avg(F.pow(F.col(raw) - y, 2)).alias("before"), F.avg(F.pow(F.col("_p1") - y, 2)).alias("after")
    ).first()
    calibrator.brier_before, calibrator.brier_after = both["before"], both["after"]
    return calibrator


def train_bundle(
    gold: DataFrame,
    train_years: Sequence[int] = TRAIN_YEARS,
    test_years: Sequence[int] = TEST_YEARS,
    boosting: Boosting = Boosting(),
    method: str = "isotonic",
    ties: Sequence[str] = TIES,
) -> tuple[Bundle, DataFrame]:
    """The whole training job over a stored feature table: bundle and test metrics.

    ``ties`` orders the rows of one day when the training period is cut into slices.
    """
    gold = require_columns(gold, [*FEATURES, LABEL, "flight_date", "year"])
    train, test = temporal_split(gold, train_years, test_years)
    sides = split_counts(gold, train_years, test_years).first()
    if not sides["train_rows"] or not sides["test_rows"]:
        raise ValueError(f"empty side in the temporal split: {sides.asDict()}")
    # Every boosting round reads the slices: store them once instead of cutting anew.
    sliced = cut(temporal_slices(train, list(ties)))
    rates, prior = fit_base_rates(train), train.agg(F.avg(F.col(LABEL).cast("double"))).first()[0]
    pipeline = train_model(train, sliced.where(F.col("slice") != "calib"), boosting)
    calibrator = fit_calibrator(
        raw_scores(pipeline, sliced.where(F.col("slice") == "calib")), method=method
    )
    bundle = Bundle(pipeline, calibrator, rates, float(prior))
    metrics = evaluation_table(scored_rows(bundle, test), LABEL).withColumns(
        {
            "calib_brier_before": F.lit(calibrator.brier_before),
            "calib_brier_after": F.lit(calibrator.brier_after),
            "rounds_used": F.lit(pipeline.stages[-1].getNumTrees),
        }
    )
    return bundle, metrics


# --- scoring --------------------------------------------------------------------------


def scored_rows(bundle: Bundle, rows: DataFrame) -> DataFrame:
    """Raw, calibrated and baseline probability of each row."""
    raw = raw_scores(bundle.pipeline, rows)
    calibrated = bundle.calibrator.transform(raw, "raw_probability", "delay_probability")
    return score_base_rate(calibrated, bundle.base_rates, F.lit(bundle.prior))


def batch_score(bundle: Bundle, rows: DataFrame, k: int = 3, explain: bool = True) -> DataFrame:
    """The served prediction of each row: probability, band, baseline and top factors."""
    scored = scored_rows(bundle, require_columns(rows, dict.fromkeys([*rows.columns, *FEATURES])))
    p, base = F.col("delay_probability"), F.col("baseline_probability")
    out = scored.withColumns(
        {"risk_band": risk_band(p), "beats_baseline": F.abs(p - base) > 1e-6}
    )
    if explain:
        out = with_factors(bundle.pipeline, out, k)
    return out.withColumns(
        {"delay_probability": round6(p), "baseline_probability": round6(base), "calibrated": F.lit(True)}
    ).drop("features", "raw_probability")


# --- explanation ------------------------------------------------------------------------


@dataclass
class TreeTable:
    """Nodes of all trees as flat arrays; children are positions in the arrays."""

    roots: np.ndarray
    weight: np.ndarray
    prediction: np.ndarray
    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    goes_left: np.ndarray  # node x category; all False for continuous splits
    categorical: np.ndarray


def tree_table(trees: GBTClassificationModel) -> TreeTable:
    """Flatten the fitted trees.  Their number and depth are fixed by the settings."""
    weights = list(trees.treeWeights)
    rows, roots = [], []

    def walk(node, weight: float) -> int:
        at = len(rows)
        row = {"w": weight, "pred": node.prediction(), "l": -1, "r": -1, "f": -1, "t": np.nan}
        rows.append(row)
        if node.getClass().getSimpleName() == "InternalNode":
            split = node.split()
            row["f"] = split.featureIndex()
            if split.getClass().getSimpleName() == "CategoricalSplit":
                row["cats"] = [int(c) for c in split.leftCategories()]
            else:
                row["t"] = split.threshold()
            row["l"] = walk(node.leftChild(), weight)
            row["r"] = walk(node.rightChild(), weight)
        return at

    for weight, tree in zip(weights, trees.trees):
        roots.append(walk(tree._java_obj.rootNode(), weight))
    width = 1 + max([c for r in rows for c in r.get("cats", [])], default=0)
    goes_left = np.zeros((len(rows), width), dtype=bool)
    for i, r in enumerate(rows):
        goes_left[i, r.get("cats", [])] = True
    return TreeTable(
        np.array(roots),
        np.array([r["w"] for r in rows]),
        np.array([r["pred"] for r in rows]),
        np.array([r["l"] for r in rows]),
        np.array([r["r"] for r in rows]),
        np.array([r["f"] for r in rows]),
        np.array([r["t"] for r in rows]),
        goes_left,
        np.array(["cats" in r for r in rows]),
    )


def path_contributions(x: np.ndarray, t: TreeTable) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds contribution of each feature and the common base, for rows ``x``.

    Walking down a tree, each split moves the expected value; the move is credited to
    the feature of the split.  Contributions and base add up to the log-odds exactly.
    Unlike Shapley values, the credit depends on the order of the splits.
    """
    n, width = x.shape
    out = np.zeros((n, width))
    base = np.zeros(n)
    every = np.arange(n)
    for root in t.roots:
        node = np.full(n, root)
        base += 2 * t.weight[root] * t.prediction[root]
        active = every[t.feature[node] >= 0]
        while active.size:
            at = node[active]
            feature = t.feature[at]
            value = x[active, feature]
            code = np.clip(value, 0, t.goes_left.shape[1] - 1).astype(int)
            in_set = t.goes_left[at, code] & (value < t.goes_left.shape[1])
            left = np.where(t.categorical[at], in_set, value <= t.threshold[at])
            child = np.where(left, t.left[at], t.right[at])
            move = 2 * t.weight[at] * (t.prediction[child] - t.prediction[at])
            out[active, feature] += move
            node[active] = child
            active = active[t.feature[child] >= 0]
    return out, base


def with_contributions(pipeline: PipelineModel, rows: DataFrame) -> DataFrame:
    """Add ``contributions`` (one per feature) and ``base`` in log-odds.

    The only Python stage of scoring: numpy over Arrow batches, with the tree arrays
    in the closure.
    """
    table = tree_table(pipeline.stages[-1])
    plain = rows.withColumn("features", vector_to_array("features"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)

    def attribute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("features").flatten().to_numpy(zero_copy_only=False)
            x = x.reshape(batch.num_rows, -1 if batch.num_rows else 1)
            moves, base = path_contributions(x, table)
            ends = np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(moves.ravel()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, lists, pa.array(base)], [*batch.schema.names, "contributions", "base"]
            )

    return plain.mapInArrow(attribute, f"{fields}, contributions array<double>, base double")


def with_factors(pipeline: PipelineModel, rows: DataFrame, k: int = 3) -> DataFrame:
    """Add ``top_factors``: the k features with the largest signed contribution."""
    entries: list[tuple[str, Column, Column]] = [
        (f, F.col(f), F.col("contributions")[i]) for i, f in enumerate(FEATURES)
    ]
    explained = with_contributions(pipeline, rows)
    return explained.withColumn("top_factors", top_factors(entries, k)).drop("contributions", "base")


# --- storing ------------------------------------------------------------------------------


def save_bundle(bundle: Bundle, path: str) -> None:
    """Model, calibrator, base rates and scalars below one folder."""
    bundle.pipeline.write().overwrite().save(f"{path}/model")
    bundle.calibrator.model.write().overwrite().save(f"{path}/calibrator")
    bundle.base_rates.write.mode("overwrite").parquet(f"{path}/base_rates")
    c = bundle.calibrator
    spark = bundle.base_rates.sparkSession
    spark.createDataFrame(
        [(c.method, c.brier_before, c.brier_after, bundle.prior)],
        "method string, brier_before double, brier_after double, prior double",
    ).coalesce(1).write.mode("overwrite").json(f"{path}/meta")


def load_bundle(spark: SparkSession, path: str) -> Bundle:
    meta = spark.read.schema(
        "method string, brier_before double, brier_after double, prior double"
    ).json(f"{path}/meta").first()
    kind = IsotonicRegressionModel if meta["method"] == "isotonic" else LogisticRegressionModel
    return Bundle(
        PipelineModel.load(f"{path}/model"),
        Calibrator(
            meta["method"], kind.load(f"{path}/calibrator"), meta["brier_before"], meta["brier_after"]
        ),
        spark.read.parquet(f"{path}/base_rates"),
        meta["prior"],
    )


def quality_gate(
    runs: DataFrame, floor: float = AUC_FLOOR, order: str = "run", metric: str = "roc_auc"
) -> DataFrame:
    """Which training runs are published: at or above the floor and above the last
    published run.

    Published values only ever rise, so the last published one is the best run so far
    that cleared the floor.  One row per model: the window over all of them is small.
    """
    earlier = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    cleared = F.col(metric) >= floor
    previous = F.max(F.when(cleared, F.col(metric))).over(earlier)
    return runs.withColumn("previous", previous).withColumn(
        "published",
        F.coalesce(
            cleared & (F.col("previous").isNull() | (F.col(metric) > F.col("previous"))),
            F.lit(False),
        ),
    )
