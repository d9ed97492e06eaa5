"""Candidate regressors and how they are fitted, validated and compared.

Models are fitted with MLlib on all series together; splits and folds are cut per series.
Every fit is a Spark job of its own, and independent fits run side by side.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.operators.features import (
    FEATURES,
    TARGET,
    fold_size,
    fold_start,
    train_length,
)
from tradewind.operators.metrics import regression_metrics

PREDICTION = "prediction"


@dataclass(frozen=True)
class ModelSettings:
    """Model sizes. Smaller forests and fewer rounds suit quick runs."""

    ridge_alpha: float = 10.0
    forest_trees: int = 200
    forest_depth: int = 6
    forest_min_leaf: int = 3
    boosting_rounds: int = 200
    boosting_rate: float = 0.05
    boosting_depth: int = 4
    boosting_subsample: float = 0.8
    # Enough bins that short series are split between any two values.
    max_bins: int = 256
    seed: int = 42
    parallel_fits: int = 4


Fit = Callable[[DataFrame], PipelineModel]


def _assembler(output: str = "features") -> VectorAssembler:
    # "keep" passes a missing lag on as NaN when a short series is forecast.
    return VectorAssembler(inputCols=list(FEATURES), outputCol=output, handleInvalid="keep")


def _standardised() -> list:
    return [_assembler("raw_features"),
            StandardScaler(inputCol="raw_features", outputCol="features",
                           withMean=True, withStd=True)]


def _fit(stages: list) -> Fit:
    return lambda rows: Pipeline(stages=stages).fit(rows)


def ridge_parameter(alpha: float, count: int, deviation: float) -> float:
    """MLlib's ``regParam`` for a ridge penalty ``alpha`` on population-standardised features.

    MLlib averages the squared errors over ``count`` rows and divides the penalty by the
    label's deviation; its scaler uses the sample deviation, hence (count - 1) / count.
    """
    return alpha * deviation * (count - 1) / count**2


# Penalty per row, in units of a standardised feature's variance, that only decides between
# exact solutions: the features are partly collinear (trend, year and month; a rolling mean
# and its lags), and the least-squares solution of smallest norm is wanted.
VANISHING_PENALTY = 1e-10


def _fit_linear(penalty: Callable[[int], float]) -> Fit:
    """Linear regression on standardised features; ``penalty`` gives alpha for a row count."""
    def fit(rows: DataFrame) -> PipelineModel:
        label = rows.agg(F.count(TARGET).alias("n"), F.stddev_pop(TARGET).alias("sd")).first()
        regressor = LinearRegression(
            labelCol=TARGET, elasticNetParam=0.0, standardization=False, solver="normal",
            regParam=ridge_parameter(penalty(label.n), label.n, label.sd))
        return Pipeline(stages=[*_standardised(), regressor]).fit(rows)
    return fit


def candidate_models(settings: ModelSettings | None = None) -> dict[str, Fit]:
    """The candidates by name, in the order that breaks ties."""
    s = settings or ModelSettings()
    forest = RandomForestRegressor(
        labelCol=TARGET, numTrees=s.forest_trees, maxDepth=s.forest_depth,
        minInstancesPerNode=s.forest_min_leaf, featureSubsetStrategy="all",
        maxBins=s.max_bins, seed=s.seed)
    boosting = GBTRegressor(
        labelCol=TARGET, maxIter=s.boosting_rounds, stepSize=s.boosting_rate,
        maxDepth=s.boosting_depth, subsamplingRate=s.boosting_subsample,
        maxBins=s.max_bins, seed=s.seed)
    return {
        "LinearRegression (baseline)": _fit_linear(lambda count: VANISHING_PENALTY * count),
        "Ridge": _fit_linear(lambda count: s.ridge_alpha),
        "RandomForest": _fit([_assembler(), forest]),
        "GradientBoosting": _fit([_assembler(), boosting]),
    }


TREE_MODELS = ("RandomForest", "GradientBoosting")


def _side_by_side(spark: SparkSession, work: Callable, items: Sequence, threads: int) -> list:
    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        return list(pool.map(inheritable_thread_target(spark)(work), items))


def _folds(rows: DataFrame, folds: int) -> list[tuple[DataFrame, DataFrame]]:
    """(train, validation) rows of every expanding fold, cut per series."""
    length, position = F.col("length"), F.col("position")
    parts = []
    for fold in range(folds):
        start = fold_start(length, fold, folds)
        parts.append((rows.where(position < start),
                      rows.where((position >= start)
                                 & (position < start + fold_size(length, folds)))))
    return parts


def cv_scores(rows: DataFrame, models: dict[str, Fit], folds: int = 5,
              parallel: int = 4) -> DataFrame:
    """(model, fold, mae) of a walk-forward validation.

    ``rows`` carry ``position`` and ``length`` within their series. At least one series needs
    more rows than there are folds.
    """
    longest = rows.agg(F.max("length").alias("rows")).first().rows or 0
    if longest <= folds:
        raise ValueError(f"{longest} rows are too few for {folds} folds")
    parts = _folds(rows, folds)
    tasks = [(name, fold) for name in models for fold in range(folds)]

    def score(task: tuple[str, int]) -> tuple[str, int, float]:
        name, fold = task
        train, valid = parts[fold]
        error = F.avg(F.abs(F.col(TARGET) - F.col(PREDICTION))).alias("mae")
        return name, fold, models[name](train).transform(valid).agg(error).first().mae

    spark = rows.sparkSession
    return spark.createDataFrame(_side_by_side(spark, score, tasks, parallel),
                                 "model string, fold int, mae double")


def holdout_metrics(train: DataFrame, test: DataFrame, models: dict[str, Fit],
                    parallel: int = 4) -> DataFrame:
    """(model, rank, mae, rmse, mape, r2) of each model on the held-out rows."""
    if train.isEmpty() or test.isEmpty():
        raise ValueError("no series is long enough for a training and a test part")

    def score(item: tuple[int, str]) -> tuple:
        rank, name = item
        predicted = models[name](train).transform(test)
        return (name, rank, *predicted.agg(*regression_metrics(TARGET, PREDICTION)).first())

    spark = train.sparkSession
    rows = _side_by_side(spark, score, list(enumerate(models)), parallel)
    return spark.createDataFrame(
        rows, "model string, rank int, mae double, rmse double, mape double, r2 double")


def champion(holdout: DataFrame) -> DataFrame:
    """The model with the lowest held-out error; the first listed one wins a tie."""
    best = F.struct("mae", "rank")
    return holdout.agg(F.min_by("model", best).alias("model"), F.min("mae").alias("mae"))


def feature_importance(model: PipelineModel) -> DataFrame | None:
    """(feature, importance) in falling order, or None for a linear model."""
    weights = getattr(model.stages[-1], "featureImportances", None)
    if weights is None:
        return None
    spark = SparkSession.active()
    rows = list(zip(FEATURES, weights.toArray().tolist(), strict=True))
    return (spark.createDataFrame(rows, "feature string, importance double")
            .orderBy(F.col("importance").desc(), "feature"))


def split_rows(rows: DataFrame, test_size: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """Train and test rows of a holdout split; ``length`` becomes that of the train part."""
    train = (rows.where("is_train")
             .withColumn("length", train_length(F.col("length"), test_size)))
    return train, rows.where(~F.col("is_train"))


@dataclass(frozen=True)
class Training:
    """What a comparison of the candidates yields."""

    scores: DataFrame
    holdout: DataFrame
    champion: str
    model: PipelineModel


def train_and_evaluate(rows: DataFrame, models: dict[str, Fit], *, test_size: float = 0.2,
                       folds: int = 5, parallel: int = 4) -> Training:
    """Validate, compare on the held-out end of each series, refit the best on all rows.

    ``rows`` come from ``holdout_split`` with the same ``test_size``. Every fit reads them, so
    they should be written out first.
    """
    train, test = split_rows(rows, test_size)
    scores = cv_scores(train, models, folds, parallel)
    holdout = holdout_metrics(train, test, models, parallel)
    best = champion(holdout).first().model
    return Training(scores, holdout, best, models[best](rows))
