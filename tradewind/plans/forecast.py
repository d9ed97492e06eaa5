"""Recursive forecasts and the run from monthly series to saved artifacts."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradewind.operators.features import (
    LAGS,
    ROLLING,
    TARGET,
    feature_set,
    holdout_split,
    time_columns,
)
from tradewind.operators.lineage import written
from tradewind.operators.metrics import metrics_report
from tradewind.plans.models import (
    PREDICTION,
    ModelSettings,
    candidate_models,
    feature_importance,
    train_and_evaluate,
)
from tradewind.plans.sales import monthly_sales
from tradewind.plans.warehouse import Warehouse
from tradewind.sources.files import read_monthly_csv, save_artifacts

# "continued": the trend goes on from the last training row. "restarted": it counts on from
# the number of complete rows, which is lower by the rows the longest lag used up.
TREND_MODES = ("continued", "restarted")


def _last(values: Column, count: int) -> Column:
    """The last ``count`` entries, or all of them if there are fewer."""
    return F.slice(values, F.greatest(F.size(values) - (count - 1), F.lit(1)), F.lit(count))


def _mean(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, v: total + v) / F.size(values)


def _sample_deviation(values: Column, mean: Column) -> Column:
    squares = F.aggregate(values, F.lit(0.0), lambda total, v: total + (v - mean) * (v - mean))
    return F.when(F.size(values) > 1, F.sqrt(squares / (F.size(values) - 1))).otherwise(0.0)


def _step_features(state: DataFrame, step: int) -> DataFrame:
    history = F.col("history")
    month = F.add_months("last_month", step)
    columns = {"order_month": month, **time_columns(month),
               "trend": F.col("last_trend") + step}
    for lag in LAGS:
        columns[f"lag_{lag}"] = F.try_element_at(history, F.lit(-lag))
    for size in ROLLING:
        columns[f"rolling_{size}_mean"] = _mean(_last(history, size))
    rows = state.withColumns(columns)
    return rows.withColumns({
        f"rolling_{size}_std": _sample_deviation(
            _last(history, size), F.col(f"rolling_{size}_mean")) for size in ROLLING})


def forecast(model: PipelineModel, known: DataFrame, horizon: int = 6,
             trend_mode: str = "continued") -> DataFrame:
    """(series_key, order_month, predicted_revenue) for the next ``horizon`` months.

    ``known`` is the feature set. Each prediction, not below zero, becomes part of the history
    that the next step's lags and statistics read. All series advance together, one model
    call per step; a series only carries its last twelve values. A lag that a short series
    does not have is missing (NaN) for the model.
    """
    if trend_mode not in TREND_MODES:
        raise ValueError(f"trend_mode must be one of {TREND_MODES}")
    newest = Window.partitionBy("series_key").orderBy(F.col("order_month").desc())
    counted = known.withColumns({
        "age": F.row_number().over(newest),
        "rows": F.count(F.lit(1)).over(Window.partitionBy("series_key"))})
    last_trend = F.max("trend") if trend_mode == "continued" else F.first("rows") - 1
    entries = F.array_sort(F.collect_list(F.struct("order_month", TARGET)))
    state = (counted.where(F.col("age") <= max(LAGS))
             .groupBy("series_key")
             .agg(F.max("order_month").alias("last_month"),
                  last_trend.cast("int").alias("last_trend"),
                  F.transform(entries, lambda e: e[TARGET].cast("double")).alias("history"))
             .withColumn("predicted", F.array().cast("array<struct<order_month:date,"
                                                     "predicted_revenue:double>>")))
    for step in range(1, horizon + 1):
        scored = model.transform(_step_features(state, step))
        value = F.greatest(F.col(PREDICTION), F.lit(0.0))
        outcome = F.struct(F.col("order_month").alias("order_month"),
                           value.alias("predicted_revenue"))
        # Written out per step: the plan of a step would otherwise contain all earlier ones.
        state = written(scored.select(
            "series_key", "last_month", "last_trend",
            _last(F.array_append("history", value), max(LAGS)).alias("history"),
            F.array_append("predicted", outcome).alias("predicted")))
    return (state.select("series_key", F.explode("predicted").alias("entry"))
            .select("series_key", "entry.order_month", "entry.predicted_revenue"))


@dataclass(frozen=True)
class ForecastResult:
    """Outcome of a run. ``importance`` is None if the champion is a linear model."""

    champion: str
    metrics: DataFrame
    forecast: DataFrame
    importance: DataFrame | None
    model: PipelineModel


class DemandForecast:
    """Features, model comparison and forecast for a frame of monthly series."""

    def __init__(self, series: DataFrame, *, horizon: int = 6, folds: int = 5,
                 test_size: float = 0.2, trend_mode: str = "continued",
                 settings: ModelSettings | None = None):
        self.series = series
        self.horizon = horizon
        self.folds = folds
        self.test_size = test_size
        self.trend_mode = trend_mode
        self.settings = settings or ModelSettings()

    @classmethod
    def from_warehouse(cls, warehouse: Warehouse, series: str | None = None, *,
                       through: date | None = None, **options) -> DemandForecast:
        """Monthly sales of a warehouse: all months, or those up to the month of ``through``.

        Whether the last month is over can't be told from the data; a caller who knows that it
        is not names the last month to use.
        """
        months = monthly_sales(warehouse, series, customers=False)
        if through is not None:
            months = months.where(F.col("order_month") <= F.lit(through))
        return cls(months, **options)

    @classmethod
    def from_csv(cls, spark: SparkSession, path: str, **options) -> DemandForecast:
        return cls(read_monthly_csv(spark, path), **options)

    def features(self) -> DataFrame:
        """The split feature set, computed once and written to the checkpoint folder."""
        return written(holdout_split(feature_set(self.series), self.test_size))

    def run(self, save_to: str | None = None) -> ForecastResult:
        """Compare the models, forecast with the best and, if asked, save the outcome."""
        rows = self.features()
        training = train_and_evaluate(
            rows, candidate_models(self.settings), test_size=self.test_size, folds=self.folds,
            parallel=self.settings.parallel_fits)
        result = ForecastResult(
            champion=training.champion,
            metrics=metrics_report(training.holdout, training.scores),
            forecast=forecast(training.model, rows, self.horizon, self.trend_mode),
            importance=feature_importance(training.model),
            model=training.model)
        if save_to:
            save_artifacts(save_to, result.model, result.metrics, result.forecast,
                           result.importance)
        return result
