"""Regression metrics, each set computed in one aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The columns of the metrics report, in order.
REPORT_COLUMNS = ("model", "MAE", "RMSE", "MAPE (%)", "R²", "CV MAE médio", "CV MAE desvio")


def mape(actual: Column, predicted: Column) -> Column:
    """Mean absolute percentage error over non-zero actuals; NaN if there are none."""
    error = F.when(actual != 0, F.abs((actual - predicted) / actual))
    return F.coalesce(F.avg(error), F.lit(float("nan"))) * 100


def r2(actual: Column, predicted: Column) -> Column:
    """1 - SSE/SST; for constant actuals 1 if every prediction is exact, else 0."""
    squared = F.sum(F.pow(actual - predicted, 2))
    total = F.var_pop(actual) * F.count(actual)
    return (F.when(total > 0, 1 - squared / total)
            .when(squared == 0, F.lit(1.0)).otherwise(F.lit(0.0)))


def regression_metrics(actual: str, predicted: str) -> list[Column]:
    """Aggregates ``mae``, ``rmse``, ``mape`` and ``r2`` for ``df.agg`` or a grouped ``agg``."""
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    return [F.avg(F.abs(y - p)).alias("mae"),
            F.sqrt(F.avg(F.pow(y - p, 2))).alias("rmse"),
            mape(y, p).alias("mape"),
            r2(y, p).alias("r2")]


def cross_validation_metrics(scores: DataFrame) -> DataFrame:
    """Mean and population deviation of the fold errors, per model."""
    return scores.groupBy("model").agg(F.avg("mae").alias("cv_mae_mean"),
                                       F.stddev_pop("mae").alias("cv_mae_std"))


def metrics_report(holdout: DataFrame, scores: DataFrame) -> DataFrame:
    """The rounded report, best model first. ``holdout`` has one row of metrics per model."""
    joined = holdout.join(cross_validation_metrics(scores), "model")
    values = ("mae", "rmse", "mape", "r2", "cv_mae_mean", "cv_mae_std")
    rounded = [F.round(value, 4 if value == "r2" else 2).alias(name)
               for value, name in zip(values, REPORT_COLUMNS[1:], strict=True)]
    return joined.orderBy("mae", "rank").select("model", *rounded)
