import math

import numpy as np
import pytest

from tradewind.operators.metrics import (
    REPORT_COLUMNS,
    cross_validation_metrics,
    metrics_report,
    regression_metrics,
)


@pytest.fixture
def measure(spark):
    def run(actual, predicted):
        rows = spark.createDataFrame(
            [(float(a), float(p)) for a, p in zip(actual, predicted, strict=True)],
            "y double, p double")
        return rows.agg(*regression_metrics("y", "p")).first()
    return run


@pytest.mark.parametrize(("actual", "predicted", "expected"), [
    ([100, 200, 300], [100, 200, 300], 0.0),
    ([100, 200], [110, 180], 10.0),
    ([0, 100], [50, 110], 10.0),
])
def test_mape(measure, actual, predicted, expected):
    assert measure(actual, predicted).mape == pytest.approx(expected)


def test_mape_without_any_actual_is_nan(measure):
    assert math.isnan(measure([0, 0, 0], [1, 1, 1]).mape)


def test_errors_equal_numpy(measure):
    chance = np.random.default_rng(5)
    y, p = chance.normal(50, 9, 40), chance.normal(50, 9, 40)
    found = measure(y, p)
    assert found.mae == pytest.approx(np.abs(y - p).mean())
    assert found.rmse == pytest.approx(np.sqrt(((y - p) ** 2).mean()))
    assert found.r2 == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())


def test_r2_of_constant_actuals(measure):
    assert measure([5, 5], [5, 5]).r2 == 1.0
    assert measure([5, 5], [5, 6]).r2 == 0.0


def test_report(spark):
    holdout = spark.createDataFrame(
        [("second", 1, 2.345, 3.0, 1.0, 0.98765), ("first", 0, 2.345, 3.0, 1.0, 0.5),
         ("best", 2, 1.0, 1.0, float("nan"), -3.0)],
        "model string, rank int, mae double, rmse double, mape double, r2 double")
    scores = spark.createDataFrame(
        [(m, n, v) for m in ("first", "second", "best")
         for n, v in enumerate((1000.0, 1100.0, 950.0))], "model string, fold int, mae double")
    rows = metrics_report(holdout, scores).collect()
    assert tuple(rows[0].__fields__) == REPORT_COLUMNS and len(REPORT_COLUMNS) == 7
    assert [row.model for row in rows] == ["best", "first", "second"]
    assert rows[2]["MAE"] == 2.35 and rows[2]["R²"] == 0.9877
    assert rows[0]["CV MAE médio"] == 1016.67
    # The spread is the population deviation.
    assert rows[0]["CV MAE desvio"] == round(float(np.std([1000, 1100, 950])), 2)
    assert cross_validation_metrics(scores).count() == 3
