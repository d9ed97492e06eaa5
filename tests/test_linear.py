"""Linear models from sums of products, against closed forms, plain loops and single runs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from test_features import COLUMNS, series_rows
from test_forecast import expected_forecast
from test_models import closed_form
from tradewind.operators.features import FEATURES, TARGET, feature_set, holdout_split
from tradewind.plans import linear, models
from tradewind.plans.forecast import forecast

CANDIDATES = linear.linear_candidates()
RIDGE = CANDIDATES[1:]


@pytest.fixture(scope="module")
def rows(spark):
    """Three series of different length, the last without a name and with five complete rows."""
    data = series_rows(60, "a") + series_rows(40, "b", seed=9) + series_rows(17, None, seed=4)
    return holdout_split(feature_set(spark.createDataFrame(data, COLUMNS))).cache()


def matrices(rows, key):
    data = rows.where(F.col("series_key").eqNullSafe(F.lit(key))).orderBy("order_month").toPandas()
    return data, data[list(FEATURES)].to_numpy(float), data[TARGET].to_numpy()


def predictor(row):
    return lambda x: row.level + (np.asarray(x, float) - np.array(row.centre)) @ np.array(
        row.weights)


@pytest.mark.parametrize(("place", "alpha", "tolerance"), [(1, 10.0, 1e-9), (0, 0.0, 1e-5)])
def test_fits_equal_closed_forms(rows, place, alpha, tolerance):
    found = linear.fit(rows, CANDIDATES[place:place + 1]).collect()
    assert {row.series_key for row in found} == {"a", "b", None}
    for row in found:
        _, x, y = matrices(rows, row.series_key)
        np.testing.assert_allclose(predictor(row)(x), closed_form(x, y, alpha)(x), rtol=tolerance)


@pytest.mark.parametrize("place", [0, 1])
def test_pooled_fits_equal_mllib(rows, place):
    """One model for all series, as the library's other fits are."""
    model = linear.fit(rows, CANDIDATES[place:place + 1], by_series=False).first()
    other = models.candidate_models()[CANDIDATES[place].model](rows)
    data = other.transform(rows).toPandas()
    np.testing.assert_allclose(predictor(model)(data[list(FEATURES)]), data["prediction"],
                               rtol=1e-6)


def test_cv_scores_of_every_series_equal_closed_forms(rows):
    train, _ = models.split_rows(rows)
    found = {(r.series_key, r.fold): r.mae
             for r in linear.linear_cv_scores(train, RIDGE).collect()}
    expected = {}
    for key in ("a", "b"):  # the third has too few rows
        _, x, y = matrices(train, key)
        size = len(y) // 6
        for fold in range(5):
            start = len(y) - (5 - fold) * size
            guess = closed_form(x[:start], y[:start], 10.0)(x[start:start + size])
            expected[key, fold] = np.abs(guess - y[start:start + size]).mean()
    assert found.keys() == expected.keys()
    for key, value in expected.items():
        assert found[key] == pytest.approx(value, rel=1e-8)


def test_pooled_cv_scores_equal_mllib(rows):
    train, _ = models.split_rows(rows.where("series_key IS NOT NULL"))
    fits = {"Ridge": models.candidate_models()["Ridge"]}
    other = {r.fold: r.mae for r in models.cv_scores(train, fits).collect()}
    found = {r.fold: r.mae for r in linear.linear_cv_scores(train, RIDGE, by_series=False).collect()}
    assert found == {fold: pytest.approx(mae, rel=1e-6) for fold, mae in other.items()}


def test_a_feature_that_never_varies_has_no_weight(rows):
    constant = rows.withColumns({"year": F.lit(2013), "lag_12": F.lit(1e9 / 3)})
    for row in linear.fit(constant, CANDIDATES).collect():
        weights = dict(zip(FEATURES, row.weights, strict=True))
        assert weights["year"] == weights["lag_12"] == 0


@pytest.mark.parametrize("mode", ["continued", "restarted"])
def test_forecast_equals_plain_loop(rows, mode):
    fitted = linear.fit(rows, RIDGE)
    found = linear.linear_forecast(fitted, rows, 8, mode).collect()
    for row in fitted.where("series_key IS NOT NULL").collect():
        known, _, _ = matrices(rows, row.series_key)
        first = int(known["trend"].max()) + 1 if mode == "continued" else len(known)
        expected = expected_forecast(lambda x, p=predictor(row): float(p(x)), known, 8, first)
        own = sorted((r.order_month, r.predicted_revenue) for r in found
                     if r.series_key == row.series_key)
        assert [month for month, _ in own] == [month for month, _ in expected]
        np.testing.assert_allclose([v for _, v in own], [v for _, v in expected], rtol=1e-9)
    short = [r.predicted_revenue for r in found if r.series_key is None]
    assert len(short) == 8 and math.isnan(short[0])


def test_pooled_forecast_equals_the_stepwise_one(rows):
    known = rows.where("series_key IS NOT NULL")
    found = linear.linear_forecast(linear.fit(known, RIDGE, by_series=False), known, 5)
    other = forecast(models.candidate_models()["Ridge"](known), known, 5)
    a, b = ({(r.series_key, r.order_month): r.predicted_revenue for r in frame.collect()}
            for frame in (found, other))
    assert a == {key: pytest.approx(value, rel=1e-6) for key, value in b.items()}


def test_each_series_has_the_results_of_its_own_run(rows):
    every = linear.champion_models(rows, CANDIDATES)
    scores = linear.linear_forecast(every, rows, 4).collect()
    for key in ("a", "b"):
        alone = rows.where(F.col("series_key") == key)
        model = linear.champion_models(alone, CANDIDATES)
        assert model.first().model == every.where(F.col("series_key") == key).first().model
        own = {r.order_month: r.predicted_revenue
               for r in linear.linear_forecast(model, alone, 4).collect()}
        assert own == {r.order_month: pytest.approx(r.predicted_revenue, rel=1e-7)
                       for r in scores if r.series_key == key}


def test_champions_break_ties_in_order(spark):
    holdout = spark.createDataFrame(
        [("s", "b", 1, 5.0), ("s", "a", 0, 5.0), (None, "b", 1, 4.0), (None, "a", 0, 9.0)],
        "series_key string, model string, rank int, mae double")
    assert {tuple(row) for row in linear.champions(holdout).collect()} == {
        ("s", "a", 5.0), (None, "b", 4.0)}


def test_one_plan(rows):
    """Fit and forecast run no job before they are asked for, and call no Python."""
    text = linear.linear_forecast(linear.fit(rows, RIDGE), rows)._jdf.queryExecution()
    assert "Python" not in text.executedPlan().toString()


def test_unknown_trend_mode_and_no_rows(rows):
    fitted = linear.fit(rows, RIDGE)
    with pytest.raises(ValueError, match="trend_mode"):
        linear.linear_forecast(fitted, rows, 2, "other")
    assert linear.fit(rows.limit(0), RIDGE).count() == 0
    assert linear.linear_cv_scores(rows.limit(0), RIDGE).count() == 0
