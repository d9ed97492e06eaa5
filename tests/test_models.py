"""Models: linear ones against closed forms, trees by property."""

import numpy as np
import pytest

from test_features import monthly  # noqa: F401
from tradewind.operators.features import FEATURES, TARGET, feature_set, holdout_split
from tradewind.plans import models
from tradewind.plans.models import ModelSettings, candidate_models, cv_scores

SETTINGS = ModelSettings(forest_trees=20, boosting_rounds=5)


@pytest.fixture(scope="module")
def rows(spark, monthly):  # noqa: F811
    return holdout_split(feature_set(monthly)).cache()


@pytest.fixture(scope="module")
def fits():
    return candidate_models(SETTINGS)


def closed_form(x, y, alpha):
    """Ridge, or the smallest-norm least squares for alpha 0, on standardised columns."""
    mean, scale = x.mean(0), x.std(0)
    scale[scale < 1e-9] = 1.0
    z = (x - mean) / scale
    if alpha:
        w = np.linalg.solve(z.T @ z + alpha * np.eye(z.shape[1]), z.T @ (y - y.mean()))
    else:
        w = np.linalg.lstsq(z, y - y.mean(), rcond=1e-10)[0]
    return lambda q: (q - mean) / scale @ w + y.mean()


@pytest.mark.parametrize("train", [5, 12, 20, 25])
@pytest.mark.parametrize(("name", "alpha", "tolerance"), [
    ("Ridge", 10.0, 1e-7), ("LinearRegression (baseline)", 0.0, 1e-5)])
def test_linear_models_equal_closed_form(spark, rows, fits, train, name, alpha, tolerance):
    data = rows.orderBy("order_month").toPandas()
    x, y = data[list(FEATURES)].to_numpy(float), data[TARGET].to_numpy()
    expected = closed_form(x[:train], y[:train], alpha)(x)
    model = fits[name](spark.createDataFrame(data.iloc[:train]))
    found = [row.prediction for row in model.transform(spark.createDataFrame(data))
             .orderBy("order_month").collect()]
    np.testing.assert_allclose(found, expected, rtol=tolerance)


def test_candidates():
    assert list(candidate_models()) == [
        "LinearRegression (baseline)", "Ridge", "RandomForest", "GradientBoosting"]
    full = ModelSettings()
    assert (full.forest_trees, full.forest_depth, full.forest_min_leaf) == (200, 6, 3)
    assert (full.boosting_rounds, full.boosting_rate, full.boosting_depth,
            full.boosting_subsample) == (200, 0.05, 4, 0.8)
    assert full.ridge_alpha == 10.0 and full.seed == 42


def test_all_models_predict_every_row(rows, fits):
    for name, fit in fits.items():
        found = fit(rows).transform(rows).where("not isnan(prediction)").count()
        assert found == rows.count(), name


def test_trees_follow_the_target(rows, fits):
    for name in models.TREE_MODELS:
        assert fits[name](rows).transform(rows).corr(TARGET, "prediction") > 0.8


def test_cv_scores(rows, fits):
    train, _ = models.split_rows(rows)
    for folds in (3, 5):
        found = cv_scores(train, {"Ridge": fits["Ridge"]}, folds).collect()
        assert [row.fold for row in sorted(found, key=lambda r: r.fold)] == list(range(folds))
        assert all(row.mae >= 0 for row in found)


def test_cv_score_is_the_error_of_its_fold(rows, fits):
    data = rows.orderBy("order_month").toPandas()
    x, y = data[list(FEATURES)].to_numpy(float), data[TARGET].to_numpy()
    train, _ = models.split_rows(rows)
    found = {r.fold: r.mae for r in cv_scores(train, {"Ridge": fits["Ridge"]}).collect()}
    for fold, start in enumerate((5, 8, 11, 14, 17)):
        predicted = closed_form(x[:start], y[:start], 10.0)(x[start:start + 3])
        assert found[fold] == pytest.approx(np.abs(predicted - y[start:start + 3]).mean(),
                                            rel=1e-5)


def test_too_few_rows_for_the_folds(rows, fits):
    train, test = models.split_rows(rows)
    with pytest.raises(ValueError, match="20 rows are too few for 20 folds"):
        cv_scores(train, {"Ridge": fits["Ridge"]}, 20)
    with pytest.raises(ValueError, match="0 rows"):
        cv_scores(train.limit(0), {"Ridge": fits["Ridge"]}, 3)
    with pytest.raises(ValueError, match="long enough"):
        models.holdout_metrics(train, test.limit(0), fits)


def test_champion_breaks_ties_in_order(spark):
    holdout = spark.createDataFrame(
        [("b", 1, 5.0), ("a", 0, 5.0), ("c", 2, 9.0)], "model string, rank int, mae double")
    assert tuple(models.champion(holdout).first()) == ("a", 5.0)


def test_feature_importance(rows, fits):
    for name in models.TREE_MODELS:
        found = models.feature_importance(fits[name](rows)).collect()
        weights = [row.importance for row in found]
        assert {row.feature for row in found} == set(FEATURES)
        assert sum(weights) == pytest.approx(1.0, abs=1e-9)
        assert weights == sorted(weights, reverse=True)
    assert models.feature_importance(fits["Ridge"](rows)) is None


def test_train_and_evaluate(rows, fits):
    linear = {name: fits[name] for name in list(fits)[:2]}
    result = models.train_and_evaluate(rows, linear, folds=4)
    assert result.scores.count() == 8 and result.holdout.count() == 2
    best = result.holdout.orderBy("mae").first()
    assert result.champion == best.model and best.r2 > 0
    # The champion is refitted on all rows.
    data = rows.orderBy("order_month").toPandas()
    x, y = data[list(FEATURES)].to_numpy(float), data[TARGET].to_numpy()
    alpha = 10.0 if result.champion == "Ridge" else 0.0
    found = [row.prediction for row in
             result.model.transform(rows).orderBy("order_month").collect()]
    np.testing.assert_allclose(found, closed_form(x, y, alpha)(x), rtol=1e-4)
