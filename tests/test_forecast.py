"""Recursive forecasts against a plain loop, and the run from series to artifacts."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from conftest import SMALL, rows_of
from test_features import COLUMNS, months, series_rows
from tradewind import DemandForecast, Warehouse, build_warehouse
from tradewind.operators.features import FEATURES, TARGET, feature_set, holdout_split
from tradewind.plans.forecast import forecast
from tradewind.plans.models import ModelSettings, candidate_models
from tradewind.sources.feed import OrdersFeed
from tradewind.sources.files import load_champion_model, read_monthly_csv, save_artifacts

QUICK = ModelSettings(forest_trees=10, boosting_rounds=3)


def expected_forecast(predict, known, horizon, first_trend):
    """One series, step by step in plain Python. ``known`` is a pandas feature set."""
    history = list(known[TARGET])
    last = known["order_month"].max()
    found = []
    for step in range(1, horizon + 1):
        number = last.year * 12 + last.month - 1 + step
        year, month = divmod(number, 12)
        month += 1
        quarter = (month - 1) // 3 + 1
        row = {"month": month, "quarter": quarter, "year": year,
               "month_sin": math.sin(2 * math.pi * month / 12),
               "month_cos": math.cos(2 * math.pi * month / 12),
               "quarter_sin": math.sin(2 * math.pi * quarter / 4),
               "quarter_cos": math.cos(2 * math.pi * quarter / 4),
               "trend": first_trend + step - 1}
        for lag in (1, 2, 3, 6, 12):
            row[f"lag_{lag}"] = history[-lag] if len(history) >= lag else math.nan
        for size in (3, 6):
            window = history[-size:]
            row[f"rolling_{size}_mean"] = float(np.mean(window))
            row[f"rolling_{size}_std"] = (float(np.std(window, ddof=1))
                                          if len(window) > 1 else 0.0)
        value = max(predict([row[name] for name in FEATURES]), 0.0)
        history.append(value)
        found.append((dt.date(year, month, 1), value))
    return found


def linear_predictor(model):
    scaler, line = model.stages[-2], model.stages[-1]
    mean, scale = scaler.mean.toArray(), scaler.std.toArray()

    def predict(values):
        with np.errstate(divide="ignore", invalid="ignore"):
            z = np.where(scale > 0, (np.array(values) - mean) / scale, 0.0)
        return float(z @ line.coefficients.toArray() + line.intercept)
    return predict


@pytest.fixture(scope="module")
def panel(spark):
    """Three series of different length; the last has five complete rows."""
    rows = series_rows(37, "a") + series_rows(30, "b", seed=9) + series_rows(17, None, seed=4)
    return feature_set(spark.createDataFrame(rows, COLUMNS)).cache()


@pytest.fixture(scope="module")
def ridge(panel):
    return candidate_models()["Ridge"](panel)


@pytest.mark.parametrize("mode", ["continued", "restarted"])
def test_equals_plain_loop(panel, ridge, mode):
    found = forecast(ridge, panel, 8, mode).collect()
    data = panel.orderBy("order_month").toPandas()
    assert len(found) == 24
    for key in ("a", "b"):
        known = data[data["series_key"] == key]
        first = int(known["trend"].max()) + 1 if mode == "continued" else len(known)
        expected = expected_forecast(linear_predictor(ridge), known, 8, first)
        rows = sorted((r.order_month, r.predicted_revenue) for r in found if r.series_key == key)
        assert [month for month, _ in rows] == [month for month, _ in expected]
        np.testing.assert_allclose([v for _, v in rows], [v for _, v in expected], rtol=1e-9)


def test_short_series_has_no_value_until_its_lags_exist(panel, ridge):
    rows = [r for r in forecast(ridge, panel, 3).collect() if r.series_key is None]
    assert len(rows) == 3 and all(math.isnan(row.predicted_revenue) for row in rows)


def test_trees_forecast_short_series_too(panel):
    model = candidate_models(QUICK)["RandomForest"](panel)
    rows = forecast(model, panel, 2).collect()
    assert len(rows) == 6 and all(row.predicted_revenue > 0 for row in rows)


def test_never_below_zero(spark):
    falling = [(key, month, n, max(4e5 - 1.2e4 * i, 1.0), q, c, a)
               for i, (key, month, n, _, q, c, a) in enumerate(series_rows(37))]
    known = feature_set(spark.createDataFrame(falling, COLUMNS))
    model = candidate_models()["LinearRegression (baseline)"](known)
    values = [r.predicted_revenue for r in forecast(model, known, 6).collect()]
    assert len(values) == 6 and all(value >= 0 for value in values)


def test_unknown_trend_mode(panel, ridge):
    with pytest.raises(ValueError, match="trend_mode"):
        forecast(ridge, panel, 2, "other")


@pytest.fixture(scope="module")
def result(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("artifacts")
    run = DemandForecast(spark.createDataFrame(series_rows(37), COLUMNS), horizon=4, folds=3,
                         settings=QUICK)
    return run.run(save_to=str(folder)), folder


def test_run(result):
    outcome, _ = result
    metrics = outcome.metrics.collect()
    assert [row.model for row in metrics][0] == outcome.champion
    assert {row.model for row in metrics} == set(candidate_models())
    assert all(row["MAE"] >= 0 for row in metrics)
    assert metrics[0]["R²"] > 0
    rows = outcome.forecast.orderBy("order_month").collect()
    assert [row.order_month for row in rows] == months(41)[-4:]
    assert (outcome.importance is None) == (outcome.champion not in (
        "RandomForest", "GradientBoosting"))


def test_saved_artifacts(spark, result, panel):
    outcome, folder = result
    csv = spark.read.option("header", True).csv
    assert csv(str(folder / "model_metrics.csv")).columns == outcome.metrics.columns
    assert csv(str(folder / "forecast.csv")).count() == 4
    assert (folder / "feature_importance.csv").exists() == (outcome.importance is not None)
    model = load_champion_model(spark, str(folder))
    assert isinstance(model, PipelineModel)
    rows = panel.where("series_key = 'a'")
    assert (model.transform(rows).agg({"prediction": "sum"}).first()[0]
            == pytest.approx(outcome.model.transform(rows).agg({"prediction": "sum"}).first()[0]))


def test_importance_is_written_only_if_present(spark, ridge, tmp_path):
    frame = spark.createDataFrame([("lag_1", 0.5)], "feature string, importance double")
    save_artifacts(str(tmp_path / "with"), ridge, frame, frame, frame)
    save_artifacts(str(tmp_path / "without"), ridge, frame, frame, None)
    names = {"champion_model", "model_metrics.csv", "forecast.csv"}
    assert {p.name for p in (tmp_path / "with").iterdir()} == names | {"feature_importance.csv"}
    assert {p.name for p in (tmp_path / "without").iterdir()} == names


def test_missing_model(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_champion_model(spark, str(tmp_path / "nothing"))


def test_csv_source(spark, tmp_path):
    path = tmp_path / "monthly.csv"
    lines = ["ORDER_MONTH,Total_Revenue,TOTAL_ORDERS,total_qty,unique_customers,note"]
    for _, month, orders, revenue, qty, customers, _ in series_rows(37):
        lines.append(f"{month} 00:00:00,{revenue},{orders},{qty},{customers},x")
    path.write_text("\n".join(lines))
    rows = read_monthly_csv(spark, str(path))
    kinds = dict(rows.dtypes)
    assert kinds["order_month"] == "date" and kinds["total_revenue"] == "double"
    assert kinds["total_orders"] == "bigint" and kinds["note"] == "string"
    assert rows.select("series_key").distinct().first().series_key == "all"
    features = DemandForecast.from_csv(spark, str(path)).features()
    assert features.count() == 25 and features.where("is_train").count() == 20


def test_warehouse_source_has_every_month(small):
    run = DemandForecast.from_warehouse(small)
    last = run.series.agg({"order_month": "max"}).first()[0]
    assert last == dt.date(2001, 8, 1)
    assert run.features().count() == 68
    closed = DemandForecast.from_warehouse(small, through=dt.date(2001, 7, 31))
    assert closed.series.agg({"order_month": "max"}).first()[0] == dt.date(2001, 7, 1)
    assert closed.features().count() == 67
    per_country = DemandForecast.from_warehouse(small, "countryregion_name").features()
    assert per_country.select("series_key").distinct().count() == 5


def test_a_late_order_without_lines_changes_nothing(spark, tmp_path):
    class LateOrder(OrdersFeed):
        """The feed with one more order, after all others and without lines."""

        def table(self, schema, name):
            rows = super().table(schema, name)
            if name != "salesorderheader":
                return rows
            late = rows.orderBy("salesorderid").limit(1).withColumns({
                "salesorderid": F.lit(-1).cast(rows.schema["salesorderid"].dataType),
                "orderdate": F.lit(dt.date(2003, 9, 5)).cast(
                    rows.schema["orderdate"].dataType)})
            return rows.unionByName(late)

    feed = LateOrder(spark, SMALL)
    build_warehouse(spark, feed, str(tmp_path))
    lazy = DemandForecast.from_warehouse(Warehouse(spark, feed)).features()
    built = DemandForecast.from_warehouse(Warehouse.open(spark, str(tmp_path))).features()
    assert lazy.agg({"order_month": "max"}).first()[0] == dt.date(2001, 8, 1)
    assert rows_of(lazy) == rows_of(built)


def test_built_warehouse_gives_the_same_features(small, built):
    lazy = DemandForecast.from_warehouse(small, "productcategory_name").features()
    written = DemandForecast.from_warehouse(built, "productcategory_name").features()
    assert rows_of(lazy) == rows_of(written)


def test_split_columns(panel):
    rows = holdout_split(panel)
    assert {"position", "length", "is_train"} <= set(rows.columns)
