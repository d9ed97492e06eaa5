"""Features and splits against pandas, and by the properties they promise."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest

from tradewind.operators.features import (
    FEATURES,
    feature_set,
    holdout_split,
    lag_features,
    time_features,
    walk_forward_folds,
)


def months(count, start=(2011, 6)):
    return [dt.date(start[0] + (start[1] - 1 + n) // 12, (start[1] - 1 + n) % 12 + 1, 1)
            for n in range(count)]


def series_rows(count, key="all", seed=3):
    """A trend with a season, like the monthly totals of a growing shop."""
    chance = np.random.default_rng(seed)
    n = np.arange(count)
    revenue = 200_000 + 8_000 * n + 60_000 * np.sin(2 * np.pi * n / 12) + chance.normal(
        0, 9_000, count)
    return [(key, month, 100 + i, float(value), 900 + i, 80 + i, float(value) / 100)
            for i, (month, value) in enumerate(zip(months(count), revenue, strict=True))]


COLUMNS = ("series_key string, order_month date, total_orders bigint, total_revenue double, "
           "total_qty bigint, unique_customers bigint, avg_order_value double")


@pytest.fixture(scope="session")
def monthly(spark):
    """37 months of one series."""
    return spark.createDataFrame(series_rows(37), COLUMNS)


def test_time_features(monthly):
    rows = time_features(monthly).collect()
    for row in rows:
        assert row.month == row.order_month.month and row.year == row.order_month.year
        assert row.quarter == (row.month - 1) // 3 + 1
        assert math.isclose(row.month_sin, math.sin(2 * math.pi * row.month / 12), abs_tol=1e-12)
        assert math.isclose(row.month_cos, math.cos(2 * math.pi * row.month / 12), abs_tol=1e-12)
        assert math.isclose(row.quarter_sin, math.sin(math.pi * row.quarter / 2), abs_tol=1e-12)
        assert math.isclose(row.quarter_cos, math.cos(math.pi * row.quarter / 2), abs_tol=1e-12)


def test_time_features_parse_text_and_timestamps(spark):
    rows = spark.createDataFrame([("2014-05-01",), ("2013-11-30",)], "day string")
    assert [(r.month, r.quarter, r.year) for r in time_features(rows, "day").collect()] == [
        (5, 2, 2014), (11, 4, 2013)]


def test_lag_features_equal_pandas(monthly):
    found = lag_features(monthly).orderBy("order_month").toPandas()
    target = found["total_revenue"]
    for lag in (1, 2, 3, 6, 12):
        pd.testing.assert_series_equal(found[f"lag_{lag}"], target.shift(lag), check_names=False)
    for size in (3, 6):
        before = target.shift(1).rolling(size)
        pd.testing.assert_series_equal(found[f"rolling_{size}_mean"], before.mean(),
                                       check_names=False)
        pd.testing.assert_series_equal(found[f"rolling_{size}_std"], before.std(),
                                       check_names=False)
    assert found["trend"].tolist() == list(range(37))


def test_lags_are_positional_and_stay_in_their_series(spark):
    rows = [r for r in series_rows(20, "a") if r[1].month != 9] + series_rows(20, "b", seed=8)
    found = lag_features(spark.createDataFrame(rows, COLUMNS)).orderBy(
        "series_key", "order_month").toPandas()
    for _, part in found.groupby("series_key"):
        assert part["lag_1"].tolist()[1:] == part["total_revenue"].tolist()[:-1]
        assert math.isnan(part["lag_1"].iloc[0]) and part["trend"].iloc[0] == 0


def test_own_lags(monthly):
    assert {"lag_4", "lag_5"} <= set(lag_features(monthly, lags=[4, 5]).columns)


def test_feature_set(monthly):
    found = feature_set(monthly).orderBy("order_month").toPandas()
    assert list(found.columns) == ["series_key", "order_month", "total_revenue", *FEATURES]
    assert len(FEATURES) == 17 and len(found) == 25
    assert not found.isna().any().any()
    assert found["trend"].tolist() == list(range(12, 37))


def test_feature_set_keeps_the_series_without_a_name(spark):
    assert feature_set(spark.createDataFrame(series_rows(14, None), COLUMNS)).count() == 2


def test_rows_with_a_missing_value_are_dropped(spark):
    rows = [list(row) for row in series_rows(30)]
    rows[20][2] = None             # a column that is not a feature
    rows[25][3] = float("nan")     # the target, which later rows refer to
    found = feature_set(spark.createDataFrame(rows, COLUMNS))
    assert found.count() == 30 - 12 - 1 - 5


@pytest.mark.parametrize(("count", "train"), [(37, 20), (17, 4), (13, 0)])
def test_holdout_split(spark, count, train):
    rows = holdout_split(feature_set(spark.createDataFrame(series_rows(count), COLUMNS)))
    flags = [row.is_train for row in rows.orderBy("order_month").collect()]
    assert flags == [True] * train + [False] * (count - 12 - train)


def test_walk_forward_bounds(spark):
    rows = spark.createDataFrame(series_rows(20) + series_rows(23, "b"), COLUMNS)
    found = {(r.series_key, r.fold): r for r in walk_forward_folds(rows, 5).collect()}
    month = months(23)
    for fold, start in enumerate((5, 8, 11, 14, 17)):
        row = found["all", fold]
        assert (row.train_rows, row.valid_rows) == (start, 3)
        assert (row.valid_from, row.valid_to) == (month[start], month[start + 2])
    assert [found["b", fold].train_rows for fold in range(5)] == [8, 11, 14, 17, 20]


def test_folds_cover_the_end_without_overlap(spark):
    for count, folds in ((29, 3), (12, 5), (100, 7)):
        rows = spark.createDataFrame(series_rows(count), COLUMNS)
        found = walk_forward_folds(rows, folds).orderBy("fold").collect()
        size = count // (folds + 1)
        assert [row.train_rows for row in found] == [
            count - (folds - fold) * size for fold in range(folds)]
        assert {row.valid_rows for row in found} == {size}
