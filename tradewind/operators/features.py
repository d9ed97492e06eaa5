"""Features of monthly series, and the splits used to train and validate on them.

A series is identified by ``series_key`` and has one row per ``order_month``. Windows are
partitioned by series, so a task holds the months of a series at a time, never a whole panel.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TARGET = "total_revenue"
LAGS = (1, 2, 3, 6, 12)
ROLLING = (3, 6)

TIME_FEATURES = (
    "month", "quarter", "year", "month_sin", "month_cos", "quarter_sin", "quarter_cos")
FEATURES = (
    *TIME_FEATURES, "trend", *(f"lag_{lag}" for lag in LAGS),
    *(f"rolling_{size}_mean" for size in ROLLING), *(f"rolling_{size}_std" for size in ROLLING))


def _circle(turn, position: Column, length: int) -> Column:
    """Sine or cosine of a position on a circle, without the rounding dust around 0.

    A column that holds 0 in every row would otherwise be standardised to noise.
    """
    return F.round(turn(F.lit(2 * math.pi) * position / length), 12) + F.lit(0.0)


def time_columns(date: Column) -> dict[str, Column]:
    month, quarter = F.month(date), F.quarter(date)
    return {
        "month": month,
        "quarter": quarter,
        "year": F.year(date),
        "month_sin": _circle(F.sin, month, 12),
        "month_cos": _circle(F.cos, month, 12),
        "quarter_sin": _circle(F.sin, quarter, 4),
        "quarter_cos": _circle(F.cos, quarter, 4),
    }


def time_features(rows: DataFrame, date: str = "order_month") -> DataFrame:
    """Add month, quarter, year and their positions on the yearly circle."""
    dated = rows.withColumn(date, F.to_date(date))
    return dated.withColumns(time_columns(F.col(date)))


def lag_features(rows: DataFrame, target: str = TARGET,
                 lags: Sequence[int] = LAGS) -> DataFrame:
    """Add earlier values, statistics of the preceding rows, and the row's ordinal.

    Lags are counted in rows; a missing month is not filled in. The statistics leave out the
    current row and are NULL until the window is full.
    """
    ordered = Window.partitionBy("series_key").orderBy("order_month")
    added = {f"lag_{lag}": F.lag(target, lag).over(ordered) for lag in lags}
    for size in ROLLING:
        before = ordered.rowsBetween(-size, -1)
        full = F.count(target).over(before) == size
        added[f"rolling_{size}_mean"] = F.when(full, F.avg(target).over(before))
        added[f"rolling_{size}_std"] = F.when(full, F.stddev_samp(target).over(before))
    added["trend"] = F.row_number().over(ordered) - 1
    return rows.withColumns(added)


def feature_set(series: DataFrame, target: str = TARGET) -> DataFrame:
    """Series, month, target and the 17 features, for rows where nothing is missing."""
    values = series.withColumn(target, F.col(target).cast("double"))
    featured = lag_features(time_features(values), target)
    # The key may be NULL: sales without a country are a series as well.
    complete = featured.na.drop("any", subset=[c for c in featured.columns if c != "series_key"])
    return complete.select("series_key", "order_month", target, *FEATURES)


def positions(rows: DataFrame) -> DataFrame:
    """Add ``position`` of a row in its series, from 0, and ``length`` of the series."""
    series = Window.partitionBy("series_key")
    return rows.withColumns({
        "position": F.row_number().over(series.orderBy("order_month")) - 1,
        "length": F.count(F.lit(1)).over(series)})


def train_length(length: Column, test_size: float) -> Column:
    return F.floor(length * F.lit(1 - test_size)).cast("int")


def holdout_split(rows: DataFrame, test_size: float = 0.2) -> DataFrame:
    """Add ``is_train``: the earlier part of each series, the rest being the test part."""
    return positions(rows).withColumn(
        "is_train", F.col("position") < train_length(F.col("length"), test_size))


def fold_start(length: Column, fold: int | Column, folds: int) -> Column:
    """Position of the first validation row; everything before it trains the fold."""
    return length - (F.lit(folds) - fold) * fold_size(length, folds)


def fold_size(length: Column, folds: int) -> Column:
    return F.floor(length / F.lit(folds + 1)).cast("int")


def walk_forward_folds(rows: DataFrame, folds: int = 5) -> DataFrame:
    """The bounds of every expanding fold, per series.

    Columns: ``series_key``, ``fold`` (from 0), ``train_rows``, ``valid_rows``,
    ``valid_from`` and ``valid_to`` (first and last validation month).
    """
    numbered = positions(rows)
    start = fold_start(F.col("length"), F.col("fold"), folds)
    spread = numbered.withColumn(
        "fold", F.explode(F.sequence(F.lit(0), F.lit(folds - 1)))).withColumn("start", start)
    inside = (F.col("position") >= F.col("start")) & (
        F.col("position") < F.col("start") + fold_size(F.col("length"), folds))
    return (spread.groupBy("series_key", "fold")
            .agg(F.count_if(F.col("position") < F.col("start")).alias("train_rows"),
                 F.count_if(inside).alias("valid_rows"),
                 F.min(F.when(inside, F.col("order_month"))).alias("valid_from"),
                 F.max(F.when(inside, F.col("order_month"))).alias("valid_to")))
