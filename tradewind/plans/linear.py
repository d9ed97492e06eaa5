"""Linear models of many series at once, from sums of products.

The least-squares solution of a group of rows needs its count, sums and sums of products only. One
aggregation takes them for every series and every stretch between two folds; a fold's sums are those
of the stretches before it. The normal equations, 17 by 17, are then solved where they are, by
elimination in array functions, so that any number of series and folds is fitted in one job, and a
forecast of any number of steps is one expression: no model is called and nothing is written in
between.

Values are taken relative to their group's mean before they are multiplied, which keeps the sums of
products accurate. Features are standardised with the population deviation; one that doesn't vary
has no weight.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.operators.features import (
    FEATURES,
    LAGS,
    ROLLING,
    TARGET,
    fold_size,
    fold_start,
    time_columns,
)
from tradewind.operators.metrics import regression_metrics
from tradewind.plans.models import PREDICTION, VANISHING_PENALTY, ModelSettings, split_rows

SIZE = len(FEATURES)
# A deviation below this part of the values' size is rounding.
NO_DEVIATION = 1e-7


@dataclass(frozen=True)
class Penalty:
    """A linear candidate: ``fixed + per_row * rows`` penalises standardised weights."""

    model: str
    fixed: float = 0.0
    per_row: float = 0.0


def linear_candidates(settings: ModelSettings | None = None) -> tuple[Penalty, ...]:
    """The linear candidates, in the order that breaks ties."""
    return (Penalty("LinearRegression (baseline)", per_row=VANISHING_PENALTY),
            Penalty("Ridge", fixed=(settings or ModelSettings()).ridge_alpha))


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    condition = F.lit(True)
    for a, b in zip(left, right, strict=True):
        condition = condition & F.col(a).eqNullSafe(F.col(b))
    return condition


def _joined(rows: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on keys that may be NULL."""
    names = [f"_{key}" for key in keys]
    return rows.join(other.withColumnsRenamed(dict(zip(keys, names, strict=True))),
                     _same(keys, names)).drop(*names)


def _values(target: bool = True) -> Column:
    return F.array(*(F.col(name).cast("double")
                     for name in (*FEATURES, *([TARGET] if target else []))))


def sums_of_products(rows: DataFrame, keys: Sequence[str], first: Column | None = None,
                     groups: int = 1) -> DataFrame:
    """(keys, part, shift, sums) of each group: sums of products of (1, features, target), the
    values less ``shift``, row by row.

    With ``first``, the earliest of ``groups`` parts that a row belongs to, a group's part holds
    all rows of it and of the parts before.
    """
    keys = list(keys)
    means = rows.groupBy(*keys).agg(F.array(*(
        F.avg(F.col(name).cast("double")) for name in (*FEATURES, TARGET))).alias("shift"))
    part = F.lit(0) if first is None else first
    less = F.zip_with(_values(), "shift", lambda value, mean: value - mean)
    products = F.flatten(F.transform("_row", lambda a: F.transform("_row", lambda b: a * b)))
    sums = (_joined(rows.withColumn("part", part), means, keys)
            .withColumn("_row", F.concat(F.array(F.lit(1.0)), less))
            .select(*keys, "part", "shift", F.posexplode(products).alias("place", "value"))
            .groupBy(*keys, "part", "shift", "place").agg(F.sum("value").alias("value")))
    if first is not None:
        sums = (sums.withColumn("part", F.explode(F.sequence(F.col("part"), F.lit(groups - 1))))
                .groupBy(*keys, "part", "shift", "place").agg(F.sum("value").alias("value")))
    return sums.groupBy(*keys, "part", "shift").agg(F.transform(
        F.sort_array(F.collect_list(F.struct("place", "value"))), lambda e: e["value"])
        .alias("sums"))


def _eliminated(matrix: Column) -> Column:
    """A symmetric positive definite matrix with a last column, reduced to that column's solution."""
    def step(rows: Column, k: Column) -> Column:
        pivot = F.get(rows, k)
        return F.transform(rows, lambda row, i: F.when(
            i == k, F.transform(row, lambda value: value / F.get(pivot, k))).otherwise(
            F.zip_with(row, pivot, lambda value, other: value - F.get(row, k) * other
                       / F.get(pivot, k))))

    solved = F.aggregate(F.sequence(F.lit(0), F.lit(SIZE - 1)), matrix, step)
    return F.transform(solved, lambda row: F.get(row, F.lit(SIZE)))


def solve(sums: DataFrame, candidates: Sequence[Penalty]) -> DataFrame:
    """Add (model, rank, level, centre, weights): a row per group and candidate.

    A prediction is level + sum of weights * (feature - centre).
    """
    width = SIZE + 2

    def entry(i: int | Column, j: int | Column) -> Column:
        return F.get("sums", (F.lit(i) if isinstance(i, int) else i) * width + j)

    count = F.col("_count")
    mean = F.transform(F.sequence(F.lit(1), F.lit(SIZE + 1)), lambda i: entry(0, i) / count)
    places = F.sequence(F.lit(0), F.lit(SIZE - 1))

    def covariance(i: Column, j: Column) -> Column:
        return entry(i + 1, j + 1) / count - F.get("_mean", i) * F.get("_mean", j)

    def deviation(i: Column) -> Column:
        size = entry(i + 1, i + 1) / count
        found = F.sqrt(F.greatest(covariance(i, i), F.lit(0.0)))
        return F.when(found > NO_DEVIATION * F.sqrt(size), found)

    measured = (sums.withColumn("_count", entry(0, 0)).withColumn("_mean", mean)
                .withColumn("_deviation", F.transform(places, deviation)))
    options = F.array(*(F.struct(
        F.lit(one.model).alias("model"), F.lit(rank).alias("rank"),
        (F.lit(one.fixed) + F.lit(one.per_row) * count).alias("penalty"))
        for rank, one in enumerate(candidates)))
    chosen = measured.withColumn("_option", F.explode(options))

    def scaled(i: Column, j: Column) -> Column:
        product = count * covariance(i, j) / (F.get("_deviation", i) * F.get("_deviation", j))
        return F.coalesce(product, F.lit(0.0)) + F.when(i == j, F.col("_option.penalty")).otherwise(
            0.0)

    matrix = F.transform(places, lambda i: F.array_append(
        F.transform(places, lambda j: scaled(i, j)),
        F.coalesce(count * covariance(i, F.lit(SIZE)) / F.get("_deviation", i), F.lit(0.0))))
    weights = F.transform(_eliminated(F.col("_matrix")), lambda w, i: F.coalesce(
        w / F.get("_deviation", i), F.lit(0.0)))
    centre = F.zip_with(F.slice("shift", 1, SIZE), F.slice("_mean", 1, SIZE),
                        lambda shift, own: shift + own)
    others = [name for name in sums.columns if name not in ("shift", "sums")]
    return (chosen.withColumn("_matrix", matrix)
            .select(*others, "_option.model", "_option.rank",
                    (F.get("shift", F.lit(SIZE)) + F.get("_mean", F.lit(SIZE))).alias("level"),
                    centre.alias("centre"), weights.alias("weights")))


def prediction(values: Column) -> Column:
    """The prediction of a model in the columns ``level``, ``centre`` and ``weights``."""
    terms = F.zip_with(F.zip_with(values, "centre", lambda x, c: F.coalesce(
        x, F.lit(float("nan"))) - c), "weights", lambda x, w: x * w)
    return F.aggregate(terms, F.col("level"), lambda total, term: total + term)


def _keys(by_series: bool) -> list[str]:
    return ["series_key"] if by_series else []


def _grouped(rows: DataFrame, by_series: bool) -> tuple[DataFrame, list[str]]:
    """One model per series, or one for all: then a column that is the same in every row."""
    return (rows, ["series_key"]) if by_series else (rows.withColumn("_all", F.lit(0)), ["_all"])


def fit(rows: DataFrame, candidates: Sequence[Penalty], by_series: bool = True) -> DataFrame:
    """(series_key if by_series, model, rank, level, centre, weights) fitted on all rows."""
    grouped, keys = _grouped(rows, by_series)
    return solve(sums_of_products(grouped, keys), candidates).drop("part", "_all")


def linear_cv_scores(rows: DataFrame, candidates: Sequence[Penalty], folds: int = 5,
                     by_series: bool = True) -> DataFrame:
    """(series_key if by_series, model, fold, mae) of a walk-forward validation, in one job.

    ``rows`` carry ``position`` and ``length`` within their series. A series with no more rows
    than there are folds has no validation rows and no scores.
    """
    grouped, keys = _grouped(rows, by_series)
    length, position = F.col("length"), F.col("position")
    # Folds train on ever longer beginnings, so a row belongs to all from the first on.
    starts = F.array(*(fold_start(length, fold, folds) for fold in range(folds)))
    first = F.array_position(F.transform(starts, lambda start: position < start),
                             F.lit(True)).cast("int") - 1
    long = fold_size(length, folds) > 0
    training = grouped.where(long).withColumn("_first", first).where("_first >= 0")
    models = solve(sums_of_products(training, keys, F.col("_first"), folds), candidates)
    fold = F.floor((position - F.get(starts, F.lit(0))) / fold_size(length, folds)).cast("int")
    valid = grouped.where(long).withColumn("fold", fold).where(
        (F.col("fold") >= 0) & (F.col("fold") < folds))
    scored = _joined(valid.withColumn("part", F.col("fold")), models, [*keys, "part"])
    return (scored.groupBy(*_keys(by_series), "model", "rank", "fold")
            .agg(F.avg(F.abs(F.col(TARGET) - prediction(_values(target=False)))).alias("mae")))


def linear_holdout(rows: DataFrame, candidates: Sequence[Penalty], test_size: float = 0.2,
                   by_series: bool = True) -> DataFrame:
    """(series_key if by_series, model, rank, mae, rmse, mape, r2) on the held-out rows."""
    train, test = split_rows(rows, test_size)
    keys = _grouped(rows, by_series)[1]
    models = solve(sums_of_products(_grouped(train, by_series)[0], keys), candidates)
    scored = _joined(_grouped(test, by_series)[0], models, keys).withColumn(
        PREDICTION, prediction(_values(target=False)))
    return scored.groupBy(*_keys(by_series), "model", "rank").agg(
        *regression_metrics(TARGET, PREDICTION))


def champions(holdout: DataFrame) -> DataFrame:
    """(series_key, model, mae): of each series the model with the lowest held-out error."""
    return holdout.groupBy("series_key").agg(
        F.min_by("model", F.struct("mae", "rank")).alias("model"), F.min("mae").alias("mae"))


def champion_models(rows: DataFrame, candidates: Sequence[Penalty],
                    test_size: float = 0.2) -> DataFrame:
    """The champion of each series, fitted on all its rows."""
    best = champions(linear_holdout(rows, candidates, test_size)).drop("mae")
    return _joined(fit(rows, candidates), best, ["series_key", "model"])


# --- recursive forecasts --------------------------------------------------------------

def _last(values: Column, count: int) -> Column:
    return F.slice(values, F.greatest(F.size(values) - (count - 1), F.lit(1)), F.lit(count))


def _mean(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, v: total + v) / F.size(values)


def _deviation(values: Column) -> Column:
    mean = _mean(values)
    squares = F.aggregate(values, F.lit(0.0), lambda total, v: total + (v - mean) * (v - mean))
    return F.when(F.size(values) > 1, F.sqrt(squares / (F.size(values) - 1))).otherwise(0.0)


def _next_values(history: Column, month: Column, trend: Column) -> Column:
    """The features of the month after ``history``, in the order of FEATURES."""
    found = {**time_columns(month), "trend": trend}
    found |= {f"lag_{lag}": F.try_element_at(history, F.lit(-lag)) for lag in LAGS}
    found |= {f"rolling_{size}_mean": _mean(_last(history, size)) for size in ROLLING}
    found |= {f"rolling_{size}_std": _deviation(_last(history, size)) for size in ROLLING}
    return F.array(*(found[name].cast("double") for name in FEATURES))


def linear_forecast(models: DataFrame, known: DataFrame, horizon: int = 6,
                    trend_mode: str = "continued") -> DataFrame:
    """(series_key, order_month, predicted_revenue) for the next ``horizon`` months.

    ``models`` has a row per series, or one row without ``series_key`` for all of them; ``known``
    is the feature set. Each prediction, not below zero, becomes part of the history that the next
    one reads, all inside one expression over the last twelve values of a series. A lag that a
    short series does not have makes the prediction missing (NaN).
    """
    if trend_mode not in ("continued", "restarted"):
        raise ValueError("trend_mode must be 'continued' or 'restarted'")
    series = Window.partitionBy("series_key")
    counted = known.withColumns({
        "_age": F.row_number().over(series.orderBy(F.col("order_month").desc())),
        "_rows": F.count(F.lit(1)).over(series)})
    last_trend = F.max("trend") if trend_mode == "continued" else F.first("_rows") - 1
    entries = F.array_sort(F.collect_list(F.struct("order_month", TARGET)))
    state = (counted.where(F.col("_age") <= max(LAGS)).groupBy("series_key")
             .agg(F.max("order_month").alias("last_month"),
                  last_trend.cast("int").alias("last_trend"),
                  F.transform(entries, lambda e: e[TARGET].cast("double")).alias("history")))
    state, keys = _grouped(state, "series_key" in models.columns)
    if keys == ["_all"]:
        models = models.withColumn("_all", F.lit(0))
    state = _joined(state, models.select(*keys, "level", "centre", "weights"), keys)

    def step(so_far: Column, number: Column) -> Column:
        values = _next_values(so_far["history"], F.add_months("last_month", number),
                              F.col("last_trend") + number)
        value = F.greatest(prediction(values), F.lit(0.0))
        # A struct of one value first, so that the prediction is computed once.
        return F.element_at(F.transform(F.array(value), lambda v: F.struct(
            _last(F.array_append(so_far["history"], v), max(LAGS)).alias("history"),
            F.array_append(so_far["predicted"], v).alias("predicted"))), 1)

    start = F.struct(F.col("history").alias("history"),
                     F.array().cast("array<double>").alias("predicted"))
    found = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), start, step)["predicted"]
    return (state.select("series_key", "last_month", F.posexplode(found).alias("step", "value"))
            .select("series_key", F.add_months("last_month", F.col("step") + 1).alias("order_month"),
                    F.col("value").alias("predicted_revenue")))
