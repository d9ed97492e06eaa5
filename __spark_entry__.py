"""Registry of the queries and of the SQL they are compared with."""

from __future__ import annotations

import sys
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from pathlib import Path
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from oracle import sql as oracle  # noqa: E402
from tradewind.functions.columns import money, plain_double  # noqa: E402
from tradewind.operators import features, metrics, quality  # noqa: E402
from tradewind.operators.lineage import checkpoint_folder, written  # noqa: E402
from tradewind.plans import linear, models  # noqa: E402
from tradewind.plans.checks import MART_CHECKS, SOURCE_CHECKS  # noqa: E402
from tradewind.plans.customers import CUSTOMER_REPORTS  # noqa: E402
from tradewind.plans.forecast import DemandForecast, forecast  # noqa: E402
from tradewind.plans.marts import MARTS  # noqa: E402
from tradewind.plans.reports import (  # noqa: E402
    REPORTS,
    calendar_revenue,
    monthly_revenue,
    quarterly_revenue,
    top_products,
)
from tradewind.plans.sales import monthly_sales  # noqa: E402
from tradewind.plans.staging import STAGING  # noqa: E402
from tradewind.plans.warehouse import Warehouse, build_warehouse, run_query  # noqa: E402
from tradewind.sources.feed import OrdersFeed  # noqa: E402
from tradewind.sources.files import (  # noqa: E402
    file_state,
    load_champion_model,
    read_monthly_csv,
    save_artifacts,
)

# The operators for training data are an optional part: without their folder, and the pipeline
# made of them, everything else works.
try:
    import tradewind.llm.queries as llm  # noqa: E402
    import corpus_pipeline  # noqa: E402
except ModuleNotFoundError as missing:
    if missing.name not in {"corpus_pipeline", "tradewind.llm", "tradewind.llm.queries"}:
        raise
    llm = corpus_pipeline = None

Query = Callable[[SparkSession, str], DataFrame]

FEED_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def _warehouse(spark: SparkSession, folder: str) -> Warehouse:
    return Warehouse(spark, OrdersFeed(spark, folder))


def _model(name: str) -> Query:
    return lambda spark, folder: _warehouse(spark, folder).model(name)


def _report(report: Callable[[Warehouse], DataFrame]) -> Query:
    return lambda spark, folder: report(_warehouse(spark, folder))


def _checks(*kinds: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        spec = {name: checks.only(*kinds)
                for name, checks in (SOURCE_CHECKS | MART_CHECKS).items()}
        return quality.run_checks(_warehouse(spark, folder).model, spec)
    return run


def _build_and_check(spark: SparkSession, folder: str) -> DataFrame:
    """Check the sources, write the warehouse to the shared folder, check what was written."""
    location = f"{checkpoint_folder(spark)}/warehouse-{uuid4().hex}"
    build = build_warehouse(spark, OrdersFeed(spark, folder), location)
    return build.warehouse.check_sources().unionByName(build.report)


# --- monthly series and features, rounded so that engines can be compared --------------

def _monthly(series: str | None = None) -> Callable[[Warehouse], DataFrame]:
    return lambda warehouse: monthly_sales(warehouse, series).withColumn(
        "total_revenue", money(F.col("total_revenue")))


def _rounded(rows: DataFrame) -> DataFrame:
    digits = {name: 4 for name in features.FEATURES if name.startswith("rolling")}
    digits |= {name: 6 for name in features.TIME_FEATURES if name.endswith(("sin", "cos"))}
    return rows.withColumns({name: plain_double(F.col(name), places)
                             for name, places in digits.items() if name in rows.columns})


def _time_features(warehouse: Warehouse) -> DataFrame:
    rows = features.time_features(monthly_sales(warehouse, customers=False))
    return _rounded(rows.select("series_key", "order_month", *features.TIME_FEATURES))


def _lag_features(warehouse: Warehouse) -> DataFrame:
    series = monthly_sales(warehouse, customers=False)
    rows = features.lag_features(
        series.withColumn("total_revenue", F.col("total_revenue").cast("double")))
    names = [name for name in features.FEATURES if name not in features.TIME_FEATURES]
    return _rounded(rows.select(
        "series_key", "order_month", money(F.col("total_revenue")).alias("total_revenue"),
        *names))


def _features(warehouse: Warehouse) -> DataFrame:
    return features.feature_set(monthly_sales(warehouse, customers=False))


def _feature_set(warehouse: Warehouse) -> DataFrame:
    return _rounded(_features(warehouse)).withColumn(
        "total_revenue", plain_double(F.col("total_revenue"), 4))


def _split(warehouse: Warehouse) -> DataFrame:
    return features.holdout_split(_features(warehouse))


def _folds(warehouse: Warehouse) -> DataFrame:
    return features.walk_forward_folds(_split(warehouse).where("is_train"))


def _lag1_metrics(warehouse: Warehouse) -> DataFrame:
    measured = _split(warehouse).where("not is_train").agg(
        *metrics.regression_metrics("total_revenue", "lag_1"))
    return measured.select(plain_double(F.col("mae"), 4).alias("mae"),
                           plain_double(F.col("rmse"), 4).alias("rmse"),
                           plain_double(F.col("mape"), 6).alias("mape"),
                           plain_double(F.col("r2"), 6).alias("r2"))


# --- panels: the same per country and per category -----------------------------------------

PANELS = {"by_country": "countryregion_name", "by_category": "productcategory_name"}


def _panel_features(series: str) -> Callable[[Warehouse], DataFrame]:
    return lambda warehouse: features.feature_set(
        monthly_sales(warehouse, series, customers=False))


def _panel_split(series: str) -> Callable[[Warehouse], DataFrame]:
    return lambda warehouse: features.holdout_split(_panel_features(series)(warehouse))


def _panel_metrics(series: str) -> Callable[[Warehouse], DataFrame]:
    """Errors of last month's revenue as the prediction, for each series on its own."""
    def run(warehouse: Warehouse) -> DataFrame:
        measured = _panel_split(series)(warehouse).where("not is_train").groupBy(
            "series_key").agg(*metrics.regression_metrics("total_revenue", "lag_1"))
        return measured.select("series_key", *(plain_double(F.col(name), digits).alias(name)
                                               for name, digits in (("mae", 4), ("rmse", 4),
                                                                    ("mape", 6), ("r2", 6))))
    return run


def _panel_queries() -> dict[str, Callable[[Warehouse], DataFrame]]:
    found = {}
    for suffix, series in PANELS.items():
        found[f"feature_set_{suffix}"] = lambda w, s=series: _rounded(
            _panel_features(s)(w)).withColumn(
                "total_revenue", plain_double(F.col("total_revenue"), 4))
        found[f"holdout_split_{suffix}"] = lambda w, s=series: _panel_split(s)(w).select(
            "series_key", "order_month", "is_train")
        found[f"walk_forward_folds_{suffix}"] = lambda w, s=series: features.walk_forward_folds(
            _panel_split(s)(w).where("is_train"))
        found[f"holdout_metrics_lag1_{suffix}"] = _panel_metrics(series)
    return found


# --- models ---------------------------------------------------------------------------

@dataclass(frozen=True)
class TrainingRun:
    """The feature rows of a warehouse and the comparison of the candidates on them."""

    rows: DataFrame
    training: models.Training


# One run per session, folder and state of its files serves the five queries that read it: a run
# is hundreds of fits. The newest run of a folder is kept.
_RUNS: dict[tuple[str, str], tuple[tuple, TrainingRun]] = {}


def forget_training_runs() -> None:
    """The next query that needs a training run makes a new one."""
    _RUNS.clear()


def _train(spark: SparkSession, folder: str) -> TrainingRun:
    rows = DemandForecast.from_warehouse(_warehouse(spark, folder)).features()
    return TrainingRun(rows, models.train_and_evaluate(rows, models.candidate_models()))


def _trained(read: Callable[[TrainingRun], DataFrame]) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, folder)
        state = file_state(spark, [f"{folder}/{table}.parquet" for table in FEED_TABLES])
        if key not in _RUNS or _RUNS[key][0] != state:
            _RUNS[key] = (state, _train(spark, folder))
        return read(_RUNS[key][1])
    return query


def _importance(run: TrainingRun) -> DataFrame:
    def importance(name: str) -> DataFrame:
        own = run.training.champion == name
        fitted = run.training.model if own else models.candidate_models()[name](run.rows)
        return models.feature_importance(fitted).withColumn("model", F.lit(name))
    return reduce(DataFrame.unionByName, map(importance, models.TREE_MODELS))


TRAINED = {
    "cv_scores": lambda run: run.training.scores,
    "model_metrics": lambda run: metrics.metrics_report(run.training.holdout,
                                                        run.training.scores),
    "champion": lambda run: models.champion(run.training.holdout),
    "feature_importance": _importance,
    "forecast": lambda run: forecast(run.training.model, run.rows),
}


# --- files and SQL ----------------------------------------------------------------------

def _scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_folder(spark)}/{name}-{uuid4().hex}"


def _csv_series(warehouse: Warehouse) -> DataFrame:
    """The monthly series written as CSV and read back."""
    folder = _scratch(warehouse.spark, "monthly")
    _monthly()(warehouse).write.option("header", True).csv(folder)
    read = read_monthly_csv(warehouse.spark, folder)
    return read.withColumns({"total_revenue": plain_double(F.col("total_revenue"), 2),
                             "avg_order_value": plain_double(F.col("avg_order_value"), 4)})


def _save_ridge(warehouse: Warehouse) -> tuple[str, DataFrame]:
    """A folder with a ridge model, its metrics and fitted values, and the rows it was fitted on."""
    folder = _scratch(warehouse.spark, "artifacts")
    rows = _written_split(warehouse, None)
    model = models.candidate_models()["Ridge"](rows)
    train, _ = models.split_rows(rows)
    report = metrics.metrics_report(linear.linear_holdout(rows, RIDGE, by_series=False),
                                    linear.linear_cv_scores(train, RIDGE, by_series=False))
    fitted = model.transform(rows).select("series_key", "order_month", "prediction")
    save_artifacts(folder, model, report, fitted)
    return folder, rows


def _saved_model(warehouse: Warehouse) -> DataFrame:
    """Predictions of a model that was saved with its reports and loaded again."""
    folder, rows = _save_ridge(warehouse)
    loaded = load_champion_model(warehouse.spark, folder).transform(rows)
    return loaded.select("series_key", "order_month",
                         plain_double(F.col("prediction"), 2).alias("prediction"))


def _saved_metrics(warehouse: Warehouse) -> DataFrame:
    """The metrics that were saved with a model, read back."""
    folder, _ = _save_ridge(warehouse)
    names = ("mae", "rmse", "mape", "r2", "cv_mae_mean", "cv_mae_std")
    report = (warehouse.spark.read.option("header", True)
              .schema("model string, " + ", ".join(f"{name} double" for name in names))
              .csv(f"{folder}/model_metrics.csv"))
    # Two digits, as saved; sums of squares of whole currency amounts leave no more certain.
    return report.select("model", *(plain_double(F.col(name), 2).alias(name) for name in names))


# --- linear models of all series at once --------------------------------------------------

RIDGE = linear.linear_candidates()[1:]


def _written_split(warehouse: Warehouse, series: str | None) -> DataFrame:
    """The split rows, which a fit and what it predicts both read."""
    return written(features.holdout_split(features.feature_set(
        monthly_sales(warehouse, series, customers=False))))


def _whole(rows: DataFrame, *names: str) -> DataFrame:
    return rows.withColumns({name: plain_double(F.col(name), 0) for name in names})


def _ridge_cv(warehouse: Warehouse, series: str | None) -> DataFrame:
    train, _ = models.split_rows(_written_split(warehouse, series))
    scores = linear.linear_cv_scores(train, RIDGE)
    return _whole(scores.select("series_key", "fold", "mae"), "mae")


def _ridge_forecast(warehouse: Warehouse, series: str | None) -> DataFrame:
    rows = _written_split(warehouse, series)
    return _whole(linear.linear_forecast(linear.fit(rows, RIDGE), rows), "predicted_revenue")


def _linear_champion(warehouse: Warehouse, series: str | None) -> DataFrame:
    holdout = linear.linear_holdout(_written_split(warehouse, series),
                                    linear.linear_candidates())
    return linear.champions(holdout).select("series_key", "model")


def _champion_forecast(warehouse: Warehouse, series: str | None) -> DataFrame:
    rows = _written_split(warehouse, series)
    best = linear.champion_models(rows, linear.linear_candidates())
    return linear.linear_forecast(best, rows)


LINEAR = {
    f"{name}{suffix}": lambda warehouse, query=query, series=series: query(warehouse, series)
    for name, query in (("ridge_cv_scores", _ridge_cv), ("ridge_forecast", _ridge_forecast),
                        ("linear_champion", _linear_champion),
                        ("champion_forecast", _champion_forecast))
    for suffix, series in {"": None, **{f"_{name}": of for name, of in PANELS.items()}}.items()
}


DUE_BY_COUNTRY = """
    SELECT countryregion_name, COUNT(*) AS LINE_COUNT, COUNT(DISTINCT salesorderid) AS ORDER_COUNT
    FROM fact_sales GROUP BY countryregion_name"""


def _sql_query(warehouse: Warehouse) -> DataFrame:
    """A query in SQL over the registered views."""
    warehouse.register_views()
    return run_query(warehouse.spark, DUE_BY_COUNTRY)


def _ranked(report: str, by: str, *ties: str) -> Callable[[Warehouse], DataFrame]:
    """A report with the place of each row in ascending order, as a chart shows it."""
    return lambda warehouse: REPORTS[report](warehouse).withColumn(  # a report has a few rows
        "place", F.row_number().over(Window.orderBy(by, *ties)))


def _second_half(report: Callable[..., DataFrame], *options) -> Callable[[Warehouse], DataFrame]:
    """A report on the second halves of years, by the calendar's columns."""
    return lambda warehouse: report(warehouse, *options, days=F.col("semester") == 2)


EXTRAS = {
    "monthly_revenue_second_half": _second_half(monthly_revenue),
    "quarterly_revenue_second_half": _second_half(quarterly_revenue),
    "calendar_revenue_second_half": _second_half(calendar_revenue),
    "csv_series": _csv_series,
    "saved_model": _saved_model,
    "saved_metrics": _saved_metrics,
    "sql_query": _sql_query,
    "top_products_ascending": _ranked("top_products", "total_revenue", "product_name"),
    "revenue_by_country_ascending": _ranked("revenue_by_country", "total_revenue", "country"),
}


FORECAST = {
    "monthly_sales": _monthly(),
    "monthly_sales_by_country": _monthly("countryregion_name"),
    "monthly_sales_by_category": _monthly("productcategory_name"),
    "time_features": _time_features,
    "lag_features": _lag_features,
    "feature_set": _feature_set,
    "holdout_split": lambda warehouse: _split(warehouse).select(
        "series_key", "order_month", "is_train"),
    "walk_forward_folds": _folds,
    "holdout_metrics_lag1": _lag1_metrics,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: the ten best-selling products."""
    return top_products(_warehouse(spark, "/root/testdata/sf0.001"))


def core_queries() -> dict[str, Query]:
    """The queries that need no optional part."""
    return {
        **{name: _model(name) for name in (*STAGING, *MARTS)},
        **{name: _report(report) for name, report in (
            REPORTS | CUSTOMER_REPORTS | FORECAST | _panel_queries() | EXTRAS | LINEAR).items()},
        **{name: _trained(read) for name, read in TRAINED.items()},
        "dq_unique": _checks("unique"),
        "dq_not_null": _checks("not_null"),
        "dq_relationships": _checks("references"),
        "dq_report": _build_and_check,
    }


def queries() -> dict[str, Query]:
    if llm is None:
        return core_queries()
    return {**core_queries(), **llm.queries(),
            "pipeline": lambda spark, folder: corpus_pipeline.run(spark, folder)}


def oracle_sql() -> dict[str, str]:
    if llm is None:
        return oracle.oracle_sql()
    return {**oracle.oracle_sql(), **llm.oracle_sql()}
