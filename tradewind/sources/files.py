"""Files of the forecast: a monthly series in, reports and the model out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Types of the monthly columns; others stay text.
MONTHLY_TYPES = {
    "series_key": "string",
    "total_orders": "bigint",
    "total_revenue": "double",
    "total_qty": "bigint",
    "unique_customers": "bigint",
    "avg_order_value": "double",
}
MODEL_FOLDER = "champion_model"


def read_monthly_csv(spark: SparkSession, path: str) -> DataFrame:
    """A monthly series from CSV with a header; names in lower case, types by name.

    ``order_month`` may be a date or a timestamp. Without a ``series_key`` all rows belong to
    the series ``all``.
    """
    raw = spark.read.option("header", True).csv(path)
    rows = raw.toDF(*(name.lower() for name in raw.columns))
    typed = rows.withColumns({
        "order_month": F.to_date(F.to_timestamp("order_month")),
        **{name: F.col(name).cast(kind) for name, kind in MONTHLY_TYPES.items()
           if name in rows.columns}})
    return typed if "series_key" in rows.columns else typed.withColumn("series_key", F.lit("all"))


def file_state(spark: SparkSession, paths: Sequence[str]) -> tuple:
    """Name, size and time of change of every file below the paths, on any file system.

    Two equal states mean that nothing was written in between.
    """
    found = []
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
        while files.hasNext():
            file = files.next()
            found.append((file.getPath().toString(), file.getLen(), file.getModificationTime()))
    return tuple(sorted(found))


def _write_csv(frame: DataFrame, path: str) -> None:
    frame.write.mode("overwrite").option("header", True).csv(path)


def save_artifacts(folder: str, model: PipelineModel, metrics: DataFrame, forecast: DataFrame,
                   importance: DataFrame | None = None) -> None:
    """Write the model and its reports below ``folder``; importance only if there is any."""
    base = folder.rstrip("/")
    model.write().overwrite().save(f"{base}/{MODEL_FOLDER}")
    _write_csv(metrics, f"{base}/model_metrics.csv")
    _write_csv(forecast, f"{base}/forecast.csv")
    if importance is not None:
        _write_csv(importance, f"{base}/feature_importance.csv")


def load_champion_model(spark: SparkSession, folder: str) -> PipelineModel:
    """The model saved by :func:`save_artifacts`; ``FileNotFoundError`` if there is none."""
    location = f"{folder.rstrip('/')}/{MODEL_FOLDER}"
    try:
        spark.read.text(f"{location}/metadata").limit(1).count()
    except AnalysisException as missing:
        raise FileNotFoundError(f"no model at {location}; run the forecast first") from missing
    return PipelineModel.load(location)
