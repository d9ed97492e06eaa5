"""Sales warehouse, business reports and demand forecasting on PySpark."""

from tradewind.plans.forecast import DemandForecast, ForecastResult
from tradewind.plans.warehouse import Warehouse, build_warehouse, run_query

__all__ = ["DemandForecast", "ForecastResult", "Warehouse", "build_warehouse", "run_query"]
