"""The warehouse: lazy staging views and marts over a source, and the build of its tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from tradewind.functions.columns import month_start
from tradewind.operators.lineage import shuffles_removed
from tradewind.operators.quality import Observed, observed_report, run_checks
from tradewind.plans.checks import MART_CHECKS, SOURCE_CHECKS
from tradewind.plans.marts import (
    MARTS,
    ROLLUPS,
    TOTALS_COLUMNS,
    fact_rows,
    keyed_fact,
    keyed_totals,
    order_total_rows,
)
from tradewind.plans.staging import STAGING
from tradewind.sources.versions import Versions

# Written tables carry the month of this date, as MONTH. Those in PARTITIONED are laid out by it;
# the calendar has it so that a condition on days prunes their partitions.
DATES = {"fact_sales": "orderdate", "order_totals": "orderdate", "dim_dates": "metric_date"}
MONTH = "order_month"
# The rows of a partitioned table, and what makes its columns from them.
LAYOUTS = {
    "fact_sales": (fact_rows, lambda rows: keyed_fact(rows, MONTH)),
    "order_totals": (lambda tables: order_total_rows(tables, TOTALS_COLUMNS),
                     lambda rows: keyed_totals(rows, TOTALS_COLUMNS, MONTH)),
}
PARTITIONED = tuple(LAYOUTS)


class Warehouse:
    """Staging views and marts by name.

    A mart is read from its table once it is built, and otherwise planned from the staging
    frames. Frames are lazy; nothing runs until one is used. ``keys_checked`` says that the
    declared keys of the source are known to be unique, as after ``check_sources``.
    """

    def __init__(self, spark: SparkSession, source=None,
                 tables: dict[str, DataFrame] | None = None, *, keys_checked: bool = False):
        self.spark = spark
        self.source = source
        self.keys_checked = keys_checked
        self._tables = dict(tables or {})
        self._staged: dict[str, DataFrame] = {}

    @classmethod
    def open(cls, spark: SparkSession, location: str, source=None,
             version: str | None = None) -> Warehouse:
        """A warehouse built earlier: its newest published version, or a named one.

        It keeps to that version, whatever is built later.
        """
        return cls(spark, source, Versions(spark, location).open(version))

    def stg(self, name: str) -> DataFrame:
        schema, table, transform = STAGING[name]
        if self.source is None:
            raise LookupError(f"{name} needs a source; this warehouse only has built tables")
        if name not in self._staged:
            self._staged[name] = transform(self.source.table(schema, table))
        return self._staged[name]

    def mart(self, name: str) -> DataFrame:
        if name in self._tables:
            return self._tables[name].drop(MONTH)
        return (MARTS | ROLLUPS)[name](self)

    def by_month(self, name: str) -> DataFrame:
        """A table of ``DATES`` with the month of its date, which is stored if it is built."""
        if MONTH in getattr(self._tables.get(name), "columns", ()):
            return self._tables[name]
        return self.mart(name).withColumn(MONTH, month_start(DATES[name]))

    def has(self, name: str) -> bool:
        """Whether the mart or rollup is built."""
        return name in self._tables

    def model(self, name: str) -> DataFrame:
        return self.stg(name) if name in STAGING else self.mart(name)

    def register_views(self) -> None:
        """Make staging views and marts available to ``spark.sql`` by name."""
        if self.source is not None:
            for name in STAGING:
                self.stg(name).createOrReplaceTempView(name)
        for name in MARTS:
            self.mart(name).createOrReplaceTempView(name)

    def check_sources(self) -> DataFrame:
        return run_checks(self.model, SOURCE_CHECKS)

    def check_marts(self) -> DataFrame:
        return run_checks(self.model, MART_CHECKS)


class SourceCheckError(RuntimeError):
    """Declared keys of the source tables are missing or repeated."""


@dataclass(frozen=True)
class Build:
    warehouse: Warehouse
    report: DataFrame
    version: str


def _laid_out(name: str, warehouse: Warehouse) -> DataFrame:
    """The mart as it is written; large months make several files, small ones share tasks.

    Partitioned tables are dealt and sorted by month before their keys are made: hashes are the
    larger part of a row and hardly compress.
    """
    if name not in PARTITIONED:
        frame = warehouse.mart(name)
        return frame.withColumn(MONTH, month_start(DATES[name])) if name in DATES else frame
    rows, keyed = LAYOUTS[name]
    dated = rows(warehouse).withColumn(MONTH, month_start(DATES[name]))
    return keyed(dated.hint("rebalance", MONTH).sortWithinPartitions(MONTH, "line_salesorderid"))


def build_warehouse(spark: SparkSession, source, location: str, *,
                    check_sources: bool = True) -> Build:
    """Write every mart as a new version of the tables at ``location``, publish it and check it.

    ``location`` is a folder on shared storage, or ``catalog:<database>``; see
    :class:`Versions`. The source keys are checked first, because the marts rely on them: repeated
    or missing keys stop the build. The dimensions and the aggregate do not depend on each other
    and are written side by side. The rollup per order follows and reads the written reasons, then
    ``fact_sales``, which reads that rollup, then the rollups per product and of customers. NULLs are counted while
    the tables are written. Until all are, readers see the version before; a build that fails
    leaves it in place and removes what it has written. Shuffle files of a write go when it ends.

    ``report`` holds the checks on the written tables; a failing one does not undo the build.
    """
    warehouse = Warehouse(spark, source)
    if check_sources:
        with shuffles_removed(spark):
            failed = warehouse.check_sources().where("not passed").collect()
        if failed:
            names = ", ".join(f"{row.model}.{row.column_name} ({row.test})" for row in failed)
            raise SourceCheckError(f"source checks failed: {names}")
        warehouse.keys_checked = True
    versions = Versions(spark, location)
    version = versions.new()
    observed: dict[str, Observed] = {}

    def write(name: str) -> DataFrame:
        frame = _laid_out(name, warehouse)
        checks = MART_CHECKS.get(name)
        if checks and checks.not_null:
            observed[name] = Observed(frame, checks.not_null)
            frame = observed[name].frame
        versions.write(frame, version, name, MONTH if name in PARTITIONED else None)
        return versions.read(version, name, frame.schema)

    try:
        independent = [name for name in MARTS if name != "fact_sales"]
        with shuffles_removed(spark):
            with ThreadPoolExecutor(max_workers=4) as pool:
                frames = list(pool.map(inheritable_thread_target(spark)(write), independent))
            written = dict(zip(independent, frames, strict=True))
            for name in ("order_totals", "fact_sales", "product_totals", "customer_bitmaps"):
                warehouse = Warehouse(spark, source, written, keys_checked=check_sources)
                written[name] = write(name)
        versions.publish(version, {name: frame.schema for name, frame in written.items()})
    except BaseException:
        versions.discard(version, [*MARTS, *ROLLUPS])
        raise
    warehouse = Warehouse(spark, source, written, keys_checked=check_sources)
    others = {name: checks.only("unique", "references") for name, checks in MART_CHECKS.items()}
    report = observed_report(spark, observed).unionByName(
        run_checks(warehouse.model, others, written=True))
    return Build(warehouse, report, version)


def run_query(spark: SparkSession, sql: str) -> DataFrame:
    """Run SQL over the registered views; column names come back in lower case."""
    result = spark.sql(sql)
    return result.toDF(*(column.lower() for column in result.columns))
