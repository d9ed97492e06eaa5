"""Data checks: unique, not null, relationships, and a report over many models.

All checks of one model run in a few passes: one aggregate for every not-null check, and one
count of values for every unique and relationship check. Values are counted before they are
shuffled, so a value that fills a large part of a column stays cheap.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tradewind.functions.columns import packed

# Repeated values of a written table are searched among those whose hash falls into the slot of a
# repeated hash. So many slots are broadcast at most.
SLOTS = 1 << 20


@dataclass(frozen=True)
class Reference:
    """Values of ``column`` must occur in ``parent_column`` of ``parent``."""

    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class Checks:
    """The checks declared for one model."""

    unique: Sequence[str] = ()
    not_null: Sequence[str] = ()
    references: Sequence[Reference] = ()

    def only(self, *kinds: str) -> Checks:
        """The same checks restricted to the named kinds."""
        return Checks(**{kind: getattr(self, kind) for kind in kinds})


def _values(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(place, value) for the non-null values of several columns; place is the column's."""
    if len(columns) == 1:
        values = rows.select(F.lit(0).alias("place"), F.col(columns[0]).alias("value"))
    else:
        entries = F.array(*(F.struct(F.lit(place).alias("place"),
                                     F.col(column).cast("string").alias("value"))
                            for place, column in enumerate(columns)))
        values = rows.select(F.inline(entries))
    return values.where(F.col("value").isNotNull())


def _counted(values: DataFrame, *keys: str) -> DataFrame:
    return values.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def _by_column(failing: DataFrame, columns: Sequence[str],
               failures: Callable[[Column], Column]) -> DataFrame:
    """Failures per column, with a row for columns that have none."""
    totals = failing.agg(*(
        F.coalesce(failures(F.col("place") == place), F.lit(0)).cast("bigint").alias(column)
        for place, column in enumerate(columns)))
    return totals.unpivot([], list(columns), "column_name", "failures")


def unique(rows: DataFrame, columns: Sequence[str], *, written: bool = False) -> DataFrame:
    """(column_name, failures): how many non-null values occur more than once.

    Of ``written`` rows, which are cheap to read twice, only hashes are shuffled first: a value
    whose hash occurs once does so itself. The others are counted, with what shares their slots.
    """
    values = _values(rows, columns)
    if written:
        hashed = F.xxhash64("place", "value")
        hashes = _counted(values.select(hashed.alias("hash")), "hash").where(F.col("n") > 1)
        slots = hashes.select(F.pmod("hash", F.lit(SLOTS)).alias("slot")).distinct()
        values = values.join(F.broadcast(slots), F.pmod(hashed, F.lit(SLOTS)) == F.col("slot"),
                             "left_semi")
    repeated = _counted(values, "place", "value").where(F.col("n") > 1)
    return _by_column(repeated, columns, F.count_if)


def not_null(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, failures): how many rows are NULL, all columns in one pass."""
    counts = rows.agg(*(F.count_if(F.col(column).isNull()).alias(column) for column in columns))
    return counts.unpivot([], list(columns), "column_name", "failures")


class Observed:
    """A frame that counts its NULLs while it is written or otherwise computed, once.

    The counts are those of the tasks that make the result, so a repeated task counts once.
    """

    def __init__(self, rows: DataFrame, columns: Sequence[str]):
        self.columns = tuple(columns)
        self._observation = Observation()
        self.frame = rows.observe(self._observation, *(
            F.count_if(F.col(column).isNull()).alias(column) for column in columns))

    def failures(self) -> dict[str, int]:
        """NULLs by column; waits until the frame is computed."""
        return {column: self._observation.get[column] for column in self.columns}


def observed_report(spark: SparkSession, observed: Mapping[str, Observed]) -> DataFrame:
    """The not-null part of a report, see :func:`run_checks`, from frames that were written."""
    rows = [(name, column, "not_null", failures, failures == 0)
            for name, counts in observed.items()
            for column, failures in counts.failures().items()]
    return spark.createDataFrame(rows, "model string, column_name string, test string, "
                                       "failures bigint, passed boolean")


def relationships(rows: DataFrame, references: Sequence[Reference],
                  parent: Callable[[str], DataFrame]) -> DataFrame:
    """(column_name, failures): how many rows hold a non-null value without a parent row."""
    parents = reduce(DataFrame.unionByName, (
        parent(reference.parent).select(
            F.lit(place).alias("place"), packed(reference.parent_column).alias("value"))
        for place, reference in enumerate(references)))
    columns = [reference.column for reference in references]
    values = _values(rows, columns).select("place", packed("value").alias("value"))
    orphans = _counted(values, "place", "value").join(parents, ["place", "value"], "left_anti")
    return _by_column(orphans, columns, lambda matches: F.sum(F.when(matches, F.col("n"))))


def run_checks(model: Callable[[str], DataFrame], spec: Mapping[str, Checks], *,
               written: bool = False) -> DataFrame:
    """Report (model, column_name, test, failures, passed) for every declared check.

    ``model`` returns the frame for a model name. The report is lazy. Checking written tables
    reads the checked columns; a model that is not written is computed once per kind of check.
    ``written`` says that all are written, see :func:`unique`.
    """
    parts = []
    for name, checks in spec.items():
        rows = model(name)
        if checks.unique:
            parts.append((name, "unique", unique(rows, checks.unique, written=written)))
        if checks.not_null:
            parts.append((name, "not_null", not_null(rows, checks.not_null)))
        if checks.references:
            parts.append((name, "relationships", relationships(rows, checks.references, model)))
    failures = F.col("failures").cast("bigint")
    return reduce(DataFrame.unionByName, (
        result.select(F.lit(name).alias("model"), "column_name", F.lit(test).alias("test"),
                      failures.alias("failures"), (failures == 0).alias("passed"))
        for name, test, result in parts))
