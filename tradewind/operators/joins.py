"""Left joins that stay balanced when keys are uneven.

Adaptive execution already splits a skewed partition when both join inputs come straight
from a shuffle. These two helpers cover the cases it does not: a side that is aggregated or
joined on the same key before, and NULL keys, which all hash to one partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key with more rows than this is spread over several tasks.
ROWS_PER_SPLIT = 2_000_000
# Into how many parts rows without a key are cut.
NULL_PARTS = 100_000


def key_counts(rows: DataFrame, key: str) -> DataFrame:
    """(key, rows) per value of ``key``; reads one column and counts before the shuffle."""
    return rows.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("rows"))


def hot_keys(counts: DataFrame, rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """Keys with more than ``rows_per_split`` rows and the number of parts to cut them into.

    At most ``total rows / rows_per_split`` keys can qualify, so the result is about 16
    bytes for every 2 million input rows: 8 MB for 10^12 rows.
    """
    return (counts.where(F.col("rows") > rows_per_split)
            .groupBy(F.col("key").alias("_hot_key"))
            .agg(F.ceil(F.max("rows") / F.lit(rows_per_split)).cast("int").alias("_parts")))


def mark_parts(left: DataFrame, left_key: str, spread_by: str, hot: DataFrame) -> DataFrame:
    """``left`` with ``_part``: rows of a hot key are cut by a hash of ``spread_by``, others are 0.

    NULL keys match nothing and are always cut, so ``hot`` need not list them.
    """
    parts = F.when(F.col(left_key).isNull(), F.lit(NULL_PARTS)).otherwise(F.col("_parts"))
    # Null-safe on both sides, a form that lets Spark broadcast the hot keys once.
    return (left.join(F.broadcast(hot), F.col(left_key).eqNullSafe(F.col("_hot_key")), "left")
            .withColumn("_part", F.when(parts.isNull(), F.lit(0))
                        .otherwise(F.pmod(F.xxhash64(spread_by), parts).cast("int")))
            .drop("_hot_key", "_parts"))


def repeat_parts(right: DataFrame, right_key: str, hot: DataFrame) -> DataFrame:
    """``right`` with ``_right_part``: rows of a hot key are repeated once per part."""
    return (right.join(F.broadcast(hot), F.col(right_key).eqNullSafe(F.col("_hot_key")), "left")
            .withColumn("_right_part", F.explode(F.sequence(
                F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)))
            .drop("_hot_key", "_parts"))


def repeat_counted(right: DataFrame, right_key: str, counts: DataFrame,
                   rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """As :func:`repeat_parts`, from the (key, rows) of the left side. Keys are not NULL.

    It saves a shuffle where ``right`` is dealt by its key already, as ``counts`` are.
    """
    rows = F.coalesce(F.col("_rows"), F.lit(0))
    parts = F.when(rows > rows_per_split, F.ceil(rows / F.lit(rows_per_split)).cast("int")
                   ).otherwise(F.lit(1))
    most = counts.select(F.col("key").alias("_key"), F.col("rows").alias("_rows"))
    return (right.join(most, F.col(right_key) == F.col("_key"), "left")
            .withColumn("_right_part", F.explode(F.sequence(F.lit(0), parts - 1)))
            .drop("_key", "_rows"))


def left_join_hot(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                  spread_by: str, counts: DataFrame | None = None,
                  rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """``left`` LEFT JOIN ``right`` where a few keys may hold a large share of ``left``.

    Rows of a hot key are cut into parts by a hash of ``spread_by``, which should differ between
    them, and the matching right rows are repeated once per part; all other rows are joined as
    usual. The result is the plain left join, whichever keys count as hot. ``counts`` gives the
    (key, rows) of ``left`` where they are known or cheaper to count elsewhere.

    Broadcasting the hot keys is safe: see the bound in :func:`hot_keys`.
    """
    hot = hot_keys(key_counts(left, left_key) if counts is None else counts, rows_per_split)
    return left_join_parts(mark_parts(left, left_key, spread_by, hot),
                           repeat_parts(right, right_key, hot),
                           left_key, right_key).drop("_part")


def left_join_parts(marked: DataFrame, repeated: DataFrame, left_key: str,
                    right_key: str) -> DataFrame:
    """The join of a side with ``_part``, which is kept, and one with ``_right_part``."""
    on = (F.col(left_key) == F.col(right_key)) & (F.col("_part") == F.col("_right_part"))
    return marked.join(repeated, on, "left").drop("_right_part")


def left_join_nullable(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                       spread_by: str) -> DataFrame:
    """``left`` LEFT JOIN ``right`` on an integer key that is often NULL on the left.

    A NULL key matches nothing, but a plain join still sends all such rows to one task. A
    second key column that differs between NULL rows spreads them; it is 0 for every other
    row. ``pmod(key, 1)`` is that 0 on the right, in a form that stays part of the join key.
    """
    spread = F.when(F.col(left_key).isNull(), F.xxhash64(F.col(spread_by))).otherwise(F.lit(0))
    marked = left.withColumn("_spread", spread.cast("bigint"))
    keyed = right.withColumn("_zero", F.pmod(F.col(right_key), F.lit(1)).cast("bigint"))
    on = (F.col(left_key) == F.col(right_key)) & (F.col("_spread") == F.col("_zero"))
    return marked.join(keyed, on, "left").drop("_spread", "_zero")
