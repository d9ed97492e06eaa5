"""Column expressions shared by the plans. All of them stay on the JVM side."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradewind.functions.labels import KEY_NULL, KEY_SEPARATOR


def translate(column: str | Column, labels: Mapping[Any, str], default: Any = None) -> Column:
    """Replace listed values by their label; others become ``default``.

    ``default`` may be a literal or a column. A NULL input is never listed, so it
    takes the default too.
    """
    value = F.col(column) if isinstance(column, str) else column
    entries = iter(labels.items())
    first, label = next(entries)
    result = F.when(value == F.lit(first), F.lit(label))
    for known, label in entries:
        result = result.when(value == F.lit(known), F.lit(label))
    return result.otherwise(default if isinstance(default, Column) else F.lit(default))


def surrogate_key(*parts: str | Column) -> Column:
    """md5 over the parts as text; NULL parts are written as a fixed marker."""
    texts = [F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit(KEY_NULL))
             for p in parts]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *texts))


def foreign_key(natural_key: str | Column) -> Column:
    """The surrogate key of the row ``natural_key`` points to, or NULL if it is NULL.

    Dimensions hash their natural key, so the reference from a fact row can be
    computed where the row is instead of joined.
    """
    column = F.col(natural_key) if isinstance(natural_key, str) else natural_key
    return F.when(column.isNotNull(), surrogate_key(column))


# Longer than a packed surrogate key, so that no packed text equals one.
TEXT_MARK = "00" * 17


def packed(key: str | Column) -> Column:
    """A key as bytes, for grouping and joining: different keys differ, and NULL stays NULL.

    A surrogate key takes 16 bytes, half of its text; other values are their text behind a mark.
    """
    text = (F.col(key) if isinstance(key, str) else key).cast("string")
    return (F.when(text.rlike(r"\A[0-9a-f]{32}\z"), F.unhex(text))
            .otherwise(F.concat(F.unhex(F.lit(TEXT_MARK)), text.cast("binary"))))


def unpacked(key: str) -> Column:
    """The text of the key that :func:`packed` made this from."""
    text = F.col(key).substr(len(TEXT_MARK) // 2 + 1, 2 ** 31 - 1).cast("string")
    return F.when(F.length(key) == 16, F.lower(F.hex(key))).otherwise(text)


def day(column: str, name: str | None = None) -> Column:
    """The calendar day of a timestamp column, under the same or a new name."""
    return F.to_date(F.col(column)).alias(name or column)


def month_start(column: str) -> Column:
    return F.trunc(F.col(column), "MM")


def money(column: Column) -> Column:
    """Round to cents and fix the type, so equal amounts compare equal everywhere."""
    return F.round(column, 2).cast("decimal(38,2)")


def plain_double(column: Column, digits: int = 6) -> Column:
    """A double rounded for display; adding zero turns -0.0 into 0.0."""
    return F.round(column.cast("double"), digits) + F.lit(0.0)
