"""Running vectorised Python over the rows of a frame, in slices of bounded size."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import Any
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

# Characters of text that one call of a kernel sees, unless one text alone is longer.
SLICE_CHARS = 1_000_000
SLICE_ROWS = 4_000
# Rows, of about 1 KB at most, that a join may broadcast.
BROADCAST_ROWS = 10_000


def importable(spark: SparkSession) -> None:
    """Python workers started from now on look for this package where the driver found it.

    It matters where the package is neither installed nor sent with --py-files, as in tests.
    """
    environment = spark.sparkContext.environment
    root = str(Path(__file__).resolve().parents[2])
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([*filter(None, known), root])


def arrow_schema(schema: str) -> pa.Schema:
    parsed = _parse_datatype_string(schema)
    assert isinstance(parsed, StructType)
    return to_arrow_schema(parsed)


# What the step a worker is at keeps from one task to the next, under the step's own key.
_KEPT: dict[str, dict[str, Any]] = {}


def begin(step: str) -> None:
    """A task of ``step`` begins: what another step has kept in this worker goes.

    Workers serve all steps of a session, so it would add up with that of later steps.
    """
    if step not in _KEPT:
        _KEPT.clear()
        free_unused()
        _KEPT[step] = {}


def kept_in_worker(key: str, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, made once in a worker for the tasks of a step that follow each other."""
    if not _KEPT:  # outside of a task
        begin("")
    held = next(iter(_KEPT.values()))
    if key not in held:
        held.clear()
        held[key] = make()
    return held[key]


def free_unused() -> None:
    """Unused memory of Arrow and, where the C library can, of Python goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_texts(rows: DataFrame, text: str | Column, keep: list[Column],
              kernel: Callable[[list[str], dict[str, list]], dict[str, list]],
              schema: str, passed: list[Column] | None = None,
              rest: Callable[[], dict[str, list]] | None = None) -> DataFrame:
    """``kernel(texts, kept columns)`` over slices of at most SLICE_CHARS characters.

    The columns of ``passed`` come first in the result, as they are; the kernel doesn't see them.
    A kernel may hold rows back; ``rest`` gives them after the last slice of a task.

    Only the text and the columns of ``keep`` are read, so other columns of ``rows`` may have
    any names. A NULL text reaches the kernel as None.
    """
    text = F.col(text) if isinstance(text, str) else text
    passed = passed or []
    inner = rows.select(*passed, *keep, text.cast("string").alias("__text"))
    target, ahead = arrow_schema(schema), len(passed)
    importable(rows.sparkSession)
    step = uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(step)
        for batch in batches:
            lengths = np.cumsum(pc.fill_null(pc.utf8_length(batch.column(batch.num_columns - 1)), 0),
                                dtype=np.int64)
            start = 0
            while start < batch.num_rows:
                before = lengths[start - 1] if start else 0
                end = int(np.searchsorted(lengths, before + SLICE_CHARS, side="right"))
                end = min(max(end, start + 1), start + SLICE_ROWS, batch.num_rows)
                part = batch.slice(start, end - start)
                kept = {name: part.column(i).to_pylist()
                        for i, name in enumerate(part.schema.names[:-1]) if i >= ahead}
                out = kernel(part.column(part.num_columns - 1).to_pylist(), kept)
                out = {target.names[i]: part.column(i).cast(target.field(i).type)
                       for i in range(ahead)} | out
                yield pa.RecordBatch.from_pydict(out, schema=target)
                start = end
        if rest is not None:
            yield pa.RecordBatch.from_pydict(rest(), schema=target)
        batch = part = kept = out = None
        free_unused()  # a worker serves other tasks after this one

    return inner.mapInArrow(run, schema)


def map_groups(rows: DataFrame, key: str, kernel: Callable[[pa.Table], pa.Table | None],
               schema: str, partitions: int | None = None) -> DataFrame:
    """``kernel`` over tables that hold whole groups of ``key`` (a bigint), sorted by it.

    A table holds as many groups as its batches do, so small groups cost no call of their own.
    The caller bounds the size of a group.
    """
    dealt = rows.repartition(partitions, key) if partitions else rows.repartition(key)
    target = arrow_schema(schema)
    importable(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush():
            found = kernel(pa.Table.from_batches(held)) if held else None
            if found is not None and found.num_rows:
                yield from found.cast(target).to_batches()

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(key).to_numpy(zero_copy_only=False)
            last = int(np.searchsorted(keys, keys[-1], side="left"))  # the last group may go on
            if last:
                held.append(batch.slice(0, last))
                yield from flush()
                held = []
            elif held and held[-1].column(key)[-1].as_py() != keys[0]:
                yield from flush()
                held = []
            held.append(batch.slice(last))
        yield from flush()

    return dealt.sortWithinPartitions(key).mapInArrow(run, schema)


def join_small(rows: DataFrame, small: DataFrame, on: Column, how: str = "inner") -> DataFrame:
    """``rows`` joined with a frame that is small as a rule, and read from a checkpoint.

    It is broadcast if it has at most BROADCAST_ROWS rows, counted here; else Spark joins as it
    does any two frames. Either way the result is the same.
    """
    if small.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        small = F.broadcast(small)
    return rows.join(small, on, how)


def group_bounds(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal values."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int)
    return starts, np.r_[starts[1:], len(keys)].astype(int) if len(starts) else starts
