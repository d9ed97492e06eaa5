"""Cutting the lineage of frames that are used many times or grow step by step."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpoint_folder(spark: SparkSession) -> str:
    """The checkpoint folder, taken from the session's settings.

    Only a local session without the setting gets a temporary folder, which goes when the
    program ends; a cluster has to name one that every executor can reach.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get(CHECKPOINT_SETTING, None)
        if not folder:
            if not context.master.startswith("local"):
                raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder on shared storage")
            folder = tempfile.mkdtemp(prefix="tradewind-checkpoint-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def written(frame: DataFrame) -> DataFrame:
    """The frame, computed once and read back from the checkpoint folder.

    Later jobs, and recovery after a lost executor, start from the written files.
    """
    checkpoint_folder(frame.sparkSession)
    return frame.checkpoint()


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of what runs here go when it ends.

    Otherwise they stay until the driver collects garbage, those of one write beside the next's.
    """
    before = spark.conf.get(CLEANUP_SETTING, None)
    spark.conf.set(CLEANUP_SETTING, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP_SETTING)
        else:
            spark.conf.set(CLEANUP_SETTING, before)
