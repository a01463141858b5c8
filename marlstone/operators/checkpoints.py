"""Cutting lineage in the folder that all executors share."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame


def _shared(spark) -> str:
    """The folder that a cluster names in ``spark.checkpoint.dir``; one of our own only where
    that is unset and the driver is the only machine (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.match(r"local(\[[^,\]]*\])?$", spark.sparkContext.master):
        raise ValueError("a cluster must name its shared folder in spark.checkpoint.dir")
    made = tempfile.mkdtemp(prefix="marlstone-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    return made


def cut(rows: DataFrame) -> DataFrame:
    """``rows`` as a checkpoint in the shared folder.  A session that sets
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` deletes it when nothing refers to it."""
    context = rows.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(f"{_shared(rows.sparkSession)}/{uuid.uuid4().hex}")
    return rows.checkpoint()


def scratch(spark, name: str) -> str:
    """A new folder in the shared place."""
    return f"{_shared(spark)}/{name}-{uuid.uuid4().hex}"
