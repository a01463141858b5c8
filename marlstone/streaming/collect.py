"""Collecting as a stream: a page or file is a micro-batch, sinks are idempotent, and a
batch is checkpointed after its rows are written, so a repeated batch changes nothing."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.urls import normalize_article_url
from .seen import with_first


def _run(spark: SparkSession, source: str, schema: T.StructType, sink: str, checkpoint: str, files_per_batch: int, on_batch: Callable[[int, int], None] | None) -> int:
    """Appends each batch's new rows to ``sink`` in a folder named by the checkpoint and the
    batch's number: a batch that is repeated after a crash replaces itself, and another
    stream's batches are never touched.  What this stream has seen is keyed state; what
    others had written when it began is read once."""
    ran, own = [], hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def write(batch: DataFrame, number: int) -> None:
        counted = Observation()
        new = batch.filter("marl_new").drop("marl_new").observe(counted, F.count(F.lit(1)).alias("n"))
        new.write.mode("overwrite").parquet(f"{sink}/batch={own}-{number:08d}")
        ran.append(number)
        if on_batch:
            on_batch(number, counted.get["n"])  # counted as they were written

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    rows = with_first(stream.withColumn("url", normalize_article_url(F.col("url"))), "url", ["page_id"], _known(spark, sink, own), "marl_new")
    rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return len(ran)


def collect_pages(spark: SparkSession, source: str, schema: T.StructType, sink: str, checkpoint: str, files_per_batch: int = 1, on_batch: Callable[[int, int], None] | None = None) -> int:
    """ST1-ST3, ST6, ST9: reads new page files (url and other columns) from ``source`` and
    appends to ``sink`` the rows whose address isn't there yet, the first of a batch.  Returns
    the number of batches; ``on_batch`` is told each one's number and new rows."""
    return _run(spark, source, schema, sink, checkpoint, files_per_batch, on_batch)


def _known(spark: SparkSession, sink: str, own: str) -> DataFrame | None:
    """Addresses that other streams have written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(sink)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return None
    done = [s.getPath().toString() for s in files.listStatus(path) if (name := s.getPath().getName()).startswith("batch=") and not name.startswith(f"batch={own}-")]
    return spark.read.schema("url string").parquet(*done).distinct() if done else None


def fill_gaps(spark: SparkSession, source: str, schema: T.StructType, sink: str, checkpoint: str, files_per_batch: int = 1, on_batch: Callable[[int, int], None] | None = None) -> int:
    """ST4: goes over all pages again under a new checkpoint; rows that are there stay."""
    return _run(spark, source, schema, sink, checkpoint, files_per_batch, on_batch)
