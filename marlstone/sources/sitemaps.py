"""Sitemaps as files: fetched through an engine, read entry by entry.

Entries come from Spark's XML source by their tag, so a document of any number of entries is
read in parts, compressed or not, and no task holds a whole one.  What isn't well formed is a
row that says so."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.checkpoints import cut, scratch
from . import files, providers

#: Kinds of entries by their tag.
TAGS = {"sitemap": "index", "url": "page"}


def entries(spark: SparkSession, paths: str | list[str], prefix: str = "") -> DataFrame:
    """SRC11, SRC12: file, kind (``index`` or ``page``), at (the entry's place), dst and broken
    (the text of an entry that can't be read) of sitemap documents in files, whatever their
    default namespace; ``prefix`` (``s:``) where tags have one.  Names that end in ``.gz``
    are unpacked as they are read."""

    def of(tag: str, kind: str) -> DataFrame:
        rows = spark.read.format("xml").schema(f"`{prefix}loc` string, broken string").options(rowTag=f"{prefix}{tag}", columnNameOfCorruptRecord="broken", mode="PERMISSIVE", ignoreSurroundingSpaces="true").load(paths)
        m = F.col("_metadata")
        place = F.struct(m["file_block_start"].alias("start"), F.monotonically_increasing_id().alias("row"))
        return rows.select(m["file_path"].alias("file"), F.lit(kind).alias("kind"), place.alias("at"), F.nullif(F.trim(F.col(f"`{prefix}loc`"), F.lit(" \t\r\n")), F.lit("")).alias("dst"), "broken")

    return reduce(DataFrame.unionByName, [of(*x) for x in TAGS.items()])


def crawled(spark: SparkSession, content: Callable[[str], bytes], root: str, folder: str | None = None, partitions: int | None = None, per_second: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """SRC11, SRC12: the pages (level, src, at, dst) below the sitemap ``root``, which is asked
    for with all sitemaps it names, level by level and each once; and errors (src, error): of
    documents that can't be had, and of entries that can't be read.  Documents are kept as
    files in ``folder`` (a scratch folder without one)."""
    folder = folder or scratch(spark, "sitemaps")
    pending = spark.createDataFrame([(root,)], "url string")
    seen, level, pages, errors = cut(pending), 0, [], []
    while pending.head(1):
        got = cut(providers.downloaded(pending, content, partitions, per_second))
        packed = F.hex(F.substring("content", 1, 2)) == "1F8B"
        name = F.concat(F.sha1("url"), F.when(packed, ".xml.gz").otherwise(".xml"))
        there = got.filter("error is null and octet_length(content) > 0").select("url", name.alias("name"), "content")
        own = f"{folder}/{level}-{uuid.uuid4().hex}"
        written = files.write_blobs(there, own, "name", "content")
        errors += [got.filter("error is not null").select(F.col("url").alias("src"), "error"), there.select(F.col("url").alias("src"), "name").join(written.filter("error is not null").select("name", "error"), "name").select("src", "error")]
        if not written.filter("error is null").head(1):
            break
        found = entries(spark, own).withColumn("name", F.regexp_extract("file", "([^/]*)$", 1))
        found = cut(found.join(there.select(F.col("url").alias("src"), "name"), "name").drop("name", "file"))
        errors.append(found.filter("dst is null").select("src", F.concat(F.lit("not an entry: "), F.substring(F.coalesce("broken", F.lit("")), 1, 200)).alias("error")))
        pages.append(found.filter("kind = 'page' and dst is not null").select(F.lit(level).alias("level"), "src", "at", "dst"))
        pending = cut(found.filter("kind = 'index' and dst is not null").select(F.col("dst").alias("url")).distinct().join(seen, "url", "left_anti"))
        seen, level = seen.unionByName(pending), level + 1
    none = spark.createDataFrame([], "level int, src string, at struct<start:bigint,row:bigint>, dst string")
    return reduce(DataFrame.unionByName, pages, none), reduce(DataFrame.unionByName, errors)
