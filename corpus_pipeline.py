"""From raw documents to packed sequences, each stage written and read again.

1. quality rules: documents that fail the base rules, or whose host is rejected, go;
2. line dedup: repeated multi-line chunks go, but for their first occurrence;
3. SimHash near-dedup: of each group of near copies, verified at a similarity of 0.8 of
   five-word shingles, the row with the smallest id stays;
4. suffix-array dedup: passages of 200 bytes or more go wherever they occur but the first time;
5. best-fit packing: sequences of byte-level BPE tokens, one row each.
"""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm import bpe, linededup, neardup, packing, quality, suffixarray
from marlstone.llm.common import stored, swept


def _measured(docs: DataFrame) -> DataFrame:
    """n_chars follows a text that a stage has cut."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose host isn't rejected.  A null or empty text
    fails; rows without a host are a host of their own; repeated rows are judged, and kept,
    each; other columns pass, whatever their names and types; no rows give none."""
    return quality.keep_good(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines of chunks that occurred before.  A null text stays
    null, an empty one empty; rows equal in id and text count as one document and each keeps
    the same lines; other columns pass, and n_chars follows the text; no rows give none."""
    return _measured(linededup.without_repeats(docs))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8, verified):
    that with the smallest id, null last, ties by a hash of the text.  Candidates are
    operator 5's links and, as those miss most pairs at 0.8, min-hash bands.  Texts without words
    are copies of each other; of rows equal in id and text one stays; other columns pass; no
    rows give none."""
    return neardup.keep_one(docs)


def suffix_array_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document of which something but space is left, without the bytes of passages
    that occurred before (by id, null last).  Null and empty texts go; repeated rows are
    one document's; other columns pass, and n_chars follows the text; no rows give none."""
    cut = _measured(suffixarray.without_repeats(docs, keep_first=True))
    return cut.filter(F.coalesce(F.trim("text", F.lit(" \t\n\x0b\x0c\r")), F.lit("")) != "")  # nothing is left of the others


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of byte-level BPE tokens, a row each, with the documents and places that they
    come from.  A null or empty text is its closing token alone; repeated rows are packed as
    often as they occur; ids may be null; other columns aren't read; no rows give none."""
    made = packing.packed(docs, tokens=bpe.closed(spark, F.col("text")))
    return made.withColumn("tokens", F.flatten("parts")).drop("parts")


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("suffix-array dedup", suffix_array_stage),
    ("best-fit packing", packing_stage),
]
#: No stage after the first can be put in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        gc.collect()  # what the stage read is of no use any more
        spark._jvm.System.gc()
        swept(spark)
    return docs
