"""Works from a bibliography provider: references, journals, citation counts."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from functools import reduce
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .checkpoints import cut

#: What is read of a work.
WORK = "struct<title:array<string>,container_title:array<string>,is_referenced_by_count:bigint,reference:array<struct<doi:string,title:string,author:string,container_title:string,issued:array<array<int>>>>>"


def _plain(value: Any) -> Any:
    """A provider's answer with names as columns have them."""
    if isinstance(value, dict):
        return {k.lower().replace("-", "_"): _plain(v) for k, v in value.items()}
    return [_plain(v) for v in value] if isinstance(value, list) else value


def looked_up(dois: DataFrame, lookup: Callable[[str, int], dict | None], tries: int = 3, gap: float = 0.2, partitions: int | None = None, sleep: Callable[[float], None] = time.sleep) -> tuple[DataFrame, DataFrame]:
    """SRC21: works (doi, work, tries) and dead letters (doi, error, tries) for a list of DOIs
    (doi), each asked for once a round by ``lookup(doi, retry)``, on the executors.  Only what
    failed or had no answer goes on to the next round, ``gap`` seconds later; what ``tries``
    rounds don't bring is a dead letter with its last error.  Rounds are checkpoints, so a
    lost executor repeats no other's requests.  A round's requests are dealt to ``partitions``
    tasks, by default as many as run at once: by their bytes they would go to one or two."""
    spread = partitions or dois.sparkSession.sparkContext.defaultParallelism
    schema = pa.schema([("doi", pa.string()), ("answer", pa.string()), ("error", pa.string())])
    pending, works, dead = dois.select("doi").filter("doi is not null").distinct(), [], None
    for retry in range(tries):
        if retry:
            if not pending.head(1):
                break
            sleep(gap)

        def ask(batches, retry=retry):
            for batch in batches:
                rows = []
                for doi in batch.column(0).to_pylist():
                    try:
                        got, why = lookup(doi, retry), "no such work"
                    except Exception as e:  # a failure is a result
                        got, why = None, str(e) or type(e).__name__
                    rows.append({"doi": doi, "answer": None if got is None else json.dumps(_plain(got)), "error": why if got is None else None})
                yield pa.RecordBatch.from_pylist(rows, schema)

        dealt = pending.repartition(spread)
        got = cut(dealt.mapInArrow(ask, "doi string, answer string, error string"))
        works.append(got.filter("error is null").select("doi", F.from_json("answer", WORK).alias("work"), F.lit(retry + 1).alias("tries")))
        dead = got.filter("error is not null").select("doi", "error", F.lit(retry + 1).alias("tries"))
        pending = dead.select("doi")
    return reduce(DataFrame.unionByName, works), dead


def with_works(dois: DataFrame, works: DataFrame) -> DataFrame:
    """SRC21, J12: works (doi, work) for a list of DOIs; null where there is none."""
    return dois.join(works, "doi", "left")


def references(works: DataFrame) -> DataFrame:
    """SRC22: one row for each reference (doi, index from 0, ref_doi, title, author,
    container, year); an absent field is null and spoils nothing (Q22)."""
    rows = works.select("doi", F.posexplode("work.reference").alias("index", "r"))
    return rows.select("doi", "index", F.col("r.doi").alias("ref_doi"), "r.title", "r.author", F.col("r.container_title").alias("container"), F.get(F.get("r.issued", F.lit(0)), F.lit(0)).alias("year"))


def journal(titles: Column) -> Column:
    """SRC24: the first container title; the text ``None`` without one."""
    return F.coalesce(F.get(titles, F.lit(0)), F.lit("None"))


def citation_counts(dois: DataFrame, works: DataFrame) -> DataFrame:
    """SRC25."""
    return with_works(dois, works).select("doi", F.col("work.is_referenced_by_count").alias("citations"))
