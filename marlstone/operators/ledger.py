"""Keyed logs in one folder whose rows appear together.

A commit writes the rows of several logs, each to ``<log>/commit=<number>/bucket=<b>``, where
a bucket is a hash of the log's key, and becomes visible by one empty file ``_commits/<number>``:
readers take only commits that have one, so a writer that dies in between leaves nothing to be
seen, and the next one replaces what it wrote.  One writer at a time is taken for granted.

The present state of a key is its last row (or what the log's ``merge`` makes of its rows).  A
lookup of keys reads their buckets only.  When ``FAN`` commits of like size have come together
at the end, they are merged into one, bucket by bucket, so a row is written again
log(commits) / log(FAN) times in all, and readers find few files.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Commits of like size that are merged.
FAN = 8
#: Parts of a log by its key: more for large catalogues, as a commit writes a file for each that it has rows of.
BUCKETS = 16


def now() -> str:
    return datetime.now(timezone.utc).isoformat()


@dataclass(frozen=True)
class Log:
    """Columns (without ``at``, the time of the commit), the key, and what may stand for all
    rows of a key (None: nothing but the rows themselves)."""

    schema: str
    key: str
    merge: Callable[[DataFrame], DataFrame] | None = None


class Ledger:
    def __init__(self, spark: SparkSession, folder: str, logs: dict[str, Log], buckets: int = BUCKETS, fan: int = FAN):
        self.spark, self.folder, self.logs, self.buckets, self.fan = spark, folder.rstrip("/"), logs, buckets, fan

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        path, files = self._path(folder)
        return sorted(s.getPath().getName() for s in files.listStatus(path)) if files.exists(path) else []

    def _marked(self) -> list[tuple[int, int]]:
        return [(int(a), int(b)) for a, b in (n.split("-") for n in self._names("_commits") if n[:1].isdigit())]

    def commits(self) -> list[tuple[int, int]]:
        """First and last number of each visible commit; one that was merged isn't any more."""
        whole: list[tuple[int, int]] = []
        for a, b in sorted(self._marked(), key=lambda x: (x[0], -x[1])):
            if not whole or a > whole[-1][1]:
                whole.append((a, b))
        return whole

    @staticmethod
    def _part(commit: tuple[int, int]) -> str:
        return f"commit={commit[0]:08d}-{commit[1]:08d}"

    def bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def read(self, name: str, keys: DataFrame | None = None, commits: list[tuple[int, int]] | None = None) -> DataFrame:
        """All visible rows of a log with ``at``; with ``keys`` (one column), only theirs: of
        the log no other bucket is read."""
        log = self.logs[name]
        there = set(self._names(name))
        parts = [p for p in map(self._part, self.commits() if commits is None else commits) if p in there]
        kind = f"{log.schema}, at string"
        if not parts:
            return self.spark.createDataFrame([], kind)
        rows = self.spark.read.schema(f"{kind}, commit string, bucket int").option("basePath", f"{self.folder}/{name}").parquet(*[f"{self.folder}/{name}/{p}" for p in parts])
        if keys is not None:
            own = keys.select(F.col(keys.columns[0]).alias(log.key)).distinct()
            wanted = [r[0] for r in own.select(self.bucket(F.col(log.key))).distinct().collect()]  # as many as there are buckets at most
            rows = rows.filter(F.col("bucket").isin(wanted)).join(own, log.key, "left_semi")
        return rows.drop("commit", "bucket")

    def _write(self, name: str, rows: DataFrame, commit: tuple[int, int]) -> None:
        placed = rows.withColumn("bucket", self.bucket(F.col(self.logs[name].key)))
        placed.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/{name}/{self._part(commit)}")

    def _mark(self, commit: tuple[int, int]) -> None:
        path, files = self._path(f"_commits/{commit[0]:08d}-{commit[1]:08d}")
        files.create(path, False).close()  # fails if there is one

    def commit(self, rows: dict[str, DataFrame]) -> None:
        """Adds rows to the logs by name; all of them, at the same time ``at``, or none."""
        last = self.commits()[-1][1] if self.commits() else 0
        own, time = (last + 1, last + 1), now()
        with ThreadPoolExecutor(len(rows)) as together:  # several short jobs
            list(together.map(lambda item: self._write(item[0], item[1].withColumn("at", F.lit(time)), own), rows.items()))
        self._mark(own)
        self._compact()

    def _tier(self, commit: tuple[int, int]) -> int:
        size, tier = commit[1] - commit[0] + 1, 0
        while size >= self.fan:
            size, tier = size // self.fan, tier + 1
        return tier

    def _compact(self) -> None:
        """Merges the last commits while ``fan`` of them are of one tier.  What an earlier merge
        replaced is deleted now, and no sooner, as frames may still have been reading it."""
        while len(last := self.commits()[-self.fan :]) == self.fan and len({self._tier(c) for c in last}) == 1:
            self._delete_replaced()
            whole = (last[0][0], last[-1][1])
            for name, log in self.logs.items():
                rows = self.read(name, commits=last)
                self._write(name, log.merge(rows).select(*rows.columns) if log.merge else rows, whole)
            self._mark(whole)

    def _delete_replaced(self) -> None:
        alive = set(self.commits())
        for a, b in [c for c in self._marked() if c not in alive]:
            for name in self.logs:
                path, files = self._path(f"{name}/{self._part((a, b))}")
                files.delete(path, True)
            path, files = self._path(f"_commits/{a:08d}-{b:08d}")
            files.delete(path, False)
