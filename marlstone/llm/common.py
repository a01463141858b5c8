"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
import weakref
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: How tables are written.  Very long texts make pages of hundreds of MB by default, as their
#: size is looked at only after 100 rows, and Snappy keeps such pages outside the heap.
WRITING = {"compression": "zstd", "parquet.page.size.row.check.min": "4", "parquet.page.size.row.check.max": "64"}
_own_dirs: dict[str, str] = {}


#: The folder of each frame that ``stored`` or ``bucketed`` has made and ``dropped`` hasn't deleted.
_tables: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()
#: Folders that aren't deleted yet, each with a weak reference to what all plans that read it share.
_left: dict[str, object] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables: the one that the cluster names in
    ``spark.checkpoint.dir``; a folder of our own only where that is unset and the driver
    is the only machine (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.match(r"local(\[[^,\]]*\])?$", spark.sparkContext.master):
        raise ValueError("a cluster must name its shared folder in spark.checkpoint.dir")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = tempfile.mkdtemp(prefix="marlstone-")
        atexit.register(shutil.rmtree, _own_dirs[app], ignore_errors=True)
    return f"file://{_own_dirs[app]}"


def _delete(spark: SparkSession, path: str) -> None:
    _left.pop(path, None)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _at_exit() -> None:
    """Deletes what is still there: tables that returned frames could read to the end.  (A
    driver that is killed leaves them to whoever clears the folder it named.)"""
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.sparkContext._jsc is not None:
        for path in list(_left):
            _delete(spark, path)


atexit.register(_at_exit)


def dropped(*tables: DataFrame) -> None:
    """Deletes tables of ``stored`` that nothing reads any more; what came of them must
    have been written."""
    for df in tables:
        if path := _tables.pop(df, None):
            _delete(df.sparkSession, path)


def swept(spark: SparkSession) -> None:
    """Deletes the tables that no frame can read any more: those whose relation, which the
    plans of a table and of all that was made of it share, is garbage in the JVM.  Runs before
    each new table, so a round of a loop frees what the rounds before it left."""
    for path, relation in list(_left.items()):
        if relation.get() is None:
            _delete(spark, path)


def _written(spark: SparkSession, write, made, path: str) -> DataFrame:
    swept(spark)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")  # the shuffles of this write are of no use after it
    try:
        write()
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    df = made()
    _tables[df] = path
    relation = df._jdf.queryExecution().analyzed().collectLeaves().head().relation()
    _left[path] = spark._jvm.java.lang.ref.WeakReference(relation)
    return df


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a Parquet table in the shared folder and read back: it cuts
    the lineage, outlives executors, and gives the planner true sizes."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    return _written(spark, lambda: df.write.options(**WRITING).parquet(path), lambda: spark.read.schema(df.schema).parquet(path), path)


def bucketed(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """As ``stored``, dealt into buckets by ``keys``: joins and groupings by them shuffle
    nothing of this table any more, however often it is read."""
    spark = df.sparkSession
    own = f"{name}_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/{own}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def made():
        found = spark.table(own)
        spark.sql(f"DROP TABLE {own}")  # the files stay: the table is external
        return found

    return _written(spark, lambda: df.repartition(n, *keys).write.bucketBy(n, *keys).sortBy(*keys).options(**WRITING).option("path", path).saveAsTable(own), made, path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus`` (null id: null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def chosen(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names, so that extra columns
    of the input can't clash with anything an operator makes."""
    return df.select(*[df[old].alias(new) for new, old in columns.items()])
