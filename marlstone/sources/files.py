"""Files as frames: address lists, record logs, PDF folders; and the sinks beside them."""

from __future__ import annotations

import os
import re
import uuid
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.fs as pa_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import pdf
from ..functions.ids import base_name
from ..functions.text import strip
from ..operators.checkpoints import cut
from ..operators.dedupe import first_by, last_by
from ..operators.numbering import numbered
from ..operators.records import SUMMARY


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of a file or folder: value and, as ``place``, when its file was written, the
    file, the part of it that a task read, and the line's place in that part."""
    m = F.col("_metadata")
    rows = spark.read.text(path).select("value", m["file_modification_time"].alias("time"), m["file_path"].alias("file"), m["file_block_start"].alias("start"))
    return rows.select("value", F.struct("file", "start", F.monotonically_increasing_id().alias("at")).alias("place"), "time")


def _numbered(rows: DataFrame) -> DataFrame:
    """Numbers lines by file and place in it."""
    return numbered(rows, ["place"]).drop("place", "time")


#: What tells appended lines apart: the time of the append, and the row's number in it.
APPENDED = ("appended_at", "appended_ord")
APPENDED_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def urls_from_list(spark: SparkSession, urls: list[str]) -> DataFrame:
    """SRC1."""
    return spark.createDataFrame(list(enumerate(urls)), "ord bigint, url string").select("url", "ord")


def urls_from_file(spark: SparkSession, path: str) -> DataFrame:
    """SRC2, F5: a line each; blank lines and those that begin with ``#`` don't count."""
    url = strip(F.col("value"))
    return _numbered(_lines(spark, path).filter((url != "") & ~url.startswith("#"))).select(url.alias("url"), "ord")


def doi_list(spark: SparkSession, path: str) -> DataFrame:
    """SRC16: a line each, blank ones kept."""
    return _numbered(_lines(spark, path)).select(strip(F.col("value")).alias("doi"), "ord")


def records_from_jsonl(spark: SparkSession, path: str, columns: tuple[str, ...] = SUMMARY) -> DataFrame:
    """SRC13, A4: known keys only; absent ones are null; lines without a slug don't count,
    a line that isn't JSON raises; of a slug's lines the last counts."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*columns, *APPENDED)])
    lines = _lines(spark, path).filter(strip(F.col("value")) != "")
    # a line that is JSON but no object is no record
    an_object = F.when(~strip(F.col("value")).rlike(r"^[\[\"\d\-tfn]"), F.col("value"))
    rows = lines.select("place", "time", F.from_json(an_object, schema, {"mode": "FAILFAST"}).alias("r")).select("place", "time", "r.*")
    # rows that append_jsonl wrote say which append they are of; the time of a file stands in for others
    rows = rows.withColumn("appended_at", F.coalesce("appended_at", F.date_format(F.to_utc_timestamp("time", F.current_timezone()), APPENDED_FORMAT)))
    rows = rows.withColumn("appended_ord", F.coalesce(F.col("appended_ord").cast("bigint"), F.lit(-1)))
    return last_by(rows.filter("slug is not null and slug <> ''"), ["slug"], ["appended_at", "appended_ord", "place"]).select(*columns)


def records_or_log(table: DataFrame | None, log: DataFrame) -> DataFrame:
    """The table's records if it has any, else the log's."""
    return table if table is not None and table.head(1) else log


def pdf_files(spark: SparkSession, folder: str, recursive: bool = True, content: bool = False) -> DataFrame:
    """SRC17, SRC18: PDFs of a folder by path; flat if asked (Q21)."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.[pP][dD][fF]").option("recursiveFileLookup", str(recursive).lower())
    rows = reader.load(folder)
    if not recursive:
        rows = rows.filter(F.regexp_replace("path", "/[^/]*$", "").endswith(folder.rstrip("/").split("://")[-1]))
    return rows.select("path", base_name(F.col("path")).alias("name"), "length", "modificationTime", *["content"] * content)


def unique_names(files: DataFrame) -> DataFrame:
    """Of files with one name the first by path."""
    return first_by(files, ["name"], ["path"])


def sliced(rows: DataFrame, order: str, start: int = 0, end: int | None = None) -> DataFrame:
    """O4, L3, SRC27: rows ``start`` to ``end`` by order, as the feature asks for."""
    ordered = rows.orderBy(order)
    return ordered.offset(start) if end is None else ordered.offset(start).limit(max(0, end - start))


def append_jsonl(rows: DataFrame, path: str, order: list[str] | None = None) -> None:
    """SNK5, SNK10: null fields are written too, and to each line which append it is of and,
    with ``order``, its number in it."""
    rows = numbered(rows, order, "appended_ord") if order else rows.withColumn("appended_ord", F.monotonically_increasing_id())
    at = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%f")
    rows.withColumn("appended_at", F.lit(at)).write.mode("append").option("ignoreNullFields", "false").json(path)


def write_blobs(rows: DataFrame, folder: str, name: str, content: str, replace: bool = True, nested: bool = False) -> DataFrame:
    """SNK1, SNK2, SNK14, SNK16: a file ``folder/name`` for each row, byte for byte (texts in UTF-8),
    in any store that Arrow's file systems reach.  Returns name, path, n_bytes and error.  A
    file gets its name once it is whole; one that is there is replaced, or else left alone.
    A name that isn't a plain file name (with ``nested``, a plain path below the folder), and
    null content, are errors of their row.  Written
    once: the result is a checkpoint."""
    if re.match("file:/(?!/)", folder):
        folder = folder.removeprefix("file:")
    elif "://" not in folder:
        folder = os.path.abspath(folder)  # of the driver, as executors work elsewhere
    body = F.col(content)
    given = rows.select(F.col(name).cast("string").alias("name"), (body if rows.schema[content].dataType == T.BinaryType() else F.encode(body.cast("string"), "UTF-8")).alias("content"))

    def run(batches):
        files, base = pa_fs.FileSystem.from_uri(folder)
        files.create_dir(base)
        for batch in batches:
            out = {"name": [], "path": [], "n_bytes": [], "error": []}
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                path, why = None, None
                parts = (name or "").split("/")
                if "\\" in (name or "") or len(parts) > 1 and not nested or any(x in ("", ".", "..") for x in parts):
                    why = "not a file name"
                elif data is None:
                    why = "no content"
                else:
                    path = f"{base.rstrip('/')}/{name}"
                    try:
                        if replace or files.get_file_info(path).type == pa_fs.FileType.NotFound:
                            if len(parts) > 1:
                                files.create_dir(path.rpartition("/")[0])
                            part = f"{path}.{uuid.uuid4().hex}.part"
                            with files.open_output_stream(part) as f:
                                f.write(data)
                            files.move(part, path)
                    except OSError as e:
                        path, why = None, str(e)
                for k, v in zip(out, (name, path, None if path is None else len(data), why), strict=True):
                    out[k].append(v)
            yield pa.RecordBatch.from_pydict(out, pa.schema([("name", pa.string()), ("path", pa.string()), ("n_bytes", pa.int64()), ("error", pa.string())]))

    return cut(given.mapInArrow(run, "name string, path string, n_bytes bigint, error string"))


def read_task_log(spark: SparkSession, path: str) -> DataFrame:
    """SRC28: a task log, as one JSON array or as lines, back as rows."""
    kind = "batch_id string, file_name string, file_path string, state string, result_path string, processed boolean"
    first = spark.read.text(path).filter(strip(F.col("value")) != "").first()
    return spark.read.schema(kind).json(path, multiLine=bool(first) and first["value"].lstrip().startswith("["))


def write_one_json(row: DataFrame, path: str) -> None:
    """SNK17: a one-row frame, such as a run's summary, as one JSON file in the folder ``path``."""
    row.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_list(rows: DataFrame, column: str, path: str) -> None:
    """SNK18: a column's values, a line each, sorted; nulls don't count."""
    rows.select(F.col(column).cast("string").alias("value")).filter(F.col("value").isNotNull()).orderBy("value").write.mode("overwrite").text(path)


def validated(found: DataFrame, wanted: DataFrame) -> DataFrame:
    """Wanted files (path) with ``ok`` and ``why``: what isn't a PDF by its name, isn't
    there, or is empty, is told apart.  found: path, length."""
    there = found.select(plain_path(F.col("path")).alias("path"), "length")
    rows = wanted.select(plain_path(F.col("path")).alias("path")).distinct().join(there, "path", "left")
    why = F.when(~F.lower("path").endswith(".pdf"), "not a PDF").when(F.col("length").isNull(), "missing").when(F.col("length") == 0, "empty")
    return rows.select("path", why.isNull().alias("ok"), why.alias("why"))


def plain_path(path):
    """A path without its scheme."""
    return F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:/*(?=/)", "")


def pdf_info(content):
    """SRC19, SRC20: ``map<string,string>`` of a PDF's information dictionary, wherever the
    file's tables say that it is, compressed or not; strings may be literal, hexadecimal or
    UTF-16.  Empty for what isn't a PDF or has none; ``Encrypted`` alone where strings can't
    be read; of a damaged file the entries that stand in it."""

    @F.arrow_udf("map<string,string>")
    def run(files: pa.Array) -> pa.Array:
        return pa.array((list(pdf.information(x.as_py()).items()) for x in files), pa.map_(pa.string(), pa.string()))

    return run(content)


def pdf_info_at(path):
    """As ``pdf_info`` for files by their paths: only their ends, their tables of objects and
    the dictionary are read.  Null for a file that can't be opened."""

    @F.arrow_udf("map<string,string>")
    def run(paths: pa.Array) -> pa.Array:
        found: list = []
        for x in paths:
            try:
                store, base = pa_fs.FileSystem.from_uri(re.sub("^file:/(?!/)", "file:///", x.as_py() or ""))
                with store.open_input_file(base) as file:
                    found.append(list(pdf.information(pdf.FileSource(file)).items()))
            except (OSError, pa.ArrowInvalid):
                found.append(None)
        return pa.array(found, pa.map_(pa.string(), pa.string()))

    return run(path)
