"""The parsing task: batches, states, idempotent steps, archives, and the summary."""

from __future__ import annotations

import io
import posixpath
import time
import zipfile
from collections.abc import Callable
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import stem
from .checkpoints import cut
from .numbering import numbered

#: The states that the parsing service reports while it isn't finished.
WAITING = ("waiting-file", "pending", "running", "converting")
ENDED = ("done", "failed")
BATCH = 200


def chunked(rows: DataFrame, order: list[str], size: int = BATCH) -> DataFrame:
    """Consecutive batches in the given order, and no empty one at the end (Q18)."""
    return numbered(rows, order, "marl_ord").select(*rows.columns, F.floor(F.col("marl_ord") / size).cast("int").alias("batch"))


def file_state(state: Column) -> Column:
    """F8."""
    return F.when(state == "done", "done").when(state == "failed", "failed").when(state.isin(*WAITING), "waiting").otherwise("unknown")


def latest_states(polls: DataFrame, order: str = "ord") -> DataFrame:
    """B2: the last report on each file of a batch (matched by name: J8).  polls: batch_id,
    file_name, state, url, error and the order column."""
    last = F.max_by(F.struct("state", "url", "error"), order)
    return polls.groupBy("batch_id", "file_name").agg(last.alias("r")).select("batch_id", "file_name", file_state(F.col("r.state")).alias("state"), "r.url", "r.error")


def without_output(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """F9, SNK14: rows whose output isn't there yet."""
    return rows.join(done.select(key).distinct(), key, "left_anti")


def run_summary(results: DataFrame) -> DataFrame:
    """One row: total, successful, failed and the errors by file.  A file is counted
    once (Q19): failed if any of its phases failed.  results: file, phase, error."""
    files = results.groupBy("file").agg(F.max_by("phase", F.when(F.col("error").isNotNull(), F.struct("phase", "error"))).alias("phase"), F.max("error").alias("error"))
    return files.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("error").isNull()).alias("successful"), F.count_if(F.col("error").isNotNull()).alias("failed"))


def run_errors(results: DataFrame) -> DataFrame:
    """The error table beside the summary."""
    return results.filter(F.col("error").isNotNull()).select("file", "phase", "error")


def safe_members(data: bytes | None) -> list[tuple[str, bytes]]:
    """SNK15: members of a ZIP that stay inside its folder; none of what isn't a ZIP."""
    try:
        archive = zipfile.ZipFile(io.BytesIO(data or b""))
    except zipfile.BadZipFile:
        return []
    found = []
    for info in archive.infolist():
        name = posixpath.normpath(info.filename.replace("\\", "/"))
        if not info.is_dir() and not name.startswith(("/", "..")) and ":" not in name.split("/")[0]:
            found.append((name, archive.read(info)))
    return found


def unzipped(content: Column) -> Column:
    """SNK15, SNK16: ``array<struct<name, content>>``."""
    kind = pa.list_(pa.struct([("name", pa.string()), ("content", pa.binary())]))

    @F.arrow_udf("array<struct<name:string,content:binary>>")
    def run(zips: pa.Array) -> pa.Array:
        return pa.array(([{"name": n, "content": c} for n, c in safe_members(z.as_py())] for z in zips), kind)

    return run(content)


def retried(call: Callable, tries: int, wait: Callable[[int], float], sleep: Callable[[float], None]):
    """The result of ``call`` and no error, or nothing and the last error; before try k + 1
    it waits ``wait(k)`` seconds."""
    why = None
    for k in range(tries):
        if k:
            sleep(wait(k))
        try:
            return call(), None
        except Exception as e:  # a service's failure is a result
            why = str(e) or type(e).__name__
    return None, why


class Parser(Protocol):
    """A parsing service.  ``upload`` takes contents by file name and returns the batch's id;
    ``poll`` returns state, address and error by file name; ``download`` returns a ZIP."""

    def upload(self, contents: dict[str, bytes]) -> str: ...

    def poll(self, batch: str) -> dict[str, tuple]: ...

    def download(self, url: str) -> bytes: ...


@dataclass(frozen=True)
class Settings:
    """How a service is asked.  Times in seconds."""

    tries: int = 3
    poll_interval: float = 5.0
    poll_timeout: float = 300.0
    download_gap: float = 1.0
    model_version: str = "vlm"
    language: str = "en"
    ocr: bool = True


def parse_documents(files: DataFrame, service: Parser, settings: Settings = Settings(), known: DataFrame | None = None, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> DataFrame:  # noqa: B008
    """B1-B3, B5, SNK13, SNK14, ST7: uploads in batches, polls each batch until all its files
    are at an end or the time is over, and downloads what is done.  Returns for each file (file,
    content) batch_id, state, phase (where it stopped), result and error.  Uploads and
    downloads are tried again after 2, 4 ... seconds and a gap; a poll that fails is only
    polled again.  One failing file stops no other.  ``known`` (file, batch_id, url) are files
    that were done before: they go on to the download.  The service runs on the executors, a
    batch in a task; the result is a checkpoint, so nothing is sent twice."""
    out_schema = pa.schema([("file", pa.string()), ("batch_id", pa.string()), ("state", pa.string()), ("phase", pa.string()), ("result", pa.binary()), ("error", pa.string())])
    shape = "file string, batch_id string, state string, phase string, result binary, error string"

    def polled(batch: str, names: list[str]) -> tuple[dict, str | None]:
        began, reports, why = clock(), {}, None
        while True:
            try:
                reports, why = {**reports, **service.poll(batch)}, None
            except Exception as e:  # it may answer the next time
                why = str(e) or type(e).__name__
            if all(reports.get(n, ("",))[0] in ENDED for n in names):
                return reports, None
            if clock() - began >= settings.poll_timeout:
                return reports, why or f"no end after {settings.poll_timeout:g} s"
            sleep(settings.poll_interval)

    def fetched(url: str | None):
        if not url:
            return None, "no address of a result"
        return retried(lambda: service.download(url), settings.tries, lambda k: settings.download_gap, sleep)

    def batches(rows: pa.Table) -> pa.Table:
        names = rows["file"].to_pylist()
        contents = dict(zip(names, rows["content"].to_pylist(), strict=True))
        given = {n: (b, u) for n, b, u in zip(names, rows["marl_batch_id"].to_pylist(), rows["marl_url"].to_pylist(), strict=True) if u}
        sent = {n: contents[n] for n in names if n not in given}
        batch, reports, failed, phase = None, {}, None, "upload"
        if sent:
            batch, failed = retried(lambda: service.upload(sent), settings.tries, lambda k: 2.0**k, sleep)
            if failed is None:
                phase = "poll"
                reports, failed = polled(batch, list(sent))
        out = []
        for name in names:
            if name in given:
                own, (state, url, why) = given[name][0], ("done", given[name][1], None)
            else:
                own, (state, url, why) = batch, (tuple(reports[name]) + (None, None))[:3] if name in reports else ("unknown", None, None)
            step, result = phase if name not in given else "poll", None
            if state == "done":
                step = "download"
                result, why = fetched(url)
            elif state in WAITING or state == "unknown":
                why = failed or why or "not reported"
            else:
                why = why or f"state {state}"
            out.append({"file": name, "batch_id": own, "state": state, "phase": step, "result": result, "error": why})
        return pa.Table.from_pylist(out, out_schema)

    none = F.lit(None).cast("string")
    own = files.select("file", "content")
    told = known.select("file", F.col("batch_id").alias("marl_batch_id"), F.col("url").alias("marl_url")) if known is not None else own.select("file", none.alias("marl_batch_id"), none.alias("marl_url")).limit(0)
    dealt = chunked(own.join(told, "file", "left"), ["file"])
    return cut(dealt.groupBy("batch").applyInArrow(batches, shape))


def has_result(results: DataFrame) -> DataFrame:
    """adds ``has_result``: without one, later steps leave the file alone."""
    return results.withColumn("has_result", F.col("result").isNotNull() & (F.octet_length("result") > 0))


def result_members(results: DataFrame) -> DataFrame:
    """B4, SNK15, SNK16: the files in each result (file, result): stem, of the parsed file,
    name (a path in the folder of that stem) and content.  The service's own name of the
    original gives way to the stem."""
    rows = has_result(results).filter("has_result").select(stem(F.col("file")).alias("stem"), unzipped(F.col("result")).alias("m"))
    rows = rows.select("stem", F.explode("m").alias("m")).select("stem", "m.name", "m.content")
    return rows.withColumn("name", F.regexp_replace("name", r"[^/]*(_origin\.pdf)$", F.concat(F.regexp_replace("stem", r"([\\$])", r"\\$1"), F.lit("$1"))))


def processed(results: DataFrame) -> DataFrame:
    """File and the flag ``processed``: whether a result came and is a ZIP with a member."""
    flag = F.size(unzipped(F.col("result"))) > 0
    return has_result(results).select("file", (F.col("has_result") & flag).alias("processed"))


def zipped(left: DataFrame, right: DataFrame, order: str) -> DataFrame:
    """Rows side by side by their place in the order of each side; as many as the
    shorter one has."""
    a, b = (numbered(x, [order], "marl_place").drop(order) for x in (left, right))
    return a.join(b, "marl_place").withColumnRenamed("marl_place", "place")
