"""Parsed pages: block lists merged in order, titles, heading levels, markdown."""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .checkpoints import cut


def merged_blocks(*lists: Column) -> Column:
    """Several lists of blocks (structs with ``index``) as one, by index; equal
    indexes stay in the order of the lists."""
    whole = F.concat(*[F.coalesce(x, F.array()) for x in lists]) if len(lists) > 1 else lists[0]
    placed = F.transform(whole, lambda b, i: F.struct(b["index"].alias("at"), i.alias("i"), b.alias("b")))
    order = lambda x, y: F.when(x["at"] < y["at"], -1).when(x["at"] > y["at"], 1).when(x["i"] < y["i"], -1).otherwise(1)
    return F.transform(F.array_sort(placed, order), lambda p: p["b"])


def line_height(lines: Column, bbox: Column, known: Column) -> Column:
    """The height that is given, else the mean of the lines', else the box's."""
    height = lambda b: (F.get(b, F.lit(3)) - F.get(b, F.lit(1))).cast("int")
    heights = F.transform(lines, lambda line: height(line["bbox"]))
    mean = F.aggregate(heights, F.lit(0), lambda a, h: a + h) / F.size(heights)
    return F.coalesce(known.cast("double"), F.when(F.size(lines) > 0, mean), height(bbox).cast("double"))


def titles(blocks: DataFrame, document: str = "doc", page: str = "page_idx", index: str = "index", kind: str = "type") -> DataFrame:
    """Title blocks with their ordinal in the document and their page number from 1."""
    order = Window.partitionBy(document).orderBy(page, index)
    return blocks.filter(F.col(kind) == "title").withColumn("ordinal", F.row_number().over(order) - 1).withColumn("page_number", F.col(page) + 1)


def with_levels(rows: DataFrame, levels: DataFrame, document: str = "doc") -> DataFrame:
    """Levels (doc, ordinal, level) for titles (doc, ordinal), taken for a document only
    if both have equally many; else they stay null."""
    same = rows.groupBy(document).agg(F.count(F.lit(1)).alias("n_titles")).join(levels.groupBy(document).agg(F.count(F.lit(1)).alias("n_levels")), document).filter("n_titles = n_levels").select(document)
    return rows.join(levels.join(same, document, "left_semi"), [document, "ordinal"], "left")


def rule_levels(rows: DataFrame, height: str = "height", document: str = "doc", most: int = 4) -> DataFrame:
    """X5, B7 by rules: taller lines are higher levels, four at most, and going down no
    level is skipped.  Returns doc, ordinal, level."""
    rank = F.least(F.dense_rank().over(Window.partitionBy(document).orderBy(F.desc(height))), F.lit(most))
    ranked = rows.withColumn("wanted", rank).groupBy(document).agg(F.array_sort(F.collect_list(F.struct("ordinal", "wanted"))).alias("all"))  # titles of one document
    start = F.struct(F.lit(0).alias("last"), F.array().cast("array<struct<ordinal:int,level:int>>").alias("out"))

    def step(state, x):
        level = F.least(x["wanted"], state["last"] + 1)
        return F.struct(level.alias("last"), F.array_append(state["out"], F.struct(x["ordinal"].alias("ordinal"), level.alias("level"))).alias("out"))

    return ranked.select(document, F.explode(F.aggregate("all", start, step, lambda s: s["out"])).alias("r")).select(document, "r.ordinal", "r.level")


def parsed_levels(answer: str | None, n_titles: int) -> dict[int, int] | None:
    """Levels from a model's answer: what stands before ``</think>`` goes, then the first
    object counts, read tolerantly: comments, single quotes, bare keys, commas at the end and
    a missing end are forgiven.  Null unless it has whole numbers only and one entry for
    each title."""
    body = (answer or "").rpartition("</think>")[2]
    start = body.find("{")
    if start < 0:
        return None
    found: dict[int, int] = {}
    inside = re.sub(r"//[^\n]*|/\*.*?\*/", "", body[start + 1 :], flags=re.S).partition("}")[0]
    for part in inside.split(","):
        if not part.strip():
            continue
        entry = re.fullmatch(r"\s*['\"]?\s*(-?\d+)\s*['\"]?\s*:\s*['\"]?\s*(-?\d+)\s*['\"]?\s*", part)
        if not entry:
            return None
        found[int(entry[1])] = int(entry[2])
    return found if len(found) == n_titles else None


def provided_levels(rows: DataFrame, ask: Callable[[list[dict]], str], tries: int = 3, document: str = "doc") -> DataFrame:
    """Levels (doc, ordinal, level) from a provider that is asked once for each
    document with its titles (ordinal, text, height, page_number) in order, and again up to
    ``tries`` times while it fails or its answer can't be read.  A document without a usable
    answer has no rows, so its levels stay unset."""
    kind = rows.schema[document].dataType.simpleString()
    listed = rows.groupBy(document).agg(F.array_sort(F.collect_list(F.struct("ordinal", "text", "height", "page_number"))).alias("all"))  # titles of one document

    def run(batches):
        for batch in batches:
            take, ordinals, levels = [], [], []
            for i, own in enumerate(batch.column(1).to_pylist()):
                for _ in range(tries):
                    try:
                        found = parsed_levels(ask(own), len(own))
                    except Exception:  # a provider that fails is asked again
                        found = None
                    if found is not None:
                        break
                for ordinal, level in (found or {}).items():
                    take.append(i)
                    ordinals.append(ordinal)
                    levels.append(level)
            yield pa.record_batch({document: batch.column(0).take(pa.array(take, pa.int64())), "ordinal": pa.array(ordinals, pa.int32()), "level": pa.array(levels, pa.int32())})

    return cut(listed.select(document, "all").mapInArrow(run, f"{document} {kind}, ordinal int, level int"))


#: The kinds of blocks that a page shows, in the order in which they are put together.
SHOWN = ("image", "table", "code", "ref_text", "phonetic", "title", "text", "interline_equation", "list")


def page_infos(blocks: DataFrame, pages: DataFrame, document: str = "doc") -> DataFrame:
    """For each page of ``pages`` (doc, page_idx, width, height) its size and its
    blocks (doc, page_idx, index, type, text, level) by index: those that it shows, equal
    indexes in the order of ``SHOWN``, and apart from them those it discards."""
    at = F.array_position(F.array(*map(F.lit, SHOWN)), F.col("type"))
    block = F.struct("index", at.alias("at"), "type", "text", "level")
    lists = blocks.groupBy(document, "page_idx").agg(F.array_sort(F.collect_list(F.when(at > 0, block))).alias("shown"), F.array_sort(F.collect_list(F.when(at == 0, block))).alias("out"))
    plain = lambda xs: F.transform(F.coalesce(xs, F.array().cast(lists.schema["shown"].dataType.simpleString())), lambda b: F.struct(b["index"].alias("index"), b["type"].alias("type"), b["text"].alias("text"), b["level"].alias("level")))
    joined = pages.join(lists, [document, "page_idx"], "left")
    return joined.select(document, "page_idx", F.array("width", "height").alias("page_size"), plain(F.col("shown")).alias("para_blocks"), plain(F.col("out")).alias("discarded_blocks"))


def middle(infos: DataFrame, backend: str = "vlm", document: str = "doc") -> DataFrame:
    """One JSON text for each document, its pages in order; a table that goes on at the
    top of the next page (a page that begins with a table after one that ends with one) is
    joined to the one before, and leaves that page.  That goes for tables in plain text; those
    in markup are joined before, by their columns (``tables.joined_tables``)."""
    listed = infos.groupBy(document).agg(F.array_sort(F.collect_list(F.struct("page_idx", "page_size", "para_blocks", "discarded_blocks"))).alias("pages"))  # pages of one document
    kind = listed.schema["pages"].dataType.simpleString()

    def join(done, page):
        last = F.try_element_at(done, F.lit(-1))
        ends = F.when(F.size(done) > 0, F.when(F.size(last["para_blocks"]) > 0, F.try_element_at(last["para_blocks"], F.lit(-1))["type"]))
        begins = F.get(page["para_blocks"], F.lit(0))
        plain = ~F.lower(F.coalesce(begins["text"], F.lit(""))).contains("<table")  # markup is for ``tables.joined_tables``
        goes_on = F.coalesce((ends == "table") & (begins["type"] == "table") & plain, F.lit(False))
        whole = F.try_element_at(last["para_blocks"], F.lit(-1))
        longer = F.concat(
            F.slice(last["para_blocks"], F.lit(1), F.size(last["para_blocks"]) - 1),
            F.array(F.struct(whole["index"].alias("index"), whole["type"].alias("type"), F.concat_ws("\n", whole["text"], begins["text"]).alias("text"), whole["level"].alias("level"))),
        )
        make = lambda p, shown: F.struct(p["page_idx"].alias("page_idx"), p["page_size"].alias("page_size"), shown.alias("para_blocks"), p["discarded_blocks"].alias("discarded_blocks"))
        rest = F.slice(page["para_blocks"], F.lit(2), F.size(page["para_blocks"]))
        joined = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(make(last, longer), make(page, rest)))
        return F.when(goes_on, joined).otherwise(F.array_append(done, page)).cast(kind)

    pages = F.aggregate("pages", F.array().cast(kind), join)
    whole = F.struct(pages.alias("pdf_info"), F.lit(backend).alias("_backend"))
    return listed.select(document, F.to_json(whole, {"ignoreNullFields": "false"}).alias("middle"))


def rendered(blocks: DataFrame, document: str = "doc", page: str = "page_idx", index: str = "index", kind: str = "type", text: str = "text", level: str = "level") -> DataFrame:
    """A document's blocks as markdown, titles under their level (1 if unknown)."""
    marks = F.concat(F.repeat(F.lit("#"), F.coalesce(F.col(level), F.lit(1))), F.lit(" "))
    body = F.when(F.col(kind) == "title", F.concat(marks, F.col(text))).otherwise(F.col(text))
    parts = blocks.filter(F.col(text).isNotNull()).groupBy(document).agg(F.array_sort(F.collect_list(F.struct(F.col(page).alias("p"), F.col(index).alias("i"), body.alias("t")))).alias("parts"))
    return parts.select(document, F.array_join(F.transform("parts", lambda p: p["t"]), "\n\n").alias("markdown"))


def rendered_plain(blocks: DataFrame, document: str = "doc", **columns) -> DataFrame:
    """As ``rendered``, all titles on one level."""
    return rendered(blocks.withColumn("marl_level", F.lit(1)), document, level="marl_level", **columns)


#: How markdown is made: with the levels of titles, or without.
RENDERERS: dict[str, Callable[..., DataFrame]] = {"vlm": rendered, "pipeline": rendered_plain}


def with_image_dir(markdown: Column, folder: str, name: str = "images") -> Column:
    """B11."""
    return F.replace(markdown, F.lit(folder), F.lit(name))
