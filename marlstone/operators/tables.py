"""Tables that go on from page to page, as one."""

from __future__ import annotations

from dataclasses import dataclass
from html import escape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.html import Node, parsed
from .blocks import SHOWN


@dataclass
class Cell:
    text: str
    markup: str
    across: int
    down: int


def _markup(node: Node) -> str:
    """A node's contents as markup."""
    out = []
    for x in node.children:
        if isinstance(x, Node):
            attrs = "".join(f' {k}="{escape(v)}"' for k, v in x.attrs.items())
            out.append(f"<{x.name}{attrs}>{_markup(x)}</{x.name}>" if x.children or x.name not in ("br", "img", "hr") else f"<{x.name}{attrs}>")
        else:
            out.append(escape(x, quote=False))
    return "".join(out)


def _span(node: Node, name: str) -> int:
    told = node.attrs.get(name, "1").strip()
    return max(1, int(told)) if told.isdecimal() and len(told) < 5 else 1


class Table:
    """The rows of the first table in some markup, and the grid that their cells cover."""

    def __init__(self, html: str | None):
        own = next((n for n in parsed(html).walk() if n.name == "table"), None)
        rows = [n for n in own.walk() if n.name == "tr" and self._of(n) is own] if own else []
        self.headed = sum(all(x.name == "th" for x in r.children if isinstance(x, Node)) or r.parent.name == "thead" for r in rows)
        self.rows = [[(x.name, Cell(x.text(" "), _markup(x), _span(x, "colspan"), _span(x, "rowspan"))) for x in r.children if isinstance(x, Node) and x.name in ("td", "th")] for r in rows]
        self.grid = self._grid()
        self.width = max(map(len, self.grid), default=0)

    @staticmethod
    def _of(node: Node) -> Node | None:
        while node is not None and node.name != "table":
            node = node.parent
        return node

    def _grid(self) -> list[list[Cell | None]]:
        """For each row the cell that covers each column; a cell may come from a row above."""
        grid: list[list[Cell | None]] = [[] for _ in self.rows]
        for i, row in enumerate(self.rows):
            at = 0
            for _, cell in row:
                while at < len(grid[i]) and grid[i][at] is not None:
                    at += 1
                for down in range(min(cell.down, len(self.rows) - i)):
                    line = grid[i + down]
                    line += [None] * (at + cell.across - len(line))
                    line[at : at + cell.across] = [cell] * cell.across
                at += cell.across
        return grid

    def header_of(self, before: Table) -> int:
        """How many of the first rows say what the first rows of ``before`` say: its header, or
        one row where no header is marked; none if a cell of them reaches further down."""
        texts = lambda line: [c.text if c else "" for c in line]
        most, n = min(max(1, before.headed), len(self.grid), len(before.grid)), 0
        while n < most and texts(self.grid[n]) == texts(before.grid[n]):
            n += 1
        reaches = any(i + cell.down > n for i, row in enumerate(self.rows[:n]) for _, cell in row)
        return 0 if reaches else n

    def add(self, more: Table) -> None:
        """Takes over the rows of a table of as many columns, but for a repeated header."""
        self.rows += more.rows[more.header_of(self) :]
        self.grid = self._grid()

    def html(self) -> str:
        span = lambda name, n: f' {name}="{n}"' if n > 1 else ""
        one = lambda kind, c: f"<{kind}{span('colspan', c.across)}{span('rowspan', c.down)}>{c.markup}</{kind}>"
        return "<table>" + "".join("<tr>" + "".join(one(*x) for x in row) + "</tr>" for row in self.rows) + "</table>"


def table_columns(text: Column) -> Column:
    """How many columns the first table in a block's markup has; 0 without one."""

    @F.arrow_udf("int")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array((Table(x.as_py()).width if x.is_valid and "<t" in x.as_py().lower() else 0 for x in texts), pa.int32())

    return run(text)


def one_table(parts: Column) -> Column:
    """Tables of as many columns as one, the first one's header counting."""

    @F.arrow_udf("string")
    def run(lists: pa.Array) -> pa.Array:
        made = []
        for x in lists:
            first, *rest = map(Table, x.as_py())
            for more in rest:
                first.add(more)
            made.append(first.html())
        return pa.array(made, pa.string())

    return run(parts)


def joined_tables(blocks: DataFrame, document: str = "doc") -> DataFrame:
    """Blocks (doc, page_idx, index, type, text and others) in which a table that goes on
    over pages is one block, where it begins: a table that a page shows first goes on from
    one that the page before shows last if both have equally many columns.  Rows of repeated
    headers go.  Tables are markup; other blocks, and tables without it, stay as they are."""
    place = [document, "page_idx"]
    shown = blocks.filter(F.col("type").isin(*SHOWN))
    block = F.struct("index", "type", "text")
    pages = shown.groupBy(*place).agg(F.min_by(block, "index").alias("first"), F.max_by(block, "index").alias("last"), F.count(F.lit(1)).alias("n"))
    wide = lambda name: F.when(F.col(f"{name}.type") == "table", F.col(f"{name}.text"))
    pages = pages.withColumn("begins", table_columns(wide("first"))).withColumn("ends", table_columns(wide("last")))
    order = Window.partitionBy(document).orderBy("page_idx")  # pages of one document
    follows = (F.lag("page_idx").over(order) == F.col("page_idx") - 1) & (F.lag("ends").over(order) == F.col("begins")) & (F.col("begins") > 0)
    pages = pages.withColumn("goes_on", F.coalesce(follows, F.lit(False)))
    through = F.col("goes_on") & (F.col("n") == 1)
    pages = pages.withColumn("head", F.max(F.when(~through, F.col("page_idx"))).over(order.rowsBetween(Window.unboundedPreceding, -1)))
    tails = pages.filter("goes_on").select(document, "page_idx", "head", "first")
    lists = tails.groupBy(document, "head").agg(F.array_sort(F.collect_list(F.struct("page_idx", F.col("first.text").alias("text")))).alias("rest"))  # of one table
    heads = pages.select(document, F.col("page_idx").alias("head"), F.col("last.index").alias("index"), F.col("last.text").alias("text"))
    whole = heads.join(lists, [document, "head"]).select(document, F.col("head").alias("page_idx"), "index", one_table(F.concat(F.array("text"), F.transform("rest", lambda x: x["text"]))).alias("marl_text"))
    left = blocks.join(tails.select(*place, F.col("first.index").alias("index")), [*place, "index"], "left_anti")
    made = left.join(whole, [*place, "index"], "left").withColumn("text", F.coalesce("marl_text", "text"))
    return made.select(*blocks.columns)
