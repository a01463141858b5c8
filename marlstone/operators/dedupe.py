"""Keeping the first of equals, inverted indexes, and greedy dedupe by several keys."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .checkpoints import cut
from .components import components


def first_by(rows: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key.  The columns go through one aggregate, which
    works ahead of the shuffle, so a hot key sends a row from each task only."""
    rest = [c for c in rows.columns if c not in keys]
    place = [F.col(o) if isinstance(o, str) else o for o in order]
    first = rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*place)).alias("kept")) if rest else rows.select(*keys).distinct()
    return first.select(*keys, "kept.*").select(*rows.columns) if rest else first


def last_by(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """A4, SNK6, SNK8: the last row of each key."""
    rest = [c for c in rows.columns if c not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("kept"))
    return last.select(*keys, "kept.*").select(*rows.columns)


def key_index(rows: DataFrame, id_column: str, keys: str, order: str) -> DataFrame:
    """Key -> the first record that has it.  Exploded with empty lists, which are dropped
    after: an inner explode would have the lists made twice more, to filter by them first."""
    pairs = rows.select(id_column, order, F.explode_outer(keys).alias("dup_key")).filter("dup_key is not null")
    return pairs.groupBy("dup_key").agg(F.min_by(id_column, order).alias("first_id"))


def existing_match(rows: DataFrame, index: DataFrame, id_column: str, keys: str) -> DataFrame:
    """For each row the smallest record of the index that shares any key; rows
    without one have null."""
    pairs = rows.select(id_column, F.explode_outer(keys).alias("dup_key")).join(index, "dup_key", "left")
    return pairs.groupBy(id_column).agg(F.min("first_id").alias("duplicate_of"))


#: Rows with their keys of a component that one task goes through by itself, at most; and the
#: rounds before components are looked for.
ALONE, FEW = 200_000, 2


def greedy_leaders(rows: DataFrame, id_column: str, keys: str, alone: int = ALONE) -> DataFrame:
    """Walks the rows by id; a row is kept if it shares no key with a kept row before
    it, and a rejected row's keys count for nothing.  Returns id and leader (itself, if
    kept; else the smallest kept row that shares a key; Q10).

    A round decides the rows that are the smallest of all their keys and those that share
    a key with them, and from the second round on all that hang on these by rows with a
    single smaller neighbour: such a row is kept if its neighbour isn't, so pointers that
    double tell from the parity of its distance, and a chain of n conflicts takes log n steps.  What is left after ``FEW`` rounds falls into
    components of conflicts, and those of up to ``alone`` pairs are walked each in one task.
    Larger ones take further rounds, each of which decides a row at least, until none is
    left: there is no cap."""
    pairs = cut(rows.select(F.col(id_column).alias("id"), F.explode_outer(keys).alias("k")).distinct())
    open_ = pairs.filter("k is not null")
    kept, rounds = [pairs.filter("k is null").select("id").join(open_, "id", "left_anti")], 0
    while open_.head(1):
        nodes, waiting = _blockers(open_)
        lead = nodes.filter("low is null").select("id")
        if rounds:  # most conflicts are over after the first round
            lead = lead.unionByName(_by_parity(nodes.filter("low = high and not many").select("id", F.col("low").alias("parent")), lead))
        kept.append(lead)
        rounds += 1
        if not waiting:
            break
        taken = open_.join(lead, "id", "left_semi").select("k").distinct()
        out = open_.join(taken, "k", "left_semi").select("id").unionByName(lead).distinct()
        open_ = cut(open_.join(out, "id", "left_anti"))
        if rounds == FEW and open_.head(1):
            walked, open_ = _walked(open_, alone)
            kept.append(walked)
    leaders = kept[0]
    for more in kept[1:]:
        leaders = leaders.unionByName(more)
    owner = pairs.join(leaders, "id", "left_semi").filter("k is not null").groupBy("k").agg(F.min("id").alias("owner"))
    found = pairs.join(owner, "k", "left").groupBy("id").agg(F.min("owner").alias("owner"))
    return found.select(F.col("id").alias(id_column), F.coalesce("owner", "id").alias("leader"))


def _blockers(pairs: DataFrame):
    """Of each row the smaller rows that share a key with it: the least of all keys' firsts
    (``low``, null without a smaller row) and the greatest (``high``), and whether any key has
    ``many``; and whether any row has smaller ones.  Firsts and seconds of a key are
    aggregates, so a key of any number of rows needs no task to itself."""
    firsts = pairs.groupBy("k").agg(F.min("id").alias("one"))
    own = pairs.join(firsts, "k")
    seconds = own.filter("id > one").groupBy("k").agg(F.min("id").alias("two"))
    before = F.when(F.col("id") > F.col("one"), F.col("one"))
    nodes = own.join(seconds, "k", "left").groupBy("id").agg(F.min(before).alias("low"), F.max(before).alias("high"), F.bool_or(F.coalesce(F.col("id") > F.col("two"), F.lit(False))).alias("many"))
    nodes = cut(nodes)
    return nodes, bool(nodes.filter("low is not null").head(1))


def _by_parity(pointers: DataFrame, lead: DataFrame) -> DataFrame:
    """The rows (id, parent) that are kept, as their chain of parents begins at a row that
    leads, an even number of steps away."""
    at = cut(pointers.withColumn("odd", F.lit(True)).withColumn("moved", F.lit(True)))
    while at.filter("moved").head(1):
        ahead = at.select(F.col("id").alias("parent"), F.col("parent").alias("next"), F.col("odd").alias("more"))
        moved = F.col("next").isNotNull()
        at = cut(at.join(ahead, "parent", "left").select("id", F.coalesce("next", "parent").alias("parent"), F.when(moved, F.col("odd") != F.col("more")).otherwise(F.col("odd")).alias("odd"), moved.alias("moved")))
    return cut(at.filter("not odd").join(lead.select(F.col("id").alias("parent")), "parent", "left_semi").select("id"))


def _walked(pairs: DataFrame, alone: int) -> tuple[DataFrame, DataFrame]:
    """The kept rows of small components of conflicts, and the pairs of the large ones."""
    kind = pairs.schema["id"].dataType.simpleString()
    firsts = pairs.groupBy("k").agg(F.min("id").alias("b"))
    whole = components(pairs.join(firsts, "k").select(F.col("id").alias("a"), "b"))
    own = cut(pairs.join(whole, "id").select("root", "id", "k"))
    large = own.groupBy("root").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > alone).select("root")
    small = own.join(large, "root", "left_anti")

    def walk(frame: pd.DataFrame) -> pd.DataFrame:
        taken: set = set()
        kept = []
        for one, keys in frame.groupby("id", sort=True)["k"]:
            if taken.isdisjoint(keys):
                taken.update(keys)
                kept.append(one)
        return pd.DataFrame({"id": kept})

    return cut(small.groupBy("root").applyInPandas(walk, f"id {kind}")), cut(own.join(large, "root", "left_semi").select("id", "k"))
