"""Keyed logs: what appears when, what a lookup reads, and merges."""

import random

import pytest
from pyspark.sql import functions as F

from marlstone.operators import dedupe
from marlstone.operators.ledger import Ledger, Log
from marlstone.plans.collect import ATTEMPT, PAGE, Catalog

LOGS = {"a": Log("k string, v int", "k", lambda rows: dedupe.last_by(rows, ["k"], ["at"])), "b": Log("k string, v int", "k")}


def frame(spark, rows, kind="k string, v int"):
    return spark.createDataFrame(rows, kind)


def files_read(df):
    """Files that a frame's scans open, after it has run without adaptive plans."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    nodes = [leaves.apply(i) for i in range(leaves.size())]
    return sum(n.metrics().apply("numFiles").value() for n in nodes if n.metrics().contains("numFiles"))


def test_a_commit_appears_whole(spark, tmp_path, monkeypatch):
    ledger = Ledger(spark, f"{tmp_path}/l", LOGS)
    assert ledger.read("a").count() == 0 and ledger.commits() == []
    ledger.commit({"a": frame(spark, [("x", 1)]), "b": frame(spark, [("x", 1)])})
    written = ledger._write

    def dies(name, rows, commit):
        if name == "b":
            raise OSError("lost")
        written(name, rows, commit)

    monkeypatch.setattr(ledger, "_write", dies)
    with pytest.raises(OSError):
        ledger.commit({"a": frame(spark, [("x", 2), ("y", 2)]), "b": frame(spark, [("y", 2)])})
    monkeypatch.setattr(ledger, "_write", written)
    assert [tuple(r)[:2] for r in ledger.read("a").collect()] == [("x", 1)] and ledger.read("b").count() == 1
    ledger.commit({"a": frame(spark, [("z", 3)]), "b": frame(spark, [])})  # takes the place of what was left
    assert sorted(tuple(r)[:2] for r in ledger.read("a").collect()) == [("x", 1), ("z", 3)] and ledger.read("b").count() == 1


def test_lookups_read_their_buckets(spark, tmp_path):
    ledger = Ledger(spark, f"{tmp_path}/l", LOGS, buckets=32)
    for n in range(2):
        ledger.commit({"a": spark.range(400).select(F.concat(F.lit("k"), "id").alias("k"), F.lit(n).alias("v"))})
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        one = ledger.read("a", frame(spark, [("k7",), ("k7",), ("none",)], "k string"))
        assert sorted(r["v"] for r in one.collect()) == [0, 1]
        whole, few = files_read(ledger.read("a")), files_read(one)
        assert whole == 64 and few <= 4  # two commits of one or two buckets
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_merges_change_nothing(spark, tmp_path):
    rng, rows = random.Random(2), {}
    ledger = Ledger(spark, f"{tmp_path}/l", LOGS, buckets=4, fan=3)
    for n in range(10):
        new = {f"k{rng.randrange(12)}": n for _ in range(5)}
        rows |= new
        ledger.commit({"a": frame(spark, list(new.items())), "b": frame(spark, [("all", n)])})
    assert ledger.commits() == [(1, 9), (10, 10)]
    assert {r["k"]: r["v"] for r in dedupe.last_by(ledger.read("a"), ["k"], ["at"]).collect()} == rows
    assert sorted(r["v"] for r in ledger.read("b").collect()) == list(range(10))
    assert len(ledger._names("a")) <= 5  # older commits were deleted


def test_merged_states(spark, tmp_path):
    """States that keep their last success, and cleared pages, are the same with merges and without."""
    got = []
    for fan in (100, 2):
        catalog = Catalog(spark, f"{tmp_path}/c{fan}", fan=fan, buckets=2)
        for k, (status, slug) in enumerate([("success", "s"), ("failed", None), ("failed", None), ("success", None)]):
            catalog.append("attempts", spark.createDataFrame([("u", status, f"t{k}", f"t{k}" if status == "success" else None, slug, None if slug else f"e{k}"), (f"v{k}", "failed", "t", None, None, "e")], ATTEMPT))
        catalog.append("pages", spark.createDataFrame([("x", 1, 20, "t"), ("x", 2, 20, "t"), ("y", 1, 3, "t")], PAGE))
        catalog.append("pages", spark.createDataFrame([("x", None, None, None)], PAGE))
        catalog.append("pages", spark.createDataFrame([("x", 1, 5, "t")], PAGE))
        got.append((sorted(map(str, catalog.attempts().collect())), sorted(map(str, catalog.pages().collect())), [catalog.resume_page(a) for a in "xyz"]))
        assert (len(catalog.commits()) == 7) == (fan == 100)
    assert got[0] == got[1] and got[0][2] == [2, 2, 1] and len(got[0][0]) == 5 and len(got[0][1]) == 2
    assert [r["article_slug"] for r in catalog.attempts(spark.createDataFrame([("u",)], "url string")).collect()] == ["s"]
