"""Quality rules with host-level verdicts (operator 9).

Each document is measured alone, in one pass over its whole text.  The failures of every
rule are then counted by host (``source``); a host's rate is shrunk towards the rates of
all hosts by a beta prior whose two parameters are fitted to those rates by moments.  A
host is rejected with all its documents if a shrunk rate lies ``DEVIATIONS`` of the prior's
standard deviations above the prior's mean, so it is out of line with the other hosts, and
is ``LEAST`` at least, so that most of what it has is bad.

Defined results: a null text counts as empty (no words, so it fails the base rules);
documents with a null host form a host of their own; repeated rows are measured and
counted as often as they occur; an empty table gives an empty result and no host.
Other columns of the input are never read; ``keep_good`` passes them through.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chosen, stored, table

#: Words in a window that counts as repeated.
WINDOW = 8
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
#: How far above the prior's mean, in its standard deviations, and at least how high the
#: shrunk rate of a rule's failures must be for a host to be rejected.
DEVIATIONS, LEAST = 2.0, 0.5
#: Host verdicts are dealt to so many salts, so that a host with a third of all rows isn't one group.
SALTS = 16
#: Bounds of the prior's weight, in documents.
LIGHTEST, HEAVIEST = 1.0, 10_000.0
#: The name under which a null host goes.
NO_HOST = "\x00"
_POWERS = [np.uint64(pow(0x9E3779B97F4A7C15, j + 1, 2**64)) for j in range(WINDOW)]


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` words found twice or more in this text."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    sums = np.zeros(n, np.uint64)
    for j in range(window):
        sums += ids[j : j + n] * _POWERS[j]
    order = np.argsort(sums, kind="stable")
    same = sums[order[1:]] == sums[order[:-1]]
    if not same.any():
        return 0
    maybe = order[np.concatenate((same, [False])) | np.concatenate(([False], same))].tolist()
    found = Counter(tuple(words[i : i + window]) for i in maybe)  # equal sums aren't yet equal words
    starts = np.array([i for i in maybe if found[tuple(words[i : i + window])] > 1], np.int64)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def measures(text: str) -> tuple[int, int, int, int, int]:
    data = text.encode()
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    return (
        len(words),
        len(text) - sum(data.count(x) for x in SPACES),
        sum(data.count(x) for x in SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measured(text: Column) -> Column:
    """A struct of the five measures of each text."""

    @F.arrow_udf("struct<" + ",".join(f"{x}:bigint" for x in MEASURES) + ">")
    def run(texts: pa.Array) -> pa.Array:
        rows = [measures(x.as_py() or "") for x in texts]
        return pa.StructArray.from_arrays([pa.array((r[i] for r in rows), pa.int64()) for i in range(len(MEASURES))], list(MEASURES))

    return run(text)


def rules(m: Column) -> dict[str, Column]:
    """Each rule's failure, from the struct of measures."""
    return {
        "short": m["n_words"] < 20,
        "repeats": 100 * m["n_repeat_words"] > 30 * m["n_words"],
        "symbols": 10 * m["n_symbols"] > 3 * m["n_words"],
        "odd_words": (m["word_chars"] > 14 * m["n_words"]) | (m["word_chars"] < 2 * m["n_words"]),
    }


def base_failed(m: Column) -> Column:
    found = rules(m)
    return found["short"] | found["repeats"]


def host_verdicts(rows: DataFrame, host: str, measure: str, deviations: float = DEVIATIONS, least: float = LEAST) -> DataFrame:
    """host, n, rejected and each rule's shrunk rate, one row for each host.  The prior is
    two numbers for each rule; nothing else comes to the driver."""
    found = rules(rows[measure])
    hosts = stored(
        rows.groupBy(F.coalesce(rows[host], F.lit(NO_HOST)).alias("host")).agg(F.count(F.lit(1)).alias("n"), *[F.sum(x.cast("long")).alias(k) for k, x in found.items()]),
        "hosts",
    )
    moments = hosts.agg(*[f(F.col(k) / F.col("n")).alias(f"{k}_{f.__name__}") for k in found for f in (F.avg, F.var_pop)]).first()
    shrunk, over = {}, []
    for k in found:
        mean, spread = moments[f"{k}_avg"] or 0.0, moments[f"{k}_var_pop"] or 0.0
        weight = min(HEAVIEST, max(LIGHTEST, mean * (1 - mean) / spread - 1)) if spread > 0 else HEAVIEST
        shrunk[k] = (F.col(k) + mean * weight) / (F.col("n") + weight)
        over.append(shrunk[k] >= max(least, mean + deviations * sqrt(mean * (1 - mean) / (weight + 1))))
    return hosts.select("host", "n", *[v.alias(f"{k}_rate") for k, v in shrunk.items()], reduce(lambda a, b: a | b, over).alias("rejected"))


def with_verdicts(rows: DataFrame, host: str, dealt_by: list[str], verdicts: DataFrame) -> DataFrame:
    """``rows`` with the struct column ``marl_host`` of its host's verdict.  The planner
    broadcasts the verdicts only under its threshold (they are a written table, so their
    size is known); beyond it, they are copied to each salt and joined by a shuffle."""
    small = stored(verdicts.select(F.col("host").alias("marl_key"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("marl_salt"), F.struct("rejected").alias("marl_host")), "verdicts")
    keyed = rows.withColumn("marl_key", F.coalesce(rows[host], F.lit(NO_HOST))).withColumn("marl_salt", F.pmod(F.xxhash64(*[rows[x] for x in dealt_by]), F.lit(SALTS)).cast("int"))
    return keyed.join(small, ["marl_key", "marl_salt"], "left").drop("marl_key", "marl_salt")


def quality_rules(docs: DataFrame, **limits) -> DataFrame:
    """doc_id, the measures, base_failed, host_rejected and kept of each row of ``docs``
    (doc_id, text, source)."""
    rows = stored(chosen(docs, doc_id="doc_id", host="source", text="text").select("doc_id", "host", measured(F.col("text")).alias("m")), "measures")
    joined = with_verdicts(rows, "host", ["doc_id", "m"], host_verdicts(rows, "host", "m", **limits))
    failed, rejected = base_failed(F.col("m")), F.col("marl_host.rejected")
    return joined.select("doc_id", *[f"m.{x}" for x in MEASURES], failed.alias("base_failed"), rejected.alias("host_rejected"), (~failed & ~rejected).alias("kept"))


def keep_good(docs: DataFrame, **limits) -> DataFrame:
    """The rows of ``docs`` that ``quality_rules`` keeps, with all their columns, of any type
    (maps too).  Rows are written with their measures, so each text is measured once."""
    own = docs["doc_id"].cast("string") if "doc_id" in docs.columns else F.lit(None).cast("string")
    rows = stored(docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("marl_row"), docs["source"].alias("marl_source"), own.alias("marl_id"), measured(docs["text"]).alias("marl_m")), "measured")
    verdicts = host_verdicts(rows.select("marl_source", "marl_m"), "marl_source", "marl_m", **limits)
    kept = with_verdicts(rows.filter(~base_failed(F.col("marl_m"))), "marl_source", ["marl_id", "marl_m"], verdicts).filter(~F.col("marl_host.rejected"))
    return kept.select("marl_row.*")


def quality_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdicts on ``documents``, where a host is a source's texts of one order of length
    (powers of two of their characters): those of the shortest texts are rejected."""
    docs = table(spark, sf_dir, "documents")
    size = F.length(F.bin(F.length(F.coalesce("text", F.lit(""))) + 1)) - 1
    rows = stored(docs.select(F.concat_ws("/", F.coalesce("source", F.lit(NO_HOST)), size.cast("string")).alias("host"), measured(F.col("text")).alias("m")), "measures")
    verdicts = host_verdicts(rows, "host", "m")
    rates = [F.round(c, 9).alias(c) for c in verdicts.columns if c.endswith("_rate")]
    return verdicts.select("host", "n", *rates, "rejected")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = quality_rules(table(spark, sf_dir, "documents"))
    return made.select("doc_id", *MEASURES, "base_failed", "kept")


_MEASURED_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, {host} AS host, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d
), words AS (
  SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM w
), starts AS (
  SELECT rid, i, lead(i, 7) OVER o AS last, w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o || ' ' ||
    lead(w, 3) OVER o || ' ' || lead(w, 4) OVER o || ' ' || lead(w, 5) OVER o || ' ' || lead(w, 6) OVER o ||
    ' ' || lead(w, 7) OVER o AS gram
  FROM words WINDOW o AS (PARTITION BY rid ORDER BY i)
), grams AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS n FROM starts WHERE last IS NOT NULL
), covered AS (
  SELECT rid, count(DISTINCT j) AS n_repeat_words
  FROM (SELECT rid, unnest(range(i, i + 8)) AS j FROM grams WHERE n > 1) GROUP BY rid
), lines AS (
  SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d
), dups AS (
  SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid
), m AS (
  SELECT d.rid, doc_id, host, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM d JOIN w USING (rid) LEFT JOIN dups USING (rid) LEFT JOIN covered USING (rid)
), f AS (
  SELECT *, n_words < 20 AS short, 100 * n_repeat_words > 30 * n_words AS repeats,
    10 * n_symbols > 3 * n_words AS symbols,
    word_chars > 14 * n_words OR word_chars < 2 * n_words AS odd_words
  FROM m
), hosts AS (
  SELECT host, rule, count(*) AS n, count(*) FILTER (WHERE failed) AS bad
  FROM (UNPIVOT (SELECT host, short, repeats, symbols, odd_words FROM f)
        ON short, repeats, symbols, odd_words INTO NAME rule VALUE failed)
  GROUP BY host, rule
), prior AS (
  SELECT rule, avg(bad / n) AS mean, var_pop(bad / n) AS spread FROM hosts GROUP BY rule
), weighed AS (
  SELECT rule, mean, CASE WHEN spread > 0 THEN
    least(10000, greatest(1, mean * (1 - mean) / spread - 1)) ELSE 10000 END AS weight
  FROM prior
), shrunk AS (
  SELECT host, n, rule, (bad + mean * weight) / (n + weight) AS rate,
    greatest(0.5, mean + 2.0 * sqrt(mean * (1 - mean) / (weight + 1))) AS most
  FROM hosts JOIN weighed USING (rule)
), verdict AS (
  SELECT host, bool_or(rate >= most) AS rejected FROM shrunk GROUP BY host
)
"""
OP9_SQL = (
    _MEASURED_SQL.replace("{host}", "coalesce(source, chr(0))")
    + """
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  short OR repeats AS base_failed, NOT (short OR repeats) AND NOT rejected AS kept
FROM f JOIN verdict USING (host)
"""
)
HOSTS_SQL = (
    _MEASURED_SQL.replace("{host}", "coalesce(source, chr(0)) || '/' || CAST(length(bin(length(coalesce(text, '')) + 1)) - 1 AS VARCHAR)")
    + """
SELECT host, n, """
    + ", ".join(f"round(max(rate) FILTER (WHERE rule = '{k}'), 9) AS {k}_rate" for k in ("short", "repeats", "symbols", "odd_words"))
    + """, rejected
FROM shrunk JOIN verdict USING (host) GROUP BY host, n, rejected
"""
)
