"""Periodic runs of words (operator 12).

A run is a stretch of words that repeats with its smallest period q, ``times`` periods long
and ``least`` words at least, which no neighbouring word extends.  Words are numbered, and
the numbers are laid out as bit planes: one big integer for each bit of the numbers, with a
bit for each word of the text.  For a lag q, each plane is XORed with itself shifted by q
and the results are ORed: a zero then says that the words at i and i + q are equal.  Shifts
that double, ANDed, leave the places where enough equal words follow each other.

A text of n words has n / times lags, each of which costs n / 64 steps a plane.  Lags that
can't hold a run are therefore left out before, which loses none.  A run whose period q
lies between Q and 2Q (a power of two) holds a multiple p of Q early enough for the Q words
from p to occur again, inside the run, q words later; so for each Q the hash of the Q words
at every multiple of Q is compared with those at distances Q to 2Q, one comparison a word.
Where both lie in a known run whose period divides q they say nothing new, as two runs that
share so many words would be one.  Equal hashes only choose lags; the planes decide.

Defined results: a null text has no words; texts of fewer than ``least`` words have no run;
an empty word list collapses to the empty text; rows stand alone, so repeated rows get equal
results; of several strongest runs the earliest, then that of the smallest period is named;
an empty table gives no rows.  Columns are made by an expression over the text, so other
columns can't clash with anything.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chosen, table

#: A run's least length in words, and in periods.
LEAST, TIMES = 6, 4
_M = 0x9E3779B97F4A7C15


def planes_of(ids: np.ndarray) -> list[int]:
    """A big integer for each bit of the numbers; its bit i is that of word i."""
    return [int.from_bytes(np.packbits(((ids >> k) & 1).astype(np.uint8), bitorder="little").tobytes(), "little") for k in range(int(ids.max(initial=0)).bit_length())]


def stretches(planes: list[int], n: int, lag: int, need: int) -> list[tuple[int, int]]:
    """Start and end of each maximal stretch of ``need`` or more places i, one after the other,
    whose words equal those at i + lag."""
    differ = 0
    for plane in planes:
        differ |= plane ^ (plane >> lag)
    whole = (1 << (n - lag)) - 1
    same, have = whole ^ (differ & whole), 1
    while have < need and same:
        step = min(have, need - have)
        same &= same >> step
        have += step
    if not same:
        return []
    bits = np.unpackbits(np.frombuffer(same.to_bytes((n + 7) // 8, "little"), np.uint8), bitorder="little").astype(np.int8)
    edges = np.diff(bits, prepend=np.int8(0), append=np.int8(0))
    return list(zip(np.flatnonzero(edges == 1).tolist(), (np.flatnonzero(edges == -1) + need - 1).tolist(), strict=True))


def _open_lags(hashes: np.ndarray, q: int, found: dict) -> list[int]:
    """The lags from q to 2q - 1 that may hold a run, from the hashes of q words at each place."""
    if len(hashes) <= q:
        return []
    again = np.flatnonzero(hashes[q:] == np.repeat(hashes[::q], q)[: len(hashes) - q]) + q
    if not len(again):
        return []
    lags = again % q + q
    new = np.ones(len(again), bool)
    for (start, end), period in found.items():
        if end - start >= 2 * q:
            a, b = np.searchsorted(again, ((-(-start // q) + 1) * q, end - q + 1))
            new[a:b] &= lags[a:b] % period != 0
    return np.unique(lags[new]).tolist()


def runs_of(words: list, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """Start, length and period of every run, by start, then period."""
    if times < 3 or least < 1:
        raise ValueError("runs of three periods or more are found")
    n = len(words)
    numbers: dict = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    found: dict[tuple[int, int], int] = {}  # the period of each stretch
    planes: list[int] = []
    q, hashes, factor = 1, (ids.view(np.uint64) + np.uint64(1)) * np.uint64(_M), _M
    while q * times <= n and n >= least:
        for lag in _open_lags(hashes, q, found):
            if lag * times > n:
                break
            planes = planes or planes_of(ids) or [0]
            for start, end in stretches(planes, n, lag, max(1, max(least, times * lag) - lag)):
                found.setdefault((start, end + lag), lag)  # a smaller period came before
        factor = (factor * _M + 2) % 2**64  # another one each time
        hashes, q = hashes[:-q] * np.uint64(factor) + hashes[q:], 2 * q
    return sorted((start, end - start, period) for (start, end), period in found.items())


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without those that a run repeats: of each run its first period stays."""
    if not runs:
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()]


_RUN = "struct<start:bigint,length:bigint,period:bigint>"


def periodic(text: Column, least: int = LEAST, times: int = TIMES) -> Column:
    """``struct<n_words, runs, strongest, kept>`` of each text: all runs, that of the greatest
    length / period, and the collapsed words joined by a space."""

    @F.arrow_udf(f"struct<n_words:bigint,runs:array<{_RUN}>,strongest:{_RUN},kept:string>")
    def run(texts: pa.Array) -> pa.Array:
        one = pa.struct([(k, pa.int64()) for k in ("start", "length", "period")])
        n_words, all_runs, strongest, kept = [], [], [], []
        for x in texts.cast(pa.binary()):
            words = x.as_buffer().to_pybytes().split() if x.is_valid else []
            found = runs_of(words, least, times)
            runs = [{"start": s, "length": n, "period": q} for s, n, q in found]
            n_words.append(len(words))
            all_runs.append(runs)
            strongest.append(min(runs, key=lambda r: (-Fraction(r["length"], r["period"]), r["start"], r["period"]), default=None))
            kept.append(b" ".join(collapsed(words, found)))
        columns = [pa.array(n_words, pa.int64()), pa.array(all_runs, pa.list_(one)), pa.array(strongest, one), pa.array(kept, pa.string())]
        return pa.StructArray.from_arrays(columns, ["n_words", "runs", "strongest", "kept"])

    return run(text)


def _planted(text: Column, doc_id: Column) -> Column:
    """The query's own input: a tenth of the texts, chosen by their ids, are made periodic
    from some word on; a text with a null id is left as it is."""

    @F.arrow_udf("string")
    def run(texts: pa.Array, sums: pa.Array) -> pa.Array:
        made = []
        for x, h in zip(texts.cast(pa.binary()), sums.to_pylist(), strict=True):
            data = x.as_buffer().to_pybytes() if x.is_valid else b""
            if h is not None and h % 10 == 0 and (words := data.split()):
                g, n = h // 10, len(words)
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                data = b" ".join(words[:a] + [words[a + i % p] for i in range(n - a)])
            made.append(data)
        return pa.array(made, pa.string())

    return run(text, F.crc32(doc_id.cast("string").cast("binary")))


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = chosen(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text")
    made = docs.select("doc_id", periodic(_planted(F.col("text"), F.col("doc_id"))).alias("made")).select("doc_id", "made.*")
    told = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return made.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "strongest.*",
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", told), 256).alias("runs_sha256"),
        F.sha2("kept", 256).alias("collapsed_sha256"),
    )
