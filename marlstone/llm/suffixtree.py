"""Substring dedup over words by prefix-partitioned suffix trees (operator 2).

Suffixes are split by prefixes of variable length, in two steps.  ``repeats`` splits those of
the whole corpus between tasks: the suffix at a window's anchor goes by its first ``GRAM``
words, and where too many different ones share these, by the whole window.  Within a portion
of such groups, ``prefix_groups`` gives each suffix the shortest prefix that ``SUBTREE``
suffixes or fewer share, one word longer at a time and only where a group is still too large.

The suffixes under one prefix make a subtree of bounded size: they are sorted to their ends,
the common prefixes of neighbours are taken, and a stack over these gives the internal nodes,
each with its depth and the range of its leaves.  A node as deep as a window or deeper whose
leaves don't all follow the same word is a maximal repeat: its leaves are the occurrences, its
depth their length.  Windows inside occurrences of maximal repeats are those that occur
elsewhere; equal ones lie under the same topmost node of that depth.

Words are ``[^\\x20\\x09-\\x0D]+``.  Defined results: a null, empty or blank text has no
words; texts shorter than a window are kept whole; equal rows are copies of each other, so
with a window's length they are removed wholly; a null id is carried through; an empty
table gives no rows; other columns are never read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import table
from .repeats import Units, by_document, covered, own_columns, removed

#: Words in a window, and in the grams whose least hash keys it.
WINDOW, GRAM = 35, 10
#: Suffixes in a subtree, and in the subtrees that are built at once.
SUBTREE, TOGETHER = 1024, 16_384


def prefix_groups(ids: np.ndarray, suffixes: np.ndarray, window: int, limit: int = SUBTREE):
    """Splits suffixes of ``ids`` by variable-length prefixes, each as long as it takes to
    leave ``limit`` suffixes or fewer, and the window at most.  Yields a length and the
    suffixes of whole subtrees under prefixes of that length, ``TOGETHER`` of them or one
    subtree at a time."""
    left, prefix, words = suffixes, ids[suffixes], int(ids.max(initial=0)) + 1
    for length in range(1, window + 1):
        _, prefix, sizes = np.unique(prefix, return_inverse=True, return_counts=True)
        fits = sizes[prefix] <= limit if length < window else np.ones(len(left), bool)
        done = np.flatnonzero(fits)
        done = done[np.argsort(prefix[done], kind="stable")]
        bounds = np.cumsum(sizes[np.unique(prefix[done])])
        at = 0
        while at < len(done):
            k = np.searchsorted(bounds, at + TOGETHER, side="right")
            end = int(bounds[k - 1] if k and bounds[k - 1] > at else bounds[k])
            yield length, left[done[at:end]]
            at = end
        left, prefix = left[~fits], prefix[~fits].astype(np.int64)
        if not len(left):
            return
        prefix = prefix * words + ids[left + length]


class Subtrees:
    """The subtrees of some suffixes of ``ids``, each of which goes on to its ``ends``."""

    def __init__(self, ids: np.ndarray, suffixes: np.ndarray, ends: np.ndarray):
        lengths = ends - suffixes
        at = np.arange(int(lengths.max(initial=0)))
        inside = at < lengths[:, None]
        rows = np.where(inside, ids[np.where(inside, suffixes[:, None] + at, 0)], -1).astype(np.int32)
        order = np.argsort(rows.view(f"V{4 * max(1, rows.shape[1])}").ravel(), kind="stable") if rows.size else np.arange(len(rows))
        rows, lengths = rows[order], lengths[order]
        #: The suffixes in order, and of each two neighbours the length of their common prefix.
        self.leaves = suffixes[order]
        differ = rows[1:] != rows[:-1]
        common = np.where(differ.any(1), differ.argmax(1), rows.shape[1]) if rows.size else np.zeros(0, np.int64)
        self.common = np.minimum(common, np.minimum(lengths[1:], lengths[:-1]))

    def nodes(self, least: int = 1) -> np.ndarray:
        """Depth, first and last leaf of every internal node of that depth at least, inner ones
        before outer ones."""
        made, open_ = [], []
        places = np.flatnonzero(self.common >= least)
        ends = np.append(np.diff(places) > 1, True) if len(places) else ()  # where no node goes on
        for i, depth, last in zip(places.tolist(), self.common[places].tolist(), ends, strict=True):
            first = i
            while open_ and open_[-1][0] > depth:
                deeper, first = open_.pop()
                made.append((deeper, first, i))
            if not open_ or open_[-1][0] < depth:
                open_.append((depth, first))
            if last:
                made += [(d, f, i + 1) for d, f in reversed(open_)]
                open_.clear()
        return np.array(made, np.int64).reshape(-1, 3)

    def maximal(self, nodes: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Those of the nodes whose leaves follow different words; ``before``: the word before
        each leaf, of its own kind where there is none."""
        changes = np.concatenate(([0], np.cumsum(before[1:] != before[:-1]))) if len(before) else np.zeros(1, np.int64)
        return nodes[changes[nodes[:, 2]] > changes[nodes[:, 1]]]


def topmost(nodes: np.ndarray) -> np.ndarray:
    """The nodes that lie in no other one of them."""
    order = nodes[np.lexsort((-nodes[:, 2], nodes[:, 1]))]
    reach = np.maximum.accumulate(np.concatenate(([-1], order[:-1, 2])))
    return order[order[:, 2] > reach]


def solve(contents: list[bytes], counts: np.ndarray, window: int = WINDOW, limit: int = SUBTREE) -> list[np.ndarray]:
    """For each window of each record the number of its node, the topmost one of the window's
    depth at least, or -1 if these records have it once."""
    lists = [c.split() for c in contents]
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for words in lists for w in words], np.int64)
    sizes = np.array([len(words) for words in lists])
    offsets = np.cumsum(sizes) - sizes
    starts = np.repeat(offsets, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    ends = np.repeat(offsets + sizes, sizes)  # of the record of each word
    before = np.concatenate(([0], ids[:-1])) if len(ids) else ids
    before[offsets[sizes > 0]] = -1 - np.arange(int((sizes > 0).sum()))  # unlike any other
    node, nodes = np.full(len(ids), -1, np.int64), 0
    covered_ = np.zeros(len(ids) + 1, np.int64)
    for _, suffixes in prefix_groups(ids, starts, window, limit):
        trees = Subtrees(ids, suffixes, ends[suffixes])
        deep = trees.nodes(window)
        for k, (_, first, last) in enumerate(topmost(deep).tolist()):
            node[trees.leaves[first : last + 1]] = nodes + k
        nodes += len(deep)
        for depth, first, last in trees.maximal(deep, before[trees.leaves]).tolist():
            found = trees.leaves[first : last + 1]  # each a place of its own
            covered_[found] += 1
            np.subtract.at(covered_, found + depth - window + 1, 1)
    node[np.cumsum(covered_[:-1]) == 0] = -1
    return [node[o : o + n] for o, n in zip(offsets.tolist(), counts.tolist(), strict=True)]


def deduplicated(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, text: bool = True, **limits) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, with ``text``, kept_text of each row of
    ``docs`` (doc_id, text)."""
    units = Units(window, min(gram, window), words=True)
    docs = own_columns(docs)

    def finish(batches):
        for batch in batches:
            rows = batch.to_pylist()
            out = {"h1": [], "h2": [], "n_words": [], "n_removed": [], "kept_sha256": [], "kept_text": []}
            for r in rows:
                words = r["text"].encode().split()
                low, high = covered(r["found"], r["n"], len(words), window)
                kept, at = [], 0
                for a, b in zip(low.tolist(), high.tolist(), strict=True):
                    kept += words[at:a]
                    at = b
                kept = b" ".join(kept + words[at:])
                for c, v in zip(out, (r["h1"], r["h2"], len(words), int((high - low).sum()), hashlib.sha256(kept).hexdigest(), kept.decode() if text else None), strict=True):
                    out[c].append(v)
            yield pa.record_batch({c: pa.array(v, pa.int64() if c[0] in "hn" else pa.string()) for c, v in out.items()})

    per_text = removed(docs, units, lambda *x: solve(*x, window=window), **limits).mapInArrow(finish, "h1 bigint, h2 bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept_text string")
    columns = ["doc_id", "n_words", "n_removed", "kept_sha256", *["kept_text"] * text]
    return by_document(docs, per_text).select(*columns)


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(table(spark, sf_dir, "documents"), text=False)
