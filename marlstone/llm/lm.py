"""A hidden Markov language model (operator 4).

Training documents give a table of token counts.  Its most frequent tokens (a bounded
number) are symbols of their own; every other token is one of a few shape symbols, times
its own probability within that shape.  Baum-Welch trains latent states over symbols:
each task runs scaled forward-backward recursions over its documents and emits expected
counts, Spark adds them up by symbol, and the driver gets the sums, whose number is bounded
by symbols times states.  The scaled forward recursion over the whole token sequence then
gives a document's exact likelihood under the trained model.

Training and scores both take whole documents.  One longer than ``STRETCH`` tokens is worked
on in stretches: the product of a stretch's steps is a matrix of states by states, and these
carry the exact forward and backward vectors over every cut.  Counts outside a bounded
dictionary are joined by token, never broadcast.

Defined results: a null or empty text is its end token alone; a null id counts as
training; without training tokens every score is that of the smoothing alone; repeated
rows are counted and scored each; an empty table gives no rows; other columns are never
read.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chosen, crc_mod, stored, table

#: Latent states, tokens that are symbols, and Baum-Welch rounds.
STATES, SYMBOLS, ROUNDS = 4, 8192, 3
#: Tokens whose counts every task holds; longer ones than LONGEST bytes go by a digest there.
DICTIONARY, LONGEST = 65_536, 64
#: Tokens of a stretch, and steps of all sequences that are worked on at once.
STRETCH, CELLS = 512, 1 << 19
#: Distinct tokens that a counting task holds before it passes them on.
FLUSH = 250_000
SHAPES = 32
#: Weight of the symbol shares that smooth each state's emissions, in tokens.
SMOOTH = 10.0
SEED = 11
END = b""  # no word is empty


def words_of(text: str | None) -> list[bytes]:
    """The text's words, then its end token."""
    return [*(text or "").encode().lower().split(), END]  # bytes: only A-Z change


def name_of(word: bytes) -> bytes:
    """How the dictionary names a token: itself, or a digest after a space, which no token has."""
    return word if len(word) <= LONGEST else b" " + hashlib.sha256(word).hexdigest()[:32].encode()


def shape_of(word: bytes) -> int:
    """A class by length, non-ASCII bytes, a last byte that is no letter or digit, and digits."""
    n = len(word)
    return (0 if n < 4 else 1 if n < 8 else 2 if n < 12 else 3) + (0 if word.isascii() else 4) + (0 if word[-1:].isalnum() or word[-1] > 127 else 8) + (16 if any(48 <= c < 58 for c in word) else 0)


def token_counts(texts: DataFrame) -> DataFrame:
    """token, shape and c over the column ``text``; added up in each task, then by token."""

    def count(batches):
        found: Counter = Counter()

        def out():
            words = [w for w in found if w is not END and w]
            shapes = [shape_of(w) for w in words]
            counts = [found[w] for w in words]
            if END in found:
                words, shapes, counts = [*words, END], [*shapes, -1], [*counts, found[END]]
            return pa.record_batch({"token": pa.array(words, pa.binary()).cast(pa.string()), "shape": pa.array(shapes, pa.int32()), "c": pa.array(counts, pa.int64())})

        for batch in batches:
            for text in batch.column(0):
                found.update(words_of(text.as_py()))
                if len(found) >= FLUSH:
                    yield out()
                    found.clear()
        if found:
            yield out()

    return texts.mapInArrow(count, "token string, shape int, c bigint").groupBy("token", "shape").agg(F.sum("c").alias("c"))


class Vocabulary:
    """What every task needs of the counts: the dictionary, its symbols, and the shapes' totals."""

    def __init__(self, rows: list[tuple[str, int, int]], n: int, v: int, shapes: dict[int, tuple[int, int]], symbols: int):
        """rows: a token's name, shape and count, most frequent first.  shapes: count and number of all tokens."""
        self.index = {END: 0} | {t.encode(): i + 1 for i, (t, _, _) in enumerate(rows)}
        counts = np.array([0, *(c for _, _, c in rows)], np.int64)
        self.counts = counts
        own = min(symbols, len(rows))
        self.n_symbols = 1 + own + SHAPES
        self.kind = "<u2" if self.n_symbols <= 1 << 16 else "<u4"
        self.first_shape = 1 + own
        self.symbol = np.array([0, *range(1, own + 1), *(self.first_shape + s for _, s, _ in rows[own:])], np.int64)
        mass, types = np.zeros(SHAPES), np.zeros(SHAPES)
        for s, (c, k) in shapes.items():
            if s >= 0:
                mass[s], types[s] = c, k
        for _, s, c in rows[:own]:
            mass[s] -= c
            types[s] -= 1
        self.log_shape = np.log10(mass + types + 1)  # (c + 1) / (mass + types + 1): one type stands for all unseen ones
        self.share = np.concatenate((np.array([0.0]), counts[1 : own + 1], mass))
        self.n, self.v = n, v

    def with_end(self, c: int) -> Vocabulary:
        self.counts[0] = self.share[0] = c
        self.share = (self.share + 1) / (self.share.sum() + len(self.share))
        self.log_count = np.log10(self.counts + 1)
        self.log_total = float(np.log10(self.n + (self.v + 1)))
        return self


def vocabulary(counts: DataFrame, symbols: int = SYMBOLS, dictionary: int = DICTIONARY) -> Vocabulary:
    shapes = {r["shape"]: (r["c"], r["k"]) for r in counts.groupBy("shape").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("k")).collect()}  # SHAPES rows and the end token
    name = F.when(F.octet_length("token") <= LONGEST, F.col("token")).otherwise(F.concat(F.lit(" "), F.substring(F.sha2(F.col("token").cast("binary"), 256), 1, 32)))
    usable = counts.filter(F.col("shape") >= 0).select(name.alias("token"), "shape", "c")
    # by powers of two of the count, those that the dictionary can reach; so no task passes on more than it must
    levels = sorted(((r["level"], r["k"]) for r in usable.groupBy(F.floor(F.log2("c")).cast("int").alias("level")).agg(F.count(F.lit(1)).alias("k")).collect()), reverse=True)
    reach = next((level for i, (level, _) in enumerate(levels) if sum(k for _, k in levels[: i + 1]) >= dictionary), 0)
    # written first: a limit that is collected directly would send as many rows from each partition
    top = stored(usable.filter(F.floor(F.log2("c")) >= reach).orderBy(F.desc("c"), "token").limit(dictionary), "dictionary").orderBy(F.desc("c"), "token").collect()
    made = Vocabulary([(r["token"], r["shape"], r["c"]) for r in top], sum(c for c, _ in shapes.values()), sum(k for _, k in shapes.values()), shapes, symbols)
    return made.with_end(shapes.get(-1, (0, 0))[0])


def encoded(docs: DataFrame, shared) -> DataFrame:
    """Each document (doc_id, held_out, text) as symbols, with what its dictionary tokens
    add to both scores, and its other tokens (``rare``)."""
    def run(batches):
        vocab = shared.value
        lookup = vocab.index.get
        for batch in batches:
            symbols, totals, base, known, model = [], [], [], [], []
            tokens, times, offsets = [], [], [0]
            for text in batch.column(batch.schema.get_field_index("text")):
                words = words_of(text.as_py())
                at = np.fromiter(map(lookup, words, repeat(-1)), np.int64, len(words))
                for i in np.flatnonzero(at < 0).tolist():
                    if len(words[i]) > LONGEST:
                        at[i] = lookup(name_of(words[i]), -1)
                hit = at >= 0
                ids = vocab.symbol[at]
                missing = np.flatnonzero(~hit)
                rare = [words[i] for i in missing.tolist()]
                if rare:
                    ids[missing] = [vocab.first_shape + shape_of(w) for w in rare]
                own = at[hit]
                logs = vocab.log_count[own]
                shaped = ids >= vocab.first_shape
                symbols.append(ids.astype(vocab.kind).tobytes())
                totals.append(len(words))
                base.append(float(logs.sum()) - len(words) * vocab.log_total)
                known.append(int((vocab.counts[own] > 0).sum()))
                model.append(float(vocab.log_count[at[hit & shaped]].sum() - vocab.log_shape[ids[shaped] - vocab.first_shape].sum()))
                found = Counter(rare)
                tokens.extend(found)
                times.extend(found.values())
                offsets.append(len(tokens))
            rares = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([pa.array(tokens, pa.binary()).cast(pa.string()), pa.array(times, pa.int32())], ["token", "n"]))
            yield pa.record_batch({"doc_id": batch.column(batch.schema.get_field_index("doc_id")), "held_out": batch.column(batch.schema.get_field_index("held_out")), "symbols": pa.array(symbols, pa.binary()), "n_tokens": pa.array(totals, pa.int64()), "n_known": pa.array(known, pa.int64()), "base": pa.array(base, pa.float64()), "model": pa.array(model, pa.float64()), "rare": rares})

    shape = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, symbols binary, n_tokens bigint, n_known bigint, base double, model double, rare array<struct<token:string,n:int>>"
    return docs.mapInArrow(run, shape).withColumn("row", F.monotonically_increasing_id())


class Model:
    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        """start: states; move: from a state to a state; emit: a row for each symbol."""
        self.start, self.move, self.emit = start, move, emit


def first_model(share: np.ndarray, states: int = STATES) -> Model:
    rng = np.random.default_rng(SEED)
    emit = share[:, None] * rng.uniform(0.5, 1.5, (len(share), states))
    move = np.full((states, states), 0.1 / max(1, states - 1)) + np.eye(states) * (0.9 - 0.1 / max(1, states - 1))
    return Model(np.full(states, 1 / states), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def _grid(pieces: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sequences side by side, a row for each step, and where there is a step."""
    longest = max(map(len, pieces))
    grid, there = np.zeros((longest, len(pieces)), np.int64), np.zeros((longest, len(pieces)), bool)
    for i, s in enumerate(pieces):
        grid[: len(s), i] = s
        there[: len(s), i] = True
    return grid, there


def _portions(sizes: np.ndarray):
    """Positions of pieces by length, in portions of ``CELLS`` steps or one piece."""
    order = np.argsort(sizes, kind="stable")
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and sizes[order[end]] * (end + 1 - at) <= CELLS:
            end += 1
        yield order[at:end].tolist()
        at = end


def transfers(model: Model, pieces: list[np.ndarray]) -> np.ndarray:
    """For each piece a matrix, up to a factor: the vector before the piece's first emission
    times it is the one after its last."""
    k = len(model.start)
    grid, there = _grid(pieces)
    made = np.eye(k) * model.emit[grid[0]][:, None, :]
    for t in range(1, len(grid)):
        step = (made.reshape(-1, k) @ model.move).reshape(made.shape) * model.emit[grid[t]][:, None, :]
        made = np.where(there[t][:, None, None], step, made)
        if t % 8 == 0:  # emissions are over 1e-30 or so, and doubles reach 1e-300
            made /= made.sum((1, 2), keepdims=True)
    return made


def _borders(model: Model, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each piece of one sequence the forward vector before it (zeros: none) and the
    backward vector at its end, up to a factor."""
    n, k = len(steps), len(model.start)
    before, after = np.zeros((n, k)), np.ones((n, k))
    a = model.start
    for s in range(n - 1):
        a = a @ steps[s]
        before[s + 1] = a = a / a.sum()
        a = a @ model.move
    for s in range(n - 1, 0, -1):
        b = model.move @ (steps[s] @ after[s])
        after[s - 1] = b / b.sum()
    return before, after


def expected(model: Model, sequences: list[np.ndarray], stretch: int = STRETCH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected counts of starts, moves and emissions over whole sequences, by scaled
    forward-backward recursions on many of them at once."""
    k = len(model.start)
    sums = [np.zeros(k), np.zeros((k, k)), np.zeros((len(model.emit), k))]
    cuts = [[s[i : i + stretch] for i in range(0, len(s), stretch)] for s in sequences]
    pieces = [x for own in cuts for x in own]
    sizes = np.array(list(map(len, pieces)))
    long = np.flatnonzero(np.repeat([len(own) > 1 for own in cuts], [len(own) for own in cuts]))
    steps = np.empty((len(long), k, k))
    for part in _portions(sizes[long] * k):
        steps[part] = transfers(model, [pieces[i] for i in long[part].tolist()])
    before, after, at = [], [], 0
    for own in cuts:
        if len(own) > 1:
            b, a = _borders(model, steps[at : at + len(own)])
            at += len(own)
        else:
            b, a = np.zeros((1, k)), np.ones((1, k))
        before.append(b)
        after.append(a)
    before, after = np.concatenate(before), np.concatenate(after)
    for part in _portions(sizes):
        for x, y in zip(sums, _counts(model, [pieces[i] for i in part], before[part], after[part]), strict=True):
            x += y
    return tuple(sums)


def _counts(model: Model, pieces: list[np.ndarray], before: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected counts of pieces of sequences, between what comes before and after each."""
    k, v = len(model.start), len(model.emit)
    grid, there = _grid(pieces)
    longest, n = grid.shape
    last = there.sum(0) - 1
    opens = ~before.any(1)
    ahead = np.empty((longest, n, k))
    seen = model.emit[grid]
    seen[~there] = 1.0
    scale = np.ones((longest, n, 1))
    for t in range(longest):
        a = (ahead[t - 1] @ model.move if t else np.where(opens[:, None], model.start, before @ model.move)) * seen[t]
        scale[t] = a.sum(1, keepdims=True)
        ahead[t] = a / scale[t]
    after = after / (ahead[last, np.arange(n)] * after).sum(1, keepdims=True)
    moves, back = np.zeros((k, k)), np.ones((n, k))
    emits = np.zeros((v, k))
    for t in range(longest - 1, -1, -1):
        back = np.where((last == t)[:, None], after, back)
        both = ahead[t] * back
        both /= both.sum(1, keepdims=True)
        ahead[t] = both * there[t][:, None]
        later = seen[t] * back / scale[t]
        moves += ((ahead[t - 1] if t else before) * there[t][:, None]).T @ later
        back = later @ model.move.T
    flat = grid[there]
    for j in range(k):
        emits[:, j] = np.bincount(flat, ahead[..., j][there], v)
    return ahead[0][opens].sum(0), moves * model.move, emits


def log10_likelihoods(model: Model, sequences: list[np.ndarray]) -> np.ndarray:
    """log10 of each whole sequence's probability: forward recursions, scaled at each step."""
    order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
    sizes = np.array([len(sequences[i]) for i in order])
    out, total = np.zeros(len(sequences)), np.zeros(len(sequences))
    a = np.zeros((0, 0))
    for block in range(0, int(sizes.max(initial=0)), 1024):  # a block of steps at a time bounds the memory
        n = int((sizes > block).sum())
        width = min(1024, int(sizes[0]) - block)
        grid = np.zeros((width, n), np.int64)
        for i in range(n):
            part = sequences[order[i]][block : block + width]
            grid[: len(part), i] = part
        for t in range(width):
            m = int(np.searchsorted(-sizes, -(block + t), side="left"))  # those longer than this step
            seen = model.emit[grid[t, :m]]
            a = model.start * seen if block + t == 0 else (a[:m] @ model.move) * seen
            scale = a.sum(1)
            a /= scale[:, None]
            total[:m] += np.log10(scale)
    out[order] = total
    return out


def trained(rows: DataFrame, vocab: Vocabulary, states: int = STATES, rounds: int = ROUNDS) -> Model:
    """Baum-Welch over the column ``symbols``."""
    spark, model, kind = rows.sparkSession, first_model(vocab.share, states), vocab.kind
    shape = "id int, " + ", ".join(f"s{j} double" for j in range(states))
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(model)

        def run(batches, shared=shared):
            model = shared.value
            sums = [np.zeros(states), np.zeros((states, states)), np.zeros((len(model.emit), states))]
            held: list[np.ndarray] = []
            size = 0

            def add():
                for x, y in zip(sums, expected(model, held), strict=True):
                    x += y
                held.clear()

            for batch in batches:
                for x in batch.column(0):
                    held.append(np.frombuffer(x.as_py(), kind).astype(np.int64))
                    size += len(held[-1])
                    if size >= 2 * CELLS:
                        add()
                        size = 0
            if held:
                add()
            rows = np.vstack([sums[2], sums[1], sums[0][None]])  # emissions, then moves, then starts
            used = np.flatnonzero(rows.any(1))
            yield pa.record_batch({"id": pa.array(used.astype(np.int32)), **{f"s{j}": pa.array(rows[used, j]) for j in range(states)}})

        found = rows.select("symbols").mapInArrow(run, shape).groupBy("id").agg(*[F.sum(f"s{j}").alias(f"s{j}") for j in range(states)]).collect()  # symbols + states + 1 rows
        v = len(model.emit)
        sums = np.zeros((v + states + 1, states))
        for r in found:
            sums[r["id"]] = r[1:]
        emit, move, start = sums[:v] + SMOOTH * vocab.share[:, None], sums[v : v + states] + 0.1, sums[-1] + 0.1
        model = Model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))
        shared.unpersist()
    return model


def scored(rows: DataFrame, model: Model, kind: str) -> DataFrame:
    """``rows`` with log10 of the probability of their symbols, as ``forward``."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            sequences = [np.frombuffer(x.as_py(), kind).astype(np.int64) for x in batch.column(batch.schema.get_field_index("symbols"))]
            at = batch.schema.get_field_index("symbols")
            yield pa.RecordBatch.from_arrays([pa.array(log10_likelihoods(shared.value, sequences)) if i == at else batch.column(i) for i in range(batch.num_columns)], names=["forward" if i == at else n for i, n in enumerate(batch.schema.names)])

    own = rows.select("row", "doc_id", "held_out", "n_tokens", "n_known", "base", "model", "symbols")
    shape = f"row bigint, doc_id {rows.schema['doc_id'].dataType.simpleString()}, held_out boolean, n_tokens bigint, n_known bigint, base double, model double, forward double"
    return own.mapInArrow(run, shape)


def language_model(docs: DataFrame, states: int = STATES, symbols: int = SYMBOLS, rounds: int = ROUNDS, dictionary: int = DICTIONARY) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each row."""
    spark = docs.sparkSession
    own = chosen(docs, doc_id="doc_id", text="text").select("doc_id", F.coalesce(crc_mod(F.col("doc_id"), 7) == 2, F.lit(False)).alias("held_out"), "text")
    counts = stored(token_counts(own.filter(~F.col("held_out")).select("text")), "counts")
    vocab = vocabulary(counts, symbols, dictionary)
    shared = spark.sparkContext.broadcast(vocab)  # DICTIONARY tokens of LONGEST bytes at most
    rows = stored(encoded(own, shared), "encoded")
    model = trained(rows.filter(~F.col("held_out")), vocab, states, rounds)
    # tokens outside the dictionary: log10((c + 1) / total) splits into a part in c, joined here, and a local one
    rare = rows.select("row", F.explode("rare").alias("r")).select("row", "r.token", "r.n").join(counts.select("token", "c"), "token")
    rare = rare.groupBy("row").agg(F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("logs"), F.sum("n").alias("rare_known"))
    made = scored(rows, model, vocab.kind).join(rare, "row", "left")
    logs = F.coalesce("logs", F.lit(0.0))
    return made.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"), F.lit(vocab.n).cast("long").alias("train_tokens"), (F.col("base") + logs).alias("base_score"), (F.col("forward") + F.col("model") + logs).alias("score"))


def op4_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model(table(spark, sf_dir, "documents"))
