"""Operator 5: a hidden Markov language model with word classes.

Every token belongs to one class: the OWN most frequent words and the end of a text
have a class each, all other words share HASHED classes by their crc32. Latent
states emit classes; a class emits its words in proportion to their add-one
probabilities. So with p1 the add-one unigram probability,

    log P(text) = log P_hmm(classes) + sum over tokens of [log p1(token) - log p1(class)]

where p1(class) sums its words, and the hashed classes share the probability of the
one unseen word evenly. The first term comes from the scaled forward recursion over
the whole text, exactly; the rest needs the count of every token.

Counts of all training tokens are gathered word by word (partial sums in the
tasks), and grow with the corpus. Words seen at least as often as a limit that keeps
HEAD words at most are broadcast; tokens beyond it find their counts by a join,
summed up per document. Training is Baum-Welch over all training documents: tasks
compute expected counts of their sequences (stretches of STRETCH tokens), Spark adds
them up, the driver normalises (states x classes numbers, whatever the corpus). It
starts from states that tend to stay (from states all alike it would not get away),
and goes on until the likelihood of the training documents no longer rises.

Defined cases: null text is empty text (its only token is the end); without training
rows every count is 0 and the model is the base; a null doc_id falls in its own fold;
repeated rows get one row each; an empty table gives no rows; other columns are
ignored. Scores of texts of any length are finite.
"""

from __future__ import annotations

import logging
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odoflow.llm.common import Scratch, fold

MODULUS, HELD = 7, 2
STATES, OWN, HASHED = 8, 511, 512
STRETCH = 256
#: Added to the chance of staying in a state at the start, so that the states differ from the first round on.
STAY = 150
#: Training ends when CALM rounds in succession raise the log10 likelihood by less than RISE a token each.
RISE, CALM = 1e-4, 2
HEAD = 1 << 18
#: Distinct words that a task holds before it passes its partial counts on.
HOLD = 300_000
#: Tokens whose recursions run side by side.
WIDE = 500_000
END = b""


def _tokens(text: bytes | None) -> list[bytes]:
    return [*(text or b"").lower().split(), END]  # of bytes: A-Z and the six ASCII white spaces


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n) of all tokens of ``docs`` (text); the end is the empty word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def flush() -> Iterator[pa.RecordBatch]:
            words = list(held)
            for i in range(0, len(words), 100_000):
                part = words[i : i + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()), pa.array([held[w] for w in part], pa.int64())], names=["word", "n"])
            held.clear()

        for batch in batches:
            for text in batch.column(0).cast(pa.binary()):
                held.update(_tokens(text.as_py()))
                if len(held) > HOLD:
                    yield from flush()
        yield from flush()

    return docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Classes:
    """Class numbers: 0 .. OWN - 1 by rank, then the hashed ones, the end last."""

    count = OWN + HASHED + 1

    def __init__(self, own: list[bytes]) -> None:
        self.own = {w: k for k, w in enumerate(own)} | {END: self.count - 1}

    def of(self, word: bytes) -> int:
        k = self.own.get(word)
        return OWN + zlib.crc32(word) % HASHED if k is None else k


class Hmm:
    """Start, transition and emission probabilities of the latent states."""

    def __init__(self, mass: np.ndarray, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        emit = mass * rng.uniform(0.5, 1.5, (STATES, len(mass)))
        self.emit = emit / emit.sum(axis=1, keepdims=True)
        move = rng.uniform(0.5, 1.5, (STATES, STATES)) + STAY * np.eye(STATES)
        self.move = move / move.sum(axis=1, keepdims=True)
        self.start = np.full(STATES, 1 / STATES)

    def log10(self, sequences: list[np.ndarray]) -> np.ndarray:
        """Exact log10 likelihood of each whole sequence, by the scaled forward recursion."""
        out, order, emit = np.zeros(len(sequences)), np.argsort([-len(s) for s in sequences], kind="stable"), np.ascontiguousarray(self.emit.T)
        lengths = np.array([len(sequences[i]) for i in order])
        flat, first = np.concatenate([sequences[i] for i in order]), np.cumsum(lengths) - lengths
        total, alpha = np.zeros(len(order)), None
        live = len(order)
        for t in range(lengths[0]):
            while lengths[live - 1] <= t:
                live -= 1
            seen = emit[flat[first[:live] + t]]
            alpha = (alpha[:live] @ self.move if t else self.start) * seen
            scale = alpha.sum(axis=1)
            alpha /= scale[:, None]
            total[:live] += np.log10(scale)
        out[order] = total
        return out

    def expected(self, sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected starts, moves and emissions of the sequences (none empty)."""
        return self.gathered(sequences)[:3]

    def gathered(self, sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """The expected counts and the log10 likelihood of the sequences (none empty), side by side: longest first,
        so that those which still go on at a step are the first rows."""
        sequences = sorted(sequences, key=len, reverse=True)
        lengths = np.array([len(x) for x in sequences])
        steps = int(lengths[0])
        live = np.searchsorted(-lengths, -np.arange(steps), "left")  # rows longer than t
        first = np.concatenate([[0], np.cumsum(live)])
        emit = np.ascontiguousarray(self.emit.T, np.float32)
        move = self.move.astype(np.float32)
        by_step = np.empty(first[-1], np.int64)  # classes, step after step
        flat, at = np.concatenate(sequences), np.cumsum(lengths) - lengths
        for t in range(steps):
            by_step[first[t] : first[t + 1]] = flat[at[: live[t]] + t]
        seen = emit[by_step]
        alpha, scale, ones = np.empty_like(seen), np.empty(len(seen), np.float32), np.ones(STATES, np.float32)
        for t in range(steps):
            rows = slice(first[t], first[t + 1])
            now = (alpha[first[t - 1] : first[t - 1] + live[t]] @ move if t else self.start.astype(np.float32)) * seen[rows]
            scale[rows] = now @ ones
            alpha[rows] = now / scale[rows][:, None]
        moves, beta = np.zeros((STATES, STATES)), np.ones((live[0], STATES), np.float32)
        for t in range(steps - 1, -1, -1):
            n, rows = live[t], slice(first[t], first[t + 1])
            if t:
                ahead = seen[rows] * beta[:n] / scale[rows][:, None]
                moves += alpha[first[t - 1] : first[t - 1] + n].T @ ahead
            alpha[rows] *= beta[:n]  # from here on the state probabilities
            if t:
                beta[:n] = ahead @ move.T
        emissions = np.stack([np.bincount(by_step, alpha[:, s], self.emit.shape[1]) for s in range(STATES)])
        return alpha[: live[0]].sum(axis=0), moves * self.move, emissions, float(np.log10(scale).sum(dtype=float))

    def update(self, starts: np.ndarray, moves: np.ndarray, emissions: np.ndarray, mass: np.ndarray) -> None:
        """Normalised expected counts; a little of the class masses keeps every class possible."""
        emissions, moves, starts = emissions + mass, moves + 0.01, starts + 0.01
        self.emit = emissions / emissions.sum(axis=1, keepdims=True)
        self.move = moves / moves.sum(axis=1, keepdims=True)
        self.start = starts / starts.sum()


def _stretches(sequences: list[np.ndarray]) -> list[np.ndarray]:
    """Sequences cut into stretches of at most STRETCH tokens."""
    return [x[i : i + STRETCH] for x in sequences for i in range(0, len(x), STRETCH)]


def _sequences(column: pa.Array) -> Iterator[list[np.ndarray]]:
    """Class sequences of a batch, a bounded number of tokens at once."""
    held, n = [], 0
    for x in column:
        held.append(np.frombuffer(x.as_py(), np.uint16).astype(np.int64))
        n += len(held[-1])
        if n > WIDE:
            yield held
            held, n = [], 0
    if held:
        yield held


def _summed(hmm: Hmm):
    """(place, value) of the expected counts of all sequences of a task, and last of their log10 likelihood."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((STATES, Classes.count)), 0.0]
        for batch in batches:
            for sequences in _sequences(batch.column(0)):
                parts = [a + b for a, b in zip(parts, hmm.gathered(_stretches(sequences)))]
        flat = np.concatenate([np.ravel(p) for p in parts])
        at = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(flat[at])], names=["place", "value"])

    return run


def baum_welch(hmm: Hmm, classes: DataFrame, mass: np.ndarray, tokens: int, rounds: int | None = None) -> list[float]:
    """Trains ``hmm`` on all sequences of ``classes``, of ``tokens`` tokens in all; the log10 likelihood a token before
    each round. Ends when it no longer rises, or after ``rounds`` if given."""
    sizes = (STATES, STATES * STATES, STATES * Classes.count, 1)
    logs: list[float] = []
    while rounds is None or len(logs) < rounds:
        sums = np.zeros(sum(sizes))
        for place, value in classes.mapInArrow(_summed(hmm), "place int, value double").groupBy("place").agg(F.sum("value")).collect():
            sums[place] = value
        a, b, c, log = np.split(sums, np.cumsum(sizes)[:-1])
        hmm.update(a, b.reshape(STATES, STATES), c.reshape(STATES, -1), mass)
        logs.append(log[0] / tokens)
        if len(logs) > CALM and (np.diff(logs[-CALM - 1 :]) < RISE).all():
            break
    logging.getLogger(__name__).info("Baum-Welch: %d rounds, log10 likelihood a token %s", len(logs), logs)
    return logs


def score_texts(docs: DataFrame, rounds: int | None = None, head: int = HEAD) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10).

    ``rounds`` bounds the training, for tests; by default it goes on until the likelihood no longer rises.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "hmm")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("held_out", fold("doc_id", MODULUS) == HELD)
    counts = scratch.save(count_words(docs.where("not held_out")), "counts")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    floor = total + distinct + 1

    # The smallest count whose words are at most ``head``: from how many words have each count.
    limit, kept = total + 1, 0
    for n, words in counts.groupBy("n").count().orderBy(F.desc("n")).toLocalIterator():
        kept += words
        if kept > head:
            break
        limit = n
    known = {bytes(r["word"]): r["n"] for r in counts.where(F.col("n") >= limit).collect()}
    own = sorted((w for w in known if w != END), key=lambda w: (-known[w], w))[:OWN]
    classes = Classes(own)

    # Class masses: the sums over hashed words come from Spark.
    hashed = counts.where(~F.col("word").isin([bytearray(w) for w in [END, *own]])).groupBy((F.crc32("word") % HASHED).alias("k")).agg(F.sum("n").alias("n"), F.count("*").alias("words"))
    mass = np.zeros(Classes.count)
    mass[OWN:-1] = 1 / HASHED
    for k, n, words in hashed.collect():
        mass[OWN + k] += n + words
    for w in own:
        mass[classes.of(w)] = known[w] + 1
    mass[-1] = known.get(END, 0) + 1
    mass = np.maximum(mass, 1e-9) / floor
    log_mass = np.log10(mass)
    shared = spark.sparkContext.broadcast((known, classes, log_mass, np.log10(floor)))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, classes, log_mass, log_floor = shared.value
        part, row = TaskContext.get().partitionId(), 0
        log_known = {w: (classes.of(w), np.log10(n + 1)) for w, n in known.items()}
        for batch in batches:
            rows: list[tuple] = []
            for doc, text, held in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), batch.column(2).to_pylist()):
                tokens = _tokens(text.as_py())
                found, n_known, sequence = 0.0, 0, []
                rest: dict[bytes, int] = {}
                for w in tokens:
                    hit = log_known.get(w)
                    if hit is None:
                        rest[w] = rest.get(w, 0) + 1
                        sequence.append(classes.of(w))
                    else:
                        sequence.append(hit[0])
                        found += hit[1]
                        n_known += 1
                sequence = np.array(sequence, np.uint16)
                rows.append((part * (1 << 36) + row, doc, held, len(tokens), n_known, found - len(tokens) * log_floor, float(log_mass[sequence].sum()), sequence.tobytes(), list(rest), list(rest.values())))
                row += 1
                if len(rows) >= 500:
                    yield pack(rows)
                    rows = []
            if rows:
                yield pack(rows)

    schema = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, found double, of_classes double, classes binary, rest array<binary>, times array<int>"
    types = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int32())]
    names = [c.split()[0] for c in schema.split(", ")]

    def pack(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    coded = scratch.save(docs.mapInArrow(encode, schema), "coded")

    hmm = Hmm(mass)
    if total:
        baum_welch(hmm, coded.where("not held_out").select("classes"), mass, total, rounds)
    model = spark.sparkContext.broadcast(hmm)

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            logs = [model.value.log10(s) for s in _sequences(batch.column("classes"))]
            kept = [batch.column(c) for c in ("row", "doc_id", "held_out", "n_tokens", "n_known", "found", "of_classes")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(np.concatenate([np.zeros(0), *logs]))], names=["row", "doc_id", "held_out", "n_tokens", "n_known", "found", "of_classes", "hmm"])

    scored = coded.mapInArrow(forward, "row long, doc_id long, held_out boolean, n_tokens long, n_known long, found double, of_classes double, hmm double")
    # The other tokens: counts by a join on the word, sums by document.
    rare = coded.select("row", F.explode(F.arrays_zip("rest", "times")).alias("x")).select("row", F.col("x.rest").alias("word"), F.col("x.times").alias("times"))
    met = rare.join(counts.where(F.col("n") < limit), "word")
    sums = met.groupBy("row").agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("log"))
    base = F.col("found") + F.coalesce("log", F.lit(0.0))
    return scored.join(sums, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more", F.lit(0).cast("long"))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), base.alias("base_score"), (base + F.col("hmm") - F.col("of_classes")).alias("score"),
    )
