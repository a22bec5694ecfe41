"""Operator 7: toxicity by a convolutional text classifier, trained in numpy on all labelled rows.

A word's embedding is the sum of the hashed embeddings of the word and of its first
3 and 5 letters (BUCKETS in all), so inflected and compound forms share what is
learnt of their stem. Filters of several widths slide over a whole text; of each
filter the largest response (max pooling) and the logarithm of its summed positive
responses enter a logistic output, with the logarithm of the number of words.
Training (Adam, in numpy) goes in passes over all training rows but every SPARE-th,
which a hash of the id picks: each task goes on from the shared parameters and Adam
moments with its own rows, and the weighted mean of what the tasks reach, summed by
Spark, starts the next pass. An embedding is weighted by how often its bucket occurs
in the task, all else by the task's rows. The spare rows, all of them, give a threshold
for each language, found on the text's own function words, never from the ``lang``
column, from counts of the output in steps of 1 / STEPS: scores are shifted so that each
language's threshold is 0.3. Nothing is sampled; what the driver holds (parameters,
moments, counts) has the same size at every number of rows.

Defined cases: null and empty texts hold no words; they get the score of padding
alone; repeated ids train once a label, by their last text; if the spare rows or the
others hold fewer than 4 rows of a label, both are all training rows; without 4
training rows of both labels every score is the share of label 1
among the training rows (0.5 without any); repeated rows get one row each, a null
doc_id its own fold; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odoflow.llm.common import Scratch, fold, whole_text
from odoflow.llm.winnow import words_of

MODULUS, HELD = 4, 2
THRESHOLD = 0.3
BUCKETS = 1 << 15
DIM, FILTERS, WIDTHS = 8, 8, (1, 2, 3)
BATCH, RATE, DECAY = 64, 0.01, 1e-5
PAD = max(WIDTHS)
SPARE, STEPS = 4, 64
#: Rows that a task should at least have for itself; passes over rows that one task has, and over any number of rows.
LANE_ROWS, PASSES, LEAST_PASSES = 4096, 6, 3
#: Rows of the parameters (DIM to a row) that are summed together.
CHUNK = 2048

# Function words that tell four languages apart.
FUNCTION_WORDS = {
    "en": "the of and to is that it was for with",
    "de": "der die und das ist den von zu mit nicht",
    "fr": "le les des est et dans pour une avec sur",
    "es": "el los las del y por con una para como",
}


def _bucket(word: str) -> int:
    h = xxhash.xxh64_intdigest(word.encode(), 42)
    return (h - (1 << 64) if h >> 63 else h) % BUCKETS


def _language_table() -> np.ndarray:
    table = np.zeros((BUCKETS + 1, len(FUNCTION_WORDS)), np.int32)
    for k, words in enumerate(FUNCTION_WORDS.values()):
        table[[_bucket(w) for w in words.split()], k] = 1
    return table


def hashed_words(words: str | Column = "words") -> list[Column]:
    """Buckets of each word, of its first 3 and of its first 5 letters: three arrays of equal length."""
    def bucket(part: Column) -> Column:
        return F.pmod(F.xxhash64(part), F.lit(BUCKETS)).cast("int")

    return [
        F.transform(words, bucket),
        F.transform(words, lambda w: bucket(F.concat(F.lit("3"), F.substring(w, 1, 3)))),
        F.transform(words, lambda w: bucket(F.concat(F.lit("5"), F.substring(w, 1, 5)))),
    ]


def _flat(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words (rows of 3 buckets), each text followed by PAD empty words; first place and end (excluded) of each text's windows."""
    pad = np.full((PAD, 3), BUCKETS, np.int32)
    words = np.concatenate([x for d in docs for x in (d, pad)] + [pad])
    n = np.array([len(d) for d in docs])
    first = np.concatenate([[0], np.cumsum(n + PAD)[:-1]])
    return words, first, first + n + 1


def _pooled(merge: np.ufunc, values: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    return merge.reduceat(values, np.stack([first, end], axis=1).ravel(), axis=0)[::2]


class ConvModel:
    def __init__(self, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        total = len(WIDTHS) * FILTERS
        self.p = {"embed": rng.normal(0, 0.02, (BUCKETS + 1, DIM)), "out": rng.normal(0, 0.3, 2 * total + 1), "bias": np.zeros(1)}
        for w in WIDTHS:
            self.p[f"filter{w}"] = rng.normal(0, 0.5 / np.sqrt(w), (w, DIM, FILTERS))
            self.p[f"shift{w}"] = np.full(FILTERS, -0.1)
        self.p["embed"][BUCKETS] = 0
        self.cut = np.zeros(len(FUNCTION_WORDS) + 1)
        self.constant: float | None = None
        self.language = _language_table()

    def _responses(self, words: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Embeddings, and the positive responses of the filters of each width at every place."""
        p, n = self.p, len(words) - PAD
        x = p["embed"][words].sum(axis=1)
        out = []
        for w in WIDTHS:
            r = x[:n] @ p[f"filter{w}"][0]
            for o in range(1, w):
                r += x[o : n + o] @ p[f"filter{w}"][o]
            out.append(np.maximum(0, r + p[f"shift{w}"].astype(r.dtype)))
        return x, out

    def _hidden(self, responses: list[np.ndarray], first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Inputs of the output layer, and the sums of the responses."""
        top = [_pooled(np.maximum, r, first, end) for r in responses]
        sums = np.concatenate([_pooled(np.add, r, first, end) for r in responses], axis=1)
        return np.concatenate([*top, np.log1p(sums), np.log(end - first)[:, None]], axis=1), sums

    def halved(self) -> ConvModel:
        """Single precision, for scoring."""
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        return self

    def logits(self, docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Output before calibration, and the number of the language (0: none found)."""
        words, first, end = _flat(docs)
        h, _ = self._hidden(self._responses(words)[1], first, end)
        seen = _pooled(np.add, self.language[words[:, 0]], first, end)
        language = np.where(seen.max(axis=1) > 0, seen.argmax(axis=1) + 1, 0)
        return h @ self.p["out"] + self.p["bias"], language

    def scores(self, docs: list[np.ndarray]) -> np.ndarray:
        if self.constant is not None or not docs:
            return np.full(len(docs), self.constant)
        z, language = self.logits(docs)
        z = z - self.cut[language] + np.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))

    def gradients(self, docs: list[np.ndarray], y: np.ndarray) -> dict[str, np.ndarray]:
        words, first, end = _flat(docs)
        p, doc = self.p, np.zeros(len(words), np.int64)
        doc[first[1:]] = 1
        doc = np.cumsum(doc)
        x, responses = self._responses(words)
        h, sums = self._hidden(responses, first, end)
        error = (1 / (1 + np.exp(-np.clip(h @ p["out"] + p["bias"], -60, 60))) - y) / len(y)
        g = {"out": h.T @ error + 1e-4 * p["out"], "bias": error.sum(keepdims=True), "embed": np.zeros_like(p["embed"])}
        total = len(WIDTHS) * FILTERS
        for_top, for_sum = error[:, None] * p["out"][:total], error[:, None] * p["out"][total : 2 * total] / (1 + sums)
        dx = np.zeros_like(x)
        inside = np.arange(len(words) - PAD) < end[doc[: len(words) - PAD]]
        for k, w in enumerate(WIDTHS):
            mine, r = slice(k * FILTERS, (k + 1) * FILTERS), responses[k]
            row, f = np.nonzero((r > 0) & inside[:, None])
            d = for_sum[:, mine][doc[row], f] + for_top[:, mine][doc[row], f] * (r[row, f] == h[:, mine][doc[row], f])
            dr = np.zeros_like(r)
            dr[row, f] = d
            g[f"shift{w}"], g[f"filter{w}"] = dr.sum(axis=0), np.zeros_like(p[f"filter{w}"])
            n = len(r)
            for o in range(w):
                g[f"filter{w}"][o] = x[o : n + o].T @ dr
                dx[o : n + o] += dr @ p[f"filter{w}"][o].T
        moved = np.flatnonzero(dx.any(axis=1))
        for c in range(3):
            np.add.at(g["embed"], words[moved, c], dx[moved])
        for k in ("embed", *(f"filter{w}" for w in WIDTHS)):
            g[k] += (DECAY if k == "embed" else 10 * DECAY) * p[k]
        g["embed"][BUCKETS] = 0
        return g

    def parts(self, rows: np.ndarray) -> dict[str, np.ndarray]:
        """The arrays of ``self.p`` out of their rows of DIM (see _rows)."""
        out, at, rest = {"embed": rows[: BUCKETS + 1].copy()}, 0, rows[BUCKETS + 1 :].ravel()
        for k, v in self.p.items():
            if k != "embed":
                out[k] = rest[at : at + v.size].reshape(v.shape).copy()
                at += v.size
        return out


def _rows(parts: dict[str, np.ndarray]) -> np.ndarray:
    """All arrays in rows of DIM, the embeddings first."""
    rest = np.concatenate([v.ravel() for k, v in parts.items() if k != "embed"])
    return np.concatenate([parts["embed"], np.pad(rest, (0, -len(rest) % DIM)).reshape(-1, DIM)])


class Fit:
    """Parameters under training with their Adam moments, as one matrix between the passes (its last row: the steps made)."""

    def __init__(self, state: np.ndarray | None = None) -> None:
        self.model = ConvModel()
        if state is None:
            self.m, self.v = ({k: np.zeros_like(x) for k, x in self.model.p.items()} for _ in range(2))
            self.step = 0.0
        else:
            self.model.p, self.m, self.v = (self.model.parts(x) for x in np.split(state[:-1], 3, axis=1))
            self.step = float(state[-1, 0])

    def state(self) -> np.ndarray:
        rows = np.concatenate([_rows(x) for x in (self.model.p, self.m, self.v)], axis=1)
        return np.concatenate([rows, np.full((1, 3 * DIM), self.step)])

    def learn(self, docs: list[np.ndarray], y: np.ndarray, order: np.ndarray) -> None:
        p, m, v = self.model.p, self.m, self.v
        for i in range(0, len(order), BATCH):
            part = order[i : i + BATCH]
            self.step += 1
            for k, g in self.model.gradients([docs[j] for j in part], y[part]).items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                p[k] -= RATE * (m[k] / (1 - 0.9**self.step)) / (np.sqrt(v[k] / (1 - 0.999**self.step)) + 1e-8)


def _best_cut(z: np.ndarray, y: np.ndarray, w: np.ndarray) -> float:
    """The output value that, as a threshold, gives the best F1 of label 1."""
    order = np.argsort(-z, kind="stable")
    hit, all_ = np.cumsum((w * y)[order]), np.cumsum(w[order])
    f1 = 2 * hit / (all_ + (w * y).sum())
    k = int(f1.argmax())
    z = z[order]
    return float(z[k] if k + 1 == len(z) else (z[k] + z[k + 1]) / 2)


def _docs(batch: pa.RecordBatch) -> list[np.ndarray]:
    """The words of each text (rows of 3 buckets) out of the columns b0, b1 and b2."""
    flat = np.stack([batch.column(f"b{k}").flatten().to_numpy() for k in range(3)], axis=1).astype(np.int32)
    ends = np.cumsum(batch.column("b0").value_lengths().to_numpy())
    return np.split(flat, ends[:-1]) if len(ends) else []


def _slices(docs: list[np.ndarray]) -> Iterator[slice]:
    """Texts of a bounded number of words at once (one longer text goes alone)."""
    first = held = 0
    for i, d in enumerate(docs):
        held += len(d)
        if held > 300_000 or i + 1 == len(docs):
            yield slice(first, i + 1)
            first, held = i + 1, 0


def _pass(known: Broadcast, seed: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(lane, chunk, weight, total): what a task reaches with its rows from the shared state, times its weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit, rng, rows, seen = Fit(known.value), np.random.default_rng(seed), 0, np.full(BUCKETS + 1, 1e-3)
        for batch in batches:
            docs = _docs(batch)
            fit.learn(docs, batch.column("y").to_numpy(), rng.permutation(len(docs)))
            rows += len(docs)
            seen += sum(np.bincount(d.ravel(), minlength=BUCKETS + 1) for d in docs)
        if not rows:
            return
        state, lane = fit.state(), TaskContext.get().partitionId()
        weight = np.concatenate([seen, np.full(len(state) - len(seen), float(rows))])
        total = state * weight[:, None]
        for k in range(0, len(state), CHUNK):
            yield pa.RecordBatch.from_pydict({
                "lane": pa.array([lane], pa.int32()), "chunk": pa.array([k // CHUNK], pa.int32()),
                "weight": pa.array([weight[k : k + CHUNK].tobytes()], pa.binary()), "total": pa.array([total[k : k + CHUNK].tobytes()], pa.binary()),
            })

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, mean) of rows of _pass sorted by chunk and lane."""
    chunk, weight, total = None, None, None

    def done() -> pa.RecordBatch:
        mean = total / np.repeat(weight, 3 * DIM)
        return pa.RecordBatch.from_pydict({"chunk": pa.array([chunk], pa.int32()), "mean": pa.array([mean.tobytes()], pa.binary())})

    for batch in batches:
        for at, w, t in zip(*(batch.column(c).to_pylist() for c in ("chunk", "weight", "total"))):
            w, t = np.frombuffer(w), np.frombuffer(t)
            if at == chunk:
                weight, total = weight + w, total + t
                continue
            if chunk is not None:
                yield done()
            chunk, weight, total = at, w, t
    if chunk is not None:
        yield done()


def _outputs(known: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(language, step, y, n): counts of the output, in steps of 1 / STEPS."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, y = _docs(batch), batch.column("y").to_numpy()
            for part in _slices(docs):
                z, language = known.value.logits(docs[part])
                step = np.floor(np.clip(z, -60, 60) * STEPS).astype(np.int64)
                found, n = np.unique(np.stack([language, step, y[part]]), axis=1, return_counts=True)
                yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in found), pa.array(n, pa.int64())], names=["language", "step", "y", "n"])

    return run


def _cuts(counts: pa.Table, model: ConvModel) -> None:
    """The thresholds of each language (that of all where there are few rows of it)."""
    language, step, y, n = (counts.column(c).to_numpy() for c in ("language", "step", "y", "n"))
    z = (step + 0.5) / STEPS

    def best(own: np.ndarray) -> float:
        at, place = np.unique(z[own], return_inverse=True)
        all_, hit = np.bincount(place, n[own]), np.bincount(place, (n * y)[own])
        return _best_cut(at, hit / all_, all_)

    model.cut[:] = best(np.ones(len(z), bool))
    for k in range(len(model.cut)):
        own = language == k
        if min(n[own & (y == 0)].sum(), n[own & (y == 1)].sum()) >= 20:
            model.cut[k] = best(own)


def _features(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All training rows (y, spare, b0, b1, b2) in the order of a hash of their ids. Texts meet labels by sort and merge at every size."""
    ids = labels.select("doc_id", F.col("toxic").cast("int").alias("y")).distinct().hint("merge")
    texts = docs.select("doc_id", whole_text().alias("text")).where(F.col("doc_id").isNotNull() & (fold("doc_id", MODULUS) != HELD))
    rows = texts.join(ids, "doc_id").groupBy("doc_id", "y").agg(F.max("text").alias("text"))
    spread = F.xxhash64("doc_id")
    rows = rows.select("y", (F.pmod(spread, F.lit(SPARE)) == 0).alias("spare"), spread.alias("spread"), words_of().alias("words"))
    rows = rows.select("y", "spare", "spread", *(c.cast("array<short>").alias(f"b{k}") for k, c in enumerate(hashed_words())))
    return rows.sortWithinPartitions("spread", "y").drop("spread")


def train(docs: DataFrame, labels: DataFrame) -> ConvModel:
    """Fit on all training rows that have a label 0 or 1 in ``labels`` (doc_id, toxic)."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "toxicity")
    labels = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (fold("doc_id", MODULUS) != HELD))
    model = ConvModel()
    rows = scratch.save(_features(docs, labels), "rows")
    sizes = {(r.y, r.spare): r["count"] for r in rows.groupBy("y", "spare").count().collect()}
    if min(sizes.get((y, True), 0) + sizes.get((y, False), 0) for y in (0, 1)) < 4:
        named = dict(labels.groupBy("toxic").count().collect())
        model.constant = (named.get(1, 0) + 1) / (sum(named.values()) + 2)
        scratch.drop("rows")
        return model
    used, spare, n = rows.where("not spare"), rows.where("spare"), sum(k for (_, s), k in sizes.items() if not s)
    if min(sizes.get((y, s), 0) for y in (0, 1) for s in (True, False)) < 4:
        used, spare, n = rows, rows, sum(sizes.values())
    state = Fit().state()
    used = used.drop("spare").coalesce(-(-n // LANE_ROWS))
    for k in range(max(LEAST_PASSES, -(-PASSES * LANE_ROWS // max(n, LANE_ROWS)))):
        known = spark.sparkContext.broadcast(state)
        reached = used.mapInArrow(_pass(known, 11 + k), "lane int, chunk int, weight binary, total binary")
        means = reached.repartition("chunk").sortWithinPartitions("chunk", "lane").mapInArrow(_summed, "chunk int, mean binary").collect()
        state = np.concatenate([np.frombuffer(r["mean"]).reshape(-1, 3 * DIM) for r in sorted(means)])
        known.unpersist()
    model = Fit(state).model
    known = spark.sparkContext.broadcast(model)
    counts = spare.drop("spare").mapInArrow(_outputs(known), "language long, step long, y long, n long")
    _cuts(counts.groupBy("language", "step", "y").agg(F.sum("n").alias("n")).toArrow(), model)
    scratch.drop("rows")
    return model


def score(docs: DataFrame, model: ConvModel, also: tuple[str, ...] = ()) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted, of whole texts; and the columns ``also``."""
    known = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = known.value.halved()
        for batch in batches:
            docs = _docs(batch)
            parts = [model.scores(docs[part]) for part in _slices(docs)]
            scores = np.concatenate(parts) if parts else np.zeros(0)
            kept = [batch.column(c) for c in also]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), *kept], names=["doc_id", "score", *also])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), words_of().alias("words"), *also)
    rows = rows.select("doc_id", *(c.alias(f"b{k}") for k, c in enumerate(hashed_words())), *also)
    schema = ", ".join(["doc_id long", "score double", *(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in also)])
    return rows.mapInArrow(run, schema).select(
        "doc_id", (fold("doc_id", MODULUS) == HELD).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), *also
    )
