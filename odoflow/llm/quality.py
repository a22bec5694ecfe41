"""Operator 4: quality by compression against two zstandard dictionaries.

One dictionary is built from good labelled texts, one from bad ones, of a bounded
sample of training rows (SAMPLE rows a label): the texts themselves where all of them
fit into a dictionary, else one trained on pieces of them all. A whole text is compressed with
each; the difference of the two sizes over their sum says which dictionary knows
the text better. Other rows of the sample, kept from the dictionaries, calibrate
it: an increasing logistic curve of the difference, weighted to the share of
label 1 among all training rows.

Defined cases: null and empty texts compress to the same size with both
dictionaries, so their difference is 0 and their score the curve's value there;
without training rows of both labels every score is the share of label 1 (0.5
without any); repeated rows get one row each, a null doc_id its own fold; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odoflow.llm.common import fold, labelled_sample

SAMPLE = 1500
MODULUS, HELD = 5, 0
THRESHOLD = 0.3
DICTIONARY_BYTES, SMALLEST_BYTES = 1 << 16, 1 << 12
PIECE_BYTES = 2048
LEVEL = 3


class CompressionModel:
    """Two dictionaries and the curve (intercept, slope) of the size difference."""

    def __init__(self, good: bytes, bad: bytes, curve: tuple[float, float]) -> None:
        self.good, self.bad, self.curve = good, bad, curve

    def compressors(self) -> list:
        import zstandard

        return [
            zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_dict_id=False, write_checksum=False)
            if d else None for d in (self.good, self.bad)
        ]

    def differences(self, texts: list[bytes]) -> np.ndarray:
        good, bad = self.compressors()
        if good is None or bad is None:
            return np.zeros(len(texts))
        sizes = np.array([(len(good.compress(t)), len(bad.compress(t))) for t in texts], float).reshape(-1, 2)
        return (sizes[:, 1] - sizes[:, 0]) / np.maximum(1, sizes.sum(axis=1))

    def scores(self, texts: list[bytes]) -> np.ndarray:
        z = self.curve[0] + self.curve[1] * self.differences(texts)
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _dictionaries(*samples: list[bytes]) -> list[bytes]:
    """Of each sample: all of it if it fits into a dictionary, else one trained on pieces of whole texts, so that a
    long text counts with all of it. The trained ones are no larger than the smallest sample, as far as SMALLEST_BYTES."""
    import zstandard

    size = max(SMALLEST_BYTES, min(DICTIONARY_BYTES, *(sum(map(len, texts)) for texts in samples)))
    found = []
    for texts in samples:
        pieces = [t[i : i + PIECE_BYTES] for t in texts for i in range(0, len(t), PIECE_BYTES)]
        raw = b"".join(pieces)
        found.append(raw if len(raw) <= DICTIONARY_BYTES else zstandard.train_dictionary(size, pieces).as_bytes())
    return found


def _curve(x: np.ndarray, y: np.ndarray, share: float) -> tuple[float, float]:
    """Logistic fit by Newton steps with a weak pull to slope 0; labels weighted to the given share of 1."""
    w = np.where(y == 1, share / max(1, (y == 1).sum()), (1 - share) / max(1, (y == 0).sum())) * len(y)
    a, scale = np.stack([np.ones_like(x), x / (x.std() or 1)], axis=1), x.std() or 1
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -60, 60)))
        gradient = a.T @ (w * (y - p)) - 0.01 * beta
        curvature = (a * (w * p * (1 - p))[:, None]).T @ a + 0.01 * np.eye(2)
        step = np.linalg.solve(curvature, gradient)
        beta += step * min(1, 4 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(max(0, beta[1]) / scale)


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE) -> CompressionModel:
    """Fit on at most ``per_class`` training rows of each label of ``labels`` (doc_id, quality)."""
    rows, share = labelled_sample(docs, F.col("text").cast("binary"), labels, "quality", MODULUS, HELD, per_class)
    flat = (float(np.log(share / (1 - share))), 0.0)
    split: dict[int, list[bytes]] = {0: [], 1: []}
    for text, y in zip(rows["feature"].to_pylist(), rows["y"].to_pylist()):
        split[y].append(text)
    if min(map(len, split.values())) < 4:
        return CompressionModel(b"", b"", flat)
    model = CompressionModel(*_dictionaries(split[1][::2], split[0][::2]), flat)
    rest = [(t, y) for y in (0, 1) for t in split[y][1::2]]
    model.curve = _curve(model.differences([t for t, _ in rest]), np.array([y for _, y in rest]), share)
    return model


def score(docs: DataFrame, model: CompressionModel) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted, of whole texts."""
    known = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = known.value.scores([x or b"" for x in batch.column(1).cast(pa.binary()).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
    return found.select(
        "doc_id", (fold("doc_id", MODULUS) == HELD).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
