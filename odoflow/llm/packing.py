"""Operator 6: best-fit packing in bulk-synchronous rounds.

Whole texts become pieces of at most ``max_tokens`` ids; only longer documents
are cut (a shorter first piece, then full pieces, each full piece a sequence of
its own). The rest is packed in rounds, in descending order of size:

1. pieces and gaps stand in order of size; a round takes the waiting pieces of the
   largest size and sweeps to its successor among the gaps, the smallest that holds it;
2. the rank decides among equals: the k-th waiting piece takes the k-th such gap;
3. matched gaps shrink, and are gaps of their new size in the next round; pieces that
   no gap holds open sequences, no more than they fill themselves.

Sizes are whole numbers up to ``max_tokens``, so the sweeps run over size
classes (size, count) in place of single rows: the outcome is the same, and their
state is bounded by the sequence length, not by the corpus. Spark does
what grows with the corpus: tokenising, the range sort of all pieces by size,
the count of each size and range (ranks), and the hand-out of each piece to its
sequence by rank. The k-th piece of a size is found from its range's first rank
and its place in the range, so a size that a third of all pieces share is spread
over many tasks.

Defined cases: null text is empty text (one id, the end id); a null doc_id and
repeated ids are pieces like any other; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odoflow.llm.common import Scratch, whole_text
from odoflow.llm.tokens import TOKENIZER, encoder

MAX_TOKENS = 2048

_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
_RANKED = f"{_PIECE}, range int, place long"
_PACKED = f"{_PIECE}, sequence_id long, offset long"


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _cut(tokenizer: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = enc.ids(text.as_py())
                n = len(ids) // 4
                ends = range(n % size or size, n + 1, size)
                rows += ((doc, k, max(0, e - size) if k else 0, min(e, size), zlib.crc32(memoryview(ids)[4 * max(0, e - size) : 4 * e])) for k, e in enumerate(ends))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 5, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                names=_names(_PIECE),
            )

    return run


def _place_in_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows get the number of their range and, of their length, the rows before them in it."""
    part, last, seen = TaskContext.get().partitionId(), -1, 0
    for batch in batches:
        lengths = batch.column("length").to_numpy()
        if not len(lengths):
            continue
        change = np.flatnonzero(np.diff(lengths)) + 1
        first = np.concatenate([[0], change])
        place = np.arange(len(lengths)) - np.repeat(first, np.diff(np.append(first, len(lengths))))
        if lengths[0] == last:
            place[: change[0] if len(change) else None] += seen
        last, seen = lengths[-1], place[-1] + 1
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(lengths), part), pa.int32()), pa.array(place, pa.int64())], names=_names(_RANKED)
        )


class Quota:
    """Rounds of matching over size classes; the outcome as rank intervals of each size.

    ``gaps[room]`` lists (first sequence, count) of the sequences with that free room.
    ``slots[size]`` lists (first rank, count, first sequence, offset): the pieces of
    that size with these ranks go to consecutive sequences, at that offset.
    """

    def __init__(self, counts: dict[int, int], size: int) -> None:
        self.size, self.used, self.rounds = size, 0, 0
        self.slots: dict[int, list[tuple[int, int, int, int]]] = {}
        self.gaps: dict[int, list[tuple[int, int]]] = {}
        self.rooms: list[int] = []  # the keys of ``gaps``, ascending
        for length in sorted(counts, reverse=True):
            rank = 0
            while rank < counts[length]:
                rank += self._round(length, rank, counts[length] - rank)

    def _round(self, length: int, rank: int, waiting: int) -> int:
        """Matches waiting pieces with the gaps of the successor size, or else with new sequences; returns how many."""
        self.rounds += 1
        k = bisect_left(self.rooms, length)
        if k < len(self.rooms):
            room = self.rooms[k]
            sequence, n = self.gaps[room].pop()
        else:
            room, sequence, n = self.size, self.used, -(-waiting // (self.size // length))
            self.used += n
        take = min(n, waiting)
        self.slots.setdefault(length, []).append((rank, take, sequence, self.size - room))
        if take < n:
            self._free(room, sequence + take, n - take)
        elif room in self.gaps and not self.gaps[room]:
            del self.gaps[room], self.rooms[k]
        self._free(room - length, sequence, take)
        return take

    def _free(self, room: int, sequence: int, n: int) -> None:
        if room:
            if room not in self.gaps:
                insort(self.rooms, room)
            self.gaps.setdefault(room, []).append((sequence, n))

    def arrays(self) -> dict[int, np.ndarray]:
        """By size: rows (first rank, first sequence, offset) in order of rank."""
        return {k: np.array([(a, s, o) for a, _, s, o in v], np.int64) for k, v in self.slots.items()}


def pack(docs: DataFrame, max_tokens: int = MAX_TOKENS, tokenizer: str = TOKENIZER) -> DataFrame:
    """Pieces of all ``docs`` (doc_id, text) with their place: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "pack")
    cut = docs.select("doc_id", whole_text().alias("text")).mapInArrow(_cut(tokenizer, max_tokens), _PIECE)
    pieces = scratch.save(cut, "pieces")
    order = ("length", "doc_id", "piece", "ids_crc32")
    ranked = scratch.save(
        pieces.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_place_in_range, _RANKED), "ranked"
    )
    # At most (ranges + sizes) rows: a range holds a contiguous stretch of sizes.
    sizes = sorted((r["length"], r["range"], r["n"]) for r in ranked.groupBy("length", "range").agg(F.count("*").alias("n")).collect())
    first: dict[tuple[int, int], int] = {}
    counts: Counter[int] = Counter()
    for length, part, n in sizes:
        first[length, part] = counts[length]
        counts[length] += n
    known = spark.sparkContext.broadcast((first, Quota(counts, max_tokens).arrays()))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, slots = known.value
        for batch in batches:
            length, part, place = (batch.column(c).to_numpy() for c in ("length", "range", "place"))
            sequence, offset = np.zeros((2, len(length)), np.int64)
            for key in np.unique(length * (1 << 32) + part):
                size, k = int(key >> 32), int(key & 0xFFFFFFFF)
                rows = np.flatnonzero((length == size) & (part == k))
                rank, table = place[rows] + first[size, k], slots[size]
                at = np.searchsorted(table[:, 0], rank, "right") - 1
                sequence[rows] = table[at, 1] + rank - table[at, 0]
                offset[rows] = table[at, 2]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)], names=_names(_PACKED)
            )

    return ranked.mapInArrow(assign, _PACKED)
