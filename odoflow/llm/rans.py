"""Operator 1: token-id files by static range asymmetric numeral systems (rANS).

Layout below one folder, Parquet as the container so any store Spark reads works:

- ``frequencies`` (id, freq): one static table, counted over all tokens, scaled
  to sum to 2**SCALE_BITS. Shared by all blocks.
- ``blocks`` (shard, block, start, n_tokens, doc_ids, lengths, payload): whole
  documents in ascending doc_id order, about BLOCK_TOKENS tokens a block (a
  longer document makes a longer block). ``start`` counts all ids before.

A payload is independent of other blocks: a header, the coder states at every
checkpoint, and 32-bit words. LANES states are interleaved: lane j codes ids
j, j + LANES, ... Each checkpoint holds the LANES states and the word position,
so the stretches between checkpoints decode side by side, or alone
(``decode_payload(first, last)``). A CRC-32 over the payload's body is checked
before decoding and the table's CRC-32 must match the table in use.

Defined cases: null text is empty text (its only id is the end id); a null
doc_id sorts first; repeated ids keep one entry a row, in the order of their
texts; an empty table gives files without blocks; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odoflow.llm.common import Scratch, whole_text
from odoflow.llm.tokens import TOKENIZER, encoder

SCALE_BITS = 20
LANES = 1024
BLOCK_TOKENS = 1 << 17
CHECKPOINT_STEPS = 64
LOWEST = np.uint64(1 << 31)
HEADER = struct.Struct("<4sHHIIIIII")  # magic, version, lanes, tokens, steps, checkpoint steps, words, table crc, body crc
MAGIC, VERSION = b"RANS", 1

_RAW = "shard int, block int, prior long, doc_ids array<long>, lengths array<long>, n_tokens long, ids binary, seen array<long>, times array<long>"
_BLOCK = "shard int, block int, start long, n_tokens long, doc_ids array<long>, lengths array<long>, payload binary"
_BLOCK_NAMES = [c.split()[0] for c in _BLOCK.split(", ")]


class Table:
    """Scaled frequencies of the ids that occur, with the lookups of the coder."""

    def __init__(self, ids: np.ndarray, freq: np.ndarray) -> None:
        self.ids, self.freq = ids.astype(np.uint32), freq.astype(np.uint64)
        self.low = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self.crc = zlib.crc32(self.ids.tobytes() + self.freq.tobytes())
        self.place = np.full(int(self.ids[-1]) + 1, -1, np.int64)
        self.place[self.ids] = np.arange(len(self.ids))
        self.slots = np.repeat(np.arange(len(self.ids), dtype=np.int32), self.freq.astype(np.int64))

    @classmethod
    def scaled(cls, ids: np.ndarray, counts: np.ndarray) -> Table:
        """Counts scaled to 2**SCALE_BITS in all, none below 1; ``ids`` ascend."""
        total = 1 << SCALE_BITS
        freq = np.maximum(1, np.floor(counts / counts.sum() * total).astype(np.int64))
        order = np.argsort(-freq, kind="stable")
        off = total - int(freq.sum())
        if off > 0:
            freq[order[0]] += off
        for k in order:  # takes from the most frequent what rounding up to 1 has added
            if off >= 0:
                break
            cut = min(-off, int(freq[k]) // 2)
            freq[k] -= cut
            off += cut
        return cls(ids, freq)


def encode_payload(ids: np.ndarray, table: Table, lanes: int = LANES, every: int = CHECKPOINT_STEPS) -> bytes:
    steps = -(-len(ids) // lanes)
    symbols = np.zeros(steps * lanes, np.int64)
    symbols[: len(ids)] = table.place[ids]
    if len(ids) and symbols.min() < 0:
        raise ValueError("an id is not in the frequency table")
    symbols = symbols.reshape(steps, lanes)
    freq, low = table.freq[symbols], table.low[symbols]
    limit = freq << np.uint64(63 - SCALE_BITS)
    x = np.full(lanes, LOWEST, np.uint64)
    chunks: list[np.ndarray] = []
    saved: list[tuple[int, np.ndarray]] = []
    bits, down, n_words = np.uint64(SCALE_BITS), np.uint64(32), 0
    for t in range(steps - 1, -1, -1):
        over = x >= limit[t]
        if over.any():
            chunks.append(x[over].astype(np.uint32))  # the low 32 bits
            x[over] >>= down
            n_words += len(chunks[-1])
        q, r = np.divmod(x, freq[t])
        x = (q << bits) + r + low[t]
        if t % every == 0:
            saved.append((n_words, x.copy()))
    total = n_words
    body = b"".join(struct.pack("<I", total - before) + state.tobytes() for before, state in reversed(saved))
    body += b"".join(c.tobytes() for c in reversed(chunks))
    return HEADER.pack(MAGIC, VERSION, lanes, len(ids), steps, every, total, table.crc, zlib.crc32(body)) + body


def decode_payload(payload: bytes, table: Table, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids of checkpoint stretches ``first`` to ``last`` (excluded; None: to the end)."""
    magic, version, lanes, n, steps, every, total, crc, body_crc = HEADER.unpack_from(payload)
    body = memoryview(payload)[HEADER.size :]
    if magic != MAGIC or version != VERSION or crc != table.crc or zlib.crc32(body) != body_crc:
        raise ValueError("block does not match its checksum or frequency table")
    count = -(-steps // every)
    last = count if last is None else min(last, count)
    if first >= last:
        return np.zeros(0, np.uint32)
    size = 4 + 8 * lanes
    marks = np.frombuffer(body, np.uint8, count * size).reshape(count, size)[first:last]
    at = marks[:, :4].copy().view("<u4")[:, 0].astype(np.int64)
    x = marks[:, 4:].copy().view("<u8").astype(np.uint64)
    words = np.frombuffer(body, "<u4", total, count * size)
    out = np.zeros((last - first, every, lanes), np.uint32)
    slot_mask, bits, up = np.uint64((1 << SCALE_BITS) - 1), np.uint64(SCALE_BITS), np.uint64(32)
    for t in range(min(every, steps - first * every)):
        live = min(last, -(-(steps - t) // every)) - first  # stretches that have this step
        s, pos = x[:live], at[:live]
        slot = s & slot_mask
        k = table.slots[slot.astype(np.int64)]
        out[:live, t] = table.ids[k]
        s = table.freq[k] * (s >> bits) + slot - table.low[k]
        more = s < LOWEST
        rank = np.cumsum(more, axis=1)
        where = (pos[:, None] + rank - 1)[more]
        s[more] = (s[more] << up) | words[where]
        x[:live] = s
        at[:live] = pos + rank[:, -1]
    return out.reshape(-1)[: max(0, min(n - first * every * lanes, out.size))]


def _raw_blocks(tokenizer: str, block_tokens: int):
    """Blocks of ids, and after them one row a task, without a block, that counts its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, shard, block = encoder(tokenizer), TaskContext.get().partitionId(), 0
        prior = held = 0
        docs: list = []
        lengths: list[int] = []
        parts: list[bytes] = []
        counts = np.zeros(0, np.int64)

        def row(number: int | None, body: bytes | None, seen: np.ndarray | None) -> pa.RecordBatch:
            longs = pa.list_(pa.int64())
            return pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int32()), "block": pa.array([number], pa.int32()),
                "prior": pa.array([prior], pa.int64()), "doc_ids": pa.array([docs], longs), "lengths": pa.array([lengths], longs),
                "n_tokens": pa.array([sum(lengths)], pa.int64()), "ids": pa.array([body], pa.binary()),
                "seen": pa.array([seen], longs), "times": pa.array([None if seen is None else counts[seen]], longs),
            })

        def flush() -> pa.RecordBatch:
            nonlocal counts
            body = b"".join(parts)
            c = np.bincount(np.frombuffer(body, "<u4")).astype(np.int64)
            if len(c) > len(counts):
                counts, c = c, counts
            counts[: len(c)] += c
            return row(block, body, None)

        for batch in batches:
            for doc, ids in zip(batch.column(0).to_pylist(), enc.ids_of(batch.column(1).to_pylist())):
                if lengths and held + len(ids) // 4 > block_tokens:
                    yield flush()
                    block, prior, held, docs, lengths, parts = block + 1, prior + held, 0, [], [], []
                held += len(ids) // 4
                docs.append(doc)
                lengths.append(len(ids) // 4)
                parts.append(ids)
        if lengths:
            yield flush()
            docs, lengths = [], []
            yield row(None, None, np.flatnonzero(counts))

    return run


def write_token_files(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, block_tokens: int = BLOCK_TOKENS) -> None:
    """Encode every whole text of ``docs`` (doc_id, text) to files below ``path``.

    Shuffles the texts once, by ranges of doc_id; each task then encodes its
    range and forms blocks. The driver sees the number of tokens of each range
    and the counts of the ids that occur (at most the vocabulary).
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "rans")
    ordered = (
        docs.select("doc_id", whole_text().alias("text"))
        .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    )
    raw = scratch.save(ordered.mapInArrow(_raw_blocks(tokenizer, block_tokens), _RAW), "raw")
    counted = raw.select(F.explode(F.arrays_zip("seen", "times")).alias("c")).groupBy("c.seen").agg(F.sum("c.times").alias("n"))
    rows = sorted(counted.collect())
    if rows:
        shared = Table.scaled(np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64))
    else:
        shared = Table(np.zeros(1, np.uint32), np.array([1 << SCALE_BITS]))
    freq = [(int(i), int(f)) for i, f in zip(shared.ids, shared.freq)]
    spark.createDataFrame(freq, "id long, freq long").coalesce(1).write.parquet(f"{path}/frequencies")

    sizes = sorted(raw.groupBy("shard").agg(F.sum("n_tokens").alias("n")).collect())
    before, base = 0, {}
    for shard, n in sizes:
        base[shard] = before
        before += n
    known = spark.sparkContext.broadcast((shared, base))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared, base = known.value
        for batch in batches:
            payload = [encode_payload(np.frombuffer(x.as_py(), "<u4"), shared) for x in batch.column("ids")]
            start = [base[k] + n for k, n in zip(batch.column("shard").to_pylist(), batch.column("prior").to_pylist())]
            kept = {c: batch.column(c) for c in ("shard", "block", "n_tokens", "doc_ids", "lengths")}
            kept |= {"start": pa.array(start, pa.int64()), "payload": pa.array(payload, pa.binary())}
            yield pa.RecordBatch.from_pydict({c: kept[c] for c in _BLOCK_NAMES})

    raw.where("block is not null").drop("seen", "times").mapInArrow(encode, _BLOCK).write.option("compression", "none").parquet(f"{path}/blocks")
    scratch.drop("raw")


def read_table(spark: SparkSession, path: str) -> Table:
    """The shared frequency table; at most one row per id of the vocabulary."""
    rows = sorted(spark.read.parquet(f"{path}/frequencies").collect())
    return Table(np.array([r[0] for r in rows]), np.array([r[1] for r in rows]))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids (little-endian unsigned 32-bit, as bytes), ids_crc32."""
    shared = spark.sparkContext.broadcast(read_table(spark, path))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, docs, lengths, payload in zip(*(batch.column(c) for c in ("start", "doc_ids", "lengths", "payload"))):
                ids, n = decode_payload(payload.as_py(), shared.value), np.array(lengths.as_py(), np.int64)
                ends = np.cumsum(n)
                parts = [ids[e - k : e].tobytes() for e, k in zip(ends, n)]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(docs.as_py(), pa.int64()), "start": pa.array(start.as_py() + ends - n, pa.int64()),
                    "n_tokens": pa.array(n, pa.int64()), "ids_crc32": pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                    "ids": pa.array(parts, pa.binary()),
                })

    return spark.read.parquet(f"{path}/blocks").mapInArrow(
        decode, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"
    )
