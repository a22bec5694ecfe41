"""Operator 3: SimHash near-duplicates by Golay-code fuzzy hashing.

A fingerprint's 64 bits are cut into three segments. If two fingerprints differ
in at most 4 bits, at least two segments differ in at most 2 bits each (two
segments with 3 or more would make 6). Segments within 2 bits share a Golay key
(``golay.py``), so the fingerprints share a pair of keys of two segments. The
join on such pairs therefore misses no link; the bit distance is then verified.

Identical fingerprints are one node first. Rows of a key come sorted to a task,
which compares them in blocks and passes on no more than a spanning forest of
the links (components are the same). A key with more rows than a block is not
compared there: its pairs of blocks are dealt to other tasks.

Defined cases: null text has no words, fingerprint zero, and is linked like any
other; a null doc_id takes part but is never a component id unless its whole
component has none; repeated rows get one row each; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odoflow.llm import golay
from odoflow.llm.common import Scratch
from odoflow.llm.components import components

SHINGLE = 4
MAX_BITS = 4
SEED = 42
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Rows of one key that a task compares at once; longer runs are dealt out in pairs of such blocks.
BLOCK = 4096

_LANES = np.uint64(0x0101010101010101)


def _fingerprint(h: np.ndarray) -> int:
    """Majority of each bit; bytes of a word serve as counters of up to 255 hashes at once."""
    counts = np.zeros((8, 8), np.int64)
    for i in range(0, len(h), 255):
        part = h[i : i + 255]
        for bit in range(8):
            counts[:, bit] += np.add.reduce((part >> np.uint64(bit)) & _LANES, keepdims=True).view(np.uint8)
    return int.from_bytes(np.packbits(counts * 2 > len(h), axis=1, bitorder="little").tobytes(), "little")


def _hashes(text: bytes, size: int) -> np.ndarray:
    words = text.lower().split()  # of bytes: A-Z and the six ASCII white spaces
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(1, len(words) - size + 1)
    stops = ends[min(size, len(words)) - 1 :].tolist()
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(line[a:b], SEED) for a, b in zip(starts, stops)], np.uint64)


def fingerprints(docs: DataFrame, size: int = SHINGLE, also: tuple[str, ...] = ()) -> DataFrame:
    """doc_id and the fingerprint (long) of every whole text, and the columns ``also``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_fingerprint(_hashes(x.as_py() or b"", size)) for x in batch.column(1).cast(pa.binary())]
            kept = [batch.column(c) for c in also]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(found, np.uint64).view(np.int64)), *kept], names=["doc_id", "fp", *also])

    schema = ", ".join(["doc_id long", "fp long", *(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in also)])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *also).mapInArrow(run, schema)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, fp): a row for every pair of keys of two segments."""
    for batch in batches:
        fps = batch.column(0).to_numpy()
        bits = fps.view(np.uint64)
        own = []
        for low, width in SEGMENTS:
            own.append(golay.keys(((bits >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.int64), width))
        for k, (s, t) in enumerate(combinations(own, 2)):
            count = s[1] * t[1]
            row = np.repeat(np.arange(len(fps)), count)
            i = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            a = s[2][s[0][row] + i // t[1][row]].astype(np.int64)
            b = t[2][t[0][row] + i % t[1][row]].astype(np.int64)
            for at in range(0, len(row), 100_000):
                cut = slice(at, at + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array((k << 24) + (a[cut] << 12) + b[cut]), pa.array(fps[row[cut]])], names=["key", "fp"])


class _Forest:
    """Spanning forest of links between the places 0 .. n-1."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)
        self.a: list[np.ndarray] = []
        self.b: list[np.ndarray] = []

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.root[a], self.root[b]
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            if not len(a):
                return
            high, low = np.maximum(ra, rb), np.minimum(ra, rb)
            _, one = np.unique(high, return_index=True)  # each root is hung once a pass: no cycle, no lost link
            self.a.append(a[one])
            self.b.append(b[one])
            self.root[high[one]] = low[one]
            while not np.array_equal(up := self.root[self.root], self.root):
                self.root = up

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *self.a]), np.concatenate([none, *self.b])


def _near(fps: np.ndarray, group: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Forest of the links within equal ``group`` values (sorted); as fingerprints."""
    bits = fps.view(np.uint64)
    bounds = np.flatnonzero(np.diff(group, prepend=group[:1] - 1, append=group[-1:] + 1))
    left = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(len(fps))  # rows to the end of the group
    forest = _Forest(len(fps))
    at, step = np.flatnonzero(left > 1), 1
    while len(at):
        close = at[np.bitwise_count(bits[at] ^ bits[at + step]) <= most]
        forest.link(close, close + step)
        step += 1
        at = at[left[at] > step]
    a, b = forest.links()
    return fps[a], fps[b]


def _joined(block: int, most: int):
    """Sorted (key, fp) rows -> links (kind 0: a, b), or rows of a long key (kind 1: place in key's run a, fp b)."""

    def out(kind: int, key: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind), pa.int32()), pa.array(key), pa.array(a), pa.array(b)], names=["kind", "key", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 2
        sent, long_key = 0, None
        for batch in _ending(batches):
            if batch is not None:
                held = [np.concatenate([h, batch.column(k).to_numpy()]) for k, h in enumerate(held)]
            key, fps = held
            if not len(key):
                continue
            end = len(key) if batch is None else int(np.searchsorted(key, key[-1]))  # the last key may go on
            if long_key is not None:  # more rows of a key that is already long
                n = int(np.searchsorted(key, long_key, "right"))
                if n:
                    yield out(1, key[:n], np.arange(sent, sent + n), fps[:n])
                    sent += n
                    key, fps, end = key[n:], fps[n:], max(0, end - n)
                if len(key):
                    long_key = None
            if end:
                done_key, done = key[:end], fps[:end]
                bounds = np.flatnonzero(np.diff(done_key, prepend=done_key[0] - 1, append=done_key[-1] + 1))
                size = np.repeat(np.diff(bounds), np.diff(bounds))
                short = size <= block
                a, b = _near(done[short], done_key[short], most) if short.any() else (done[:0], done[:0])
                yield out(0, np.zeros(len(a), np.int64), a, b)
                for i, j in zip(bounds[:-1], bounds[1:]):
                    if j - i > block:
                        yield out(1, done_key[i:j], np.arange(j - i), done[i:j])
                key, fps = key[end:], fps[end:]
            if len(key) > block:  # one key only: it goes on to the other tasks
                yield out(1, key, np.arange(len(key)), fps)
                long_key, sent, key, fps = key[0], len(key), key[:0], fps[:0]
            held = [key, fps]

    return run


def _ending(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _compare_blocks(most: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        fps = np.unique(table.column("b").to_numpy())
        a, b = _near(fps, np.zeros(len(fps), np.int64), most)
        return pa.table({"a": a, "b": b})

    return run


def links(nodes: DataFrame, scratch: Scratch, most: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """(a, b): links between distinct fingerprints ``nodes`` (fp) that connect all pairs of at most ``most`` <= 4 differing bits."""
    if not 0 <= most <= 4:
        raise ValueError("three segments find at most 4 differing bits")
    rows = nodes.select("fp").mapInArrow(_keys, "key long, fp long")
    found = rows.repartition("key").sortWithinPartitions("key").mapInArrow(_joined(block, most), "kind int, key long, a long, b long")
    found = scratch.save(found, "found")
    near = found.where("kind = 0").select("a", "b")
    # Long keys: blocks i and j of a key meet in one task; a row goes to as many tasks as its key has blocks.
    long = found.where("kind = 1").select("key", F.expr(f"a div {block}").alias("i"), "b")
    blocks = long.groupBy("key").agg((F.max("i") + 1).alias("n"))
    dealt = (
        long.join(blocks, "key")
        .select("key", "i", "b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("j"))
        .select("key", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"), "b")
    )
    far = dealt.groupBy("key", "i", "j").applyInArrow(_compare_blocks(most), "a long, b long")
    return near.unionByName(far)


def near_duplicates(docs: DataFrame, size: int = SHINGLE, most: int = MAX_BITS, also: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, fingerprint (hex), component_id; with ``also``, those columns
    and the root: the fingerprint that names the component, whatever its ids."""
    scratch = Scratch(docs.sparkSession, "simhash")
    prints = scratch.save(fingerprints(docs, size, also), "prints")
    nodes = scratch.save(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    roots = scratch.save(components(links(nodes, scratch, most), scratch), "roots")
    placed = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    placed = scratch.save(placed, "placed")
    ids = scratch.save(placed.groupBy("root").agg(F.min("first").alias("component_id")), "ids")
    named = scratch.save(placed.join(ids, "root").select(F.col("fp").alias("node"), "component_id", "root"), "named")
    return prints.join(named, prints["fp"] == named["node"]).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", *also, *(["root"] if also else [])
    )
