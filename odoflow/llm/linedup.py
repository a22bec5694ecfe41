"""Operator 8: near-duplicate lines by an exact set-similarity join.

A line is the set of its words. Two lines match if the Jaccard similarity of their
sets is at least SIMILARITY; a line that matches an earlier one (by doc_id, line
number, text) is removed.

Equal sets are one class, held by its first line. Between classes:

1. The words of a line are ordered by rarity: by how often the words of the same of
   2**ORDER_BITS hash cells occur in all lines (one table of bounded size), then by
   hash. Any common order keeps the join exact.
2. Prefix filter: lines that match share one of their first n - ceil(s n) + 1 words,
   so only these are posted; words that occur once are left out.
3. Postings of a word stand in order of size. A sweep pairs each with those near it
   under three filters that lose no match: length, words left after the shared one, and
   the bits in which 64-bit parity signatures differ (at most the words that only one of
   the two has).
4. The lines of the pairs left are read from the documents. Signatures of 64 * PARTS
   bits sift the pairs again, then they are verified: exact Jaccard of the whole sets,
   on the words themselves. The pair whose signatures are closest goes first, the others
   only if it fails.

A line needs only one earlier match. So a sweep looks REACH places back and takes MOST
pairs of a posting; for lines without a match that may have more, the next round looks
STEP times as far and takes STEP times as many, in the words where they may. A group of
thousands of variants ends after a round or two, without all its pairs. The rounds end
when no such line is left: nothing is cut off.

Words are ordered and sets are told apart by 64-bit hashes (two different ones are
equal with a probability of about 5e-20). Postings hold 32 bits of them: words that
meet there add pairs to verify, no result.

Defined cases: null text has no lines; lines without words always stay; repeated
rows (equal id and text) are one document, each row returned with the same result; a
null doc_id sorts first; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odoflow.llm.common import Scratch

SIMILARITY = 0.8
ORDER_BITS = 22
#: Cells of a row of counts.
PART = 1 << 16
#: Places of a word's postings that the first sweep looks back, pairs that it takes of a posting, and what later sweeps multiply both by.
REACH, MOST, STEP = 256, 32, 16
#: Hash cells by which rows are sifted before a join.
SIFT_BITS = 24
#: 64-bit parts of the parity signature of a line to verify.
PARTS = 8
#: Line sets that a task remembers to post each once.
HOLD = 500_000
#: Bytes of lines that a task splits into words at a time (one longer line goes alone).
SLICE = 1 << 18

_LINE = ("doc_id", "line", "text_hash")
_LINES = "doc_id long, text_hash long, line int, set_id long, n int, sign long, posts array<long>"
_CODE = np.int64(0xFFFFFFFF)


def _needed(a: np.ndarray, b: np.ndarray, s: float) -> np.ndarray:
    """Least overlap of two sets of these sizes that match."""
    return np.ceil(s / (1 + s) * (a + b) - 1e-9)


def _cuts(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about SLICE bytes."""
    part = np.cumsum(sizes) // SLICE
    edges = np.flatnonzero(np.diff(part)) + 1
    yield from zip([0, *edges], [*edges, len(sizes)])


_SPACES, _LOWER = bytes(c in b"\t\n\v\f\r " for c in range(256)), bytes(c + 32 * (65 <= c <= 90) for c in range(256))


def _mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of MurmurHash3, a bijection of 64 bits."""
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def _hashes(data: bytes, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words at these places, taken 8 bytes at a time."""
    eights = np.ndarray(len(data) + 1, "<u8", data + bytes(8), strides=(1,))
    found, going = size.astype(np.uint64), np.arange(len(start))
    while len(going):
        at, left = start[going], size[going]
        part = eights[at] & (~np.uint64(0) >> (8 * np.maximum(8 - left, 0)).astype(np.uint64))
        found[going] = _mix((found[going] ^ part) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
        going = going[left > 8]
        start, size = start + 8, size - 8
    return found


def _words(data: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of some lines, each followed by a newline at ``ends``, and the words before the end of each line."""
    blank = np.frombuffer(b"\x01" + data.translate(_SPACES), np.uint8)
    edge = np.flatnonzero(blank[1:] != blank[:-1])  # the last byte is a newline
    start, end = edge[0::2], edge[1::2]
    return _hashes(data.translate(_LOWER), start, end - start), np.searchsorted(start, ends)


def _cells(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - ORDER_BITS)).astype(np.int64)


def _joined(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of some texts (null: empty), each followed by a newline, and where each begins and the last ends."""
    empty, newline = (pa.scalar(x, pa.large_utf8()) for x in ("", "\n"))
    texts = pc.binary_join_element_wise(pc.fill_null(texts.cast(pa.large_utf8()), empty), empty, newline)
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    edges = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(texts.buffers()[2], np.uint8)[edges[0] : edges[-1]], edges - edges[0]


def _lines(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, bytes, np.ndarray]]:
    """(row of the batch, line number, bytes, newline after each line in them) in slices of whole lines."""
    data, edges = _joined(batch.column("text"))
    ends = np.flatnonzero(data == ord("\n"))
    before = np.searchsorted(ends, edges)
    row = np.repeat(np.arange(len(edges) - 1), np.diff(before))
    number, begins = np.arange(len(row)) - before[row], np.append(0, ends + 1)
    for i, j in _cuts(np.diff(begins)):
        if j > i:
            yield row[i:j], number[i:j], data[begins[i] : begins[j]].tobytes(), ends[i:j] - begins[i]


def _coded(lines: pa.Array) -> np.ndarray:
    """For every word of some lines its line << 32 plus its place among their distinct words."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(lines))
    row, coded = np.repeat(np.arange(len(lines)), split.value_lengths().to_numpy()), split.flatten().dictionary_encode()
    code, blank = coded.indices.to_numpy().astype(np.int64), pc.index(coded.dictionary, "").as_py()
    return (row << 32 | code)[code != blank]


def _count_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, counts): occurrences of the words of each cell in a task, PART cells at a time, packed."""
    table = np.zeros(1 << ORDER_BITS, np.int64)
    for batch in batches:
        for _, _, data, ends in _lines(batch):
            np.add.at(table, _cells(_words(data, ends)[0]), 1)
    parts = [k for k in range(len(table) // PART) if table[k * PART : (k + 1) * PART].any()]
    packed = [pa.compress(table[k * PART : (k + 1) * PART].tobytes(), "zstd", asbytes=True) for k in parts]
    yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(packed, pa.binary())], names=["part", "counts"])


def _unpacked(counts: bytes) -> np.ndarray:
    return np.frombuffer(pa.decompress(counts, 8 * PART, "zstd", asbytes=True), np.int64)


def _add_counts(rows: pa.Table) -> pa.Table:
    total = np.zeros(PART, np.int64)
    for counts in rows.column("counts"):
        total += _unpacked(counts.as_py())
    return pa.table([rows.column("part").slice(0, 1), pa.array([pa.compress(total.tobytes(), "zstd", asbytes=True)], pa.binary())], names=["part", "counts"])


def _list(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(values))


def _describe(counts, s: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Lines with words: set, size, signature; once a task for each set (as far as HOLD reaches) the prefix and the line itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for source, number, data, ends in _lines(batch):
                hashes, before = _words(data, ends)
                if not len(hashes):
                    continue
                coded = pa.array(hashes).dictionary_encode()
                hashes = coded.dictionary.to_numpy()
                often = counts.value[_cells(hashes)]
                # By count, then by hash; 24 and 40 bits of them order all but a few.
                order = np.minimum(often, (1 << 24) - 1).astype(np.uint64) << np.uint64(40) | hashes >> np.uint64(24)
                by_rarity = np.argsort(order)
                if not np.diff(order[by_rarity]).all():
                    by_rarity = np.lexsort((hashes, order))
                rank = np.empty(len(hashes), np.int64)
                rank[by_rarity] = np.arange(len(hashes))
                hashes, often = hashes[by_rarity].view(np.int64), often[by_rarity]
                keys = np.sort(np.repeat(np.arange(len(ends)) << 32, np.diff(before, prepend=0)) | rank[coded.indices.to_numpy()])
                keys = keys[np.diff(keys, prepend=-1) != 0]
                code, row = keys & _CODE, keys >> 32
                word, start = hashes[code], np.flatnonzero(np.diff(row, prepend=-1))
                size, held = np.diff(np.append(start, len(row))), row[start]
                place = np.arange(len(row)) - np.repeat(start, size)
                # Sums of the mixed hashes tell sets apart.
                ids = _mix(np.add.reduceat(_mix(word.view(np.uint64) ^ np.uint64(0x5851F42D4C957F2D)), start)).view(np.int64)
                fresh = np.zeros(len(ids), bool)
                for k, i in enumerate(ids.tolist()):
                    if i not in seen:
                        fresh[k] = True
                        seen.add(i)
                if len(seen) > HOLD:
                    seen.clear()
                sign = np.bitwise_xor.reduceat(np.left_shift(np.int64(1), word & 63), start)
                # A set of n words can match one of another size only if it can match one of n + 1.
                fresh &= size * (1 - s) >= s - 1e-9
                post = place < np.repeat(np.where(fresh, size - np.ceil(s * size - 1e-9).astype(np.int64) + 1, 0), size)
                post &= often[code] > 1
                posted = np.add.reduceat(post.astype(np.int64), start)
                at = pa.array(source[held])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(at), batch.column("text_hash").take(at), pa.array(number[held], pa.int32()),
                        pa.array(ids), pa.array(size, pa.int32()), pa.array(sign),
                        _list((word[post] >> 32 << 32) | place[post], posted),
                    ],
                    names=[c.split()[0] for c in _LINES.split(", ")],
                )

    return run


def _sweep(reach: int, most: int, s: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(later, earlier, gap, word) of postings sorted by word and size: pairs at most ``reach`` places apart, at most ``most`` a posting.

    A row (later, null, null, word) says that the line may have more pairs in the
    postings of the word. Only the last ``reach`` rows of a batch, of its last word and
    of sizes that the next rows can match, are kept for the next.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in batches:
            new = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "number", "place", "sign", "open")]
            new += [np.zeros(len(new[0]), np.int64), np.zeros(len(new[0]), bool)]
            old = len(held[0]) if held else 0
            key, ids, place, sign, is_open, met, more = [np.concatenate([h, x]) for h, x in zip(held, new)] if held else new
            n, found = key & _CODE, [np.zeros((3, 0), np.int64)]
            least = key - n + np.ceil(s * n - 1e-9).astype(np.int64)  # the key of the smallest set that one of n words can match
            a = np.arange(old, len(key))
            for d in range(1, reach + 2):
                a = a[np.searchsorted(a, d) :]
                a = a[key[a - d] >= least[a]]
                if not len(a):
                    break
                if d > reach:
                    more[a] = more[a - d] = True
                    break
                b = a - d
                need = _needed(n[a], n[b], s)
                gap = np.bitwise_count((sign[a] ^ sign[b]).view(np.uint64)).astype(np.int64)
                fits = np.flatnonzero(gap <= n[a] + n[b] - 2 * need)
                if not len(fits):
                    continue
                x, y, gap, need = a[fits], b[fits], gap[fits], need[fits]
                later = np.where(ids[x] > ids[y], x, y)
                fits = (np.minimum(n[x] - place[x], n[y] - place[y]) >= need) & (ids[x] != ids[y]) & is_open[later]
                full = met[later] >= most
                more[later[fits & full]] = True
                fits &= ~full
                later, earlier = later[fits], (x + y - later)[fits]
                np.add.at(met, later, 1)
                found.append(np.stack([ids[later], ids[earlier], gap[fits]]))
            pairs = np.unique(np.concatenate(found, axis=1), axis=1)
            left = np.flatnonzero(more & is_open.astype(bool))
            none, paired = pa.nulls(len(left), pa.int64()), pa.nulls(pairs.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([pairs[0], ids[left]])), pa.concat_arrays([pa.array(pairs[1]), none]),
                    pa.concat_arrays([pa.array(pairs[2]), none]), pa.concat_arrays([paired, pa.array((key[left] >> 32).astype(np.int32))]),
                ],
                names=["later", "earlier", "gap", "word"],
            )
            if len(key):
                keep = max(np.searchsorted(key, least[-1]), len(key) - reach - 1)
                held = [x[keep:] for x in (key, ids, place, sign, is_open, met, more)]

    return run


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(number, set_id, raw, n, w0, w1, ...): rows with their size and a parity signature of PARTS parts."""
    for batch in batches:
        for i, j in _cuts(pc.binary_length(batch.column("raw")).to_numpy(zero_copy_only=False) + 1):
            rows = batch.slice(i, j - i)
            data, edges = _joined(rows.column("raw"))
            hashes, before = _words(data.tobytes(), edges[1:] - 1)
            coded = pa.array(hashes).dictionary_encode()
            key = np.unique(np.repeat(np.arange(len(rows)) << 32, np.diff(before, prepend=0)) | coded.indices.to_numpy())
            row, word = key >> 32, coded.dictionary.to_numpy()[key & _CODE]
            bits = np.bincount(row * (64 * PARTS) + (word % np.uint64(64 * PARTS)).astype(np.int64), minlength=64 * PARTS * len(rows)) & 1
            parts = np.packbits(bits.astype(np.uint8)).view(np.int64).reshape(len(rows), PARTS)
            columns = [*rows.columns, pa.array(np.bincount(row, minlength=len(rows)).astype(np.int32)), *(pa.array(np.ascontiguousarray(parts[:, k])) for k in range(PARTS))]
            yield pa.RecordBatch.from_arrays(columns, names=["number", "set_id", "raw", "n", *(f"w{k}" for k in range(PARTS))])


def _verify(s: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(matched_id, matched_set) of rows (later, set_id, a, b) whose lines match."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.add(pc.binary_length(batch.column("a")), pc.binary_length(batch.column("b"))).to_numpy(zero_copy_only=False)
            for i, j in _cuts(sizes):
                pairs = batch.slice(i, j - i)
                m = len(pairs)
                key = np.unique(_coded(pa.concat_arrays([pairs.column("a"), pairs.column("b")])))
                size = np.bincount(key >> 32, minlength=2 * m)
                edge = np.searchsorted(key, np.int64(m) << 32)
                both = np.bincount(np.intersect1d(key[:edge], key[edge:] - (np.int64(m) << 32), assume_unique=True) >> 32, minlength=m)
                pairs = pairs.filter(pa.array(both >= _needed(size[:m], size[m:], s)))
                yield pa.RecordBatch.from_arrays([pairs.column("later"), pairs.column("set_id")], names=["matched_id", "matched_set"])

    return run


def _sifted(rows: DataFrame, column: str, wanted: DataFrame, name: str) -> DataFrame:
    """``rows`` without most of those whose ``column`` is not among ``name`` of ``wanted``: those in none of its
    2**SIFT_BITS hash cells. What is broadcast is bounded; a join still has to follow."""
    of = f"xxhash64({{}}) & {(1 << SIFT_BITS) - 1}L"
    bit = "shiftleft(1L, cast({} & 63L as int))"
    cells = wanted.select(F.expr(of.format(name)).alias("cell")).groupBy(F.shiftright("cell", 6).alias("block")).agg(F.bit_or(F.expr(bit.format("cell"))).alias("bits"))
    met = rows.withColumn("cell", F.expr(of.format(column))).withColumn("at_block", F.shiftright("cell", 6))
    met = met.join(F.broadcast(cells), F.col("at_block") == F.col("block")).where(F.expr(f"(bits & {bit.format('cell')}) != 0L"))
    return met.select(*rows.columns)


class LineDedup:
    """Removed lines of ``docs`` (doc_id, text)."""

    def __init__(self, docs: DataFrame, similarity: float = SIMILARITY) -> None:
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        self.s, self.scratch = similarity, Scratch(docs.sparkSession, "lines", tidy=True)
        self.lines = self._lines()
        at = F.struct(*_LINE)
        first = self.lines.groupBy("set_id").agg(F.min(at).alias("first"), F.min(F.when(F.size("posts") > 0, at)).alias("shown"))
        # The classes, numbered in the order of their first lines.
        first = self.scratch.save(first, "first").orderBy("first.doc_id", "first.line", "set_id").withColumn("number", F.monotonically_increasing_id())
        self.first = self.scratch.save(first.withColumnRenamed("set_id", "first_id"), "classes")
        self.scratch.drop("first")
        self.matched = self._matched()
        self.removed = self._removed()
        for done in ("lines", "classes"):
            self.scratch.drop(done)

    def _lines(self) -> DataFrame:
        """The lines that have words, as _LINES says."""
        counts = self.docs.select("text").mapInArrow(_count_cells, "part int, counts binary")
        counts = counts.groupBy("part").applyInArrow(_add_counts, "part int, counts binary")
        table = np.zeros((1 << ORDER_BITS) // PART * PART, np.uint32)
        for row in counts.collect():
            table[row.part * PART : (row.part + 1) * PART] = np.minimum(_unpacked(row.counts), 0xFFFFFFFF)
        counts = self.docs.sparkSession.sparkContext.broadcast(table)
        rows = self.docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
        return self.scratch.save(rows.mapInArrow(_describe(counts, self.s), _LINES), "lines")

    def _texts(self, pairs: DataFrame, k: int) -> DataFrame:
        """(number, set_id, raw): a line of every class in ``pairs``."""
        wanted = pairs.select(F.explode(F.array("later", "earlier")).alias("number")).distinct().join(self.first.select("number", F.col("first_id").alias("set_id"), "first"), "number")
        wanted = self.scratch.save(wanted, f"wanted-{k}")
        every = self.docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n")).alias("line", "raw"))
        every = every.select(F.struct(*_LINE).alias("at"), "raw")
        held = _sifted(every, "at", wanted, "first").join(wanted, F.col("at").eqNullSafe(F.col("first")))
        held = held.groupBy("number", "set_id").agg(F.first("raw").alias("raw"))
        return self.scratch.save(held.mapInArrow(_sign, "number long, set_id long, raw string, n int, " + ", ".join(f"w{k} long" for k in range(PARTS))), f"texts-{k}")

    def _close(self, pairs: DataFrame, texts: DataFrame, k: int) -> DataFrame:
        """(later, earlier, gap): the pairs whose longer signatures differ in no more bits than those of lines that match."""
        signs = texts.drop("set_id", "raw")
        a, b = (signs.select(F.col("number").alias(x), *(F.col(c).alias(f"{x}_{c}") for c in signs.columns[1:])) for x in ("later", "earlier"))
        met = pairs.select("later", "earlier").distinct().join(a, "later").join(b, "earlier")
        gap = F.expr(" + ".join(f"bit_count(later_w{k} ^ earlier_w{k})" for k in range(PARTS)))
        both = F.col("later_n") + F.col("earlier_n")
        met = met.select("later", "earlier", gap.alias("gap"), (both - 2 * F.ceil(both * (self.s / (1 + self.s)) - 1e-9)).alias("most"))
        return self.scratch.save(met.where("gap <= most").select("later", "earlier", "gap"), f"close-{k}")

    def _matches(self, pairs: DataFrame, texts: DataFrame, name: str) -> DataFrame:
        """(matched_id, matched_set): the later classes of ``pairs`` that match the earlier one."""
        met = pairs.join(texts.select(F.col("number").alias("later"), "set_id", F.col("raw").alias("a")), "later")
        met = met.join(texts.select(F.col("number").alias("earlier"), F.col("raw").alias("b")), "earlier")
        return self.scratch.save(met.select("later", "set_id", "a", "b").mapInArrow(_verify(self.s), "matched_id long, matched_set long").distinct(), name)

    def _matched(self) -> DataFrame:
        """(matched_id, matched_set): number and set of the classes that match an earlier one."""
        scratch, first = self.scratch, self.first.where("shown is not null")
        shown = self.lines.where("size(posts) > 0").join(first, (F.col("set_id") == F.col("first_id")) & F.struct(*_LINE).eqNullSafe(F.col("shown")))
        # One row a class, but for repeated rows of documents, which the sweep passes over.
        classes = scratch.save(shown.select("number", "n", "sign", "posts"), "prefixes")
        posts = classes.select("number", "n", "sign", F.explode("posts").alias("at"))
        word = F.shiftright("at", 32)
        posts = posts.select((F.shiftleft(word, 32) + F.col("n")).alias("key"), word.cast("int").alias("word"), F.expr("cast(at & 4294967295L as int)").alias("place"), "number", "sign")
        matched, ahead = None, None
        for k in count(1):
            rows, is_open = posts, F.lit(True)
            if ahead is not None:
                rows = _sifted(posts, "word", ahead, "word").join(ahead.select(F.col("later").alias("number"), F.lit(True).alias("open")).distinct(), "number", "left")
                is_open = F.coalesce("open", F.lit(False))
            swept = rows.repartition("word").sortWithinPartitions("key").select("key", "number", "place", "sign", is_open.alias("open"))
            swept = scratch.save(swept.mapInArrow(_sweep(REACH * STEP ** (k - 1), MOST * STEP ** (k - 1), self.s), "later long, earlier long, gap long, word int"), f"swept-{k}")
            pairs = swept.where("earlier is not null")
            texts = self._texts(pairs, k)
            pairs = self._close(pairs, texts, k)
            best = scratch.save(pairs.groupBy("later").agg(F.min(F.struct("gap", "earlier"))["earlier"].alias("earlier")), f"best-{k}")
            near = self._matches(best, texts, f"near-best-{k}")
            others = pairs.select("later", "earlier").join(best, ["later", "earlier"], "left_anti")
            others = scratch.save(others.join(near, others["later"] == near["matched_id"], "left_anti"), f"others-{k}")
            near = near.unionByName(self._matches(others, texts, f"near-others-{k}"))
            matched = near if matched is None else matched.unionByName(near)
            more = swept.where("word is not null").select("later", "word").distinct()
            ahead = scratch.save(more.join(matched, more["later"] == matched["matched_id"], "left_anti"), f"ahead-{k}")
            for done in ("swept", "wanted", "texts", "close", "best", "others"):
                scratch.drop(f"{done}-{k}")
            if ahead.isEmpty():
                scratch.drop("prefixes")
                return matched

    def _removed(self) -> DataFrame:
        """(doc_id, text_hash, lines): numbers of the lines to remove, ascending."""
        where, matched = self.lines.select("set_id", *_LINE), self.matched.select("matched_set").distinct()
        first = self.first.join(matched, F.col("first_id") == F.col("matched_set"), "left").select("first_id", "first", F.col("matched_set").isNotNull().alias("matched"))
        lost = where.join(first, where["set_id"] == first["first_id"]).where(F.col("matched") | ~F.struct(*_LINE).eqNullSafe(F.col("first")))
        lost = lost.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("line")).alias("lines"))
        return self.scratch.save(lost.select(F.col("doc_id").alias("lost_id"), F.col("text_hash").alias("lost_hash"), "lines"), "removed")

    def report(self) -> DataFrame:
        """Per row of ``docs``: doc_id, n_lines, n_removed, and the text of the lines that stay."""
        docs, lost = self.docs.withColumn("text_hash", F.xxhash64("text")), self.removed
        met = docs.join(lost, docs["doc_id"].eqNullSafe(lost["lost_id"]) & (docs["text_hash"] == lost["lost_hash"]), "left")
        kept = F.expr("filter(split(text, '\\n'), (x, i) -> not array_contains(lines, i))")
        return met.select(
            "doc_id", F.coalesce(F.array_size(F.split("text", "\n")), F.lit(0)).cast("long").alias("n_lines"),
            F.coalesce(F.array_size("lines"), F.lit(0)).cast("long").alias("n_removed"),
            F.when(F.col("lines").isNull(), F.coalesce("text", F.lit(""))).otherwise(F.array_join(kept, "\n")).alias("text"),
        )
