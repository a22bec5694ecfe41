"""Operator 11: alignment of two tokenizers by inverted pair bitmaps.

Every text is encoded by a byte-level vocabulary A (space + text) and a piece
vocabulary B (which adds the space itself). Where an A and a B token both end, a
group ends; an A and a B token whose byte ranges overlap are linked.

Documents are numbered by (block, slot), slot below 65,536: the block is the high part
of the number, as in a Roaring bitmap. For each pair of ids the *index* holds one row a
block: the pair's compressed bitmaps of slots, one for each binary digit of how often the
document links the pair (multiplicity planes). Each bitmap is a sorted list of slots or,
beyond 4096 of them, 65,536 bits. OR of a pair's planes, popcounted, is its number of
documents; the planes' popcounts, weighted by their digits, are its number of links.
Bitmaps of one block come from one task; blocks stand for different documents, so a
pair's merged bitmap is its blocks side by side and popcounts add up: ``pairs``.

The postings return scores: a pair's corpus-wide count meets the pair's index rows, these
go to their blocks, and every set slot receives the count, as often as its planes say.
Only compressed postings are shuffled, never one row for each link; a block is closed at
65,536 documents or POSTINGS postings (and the document that reaches that), so what one
task holds is bounded. A pair that occurs in very many blocks is met by a join that Spark
splits (adaptive skew join).

Defined cases: null and empty texts, and texts whose joined token bytes are not space +
text, have no tokens: zeros and an empty digest; equal rows, and rows with equal or null
doc_id, are documents of their own; empty tables give no rows; other columns are
ignored; texts of any length are taken whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odoflow.llm.common import Scratch
from odoflow.llm.tokens import TOKENIZER, Encoder, _printable_bytes

PIECES = "piece_bpe_32k.model"
SLOTS = 1 << 16
POSTINGS = 2_000_000
_LIST = 4096  # slots of the longest list; more are written as bits
_TOKENS = 400_000  # tokens that are aligned together
_LONG = 1 << 16  # code points that vocabulary B encodes at once, and those up to the next space
_MARK = "▁"


def _path(name: str) -> str:
    import public_tokenizers

    return name if "/" in name else public_tokenizers.path(name)


class ByteEncoder(Encoder):
    """Vocabulary A; strings of special tokens are plain text."""

    def __init__(self, path: str) -> None:
        super().__init__(path)
        self.tokenizer.encode_special_tokens = True
        self.added = []
        code = {c: b for b, c in _printable_bytes().items()}
        self.bytes = [bytes(map(code.__getitem__, self.tokenizer.id_to_token(i))) for i in range(self.tokenizer.get_vocab_size())]

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(self.ids(text), "<u4")[:-1]


class PieceEncoder:
    """Vocabulary B. No piece holds the space mark behind another character, so no merge crosses the start of a run of
    spaces: long texts are cut there, so that the library's working memory stays bounded."""

    _START = re.compile(r"(?<! ) ")

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.apart = not any(_MARK in p.lstrip(_MARK) for p in pieces)
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(_MARK, " ").encode() for i, p in enumerate(pieces)]
        self.space = [self.model.piece_to_id(_MARK)]

    def encode(self, text: str) -> np.ndarray:
        if len(text) <= _LONG or not self.apart:
            return np.array(self.model.encode(text, num_threads=1), "<u4")
        whole, at, out = " " + text, 0, []
        while at < len(whole):
            start = self._START.search(whole, at + _LONG)
            end = start.start() if start else len(whole)
            # The library adds the first space itself; of a space alone it would make nothing.
            out.append(np.array(self.model.encode(whole[at + 1 : end], num_threads=1) if end - at > 1 else self.space, "<u4"))
            at = end
        return np.concatenate(out)


class Aligner:
    """Both vocabularies of one Python worker."""

    def __init__(self, a_name: str, b_name: str) -> None:
        self.a, self.b = ByteEncoder(_path(a_name)), PieceEncoder(_path(b_name))
        self.a_size, self.b_size = (np.array([len(x) for x in e.bytes], np.int64) for e in (self.a, self.b))
        # How an id is written in the digest: an A id inside or at the end of its group's A ids, a B id likewise.
        self.written = [f"{i}{end}".encode() for n, ends in ((len(self.a_size), ",|"), (len(self.b_size), ",;")) for end in ends for i in range(n)]

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray, int]:
        """Ids by A and B and the number of bytes; none if the joined bytes are not space + text."""
        none = np.empty(0, "<u4")
        if not text:
            return none, none, 0
        raw = (" " + text).encode()
        a, b = self.a.encode(" " + text), self.b.encode(text)
        for ids, table in ((a, self.a.bytes), (b, self.b.bytes)):
            if b"".join(map(table.__getitem__, ids.tolist())) != raw:
                return none, none, 0
        return a, b, len(raw)

    def align(self, texts: list[tuple[np.ndarray, np.ndarray, int]]):
        """Of several texts' tokens: groups and links of each, its written groups, and (A id, B id, text) of every link."""
        a, b = (np.concatenate([t[k] for t in texts]).astype(np.int64) for k in (0, 1))
        a_end, b_end, text_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b]), np.cumsum([t[2] for t in texts])
        ends = np.sort(np.concatenate((a_end, b_end)), kind="stable")  # two ascending runs: merged
        ends = ends[np.r_[True, ends[1:] != ends[:-1]]] if len(ends) else ends
        # Each end closes a piece that lies in one A and one B token: the pieces are the links.
        a_at, b_at = np.searchsorted(ends, a_end), np.searchsorted(ends, b_end)
        is_a, is_b = np.zeros(len(ends), np.int64), np.zeros(len(ends), np.int64)
        is_a[a_at], is_b[b_at] = 1, 1
        a_upto, b_upto, is_cut = np.cumsum(is_a), np.cumsum(is_b), is_a & is_b
        cut_upto = np.cumsum(is_cut)
        pairs = (a[a_upto - is_a] << 16) | b[b_upto - is_b]
        # A text without tokens ends where the one before it ends: nothing lies between.
        done = np.searchsorted(ends, text_end, "right")
        links, of = np.diff(done, prepend=0), np.repeat(np.arange(len(texts)), np.diff(done, prepend=0))
        groups = np.diff(np.r_[0, cut_upto][done], prepend=0)
        # In the digest every group's A ids stand before its B ids.
        closes = np.flatnonzero(is_cut)
        a_group, b_group = (cut_upto - is_cut)[a_at], (cut_upto - is_cut)[b_at]
        line = np.empty(len(a) + len(b), np.int64)
        line[np.arange(len(a)) + np.r_[0, b_upto[closes]][a_group]] = a + len(self.a_size) * is_cut[a_at]
        line[np.arange(len(b)) + a_upto[closes][b_group]] = b + 2 * len(self.a_size) + len(self.b_size) * is_cut[b_at]
        at, written = 0, []
        for x, y, _ in texts:
            size = len(x) + len(y)
            written.append(b"".join(map(self.written.__getitem__, line[at : at + size].tolist()))[:-1])
            at += size
        return groups, links, written, pairs, of


@lru_cache(maxsize=2)
def aligner(a_name: str, b_name: str) -> Aligner:
    return Aligner(a_name, b_name)


# ---------------------------------------------------------------- bitmaps with multiplicity planes


def pack(pair: np.ndarray, slot: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(pair, documents, links, planes) of each pair; the input is sorted by (pair, slot), each once, ``times`` > 0.

    planes: for each digit in use, ascending, the digit, popcount - 1, and the bitmap, in 16-bit integers.
    """
    first = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
    digits = int(times.max()).bit_length()
    rank = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(pair)]))
    where = [np.flatnonzero((times >> k) & 1) for k in range(digits)]
    owner, digit, slots = np.concatenate([rank[w] for w in where]), np.repeat(np.arange(digits), [len(w) for w in where]), np.concatenate([slot[w] for w in where])
    order = np.lexsort((digit, owner)) if digits > 1 else np.arange(len(owner))  # stable: slots stay ascending
    owner, digit, slots = owner[order], digit[order], slots[order]
    start = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (digit[1:] != digit[:-1])])
    count = np.diff(np.r_[start, len(owner)])
    size = 2 + np.where(count > _LIST, SLOTS // 16, count)
    at = np.cumsum(size) - size
    out = np.zeros(size.sum(), "<u2")
    out[at], out[at + 1] = digit[start], count - 1
    listed = np.repeat(count <= _LIST, count)
    out[(np.repeat(at + 2 - start, count) + np.arange(len(owner)))[listed]] = slots[listed]
    for s in np.flatnonzero(count > _LIST):
        bits = np.zeros(SLOTS, np.uint8)
        bits[slots[start[s] : start[s] + count[s]]] = 1
        out[at[s] + 2 : at[s] + size[s]] = np.packbits(bits, bitorder="little").view("<u2")
    heads = np.flatnonzero(np.r_[True, owner[start][1:] != owner[start][:-1]])
    links = np.add.reduceat(count.astype(np.int64) << digit[start], heads)
    offsets = np.r_[at[heads], len(out)].astype(np.int32) * 2
    planes = pa.BinaryArray.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(out)])
    return pair[first], np.diff(np.r_[first, len(pair)]), links, planes


def unpack(planes: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, slot, weight) of all set bits, one digit of every row at a time."""
    offsets = np.frombuffer(planes.buffers()[1], np.int32)[planes.offset : planes.offset + len(planes) + 1].astype(np.int64) // 2
    data = np.frombuffer(planes.buffers()[2] or b"", "<u2", count=int(offsets[-1]))
    rows, at = np.arange(len(planes)), offsets[:-1].copy()
    while True:
        left = at < offsets[rows + 1]
        rows, at = rows[left], at[left]
        if not len(rows):
            return
        digit, count = data[at].astype(np.int64), data[at + 1].astype(np.int64) + 1
        listed = count <= _LIST
        many = count[listed]
        start = np.cumsum(many) - many
        slots = data[np.repeat(at[listed] + 2 - start, many) + np.arange(many.sum())]
        yield np.repeat(rows[listed], many), slots, np.repeat(1 << digit[listed], many)
        for r in np.flatnonzero(~listed):
            bits = np.unpackbits(data[at[r] + 2 : at[r] + 2 + SLOTS // 16].view(np.uint8), bitorder="little")
            found = np.flatnonzero(bits)
            yield np.full(len(found), rows[r]), found, np.full(len(found), 1 << digit[r])
        at = at + 2 + np.where(listed, count, SLOTS // 16)


# ---------------------------------------------------------------- Spark

_INDEX = "block long, slot int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pair long, docs long, links long, planes binary"
_SHAPE = pa.schema([
    ("block", pa.int64()), ("slot", pa.int32()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
    ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("pair", pa.int64()), ("docs", pa.int64()), ("links", pa.int64()), ("planes", pa.binary()),
])


def _rows(size: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in _SHAPE], schema=_SHAPE)


def _index(a_name: str, b_name: str, postings: int):
    """mapInArrow function over (doc_id, text): one row a document, and one a block and pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, block, slot, held = aligner(a_name, b_name), TaskContext.get().partitionId() << 32, 0, []

        def closed() -> Iterator[pa.RecordBatch]:
            keys, times = (np.concatenate([h[k] for h in held]) for k in (0, 1))
            order = np.argsort(keys)
            keys, times = keys[order], times[order]
            if len(keys):
                pair, docs, links, planes = pack(keys >> 16, (keys & 0xFFFF).astype("<u2"), times)
                for at in range(0, len(pair), 50_000):
                    part = slice(at, at + 50_000)
                    n = len(pair[part])
                    yield _rows(n, block=np.full(n, block), pair=pair[part], docs=docs[part], links=links[part], planes=planes[part])

        def aligned(ids: list, texts: list) -> Iterator[pa.RecordBatch]:
            groups, links, written, pairs, of = both.align(texts)
            held.append(np.unique((pairs << 16) | (slot + of), return_counts=True))
            yield _rows(
                len(ids), block=np.full(len(ids), block), slot=np.arange(slot, slot + len(ids), dtype=np.int32), doc_id=ids,
                n_a=[len(t[0]) for t in texts], n_b=[len(t[1]) for t in texts], n_groups=groups, n_links=links,
                groups_sha256=[hashlib.sha256(w).hexdigest() if w else "" for w in written],
            )

        ids, texts, size = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                ids.append(doc_id.as_py())
                texts.append(both.tokens(text.as_py()))
                size += len(texts[-1][0]) + len(texts[-1][1])
                full = slot + len(ids) == SLOTS
                if full or size >= _TOKENS:
                    yield from aligned(ids, texts)
                    slot, ids, texts, size = slot + len(ids), [], [], 0
                    if full or sum(len(h[0]) for h in held) >= postings:
                        yield from closed()
                        block, slot, held = block + 1, 0, []
        if ids:
            yield from aligned(ids, texts)
        if held:
            yield from closed()

    return run


def _returned(left: pa.Table, right: pa.Table) -> pa.Table:
    """One block: its documents with the scores that its postings bring them."""
    left = left.select(["slot", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"])
    best, total = np.zeros(SLOTS, np.int64), np.zeros(SLOTS, np.int64)
    for batch in right.to_batches():
        count = batch.column("count").to_numpy()
        top = batch.column("top").to_numpy(zero_copy_only=False)
        for row, slot, weight in unpack(batch.column("planes")):
            np.add.at(best, slot, weight * top[row])
            np.add.at(total, slot, weight * count[row])
    slots = left.column("slot").to_numpy()
    return left.drop_columns(["slot"]).append_column("n_best", pa.array(best[slots])).append_column("count_sum", pa.array(total[slots]))


class Alignment:
    """Both tokenizers' tokens of ``docs`` (doc_id, text), aligned.

    ``index``: the written documents and pair bitmaps; ``pairs``: the counts of every pair over the corpus;
    ``documents()``: the result for each document.
    """

    def __init__(self, docs: DataFrame, a_name: str = TOKENIZER, b_name: str = PIECES, postings: int = POSTINGS) -> None:
        self.scratch = Scratch(docs.sparkSession, "alignment")
        cut = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_index(a_name, b_name, postings), _INDEX)
        self.index = self.scratch.save(cut, "index")
        self._bitmaps = self.index.where("pair is not null").select("block", "pair", "docs", "links", "planes")
        merged = self._bitmaps.groupBy("pair").agg(F.sum("docs").alias("docs"), F.sum("links").alias("links"))
        a_id, b_id = F.shiftright("pair", 16).cast("int").alias("a_id"), F.col("pair").bitwiseAND(0xFFFF).cast("int").alias("b_id")
        self.pairs = self.scratch.save(merged.select(a_id, b_id, "docs", "links", "pair"), "pairs")

    def documents(self) -> DataFrame:
        """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum of every document."""
        most = self.pairs.groupBy("b_id").agg(F.max("links").alias("most"))
        # One row for each id of vocabulary B at most: a bound that does not grow with the corpus.
        told = self.pairs.join(F.broadcast(most), "b_id").select("pair", F.col("links").alias("count"), (F.col("links") == F.col("most")).alias("top"))
        # The same join at every size: many pairs are too many to broadcast, few cost little to shuffle.
        scored = self._bitmaps.select(F.col("block").alias("home"), "pair", "planes").join(told.hint("merge"), "pair").select("home", "planes", "count", "top")
        rows = self.index.where("slot is not null").select("block", "slot", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
        shape = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
        return rows.groupBy("block").cogroup(scored.groupBy("home")).applyInArrow(_returned, shape)
