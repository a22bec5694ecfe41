"""Operator 13: spelling variants of words, joined by asymmetric q-chunks.

Words come from whole texts (``word_counts``: counted inside each task, then summed
by Spark). Near words are one inserted, deleted or replaced code point apart. For a
word of L code points let q be half of L, Q at most. As the *chunk side* it gives two
disjoint chunks of q code points, its first and its last; as the *gram side*, a word
of m code points gives all its positional grams of the sizes q that words of m - 1,
m and m + 1 code points use. One edit touches at most one of two disjoint chunks and
moves what follows it by one place, so some chunk of either word stands in the other
within shift one: the first chunk in its place, or the last one moved by the difference
of the lengths. Both sides meet by the 64-bit hash of (both lengths, place, gram), one number
to shuffle and sort by; ``levenshtein`` with bound 1 verifies the words inside the join, so that only
near pairs leave it and grams whose hashes agree by chance change nothing.

A pair is looked for from its lesser word only. A chunk that more than BLOCK words
share is dealt in blocks over several tasks, each of which meets all its grams:
nothing is dropped.

A word's form is its most frequent near word, if that is FACTOR times as frequent;
roots follow the forms by pointer doubling (each step multiplies the count by
FACTOR, so chains are short and have no cycle).

Defined cases: null and empty texts have no words; a null doc_id counts as empty text in
the rule that damages words; equal rows count each; empty tables give no rows; other
columns are ignored; a text or a run of letters of any length is taken whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odoflow.llm.common import Scratch

RUN = re.compile("[A-Za-zÀ-ÿ]+")
SHORTEST = 7
DAMAGE = 31
FACTOR = 10
Q = 8
BLOCK = 2048
_HELD = 200_000  # words counted in a task before they are handed on
_LONG = 1 << 20
_ROWS = 1 << 16


def damaged(doc_id: str, run: str) -> str:
    """The lower-cased run, without one code point if the hash of id and run says so."""
    h = crc32(f"{doc_id}:{run}".encode())
    if h % DAMAGE:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    counts: Counter[str] = Counter()
    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            name, low = doc_id.as_py(), (text.as_py() or "").encode().lower().decode()  # bytes.lower changes A-Z only
            runs = RUN.findall(low) if len(low) < _LONG else (m[0] for m in RUN.finditer(low))
            for run, k in Counter(runs).items():
                word = damaged("" if name is None else name, run)
                if len(word) >= SHORTEST:
                    counts[word] += k
            if len(counts) >= _HELD:
                yield rows()
                counts.clear()
    if counts:
        yield rows()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of all words of at least SHORTEST code points that occur twice or more."""
    found = docs.select(F.col("doc_id").cast("string"), F.col("text")).mapInArrow(_tally, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where("n >= 2")


def chunk_size(length: int) -> int:
    return min(length // 2, Q)


def chunks(word: str) -> Iterator[tuple[int, int, int, str]]:
    """(length of the word, of the other word, place in the other word, chunk) of its two disjoint chunks."""
    size, q = len(word), chunk_size(len(word))
    for other in range(max(size - 1, SHORTEST), size + 2):
        yield size, other, 0, word[:q]
        yield size, other, other - q, word[size - q :]


def grams(word: str) -> Iterator[tuple[int, int, int, str]]:
    """(length of the other word, of the word, place, gram): all positional grams, for each length that an edit can come from."""
    size = len(word)
    for other in range(max(size - 1, SHORTEST), size + 2):
        q = chunk_size(other)
        for at in range(size - q + 1):
            yield other, size, at, word[at : at + q]


def _spread(cut):
    """mapInArrow function: one row (length, other, at, gram, word, n) for every piece that ``cut`` gives of a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for piece in cut(word):
                    rows.append((*piece, word, n))
                    if len(rows) >= _ROWS:
                        yield _table(rows)
                        rows = []
        if rows:
            yield _table(rows)

    return run


def _table(rows: list[tuple]) -> pa.RecordBatch:
    names, kinds = ("length", "other", "at", "gram", "word", "n"), (pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], list(names))


def near_pairs(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(a, a_n, b, b_n), a < b: every pair of near words of ``words`` (word, n), once."""
    shape = "length int, other int, at int, gram string, word string, n long"
    place = F.xxhash64("length", "other", "at", "gram").alias("place")
    left = words.mapInArrow(_spread(chunks), shape).select(place, F.col("word").alias("a"), F.col("n").alias("a_n"))
    right = words.mapInArrow(_spread(grams), shape).select(place, F.col("word").alias("b"), F.col("n").alias("b_n"))
    hot = left.groupBy("place").count().where(F.col("count") > block).select("place", F.ceil(F.col("count") / block).cast("int").alias("blocks"))

    def met_at(dealt: Column) -> Column:
        return F.when(F.col("blocks").isNull(), F.col("place")).otherwise(F.xxhash64("place", dealt)).alias("met_at")

    left = left.join(hot, "place", "left").select(met_at(F.pmod(F.xxhash64("a"), "blocks").cast("int")), "a", "a_n")
    every = F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))
    right = right.join(hot, "place", "left").select("*", F.explode(every).alias("dealt")).select(met_at(F.col("dealt")), "b", "b_n")
    # sorted and merged at every size: a long word's grams are small when compressed, not when broadcast
    met = left.join(right.hint("merge"), "met_at").where((F.col("a") < F.col("b")) & (F.levenshtein("a", "b", 1) == 1))
    return met.select("a", "a_n", "b", "b_n").distinct()


def _roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root) of the words in ``forms`` (word, form): each round follows twice as many forms as the one before."""
    now, k = scratch.save(forms.select("word", F.col("form").alias("root")), "roots-0"), 0
    while True:
        k += 1
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = scratch.save(now.select("word", "root").join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), f"roots-{k}")
        if now.where("moved").isEmpty():
            return now.select("word", "root")


def variants(docs: DataFrame) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    scratch = Scratch(docs.sparkSession, "variants")
    words = scratch.save(word_counts(docs), "words")
    pairs = scratch.save(near_pairs(words), "pairs")
    ways = pairs.select(F.col("a").alias("word"), F.struct((-F.col("b_n")).alias("n"), F.col("b").alias("word")).alias("near")).unionByName(
        pairs.select(F.col("b").alias("word"), F.struct((-F.col("a_n")).alias("n"), F.col("a").alias("word")).alias("near"))
    )
    best = ways.groupBy("word").agg(F.count("*").alias("n_near"), F.min("near").alias("best"))
    enough: Column = -F.col("best.n") >= FACTOR * F.col("n")
    told = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.word")).alias("form"), F.when(enough, -F.col("best.n")).alias("form_n"),
    )
    told = scratch.save(told, "told")
    roots = _roots(told.where("form is not null"), scratch)
    return told.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
