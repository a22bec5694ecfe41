"""Operator 12: document fingerprints from closed syncmers.

DataFrame operations only. A text's K-mers (K code points) are looked at through their
S-mers: a K-mer is a closed syncmer if the smallest hash of its S-mers stands at its first
or its last place. Whether a K-mer is chosen depends on nothing outside it, so equal
passages give equal anchors wherever they stand, and of any K - S + 1 consecutive K-mers
one at least is chosen (but for ties, which choose more). ``anchors`` lists all of a text.

A *sketch* holds, of the distinct anchors of the whole text, the SIZE with the smallest
hashes, each with its first place: a fixed size at every text length, and a uniform
sample of the whole text. ``likeness`` matches two sketches by hash, takes the middle
displacement of the matches, and counts the matches that agree with it within SHIFT
places. Among the smallest hashes of both sketches these estimate the Jaccard
likeness J of the anchors; reported is 2 J / (1 + J), the shared part of the anchors.

``next_in_order`` gives every document its successor by doc_id (ties by the text's
SHA-256), the last one the first. Documents are cut into chunks of neighbouring ids
(``cut_hot``: ranks, so repeated ids and null ids are cut as well), each chunk is one
window, and the first row of the next chunk is added to it.

Defined cases: null text is empty; an empty text has no anchors and the fingerprint '',
two of them have likeness 1, one of them and another text 0; a text without a syncmer
has one anchor, its whole text; null ids come last; rows with equal doc_id and text
follow one another; a table of one row is its own successor; empty tables give no rows;
other columns are ignored; texts are read whole, in pieces of PIECE code points.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odoflow.llm.common import Scratch, text_key, whole_text
from odoflow.operators.series import CHUNK, NULL_BASE, cut_hot

K = 8
S = 3
SIZE = 64
SHIFT = 16
PIECE = 4096
ROWS = 4096  # documents of a chunk
_PLACE = 30  # bits of a place in a packed anchor; 33 bits of hash stand above them
_WINDOW = K - S + 1


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _hash_of(packed: Column) -> Column:
    return F.shiftright(packed, _PLACE)


def _place_of(packed: Column) -> Column:
    return packed.bitwiseAND((1 << _PLACE) - 1)


def _packed(hashed: Column, place: Column) -> Column:
    return F.shiftleft(hashed.bitwiseAND((1 << 33) - 1), _PLACE).bitwiseOR(place.cast("long").bitwiseAND((1 << _PLACE) - 1))


def _chosen(h: Column, start: Column) -> Column:
    """Packed anchors of a piece from the hashes of its S-mers; ``start``: the piece's place in the text."""
    at = lambda i, places: [F.get(h, i + p) for p in places]
    edge = lambda i: F.least(*at(i, (0, _WINDOW - 1)))
    inner = lambda i: F.least(*at(i, range(1, _WINDOW - 1)))
    cover = [*range(0, K - S, S), K - S]  # S-mers that together cover the K-mer
    starts = F.filter(F.sequence(F.lit(0), F.size(h) - _WINDOW), lambda i: edge(i) <= inner(i))
    found = F.transform(starts, lambda i: _packed(F.xxhash64(*at(i, cover)), start + i))
    return F.when(F.size(h) >= _WINDOW, found).otherwise(F.array().cast("array<long>"))


def anchors(text: Column, start: Column | int = 0) -> Column:
    """All closed syncmers of a text (not null), as longs: 33 bits of hash, then the place. ``start``: the text's first place."""

    def of_piece(pieces: Column) -> Callable[[Column, Column], Column]:
        def one(piece: Column, i: Column) -> Column:
            whole = F.concat(piece, F.coalesce(F.substring(F.get(pieces, i + 1), 1, K - 1), F.lit("")))
            smers = F.regexp_extract_all(whole, F.lit(f"(?s)(?=(.{{{S}}}))."), F.lit(1))  # one starts at every code point
            return _let(F.transform(smers, lambda s: F.xxhash64(s)), lambda h: _chosen(h, F.lit(start) + i * PIECE))

        return one

    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    return _let(cut, lambda pieces: F.flatten(F.transform(pieces, of_piece(pieces))))


def _distinct(ordered: Column) -> Column:
    """Of packed anchors in order, the first of every hash."""
    return F.filter(ordered, lambda a, i: (i == 0) | (_hash_of(a) != _hash_of(F.get(ordered, F.greatest(i - 1, F.lit(0))))))


def smallest(found: Column) -> Column:
    """Of packed anchors, the SIZE distinct ones of smallest hash, with their first places, in order."""
    few = 4 * SIZE

    def cut(ordered: Column) -> Column:
        # The distinct ones among the first few are enough, unless the text repeats them.
        enough = lambda d: F.when((F.size(d) >= SIZE) | (F.size(ordered) <= few), d).otherwise(_distinct(ordered))
        return F.slice(_let(_let(F.slice(ordered, 1, few), _distinct), enough), 1, SIZE)

    return _let(F.sort_array(found), cut)


def sketch(text: Column, found: Column | None = None) -> Column:
    """The sketch of a text from its anchors (or the smallest of them); a text without any has itself as its only anchor."""
    whole = F.when(text == "", F.array().cast("array<long>")).otherwise(F.array(_packed(F.xxhash64(text), F.lit(0))))
    return _let(smallest(anchors(text) if found is None else found), lambda a: F.when(F.size(a) > 0, a).otherwise(whole))


def likeness(a: Column, b: Column) -> Column:
    """Likeness of two sketches, 0 to 1, by anchors that match at one displacement."""

    def matched(both: Column) -> Column:
        at = lambda s: F.transform(F.filter(s, lambda x: F.array_contains(both, _hash_of(x))), _place_of)
        moved = F.zip_with(at(a), at(b), lambda x, y: x - y)
        middle = lambda d: F.element_at(F.sort_array(d), F.size(d).bitwiseOR(1) - F.shiftright(F.size(d), 1))
        agree = lambda d: _let(middle(d), lambda m: F.size(F.filter(d, lambda x: F.abs(x - m) <= SHIFT)))
        return F.when(F.size(both) == 0, F.lit(0)).otherwise(_let(moved, agree))

    hashes = lambda s: F.transform(s, _hash_of)
    union = F.slice(F.sort_array(F.array_union(hashes(a), hashes(b))), 1, SIZE)
    share = _let(
        union, lambda u: _let(F.array_intersect(F.array_intersect(u, hashes(a)), hashes(b)), lambda both: matched(both) / F.size(u))
    )
    return (
        F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0))
        .when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0))
        .otherwise(_let(share, lambda j: 2 * j / (1 + j)))
    )


def written(sketched: Column) -> Column:
    """A sketch as text: 16 hexadecimal digits for each anchor."""
    return F.array_join(F.transform(sketched, lambda a: F.lpad(F.lower(F.hex(a)), 16, "0")), "")


def next_in_order(docs: DataFrame, carried: dict[str, Column], scratch: Scratch, rows: int = ROWS) -> DataFrame:
    """``docs`` (doc_id, key, ...) with the columns ``carried`` and a struct ``next`` of them of the next row by (doc_id, key).

    ``key``: lower-case hexadecimal text that tells rows with one doc_id apart. ``carried`` is computed once a row.
    """
    names, values = list(carried), [c.alias(n) for n, c in carried.items()]
    low, high, n = docs.agg(F.min("doc_id"), F.max("doc_id"), F.count("*")).first()
    low, high = low or 0, high or 0
    width = max(1, -(-(high - low + 1) * rows // max(n, 1)))
    width = max(width, (high - low + 1 >> 40) + 1)
    bits = width.bit_length()
    base = F.coalesce(F.floor((F.col("doc_id") - low) / width).cast("long"), F.lit(NULL_BASE))
    offset = F.coalesce(F.pmod(F.col("doc_id") - low, F.lit(width)), F.lit(0))
    tie = F.conv(F.substring("key", 1, 15), 16, 10).cast("long")  # 60 bits
    room = max(0, 62 - bits)
    position = F.shiftleft(offset, room).bitwiseOR(F.shiftright(tie, 60 - min(room, 60)))
    cut = cut_hot(docs, [], base, position, 2 * rows)
    order = [F.col("doc_id").asc_nulls_last(), F.col("key")]

    first = cut.groupBy(CHUNK).agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("first"))
    # One row for each chunk of thousands of documents.
    first = scratch.save(first.select(CHUNK, "first.doc_id", "first.key"), "first")
    ring = Window.orderBy(CHUNK)
    ahead = first.select(F.col(CHUNK).alias("into"), F.lead(CHUNK).over(ring).alias("ahead"), F.min(CHUNK).over(ring).alias("least"))
    heads = first.join(ahead.select("into", F.coalesce("ahead", "least").alias(CHUNK)), CHUNK)
    # Written, so that Spark knows its size and broadcasts it only if it is small.
    named = scratch.save(heads.select("into", F.col("doc_id").alias("head_id"), F.col("key").alias("head_key")), "named")
    same = F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("key") == F.col("head_key"))
    edge = docs.join(named, same).dropDuplicates(["into"])
    edge = edge.select(F.lit(None).cast("long").alias("doc_id"), F.lit("").alias("key"), *values, F.col("into").alias(CHUNK), F.lit(1).alias("_edge"))

    after = Window.partitionBy(CHUNK).orderBy(F.col("_edge"), *order)
    met = cut.select("doc_id", "key", *values, CHUNK, F.lit(0).alias("_edge")).unionByName(edge)
    met = met.withColumn("next", F.lead(F.struct(*names)).over(after))
    return met.where("_edge = 0").drop("_edge", CHUNK)


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text: the last quarter of the code points replaced by the first as many of the next document.
    """
    scratch = Scratch(docs.sparkSession, "syncmers")
    rows = docs.select("doc_id", whole_text().alias("text"), text_key().alias("key"))
    # An anchor depends on its K code points alone: those of the part that stays are taken from the whole text's anchors
    # (``head``), and only the last K - 1 code points of that part and the new end are looked through again.
    text, chars, quarter = F.col("text"), F.length("text"), F.floor(F.length("text") / 4).cast("int")
    last = chars - quarter - K  # named once: inside a lambda it would be computed for every anchor
    head = lambda a: _let(last, lambda n: smallest(F.filter(a, lambda x: _place_of(x) <= n)))
    both = lambda a: F.struct(sketch(text, a).alias("own"), head(a).alias("head"))
    met = next_in_order(rows, {"text": text, "sketches": _let(anchors(text), both)}, scratch)
    kept, end = F.substring(text, F.lit(1), chars - quarter), F.substring(F.col("next.text"), F.lit(1), quarter)
    seam = F.greatest(chars - quarter - (K - 1), F.lit(0))
    met = met.select(
        "doc_id", chars.cast("long").alias("n_chars"), F.col("sketches.own").alias("own"), F.col("sketches.head").alias("head"),
        F.col("next.sketches.own").alias("following"), F.concat(kept, end).alias("edited"), F.concat(F.substring(kept, seam + 1, F.lit(K - 1)), end).alias("tail"), seam.alias("seam"),
    )
    changed = sketch(F.col("edited"), F.concat("head", anchors(F.col("tail"), F.col("seam"))))
    met = met.select("doc_id", "own", "following", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), changed.alias("changed"))
    return met.select(
        "doc_id", "n_chars", "edited_sha256", written(F.col("own")).alias("fingerprint"), written(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"), likeness(F.col("own"), F.col("following")).alias("near_next"),
    )
