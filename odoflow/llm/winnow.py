"""Operator 10: benchmark decontamination by winnowing.

DataFrame operations only. Texts become words; a window is SPAN consecutive words
of a benchmark item (a shorter item is one window). Documents and items keep, of
each run of ``width`` consecutive K-word hashes, the smallest (winnowing), with
K + width - 1 = SPAN: whatever window a document shares with an item, both have
kept the same hash of it, so the join of the kept hashes misses no document. An
item shorter than SPAN has its own K and width, for its own length.

Hits are extended and verified on the words themselves: every window of a document
that holds a hit is compared with the items' windows, as text, and overlapping
matches merge into the longest shared spans (``shared_spans``).

The items' tables are written to the shared folder; Spark broadcasts them only if
their files are below its threshold, and joins by shuffle beyond it.

Defined cases: null or empty text has no words, is never contaminated and, as an
item, occurs nowhere; repeated item ids are one item with all their windows; an
item with a null id marks words but is not counted or named; rows with equal
doc_id and text are one document, which each of them reports; rows that share only
the doc_id (or have none) are documents of their own; empty tables give no rows or
no hits; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odoflow.llm.common import Scratch, ascii_lower, text_key

SPAN = 13
K = 6
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: str = "text") -> Column:
    """Words of the lower-cased text; none for null."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(F.col(text), F.lit(""))), BREAK), "")


def _zipped(df: DataFrame, name: str, left: str, right: str, by: int, merge) -> DataFrame:
    """Column ``name``: ``left[i]`` merged with ``right[i + by]``; entries beyond the end of ``right`` count as null.

    Each step is a column of its own, as a nested expression would be computed again at each use. (For the same
    reason these columns go through explode_outer: explode would add a filter that holds the whole chain once more.)
    """
    return df.withColumn(name, F.zip_with(left, F.slice(right, by + 1, 1 << 30), merge))


def with_prints(df: DataFrame, lengths: list[int], k: int) -> DataFrame:
    """``prints``: the winnowed hashes of ``words``, for windows of each of ``lengths`` words."""
    columns = df.columns
    df = df.withColumn("h1", F.transform("words", lambda w: F.xxhash64(w)))
    made = {1}

    def gram(df: DataFrame, n: int) -> DataFrame:
        """Column h<n>: hash of each run of n words, by joining the hashes of shorter runs."""
        if n in made:
            return df
        half = 1 << ((n - 1).bit_length() - 1)
        df = gram(gram(df, half), n - half)
        made.add(n)
        return _zipped(df, f"h{n}", f"h{half}", f"h{n - half}", half, lambda a, b: F.xxhash64(a, b))

    for n in lengths:
        run = min(k, n)
        width, have = n - run + 1, 1
        df = gram(df, run)
        df = df.withColumn(f"least{n}_1", _whole(F.col(f"h{run}"), F.size("words") - run + 1))
        while have < width:
            by = min(have, width - have)
            df = _zipped(df, f"least{n}_{have + by}", f"least{n}_{have}", f"least{n}_{have}", by, lambda a, b: F.least(a, b))
            have += by
        df = df.withColumn(f"prints{n}", F.array_distinct(_whole(F.col(f"least{n}_{have}"), F.size("words") - n + 1)))
    return df.withColumn("prints", F.flatten(F.array(*(f"prints{n}" for n in lengths)))).select(*columns, "prints")


def _whole(values: Column, n: Column) -> Column:
    """The first ``n`` values: those that come from full runs."""
    return F.slice(values, F.lit(1), F.greatest(n, F.lit(0)))


def _windows(words: Column, length: int) -> Column:
    """(at, window) of every window of ``length`` words; at counts from 0."""
    n = F.size(words) - length + 1
    return F.when(
        n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(i.alias("at"), F.array_join(F.slice(words, i + 1, length), " ").alias("window")))
    )


class Winnowing:
    """Matches of all ``docs`` (doc_id, text) with all ``items`` (item_id, text)."""

    def __init__(self, docs: DataFrame, items: DataFrame, span: int = SPAN, k: int = K) -> None:
        self.scratch = Scratch(docs.sparkSession, "winnow")
        self.docs = docs.select("doc_id", "text", text_key().alias("text_sha256"))
        self.k = k
        word = self.scratch.save(items.select("item_id", words_of().alias("words")).where(F.size("words") > 0), "items")
        length = F.least(F.size("words"), F.lit(span))
        # At most ``span`` numbers: the window lengths that occur.
        self.lengths = sorted(r[0] for r in word.select(length.alias("n")).distinct().collect())
        kept = windows = None
        for n in self.lengths:
            of = word.where(length == n)
            a = with_prints(of, [n], k).select(F.explode_outer("prints").alias("hash"))
            b = of.select("item_id", F.lit(n).alias("length"), F.explode_outer(_windows(F.col("words"), n)).alias("w")).select("item_id", "length", "w.window")
            kept, windows = (a, b) if kept is None else (kept.union(a), windows.union(b))
        if self.lengths:
            self.item_prints = self.scratch.save(kept.distinct(), "item-prints")
            self.item_windows = self.scratch.save(windows.distinct(), "item-windows")
            self.windows = self.scratch.save(self.item_windows.select("window", "length").distinct(), "windows")
        self._words = self.docs.select("doc_id", "text_sha256", words_of().alias("words"))
        self.hits = self._hits() if self.lengths else None

    def _hits(self) -> DataFrame:
        """(doc_id, text_sha256, at, length, window): the windows of documents that equal an item's window."""
        # A shorter hash of the text will do for the many rows here: one candidate more finds no window.
        marked = self.docs.withColumn("mark", F.xxhash64("text"))
        prints = with_prints(marked.select("doc_id", "mark", words_of().alias("words")), self.lengths, self.k)
        hit = prints.select("doc_id", "mark", F.explode_outer("prints").alias("hash")).join(self.item_prints, "hash").select(F.col("doc_id").alias("hit_id"), F.col("mark").alias("hit_mark")).distinct()
        hit = self.scratch.save(hit, "candidates")
        near = marked.join(hit, marked["doc_id"].eqNullSafe(hit["hit_id"]) & (marked["mark"] == hit["hit_mark"]), "left_semi").select("doc_id", "text_sha256", words_of().alias("words"))
        near = self.scratch.save(near, "near")
        found = None
        for n in self.lengths:
            at = near.select("doc_id", "text_sha256", F.explode_outer(_windows(F.col("words"), n)).alias("w")).select("doc_id", "text_sha256", "w.at", F.lit(n).alias("length"), "w.window")
            found = at if found is None else found.union(at)
        return self.scratch.save(found.join(self.windows, ["window", "length"], "left_semi").select("doc_id", "text_sha256", "at", "length", "window"), "hits")

    def shared_spans(self) -> DataFrame:
        """(doc_id, text_sha256, first, last): the longest stretches of document words inside matching windows; last is included."""
        seen = self.hits.select("doc_id", "text_sha256", "at", (F.col("at") + F.col("length") - 1).alias("end")).groupBy("doc_id", "text_sha256", "at").agg(F.max("end").alias("end"))
        edge = seen.selectExpr("*", "max(end) over (partition by doc_id, text_sha256 order by at rows between unbounded preceding and 1 preceding) as reach")
        numbered = edge.selectExpr("*", "sum(case when reach is null or at > reach + 1 then 1 else 0 end) over (partition by doc_id, text_sha256 order by at) as part")
        return numbered.groupBy("doc_id", "text_sha256", "part").agg(F.min("at").alias("first"), F.max("end").alias("last")).drop("part")

    def matched_items(self) -> DataFrame:
        """(doc_id, text_sha256, item_id): the items with a window in the document."""
        seen = self.hits.select("doc_id", "text_sha256", "window", "length").distinct()
        return seen.join(self.item_windows, ["window", "length"]).select("doc_id", "text_sha256", "item_id").where("item_id is not null").distinct()

    def report(self) -> DataFrame:
        """Per row of ``docs``: doc_id, n_words, n_hit, n_items, item_ids (sorted text, comma-joined), contaminated, text_sha256."""
        counts = self._words.select("doc_id", "text_sha256", F.size("words").alias("n_words"))
        if self.hits is None:
            found = counts.withColumns({"hit": F.lit(0).cast("long"), "items": F.lit(0).cast("long"), "ids": F.lit("")})
        else:
            spans = self.shared_spans().groupBy("doc_id", "text_sha256").agg(F.sum(F.expr("last - first + 1")).alias("hit"), F.lit(0).cast("long").alias("items"), F.lit("").alias("ids"))
            named = self.matched_items().withColumn("item", F.col("item_id").cast("string")).groupBy("doc_id", "text_sha256").agg(
                F.lit(0).cast("long").alias("hit"), F.count("*").alias("items"), F.array_join(F.array_sort(F.collect_set("item")), ",").alias("ids")
            )
            both = spans.unionByName(named).groupBy("doc_id", "text_sha256").agg(F.max("hit").alias("hit"), F.max("items").alias("items"), F.max("ids").alias("ids"))
            both = self.scratch.save(both, "found")
            both = both.withColumnsRenamed({"doc_id": "hit_id", "text_sha256": "hit_sha256"})
            met = counts["doc_id"].eqNullSafe(both["hit_id"]) & (counts["text_sha256"] == both["hit_sha256"])
            found = counts.join(both, met, "left")
        n_hit = F.least(F.coalesce("hit", F.lit(0).cast("long")), F.col("n_words").cast("long"))
        return found.select(
            "doc_id", F.col("n_words").cast("long").alias("n_words"), n_hit.alias("n_hit"),
            F.coalesce("items", F.lit(0).cast("long")).alias("n_items"), F.coalesce("ids", F.lit("")).alias("item_ids"),
            ((n_hit > 0) & (n_hit * 20 >= F.col("n_words"))).alias("contaminated"), "text_sha256",
        )
