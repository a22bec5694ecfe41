"""A corpus from raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and
returns a DataFrame; ``run`` writes each as Parquet in the shared folder and rereads
it. All stages but the last keep the columns of ``docs``, whatever they are.

Defined cases: a null text is empty text in every stage; a row is known by its doc_id
(null or not) and its text, so rows that share only the id are decided each for itself;
rows equal in both stay or go together, but copies without an id leave one row in the
exact stage, and the near stage leaves one row of a component, whatever its ids. Which
of them is settled by the id (null last), the SHA-256 of the text and then the other
columns as JSON. An empty table passes as an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odoflow.llm import exact, packing, simhash, toxicity, winnow
from odoflow.llm.common import Scratch, matching, one_of_each, table, text_key

KEY = ("text_sha256",)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", text_key().alias("text_sha256"))


def _filtered(docs: DataFrame, dropped: DataFrame, name: str, repeated: DataFrame | None = None) -> DataFrame:
    """``docs`` without the rows named in ``dropped`` (doc_id, text_sha256), and with one row of each named in ``repeated``.
    Both tables are written first: their sizes are then known to the joins."""
    scratch = Scratch(docs.sparkSession, name)
    kept = matching(docs, scratch.save(dropped.select("doc_id", "text_sha256").distinct(), "dropped"), "left_anti")
    if repeated is None:
        return kept
    repeated = scratch.save(repeated.select("doc_id", "text_sha256").distinct(), "repeated")
    if repeated.isEmpty():
        return kept
    return matching(kept, repeated, "left_anti").unionByName(one_of_each(matching(kept, repeated, "left_semi")))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go."""
    scored = toxicity.score(_keyed(docs), toxicity.train(docs, table(spark, sf_dir, "labels")), KEY)
    return _filtered(docs, scored.where("predicted = 1"), "toxic")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays; if none has an id, one row."""
    found = exact.exact_groups(docs).where("not kept or keep_id is null and group_size > 1")
    found = Scratch(spark, "copies").save(found.select("doc_id", "text_sha256", "kept").distinct(), "found")
    return _filtered(docs, found.where("not kept"), "copies", found.where("kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of a SimHash component one row stays: that with the smallest doc_id, and of these the smallest text_sha256."""
    found = simhash.near_duplicates(_keyed(docs), simhash.SHINGLE, simhash.MAX_BITS, KEY)
    found = Scratch(spark, "near-copies").save(found.groupBy("doc_id", "text_sha256", "component_id", "root").agg(F.count("*").alias("n")), "found")
    first = found.where("doc_id <=> component_id")  # one text of a component, or more if its smallest id is repeated or null
    tied = first.groupBy("root").agg(F.min("text_sha256").alias("least"), F.count("*").alias("texts")).where("texts > 1").select("root", "least")
    later = first.join(tied, "root").where("text_sha256 != least")
    dropped = found.where("not doc_id <=> component_id").select("doc_id", "text_sha256").unionByName(later.select("doc_id", "text_sha256"))
    return _filtered(docs, dropped, "near-copies", first.where("n > 1"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    found = winnow.Winnowing(docs, table(spark, sf_dir, "benchmark")).report()
    return _filtered(docs, found.where("contaminated"), "contaminated")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rest, cut and packed into sequences of at most 2048 tokens."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

# A trained classifier, a component search and packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last."""
    scratch, docs = Scratch(spark, "pipeline"), table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return docs
