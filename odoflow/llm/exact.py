"""Operator 2: exact duplicates by an extendible-hash index on shared files.

DataFrame operations only. The index is a set of files in the shared folder:

- ``directory``: 2**depth cells, each naming the bucket of all hash values that
  start with the cell's bits. It starts with two buckets. While a bucket holds
  more distinct hash values than CAPACITY, it is split by its next bit; if it was
  the only bucket of its cells, the directory doubles first. The directory grows
  with (distinct values / CAPACITY), and joins to rows as Spark sees fit: a
  broadcast only if its files are below the session's threshold.
- ``pages``: one entry for each distinct text: bucket, hash, place in the chain of
  texts that collide in the hash, keeper, group size. Entries are dealt to owner
  tasks by ranges of (bucket, hash), and stand sorted in their files.

Texts are compared as bytes: entries are grouped by the text itself, with partial
sums before the shuffle, so a text that a third of all rows share is one row a
task. Rows find their entry by the hash; where a chain has more than one entry,
by the text too.

Defined cases: null text equals empty text; of a text whose rows have only null
ids the keeper is null and all rows count as kept; repeated ids are kept or
dropped together; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odoflow.llm.common import Scratch, whole_text

CAPACITY = 1 << 14
MAX_DEPTH = 40


def _cell(key: Column, depth: int) -> Column:
    """The first ``depth`` bits of the hash."""
    return F.shiftrightunsigned(key, 64 - depth)


def build_directory(keys: DataFrame, scratch: Scratch, capacity: int = CAPACITY) -> tuple[DataFrame, int]:
    """(cell, bucket, bits) of 2**depth cells, and depth. ``keys``: distinct ``key``.

    ``bucket`` is the first cell value of the bucket at its own number of ``bits``,
    written with MAX_DEPTH bits, so buckets stay in the order of the hash.
    """
    spark, depth = keys.sparkSession, 1
    halves = spark.range(2).select(F.col("id").alias("cell"), F.shiftleft("id", MAX_DEPTH - 1).alias("bucket"), F.lit(1).alias("bits"))
    directory = scratch.save(halves, "directory-0")
    for step in range(1, MAX_DEPTH):
        load = (
            keys.groupBy(_cell(F.col("key"), depth).alias("cell")).agg(F.count("*").alias("n"))
            .join(directory, "cell").groupBy("bucket", "bits").agg(F.sum("n").alias("n"))
        )
        full = scratch.save(load.where(F.col("n") > capacity).select(F.col("bucket").alias("full"), "bits"), f"full-{step}")
        deepest = full.agg(F.max("bits")).first()[0]
        if deepest is None:
            break
        if deepest == depth:  # the directory doubles: each cell becomes two, of the same bucket
            directory = directory.select(F.explode(F.array(F.col("cell") * 2, F.col("cell") * 2 + 1)).alias("cell"), "bucket", "bits")
            depth += 1
        marked = directory.join(full.select("full"), directory["bucket"] == F.col("full"), "left")
        split = F.col("full").isNotNull()
        directory = scratch.save(
            marked.select(
                "cell",
                F.when(split, F.col("bucket") + F.expr(f"shiftleft({bit_sql(depth)}, {MAX_DEPTH} - bits - 1)")).otherwise(F.col("bucket")).alias("bucket"),
                F.when(split, F.col("bits") + 1).otherwise(F.col("bits")).alias("bits"),
            ),
            f"directory-{step}",
        )
    return directory, depth


def bit_sql(depth: int) -> str:
    """The bit of a cell that tells the two halves of its split bucket apart."""
    return f"(shiftright(cell, {depth} - bits - 1) & 1)"


def exact_groups(docs: DataFrame, capacity: int = CAPACITY, hash_bits: int = 64) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256, bucket, chain.

    ``hash_bits`` below 64 makes the hash weaker, to test chains.
    """
    scratch = Scratch(docs.sparkSession, "exact")
    text = whole_text()
    key = F.xxhash64(text)
    key = key if hash_bits == 64 else F.shiftleft(F.shiftrightunsigned(key, 64 - hash_bits), 64 - hash_bits)
    rows = docs.select("doc_id", text.alias("text"), key.alias("key"))

    keys = scratch.save(rows.groupBy("key").agg(F.count("*").alias("rows")), "keys")
    directory, depth = build_directory(keys, scratch, capacity)
    placed = rows.withColumn("cell", _cell(F.col("key"), depth)).join(directory.select("cell", "bucket"), "cell")
    same = placed.groupBy("bucket", "key", "text").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    entries = scratch.save(same.withColumn("text_sha256", F.sha2("text", 256)).drop("text"), "entries")
    # Owner tasks: each takes a range of (bucket, hash), numbers its chains and writes its pages in order.
    owned = entries.repartitionByRange("bucket", "key").selectExpr(
        "*", "row_number() over (partition by bucket, key order by text_sha256) as chain",
        "count(*) over (partition by bucket, key) as chained",
    )
    pages = scratch.save(owned.sortWithinPartitions("bucket", "key", "chain"), "pages")

    columns = ["doc_id", "keep_id", "group_size", F.expr("doc_id <=> keep_id").alias("kept"), "text_sha256", "bucket", "chain"]
    found = rows.select("doc_id", "key").join(pages.where("chained = 1"), "key").select(*columns)
    chained = scratch.save(pages.where("chained > 1"), "chained")
    if chained.isEmpty():
        return found
    # Rows whose hash several texts share: by the bytes of the text.
    shared = rows.join(chained.select("key").distinct(), "key", "left_semi")
    texts = shared.groupBy("key", "text").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    texts = texts.join(chained.withColumn("sha", F.col("text_sha256")).select("key", "sha", "text_sha256", "bucket", "chain"), ["key"]).where(F.sha2("text", 256) == F.col("sha"))
    texts = scratch.save(texts.select(F.col("key").alias("k"), F.col("text").alias("t"), "keep_id", "group_size", "text_sha256", "bucket", "chain"), "texts")
    met = shared.join(texts, (shared["key"] == texts["k"]) & (shared["text"] == texts["t"]))
    return found.unionByName(met.select(*columns))
