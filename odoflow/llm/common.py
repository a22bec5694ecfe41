"""Helpers shared by the training-data operators."""

from __future__ import annotations

import string
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from odoflow.session import checkpoint_root

#: Whether shuffle files go when the query that made them ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Intermediate tables of one job in the shared folder of ``spark.checkpoint.dir``.

    A table written here cuts the lineage: a lost executor costs the tasks that
    were running, not the stages before. ``drop`` removes a table that no later
    step reads. ``tidy`` removes the shuffle files of each write as soon as it ends:
    with many steps they fill the disks otherwise, until the driver's next collection.
    """

    def __init__(self, spark: SparkSession, name: str, tidy: bool = False) -> None:
        self.spark, self.tidy = spark, tidy
        self.root = f"{checkpoint_root(spark).rstrip('/')}/odoflow-{name}-{uuid.uuid4().hex}"

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def save(self, df: DataFrame, table: str) -> DataFrame:
        before = self.spark.conf.get(CLEANUP, "false")
        self.spark.conf.set(CLEANUP, "true" if self.tidy else before)
        try:
            df.write.option("compression", "zstd").parquet(self.path(table))
        finally:
            self.spark.conf.set(CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(self.path(table))

    def drop(self, table: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(table))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only (``lower`` would change other letters too)."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def whole_text(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def text_key(text: str = "text") -> Column:
    """What tells texts apart; with the doc_id, it names a row up to copies of it."""
    return F.sha2(whole_text(text), 256)


def fold(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, mod ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % modulus


def matching(docs: DataFrame, named: DataFrame, how: str) -> DataFrame:
    """The rows of ``docs`` (doc_id, text) that stand in ``named`` (doc_id, text_sha256), with ``how`` left_semi,
    or do not, with left_anti; all columns stay. ``named`` grows with the rows, so it is never broadcast: one plan
    at every size, in which the rows of ``docs`` are shuffled once."""
    key = "odoflow_text_sha256"  # a name that the columns of docs do not have
    keyed, named = docs.withColumn(key, text_key()), named.select(F.col("doc_id").alias("named_id"), F.col("text_sha256").alias("named_sha256")).hint("merge")
    return keyed.join(named, keyed["doc_id"].eqNullSafe(named["named_id"]) & (keyed[key] == named["named_sha256"]), how).drop(key)


def one_of_each(docs: DataFrame) -> DataFrame:
    """Of the rows of ``docs`` with equal doc_id and text, the first by all columns as JSON; partial sums before the shuffle."""
    row = F.struct(*(docs[f"`{c}`"] for c in docs.columns))
    kept = docs.groupBy(F.col("doc_id").alias("id"), text_key().alias("sha")).agg(F.min_by(row, F.to_json(row)).alias("kept"))
    return kept.select("kept.*")


def labelled_sample(docs: DataFrame, feature: Column, labels: DataFrame, label: str, modulus: int, held: int, per_class: int) -> tuple[pa.Table, float]:
    """At most ``per_class`` training rows of each label 0 and 1, to fit a small model: (feature, y) by doc_id,
    and the share of label 1 among all training rows. ``feature``: a column over ``doc_id`` and ``text`` (not null).

    Only rows outside the held-out fold are candidates. They are taken in the
    order of a hash of the id, so the choice does not depend on partitions.
    The bound is ``2 * per_class`` rows at every corpus size. Repeated ids
    count once, by their last text; rows with a null id or label are left out.
    """
    spark = docs.sparkSession
    known = labels.where(F.col("doc_id").isNotNull() & (fold("doc_id", modulus) != held))
    sizes = dict(known.where(F.col(label).isin(0, 1)).groupBy(label).count().collect())
    share = (sizes.get(1, 0) + 1) / (sum(sizes.values()) + 2)
    ids = None
    for y in (0, 1):
        part = (
            known.where(F.col(label) == y).select("doc_id").distinct()
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
            .select("doc_id", F.lit(y).alias("y"))
        )
        ids = part if ids is None else ids.union(part)
    chosen = spark.createDataFrame(ids.collect(), "doc_id long, y int")
    rows = (
        docs.select("doc_id", whole_text().alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "y").agg(F.max("text").alias("text"))
        .select("doc_id", "y", feature.alias("feature"))
    )
    return rows.toArrow().sort_by([("doc_id", "ascending"), ("y", "ascending")]), share
