"""Operator 8, exact dedup: a persistent digest index, bucketed and sorted by hash.

The index is a table (digest, keep_id, group_size).  New data is brought to one row per digest and joined against the
index by a sort-merge anti-join on the bucketed key; what is new is appended.  Digests that were there before are
appended to a second table alike, the sightings; the largest id and the size of a digest are read from both.  Neither
table is ever rewritten.  The index belongs to who names it: ``append`` it batch by batch as data comes, ``drop`` it
at the end.  The query and the pipeline's stage take a table of documents in as BATCHES batches.  DataFrame operations
only.

Defined results: a null text counts as empty; texts are equal when identical after lower-casing A-Z only; of
equal texts the row with the largest doc_id stays (a null doc_id is smaller than any other); of wholly
repeated rows (same doc_id, equal text) one is kept; an empty table gives no rows; other columns are not read; texts
are hashed whole, whatever their length.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from econ_lake.llm.shared import ascii_lower, shared_dir, stored

#: A digest is hot if it has more than one in so many of all rows; so there are fewer than that many of them.
HOT_SHARE = 10_000
#: Batches in which a whole table is taken in.
BATCHES = 3


def digest():
    """SHA-256 of the normalised text, lower-case hex."""
    return F.sha2(F.encode(ascii_lower(F.coalesce(F.col("text"), F.lit(""))), "UTF-8"), 256)


def digests(docs: DataFrame) -> DataFrame:
    """(digest, doc_id, copies): one row per distinct digest and doc_id."""
    return docs.select(digest().alias("digest"), "doc_id").groupBy("digest", "doc_id").agg(
        F.count(F.lit(1)).alias("copies"))


def groups(rows: DataFrame) -> DataFrame:
    """(digest, keep_id, group_size): one row per digest, combined before the shuffle."""
    return rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))


class DigestIndex:
    """The persistent index: a bucketed, sorted table of the session's catalog, its files in ``location``."""

    def __init__(self, spark: SparkSession, name: str | None = None, location: str | None = None,
                 buckets: int | None = None):
        self.spark = spark
        self.name = name or f"digest_index_{uuid.uuid4().hex[:12]}"
        self.location = location or f"{shared_dir(spark).rstrip('/')}/{self.name}"
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    @property
    def sightings(self) -> str:
        return f"{self.name}_again"

    def read(self) -> DataFrame:
        """(digest, keep_id, group_size) of all that was appended."""
        index = self.spark.table(self.name)
        if not self.spark.catalog.tableExists(self.sightings):
            return index
        again = self.spark.table(self.sightings).groupBy("digest").agg(
            F.max("keep_id").alias("later_id"), F.sum("group_size").alias("more"))
        return index.join(again.hint("merge"), "digest", "left").select(
            "digest", F.greatest("keep_id", "later_id").alias("keep_id"),
            (F.col("group_size") + F.coalesce("more", F.lit(0))).alias("group_size"))

    def unseen(self, new: DataFrame) -> DataFrame:
        """The groups in ``new`` whose digest the index doesn't have."""
        if not self.exists():
            return new
        return new.join(self.spark.table(self.name).select("digest").hint("merge"), "digest", "left_anti")

    def append(self, rows: DataFrame) -> None:
        """Takes in a batch of digests: what is new goes into the index, what was there before into the sightings."""
        new = stored(groups(rows), "groups")
        known = self.exists()
        if known:
            again = new.join(self.spark.table(self.name).select("digest").hint("merge"), "digest", "left_semi")
            self._add(again, self.sightings)
        self._add(self.unseen(new), self.name)

    def _add(self, rows: DataFrame, table: str) -> None:
        (rows.repartition(self.buckets, "digest").write.mode("append").format("parquet")
         .bucketBy(self.buckets, "digest").sortBy("digest").option("path", f"{self.location}/{table}").saveAsTable(table))

    def drop(self) -> None:
        """Removes the tables and their files."""
        for table in (self.name, self.sightings):
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.location)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)


def indexed(rows: DataFrame, batches: int | None = None) -> DigestIndex:
    """A new index of all ``rows`` (digest, doc_id, copies), taken in batch by batch; the caller drops it."""
    index = DigestIndex(rows.sparkSession)
    batches = batches or BATCHES
    batch = F.pmod(F.xxhash64("doc_id"), F.lit(batches))
    for k in range(batches):
        index.append(rows.filter(batch == k))
    return index


def membership(rows: DataFrame, index: DataFrame) -> DataFrame:
    """Each row with keep_id and group_size of its digest.

    Digests that hold more than 1/HOT_SHARE of the rows are joined by broadcast: there are fewer than HOT_SHARE
    of them whatever the input, so their size is bounded; all others by sort-merge join, where no key is large.
    """
    total = index.agg(F.sum("group_size")).first()[0] or 0
    hot_size = max(1000, total // HOT_SHARE)
    hot = F.broadcast(index.filter(F.col("group_size") > hot_size))
    return (rows.join(hot, "digest")
            .unionByName(rows.join(hot.select("digest"), "digest", "left_anti")
                         .join(index.filter(F.col("group_size") <= hot_size).hint("merge"), "digest")))


def mark_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = stored(digests(docs), "digests")
    index = indexed(rows)
    marked = stored(membership(rows, stored(index.read(), "index")), "membership")
    index.drop()
    return marked.select(
        "doc_id", "keep_id", "group_size",
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("nth"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("largest"), F.col("digest").alias("text_sha256"),
    ).select("doc_id", "keep_id", "group_size", (F.col("largest") & (F.col("nth") == 1)).alias("kept"), "text_sha256")


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns: one of each group of equal texts.

    The index tells which document stays of each digest.  Rows meet on digest and doc_id together, so the copies of a
    text don't meet in one task.
    """
    mark = "__llm_mark"

    def key(doc_id):
        return F.concat_ws(":", "__llm_digest", F.coalesce(doc_id.cast("string"), F.lit("null")))

    index = indexed(stored(digests(docs), "digests"))
    kept = stored(index.read().withColumnRenamed("digest", "__llm_digest").select(key(F.col("keep_id")).alias(mark)),
                  "kept")
    index.drop()
    rows = docs.withColumn("__llm_digest", digest()).withColumn(mark, key(F.col("doc_id"))).drop("__llm_digest")
    return rows.join(kept, mark, "left_semi").dropDuplicates([mark]).select(*docs.columns)
