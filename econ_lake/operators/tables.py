"""Keyed merges into Spark's own tables.

A table is a partitioned Parquet table of the session's catalog, its files under ``<root>/<table>``; large ones are
bucketed and sorted by their key as well.  A merge is a DataFrame job: the partitions that the updates touch, without
the updated keys (an anti-join that leaves a bucketed side where it is), and the updates; the result replaces these
partitions by dynamic partition overwrite, which moves staged files into place when the job is done.  The same merge
again gives the same table, so a load that failed half way is simply run again.
"""

from __future__ import annotations

import hashlib
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from econ_lake.session import materialise

#: The partition column of tables that have a single partition.
ONE = "_part"
BUCKETS = 8

_MERGE_CONF = {
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # buckets by a part of the join key are enough: the partition column is in the key, but not in the buckets
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # a task reads a bucket, and so writes files of one bucket only
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
}


@contextmanager
def _settings(spark: SparkSession):
    before = {k: spark.conf.get(k, None) for k in _MERGE_CONF}
    for k, v in _MERGE_CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _folder(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, path: str) -> bool:
    fs, folder = _folder(spark, path)
    return fs.exists(folder)


class Tables:
    """The tables below one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._prefix = f"econ_{hashlib.sha256(self.root.encode()).hexdigest()[:12]}"

    def name(self, table: str) -> str:
        return f"{self._prefix}_{table}"

    def location(self, table: str) -> str:
        return f"{self.root}/{table}"

    # ------------------------------------------------------------- reading

    def read(self, table: str) -> DataFrame | None:
        """A table; None where nothing was ever merged.  Files written before a column was added have its default."""
        stored = self._stored(table)
        return stored.drop(ONE) if stored is not None else None

    def _stored(self, table: str) -> DataFrame | None:
        if self.spark.catalog.tableExists(self.name(table)):
            return self.spark.table(self.name(table))
        if exists(self.spark, self.location(table)):  # written by another session
            return self.spark.read.option("mergeSchema", True).parquet(self.location(table))
        return None

    # ------------------------------------------------------------- writing

    def merged(self, table: str, updates: DataFrame, key: list[str], part: str, keep: list[str] | None = None
               ) -> DataFrame:
        """The touched partitions after the merge: rows of ``updates`` replace those of the same key.

        The updates alone are shuffled, to the buckets of their key.
        """
        old = self.spark.table(self.name(table)).filter(F.col(part).isin(self._values(updates, part)))
        if keep:
            known = old.select(*key, *[F.col(c).alias(f"_old_{c}") for c in keep], F.lit(True).alias("_known"))
            updates = updates.join(known, key, "left").withColumns(
                {c: F.when(F.col("_known"), F.col(f"_old_{c}")).otherwise(F.col(c)) for c in keep}
            ).drop("_known", *[f"_old_{c}" for c in keep])
        if part != ONE:
            updates = updates.repartition(BUCKETS, *[k for k in key if k != part])
        return old.join(updates.select(*key), key, "left_anti").unionByName(updates, allowMissingColumns=True)

    def merge(self, table: str, updates: DataFrame, key: list[str], part: str = ONE, keep: list[str] | None = None,
              defaults: dict | None = None) -> None:
        """Rows of ``updates`` replace those of the same key; other rows stay.

        ``part`` is a column that follows from the key; only the partitions that the updates touch are read and
        rewritten.  Columns in ``keep`` retain the stored value of an existing key.  New columns are added to the
        table first (W16): NULL, or ``defaults``, for the rows that lack them.
        """
        updates = materialise(updates.withColumn(ONE, F.lit(0)) if part == ONE else updates, f"merge-{table}")
        twice = updates.groupBy(*key).count().filter("count > 1").limit(3).collect()
        if twice:
            raise ValueError(f"{table}: several rows for keys {[tuple(r)[:-1] for r in twice]}")
        with _settings(self.spark):
            self._ready(table, updates.schema, key, part, defaults or {})
            self._insert(table, self.merged(table, updates, key, part, keep))

    def replace(self, table: str, rows: DataFrame, key: list[str], part: str, parts: list | None = None) -> None:
        """The partitions of ``rows``, and those in ``parts``, hold these rows only."""
        rows = materialise(rows, f"replace-{table}")
        with _settings(self.spark):
            self._ready(table, rows.schema, key, part, {})
            empty = set(parts or []) - set(self._values(rows, part))
            self._insert(table, rows.repartition(BUCKETS, *[k for k in key if k != part]))
            for value in empty:
                self.spark.sql(f"ALTER TABLE {self.name(table)} DROP IF EXISTS PARTITION (`{part}` = '{value}')")

    def drop(self, table: str) -> None:
        """Removes a legacy table and its files."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")
        fs, folder = _folder(self.spark, self.location(table))
        fs.delete(folder, True)

    @staticmethod
    def _values(rows: DataFrame, part: str) -> list:
        """The partitions that rows touch: as many as a load has payloads."""
        if part == ONE:
            return [0]
        return sorted(r[0] for r in rows.select(part).distinct().collect())

    def _ready(self, table: str, schema: T.StructType, key: list[str], part: str, defaults: dict) -> None:
        """The table is in the catalog and has the columns of ``schema``; a column must keep its type."""
        name = self.name(table)

        def column(f: T.StructField) -> str:
            text = f"`{f.name}` {f.dataType.simpleString()}"
            return f"{text} DEFAULT {defaults[f.name]!r}" if f.name in defaults else text

        if not self.spark.catalog.tableExists(name):
            known = self._stored(table)
            fields = list(schema if known is None else known.schema)
            fields = [schema[part] if f.name == part else f for f in fields]  # folder names don't tell the type
            buckets = [k for k in key if k != part]
            clustered = f"CLUSTERED BY ({', '.join(buckets)}) SORTED BY ({', '.join(buckets)}) INTO {BUCKETS} BUCKETS"
            self.spark.sql(f"CREATE TABLE {name} ({', '.join(map(column, fields))}) USING parquet "
                           f"PARTITIONED BY (`{part}`) {clustered if part != ONE else ''} "
                           f"LOCATION '{self.location(table)}'")
            if known is not None:
                self.spark.catalog.recoverPartitions(name)
        types = {f.name: f.dataType for f in self.spark.table(name).schema}
        for f in schema:
            if types.get(f.name, f.dataType) != f.dataType:
                raise ValueError(f"{table}.{f.name} is {types[f.name].simpleString()}, not {f.dataType.simpleString()}")
        new = [column(f) for f in schema if f.name not in types]
        if new:
            self.spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(new)})")

    def _insert(self, table: str, rows: DataFrame) -> None:
        columns = self.spark.table(self.name(table)).columns
        lacking = {c: F.lit(None) for c in columns if c not in rows.columns}
        rows.withColumns(lacking).select(*columns).write.insertInto(self.name(table), overwrite=True)
