"""Incremental Bronze intake with Structured Streaming.

New payload documents landing under the Bronze root are picked up by the
file source; ``trigger(availableNow=True)`` processes everything not yet
seen and stops, so a daily schedule replaces "list and take newest".  The
stream checkpoint (which files were consumed) lives in the shared checkpoint
folder, so a restarted or failed run resumes exactly where it left off.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from econ_lake.sources.bronze import BEA_PAYLOAD_SCHEMA, _path_parts
from econ_lake.sources.landing import ENVELOPES, FOLDERS


def payload_stream(spark: SparkSession, root: str, schema: str = BEA_PAYLOAD_SCHEMA,
                   source: str = "bea") -> DataFrame:
    """Streaming rows of newly landed payload documents with lineage columns.

    Partition columns vanish under recursive lookup, so dataset, vintage and
    run come from the file path.
    """
    docs = (
        spark.readStream.schema(schema).option("multiLine", True)
        .option("recursiveFileLookup", True).option("pathGlobFilter", "payload.json")
        .json(root)
        .select("*", F.col("_metadata.file_path").alias("file_path"))
    )
    parts = _path_parts(F.col("file_path"))
    api = "BEAAPI" if source == "bea" else "CENSUSAPI"
    return docs.select(
        F.lit(source).alias("source"),
        parts["dataset_id"].alias("dataset_id"), parts["extract_date"].alias("vintage_tag"),
        parts["run_id"].alias("run_id"),
        F.explode(F.col(f"{api}.Results.Data")).alias("row"),
    )


def landed_stream(spark: SparkSession, root: str, source: str = "bea") -> DataFrame:
    """Streaming rows of the documents of a landing zone, whose folders are partition columns."""
    top, schema = ENVELOPES[source]
    docs = spark.readStream.schema(f"{schema}, {FOLDERS}").json(f"{root.rstrip('/')}/{source}")
    return docs.select(F.lit(source).alias("source"), "dataset_id", F.col("extract_date").alias("vintage_tag"), "run_id",
                       F.explode(F.col(f"{top}.Results.Data")).alias("row"))


def _runs(target: str) -> str:
    return f"{target.rstrip('/')}_runs"


def write_batch(rows: DataFrame, batch_id: int, target: str) -> None:
    """Writes a batch to a folder of its own, and the runs it holds to the run table; the same batch again replaces
    both, so a replay adds no rows."""
    folder = f"{target.rstrip('/')}/batch={batch_id}"
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
        "dataset_id", "vintage_tag").parquet(folder)
    spark = rows.sparkSession
    written = spark.read.schema(BRONZE_ROWS_SCHEMA.replace("batch long, ", "")).parquet(folder)
    written.select("dataset_id", "vintage_tag", "run_id").distinct().coalesce(1).write.mode("overwrite").option(
        "partitionOverwriteMode", "static").parquet(f"{_runs(target)}/batch={batch_id}")  # a row per payload


def ingest_available(spark: SparkSession, root: str, target: str, checkpoint: str,
                     source: str = "bea", landed: bool = False) -> None:
    """Write every not-yet-seen payload's rows to the Bronze row table and stop.

    ``landed``: ``root`` is a landing zone, else a folder of single payload files.  A batch may be run twice after a
    failure (foreachBatch is at-least-once); its rows are in the table once.
    """
    rows = landed_stream(spark, root, source) if landed else payload_stream(spark, root, source=source)
    query = (
        rows.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, batch_id: write_batch(batch, batch_id, target)).start()
    )
    query.awaitTermination()


BRONZE_ROWS_SCHEMA = ("source string, run_id string, row map<string,string>, batch long, "
                      "dataset_id string, vintage_tag string")


def read_bronze_rows(spark: SparkSession, target: str) -> DataFrame:
    """The Bronze row table; the load order follows the vintages and runs, as payloads land in that order.

    The run table (a row per payload and batch) tells order and batch: of a run that was landed again only the last
    batch counts.  Rows are read once; an explicit schema keeps ``vintage_tag`` a text.
    """
    runs = spark.read.schema("dataset_id string, vintage_tag string, run_id string, batch long").parquet(_runs(target))
    last = runs.groupBy("dataset_id", "vintage_tag", "run_id").agg(F.max("batch").alias("batch"))
    order = last.withColumn("load_seq", F.dense_rank().over(Window.orderBy("vintage_tag", "run_id")))
    rows = spark.read.schema(BRONZE_ROWS_SCHEMA).parquet(target)
    return rows.join(order, ["dataset_id", "vintage_tag", "run_id", "batch"])
