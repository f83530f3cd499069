"""Silver and Gold sinks: Parquet under Hive-style folders, in canonical order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTITIONS = ["dataset_id", "extract_date", "run_id"]
# The canonical order of a layer's rows, as texts.
CANONICAL = ["bea_table_name", "period_code", "state_fips", "line_code"]


#: A payload's rows are written by up to so many tasks.
TASKS_PER_PAYLOAD = 256


def write_layer(rows: DataFrame, path: str, runs: list[str] | None = None) -> dict[str, int]:
    """Writes the partitions (dataset, extract date, run) that ``rows`` has; others stay; rows are sorted within files.

    S9, A20: returns the number of rows of each run in ``runs``, observed while they are written.
    """
    order = [c for c in CANONICAL if c in rows.columns]
    runs, seen = runs or [], Observation()
    if rows.isEmpty():
        return dict.fromkeys(runs, 0)
    counts = [F.count_if(F.col("run_id") == run).alias(f"n{k}") for k, run in enumerate(runs)]
    salt = F.pmod(F.xxhash64(*[c for c in order if c in ("state_fips", "line_code", "period_code")]), F.lit(TASKS_PER_PAYLOAD))
    (rows.observe(seen, F.count(F.lit(1)).alias("rows"), *counts)
     .withColumnRenamed("vintage_tag", "extract_date").repartition(*PARTITIONS, salt)
     .sortWithinPartitions(*PARTITIONS, *order).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITIONS).parquet(path))
    got = seen.get
    return {run: got[f"n{k}"] for k, run in enumerate(runs)}


def read_layer(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A written layer; the explicit schema keeps dates in folder names as texts."""
    stored = T.StructType([T.StructField("extract_date" if f.name == "vintage_tag" else f.name, f.dataType)
                           for f in schema])
    return spark.read.schema(stored).parquet(path).withColumnRenamed("extract_date", "vintage_tag").select(
        *[F.col(f.name) for f in schema])
