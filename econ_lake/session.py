"""SparkSession construction and cluster-safe scratch locations."""

from __future__ import annotations

import json
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Settings every job relies on.  AQE re-plans joins and coalesces shuffle
# partitions at runtime; skew-join splits a hot key's partition.  The session
# time zone is pinned so timestamps compare across engines.
_BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # a call site per column expression costs several round trips to the JVM each
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_spark(
    master: str | None = None,
    app_name: str = "econ_lake",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session.  ``master=None`` leaves it to spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", os.environ.get("ECON_LAKE_DRIVER_MEMORY", "8g"))
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    On a cluster ``spark.checkpoint.dir`` must point at shared storage, and is
    used as is.  Only a local session without it gets a scratch folder of its
    own; the setting itself is static, so that one is kept by the context.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    known = spark.sparkContext._jsc.sc().getCheckpointDir()
    if not current:
        if known.isDefined():
            return known.get()
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: name a folder that all executors share")
        current = tempfile.mkdtemp(prefix="econ-lake-ckpt-")
    if not known.isDefined():
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for materialised intermediate tables (below the checkpoint dir)."""
    return ensure_checkpoint_dir(spark).rstrip("/") + "/tables"


def small_frame(spark: SparkSession, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    """Rows of a fixed lookup or of configuration, as one constant of the plan: no partition of Python objects is read."""
    schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    told = json.dumps([dict(zip(schema.names, row, strict=True)) for row in rows])
    kind = f"array<{schema.simpleString()}>"
    return spark.sql("SELECT inline(from_json(:told, :kind))", args={"told": told, "kind": kind})


def materialise(df, name: str = "t"):
    """Write ``df`` as Parquet under the shared scratch folder and read it back.

    Cuts lineage (a stage that many later plans read is computed once) and
    survives executor loss, unlike a cache.  The folder is the cluster's
    ``spark.checkpoint.dir``; never a machine-local path on a cluster.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialise_counted(df, name: str = "t"):
    """``materialise``, and the number of rows, observed while they are written."""
    seen = Observation()
    stored = materialise(df.observe(seen, F.count(F.lit(1)).alias("rows")), name)
    return stored, 0 if stored.isEmpty() else seen.get["rows"]  # nothing is observed in an empty plan


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared scratch folder; ``release_scratch`` deletes it."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def release_scratch(spark: SparkSession) -> int:
    """Delete what this process has written below the scratch folder; frames read from it end here."""
    done = 0
    while _SCRATCH:
        path = spark._jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        done += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
    return done
