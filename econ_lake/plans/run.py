"""One change-driven run: land, type, judge, load, confirm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from econ_lake.operators import gold, quality, silver, warehouse
from econ_lake.operators.tables import Tables
from econ_lake.session import materialise
from econ_lake.sources import layers
from econ_lake.sources.landing import LandingZone, documents_of

QUARANTINE = ["dataset_id", "extract_date", "run_id"]


def run(spark: SparkSession, payloads: DataFrame, catalog: DataFrame, root: str, at: str, strict: bool = True
        ) -> DataFrame:
    """Processes the payloads that changed; returns the log rows of this run with what became of them.

    ``payloads`` are documents as they came (with a ``body``), or raw rows.  ``at`` is the run's time.  With
    ``strict`` a payload that fails a gate stops the run; else its documents go to the quarantine and the others are
    loaded.  The checkpoints move last, and only for what was loaded; a run that failed is run again, under the same
    run ids or others.
    """
    zone, tables = LandingZone(spark, f"{root}/landing"), Tables(spark, f"{root}/lake")
    log = zone.land(payloads if "body" in payloads.columns else documents_of(payloads), at)
    todo = log.filter("changed")
    if todo.isEmpty():
        return record(tables, log.withColumns({"reason": F.lit(None).cast("string"), "status": F.lit("unchanged")}), at)
    rows = materialise(zone.rows("bea", todo).unionByName(zone.rows("census", todo)), "landed")
    bea = materialise(silver.bea_silver(rows.filter(F.col("source") == "bea"), catalog, todo), "silver-bea")
    census = materialise(silver.census_silver(rows.filter(F.col("source") == "census"), catalog), "silver-census")
    verdicts = materialise(quality.payload_verdicts(todo, rows, catalog, bea, census), "verdicts")
    if strict:
        quality.assert_report_ok(verdicts, "payload")
    judged = log.join(verdicts.select("dataset_id", "run_id", "reason", "ok"), ["dataset_id", "run_id"], "left")
    quarantine(zone, judged.filter(~F.col("ok")), root, at)
    good = judged.filter("ok")
    runs = sorted(r.run_id for r in good.select("run_id").collect())  # a row per payload
    if runs:
        good_bea, _ = quality.split_by_verdict(bea, verdicts)
        good_census, _ = quality.split_by_verdict(census, verdicts)
        stages = {"silver": layers.write_layer(good_bea, f"{root}/silver/bea", runs)}
        for one, n in layers.write_layer(good_census, f"{root}/silver/census", runs).items():
            stages["silver"][one] += n
        conformed = gold.conformed_observations(good_bea, good_census)
        stages["gold"] = layers.write_layer(conformed, f"{root}/gold", runs)
        warehouse.load(tables, conformed, at)
        manifest(tables, good, stages, at)
        zone.confirm(good)
    status = F.when(~F.col("changed"), "unchanged").when(F.col("ok"), "loaded").otherwise("quarantined")
    return record(tables, judged.withColumn("status", status).drop("ok"), at)


def quarantine(zone: LandingZone, bad: DataFrame, root: str, at: str) -> None:
    """The documents of refused payloads as they came, with the reason; a run tried again replaces its own."""
    if bad.isEmpty():
        return
    texts = zone.texts(bad).join(bad.select("dataset_id", "run_id", "reason"), ["dataset_id", "run_id"])
    (texts.withColumnRenamed("vintage_tag", "extract_date").withColumn("quarantined_at", F.lit(at).cast("timestamp"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*QUARANTINE)
     .parquet(f"{root}/quarantine"))


def manifest(tables: Tables, log: DataFrame, stages: dict[str, dict[str, int]], at: str) -> None:
    """Rows per payload and stage, as observed while the stage wrote them; landed rows come from the log."""
    spark = tables.spark
    seen = spark.createDataFrame([(run, stage, n) for stage, counts in stages.items() for run, n in counts.items()],
                                 "run_id string, stage string, row_count long")
    landed = log.select("dataset_id", "run_id", F.lit("landed").alias("stage"), "row_count")
    rows = landed.unionByName(log.select("dataset_id", "run_id").join(F.broadcast(seen), "run_id")).withColumn(
        "written_at", F.lit(at).cast("timestamp"))
    tables.merge("manifest", rows, ["run_id", "stage"])


def record(tables: Tables, log: DataFrame, at: str) -> DataFrame:
    """The run log, one row per payload; a run recorded again keeps its first time."""
    rows = materialise(log.withColumns({"created_at": F.lit(at).cast("timestamp"),
                                        "updated_at": F.lit(at).cast("timestamp")}), "run-log")
    tables.merge("run_log", rows, ["run_id"], keep=["created_at"])
    return rows
