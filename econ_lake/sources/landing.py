"""The landing zone: payload documents under Hive-style folders, a landing log and checkpoints (S1, S3, S4, S7-S10,
S12, I12, I13, I17, I18, I21).

A payload is one or more JSON documents (source, dataset_id, vintage_tag, run_id, load_seq, body).  ``land`` parses
them once, judges each payload's envelope (broken, without its root object, an API error) and writes the documents of
payloads whose content differs from the dataset's checkpoint, a line each, under
``<source>/dataset_id=/extract_date=/run_id=``.  A run's folder is overwritten, so a run that is landed again after a
failure leaves nothing twice.  The log has a row per payload, also for those without any data row; reads are pruned to
the folders of the runs that the log names.  The checkpoint is moved by ``confirm``, after the load, so a failed load
is tried again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from econ_lake.operators.silver import OPTIONAL_FIELDS
from econ_lake.operators.tables import Tables, exists
from econ_lake.session import materialise
from econ_lake.sources import bronze

ROWS_PER_DOCUMENT = 5_000
PAYLOAD = ["source", "dataset_id", "vintage_tag", "run_id"]
RUN = ["dataset_id", "run_id"]
CORRUPT = "_corrupt_record"
#: The root object and the schema of each source's documents.
ENVELOPES = {"bea": ("BEAAPI", bronze.BEA_PAYLOAD_SCHEMA), "census": ("CENSUSAPI", bronze.CENSUS_PAYLOAD_SCHEMA)}
FOLDERS = "dataset_id string, extract_date string, run_id string"
LANDED_ROWS = ("source string, dataset_id string, vintage_tag string, run_id string, load_seq int, "
               "row map<string,string>")


def documents_of(raw: DataFrame) -> DataFrame:
    """Raw rows (source, dataset_id, vintage_tag, run_id, load_seq, row) as JSON documents of bounded size.

    Rows are dealt out by their number, so that equal rows don't meet in one document.
    """
    key = [*PAYLOAD, "load_seq"]
    rows = materialise(raw.select(*key, "row", F.monotonically_increasing_id().alias("_at")), "numbered")
    parts = rows.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / ROWS_PER_DOCUMENT).cast("int").alias("_parts"))
    each = (rows.join(parts, key).withColumn("_part", F.pmod(F.xxhash64("_at"), "_parts"))
            .groupBy(*key, "_part").agg(F.collect_list("row").alias("Data")))
    body = F.coalesce(*[F.when(F.col("source") == source, F.to_json(F.struct(F.struct(F.struct("Data").alias(
        "Results")).alias(top)))) for source, (top, _) in ENVELOPES.items()])
    return each.select(*key, body.alias("body"))


def judged(docs: DataFrame) -> DataFrame:
    """Each document with its row array, and what is wrong with its envelope (NULL: nothing)."""
    out = None
    for source, (top, schema) in ENVELOPES.items():
        read = F.from_json("body", f"{schema}, {CORRUPT} string", {"columnNameOfCorruptRecord": CORRUPT})
        one = docs.filter(F.col("source") == source).withColumn("_doc", read)
        root, broken = F.col("_doc")[top], F.col("_doc").isNull() | F.col("_doc")[CORRUPT].isNotNull()
        problem = F.when(broken, "broken document").when(root.isNull(), f"no {top} object")
        if source == "bea":
            problem = problem.when(root["Error"].isNotNull(), F.concat(F.lit("API error: "), bronze.error_text(root["Error"])))
        rows = F.coalesce(root["Results"]["Data"], F.array().cast("array<map<string,string>>"))
        one = one.select(*PAYLOAD, "load_seq", problem.alias("problem"), F.when(problem.isNull(), rows).alias("rows"))
        out = one if out is None else out.unionByName(one)
    return out


class LandingZone:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.tables = Tables(spark, f"{self.root}/_state")

    # ------------------------------------------------------------- writing

    def land(self, docs: DataFrame, landed_at: str) -> DataFrame:
        """Lands the documents of a run; returns its log rows, of which those with ``changed`` are to be processed."""
        docs = materialise(docs.select(*PAYLOAD, "load_seq", F.regexp_replace("body", "[\r\n]+", " ").alias("body")),
                           "to-land")
        row = F.col("row")
        told = judged(docs).select("*", F.explode_outer("rows").alias("row")).groupBy(*PAYLOAD, "load_seq").agg(
            F.count(row).alias("row_count"), F.max("problem").alias("problem"),
            bronze.set_hash(row).alias("payload_hash"),
            *[F.coalesce(F.max(F.map_contains_key(row, f)), F.lit(False)).alias(f"has_{f}") for f in OPTIONAL_FIELDS])
        # a run may hold several payloads of a dataset; each is compared with the one before it
        told = bronze.successive_change_flags(told)
        before = self.tables.read("checkpoint")
        if before is not None:
            before = before.select("dataset_id", F.col("payload_hash").alias("checkpoint_hash"))
            told = told.join(before, "dataset_id", "left").withColumn(
                "changed", ~F.col("payload_hash").eqNullSafe(F.coalesce("previous_hash", "checkpoint_hash"))).drop(
                "checkpoint_hash")
        log = materialise(told.drop("previous_hash").withColumn("landed_at", F.lit(landed_at).cast("timestamp")), "log")
        changed = docs.join(log.filter("changed").select(*PAYLOAD), PAYLOAD, "left_semi")
        for source in ENVELOPES:
            one = changed.filter(F.col("source") == source)
            if one.isEmpty():
                continue
            (one.select(F.col("body").alias("value"), "dataset_id", F.col("vintage_tag").alias("extract_date"), "run_id")
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("dataset_id", "extract_date", "run_id").text(f"{self.root}/{source}"))
        self.tables.merge("log", log, RUN)
        return log

    def confirm(self, log: DataFrame) -> None:
        """The loaded payloads are the datasets' checkpoints from now on."""
        self.tables.merge("checkpoint", log.groupBy("dataset_id").agg(
            F.max_by(F.struct("payload_hash", "run_id", "vintage_tag", "load_seq"), "load_seq").alias("p")).select(
            "dataset_id", "p.*"), ["dataset_id"])

    # ------------------------------------------------------------- reading

    def log(self) -> DataFrame | None:
        return self.tables.read("log")

    def _pruned(self, docs: DataFrame, log: DataFrame | None) -> DataFrame:
        """The documents of the runs in ``log`` (a row per payload), by filters on the folders alone."""
        if log is None:
            return docs
        runs = log.select(*RUN).collect()
        return docs.filter(F.col("dataset_id").isin(sorted({r.dataset_id for r in runs}))
                           & F.col("run_id").isin(sorted({r.run_id for r in runs})))

    def documents(self, source: str, log: DataFrame | None = None) -> DataFrame:
        """The landed documents of a source, or of the runs in ``log``, with the load order of their run."""
        docs = (self.spark.read.schema(f"{ENVELOPES[source][1]}, {CORRUPT} string, {FOLDERS}")
                .option("columnNameOfCorruptRecord", CORRUPT).json(f"{self.root}/{source}"))
        order = (self.log() if log is None else log).select(*RUN, "load_seq")
        return self._pruned(docs, log).withColumnRenamed("extract_date", "vintage_tag").join(order, RUN)

    def texts(self, log: DataFrame) -> DataFrame:
        """The documents of the runs in ``log`` as they came: source, dataset_id, vintage_tag, run_id, body."""
        out = None
        for source in ENVELOPES:
            if exists(self.spark, f"{self.root}/{source}"):
                docs = self._pruned(self.spark.read.schema(f"value string, {FOLDERS}").text(f"{self.root}/{source}"), log)
                one = docs.select(F.lit(source).alias("source"), "dataset_id", F.col("extract_date").alias("vintage_tag"),
                                  "run_id", F.col("value").alias("body"))
                out = one if out is None else out.unionByName(one)
        return out

    def rows(self, source: str, log: DataFrame | None = None) -> DataFrame:
        """The landed rows of a source, or of the runs in ``log``."""
        if not exists(self.spark, f"{self.root}/{source}"):  # no payload of this source was ever landed
            return self.spark.createDataFrame([], LANDED_ROWS)
        return bronze.payload_rows(self.documents(source, log), source)
