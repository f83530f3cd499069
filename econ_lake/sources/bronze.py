"""Bronze-side sources and payload shaping.

Payload files are JSON documents under Hive-style folders
``<root>/<source>/<dataset_id>/extract_date=YYYY-MM-DD/run_id=<id>/payload.json``.
One document is parsed by one task (JSON documents are not splittable), then
its row array is exploded, so all later work is row-parallel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from econ_lake.functions import exprs as X

BEA_PAYLOAD_SCHEMA = (
    "BEAAPI struct<Results: struct<Data: array<map<string,string>>, "
    "ParamValue: array<struct<Key: string, Desc: string>>, "
    "ReleaseDate: string, ReleaseName: string, Statistic: string>, "
    "Error: struct<APIErrorDescription: string, ErrorDetail: struct<Description: string>>>"
)
CENSUS_PAYLOAD_SCHEMA = "CENSUSAPI struct<Results: struct<Data: array<map<string,string>>>>"


def _path_parts(path: Column) -> dict[str, Column]:
    """Dataset, extract date (vintage tag, kept as text) and run id from a file path."""
    return {
        "dataset_id": F.regexp_extract(path, r"/(?:dataset_id=)?([^/]+)/extract_date=", 1),
        "extract_date": F.regexp_extract(path, r"extract_date=(\d{4}-\d{2}-\d{2})", 1),
        "run_id": F.regexp_extract(path, r"run_id=([^/]+)", 1),
    }


PAYLOADS = "*/extract_date=*/run_id=*/payload.json"


def read_payload_documents(spark: SparkSession, root: str, source: str = "bea",
                           paths: list[str] | None = None) -> DataFrame:
    """One row per landed payload document with its lineage columns.

    The glob skips the checkpoint folder that sits beside the partitions; the
    documents of a run (one per line, or parts) are one payload together.
    """
    schema = BEA_PAYLOAD_SCHEMA if source == "bea" else CENSUS_PAYLOAD_SCHEMA
    docs = (
        spark.read.schema(schema).option("multiLine", True)
        .json(paths or f"{root.rstrip('/')}/{PAYLOADS}")
        .select("*", F.col("_metadata.file_path").alias("file_path"),
                F.col("_metadata.file_modification_time").alias("file_mtime"))
    )
    parts = _path_parts(F.col("file_path"))
    return docs.select("*", *[v.alias(k) for k, v in parts.items()]).withColumn(
        "vintage_tag",
        F.when(F.col("extract_date") == "", F.raise_error(F.lit("vintage tag missing from path")))
        .otherwise(F.col("extract_date")),
    )


def payload_rows(docs: DataFrame, source: str = "bea") -> DataFrame:
    """Explode the row array (a missing array gives no rows)."""
    root = "BEAAPI" if source == "bea" else "CENSUSAPI"
    return docs.select(
        F.lit(source).alias("source"), "dataset_id", "vintage_tag", "run_id",
        *(["load_seq"] if "load_seq" in docs.columns else []),
        F.explode_outer(F.coalesce(F.col(f"{root}.Results.Data"), F.array().cast("array<map<string,string>>")))
        .alias("row"),
    ).filter(F.col("row").isNotNull())


def error_text(err: Column) -> Column:
    """What an API error says: its description and its detail."""
    return F.trim(F.concat_ws(" ", F.coalesce(err["APIErrorDescription"], F.lit("")),
                              F.coalesce(err["ErrorDetail"]["Description"], F.lit(""))))


def api_error(docs: DataFrame) -> DataFrame:
    """Payloads carrying an API error, with description and detail."""
    err = F.col("BEAAPI.Error")
    return docs.filter(err.isNotNull()).select("dataset_id", "run_id", error_text(err).alias("error"))


def assert_no_api_error(docs: DataFrame) -> None:
    """Refuse payloads that carry an API error, naming what it says."""
    bad = api_error(docs).limit(5).collect()
    if bad:
        raise ValueError(f"the API answered with an error: {[tuple(r) for r in bad]}")


def release_tag(docs: DataFrame) -> DataFrame:
    """First non-blank of ReleaseDate, ReleaseName, Statistic (NULL if none)."""
    res = F.col("BEAAPI.Results")
    pick = F.coalesce(*[F.nullif(X.strip(res[k]), F.lit("")) for k in ("ReleaseDate", "ReleaseName", "Statistic")])
    return docs.select("dataset_id", "run_id", pick.alias("release_tag"))


def latest_paths(spark: SparkSession, root: str, suffix: str = PAYLOADS) -> list[str]:
    """The newest file of each dataset by modification time (the first path wins ties).

    Only file metadata is read; the result has one path per dataset.
    """
    files = spark.read.format("binaryFile").load(f"{root.rstrip('/')}/{suffix}").select("path", "modificationTime")
    newest = F.min_by("path", F.struct(-F.unix_micros("modificationTime"), F.col("path")))
    found = files.groupBy(_path_parts(F.col("path"))["dataset_id"].alias("d")).agg(newest.alias("path")).collect()
    if not found:
        raise ValueError(f"no payload below {root}")
    return sorted(r.path for r in found)


def latest_snapshot(spark: SparkSession, root: str, source: str = "bea") -> DataFrame:
    """The newest document of each dataset; the older ones aren't opened."""
    return read_payload_documents(spark, root, source, latest_paths(spark, root))


def latest_runs(spark: SparkSession, path: str) -> DataFrame:
    """(dataset_id, run_id) of the newest run folder of each dataset, by the files' modification times (of equally
    new ones the first path).  Only file metadata is read; no file is opened."""
    files = spark.read.format("binaryFile").schema(
        "path string, modificationTime timestamp, length long, content binary, dataset_id string, extract_date string, "
        "run_id string").load(path).select(
        "dataset_id", "run_id", F.col("_metadata.file_path").alias("path"),
        F.unix_micros("_metadata.file_modification_time").alias("at"))
    runs = files.groupBy("dataset_id", "run_id").agg(F.max("at").alias("at"), F.min("path").alias("path"))
    return runs.groupBy("dataset_id").agg(F.min_by("run_id", F.struct(-F.col("at"), F.col("path"))).alias("run_id"))


# --- header-row matrices (Census) ------------------------------------------

def header_matrix_records(matrix: Column, wanted: dict[str, str], constant: dict[str, Column] | None = None) -> Column:
    """``[[h1,h2..],[v1,v2..],..]`` -> array of maps (fewer than 2 rows -> empty).

    ``wanted`` maps header names to field names.  Of a repeated header the last
    position counts; a row that is too short has NULL there.
    """
    header = F.get(matrix, 0)
    body = F.when(F.size(matrix) >= 2, F.slice(matrix, 2, F.size(matrix))).otherwise(
        F.array().cast("array<array<string>>"))

    def value(row: Column, name: str) -> Column:
        behind = F.array_position(F.reverse(header), name)
        return F.when(behind > 0, F.get(row, (F.size(header) - behind).cast("int")))

    def record(row: Column) -> Column:
        parts = [x for name, field in wanted.items() for x in (F.lit(field), value(row, name))]
        parts += [x for field, c in (constant or {}).items() for x in (F.lit(field), c)]
        return F.create_map(*parts)

    return F.transform(body, record)


def missing_headers(matrix: Column, required: list[str]) -> Column:
    """Required header names absent from the matrix header row."""
    return F.array_except(F.array(*[F.lit(r) for r in required]),
                          F.coalesce(F.get(matrix, 0), F.array().cast("array<string>")))


# --- line dictionary (I2-I4) -------------------------------------------------

def line_dictionary(param_values: DataFrame) -> DataFrame:
    """``ParamValue`` arrays -> (dataset_id, line_key, description).

    Keys and descriptions are stripped, blank keys dropped, and the last
    duplicate in array order wins.
    """
    e = param_values.select("dataset_id", F.posexplode("param_value").alias("pos", "pv")).select(
        "dataset_id", "pos", X.strip(F.coalesce(F.col("pv.Key"), F.lit(""))).alias("line_key"),
        X.strip(F.coalesce(F.col("pv.Desc"), F.lit(""))).alias("description"),
    ).filter(F.col("line_key") != "")
    return e.groupBy("dataset_id", "line_key").agg(F.max_by("description", "pos").alias("description"))


def attach_line_labels(rows: DataFrame, dictionary: DataFrame) -> DataFrame:
    """FunctionName = dictionary[line of Code] or '' (overwrites the field)."""
    line = X.after_first_dash(F.col("row")["Code"])
    r = rows.withColumn("_line", line)
    d = dictionary.withColumnRenamed("line_key", "_line")
    j = r.join(d, ["dataset_id", "_line"], "left")
    return j.withColumn("row", F.map_concat(
        F.map_filter("row", lambda k, v: k != "FunctionName"),
        F.create_map(F.lit("FunctionName"), F.coalesce(F.col("description"), F.lit(""))),
    )).drop("_line", "description")


# --- frequency gate (I10, I11) ----------------------------------------------

def period_frequency(c: Column) -> Column:
    """M, Q, A or UNKNOWN for a raw period text."""
    p = F.upper(X.strip(F.coalesce(c.cast("string"), F.lit(""))))
    return (F.when(p.rlike(r"^\d{4}M(0[1-9]|1[0-2])\z"), "M").when(p.rlike(r"^\d{4}Q[1-4]\z"), "Q")
            .when(p.rlike(r"^\d{4}\z"), "A").otherwise("UNKNOWN"))


def frequency_gate(raw: DataFrame, catalog: DataFrame) -> DataFrame:
    """Per payload, is the requested A/M frequency among the observed ones?"""
    cat = catalog.filter(F.col("source") == "bea").select(
        "dataset_id", F.upper(X.strip("bea_frequency")).alias("requested_frequency"))
    obs = raw.groupBy("dataset_id", "run_id").agg(
        F.array_sort(F.collect_set(period_frequency(F.col("row")["TimePeriod"]))).alias("observed_frequencies"))
    return obs.join(F.broadcast(cat), "dataset_id").withColumn(
        "ok", ~F.col("requested_frequency").isin("A", "M")
        | F.array_contains("observed_frequencies", F.col("requested_frequency")))


# --- content hash and change detection (I15-I17, S10) ------------------------

def row_digest(row: Column) -> Column:
    """Per-row SHA-256 of the row's entries sorted by key (nulls kept)."""
    canon = F.to_json(F.map_from_entries(F.array_sort(F.map_entries(row))))
    return F.sha2(canon, 256)


def set_hash(row: Column) -> Column:
    """An aggregate over rows: their count with exact (decimal) sums of two 60-bit slices of each row's digest.

    Permuting rows leaves it unchanged, duplicating a row changes it, and it is combined before the shuffle (no sort,
    no collect).
    """
    h = row_digest(row)
    a = F.conv(F.substring(h, 1, 15), 16, 10).cast("decimal(38,0)")
    b = F.conv(F.substring(h, 16, 15), 16, 10).cast("decimal(38,0)")
    return F.sha2(F.concat_ws(":", F.count(row), F.sum(a), F.sum(b)), 256)


def row_set_hash(raw: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Order-insensitive content hash per payload, and its number of rows."""
    row = F.col("row")
    return raw.groupBy(*(key or ["dataset_id", "run_id"])).agg(
        set_hash(row).alias("payload_hash"), F.count(row).alias("n"))


def change_flags(current: DataFrame, checkpoint: DataFrame | None, key: list[str] | None = None) -> DataFrame:
    """changed = no previous checkpoint, or a different hash."""
    key = key or ["dataset_id"]
    if checkpoint is None:
        return current.withColumn("changed", F.lit(True))
    prev = checkpoint.select(*key, F.col("payload_hash").alias("previous_hash"))
    return current.join(prev, key, "left").withColumn(
        "changed", ~F.col("payload_hash").eqNullSafe(F.col("previous_hash")))


def successive_change_flags(hashes: DataFrame) -> DataFrame:
    """I17 over a run history: each run against the previous run of its dataset."""
    from pyspark.sql import Window
    w = Window.partitionBy("dataset_id").orderBy("load_seq")
    return hashes.withColumn("previous_hash", F.lag("payload_hash").over(w)).withColumn(
        "changed", ~F.col("payload_hash").eqNullSafe(F.col("previous_hash")))
