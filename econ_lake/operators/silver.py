"""Silver: raw payload rows -> typed, filtered rows.

Input is the raw-row shape every source produces: ``dataset_id``,
``vintage_tag``, ``run_id``, ``load_seq`` and ``row map<string,string>``.
All datasets are parsed in one pass; dataset attributes come from the
catalog by a broadcast join (the catalog is configuration-sized).
Parsing is narrow (no shuffle).  Which optional fields a payload has is taken
from the landing log, one row per payload; without a log it is a partial
aggregate over the rows.  Either is joined by the planner's size check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from econ_lake.functions import exprs as X
from econ_lake.functions.lookups import fips_frame

LINEAGE = ["dataset_id", "vintage_tag", "run_id", "load_seq"]

# Column, key and required-column names of the Silver rows.
BEA_SILVER_COLUMNS = [
    "state_fips", "state_abbrev", "geo_name", "frequency", "period_code", "year", "month", "quarter",
    "bea_table_name", "line_code", "series_code", "series_name", "function_name", "raw_description",
    "hierarchy_path_json", "value", "unit", "unit_mult", "note_ref",
]
BEA_PK = ["bea_table_name", "state_fips", "period_code", "line_code"]
BEA_REQUIRED = ["state_fips", "state_abbrev", "frequency", "period_code", "year", "bea_table_name",
                "line_code", "value"]

POPULATION_SILVER_COLUMNS = [
    "state_fips", "state_abbrev", "geo_name", "frequency", "period_code", "year", "population",
    "census_dataset_path", "census_variable", "census_series_kind", "census_measure_label", "unit", "note_ref",
]
FINANCE_SILVER_COLUMNS = [
    "state_fips", "state_abbrev", "geo_name", "frequency", "period_code", "year", "amount",
    "census_dataset_path", "census_variable", "census_series_kind", "census_measure_label",
    "census_agg_desc", "unit", "note_ref",
]
CENSUS_PK = ["state_fips", "period_code", "census_variable"]


def _field(name: str):
    return F.col("row")[name]


OPTIONAL_FIELDS = ("NoteRef", "FunctionName", "LineDescription")


def field_presence(raw: DataFrame) -> DataFrame:
    """Per payload (dataset_id, run_id): does any row carry each optional field?"""
    return raw.groupBy("dataset_id", "run_id").agg(
        *[F.max(F.map_contains_key("row", f)).alias(f"has_{f}") for f in OPTIONAL_FIELDS]
    )


def bea_silver(raw: DataFrame, catalog: DataFrame, presence: DataFrame | None = None) -> DataFrame:
    """Typed BEA rows for states + DC, annual and monthly periods only.

    ``presence`` has a row per payload (``field_presence``, or the landing log).
    """
    spark = raw.sparkSession
    cat = catalog.filter(F.col("source") == "bea").select(
        "dataset_id", F.col("bea_table_name").alias("_spec_table"), F.col("bea_frequency").alias("_spec_freq"))
    rows = raw.join(F.broadcast(cat), "dataset_id")
    presence = field_presence(rows) if presence is None else presence.select(
        "dataset_id", "run_id", *[f"has_{f}" for f in OPTIONAL_FIELDS])
    rows = rows.join(presence, ["dataset_id", "run_id"])

    # texts that several columns come from are cleaned in a projection of their own, once a row
    rows = rows.select(
        *LINEAGE,
        F.substring(_field("GeoFips").cast("string"), 1, 2).alias("state_fips"),
        _field("GeoName").alias("geo_name"),
        X.period_text(_field("TimePeriod")).alias("_period"),
        "_spec_table", F.upper(X.strip(F.coalesce(F.col("_spec_freq"), F.lit("")))).alias("_requested"),
        _field("Code").alias("series_code"),
        X.number_text(_field("DataValue")).alias("_value_text"),
        X.number_text(_field("UNIT_MULT"), strip_commas=False).alias("_mult_text"),
        _field("CL_UNIT").alias("unit"),
        F.when(F.col("has_NoteRef"), _field("NoteRef")).otherwise(F.lit("")).alias("note_ref"),
        F.coalesce(
            F.when(F.col("has_FunctionName"), _field("FunctionName"))
            .when(F.col("has_LineDescription"), _field("LineDescription"))
            .otherwise(F.lit("")),
            F.lit(""),
        ).alias("raw_description"),
    )
    # states + DC only (51-row fixed lookup)
    rows = rows.join(F.broadcast(fips_frame(spark)), "state_fips")
    per = X.parts_of_period(F.col("_period"))
    rows = rows.select("*", *[per[k].alias(k) for k in ("frequency", "year", "month", "quarter")])
    rows = rows.filter(F.col("frequency").isin("A", "M") & F.col("year").isNotNull()).filter(
        F.when(F.col("_requested").isin("A", "M"), F.col("frequency") == F.col("_requested")).otherwise(F.lit(True)))
    rows = rows.withColumn("_path", X.label_path(F.col("raw_description")))
    path = F.col("_path")
    out = rows.select(
        *LINEAGE,
        "state_fips", "state_abbrev", "geo_name", "frequency",
        X.period_code("frequency", "year", "month").alias("period_code"),
        "year", "month", "quarter",
        F.coalesce(F.upper(X.strip(F.col("_spec_table"))), F.upper(X.before_first_dash("series_code"))).alias(
            "bea_table_name"),
        X.after_first_dash("series_code").alias("line_code"),
        F.col("series_code").cast("string").alias("series_code"),
        X.label_series_name(path).alias("series_name"),
        X.label_function_name(path).alias("function_name"),
        "raw_description",
        X.json_text_list(path).alias("hierarchy_path_json"),
        X.number_of("_value_text").alias("value"),
        "unit",
        X.whole_or_zero(X.number_of("_mult_text")).alias("unit_mult"),
        "note_ref",
    )
    return out


def census_silver(raw: DataFrame, catalog: DataFrame) -> DataFrame:
    """Typed Census rows for both series kinds (population, government finance).

    Returns one frame holding both shapes: ``population`` and ``amount`` are
    filled by kind, ``census_agg_desc`` is '' for population rows.
    """
    spark = raw.sparkSession
    cat = catalog.filter(F.col("source") == "census").select(
        "dataset_id",
        F.upper(X.strip("census_variable")).alias("census_variable"),
        F.lower(X.strip("census_series_kind")).alias("census_series_kind"),
        F.lower(X.strip("census_dataset_path")).alias("census_dataset_path"),
        X.strip("census_measure_label").alias("census_measure_label"),
        X.strip("census_unit").alias("unit"),
        F.coalesce(F.col("census_agg_desc"), F.lit("")).alias("_agg_desc"),
    )
    rows = raw.join(F.broadcast(cat), "dataset_id")
    fips = X.zfill2(_field("state"))
    value_text = F.col("row")[F.col("census_variable")]
    rows = rows.select(
        *LINEAGE,
        fips.alias("state_fips"),
        _field("NAME").cast("string").alias("geo_name"),
        X.parse_year(_field("YEAR")).alias("year"),
        # no comma stripping for Census values
        X.parse_number(value_text, strip_commas=False).alias("_value"),
        "census_variable", "census_series_kind", "census_dataset_path", "census_measure_label", "unit",
        "_agg_desc",
    )
    rows = rows.join(F.broadcast(fips_frame(spark)), "state_fips").filter(F.col("year").isNotNull())
    finance = F.col("census_series_kind") == "state_gov_finance"
    return rows.select(
        *LINEAGE,
        "state_fips", "state_abbrev", "geo_name",
        F.lit("A").alias("frequency"),
        F.col("year").cast("string").alias("period_code"),
        "year",
        F.when(~finance, F.col("_value")).alias("population"),
        F.when(finance, F.col("_value")).alias("amount"),
        "census_dataset_path", "census_variable", "census_series_kind", "census_measure_label",
        F.when(finance, F.col("_agg_desc")).otherwise(F.lit("")).alias("census_agg_desc"),
        "unit",
        F.lit("").alias("note_ref"),
    )


def census_variable_report(raw: DataFrame, catalog: DataFrame) -> DataFrame:
    """Per Census payload, is the configured variable present in any row?"""
    cat = catalog.filter(F.col("source") == "census").select(
        "dataset_id", F.upper(X.strip("census_variable")).alias("census_variable"))
    return (
        raw.join(F.broadcast(cat), "dataset_id")
        .groupBy("dataset_id", "run_id", "census_variable")
        .agg(F.max(F.map_contains_key("row", F.col("census_variable"))).alias("variable_present"))
    )
