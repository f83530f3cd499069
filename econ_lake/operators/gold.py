"""Gold and the conformed observation frame.

One 23-column observation shape carries every dataset.  All projections are
narrow; BEA and Census rows are unioned by name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from econ_lake.functions import exprs as X
from econ_lake.operators.silver import BEA_SILVER_COLUMNS, FINANCE_SILVER_COLUMNS, POPULATION_SILVER_COLUMNS

# The names of the conformed columns, and what a Silver row must have.
CONFORMED_COLUMNS = [
    "source_name", "dataset_id", "bea_table_name", "frequency", "period_code", "year", "month", "quarter",
    "state_fips", "state_abbrev", "geo_name", "line_code", "series_code", "series_name", "function_name",
    "raw_description", "hierarchy_path_json", "unit", "unit_mult", "vintage_tag", "pce_value",
    "pce_value_scaled", "note_ref",
]
LINEAGE_EXTRA = ["run_id", "load_seq"]


def require_columns(df: DataFrame, required: list[str], what: str) -> None:
    """G1: schema gate listing missing names (driver-side, schema only)."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{what} missing required columns: {missing}")


def bea_gold(silver: DataFrame) -> DataFrame:
    """Recast ints, value -> pce_value, scaled by 10^unit_mult."""
    require_columns(silver, BEA_SILVER_COLUMNS, "Silver frame")
    return silver.withColumns({
        "year": F.col("year").cast("int"),
        "month": F.col("month").cast("int"),
        "quarter": F.col("quarter").cast("int"),
        "pce_value": F.col("value").cast("double"),
        "pce_value_scaled": F.col("value").cast("double") * F.pow(F.lit(10.0), F.col("unit_mult")),
    }).drop("value")


def bea_conformed(gold: DataFrame, source_name: str = "BEA") -> DataFrame:
    """Add source, keep dataset and vintage lineage, fixed column order."""
    out = gold.withColumns({
        "source_name": F.lit(source_name.strip().upper()),
        "dataset_id": X.strip("dataset_id"),
        "vintage_tag": X.strip("vintage_tag"),
    })
    return out.select(*CONFORMED_COLUMNS, *LINEAGE_EXTRA)


def _census_table(path_col: str = "census_dataset_path"):
    return F.replace(F.upper(X.strip(path_col)), F.lit("/"), F.lit("_"))


def census_conformed(silver: DataFrame, source_name: str = "CENSUS") -> DataFrame:
    """Population and government-finance rows -> conformed rows."""
    require_columns(silver, sorted({*POPULATION_SILVER_COLUMNS, *FINANCE_SILVER_COLUMNS}), "Census Silver frame")
    finance = F.col("census_series_kind") == "state_gov_finance"
    table = _census_table()
    variable = F.upper(F.col("census_variable"))
    label = F.col("census_measure_label").cast("string")
    pop_label = F.lit("Resident population")
    return silver.select(
        F.lit(source_name.strip().upper()).alias("source_name"),
        X.strip("dataset_id").alias("dataset_id"),
        table.alias("bea_table_name"),
        "frequency", "period_code",
        F.col("year").cast("int").alias("year"),
        F.lit(None).cast("int").alias("month"),
        F.lit(None).cast("int").alias("quarter"),
        "state_fips", "state_abbrev", "geo_name",
        variable.alias("line_code"),
        F.when(finance, F.concat_ws("-", table, variable, F.upper(F.col("census_agg_desc"))))
        .otherwise(F.concat_ws("-", table, variable)).alias("series_code"),
        F.when(finance, label).otherwise(pop_label).alias("series_name"),
        F.when(finance, label).otherwise(pop_label).alias("function_name"),
        F.when(finance, label).otherwise(pop_label).alias("raw_description"),
        F.when(finance, F.concat(F.lit('["'), F.replace(label, F.lit('"'), F.lit("'")), F.lit('"]')))
        .otherwise(F.lit('["Resident population"]')).alias("hierarchy_path_json"),
        "unit",
        F.when(finance, F.lit(3)).otherwise(F.lit(0)).alias("unit_mult"),
        X.strip("vintage_tag").alias("vintage_tag"),
        F.when(finance, F.col("amount")).otherwise(F.col("population")).alias("pce_value"),
        F.when(finance, F.col("amount") * F.lit(1000.0)).otherwise(F.col("population")).alias("pce_value_scaled"),
        "note_ref",
        *LINEAGE_EXTRA,
    )


def conformed_observations(bea_silver_df: DataFrame, census_silver_df: DataFrame) -> DataFrame:
    """Every dataset's conformed rows in one frame."""
    return bea_conformed(bea_gold(bea_silver_df)).unionByName(census_conformed(census_silver_df))
