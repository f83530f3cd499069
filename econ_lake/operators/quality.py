"""Quality gates as report DataFrames (T18, T26, G8, I12, W15) plus assert
wrappers.  Reports are aggregates (partial aggregation, no collect); only
the assert wrappers bring the small report to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from econ_lake.operators.silver import BEA_PK, BEA_REQUIRED, CENSUS_PK

# What a Census Silver row must have.
CENSUS_REQUIRED = ["state_fips", "state_abbrev", "geo_name", "frequency", "period_code", "year",
                   "census_dataset_path", "census_variable", "census_series_kind"]


def silver_report(df: DataFrame, required: list[str], pk: list[str],
                  payload: tuple[str, ...] = ("dataset_id", "run_id")) -> DataFrame:
    """Per payload: rows, rows with a NULL required column, duplicate primary keys.

    Duplicates are counted with two partial aggregates (per key, then per
    payload), so a hot payload never lands in one task.
    """
    any_null = F.lit(False)
    for c in required:
        any_null = any_null | F.col(c).isNull()
    per_key = df.groupBy(*payload, *pk).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(any_null).alias("_nulls"))
    return per_key.groupBy(*payload).agg(
        F.sum("_n").alias("rows"), F.sum("_nulls").alias("null_required"),
        F.sum(F.col("_n") - 1).alias("duplicate_keys"),
    ).withColumn("ok", (F.col("rows") > 0) & (F.col("null_required") == 0) & (F.col("duplicate_keys") == 0))


def bea_silver_report(silver: DataFrame) -> DataFrame:
    """BEA Silver gate."""
    return silver_report(silver, BEA_REQUIRED, BEA_PK)


def census_silver_report(silver: DataFrame) -> DataFrame:
    """Census Silver gate (the measure column depends on the kind)."""
    measure = F.coalesce(F.col("population"), F.col("amount"))
    return silver_report(silver.withColumn("_measure", measure), CENSUS_REQUIRED + ["_measure"], CENSUS_PK)


def assert_report_ok(report: DataFrame, what: str) -> None:
    """Raise when any report row is not ok (the report is small by construction)."""
    bad = report.filter(~F.col("ok")).limit(5).collect()
    if bad:
        raise ValueError(f"{what} gate: {[r.asDict() for r in bad]}")


def assert_not_empty(df: DataFrame, what: str) -> None:
    """Refuse an empty frame."""
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")


PAYLOAD = ["dataset_id", "run_id"]


def payload_verdicts(log: DataFrame, raw: DataFrame, catalog: DataFrame, bea: DataFrame, census: DataFrame) -> DataFrame:
    """Per landed payload whether it may be loaded, and what speaks against it.

    ``log`` has a row per payload, also those without any data row, and the problem of its envelope (if any).
    """
    from econ_lake.operators.silver import census_variable_report
    from econ_lake.sources.bronze import frequency_gate

    silver = bea_silver_report(bea).unionByName(census_silver_report(census)).select(
        *PAYLOAD, "null_required", "duplicate_keys", F.lit(True).alias("has_silver"))
    frequency = frequency_gate(raw.filter(F.col("source") == "bea"), catalog).select(
        *PAYLOAD, F.col("ok").alias("frequency_ok"))
    variable = census_variable_report(raw, catalog).select(*PAYLOAD, "variable_present")
    all_in = (log.select(*PAYLOAD, "row_count", "problem").join(silver, PAYLOAD, "left").join(frequency, PAYLOAD, "left")
              .join(variable, PAYLOAD, "left"))
    reasons = F.filter(F.array(
        F.col("problem"),
        F.when((F.col("row_count") == 0) & F.col("problem").isNull(), "no rows"),
        F.when((F.col("row_count") > 0) & F.col("has_silver").isNull(), "no typed rows"),
        F.when(F.col("null_required") > 0, "required value missing"),
        F.when(F.col("duplicate_keys") > 0, "duplicate key"),
        F.when(~F.col("frequency_ok"), "requested frequency missing"),
        F.when(~F.col("variable_present"), "variable missing"),
    ), lambda r: r.isNotNull())
    return all_in.select(*PAYLOAD, F.array_join(reasons, "; ").alias("reason"), (F.size(reasons) == 0).alias("ok"))


def split_by_verdict(rows: DataFrame, verdicts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of payloads that passed, and those of the others with the reason (for the quarantine)."""
    good = rows.join(verdicts.filter("ok").select(*PAYLOAD), PAYLOAD, "left_semi")
    bad = rows.join(verdicts.filter(~F.col("ok")).select(*PAYLOAD, "reason"), PAYLOAD)
    return good, bad
