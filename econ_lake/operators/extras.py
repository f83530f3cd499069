"""Spark-side additions declared by the reference but not built there:
monthly change and 12-month rolling mean (X3), as-of vintage reads (X6).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SERIES_KEY = ["source_name", "dataset_id", "state_fips", "series_code"]


def monthly_change(conformed: DataFrame) -> DataFrame:
    """Month-over-month percent and 12-month rolling mean of monthly rows, in the
    vintage that each source loaded last.

    The month index is ``year*12 + month``; range frames pick exactly the
    prior month and the last twelve months, so gaps give NULL, and the
    rolling mean needs all twelve months.  Window groups are one series of
    one state (bounded by the number of months).
    """
    monthly = conformed.filter(F.col("frequency") == "M")
    source = ["source_name", "dataset_id", "bea_table_name"]
    latest = monthly.groupBy(*source).agg(F.max_by("vintage_tag", "load_seq").alias("vintage_tag"))
    m = monthly.join(latest, [*source, "vintage_tag"]).withColumn("month_index", F.col("year") * 12 + F.col("month"))
    w = Window.partitionBy(*SERIES_KEY).orderBy("month_index")
    prev = F.first("pce_value").over(w.rangeBetween(-1, -1))
    roll_sum = F.sum("pce_value").over(w.rangeBetween(-11, 0))
    roll_n = F.count("pce_value").over(w.rangeBetween(-11, 0))
    out = m.select(
        *SERIES_KEY, "period_code", "year", "month", "pce_value",
        prev.alias("value_prior_month"), roll_sum.alias("_roll_sum"), roll_n.alias("_roll_n"),
    )
    prior = F.col("value_prior_month")
    return out.select(
        *SERIES_KEY, "period_code", "year", "month", "pce_value", "value_prior_month",
        F.when(prior.isNull() | (prior == 0), F.lit(None).cast("double"))
        .otherwise((F.col("pce_value") - prior) / prior * F.lit(100.0)).alias("mom_pct"),
        F.when(F.col("_roll_n") == 12, F.col("_roll_sum") / F.lit(12.0)).alias("rolling_12m_mean"),
    )


def as_of_vintage(conformed: DataFrame, as_of: str) -> DataFrame:
    """Each observation as known on ``as_of`` (greatest vintage tag <= as_of,
    last load of that vintage)."""
    key = ["source_name", "dataset_id", "bea_table_name", "series_code", "state_fips", "frequency", "period_code"]
    pick = F.max_by(F.struct("vintage_tag", "pce_value", "pce_value_scaled"), F.struct("vintage_tag", "load_seq"))
    return (
        conformed.filter(F.col("vintage_tag") <= F.lit(as_of))
        .groupBy(*key).agg(pick.alias("p"))
        .select(*key, "p.vintage_tag", "p.pce_value", "p.pce_value_scaled")
    )
