"""Serving views (V1-V13) as DataFrame functions.

Each view is a function of DataFrames, composed lazily; ``register_views``
publishes them as temp views in dependency order (V12).  The wide table V1
is read several times by V7-V11, so it is stored once first (X4,
``materialise_wide_table``).
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from econ_lake.functions import exprs as X
from econ_lake.functions import lookups as L
from econ_lake.operators.warehouse import Star
from econ_lake.session import materialise

# The names of the views that others are made from.
WIDE, WEIGHTED = "obt_state_macro_annual_latest", "v_state_rpp_pce_weighted_annual"
#: Tasks that write the kept wide table's rows of a dataset, at most.
WIDE_TASKS = 64

# The names of the published output columns.
OBT_COLUMNS = [
    "source_name", "dataset_id", "bea_table_name", "state_fips", "state_abbrev", "geo_name", "year",
    "line_code", "series_code", "series_name", "function_name", "raw_description", "hierarchy_path_json",
    "unit", "unit_mult", "vintage_tag", "release_tag", "pce_value", "pce_value_scaled", "note_ref",
]


def obt_annual_latest(star: Star) -> DataFrame:
    """V1: latest-vintage annual wide table (fact joined to five dims)."""
    f = star.fact
    src = star.dim_source.select("source_id", "source_name", "dataset_id", F.col("table_name").alias("bea_table_name"))
    geo = star.dim_geo.select("geo_id", "state_fips", "state_abbrev", "geo_name")
    per = star.dim_period.filter(F.col("frequency") == "A").select("period_id", "year")
    ser = star.dim_series.select("series_id", "line_code", "series_code", "series_name", "function_name",
                                 "raw_description", "hierarchy_path_json", "unit", "unit_mult")
    vin = star.dim_vintage.filter(F.col("is_latest")).select("vintage_id", "vintage_tag", "release_tag")
    return (
        f.join(vin, "vintage_id").join(per, "period_id").join(src, "source_id")
        .join(geo, "geo_id").join(ser, "series_id")
        .select(*OBT_COLUMNS[:17], "unit", "unit_mult", "vintage_tag", "release_tag",
                F.col("value_numeric").alias("pce_value"), F.col("value_scaled").alias("pce_value_scaled"),
                "note_ref")
        .select(*OBT_COLUMNS)
    )


def materialise_wide_table(star: Star) -> DataFrame:
    """V1 stored in the shared folder, so that the views over it don't join the star again."""
    return materialise(obt_annual_latest(star), "wide")


def rpp_rows(obt: DataFrame) -> DataFrame:
    """V2: price rows with the line -> category lookup (unknown line: NULL key)."""
    spark = obt.sparkSession
    cats = F.broadcast(L.rpp_category_frame(spark))  # 5 rows, fixed
    r = obt.filter((F.col("source_name") == "BEA") & (F.col("bea_table_name") == "SARPP"))
    return r.join(cats, "line_code", "left").select(
        "state_fips", "state_abbrev", "geo_name", "year",
        F.col("line_code").alias("rpp_line_code"), F.col("series_code").alias("rpp_series_code"),
        F.col("function_name").alias("rpp_function_name"), F.col("pce_value").alias("rpp"),
        F.col("vintage_tag").alias("rpp_vintage_tag"), F.col("release_tag").alias("rpp_release_tag"),
        "category_key",
        F.coalesce(F.col("category"), F.col("function_name")).alias("category"),
    )


def pce_rows(obt: DataFrame) -> DataFrame:
    """V3 + V4: spending rows per category in one pass over the wide table.

    Direct categories come from a 4-row crosswalk join; the derived category
    is a conditional aggregate (line 13 minus line 15, NULL if either is
    missing).
    """
    spark = obt.sparkSession
    d = L.DERIVED_OTHER_SERVICES
    bea = obt.filter(F.col("source_name") == "BEA")
    xwalk = F.broadcast(L.crosswalk_frame(spark))  # 4 rows, fixed
    direct = bea.join(
        xwalk, (bea.bea_table_name == xwalk.pce_source_table) & (bea.line_code == xwalk.line_code)
    ).select(
        "state_fips", "state_abbrev", "geo_name", "year", "category_key", "category", "mapping_method",
        "pce_source_table", F.col("series_code").alias("pce_series_code"),
        F.col("function_name").alias("pce_function_name"), F.col("pce_value_scaled").alias("pce"),
        F.col("vintage_tag").alias("pce_vintage_tag"), F.col("release_tag").alias("pce_release_tag"),
    )
    parts = bea.filter((F.col("bea_table_name") == d["table"])
                       & F.col("line_code").isin(d["minuend_line"], d["subtrahend_line"]))
    derived = parts.groupBy("state_fips", "state_abbrev", "geo_name", "year").agg(
        (F.max(F.when(F.col("line_code") == d["minuend_line"], F.col("pce_value_scaled")))
         - F.max(F.when(F.col("line_code") == d["subtrahend_line"], F.col("pce_value_scaled")))).alias("pce"),
        F.max("vintage_tag").alias("pce_vintage_tag"),
        F.max("release_tag").alias("pce_release_tag"),
    ).select(
        "state_fips", "state_abbrev", "geo_name", "year",
        F.lit(d["category_key"]).alias("category_key"), F.lit(d["category"]).alias("category"),
        F.lit(d["mapping_method"]).alias("mapping_method"), F.lit(d["table"]).alias("pce_source_table"),
        F.lit(d["series_code"]).alias("pce_series_code"), F.lit(d["function_name"]).alias("pce_function_name"),
        "pce", "pce_vintage_tag", "pce_release_tag",
    )
    return direct.unionByName(derived)


def national_totals(pce: DataFrame) -> DataFrame:
    """V5: national spending per (year, category) over all spending rows."""
    return pce.groupBy("year", "category_key").agg(F.sum("pce").alias("national_pce"))


WEIGHTED_COLUMNS = [
    "year", "state_fips", "state_abbrev", "geo_name", "category", "rpp_line_code", "rpp_series_code",
    "rpp_function_name", "rpp", "pce_source_table", "pce_series_code", "pce_function_name", "mapping_method",
    "pce", "pce_share", "weighted_rpp", "rpp_vintage_tag", "rpp_release_tag", "pce_vintage_tag",
    "pce_release_tag",
]


def weighted_view(obt: DataFrame) -> DataFrame:
    """V6 + V7: share-weighted price contributions.

    Totals are computed over every spending row before the price join, so
    shares over the joined subset may sum below one (the study gate
    reports that).
    """
    r = rpp_rows(obt).filter(F.col("category_key").isNotNull())
    p = pce_rows(obt)
    t = national_totals(p)
    joined = (
        r.join(p.drop("state_abbrev", "geo_name", "category"), ["state_fips", "year", "category_key"])
        .join(t, ["year", "category_key"])
    )
    share = F.when(F.col("pce").isNull(), F.lit(None).cast("double")).otherwise(
        X.safe_ratio(F.col("pce"), F.col("national_pce")))
    return joined.withColumn("pce_share", share).withColumn(
        "weighted_rpp",
        F.when(F.col("rpp").isNull() | F.col("pce_share").isNull(), F.lit(None).cast("double"))
        .otherwise(F.col("rpp") * F.col("pce_share")),
    ).select(*WEIGHTED_COLUMNS)


YOY_COLUMNS = [
    "source_name", "dataset_id", "bea_table_name", "state_fips", "state_abbrev", "geo_name", "line_code",
    "series_code", "series_name", "function_name", "raw_description", "hierarchy_path_json", "year",
    "value_current", "value_prior", "yoy_pct",
]
YOY_KEY = ["source_name", "dataset_id", "state_fips", "series_code"]


def _yoy_pct(cur: str, prev: str):
    p = F.col(prev)
    return F.when(p.isNull() | (p == 0), F.lit(None).cast("double")).otherwise(
        ((F.col(cur) - p) / p) * F.lit(100.0))


def yoy_view(obt: DataFrame) -> DataFrame:
    """V8 (join form): left self-join on the series key and ``year = prior + 1``.

    Exact year-1 semantics: a gap year gives NULL, never the previous row.
    Two keys may hold several rows (the join then fans out, as the SQL does).
    """
    prev = obt.select(*[F.col(k).alias(f"_p_{k}") for k in YOY_KEY],
                      (F.col("year") + 1).alias("_p_next_year"), F.col("pce_value").alias("value_prior"))
    cond = [obt[k] == prev[f"_p_{k}"] for k in YOY_KEY]
    cond.append(obt["year"] == prev["_p_next_year"])
    j = obt.join(prev, cond, "left")
    return j.select(
        *YOY_COLUMNS[:13], F.col("pce_value").alias("value_current"), "value_prior",
        _yoy_pct("pce_value", "value_prior").alias("yoy_pct"),
    )


def yoy_view_window(obt: DataFrame) -> DataFrame:
    """V8 (range-frame form): one exchange instead of two.

    Valid when (series key, year) is unique, which the fact key guarantees
    within one latest vintage.  ``rangeBetween(-1, -1)`` picks exactly the
    prior year, so gaps give NULL.
    """
    from pyspark.sql import Window as W
    w = W.partitionBy(*YOY_KEY).orderBy("year").rangeBetween(-1, -1)
    return obt.select(
        *YOY_COLUMNS[:13], F.col("pce_value").alias("value_current"),
        F.first("pce_value").over(w).alias("value_prior"),
    ).withColumn("yoy_pct", _yoy_pct("value_current", "value_prior"))


PER_CAPITA_COLUMNS = [
    "bea_table_name", "state_fips", "state_abbrev", "geo_name", "year", "line_code", "series_code",
    "series_name", "function_name", "bea_unit", "pce_value", "pce_value_scaled", "population",
    "population_vintage_tag", "value_per_capita",
]


def per_capita_view(obt: DataFrame, population_dataset_id: str | None = L.POPULATION_DATASET) -> DataFrame:
    """V9: BEA rows over resident population.

    ``population_dataset_id=None`` joins every Census row, as the original
    SQL does (rows with a finance record then appear twice).
    """
    bea = obt.filter(F.col("source_name") == "BEA")
    pop = obt.filter(F.col("source_name") == "CENSUS")
    if population_dataset_id is not None:
        pop = pop.filter(F.col("dataset_id") == population_dataset_id)
    pop = pop.select("state_fips", "year", F.col("pce_value_scaled").alias("population"),
                     F.col("vintage_tag").alias("population_vintage_tag"))
    return bea.join(pop, ["state_fips", "year"], "left").select(
        "bea_table_name", "state_fips", "state_abbrev", "geo_name", "year", "line_code", "series_code",
        "series_name", "function_name", F.col("unit").alias("bea_unit"), "pce_value", "pce_value_scaled",
        "population", "population_vintage_tag",
        X.safe_ratio(F.col("pce_value_scaled"), F.col("population")).alias("value_per_capita"),
    )


def _gdp_rows(obt: DataFrame) -> DataFrame:
    return obt.filter((F.col("source_name") == "BEA") & (F.col("bea_table_name") == L.GDP_TABLE)
                      & (F.col("line_code") == L.GDP_LINE)).select(
        "state_fips", "year", F.col("pce_value_scaled").alias("gdp_current_dollars"),
        F.col("vintage_tag").alias("gdp_vintage_tag"))


def federal_to_stategov_gdp(obt: DataFrame) -> DataFrame:
    """Federal -> state-government receipts over state GDP."""
    num = obt.filter((F.col("source_name") == "CENSUS") & (F.col("dataset_id") == L.FEDERAL_TO_STATEGOV_DATASET))
    return _ratio(obt, num, "federal_stategov_receipts_dollars", "federal_stategov_to_gdp_ratio",
                  "federal_stategov_vintage_tag")


def federal_to_persons_gdp(obt: DataFrame) -> DataFrame:
    """Federal -> persons receipts over state GDP."""
    num = obt.filter((F.col("source_name") == "BEA") & (F.col("dataset_id") == L.FEDERAL_TO_PERSONS_DATASET)
                     & (F.col("line_code") == L.FEDERAL_TO_PERSONS_LINE))
    return _ratio(obt, num, "federal_to_persons_receipts_dollars", "federal_to_persons_to_gdp_ratio",
                  "federal_to_persons_vintage_tag")


def _ratio(obt: DataFrame, num: DataFrame, measure: str, ratio: str, vintage: str) -> DataFrame:
    n = num.select("state_fips", "state_abbrev", "geo_name", "year",
                   F.col("pce_value_scaled").alias(measure), F.col("vintage_tag").alias(vintage))
    return n.join(_gdp_rows(obt), ["state_fips", "year"], "left").select(
        "state_fips", "state_abbrev", "geo_name", "year", measure, "gdp_current_dollars",
        X.safe_ratio(F.col(measure), F.col("gdp_current_dollars")).alias(ratio),
        vintage, "gdp_vintage_tag",
    )


def subset_level(weighted: DataFrame, keep: "F.Column | None" = None,
                 by: tuple[str, ...] = ("year", "category")) -> DataFrame:
    """Re-normalised level of any subset of states: sum(w) / sum(share)."""
    w = weighted if keep is None else weighted.filter(keep)
    return w.groupBy(*by).agg(
        X.safe_ratio(F.sum("weighted_rpp"), F.sum("pce_share")).alias("rpp_level"),
        F.sum("pce_share").alias("share_sum"),
    )


def register_views(spark: SparkSession, star: Star,
                   population_dataset_id: str | None = L.POPULATION_DATASET) -> dict[str, DataFrame]:
    """Drops every view, dependants first, and creates them again over the stored wide table."""
    obt = materialise_wide_table(star)
    views = {
        WIDE: obt,
        WEIGHTED: weighted_view(obt),
        "v_macro_yoy": yoy_view_window(obt),
        "v_pce_state_per_capita_annual": per_capita_view(obt, population_dataset_id),
        "v_state_federal_to_stategov_gdp_annual": federal_to_stategov_gdp(obt),
        "v_state_federal_to_persons_gdp_annual": federal_to_persons_gdp(obt),
    }
    for name in reversed(views):
        spark.catalog.dropTempView(name)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return views


# --- X4: the wide table kept between loads -----------------------------------

def refresh_wide_table(spark: SparkSession, path: str, star: Star, datasets: list[str]) -> None:
    """Rewrites the partitions of the loaded datasets; files of the others stay as they are.

    A row of V1 belongs to one dataset and follows from that dataset's facts and dimensions alone, so the kept table
    equals a full build.  The facts of other datasets aren't joined.
    """
    sources = star.dim_source.filter(F.col("dataset_id").isin(datasets))
    touched = star.fact.join(F.broadcast(sources.select("source_id")), "source_id", "left_semi")  # a row per table
    rows = obt_annual_latest(replace(star, fact=touched, dim_source=sources))
    (rows.repartition("dataset_id", F.pmod(F.xxhash64("state_fips", "series_code"), F.lit(WIDE_TASKS)))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dataset_id").parquet(path))


def read_wide_table(spark: SparkSession, path: str) -> DataFrame:
    """The kept wide table, in the order of its published columns."""
    return spark.read.parquet(path).select(*OBT_COLUMNS)
