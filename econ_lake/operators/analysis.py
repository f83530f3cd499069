"""Weighted price-level study (A1-A20) on top of the weighted view.

Everything stays distributed: the latest year is a one-row aggregate that is joined, scenarios are conditional aggregates in a single
``groupBy`` (no cross join with the scenario table), first/last values are
``min_by``/``max_by`` with a null filter, top-1 per group is ``row_number``.
Sums are plain sums; nothing is rounded before a gate or a report has seen it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from econ_lake.functions import exprs as X
from econ_lake.functions import lookups as L
from econ_lake.operators.serving import WEIGHTED, subset_level

NATIONAL = L.SCENARIO_ORDER[0]


def latest_year(weighted: DataFrame) -> DataFrame:
    """A1: MAX(year) of the weighted view (one row)."""
    return weighted.agg(F.max("year").alias("latest_year"))


def latest_year_rows(weighted: DataFrame) -> DataFrame:
    """A2: the latest year's rows."""
    return weighted.join(F.broadcast(latest_year(weighted)), F.col("year") == F.col("latest_year")).select(
        "year", "state_abbrev", "category", "rpp", "pce_share", "weighted_rpp")


def trend_rows(weighted: DataFrame, states: tuple[str, ...] = L.TARGET_STATES, years: int = 5) -> DataFrame:
    """A3: the last ``years`` years of the target states."""
    last = F.col("latest_year")
    wanted = latest_year(weighted).select(F.explode(F.sequence(last - (years - 1), last)).alias("year"))
    return weighted.filter(F.col("state_abbrev").isin(*states)).join(F.broadcast(wanted), "year").select(
        "state_abbrev", "category", "year", "rpp")


def share_sums(weighted: DataFrame) -> DataFrame:
    """A4: share sum per (year, category)."""
    return weighted.groupBy("year", "category").agg(F.sum("pce_share").alias("share_sum"))


def share_sum_report(weighted: DataFrame, tolerance: float = L.SHARE_SUM_TOLERANCE) -> DataFrame:
    """Groups whose shares do not sum to one within ``tolerance``."""
    return share_sums(weighted).withColumn(
        "ok", F.coalesce(F.abs(F.col("share_sum") - F.lit(1.0)) <= F.lit(tolerance), F.lit(False)))


def _scenario_sums(rows: DataFrame) -> DataFrame:
    """Per category: weighted and share sums under every scenario, one pass."""
    aggs = []
    for i, name in enumerate(L.SCENARIO_ORDER):
        excluded = L.SCENARIO_EXCLUSIONS[name]
        keep = ~F.col("state_abbrev").isin(*excluded) if excluded else F.lit(True)
        aggs.append(F.sum(F.when(keep, F.col("weighted_rpp"))).alias(f"w{i}"))
        aggs.append(F.sum(F.when(keep, F.col("pce_share"))).alias(f"s{i}"))
    sums = rows.groupBy("category").agg(*aggs)
    per = F.array(*[
        F.struct(F.lit(name).alias("scenario"), F.lit(i + 1).alias("scenario_rank"),
                 F.col(f"w{i}").alias("weighted_sum"), F.col(f"s{i}").alias("share_sum"))
        for i, name in enumerate(L.SCENARIO_ORDER)
    ])
    return sums.select("category", F.col("w0").alias("national_rpp"), F.inline(per))


def _category_rank() -> Column:
    rank = F.lit(len(L.CATEGORY_ORDER))
    for i, c in reversed(list(enumerate(L.CATEGORY_ORDER[:-1]))):
        rank = F.when(F.col("category") == c, F.lit(i + 1)).otherwise(rank)
    return rank


def scenarios_sql_form(weighted: DataFrame) -> DataFrame:
    """A5 (+A7, A8): exclusion scenarios, level = sum(w)/NULLIF(sum(share),0)
    for subsets; percent = ((level / national) - 1) * 100."""
    s = _scenario_sums(latest_year_rows(weighted))
    level = F.when(F.col("scenario") == NATIONAL, F.col("weighted_sum")).otherwise(
        X.safe_ratio(F.col("weighted_sum"), F.col("share_sum")))
    out = s.withColumn("rpp_level", level).withColumn(
        "national_rpp", F.col("national_rpp"))
    return out.select(
        "category", "scenario", "rpp_level", "share_sum",
        (F.col("rpp_level") - F.col("national_rpp")).alias("difference_from_national"),
        ((X.safe_ratio(F.col("rpp_level"), F.col("national_rpp")) - F.lit(1)) * F.lit(100.0)).alias(
            "pct_change_from_national"),
        _category_rank().alias("category_rank"), "scenario_rank",
    )


def scenarios_frame_form(weighted: DataFrame) -> DataFrame:
    """Same scenarios, percent = difference / national * 100."""
    s = _scenario_sums(latest_year_rows(weighted))
    level = F.when(F.col("scenario") == NATIONAL, F.col("weighted_sum")).otherwise(
        F.try_divide(F.col("weighted_sum"), F.col("share_sum")))
    out = s.withColumn("rpp_level", level).withColumn(
        "difference_from_national", F.col("rpp_level") - F.col("national_rpp"))
    return out.select(
        "category", "scenario", "rpp_level", "difference_from_national",
        (F.try_divide(F.col("difference_from_national"), F.col("national_rpp")) * F.lit(100.0)).alias(
            "pct_change_from_national"),
        "share_sum",
    )


def scenario_levels_by_state(weighted: DataFrame) -> DataFrame:
    """The scenarios by another route: V13 (``subset_level``) of each one's states, on its own."""
    rows = latest_year_rows(weighted)
    out = None
    for name in L.SCENARIO_ORDER:
        excluded = L.SCENARIO_EXCLUSIONS[name]
        one = subset_level(rows, ~F.col("state_abbrev").isin(*excluded) if excluded else None, ("category",))
        if name == NATIONAL:  # the national level is the sum itself, not re-normalised
            one = one.withColumn("rpp_level", F.col("rpp_level") * F.col("share_sum"))
        one = one.withColumn("scenario", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


def scenario_reconciliation(weighted: DataFrame, tolerance: float = L.SCENARIO_MATH_TOLERANCE) -> DataFrame:
    """The scenario table (A5) against the levels computed by state subsets.

    A key that one side lacks, and a value that only one side has, are failures.
    """
    key = ["category", "scenario"]
    left = scenarios_sql_form(weighted).withColumn("here", F.lit(1)).alias("a")
    right = scenario_levels_by_state(weighted)
    national = right.filter(F.col("scenario") == NATIONAL).select("category", F.col("rpp_level").alias("national"))
    right = right.join(national, "category", "left").select(
        *key, "rpp_level", "share_sum", (F.col("rpp_level") - F.col("national")).alias("difference_from_national"),
        (F.try_divide(F.col("rpp_level") - F.col("national"), F.col("national")) * 100.0).alias(
            "pct_change_from_national"), F.lit(1).alias("here")).alias("b")
    columns = ["rpp_level", "difference_from_national", "pct_change_from_national", "share_sum"]
    lone = F.col("a.here").isNull() | F.col("b.here").isNull()
    both = left.join(right, key, "full_outer").select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.abs(F.col(f"a.{c}") - F.col(f"b.{c}")).alias("delta"),
                 (lone | (F.col(f"a.{c}").isNull() != F.col(f"b.{c}").isNull())).alias("lone")) for c in columns])))
    return both.groupBy("column_name").agg(F.max("delta").alias("max_delta"), F.count_if("lone").alias("unmatched")
                                           ).withColumn("ok", (F.coalesce("max_delta", F.lit(0.0)) <= tolerance)
                                                        & (F.col("unmatched") == 0))


def completeness_report(trend: DataFrame, years: int = 5) -> DataFrame:
    """(state, category) groups without exactly ``years`` distinct years."""
    return trend.groupBy("state_abbrev", "category").agg(
        F.count_distinct("year").alias("distinct_years")).withColumn("ok", F.col("distinct_years") == years)


def state_change_summary(trend: DataFrame, years: int = 5) -> DataFrame:
    """A10: first/last year and first/last non-null rpp per (state, category).

    Every group is reported; ``complete`` tells whether it has exactly ``years``
    years (A9).  ``assert_complete`` refuses a study with an incomplete one.
    """
    nn = F.col("rpp").isNotNull()
    s = trend.groupBy("state_abbrev", "category").agg(
        F.min("year").alias("start_year"), F.max("year").alias("end_year"),
        F.min_by(F.when(nn, F.col("rpp")), F.when(nn, F.col("year"))).alias("start_rpp"),
        F.max_by(F.when(nn, F.col("rpp")), F.when(nn, F.col("year"))).alias("end_rpp"),
        (F.count_distinct("year") == years).alias("complete"),
    )
    return s.withColumn("rpp_change", F.col("end_rpp") - F.col("start_rpp")).withColumn(
        "pct_change", (F.try_divide(F.col("end_rpp"), F.col("start_rpp")) - F.lit(1.0)) * F.lit(100.0))


def assert_complete(trend: DataFrame, years: int = 5) -> None:
    """Raise when a (state, category) group lacks a year or has too many."""
    bad = completeness_report(trend, years).filter(~F.col("ok")).limit(5).collect()
    if bad:
        raise ValueError(f"trend groups without exactly {years} years: {[tuple(r) for r in bad]}")


def assert_study(weighted: DataFrame) -> None:
    """Refuse a study whose shares, trends or scenario figures don't hold."""
    assert_complete(trend_rows(weighted))
    for what, report in (("shares", share_sum_report(weighted)), ("scenarios", scenario_reconciliation(weighted))):
        bad = report.filter(~F.col("ok")).limit(5).collect()
        if bad:
            raise ValueError(f"study gate on {what} failed: {[r.asDict() for r in bad]}")


# The names of the published output columns.
COMBINED_COLUMNS = [
    "view_type", "latest_year", "scenario", "state_abbrev", "category", "year", "rpp_level",
    "difference_from_national", "pct_change_from_national", "share_sum", "rpp", "start_year", "end_year",
    "start_rpp", "end_rpp", "rpp_change", "pct_change",
]


def combined_output(weighted: DataFrame) -> DataFrame:
    """Scenario, trend and change rows in one 17-column frame."""
    trend = trend_rows(weighted)
    sc = scenarios_frame_form(weighted).withColumn("view_type", F.lit("scenario_comparison"))
    tr = trend.withColumn("view_type", F.lit("state_trend"))
    ch = state_change_summary(trend).withColumn("view_type", F.lit("state_change_summary"))
    out = sc.unionByName(tr, allowMissingColumns=True).unionByName(ch, allowMissingColumns=True)
    last = latest_year(weighted).scalar()
    year = F.when(F.col("view_type") == "scenario_comparison", last).otherwise(F.col("year"))
    return out.withColumns({"latest_year": last, "year": year}).select(*COMBINED_COLUMNS)


def write_combined_csv(combined: DataFrame, path: str) -> None:
    """The combined output as CSV part files with a header; NULL is an empty field, an empty text is quoted."""
    combined.write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", '""').csv(path)


def read_combined_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The written rows with their types; a file with other columns, or a field of another type, is refused."""
    quoted = "\u0001"  # stands for a quoted empty text, which else reads as an empty field does
    rows = (spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST")
            .option("nullValue", "").option("emptyValue", quoted).csv(path))
    return rows.withColumns({f.name: F.when(F.col(f.name) == quoted, "").otherwise(F.col(f.name))
                             for f in schema if isinstance(f.dataType, T.StringType)})


def chart_rows(weighted: DataFrame) -> DataFrame:
    """What the charts show, a row per point: the scenarios' differences from the national level by category, and
    the target states' levels by year."""
    scenario = scenarios_frame_form(weighted).filter(F.col("scenario") != NATIONAL).select(
        F.lit("scenario_difference").alias("chart"), F.col("scenario").alias("line"), F.col("category").alias("panel"),
        F.lit(None).cast("int").alias("x"), F.col("difference_from_national").alias("y"))
    trend = trend_rows(weighted).select(
        F.lit("state_trend").alias("chart"), F.col("state_abbrev").alias("line"), F.col("category").alias("panel"),
        F.col("year").cast("int").alias("x"), F.col("rpp").alias("y"))
    return scenario.unionByName(trend)


def largest_drop(weighted: DataFrame) -> DataFrame:
    """Per non-national scenario, the category with the most negative difference."""
    s = scenarios_frame_form(weighted).filter(F.col("scenario") != NATIONAL)
    pick = F.min_by(F.struct("category", "difference_from_national", "pct_change_from_national"),
                    F.struct("difference_from_national", "category"))
    return s.groupBy("scenario").agg(pick.alias("p")).select(
        "scenario", "p.category", "p.difference_from_national", "p.pct_change_from_national")


def top_category_per_state(weighted: DataFrame) -> DataFrame:
    """Per state the category with the largest rpp change (ties: category)."""
    ch = state_change_summary(trend_rows(weighted))
    w = Window.partitionBy("state_abbrev").orderBy(F.col("rpp_change").desc_nulls_last(), F.col("category"))
    return ch.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") == 1).drop("rn")


def formatted_scenarios(weighted: DataFrame) -> DataFrame:
    """A16 + A17: display strings of the scenario table and a category slug."""
    s = scenarios_frame_form(weighted)
    return s.select(
        "category", "scenario", X.slugify(F.col("category")).alias("category_slug"),
        F.format_string("%.4f", "rpp_level").alias("rpp_level_text"),
        F.format_string("%+.4f", "difference_from_national").alias("difference_text"),
        F.format_string("%+.4f%%", "pct_change_from_national").alias("pct_change_text"),
        F.format_string("%.4f", F.col("share_sum") * F.lit(100.0)).alias("share_pct_text"),
    )


# --- S13: parameterised reads of the registered views ------------------------

LATEST_YEAR_SQL = f"SELECT max(year) AS latest_year FROM {WEIGHTED}"
LATEST_ROWS_SQL = f"""
SELECT year, state_abbrev, category, rpp, pce_share, weighted_rpp FROM {WEIGHTED} WHERE year = :year"""
TREND_SQL = f"""
SELECT state_abbrev, category, year, rpp FROM {WEIGHTED}
WHERE array_contains(:states, state_abbrev) AND year BETWEEN :last_year - (:years - 1) AND :last_year"""
LEVELS_SQL = f"""
SELECT category, :scenario AS scenario, sum(pce_share) AS share_sum,
       CASE WHEN :whole THEN sum(weighted_rpp) ELSE sum(weighted_rpp) / nullif(sum(pce_share), 0) END
         AS rpp_level
FROM {WEIGHTED} WHERE year = :year AND NOT array_contains(:excluded, state_abbrev) GROUP BY category"""


def sql_latest_year(spark: SparkSession) -> int:
    """A1 from the registered view."""
    return spark.sql(LATEST_YEAR_SQL).first().latest_year


def sql_latest_rows(spark: SparkSession, year: int) -> DataFrame:
    """A2 from the registered view."""
    return spark.sql(LATEST_ROWS_SQL, args={"year": year})


def sql_trend_rows(spark: SparkSession, last_year: int, states=L.TARGET_STATES, years: int = 5) -> DataFrame:
    """A3 from the registered view."""
    return spark.sql(TREND_SQL, args={"states": F.array(*map(F.lit, states)), "last_year": last_year, "years": years})


def sql_scenarios(spark: SparkSession, year: int) -> DataFrame:
    """A5 from the registered view: a parameterised read per scenario, each against the national level."""
    out = None
    for name in L.SCENARIO_ORDER:
        excluded = L.SCENARIO_EXCLUSIONS[name] or ("",)
        one = spark.sql(LEVELS_SQL, args={"scenario": name, "year": year, "whole": not L.SCENARIO_EXCLUSIONS[name],
                                          "excluded": F.array(*map(F.lit, excluded))})
        out = one if out is None else out.unionByName(one)
    national = out.filter(F.col("scenario") == NATIONAL).select("category", F.col("rpp_level").alias("_national"))
    ratio = X.safe_ratio(F.col("rpp_level"), F.col("_national"))
    return out.join(national, "category").select(
        "category", "scenario", "rpp_level", "share_sum",
        (F.col("rpp_level") - F.col("_national")).alias("difference_from_national"),
        ((ratio - F.lit(1)) * F.lit(100.0)).alias("pct_change_from_national"))
