"""Census payload shaping: header matrices to rows, routing by year, coverage.

A matrix document has one request's answer: a header row and data rows.  There
is one per dataset and year (or one for all years), so work is parallel over
documents, and over rows once they are exploded.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from econ_lake.functions import exprs as X
from econ_lake.sources.bronze import header_matrix_records, missing_headers

FIRST_SURVEY_YEAR = 2005
EARLIEST_YEAR = 1900


def requested_years(spark: SparkSession, start: int, current: int | None = None) -> DataFrame:
    """I8: the years from ``start`` to the current one."""
    current = current or date.today().year
    if not EARLIEST_YEAR <= start <= current:
        raise ValueError(f"start year {start} is outside {EARLIEST_YEAR}..{current}")
    return spark.range(start, current + 1).select(F.col("id").cast("int").alias("year"))


def header_report(documents: DataFrame, required: list[str]) -> DataFrame:
    """Per document the required headers that it lacks (documents without data rows aren't judged)."""
    missing = F.when(F.size("matrix") >= 2, missing_headers(F.col("matrix"), required)).otherwise(
        F.array().cast("array<string>"))
    return documents.select(*[c for c in documents.columns if c != "matrix"], missing.alias("missing")).withColumn(
        "ok", F.size("missing") == 0)


def _rows(documents: DataFrame, wanted: dict[str, str], constant: dict | None = None) -> DataFrame:
    others = [c for c in documents.columns if c != "matrix"]
    return documents.select(*others, F.explode(header_matrix_records(F.col("matrix"), wanted, constant)).alias("row"))


def survey_rows(documents: DataFrame, variable: str) -> DataFrame:
    """Rows of annual survey matrices (year, matrix); YEAR is the document's."""
    return _rows(documents, {"NAME": "NAME", variable: variable, "state": "state"},
                 {"YEAR": F.col("year").cast("string")})


def intercensal_rows(documents: DataFrame, variable: str, years: DataFrame) -> DataFrame:
    """July 1 estimates of the requested years, in the survey's layout.

    The description's case doesn't matter; the count goes under the configured variable.
    """
    rows = _rows(documents, {"GEONAME": "NAME", "POP": variable, "state": "state", "DATE_DESC": "DATE_DESC"})
    told = F.lower(X.strip(F.col("row")["DATE_DESC"]))
    year = F.regexp_extract(told, r"(\d{4})\s+population", 1)
    rows = rows.filter(told.startswith("7/1/") & (year != "")).withColumn("year", year.try_cast("int"))
    rows = rows.join(years.select("year"), "year", "left_semi")
    return rows.withColumn("row", F.map_concat(
        F.map_filter("row", lambda k, _: k != "DATE_DESC"), F.create_map(F.lit("YEAR"), F.col("year").cast("string"))))


def timeseries_rows(documents: DataFrame, variable: str) -> DataFrame:
    """YEAR = the first four digits of ``time``; rows without them go."""
    rows = _rows(documents, {"NAME": "NAME", variable: variable, "state": "state", "time": "time"})
    year = F.regexp_extract(F.coalesce(X.strip(F.col("row")["time"]), F.lit("")), r"(\d{4})", 1)
    return rows.withColumn("year", year.try_cast("int")).filter(F.col("year").isNotNull()).withColumn(
        "row", F.map_concat(F.map_filter("row", lambda k, _: k != "time"),
                            F.create_map(F.lit("YEAR"), F.col("year").cast("string"))))


def routed_population(survey: DataFrame, intercensal: DataFrame, variable: str, years: DataFrame,
                      first_survey_year: int = FIRST_SURVEY_YEAR) -> DataFrame:
    """Requested years from ``first_survey_year`` on come from the survey, earlier ones from intercensal rows."""
    new = survey_rows(survey.join(years.filter(F.col("year") >= first_survey_year), "year", "left_semi"), variable)
    old = intercensal_rows(intercensal, variable, years.filter(F.col("year") < first_survey_year))
    return new.select("year", "row").unionByName(old.select("year", "row"))


def year_coverage(rows: DataFrame, years: DataFrame) -> DataFrame:
    """The number of rows of each requested year; 0 where a year has none."""
    return years.join(rows.groupBy("year").agg(F.count(F.lit(1)).alias("n")), "year", "left").select(
        "year", F.coalesce("n", F.lit(0)).alias("row_count")).withColumn("covered", F.col("row_count") > 0)
