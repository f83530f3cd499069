"""End-to-end plan builders: table directory -> each layer.

Every function takes ``(spark, sf_dir)`` and returns a DataFrame whose
lineage starts at the given parquet tables, so the work grows with them.
What several later plans read is stored once per job in the shared folder: the
cells of the base tables, the conformed rows, the wide table (X4) and the
weighted view.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from econ_lake.operators import gold, silver, warehouse
from econ_lake.operators import serving as V
from econ_lake.operators.tables import Tables
from econ_lake.session import materialise
from econ_lake.sources import bridge
from econ_lake.sources.catalog import catalog_frame


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw payload rows derived from the base tables, stored: presence, Silver of both kinds and the gates read them."""
    return materialise(bridge.raw_rows(spark, sf_dir), "raw")


def catalog(spark: SparkSession) -> DataFrame:
    return catalog_frame(spark)


def bea_silver(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    rows = raw(spark, sf_dir) if rows is None else rows
    rows = rows.filter(rows.source == "bea")
    return silver.bea_silver(rows, catalog(spark), materialise(silver.field_presence(rows), "presence"))


def census_silver(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    rows = raw(spark, sf_dir) if rows is None else rows
    return silver.census_silver(rows.filter(rows.source == "census"), catalog(spark))


def conformed_plan(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """Conformed observations of every dataset and vintage."""
    rows = raw(spark, sf_dir) if rows is None else rows
    return gold.conformed_observations(bea_silver(spark, sf_dir, rows), census_silver(spark, sf_dir, rows))


def conformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conformed observations, stored once.

    Everything above this layer is bounded by states x periods x series x
    vintages, not by the size of the base tables, and is read by many
    downstream plans.
    """
    return materialise(conformed_plan(spark, sf_dir), "conformed")


def star(spark: SparkSession, sf_dir: str) -> warehouse.Star:
    return warehouse.build_star(conformed(spark, sf_dir))


def obt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.materialise_wide_table(star(spark, sf_dir))


def weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise(V.weighted_view(obt(spark, sf_dir)), "weighted")


def load_star(spark: SparkSession, sf_dir: str, root: str, loaded_at: str) -> None:
    """Upserts this run's rows into the star stored at ``root``."""
    warehouse.load(Tables(spark, root), conformed_plan(spark, sf_dir), loaded_at)
