"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator group of the inventory, plus the matching oracle SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from econ_lake.functions import exprs as X
from econ_lake.operators import gold, silver
from econ_lake.operators import serving as V
from econ_lake.plans import lake
from econ_lake.plans import oracle as O
from econ_lake.operators.silver import BEA_SILVER_COLUMNS, LINEAGE
from econ_lake.session import materialise, materialise_counted, scratch_path
from econ_lake.sources import layers

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def tidy(df: DataFrame, **places: int) -> DataFrame:
    """The last step of a query: sums of doubles differ in the last digits with the order of their rows, so such
    columns are rounded here, after every gate has seen them in full."""
    return df.withColumns({c: F.round(c, n) for c, n in places.items() if c in df.columns})


LEVELS = {"rpp_level": 6, "difference_from_national": 6, "pct_change_from_national": 6, "share_sum": 10}


# --- Silver / Gold -----------------------------------------------------------

@register("silver_bea", "WITH " + O.CONFORMED_CTES + """
SELECT dataset_id, vintage_tag, run_id, load_seq, state_fips, state_abbrev, geo_name, frequency, period_code,
       year, month, quarter, bea_table_name, line_code, series_code, series_name, function_name, raw_description,
       hierarchy_path_json, pce_value AS value, unit, unit_mult, note_ref
FROM bea_conf""")
def q_silver_bea(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed BEA Silver rows of every dataset and vintage."""
    return lake.bea_silver(spark, sf_dir).select(*LINEAGE, *BEA_SILVER_COLUMNS)


@register("silver_census", "WITH " + O.CONFORMED_CTES + """
SELECT c.dataset_id, c.vintage_tag, c.run_id, c.load_seq, c.state_fips, c.state_abbrev, c.geo_name,
       c.frequency, c.period_code, c.year,
       CASE WHEN c.unit_mult = 0 THEN c.pce_value END AS population,
       CASE WHEN c.unit_mult = 3 THEN c.pce_value END AS amount,
       CASE WHEN c.unit_mult = 3 THEN 'timeseries/govs' ELSE 'acs/acs1' END AS census_dataset_path,
       c.line_code AS census_variable,
       CASE WHEN c.unit_mult = 3 THEN 'state_gov_finance' ELSE 'population' END AS census_series_kind,
       c.series_name AS census_measure_label,
       CASE WHEN c.unit_mult = 3 THEN 'SF0004' ELSE '' END AS census_agg_desc,
       c.unit, c.note_ref
FROM census_conf c""")
def q_silver_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed Census Silver rows (population and finance shapes)."""
    return lake.census_silver(spark, sf_dir)


@register("conformed", "WITH " + O.CONFORMED_CTES + f" SELECT {O.CONFORMED_COLUMNS} FROM conformed")
def q_conformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conformed observations of every dataset in one frame."""
    return lake.conformed_plan(spark, sf_dir)


# --- Serving views -----------------------------------------------------------

@register("obt_annual_latest", "WITH " + O.OBT_CTES + " SELECT * FROM obt")
def q_obt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1 (+ W1-W7, W10, W13): latest annual wide table read from the star."""
    return lake.obt(spark, sf_dir)


@register("weighted_rpp", "WITH " + O.WEIGHTED_CTES + """
SELECT * REPLACE (round(pce_share, 12) AS pce_share, round(weighted_rpp, 8) AS weighted_rpp) FROM wview""")
def q_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2-V7: share-weighted price view (flagship)."""
    return tidy(lake.weighted(spark, sf_dir), pce_share=12, weighted_rpp=8)


@register("yoy", O.YOY_SQL)
def q_yoy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V8 (self-join form): exact year-over-year change."""
    return V.yoy_view(lake.obt(spark, sf_dir))


@register("yoy_window", O.YOY_SQL)
def q_yoy_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V8 (range-frame form): same result with one exchange."""
    return V.yoy_view_window(lake.obt(spark, sf_dir))


@register("per_capita", O.per_capita_sql(True))
def q_per_capita(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V9: per-capita values over the population dataset (T-14 fix)."""
    return V.per_capita_view(lake.obt(spark, sf_dir))


@register("per_capita_all_census", O.per_capita_sql(False))
def q_per_capita_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V9 with the original join to every Census row (fan-out kept)."""
    return V.per_capita_view(lake.obt(spark, sf_dir), population_dataset_id=None)


@register("federal_to_stategov_gdp", O.ratio_sql(
    "source_name = 'CENSUS' AND dataset_id = 'census_state_gov_finance_federal_intergovernmental_revenue'",
    "federal_stategov_receipts_dollars", "federal_stategov_to_gdp_ratio", "federal_stategov_vintage_tag"))
def q_fed_stategov(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Federal-to-state-government receipts over GDP."""
    return V.federal_to_stategov_gdp(lake.obt(spark, sf_dir))


@register("federal_to_persons_gdp", O.ratio_sql(
    "source_name = 'BEA' AND dataset_id = 'state_personal_transfer_receipts_sainc35' AND line_code = '2000'",
    "federal_to_persons_receipts_dollars", "federal_to_persons_to_gdp_ratio", "federal_to_persons_vintage_tag"))
def q_fed_persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Federal-to-persons receipts over GDP."""
    return V.federal_to_persons_gdp(lake.obt(spark, sf_dir))


@register("subset_level_without_ca", O.SUBSET_LEVEL_SQL)
def q_subset_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Re-normalised level of a subset of states (all but CA), per year and category."""
    return tidy(V.subset_level(lake.weighted(spark, sf_dir), keep=F.col("state_abbrev") != "CA"), **LEVELS)


# --- Study -------------------------------------------------------------------
from econ_lake.operators import analysis as A  # noqa: E402

_S = "WITH " + O.STUDY_CTES


@register("latest_year", _S + " SELECT latest_year FROM latest")
def q_latest_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: latest year of the weighted view."""
    return A.latest_year(lake.weighted(spark, sf_dir))


@register("latest_year_rows", _S + """
SELECT * REPLACE (round(pce_share, 12) AS pce_share, round(weighted_rpp, 8) AS weighted_rpp) FROM lrows""")
def q_latest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: latest-year slice."""
    return tidy(A.latest_year_rows(lake.weighted(spark, sf_dir)), pce_share=12, weighted_rpp=8)


@register("state_trend_rows", _S + " SELECT * FROM trend")
def q_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: five-year trend rows of the target states."""
    return A.trend_rows(lake.weighted(spark, sf_dir))


@register("share_sums", _S + " SELECT year, category, round(sum(pce_share), 10) AS share_sum "
          "FROM wview GROUP BY year, category")
def q_share_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: share sum per (year, category)."""
    return tidy(A.share_sums(lake.weighted(spark, sf_dir)), **LEVELS)


@register("share_sum_gate", _S + """ SELECT year, category, round(share_sum, 10) AS share_sum,
  coalesce(abs(share_sum - 1.0) <= 1e-8, false) AS ok
  FROM (SELECT year, category, sum(pce_share) AS share_sum FROM wview GROUP BY year, category)""")
def q_share_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share-sum gate report (ok = within 1e-8 of one)."""
    return tidy(A.share_sum_report(lake.weighted(spark, sf_dir)), **LEVELS)


@register("share_sum_gate_drift", _S + """ SELECT year, category, round(share_sum, 10) AS share_sum,
  coalesce(abs(share_sum - 1.0) <= 1e-8, false) AS ok
  FROM (SELECT year, category, sum(CASE WHEN category = 'Goods' THEN pce_share * CAST(1.0000000149 AS DOUBLE)
                                        ELSE pce_share END) AS share_sum FROM wview GROUP BY year, category)""")
def q_share_gate_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11 where it must fail: the shares of one category are off by 1.49e-8, just beyond the tolerance."""
    drifted = lake.weighted(spark, sf_dir).withColumn("pce_share", F.when(
        F.col("category") == "Goods", F.col("pce_share") * F.lit(1.0000000149)).otherwise(F.col("pce_share")))
    return tidy(A.share_sum_report(drifted), **LEVELS)


@register("scenarios_sql_form", _S + O.FRAME_ROUNDED + ", category_rank, scenario_rank FROM sql_form")
def q_scen_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exclusion scenarios (ratio-minus-one percent), with display ranks."""
    return tidy(A.scenarios_sql_form(lake.weighted(spark, sf_dir)), **LEVELS)


@register("scenarios_frame_form", _S + O.FRAME_ROUNDED + " FROM frame_form")
def q_scen_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exclusion scenarios (difference-over-national percent)."""
    return tidy(A.scenarios_frame_form(lake.weighted(spark, sf_dir)), **LEVELS)


@register("scenario_reconciliation", _S + f""" SELECT column_name, round(max_delta, 6) AS max_delta, unmatched,
  coalesce(max_delta, 0.0) <= 1e-4 AND unmatched = 0 AS ok FROM (
  {" UNION ALL ".join(f"SELECT '{c}' AS column_name, max(abs(a.{c} - b.{c})) AS max_delta, "
                      f"count(*) FILTER (WHERE a.scenario IS NULL OR b.scenario IS NULL "
                      f"OR (a.{c} IS NULL) <> (b.{c} IS NULL)) AS unmatched FROM frame_form a "
                      f"FULL OUTER JOIN sql_form b ON a.category = b.category AND a.scenario = b.scenario"
                      for c in ("rpp_level", "difference_from_national", "pct_change_from_national", "share_sum"))})""")
def q_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scenario table and the levels of each scenario's states on their own agree within 1e-4."""
    return tidy(A.scenario_reconciliation(lake.weighted(spark, sf_dir)), max_delta=6)


@register("completeness_gate", _S + """ SELECT state_abbrev, category, count(DISTINCT year) AS distinct_years,
  count(DISTINCT year) = 5 AS ok FROM trend GROUP BY state_abbrev, category""")
def q_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exactly five distinct years per (state, category)."""
    return A.completeness_report(A.trend_rows(lake.weighted(spark, sf_dir)))


@register("state_change_summary", _S + " SELECT * FROM change")
def q_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: first/last change per (state, category)."""
    return A.state_change_summary(A.trend_rows(lake.weighted(spark, sf_dir)))


@register("combined_output", _S + f"""
SELECT 'scenario_comparison' AS view_type, (SELECT latest_year FROM latest) AS latest_year, scenario,
       NULL AS state_abbrev, category, (SELECT latest_year FROM latest) AS year, rpp_level,
       difference_from_national, pct_change_from_national, share_sum, NULL AS rpp, NULL AS start_year,
       NULL AS end_year, NULL AS start_rpp, NULL AS end_rpp, NULL AS rpp_change, NULL AS pct_change
FROM ({O.FRAME_ROUNDED} FROM frame_form)
UNION ALL
SELECT 'state_trend', (SELECT latest_year FROM latest), NULL, state_abbrev, category, year, NULL, NULL, NULL,
       NULL, rpp, NULL, NULL, NULL, NULL, NULL, NULL FROM trend
UNION ALL
SELECT 'state_change_summary', (SELECT latest_year FROM latest), NULL, state_abbrev, category, NULL, NULL, NULL,
       NULL, NULL, NULL, start_year, end_year, start_rpp, end_rpp, rpp_change, pct_change FROM change""")
def q_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A13 (+A18 chart data): heterogeneous union of scenario, trend and change rows."""
    return tidy(A.combined_output(lake.weighted(spark, sf_dir)), **LEVELS)


@register("largest_drop", _S + """ SELECT scenario, arg_min(category, (difference_from_national, category))
  AS category, round(min(difference_from_national), 6) AS difference_from_national,
  round(arg_min(pct_change_from_national, (difference_from_national, category)), 6) AS pct_change_from_national
  FROM frame_form WHERE scenario <> 'National' GROUP BY scenario""")
def q_largest_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Largest drop per exclusion scenario."""
    return tidy(A.largest_drop(lake.weighted(spark, sf_dir)), **LEVELS)


@register("top_category_per_state", _S + """ SELECT state_abbrev, category, start_year, end_year, start_rpp,
  end_rpp, rpp_change, pct_change, complete FROM (SELECT *, row_number() OVER (PARTITION BY state_abbrev
  ORDER BY rpp_change DESC NULLS LAST, category) AS rn FROM change) WHERE rn = 1""")
def q_top_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top category per state by change."""
    return A.top_category_per_state(lake.weighted(spark, sf_dir))


@register("formatted_scenarios", _S + """ SELECT category, scenario,
  regexp_replace(regexp_replace(lower(category), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS category_slug,
  printf('%.4f', rpp_level) AS rpp_level_text, printf('%+.4f', difference_from_national) AS difference_text,
  printf('%+.4f%%', pct_change_from_national) AS pct_change_text,
  printf('%.4f', share_sum * CAST(100.0 AS DOUBLE)) AS share_pct_text FROM frame_form""")
def q_formatted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formatted scenario table and category slugs."""
    return A.formatted_scenarios(lake.weighted(spark, sf_dir))


# --- Star schema ---------------------------------------------------------------
from econ_lake.operators import warehouse as W  # noqa: E402

_SRC = ["source_name", "dataset_id", "table_name"]


def _star(spark: SparkSession, sf_dir: str) -> W.Star:
    return lake.star(spark, sf_dir)


@register("dim_source", "WITH " + O.CONFORMED_CTES + """
SELECT source_name, dataset_id, bea_table_name AS table_name, min(load_seq) AS first_load_seq,
       max(load_seq) AS last_load_seq FROM conformed GROUP BY source_name, dataset_id, bea_table_name""")
def q_dim_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source dimension (one row per source, load range)."""
    return _star(spark, sf_dir).dim_source.drop("source_id")


@register("dim_vintage", "WITH " + O.OBT_CTES + """
SELECT c.source_name, c.dataset_id, c.bea_table_name AS table_name, c.vintage_tag,
       CAST(NULL AS VARCHAR) AS release_tag, c.vintage_tag = lv.vintage_tag AS is_latest,
       max(c.load_seq) AS last_load_seq
FROM conformed c JOIN latest_vintage lv USING (source_name, dataset_id, bea_table_name)
GROUP BY c.source_name, c.dataset_id, c.bea_table_name, c.vintage_tag, lv.vintage_tag""")
def q_dim_vintage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2, W3 (T-18): vintages with the last-loaded one marked latest."""
    st = _star(spark, sf_dir)
    return st.dim_vintage.join(st.dim_source.select("source_id", *_SRC), "source_id").select(
        *_SRC, "vintage_tag", "release_tag", "is_latest", "last_load_seq")


@register("dim_geo", "WITH " + O.OBT_CTES + """
SELECT 'state' AS geo_level, 'US' AS country_code, state_fips, state_abbrev, geo_name FROM geo_last""")
def q_dim_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W4 (T-17): geography dimension, last distinct attributes win."""
    return _star(spark, sf_dir).dim_geo.drop("geo_id")


@register("dim_period", "WITH " + O.CONFORMED_CTES + """
SELECT frequency, period_code,
       CASE WHEN frequency = 'A' THEN make_date(yr, 1, 1) ELSE make_date(yr, mo, 1) END AS period_start_date,
       CASE WHEN frequency = 'A' THEN make_date(yr, 12, 31) ELSE last_day(make_date(yr, mo, 1)) END
         AS period_end_date,
       yr AS year, CAST(NULL AS INTEGER) AS quarter, CASE WHEN frequency = 'M' THEN mo END AS month,
       true AS is_period_end
FROM (SELECT frequency, period_code, arg_max(year, load_seq) AS yr,
             arg_min(month, load_seq) FILTER (WHERE month IS NOT NULL) AS mo
      FROM conformed GROUP BY frequency, period_code)""")
def q_dim_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Period dimension with calendar bounds."""
    return _star(spark, sf_dir).dim_period.drop("period_id")


@register("dim_series", "WITH " + O.OBT_CTES + """
SELECT source_name, dataset_id, table_name, series_code, s_table AS bea_table_name, line_code, series_name,
       function_name, raw_description, hierarchy_path_json, unit, unit_mult, 'colon_path' AS parse_strategy
FROM series_last""")
def q_dim_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series dimension, last distinct attributes win."""
    st = _star(spark, sf_dir)
    return st.dim_series.join(st.dim_source.select("source_id", *_SRC), "source_id").drop("source_id", "series_id")


_NODES_CTES = "WITH " + O.OBT_CTES + """,
paths AS (
  SELECT source_name, dataset_id, table_name, series_code, s_table,
         coalesce(nullif(list_filter(list_transform(try_cast(hierarchy_path_json AS VARCHAR[]),
                  lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> ''), []),
                  CASE WHEN trim(function_name) <> '' THEN [trim(function_name)]
                       WHEN trim(series_name) <> '' THEN [trim(series_name)]
                       WHEN trim(line_code) <> '' THEN [trim(line_code)] ELSE [] END) AS path
  FROM series_last
),
expl AS (
  SELECT source_name, dataset_id, table_name, series_code, s_table, path, i,
         array_to_string(path[1:i], '||') AS node_key, path[i] AS node_label,
         CASE WHEN i > 1 THEN array_to_string(path[1:i - 1], '||') END AS parent_node_key,
         i = len(path) AS is_leaf
  FROM paths, range(1, len(path) + 1) AS t(i)
)"""


@register("dim_series_node", _NODES_CTES + """
SELECT DISTINCT source_name, dataset_id, table_name, s_table AS bea_table_name, node_key, node_label,
       CAST(i AS INTEGER) AS node_level, parent_node_key FROM expl""")
def q_dim_series_node(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One node per label-path prefix, with its parent."""
    st = _star(spark, sf_dir)
    return st.dim_series_node.join(st.dim_source.select("source_id", *_SRC), "source_id").select(
        *_SRC, "bea_table_name", "node_key", "node_label", "node_level", "parent_node_key")


@register("bridge_series_node", _NODES_CTES + """
SELECT source_name, dataset_id, table_name, series_code, node_key, CAST(i AS INTEGER) AS path_ordinal, is_leaf
FROM expl""")
def q_bridge_series_node(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series-to-node bridge, one leaf per series."""
    st = _star(spark, sf_dir)
    ser = st.dim_series.select("series_id", "source_id", "series_code")
    return st.bridge_series_node.join(ser, "series_id").join(
        st.dim_source.select("source_id", *_SRC), "source_id").select(
        *_SRC, "series_code", "node_key", "path_ordinal", "is_leaf")


@register("fact_observation", "WITH " + O.OBT_CTES + """
SELECT source_name, dataset_id, bea_table_name AS table_name, series_code, state_fips, frequency, period_code,
       vintage_tag, pce_value AS value_numeric, pce_value_scaled AS value_scaled, note_ref, run_id
FROM fact_last""")
def q_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact rows after replaying every load (last load per key wins)."""
    st = _star(spark, sf_dir)
    return (
        st.fact.join(st.dim_source.select("source_id", *_SRC), "source_id")
        .join(st.dim_series.select("series_id", "series_code"), "series_id")
        .join(st.dim_geo.select("geo_id", "state_fips"), "geo_id")
        .join(st.dim_period.select("period_id", "frequency", "period_code"), "period_id")
        .join(st.dim_vintage.select("vintage_id", "vintage_tag"), "vintage_id")
        .select(*_SRC, "series_code", "state_fips", "frequency", "period_code", "vintage_tag",
                "value_numeric", "value_scaled", "note_ref", "run_id")
    )


_TABLES = ["dim_source", "dim_vintage", "dim_geo", "dim_period", "dim_series", "dim_series_node",
           "bridge_series_node", "fact"]


@register("star_key_report", "SELECT * FROM " + O._values([(t, 0) for t in _TABLES], "v(table_name, bad_count)"))
def q_key_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Surrogate-id and key uniqueness per star table (bad_count 0 = ok)."""
    return W.key_uniqueness_report(_star(spark, sf_dir))


# --- Bronze-side operators -------------------------------------------------------
from econ_lake.sources import bronze as BZ  # noqa: E402
from econ_lake.sources.catalog import DEFAULT_DATASETS  # noqa: E402
from econ_lake.sources import bridge as B  # noqa: E402

_REQ = O._values([(d["dataset_id"], d.get("bea_frequency", "A")) for d in DEFAULT_DATASETS if d.get("source", "bea") == "bea"],
                 "rq(dataset_id, requested_frequency)")


@register("frequency_gate", "WITH " + O.CONFORMED_CTES + f""",
obs AS (SELECT dataset_id, freq FROM bea_cells
        UNION ALL SELECT 'pce_state_sapce4_monthly', 'Q' FROM spend_m WHERE tbl = 'SAPCE4' AND line = '19')
SELECT o.dataset_id, 'run-' || v.vintage_tag || '-' || o.dataset_id AS run_id,
       array_to_string(list_sort(list_distinct(list(o.freq))), ',') AS observed_frequencies,
       rq.requested_frequency,
       rq.requested_frequency NOT IN ('A', 'M')
         OR list_contains(list_distinct(list(o.freq)), rq.requested_frequency) AS ok
FROM obs o JOIN {_REQ} ON rq.dataset_id = o.dataset_id
JOIN {O._VINT} ON TRUE
GROUP BY o.dataset_id, v.vintage_tag, rq.requested_frequency""")
def q_frequency_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observed period frequencies per payload and the requested-frequency gate."""
    landed = lake.raw(spark, sf_dir)
    g = BZ.frequency_gate(landed.filter(landed.source == "bea"), lake.catalog(spark))
    return g.select("dataset_id", "run_id", F.array_join("observed_frequencies", ",").alias("observed_frequencies"),
                    "requested_frequency", "ok")


@register("payload_change_flags", "WITH " + O.CONFORMED_CTES + f""",
ds AS (SELECT DISTINCT dataset_id FROM conformed),
diff AS (
  SELECT dataset_id, bool_or(prelim <> final) AS differs FROM bea_cells GROUP BY dataset_id
  UNION ALL SELECT DISTINCT dataset_id, false FROM census_cells
)
SELECT dataset_id, 'run-{B.VINTAGES[0]}-' || dataset_id AS run_id, true AS changed FROM ds
UNION ALL
SELECT dataset_id, 'run-{B.VINTAGES[1]}-' || dataset_id, differs FROM diff""")
def q_change_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I15-I17 (+S10): order-insensitive payload hash per run, each run compared
    with the previous run of its dataset (first run: changed)."""
    landed = lake.raw(spark, sf_dir)
    h = BZ.row_set_hash(landed, ["dataset_id", "run_id", "load_seq"])
    return BZ.successive_change_flags(h).select("dataset_id", "run_id", "changed")


@register("payload_hashes", "WITH " + O.RAW_COUNT_CTES + f"""
SELECT c.dataset_id, c.run_id, c.row_count, c.vintage_tag = '{B.VINTAGES[0]}' OR d.differs AS new_content
FROM raw_counts c JOIN changed_sets d ON d.dataset_id = c.dataset_id""")
def q_payload_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content hash per payload: its row count, and whether an earlier run of the dataset had the same hash
    (the digest itself is engine-specific)."""
    h = BZ.row_set_hash(lake.raw(spark, sf_dir), ["dataset_id", "run_id", "load_seq"])
    first = h.groupBy("dataset_id", "payload_hash").agg(F.min("load_seq").alias("first_seq"))
    return h.join(first, ["dataset_id", "payload_hash"]).select(
        "dataset_id", "run_id", F.col("n").alias("row_count"),
        (F.col("load_seq") == F.col("first_seq")).alias("new_content"))


@register("line_dictionary", """
SELECT 'orders_' || year(o_orderdate) AS dataset_id, substr(o_orderpriority, 1, 1) AS line_key,
       max(o_orderpriority) AS description
FROM orders GROUP BY 1, 2""")
def q_line_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line dictionaries from ParamValue arrays, one document per order year, with blank keys and padding."""
    o = lake.bridge._read(spark, sf_dir, "orders")
    each = o.select(F.concat(F.lit("orders_"), F.year("o_orderdate").cast("string")).alias("dataset_id"),
                    "o_orderpriority").distinct()
    pv = each.groupBy("dataset_id").agg(F.array_sort(F.collect_list(F.struct(
        F.concat(F.lit(" "), F.substring("o_orderpriority", 1, 1)).alias("Key"),
        F.concat(F.col("o_orderpriority"), F.lit("  ")).alias("Desc")))).alias("pv"))  # five priorities
    blank = F.array(F.struct(F.lit("  ").alias("Key"), F.lit("no line").alias("Desc")))
    return BZ.line_dictionary(pv.select("dataset_id", F.concat(blank, "pv").alias("param_value")))


@register("line_labels", "WITH " + O.CONFORMED_CTES + f""",
prio AS (SELECT substr(o_orderpriority, 1, 1) AS line, max(o_orderpriority) AS label FROM orders
         WHERE substr(o_orderpriority, 1, 1) <> '5' GROUP BY 1)
SELECT b.dataset_id, v.vintage_tag, count(*) AS row_count, count(p.label) AS labelled,
       count(DISTINCT coalesce(p.label, '')) AS labels
FROM (SELECT dataset_id, line FROM bea_cells JOIN nation ON n_nationkey = nk
      UNION ALL SELECT 'pce_state_sapce1', line FROM (SELECT DISTINCT yr, line FROM spend_a WHERE tbl = 'SAPCE1'), range(2)
      UNION ALL SELECT 'pce_state_sapce4_monthly', '19'
      FROM (SELECT DISTINCT nk, yr, (mo + 2) // 3 FROM spend_m WHERE tbl = 'SAPCE4' AND line = '19')) b
JOIN {O._VINT} ON TRUE LEFT JOIN prio p ON p.line = b.line GROUP BY b.dataset_id, v.vintage_tag""")
def q_line_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label of each row's line overwrites FunctionName; a line without one gets ''."""
    rows = lake.raw(spark, sf_dir).filter(F.col("source") == "bea")
    lines = lake.bridge._read(spark, sf_dir, "orders").select("o_orderpriority").distinct().select(
        F.substring("o_orderpriority", 1, 1).alias("line_key"), F.col("o_orderpriority").alias("description")).filter(
        "line_key <> '5'")
    got = BZ.attach_line_labels(rows, rows.select("dataset_id").distinct().join(F.broadcast(lines)))  # five lines
    label = F.col("row")["FunctionName"]
    return got.groupBy("dataset_id", "vintage_tag").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(label != "").alias("labelled"),
        F.count_distinct(label).alias("labels"))


# --- Census shaping ------------------------------------------------------------------
from econ_lake.sources import census as C  # noqa: E402

_VARIABLE = "B01003_001E"
#: The years that the base tables have lie on either side of this one.
_FIRST_SURVEY_YEAR = 1996


def _matrices(spark: SparkSession, sf_dir: str, header: list[str], record) -> DataFrame:
    """A matrix document per order year: the nations' customer counts below a header row."""
    counts = lake.bridge.order_cells(lake.bridge.cells(spark, sf_dir)).select("nationkey", "year", "customers")
    rows = counts.join(lake.bridge._nations(spark, sf_dir), "nationkey")
    body = rows.groupBy("year").agg(F.sort_array(F.collect_list(F.array(*[c.cast("string") for c in record]))
                                                 ).alias("body"))  # a row per nation
    return body.select("year", F.concat(F.array(F.array(*[F.lit(h) for h in header])), "body").alias("matrix"))


def _survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survey answers with a repeated header; the second ``state`` column is the padded code."""
    key = F.col("nationkey") + 1
    return _matrices(spark, sf_dir, ["NAME", "state", _VARIABLE, "state"],
                     [F.col("n_name"), key, F.col("customers"), F.lpad(key.cast("string"), 2, "0")])


def _intercensal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intercensal answers: July estimates in mixed case for even nations, April ones for odd nations too."""
    told = F.when(F.col("nationkey") % 2 == 0, F.concat(F.lit("7/1/"), "year", F.lit(" POPULATION Estimate: "), "year",
                                                        F.lit(" Population"))).otherwise(
        F.concat(F.lit("4/1/"), "year", F.lit(" population estimate")))
    return _matrices(spark, sf_dir, ["GEONAME", "POP", "DATE_DESC", "state"],
                     [F.col("n_name"), F.col("customers"), told, F.lpad((F.col("nationkey") + 1).cast("string"), 2, "0")])


def _census_columns(rows: DataFrame) -> DataFrame:
    r = F.col("row")
    return rows.select(r["NAME"].alias("NAME"), r[_VARIABLE].alias("value"), r["state"].alias("state"),
                       r["YEAR"].alias("YEAR"))


_CENSUS_ROW = """n.n_name AS "NAME", CAST(a.customers AS VARCHAR) AS value,
  lpad(CAST(a.nk + 1 AS VARCHAR), 2, '0') AS state, CAST(a.yr AS VARCHAR) AS "YEAR"
  FROM ord_a a JOIN nation n ON n.n_nationkey = a.nk"""


@register("header_matrix_records", "WITH " + O.CONFORMED_CTES + " SELECT " + _CENSUS_ROW)
def q_header_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header-row matrices, one per year, into records; of a repeated header the last column counts."""
    return _census_columns(C.survey_rows(_survey(spark, sf_dir), _VARIABLE))


@register("required_headers", "WITH " + O.CONFORMED_CTES + """
SELECT DISTINCT yr AS year, CASE WHEN yr % 2 = 0 THEN 'POP' ELSE '' END AS missing, yr % 2 = 1 AS ok FROM ord_a""")
def q_required_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The required headers that each document lacks; documents of even years have another name for one."""
    docs = _intercensal(spark, sf_dir)
    spoiled = docs.withColumn("matrix", F.when(F.col("year") % 2 == 0, F.transform("matrix", lambda r: F.transform(
        r, lambda x: F.when(x == "POP", "POPULATION").otherwise(x)))).otherwise(F.col("matrix")))
    return C.header_report(spoiled, ["GEONAME", "POP", "DATE_DESC", "state"]).select(
        "year", F.array_join("missing", ",").alias("missing"), "ok")


@register("intercensal_rows", "WITH " + O.CONFORMED_CTES + " SELECT " + _CENSUS_ROW
          + " WHERE a.nk % 2 = 0 AND a.yr BETWEEN 1993 AND 1996")
def q_intercensal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """July estimates of the requested years, whatever the case of their description."""
    return _census_columns(C.intercensal_rows(_intercensal(spark, sf_dir), _VARIABLE,
                                              C.requested_years(spark, 1993, 1996)))


@register("timeseries_rows", "WITH " + O.CONFORMED_CTES + " SELECT " + _CENSUS_ROW + " WHERE a.nk % 3 <> 0")
def q_timeseries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The year is read from ``time``; rows whose time has none are dropped."""
    time = F.when(F.col("nationkey") % 3 == 0, "n/a").otherwise(F.concat(F.lit(" "), "year", F.lit("-Q4")))
    docs = _matrices(spark, sf_dir, ["NAME", _VARIABLE, "time", "state"],
                     [F.col("n_name"), F.col("customers"), time, F.lpad((F.col("nationkey") + 1).cast("string"), 2, "0")])
    return _census_columns(C.timeseries_rows(docs.drop("year"), _VARIABLE))


@register("census_routing", "WITH " + O.CONFORMED_CTES + " SELECT " + _CENSUS_ROW
          + f" WHERE a.yr >= 1993 AND (a.yr >= {_FIRST_SURVEY_YEAR} OR a.nk % 2 = 0)")
def q_census_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years from the first survey year on from survey matrices, earlier ones from intercensal rows."""
    return _census_columns(C.routed_population(_survey(spark, sf_dir), _intercensal(spark, sf_dir), _VARIABLE,
                                               C.requested_years(spark, 1993, 2004), _FIRST_SURVEY_YEAR))


@register("year_coverage", "WITH " + O.CONFORMED_CTES + """
SELECT CAST(y.year AS INTEGER) AS year, count(a.nk) AS row_count, count(a.nk) > 0 AS covered
FROM range(1990, 2003) AS y(year) LEFT JOIN ord_a a ON a.yr = y.year GROUP BY y.year""")
def q_year_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of each requested year, also of those without any."""
    return C.year_coverage(C.survey_rows(_survey(spark, sf_dir), _VARIABLE), C.requested_years(spark, 1990, 2002))


# --- Landed payloads and change-driven runs -----------------------------------------
from econ_lake.operators import quality as Q  # noqa: E402
from econ_lake.operators.tables import Tables  # noqa: E402
from econ_lake.plans import run as RUN  # noqa: E402
from econ_lake.sources.landing import LandingZone, documents_of  # noqa: E402
from econ_lake.streaming import intake as IN  # noqa: E402

_AT = "2026-03-05 00:00:00"


def _landed(spark: SparkSession, sf_dir: str) -> LandingZone:
    zone = LandingZone(spark, scratch_path(spark, "landing"))
    zone.land(documents_of(lake.raw(spark, sf_dir)), _AT)
    return zone


#: Payloads that are landed: a first one, and those that differ from the one before.
_LANDS = f"""(vintage_tag = '{B.PRELIM_VINTAGE}' OR dataset_id IN (SELECT dataset_id FROM changed_sets WHERE differs))"""


@register("silver_bea_from_payloads", ORACLE["silver_bea"].replace(O.CONFORMED_CTES, O.RAW_COUNT_CTES) + " WHERE " + _LANDS)
def q_silver_bea_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BEA Silver rows from landed JSON documents, load order from the landing log."""
    zone = _landed(spark, sf_dir)
    return silver.bea_silver(zone.rows("bea"), lake.catalog(spark), zone.log()).select(*LINEAGE, *BEA_SILVER_COLUMNS)


@register("silver_census_from_payloads", ORACLE["silver_census"].replace(O.CONFORMED_CTES, O.RAW_COUNT_CTES)
          + " WHERE " + _LANDS.replace("vintage_tag", "c.vintage_tag").replace("dataset_id IN", "c.dataset_id IN"))
def q_silver_census_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Census Silver rows from landed JSON documents."""
    zone = _landed(spark, sf_dir)
    return silver.census_silver(zone.rows("census"), lake.catalog(spark))


_LOG = f"""
SELECT CASE WHEN c.dataset_id LIKE 'census%' THEN 'census' ELSE 'bea' END AS source, c.dataset_id, c.vintage_tag, c.run_id,
       c.load_seq, c.row_count, CAST(NULL AS VARCHAR) AS problem,
       c.dataset_id NOT LIKE 'census%' AND c.dataset_id <> 'state_regional_price_parities_sarpp' AS "has_NoteRef",
       c.dataset_id NOT LIKE 'census%' AS "has_FunctionName", false AS "has_LineDescription",
       c.vintage_tag = '{B.PRELIM_VINTAGE}' OR d.differs AS changed
FROM raw_counts c JOIN changed_sets d ON d.dataset_id = c.dataset_id"""


@register("landing_log", "WITH " + O.RAW_COUNT_CTES + _LOG)
def q_landing_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log row of each landed payload."""
    return _landed(spark, sf_dir).log().drop("payload_hash", "landed_at")


@register("landing_again", "WITH " + O.RAW_COUNT_CTES + f"""
SELECT dataset_id, run_id, row_count AS landed_rows, CAST(1 AS BIGINT) AS log_rows FROM raw_counts WHERE {_LANDS}""")
def q_landing_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same runs landed twice, as after a load that failed: every document and log row is there once."""
    zone = _landed(spark, sf_dir)
    log = zone.land(documents_of(lake.raw(spark, sf_dir)), _AT)
    rows = zone.rows("bea", log).unionByName(zone.rows("census", log))
    found = rows.groupBy("dataset_id", "run_id").agg(F.count(F.lit(1)).alias("landed_rows"))
    return found.join(zone.log().groupBy("dataset_id", "run_id").agg(F.count(F.lit(1)).alias("log_rows")),
                      ["dataset_id", "run_id"])


@register("datasets_to_process", "WITH " + O.RAW_COUNT_CTES + f"""
SELECT c.dataset_id, c.run_id, c.row_count, d.differs AS changed
FROM raw_counts c JOIN changed_sets d ON d.dataset_id = c.dataset_id WHERE c.vintage_tag = '{B.FINAL_VINTAGE}'""")
def q_datasets_to_process(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run against the checkpoints of the first; only changed datasets are to be processed."""
    docs = materialise(documents_of(lake.raw(spark, sf_dir)), "documents")
    zone = LandingZone(spark, scratch_path(spark, "landing"))
    zone.confirm(zone.land(docs.filter(F.col("vintage_tag") == B.PRELIM_VINTAGE), _AT))
    log = zone.land(docs.filter(F.col("vintage_tag") == B.FINAL_VINTAGE), _AT)
    return log.select("dataset_id", "run_id", "row_count", "changed")


@register("latest_snapshot_rows", "WITH " + O.RAW_COUNT_CTES + f"""
SELECT dataset_id, run_id, row_count FROM raw_counts WHERE source_is_bea AND vintage_tag = CASE
  WHEN dataset_id LIKE 'pce%' THEN '{B.FINAL_VINTAGE}' ELSE '{B.PRELIM_VINTAGE}' END""".replace(
    "source_is_bea", "dataset_id NOT LIKE 'census%'"))
def q_latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of each dataset's newest files.  The later vintage's files are newer for the spending datasets;
    for the others both are equally new, so that the first path wins."""
    rows = lake.raw(spark, sf_dir).filter(F.col("source") == "bea")
    zone = LandingZone(spark, scratch_path(spark, "landing"))
    for vintage in B.VINTAGES:  # each against no checkpoint, so that unchanged ones are landed too
        zone.land(documents_of(rows.filter(F.col("vintage_tag") == vintage)), _AT)
    path = f"{zone.root}/bea"
    fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    files = spark.read.format("binaryFile").load(path).select(
        "dataset_id", F.col("extract_date").cast("string").alias("vintage"), "path").collect()  # a few per payload
    for f in files:
        newer = f.dataset_id.startswith("pce") and f.vintage == B.FINAL_VINTAGE
        fs.setTimes(spark._jvm.org.apache.hadoop.fs.Path(f.path), 2_000_000 if newer else 1_000_000, -1)
    newest = BZ.latest_runs(spark, path).join(zone.log().select("dataset_id", "run_id", "load_seq"), ["dataset_id", "run_id"])
    return zone.rows("bea", newest).groupBy("dataset_id", "run_id").agg(F.count(F.lit(1)).alias("row_count"))


@register("streamed_silver", ORACLE["silver_bea"].replace(O.CONFORMED_CTES, O.RAW_COUNT_CTES).replace(
    "load_seq, ", "") + " WHERE " + _LANDS)
def q_streamed_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three intakes of a landing zone by a file stream: nothing new in the second, a late vintage in the third,
    and the first batch once more, as after a failure."""
    docs = materialise(documents_of(lake.raw(spark, sf_dir)), "documents")
    zone = LandingZone(spark, scratch_path(spark, "landing"))
    target, checkpoint = scratch_path(spark, "streamed"), scratch_path(spark, "stream-checkpoint")

    def take_in():
        IN.ingest_available(spark, zone.root, target, checkpoint, landed=True)

    early = zone.land(docs.filter(F.col("vintage_tag") == B.PRELIM_VINTAGE), _AT)
    take_in()
    take_in()
    IN.write_batch(zone.rows("bea", early).drop("load_seq"), 0, target)
    zone.confirm(early)
    zone.land(docs.filter(F.col("vintage_tag") == B.FINAL_VINTAGE), _AT)
    take_in()
    rows = silver.bea_silver(IN.read_bronze_rows(spark, target), lake.catalog(spark), zone.log())
    return rows.select(*[c for c in LINEAGE if c != "load_seq"], *BEA_SILVER_COLUMNS)


def _spoiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows of all vintages with a fault in the payloads of four datasets, where they have rows to spoil."""
    rows = lake.raw(spark, sf_dir)
    row, ds = F.col("row"), F.col("dataset_id")

    def with_field(name: str, value) -> "F.Column":
        return F.map_concat(F.map_filter(row, lambda k, _: k != name), F.create_map(F.lit(name), value))

    of_alaska = row["GeoFips"] == "02000"
    changed = rows.withColumn("row", F.when((ds == "pce_state_sapce1") & of_alaska, with_field("DataValue", F.lit("(NA)")))
                              .when((ds == "pce_state_sapce4_monthly") & row["TimePeriod"].contains("M"),
                                    with_field("TimePeriod", F.substring(row["TimePeriod"], 1, 4)))
                              .when(ds == "census_state_population",
                                    F.map_filter(row, lambda k, _: k != _VARIABLE)).otherwise(row))
    return changed.unionByName(rows.filter((ds == "pce_state_sapce4") & of_alaska))


#: What speaks against each spoiled dataset, if the tables have the rows that are spoiled.
_FAULTS = """faults AS (
  SELECT DISTINCT dataset_id, 'required value missing' AS reason FROM bea_cells
  WHERE dataset_id = 'pce_state_sapce1' AND nk = 1
  UNION ALL SELECT DISTINCT dataset_id, 'duplicate key' FROM bea_cells WHERE dataset_id = 'pce_state_sapce4' AND nk = 1
  UNION ALL SELECT DISTINCT dataset_id, 'no typed rows; requested frequency missing' FROM bea_cells
  WHERE dataset_id = 'pce_state_sapce4_monthly'
  UNION ALL SELECT DISTINCT dataset_id, 'required value missing; variable missing' FROM census_cells
  WHERE dataset_id = 'census_state_population'
), judged AS (
  SELECT c.*, coalesce(f.reason, '') AS reason, d.differs, c.vintage_tag = '%s' AS first,
         CASE WHEN c.dataset_id = 'pce_state_sapce4' THEN (SELECT count(*) FROM bea_cells WHERE dataset_id =
           'pce_state_sapce4' AND nk = 1) ELSE 0 END AS doubled
  FROM raw_counts c LEFT JOIN faults f ON f.dataset_id = c.dataset_id
  JOIN changed_sets d ON d.dataset_id = c.dataset_id
)""" % B.PRELIM_VINTAGE


@register("payload_gates", "WITH " + O.RAW_COUNT_CTES + f", {_FAULTS} SELECT dataset_id, run_id, reason, reason = '' AS ok FROM judged")
def q_payload_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I11, T18, T19, T26 where they must fail: a missing value, a doubled row, a lost frequency, a lost variable."""
    rows = materialise(_spoiled(spark, sf_dir), "spoiled")
    log = rows.groupBy("dataset_id", "run_id").agg(F.count(F.lit(1)).alias("row_count")).withColumn(
        "problem", F.lit(None).cast("string"))
    bea = silver.bea_silver(rows.filter(F.col("source") == "bea"), lake.catalog(spark))
    census = silver.census_silver(rows.filter(F.col("source") == "census"), lake.catalog(spark))
    return Q.payload_verdicts(log, rows, lake.catalog(spark), bea, census)


@register("run_log", "WITH " + O.RAW_COUNT_CTES + f""", {_FAULTS}
SELECT dataset_id, run_id, row_count + doubled AS row_count,
       CASE WHEN first OR differs THEN reason END AS reason,
       CASE WHEN NOT first AND NOT differs THEN 'unchanged' WHEN reason = '' THEN 'loaded' ELSE 'quarantined' END AS status
FROM judged
UNION ALL
SELECT dataset_id, run_id || '-2', row_count, CASE WHEN differs OR first AND reason <> '' THEN '' END,
       CASE WHEN differs OR first AND reason <> '' THEN 'loaded' ELSE 'unchanged' END
FROM judged""")
def q_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run with four faulty datasets, then one with the right rows: what passed the first time and
    is as it was is unchanged, what was put into quarantine is loaded."""
    root = scratch_path(spark, "runs")
    RUN.run(spark, _spoiled(spark, sf_dir), lake.catalog(spark), root, _AT, strict=False)
    again = lake.raw(spark, sf_dir).withColumns(
        {"run_id": F.concat("run_id", F.lit("-2")), "load_seq": F.col("load_seq") + 1000})
    RUN.run(spark, again, lake.catalog(spark), root, _AT)
    return Tables(spark, f"{root}/lake").read("run_log").select("dataset_id", "run_id", "row_count", "reason", "status")


@register("run_after_failed_load", "WITH " + O.OBT_CTES + " SELECT * EXCLUDE (vintage_tag) FROM obt")
def q_run_after_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that stops at a gate after landing, then the same runs again with the right rows: the star
    is that of one clean load (the tag apart, as a vintage that changes nothing isn't loaded)."""
    root = scratch_path(spark, "runs")
    try:
        RUN.run(spark, _spoiled(spark, sf_dir), lake.catalog(spark), root, _AT)
    except ValueError as refused:
        if "payload gate" not in str(refused):
            raise
    else:
        raise AssertionError("the gate let spoiled payloads pass")
    RUN.run(spark, lake.raw(spark, sf_dir), lake.catalog(spark), root, _AT)
    return V.obt_annual_latest(W.read_star(Tables(spark, f"{root}/lake"))).drop("vintage_tag")


def _bad_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All payloads as documents; of three datasets the API answered with an error, with no row, with a broken text."""
    docs = documents_of(lake.raw(spark, sf_dir))
    error = '{"BEAAPI": {"Error": {"APIErrorDescription": "Unknown table", "ErrorDetail": {"Description": "SAGDP1"}}}}'
    body = (F.when(F.col("dataset_id") == "state_gdp_sagdp1", F.lit(error))
            .when(F.col("dataset_id") == "pce_state_sapce4", F.lit('{"BEAAPI": {"Results": {"Data": []}}}'))
            .when(F.col("dataset_id") == "census_state_population", F.expr("left(body, length(body) div 2)"))
            .otherwise(F.col("body")))
    return docs.withColumn("body", body)


_BAD = """SELECT c.dataset_id, c.run_id,
       CASE WHEN b.reason IS NULL THEN row_count ELSE 0 END AS row_count,
       CASE WHEN first OR differs AND b.reason IS NULL THEN coalesce(b.reason, '') END AS reason,
       CASE WHEN NOT (first OR differs AND b.reason IS NULL) THEN 'unchanged' WHEN b.reason IS NULL THEN 'loaded'
            ELSE 'quarantined' END AS status
FROM judged c LEFT JOIN (VALUES ('state_gdp_sagdp1', 'API error: Unknown table SAGDP1'),
  ('pce_state_sapce4', 'no rows'), ('census_state_population', 'broken document')) b(dataset_id, reason)
ON b.dataset_id = c.dataset_id"""


@register("run_with_bad_payloads", "WITH " + O.RAW_COUNT_CTES + f", {_FAULTS} {_BAD}")
def q_run_bad_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API errors, payloads without rows and broken documents are refused with their reasons; the rest of
    the run is loaded."""
    root = scratch_path(spark, "runs")
    RUN.run(spark, _bad_payloads(spark, sf_dir), lake.catalog(spark), root, _AT, strict=False)
    return Tables(spark, f"{root}/lake").read("run_log").select("dataset_id", "run_id", "row_count", "reason", "status")


@register("quarantined_documents", "WITH " + O.RAW_COUNT_CTES + f""", {_FAULTS}
SELECT dataset_id, run_id, reason FROM ({_BAD}) WHERE status = 'quarantined'""")
def q_quarantined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quarantine after the same bad run was tried twice holds each refused payload once."""
    root = scratch_path(spark, "runs")
    docs = materialise(_bad_payloads(spark, sf_dir), "documents")
    for _ in range(2):
        RUN.run(spark, docs, lake.catalog(spark), root, _AT, strict=False)
    return spark.read.parquet(f"{root}/quarantine").select("dataset_id", "run_id", "reason").distinct()


@register("run_manifest", "WITH " + O.RAW_COUNT_CTES + f""", {_FAULTS},
silver AS (SELECT dataset_id, run_id, count(*) AS n FROM conformed GROUP BY dataset_id, run_id)
SELECT s.dataset_id, s.run_id, t.stage, CASE WHEN t.stage = 'landed' THEN c.row_count ELSE s.n END AS row_count
FROM judged c JOIN silver s ON s.run_id = c.run_id, (VALUES ('landed'), ('silver'), ('gold')) t(stage)
WHERE c.first OR c.differs""")
def q_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per payload and stage of a run, as observed while the stages were written."""
    root = scratch_path(spark, "runs")
    RUN.run(spark, lake.raw(spark, sf_dir), lake.catalog(spark), root, _AT)
    return Tables(spark, f"{root}/lake").read("manifest").select("dataset_id", "run_id", "stage", "row_count")


# --- Stored tables: keyed upserts and the incremental star ---------------------------------
_OBS = ["source_name", "dataset_id", "series_code", "state_fips", "frequency", "period_code", "vintage_tag"]
_OBS_SQL = ", ".join(_OBS)


def _observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake.conformed(spark, sf_dir).select(*_OBS, "year", "pce_value",
                                                F.xxhash64("dataset_id", "vintage_tag").alias("part_id"))


def _tables_of(spark: SparkSession, *loads: DataFrame) -> Tables:
    tables = Tables(spark, scratch_path(spark, "tables"))
    for rows in loads:
        tables.merge("obs", rows, [*_OBS, "part_id"], part="part_id")
    return tables


@register("upsert_same_vintage", "WITH " + O.CONFORMED_CTES + f" SELECT {_OBS_SQL}, pce_value FROM conformed")
def q_upsert_same(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same vintages loaded twice add no rows; the second values win."""
    rows = _observations(spark, sf_dir)
    tables = _tables_of(spark, rows.withColumn("pce_value", F.col("pce_value") - 1), rows)
    return tables.read("obs").select(*_OBS, "pce_value")


@register("upsert_new_vintage", "WITH " + O.CONFORMED_CTES + f" SELECT {_OBS_SQL}, pce_value FROM conformed")
def q_upsert_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new vintage is added; the partitions of the earlier one aren't rewritten."""
    rows = _observations(spark, sf_dir)
    tables = _tables_of(spark, *[rows.filter(F.col("vintage_tag") == v) for v in B.VINTAGES])
    return tables.read("obs").select(*_OBS, "pce_value")


@register("upsert_vanished_row", "WITH " + O.CONFORMED_CTES + f"""
SELECT {_OBS_SQL}, CASE WHEN year % 2 = 0 THEN pce_value + 1 ELSE pce_value END AS pce_value FROM conformed""")
def q_upsert_vanished(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a second load of the vintages no longer has stay as they were."""
    rows = _observations(spark, sf_dir)
    tables = _tables_of(spark, rows, rows.filter(F.col("year") % 2 == 0).withColumn("pce_value", F.col("pce_value") + 1))
    return tables.read("obs").select(*_OBS, "pce_value")


@register("upsert_new_column", "WITH " + O.CONFORMED_CTES + f"""
SELECT {_OBS_SQL}, pce_value, CASE WHEN vintage_tag = '{B.FINAL_VINTAGE}' THEN year END AS revised_in,
       CASE WHEN vintage_tag = '{B.FINAL_VINTAGE}' THEN 'late' ELSE 'early' END AS kind FROM conformed""")
def q_upsert_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns that a later load brings; in one read, the files of earlier rows give NULL or the default."""
    rows = _observations(spark, sf_dir)
    tables = _tables_of(spark, rows.filter(F.col("vintage_tag") == B.PRELIM_VINTAGE))
    late = rows.filter(F.col("vintage_tag") == B.FINAL_VINTAGE).withColumns(
        {"revised_in": F.col("year"), "kind": F.lit("late")})
    tables.merge("obs", late, [*_OBS, "part_id"], part="part_id", defaults={"kind": "early"})
    return tables.read("obs").select(*_OBS, "pce_value", "revised_in", "kind")


def _two_loads(spark: SparkSession, sf_dir: str) -> W.Star:
    """The star after a first load with other labels and names, and a second one with the right ones."""
    conf = lake.conformed(spark, sf_dir)
    early = conf.filter(F.col("vintage_tag") == B.PRELIM_VINTAGE).withColumns({
        "geo_name": F.concat("geo_name", F.lit(" (early)")),
        "hierarchy_path_json": F.when(F.col("series_code") == "SAPCE1-2", '["Old", "Goods"]').otherwise(
            F.col("hierarchy_path_json"))})
    tables = Tables(spark, scratch_path(spark, "star"))
    W.load(tables, early, _AT)
    W.load(tables, conf.filter(F.col("vintage_tag") == B.FINAL_VINTAGE), _AT)
    return W.read_star(tables)


@register("stored_nodes_after_two_loads", _NODES_CTES + """
SELECT DISTINCT source_name, dataset_id, table_name, node_key, node_label, CAST(i AS INTEGER) AS node_level,
       parent_node_key FROM expl
UNION ALL SELECT 'BEA', 'pce_state_sapce1', 'SAPCE1', 'Old', 'Old', 1, NULL
UNION ALL SELECT 'BEA', 'pce_state_sapce1', 'SAPCE1', 'Old||Goods', 'Goods', 2, 'Old'""")
def q_stored_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of an earlier label path stay when the path changes."""
    st = _two_loads(spark, sf_dir)
    return st.dim_series_node.join(st.dim_source.select("source_id", *_SRC), "source_id").select(
        *_SRC, "node_key", "node_label", "node_level", "parent_node_key")


@register("stored_bridge_after_two_loads", _NODES_CTES + """
SELECT source_name, dataset_id, table_name, series_code, node_key, CAST(i AS INTEGER) AS path_ordinal, is_leaf
FROM expl""")
def q_stored_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bridge of a source is rebuilt; it no longer has the earlier path."""
    st = _two_loads(spark, sf_dir)
    ser = st.dim_series.select("series_id", "series_code")
    return st.bridge_series_node.join(ser, "series_id").join(
        st.dim_source.select("source_id", *_SRC), "source_id").select(
        *_SRC, "series_code", "node_key", "path_ordinal", "is_leaf")


@register("stored_wide_after_two_loads", "WITH " + O.OBT_CTES + " SELECT * FROM obt")
def q_stored_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide table read from the stored star equals the replay of all loads."""
    return V.obt_annual_latest(_two_loads(spark, sf_dir))


@register("stored_vintages_after_two_loads", "WITH " + O.OBT_CTES + """
SELECT c.source_name, c.dataset_id, c.bea_table_name AS table_name, c.vintage_tag,
       c.vintage_tag = lv.vintage_tag AS is_latest
FROM conformed c JOIN latest_vintage lv USING (source_name, dataset_id, bea_table_name) GROUP BY ALL""")
def q_stored_vintages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second load demotes the first one's vintage."""
    st = _two_loads(spark, sf_dir)
    return st.dim_vintage.join(st.dim_source.select("source_id", *_SRC), "source_id").select(
        *_SRC, "vintage_tag", "is_latest")


@register("star_constraints", "SELECT * FROM " + O._values(
    [(t, r, 0) for t in _TABLES for r in ("unique", "not_null")]
    + [(t, f"{k} in {to}", 0) for t, k, to in W.REFERENCES], "v(table_name, rule, bad_count)"))
def q_star_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unique keys, NOT NULL columns and references of the stored star."""
    return W.constraint_report(_two_loads(spark, sf_dir))


# --- Gates and additions -------------------------------------------------------------
from econ_lake.operators import extras as XT  # noqa: E402
from econ_lake.operators import quality as Q  # noqa: E402


@register("silver_gate", "WITH " + O.CONFORMED_CTES + """
SELECT dataset_id, run_id, count(*) AS rows,
       count(*) FILTER (WHERE state_fips IS NULL OR state_abbrev IS NULL OR frequency IS NULL OR period_code IS NULL
                        OR year IS NULL OR bea_table_name IS NULL OR line_code IS NULL OR pce_value IS NULL)
         AS null_required,
       count(*) - count(DISTINCT (bea_table_name, state_fips, period_code, line_code)) AS duplicate_keys,
       count(*) > 0 AND count(*) = count(DISTINCT (bea_table_name, state_fips, period_code, line_code))
         AND count(*) FILTER (WHERE pce_value IS NULL) = 0 AS ok
FROM conformed GROUP BY dataset_id, run_id""")
def q_silver_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver gates per payload (rows, NULL required columns, duplicate keys)."""
    rows = lake.raw(spark, sf_dir)
    bea = Q.bea_silver_report(lake.bea_silver(spark, sf_dir, rows))
    cen = Q.census_silver_report(lake.census_silver(spark, sf_dir, rows))
    return bea.unionByName(cen)


@register("monthly_change", "WITH " + O.CONFORMED_CTES + f""",
m AS (SELECT *, year * 12 + month AS mi FROM conformed WHERE frequency = 'M' AND vintage_tag = '{B.FINAL_VINTAGE}')
SELECT a.source_name, a.dataset_id, a.state_fips, a.series_code, a.period_code, a.year, a.month, a.pce_value,
       p.pce_value AS value_prior_month,
       CASE WHEN p.pce_value IS NULL OR p.pce_value = 0 THEN NULL
            ELSE (a.pce_value - p.pce_value) / p.pce_value * {O.PCT} END AS mom_pct,
       CASE WHEN r.n = 12 THEN round(r.s / CAST(12.0 AS DOUBLE), 6) END AS rolling_12m_mean
FROM m a
LEFT JOIN m p ON p.source_name = a.source_name AND p.dataset_id = a.dataset_id AND p.state_fips = a.state_fips
     AND p.series_code = a.series_code AND p.mi = a.mi - 1
LEFT JOIN (SELECT a2.source_name, a2.dataset_id, a2.state_fips, a2.series_code, a2.mi,
                  sum(b2.pce_value) AS s, count(b2.pce_value) AS n
           FROM m a2 JOIN m b2 ON b2.source_name = a2.source_name AND b2.dataset_id = a2.dataset_id
                AND b2.state_fips = a2.state_fips AND b2.series_code = a2.series_code
                AND b2.mi BETWEEN a2.mi - 11 AND a2.mi
           GROUP BY ALL) r
     ON r.source_name = a.source_name AND r.dataset_id = a.dataset_id AND r.state_fips = a.state_fips
     AND r.series_code = a.series_code AND r.mi = a.mi""")
def q_monthly_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month-over-month change and 12-month rolling mean (latest vintage)."""
    return tidy(XT.monthly_change(lake.conformed(spark, sf_dir)), rolling_12m_mean=6)


@register("as_of_vintage", "WITH " + O.CONFORMED_CTES + f"""
SELECT source_name, dataset_id, bea_table_name, series_code, state_fips, frequency, period_code,
       arg_max(vintage_tag, (vintage_tag, load_seq)) AS vintage_tag,
       arg_max(pce_value, (vintage_tag, load_seq)) AS pce_value,
       arg_max(pce_value_scaled, (vintage_tag, load_seq)) AS pce_value_scaled
FROM conformed WHERE vintage_tag <= '{B.PRELIM_VINTAGE}'
GROUP BY source_name, dataset_id, bea_table_name, series_code, state_fips, frequency, period_code""")
def q_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations as known on the first vintage date."""
    return XT.as_of_vintage(lake.conformed(spark, sf_dir), B.PRELIM_VINTAGE)


@register("stage_row_counts", "WITH " + O.OBT_CTES + """
SELECT 'silver_bea' AS stage, count(*) AS row_count FROM bea_conf
UNION ALL SELECT 'silver_census', count(*) FROM census_conf
UNION ALL SELECT 'conformed', count(*) FROM conformed
UNION ALL SELECT 'fact', count(*) FROM fact_last
UNION ALL SELECT 'fact_after_same_loads_again', count(*) FROM fact_last
UNION ALL SELECT 'obt_annual_latest', count(*) FROM obt""")
def q_stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts per stage, observed while each is written, and of the stored fact after every load was run
    a second time."""
    rows = lake.raw(spark, sf_dir)
    bea, n_bea = materialise_counted(lake.bea_silver(spark, sf_dir, rows), "silver-bea")
    census, n_census = materialise_counted(lake.census_silver(spark, sf_dir, rows), "silver-census")
    conf, n_conf = materialise_counted(gold.conformed_observations(bea, census), "conformed")
    counts = [("silver_bea", n_bea), ("silver_census", n_census), ("conformed", n_conf)]
    tables = Tables(spark, scratch_path(spark, "star"))
    for stage in ("fact", "fact_after_same_loads_again"):
        for vintage in B.VINTAGES:
            W.load(tables, conf.filter(F.col("vintage_tag") == vintage), _AT)
        counts.append((stage, tables.read("fact").count()))
    counts.append(("obt_annual_latest", materialise_counted(V.obt_annual_latest(W.read_star(tables)), "wide")[1]))
    return spark.createDataFrame(counts, "stage string, row_count long")


@register("backfill_counts", "WITH " + O.OBT_CTES + """
SELECT source_name, dataset_id, count(*) AS row_count, count(DISTINCT vintage_tag) AS vintages
FROM fact_last GROUP BY source_name, dataset_id""")
def q_backfill_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored fact rows per (source, dataset)."""
    st = _two_loads(spark, sf_dir)
    return st.fact.join(st.dim_source.select("source_id", "source_name", "dataset_id"), "source_id").groupBy(
        "source_name", "dataset_id").agg(F.count(F.lit(1)).alias("row_count"),
                                         F.count_distinct("vintage_id").alias("vintages"))


@register("layer_round_trip", ORACLE["silver_bea"])
def q_layer_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BEA Silver rows written under Hive-style folders in canonical order, and read back."""
    rows = lake.bea_silver(spark, sf_dir).select(*LINEAGE, *BEA_SILVER_COLUMNS)
    path = scratch_path(spark, "silver")
    layers.write_layer(rows, path)
    return layers.read_layer(spark, path, rows.schema)


# --- Labels beyond ASCII, spoiled stars, SQL over views, CSV, charts, the kept wide table ---------
@register("labels_beyond_ascii", """
WITH t AS (
  SELECT c_custkey, c_name || ': ' || CASE c_custkey % 4 WHEN 0 THEN 'Café' WHEN 1 THEN 'straße "½"' WHEN 2 THEN '住宅: 🏠'
    ELSE 'plain' END AS label FROM customer
), p AS (
  SELECT c_custkey, list_filter(list_transform(string_split(label, ':'), lambda x: trim(x)), lambda x: x <> '') AS path FROM t
)
SELECT c_custkey AS series_key, '["' || array_to_string(list_transform(path, lambda x:
  replace(replace(replace(replace(replace(replace(replace(replace(x, '"', '\\"'), 'é', '\\u00e9'), 'ß', '\\u00df'),
    '½', '\\u00bd'), '住', '\\u4f4f'), '宅', '\\u5b85'), '🏠', '\\ud83c\\udfe0'), chr(127), '')), '", "') || '"]'
  AS hierarchy_path_json
FROM p""")
def q_labels_beyond_ascii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label paths as JSON in ASCII; all else is escaped, beyond the basic plane as two surrogates."""
    end = F.element_at(F.array(*[F.lit(x) for x in ("Café", 'straße "½"', "住宅: 🏠", "plain")]),
                       (F.col("c_custkey") % 4 + 1).cast("int"))
    rows = lake.bridge._read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("series_key"), F.concat("c_name", F.lit(": "), end).alias("label"))
    return rows.select("series_key", X.json_text_list(X.label_path("label")).alias("hierarchy_path_json"))


def _broken_star(spark: SparkSession, sf_dir: str) -> W.Star:
    """The star with faults by rules on its rows: geographies of even codes twice, price series without a code, and no
    periods of odd years."""
    st = lake.star(spark, sf_dir)
    st = replace(st, **{k: materialise(df, k) for k, df in st.tables().items()})  # each is read by several rules
    even = F.col("state_fips").cast("int") % 2 == 0
    prices = st.dim_source.filter(F.col("table_name") == "SARPP").select("source_id", F.lit(True).alias("_price"))
    series = st.dim_series.join(prices, "source_id", "left").withColumn(
        "series_code", F.when(F.col("_price").isNull(), F.col("series_code"))).drop("_price")
    return replace(st, dim_geo=st.dim_geo.unionByName(st.dim_geo.filter(even)), dim_series=series,
                   dim_period=st.dim_period.filter(F.col("year") % 2 == 0))


_BROKEN = f"""
, bad(table_name, rule, n) AS (
  SELECT 'dim_geo', 'unique', count(*) FROM (SELECT DISTINCT state_fips FROM conformed WHERE CAST(state_fips AS INT) % 2 = 0)
  UNION ALL SELECT 'dim_series', 'not_null', count(*) FROM (SELECT DISTINCT dataset_id, series_code FROM conformed
    WHERE bea_table_name = 'SARPP')
  UNION ALL SELECT 'fact', 'period_id in dim_period', count(*) FROM fact_last WHERE year % 2 = 1
), rules AS (SELECT * FROM {O._values([(t, r) for t in _TABLES for r in ("unique", "not_null")]
                                       + [(t, f"{k} in {to}") for t, k, to in W.REFERENCES], "v(table_name, rule)")})
SELECT r.table_name, r.rule, CAST(coalesce(b.n, 0) AS BIGINT) AS bad_count
FROM rules r LEFT JOIN bad b ON b.table_name = r.table_name AND b.rule = r.rule"""


@register("broken_star_constraints", "WITH " + O.OBT_CTES + _BROKEN)
def q_broken_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The constraint report finds exactly the faults of a spoiled star."""
    return W.constraint_report(_broken_star(spark, sf_dir))


@register("unresolved_keys", "WITH " + O.CONFORMED_CTES + """
SELECT 'period' AS fk, count(*) AS row_count FROM conformed WHERE year % 2 = 1
UNION ALL SELECT 'series', count(*) FROM conformed WHERE bea_table_name = 'SARPP'""")
def q_unresolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conformed rows whose keys a spoiled star doesn't resolve, by key."""
    return W.foreign_key_report(lake.conformed(spark, sf_dir), _broken_star(spark, sf_dir)).groupBy("fk").agg(
        F.count(F.lit(1)).alias("row_count"))


def _views(spark: SparkSession, sf_dir: str) -> int:
    """Registers the views twice (V12), of which the second registration counts; returns the latest year."""
    st = lake.star(spark, sf_dir)
    V.register_views(spark, replace(st, fact=st.fact.filter("false")))
    V.register_views(spark, st)
    return A.sql_latest_year(spark)


@register("sql_latest_rows", ORACLE["latest_year_rows"])
def q_sql_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parameterised SQL over the registered views."""
    return tidy(A.sql_latest_rows(spark, _views(spark, sf_dir)), pce_share=12, weighted_rpp=8)


@register("sql_trend_rows", ORACLE["state_trend_rows"])
def q_sql_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parameterised SQL with a list of states."""
    return A.sql_trend_rows(spark, _views(spark, sf_dir))


@register("sql_scenarios", _S + O.FRAME_ROUNDED + " FROM sql_form")
def q_sql_scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A parameterised read of the weighted view per scenario."""
    return tidy(A.sql_scenarios(spark, _views(spark, sf_dir)), **LEVELS)


@register("combined_csv_round_trip", ORACLE["combined_output"].replace(
    "NULL AS state_abbrev", "CASE WHEN category = 'All items' THEN '' END AS state_abbrev"))
def q_combined_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The combined output written as CSV and read back with its types; NULL and empty texts stay apart."""
    rows = q_combined(spark, sf_dir).withColumn("state_abbrev", F.when(
        (F.col("view_type") == "scenario_comparison") & (F.col("category") == "All items"), "").otherwise(
        F.col("state_abbrev")))
    path = scratch_path(spark, "csv")
    A.write_combined_csv(rows, path)
    return A.read_combined_csv(spark, path, rows.schema)


@register("chart_rows", _S + f"""
SELECT 'scenario_difference' AS chart, scenario AS line, category AS panel, CAST(NULL AS INTEGER) AS x,
       difference_from_national AS y FROM ({O.FRAME_ROUNDED} FROM frame_form) WHERE scenario <> '{A.NATIONAL}'
UNION ALL SELECT 'state_trend', state_abbrev, category, CAST(year AS INTEGER), round(rpp, 6) FROM trend""")
def q_chart_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The points that the charts show."""
    return tidy(A.chart_rows(lake.weighted(spark, sf_dir)), y=6)


@register("kept_wide_table", "WITH " + O.OBT_CTES + " SELECT * FROM obt")
def q_kept_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kept wide table after three loads, each of which rewrote the partitions of its own datasets, equals a
    full build."""
    conf = lake.conformed(spark, sf_dir)
    tables, path = Tables(spark, scratch_path(spark, "star")), scratch_path(spark, "kept-wide")
    final, spending = F.col("vintage_tag") == B.FINAL_VINTAGE, F.col("dataset_id").startswith("pce")
    for rows in (conf.filter(~final), conf.filter(final & spending), conf.filter(final & ~spending)):
        W.load(tables, rows, _AT)
        touched = [r.dataset_id for r in rows.select("dataset_id").distinct().collect()]  # as many as payloads
        V.refresh_wide_table(spark, path, W.read_star(tables), touched)
    return V.read_wide_table(spark, path)
