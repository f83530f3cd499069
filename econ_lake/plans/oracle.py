"""Independent DuckDB SQL for every registered query.

Each statement starts from the base tables (views ``lineitem``, ``orders``,
``customer``, ``nation``, ``supplier``...) and re-derives the result with
plain SQL: the bridge aggregation, label / period parsing, vintage and
last-write rules, views and the study.  The test-data definitions (labels,
units, spending lines, load order) are rendered from the bridge, as they are the
input; the constants of the views and of the study are written out here.
Sums of doubles depend on their order in the last digits, so the registered
queries round such columns in their last step, on both sides.
"""

from __future__ import annotations

from econ_lake.sources import bridge as B


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _values(rows: list[tuple], names: str) -> str:
    body = ",\n    ".join("(" + ", ".join("NULL" if v is None else (_q(v) if isinstance(v, str) else str(v))
                                         for v in r) + ")" for r in rows)
    return f"(VALUES\n    {body}) AS {names}"


# FIPS codes of the states that nation keys 0 to 24 can stand for.
_FIPS = _values([
    ("01", "AL"), ("02", "AK"), ("04", "AZ"), ("05", "AR"), ("06", "CA"), ("08", "CO"), ("09", "CT"), ("10", "DE"),
    ("11", "DC"), ("12", "FL"), ("13", "GA"), ("15", "HI"), ("16", "ID"), ("17", "IL"), ("18", "IN"), ("19", "IA"),
    ("20", "KS"), ("21", "KY"), ("22", "LA"), ("23", "ME"), ("24", "MD"), ("25", "MA"),
], "f(state_fips, state_abbrev)")
_LABELS = _values([(t, ln, lab) for (t, ln), lab in B.SERIES_LABELS.items()], "lb(tbl, line, label)")
_UNITS = _values([(t, u, int(m)) for t, (u, m) in B.UNITS.items()], "u(tbl, unit, unit_mult)")
_SPEND = _values(B.SPENDING_LINES, "s(tbl, line, rf, ls)")
_DSRANK = _values([(d, i + 1) for i, d in enumerate(B.DATASET_ORDER)], "r(dataset_id, rnk)")
_VINT = _values([(v, i) for i, v in enumerate(B.VINTAGES)], "v(vintage_tag, vidx)")

# python-style strip
_STRIP = "regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def strip(x: str) -> str:
    return _STRIP.format(x=x)


# ---------------------------------------------------------------------------
# Bridge + Silver + Gold: conformed observations of every dataset and vintage
# ---------------------------------------------------------------------------
CONFORMED_CTES = f"""
li AS (
  SELECT l_orderkey,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS px,
         CAST(round(l_discount * 100) AS BIGINT) AS disc,
         l_returnflag AS rf, l_linestatus AS ls
  FROM lineitem
),
oc AS (
  SELECT o.o_orderkey, o.o_custkey, c.c_nationkey AS nk,
         CAST(year(o.o_orderdate) AS INTEGER) AS yr, CAST(month(o.o_orderdate) AS INTEGER) AS mo,
         substr(o.o_orderpriority, 1, 1) AS prio,
         CAST(round(o.o_totalprice * 100) AS BIGINT) AS amt, o.o_orderstatus AS st
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
),
spend_m AS (
  SELECT oc.nk, oc.yr, oc.mo, s.tbl, s.line,
         sum(li.px) AS final, sum((li.px * (100 - li.disc) + 50) // 100) AS prelim
  FROM li JOIN oc ON li.l_orderkey = oc.o_orderkey
  JOIN {_SPEND} ON (s.rf IS NULL OR li.rf = s.rf) AND (s.ls IS NULL OR li.ls = s.ls)
  GROUP BY oc.nk, oc.yr, oc.mo, s.tbl, s.line
),
spend_a AS (
  SELECT nk, yr, tbl, line, sum(final) AS final, sum(prelim) AS prelim FROM spend_m GROUP BY nk, yr, tbl, line
),
rpp AS (
  SELECT nk, yr, prio AS line, sum(amt) // count(*) AS final FROM oc GROUP BY nk, yr, prio
),
ord_a AS (
  SELECT nk, yr, sum(amt) AS amt_all, sum(amt) FILTER (WHERE st = 'F') AS amt_f,
         count(DISTINCT o_custkey) AS customers
  FROM oc GROUP BY nk, yr
),
bea_cells AS (
  SELECT CASE tbl WHEN 'SAPCE1' THEN 'pce_state_sapce1' ELSE 'pce_state_sapce4' END AS dataset_id,
         nk, yr, CAST(NULL AS INTEGER) AS mo, 'A' AS freq, tbl, line, final, prelim FROM spend_a
  UNION ALL
  SELECT 'pce_state_sapce4_monthly', nk, yr, mo, 'M', tbl, line, final, prelim FROM spend_m WHERE tbl = 'SAPCE4'
  UNION ALL
  SELECT 'state_regional_price_parities_sarpp', nk, yr, NULL, 'A', 'SARPP', line, final,
         (final + 50) - (((final + 50) % 100) + 100) % 100 FROM rpp
  UNION ALL
  SELECT 'state_gdp_sagdp1', nk, yr, NULL, 'A', 'SAGDP1', '3', amt_all,
         (amt_all + 50) - (((amt_all + 50) % 100) + 100) % 100 FROM ord_a
  UNION ALL
  SELECT 'state_personal_transfer_receipts_sainc35', nk, yr, NULL, 'A', 'SAINC35', '2000', amt_f,
         (amt_f + 50) - (((amt_f + 50) % 100) + 100) % 100 FROM ord_a WHERE amt_f IS NOT NULL
),
label_parsed AS (
  SELECT tbl, line, raw_description,
         list_filter(list_transform(string_split(body, ':'), lambda x: {strip('x')}), lambda x: x <> '') AS path
  FROM (SELECT tbl, line, raw_description,
               {strip("regexp_replace(" + strip('raw_description') + ", '^\\[[^\\]]+\\]\\s*', '')")} AS body
        FROM (SELECT tbl, line, label AS raw_description FROM {_LABELS}))
),
bea_parsed AS (
  SELECT b.*, coalesce(lp.raw_description, '') AS raw_description, coalesce(lp.path, []) AS path
  FROM bea_cells b LEFT JOIN label_parsed lp ON lp.tbl = b.tbl AND lp.line = b.line
),
bea_conf AS (
  SELECT 'BEA' AS source_name, p.dataset_id, p.tbl AS bea_table_name, p.freq AS frequency,
         CASE WHEN p.freq = 'M' THEN printf('%dM%02d', p.yr, p.mo) ELSE CAST(p.yr AS VARCHAR) END AS period_code,
         p.yr AS year, p.mo AS month, CAST(NULL AS INTEGER) AS quarter,
         f.state_fips, f.state_abbrev,
         CASE WHEN p.dataset_id = 'state_gdp_sagdp1' THEN n.n_name || ' *' ELSE n.n_name END AS geo_name,
         p.line AS line_code, p.tbl || '-' || p.line AS series_code,
         CASE WHEN len(p.path) >= 2 THEN p.path[1] ELSE '' END AS series_name,
         CASE WHEN len(p.path) >= 1 THEN p.path[len(p.path)] ELSE '' END AS function_name,
         p.raw_description,
         CASE WHEN len(p.path) = 0 THEN '[]'
              ELSE '["' || array_to_string(list_transform(p.path,
                     lambda x: replace(replace(x, '\\', '\\\\'), '"', '\\"')), '", "') || '"]' END AS hierarchy_path_json,
         u.unit, CAST(u.unit_mult AS INTEGER) AS unit_mult, v.vintage_tag,
         (CASE v.vidx WHEN 0 THEN p.prelim ELSE p.final END) / 100.0 AS pce_value,
         ((CASE v.vidx WHEN 0 THEN p.prelim ELSE p.final END) / 100.0) * power(10.0, u.unit_mult) AS pce_value_scaled,
         CASE WHEN p.dataset_id = 'state_regional_price_parities_sarpp' THEN ''
              WHEN p.dataset_id = 'state_gdp_sagdp1' THEN '*' ELSE '' END AS note_ref,
         'run-' || v.vintage_tag || '-' || p.dataset_id AS run_id,
         CAST(v.vidx * 100 + r.rnk AS INTEGER) AS load_seq
  FROM bea_parsed p
  JOIN nation n ON n.n_nationkey = p.nk
  JOIN {_FIPS} ON f.state_fips = lpad(CAST(p.nk + 1 AS VARCHAR), 2, '0')
  JOIN {_UNITS} ON u.tbl = p.tbl
  JOIN {_DSRANK} ON r.dataset_id = p.dataset_id
  JOIN {_VINT} ON TRUE
),
fin_amt AS (
  SELECT s_nationkey AS nk, sum(CAST(round(s_acctbal * 100) AS BIGINT)) AS cents FROM supplier GROUP BY s_nationkey
),
census_cells AS (
  SELECT 'census_state_population' AS dataset_id, a.nk, a.yr, CAST(a.customers AS DOUBLE) AS value FROM ord_a a
  UNION ALL
  SELECT 'census_state_gov_finance_federal_intergovernmental_revenue', a.nk, a.yr, fa.cents / 100.0
  FROM ord_a a JOIN fin_amt fa ON fa.nk = a.nk
),
census_conf AS (
  SELECT 'CENSUS' AS source_name, c.dataset_id,
         CASE WHEN fin THEN 'TIMESERIES_GOVS' ELSE 'ACS_ACS1' END AS bea_table_name,
         'A' AS frequency, CAST(c.yr AS VARCHAR) AS period_code, c.yr AS year,
         CAST(NULL AS INTEGER) AS month, CAST(NULL AS INTEGER) AS quarter,
         f.state_fips, f.state_abbrev, n.n_name AS geo_name,
         CASE WHEN fin THEN 'AMOUNT' ELSE 'B01003_001E' END AS line_code,
         CASE WHEN fin THEN 'TIMESERIES_GOVS-AMOUNT-SF0004' ELSE 'ACS_ACS1-B01003_001E' END AS series_code,
         CASE WHEN fin THEN 'Federal intergovernmental revenue' ELSE 'Resident population' END AS series_name,
         CASE WHEN fin THEN 'Federal intergovernmental revenue' ELSE 'Resident population' END AS function_name,
         CASE WHEN fin THEN 'Federal intergovernmental revenue' ELSE 'Resident population' END AS raw_description,
         CASE WHEN fin THEN '["Federal intergovernmental revenue"]' ELSE '["Resident population"]' END
           AS hierarchy_path_json,
         CASE WHEN fin THEN 'dollars_thousands' ELSE 'persons' END AS unit,
         CASE WHEN fin THEN 3 ELSE 0 END AS unit_mult,
         v.vintage_tag, c.value AS pce_value,
         CASE WHEN fin THEN c.value * 1000.0 ELSE c.value END AS pce_value_scaled,
         '' AS note_ref,
         'run-' || v.vintage_tag || '-' || c.dataset_id AS run_id,
         CAST(v.vidx * 100 + r.rnk AS INTEGER) AS load_seq
  FROM (SELECT *, dataset_id LIKE 'census_state_gov%' AS fin FROM census_cells) c
  JOIN nation n ON n.n_nationkey = c.nk
  JOIN {_FIPS} ON f.state_fips = lpad(CAST(c.nk + 1 AS VARCHAR), 2, '0')
  JOIN {_DSRANK} ON r.dataset_id = c.dataset_id
  JOIN {_VINT} ON TRUE
),
conformed AS (
  SELECT * FROM bea_conf UNION ALL SELECT * FROM census_conf
)"""
CONFORMED_COLUMNS = (
    "source_name, dataset_id, bea_table_name, frequency, period_code, year, month, quarter, state_fips, "
    "state_abbrev, geo_name, line_code, series_code, series_name, function_name, raw_description, "
    "hierarchy_path_json, unit, unit_mult, vintage_tag, pce_value, pce_value_scaled, note_ref, run_id, load_seq"
)

# ---------------------------------------------------------------------------
# Star-schema rules and the latest annual wide table (V1)
# ---------------------------------------------------------------------------
OBT_CTES = CONFORMED_CTES + """,
geo_last AS (
  SELECT state_fips, state_abbrev, geo_name FROM (
    SELECT state_fips, state_abbrev, geo_name,
           row_number() OVER (PARTITION BY state_fips ORDER BY load_seq DESC, first_p DESC, first_l DESC) AS rn
    FROM (SELECT state_fips, state_abbrev, geo_name, load_seq, min(period_code) AS first_p,
                 arg_min(line_code, period_code) AS first_l
          FROM conformed GROUP BY state_fips, state_abbrev, geo_name, load_seq))
  WHERE rn = 1
),
series_last AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT source_name, dataset_id, bea_table_name AS table_name, series_code, s_table, line_code, series_name,
           function_name, raw_description, hierarchy_path_json, unit, unit_mult,
           row_number() OVER (PARTITION BY source_name, dataset_id, bea_table_name, series_code
                              ORDER BY load_seq DESC) AS rn
    FROM (SELECT *, bea_table_name AS s_table FROM conformed))
  WHERE rn = 1
),
latest_vintage AS (
  SELECT source_name, dataset_id, bea_table_name, arg_max(vintage_tag, load_seq) AS vintage_tag
  FROM conformed GROUP BY source_name, dataset_id, bea_table_name
),
fact_last AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT c.*, row_number() OVER (PARTITION BY source_name, dataset_id, bea_table_name, series_code, state_fips,
                                   frequency, period_code, vintage_tag ORDER BY load_seq DESC) AS rn
    FROM conformed c)
  WHERE rn = 1
),
obt AS (
  SELECT f.source_name, f.dataset_id, f.bea_table_name, f.state_fips, g.state_abbrev, g.geo_name, f.year,
         s.line_code, f.series_code, s.series_name, s.function_name, s.raw_description, s.hierarchy_path_json,
         s.unit, s.unit_mult, f.vintage_tag, CAST(NULL AS VARCHAR) AS release_tag,
         f.pce_value, f.pce_value_scaled, f.note_ref
  FROM fact_last f
  JOIN latest_vintage lv ON lv.source_name = f.source_name AND lv.dataset_id = f.dataset_id
       AND lv.bea_table_name = f.bea_table_name AND lv.vintage_tag = f.vintage_tag
  JOIN geo_last g ON g.state_fips = f.state_fips
  JOIN series_last s ON s.source_name = f.source_name AND s.dataset_id = f.dataset_id
       AND s.table_name = f.bea_table_name AND s.series_code = f.series_code
  WHERE f.frequency = 'A'
)"""

# ---------------------------------------------------------------------------
# Views (constants of the published definitions, written out)
# ---------------------------------------------------------------------------
WEIGHTED_CTES = OBT_CTES + """,
price AS (
  SELECT o.*, k.ckey, k.cname
  FROM obt o JOIN (VALUES ('1', 'all_items', 'All items'), ('2', 'goods', 'Goods'),
                          ('3', 'housing_rents', 'Housing rents'), ('4', 'utilities', 'Utilities'),
                          ('5', 'other_services', 'Other services')) AS k(line, ckey, cname) ON o.line_code = k.line
  WHERE o.source_name = 'BEA' AND o.bea_table_name = 'SARPP'
),
spent AS (
  SELECT o.state_fips, o.year, m.ckey, m.how, m.tbl, o.series_code AS series, o.function_name AS fn,
         o.pce_value_scaled AS amount, o.vintage_tag AS vtag, o.release_tag AS rtag
  FROM obt o JOIN (VALUES ('SAPCE1', '1', 'all_items', 'direct'), ('SAPCE1', '2', 'goods', 'direct'),
                          ('SAPCE4', '19', 'housing_rents', 'approximation_housing_proxy_for_rents'),
                          ('SAPCE4', '24', 'utilities', 'direct')) AS m(tbl, line, ckey, how)
    ON o.bea_table_name = m.tbl AND o.line_code = m.line
  WHERE o.source_name = 'BEA'
  UNION ALL
  SELECT coalesce(x.state_fips, y.state_fips), coalesce(x.year, y.year), 'other_services',
         'derived_services_less_housing_and_utilities', 'SAPCE1', 'SAPCE1-13_MINUS_15',
         'Services less housing and utilities', x.pce_value_scaled - y.pce_value_scaled,
         greatest(x.vintage_tag, y.vintage_tag), greatest(x.release_tag, y.release_tag)
  FROM (SELECT * FROM obt WHERE series_code = 'SAPCE1-13') AS x
  FULL JOIN (SELECT * FROM obt WHERE series_code = 'SAPCE1-15') AS y USING (state_fips, year)
),
portion AS (
  SELECT *, amount / nullif(sum(amount) OVER (PARTITION BY year, ckey), 0) AS share FROM spent
),
wview AS (
  SELECT a.year, a.state_fips, a.state_abbrev, a.geo_name, a.cname AS category, a.line_code AS rpp_line_code,
         a.series_code AS rpp_series_code, a.function_name AS rpp_function_name, a.pce_value AS rpp,
         z.tbl AS pce_source_table, z.series AS pce_series_code, z.fn AS pce_function_name, z.how AS mapping_method,
         z.amount AS pce, z.share AS pce_share, a.pce_value * z.share AS weighted_rpp,
         a.vintage_tag AS rpp_vintage_tag, a.release_tag AS rpp_release_tag, z.vtag AS pce_vintage_tag,
         z.rtag AS pce_release_tag
  FROM price a JOIN portion z ON z.state_fips = a.state_fips AND z.year = a.year AND z.ckey = a.ckey
)"""

PCT = "CAST(100.0 AS DOUBLE)"

YOY_SQL = "WITH " + OBT_CTES + f""",
pair AS (
  SELECT * EXCLUDE (pce_value), pce_value AS value_current,
         first_value(pce_value) OVER (PARTITION BY source_name, dataset_id, state_fips, series_code ORDER BY year
                                      RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) AS value_prior
  FROM obt
)
SELECT source_name, dataset_id, bea_table_name, state_fips, state_abbrev, geo_name, line_code, series_code,
       series_name, function_name, raw_description, hierarchy_path_json, year, value_current, value_prior,
       (value_current - value_prior) / nullif(value_prior, 0) * {PCT} AS yoy_pct
FROM pair"""


def per_capita_sql(population_only: bool) -> str:
    people = "dataset_id = 'census_state_population'" if population_only else "true"
    return "WITH " + OBT_CTES + f""",
head AS (SELECT state_fips, year, pce_value_scaled AS population, vintage_tag AS population_vintage_tag
         FROM obt WHERE source_name = 'CENSUS' AND {people})
SELECT bea_table_name, state_fips, state_abbrev, geo_name, year, line_code, series_code, series_name, function_name,
       unit AS bea_unit, pce_value, pce_value_scaled, population, population_vintage_tag,
       pce_value_scaled / nullif(population, 0) AS value_per_capita
FROM obt LEFT JOIN head USING (state_fips, year) WHERE source_name = 'BEA'"""


def ratio_sql(numerator: str, measure: str, ratio: str, vintage: str) -> str:
    return "WITH " + OBT_CTES + f"""
SELECT state_fips, obt.state_abbrev, obt.geo_name, year, obt.pce_value_scaled AS {measure},
       base.pce_value_scaled AS gdp_current_dollars,
       obt.pce_value_scaled / nullif(base.pce_value_scaled, 0) AS {ratio},
       obt.vintage_tag AS {vintage}, base.vintage_tag AS gdp_vintage_tag
FROM obt LEFT JOIN (SELECT * FROM obt WHERE series_code = 'SAGDP1-3') AS base USING (state_fips, year)
WHERE {numerator.replace("dataset_id", "obt.dataset_id").replace("source_name", "obt.source_name").replace("line_code", "obt.line_code")}"""


SUBSET_LEVEL_SQL = "WITH " + WEIGHTED_CTES + """
SELECT year, category, round(sum(weighted_rpp) / nullif(sum(pce_share), 0), 6) AS rpp_level,
       round(sum(pce_share), 10) AS share_sum
FROM wview WHERE state_abbrev <> 'CA' GROUP BY year, category"""

# ---------------------------------------------------------------------------
# Study
# ---------------------------------------------------------------------------
_TARGETS = "['CA', 'NY', 'NJ', 'IL', 'CT']"
STUDY_CTES = WEIGHTED_CTES + f""",
latest AS (SELECT max(year) AS latest_year FROM wview),
lrows AS (SELECT year, state_abbrev, category, rpp, pce_share, weighted_rpp
          FROM wview JOIN latest ON year = latest_year),
scenario_list AS (
  SELECT * FROM (VALUES ('National', 1, CAST([] AS VARCHAR[])), ('Without CA', 2, ['CA']),
                        ('Without CA, NY, NJ, IL, CT', 3, {_TARGETS})) AS v(scenario, scenario_rank, without)
),
totals AS (
  SELECT category, scenario, scenario_rank,
         sum(weighted_rpp) FILTER (WHERE NOT list_contains(without, state_abbrev)) AS wsum,
         sum(pce_share) FILTER (WHERE NOT list_contains(without, state_abbrev)) AS share_sum
  FROM lrows, scenario_list GROUP BY category, scenario, scenario_rank
),
levels AS (
  SELECT *, CASE WHEN scenario_rank = 1 THEN wsum ELSE wsum / nullif(share_sum, 0) END AS rpp_level FROM totals
),
sql_form AS (
  SELECT v.category, v.scenario, v.rpp_level, v.share_sum, v.rpp_level - n.rpp_level AS difference_from_national,
         (v.rpp_level / nullif(n.rpp_level, 0) - 1) * {PCT} AS pct_change_from_national,
         CAST(coalesce(list_position(['All items', 'Housing rents', 'Goods', 'Utilities'], v.category), 5) AS INTEGER)
           AS category_rank, v.scenario_rank
  FROM levels v JOIN levels n ON n.category = v.category AND n.scenario_rank = 1
),
frame_form AS (
  SELECT category, scenario, rpp_level, difference_from_national,
         difference_from_national / nullif(rpp_level - difference_from_national, 0) * {PCT}
           AS pct_change_from_national, share_sum
  FROM sql_form
),
trend AS (
  SELECT state_abbrev, category, year, rpp
  FROM wview, latest WHERE latest_year - year < 5 AND list_contains({_TARGETS}, state_abbrev)
),
change AS (
  SELECT *, end_rpp - start_rpp AS rpp_change, (end_rpp / nullif(start_rpp, 0) - 1.0) * {PCT} AS pct_change
  FROM (SELECT state_abbrev, category, min(year) AS start_year, max(year) AS end_year,
               arg_min(rpp, year) FILTER (WHERE rpp IS NOT NULL) AS start_rpp,
               arg_max(rpp, year) FILTER (WHERE rpp IS NOT NULL) AS end_rpp,
               count(DISTINCT year) = 5 AS complete
        FROM trend GROUP BY state_abbrev, category)
)"""

# Rounded in the last step of a registered query; see there.
FRAME_ROUNDED = ("SELECT category, scenario, round(rpp_level, 6) AS rpp_level, "
                 "round(difference_from_national, 6) AS difference_from_national, "
                 "round(pct_change_from_national, 6) AS pct_change_from_national, "
                 "round(share_sum, 10) AS share_sum")

# ---------------------------------------------------------------------------
# Raw payload rows, also those that the geo and period filters drop
# ---------------------------------------------------------------------------
RAW_COUNT_CTES = CONFORMED_CTES + f""",
raw_rows AS (
  SELECT dataset_id, count(*) AS n FROM bea_cells JOIN nation ON n_nationkey = nk GROUP BY dataset_id
  UNION ALL SELECT 'pce_state_sapce1', 2 * count(*) FROM (SELECT DISTINCT yr, line FROM spend_a WHERE tbl = 'SAPCE1')
  UNION ALL SELECT 'pce_state_sapce4_monthly', count(*)
            FROM (SELECT DISTINCT nk, yr, (mo + 2) // 3 FROM spend_m WHERE tbl = 'SAPCE4' AND line = '19')
  UNION ALL SELECT dataset_id, count(*) FROM census_cells JOIN nation ON n_nationkey = nk GROUP BY dataset_id
),
raw_counts AS (
  SELECT r.dataset_id, v.vintage_tag, 'run-' || v.vintage_tag || '-' || r.dataset_id AS run_id,
         CAST(sum(r.n) AS BIGINT) AS row_count, CAST(v.vidx * 100 + k.rnk AS INTEGER) AS load_seq
  FROM raw_rows r JOIN {_VINT} ON TRUE JOIN {_DSRANK.replace("r(dataset_id", "k(dataset_id")} ON k.dataset_id = r.dataset_id
  GROUP BY r.dataset_id, v.vintage_tag, v.vidx, k.rnk
),
changed_sets AS (
  SELECT dataset_id, bool_or(prelim <> final) AS differs FROM bea_cells GROUP BY dataset_id
  UNION ALL SELECT DISTINCT dataset_id, false FROM census_cells
)"""
