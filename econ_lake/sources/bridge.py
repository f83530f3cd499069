"""Test-data bridge: TPC-H-like tables -> raw payload-shaped rows.

The driver supplies order/lineitem tables, not economic payloads.  This
module aggregates them into the same loosely typed string rows an API
payload holds (one ``map<string,string>`` per row), so every downstream
operator runs unchanged on data whose volume grows with the tables.

Geography: nation ``k`` becomes state FIPS ``lpad(k+1, 2, '0')``; nations
whose code is not a state code drop at the geo filter, as national and
region rows do.  Time: the order date gives years and months.

Two vintages per dataset: ``2026-03-04`` (final) and an earlier
``2026-03-03`` whose values are a preliminary estimate (net of discount for
spending, whole units for order-based series).  Every vintage covers all rows.

Scale notes: lineitem is read once, orders once for its sums and once for two narrow columns (customers per year).
lineitem is pre-aggregated per order (exchange on the order key, reused by the join with orders).  Orders join their
customers before they are summed: nearly every order is alone in its (customer, month), so summing per customer first
would only shuffle the wide rows once more.  A customer with a third of all orders has one row on the other side of that
join, so AQE splits its partition; the sums behind it leave each task as a few cells (nations x months).  The cells are
stored once; every dataset's rows come from them, all series of one grain in one projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from econ_lake.session import materialise

# ---------------------------------------------------------------------------
# Fixed bridge definitions (our own test-data contract).
# ---------------------------------------------------------------------------
FINAL_VINTAGE = "2026-03-04"
PRELIM_VINTAGE = "2026-03-03"
VINTAGES = (PRELIM_VINTAGE, FINAL_VINTAGE)  # load order

# (table, line, return flag, line status): spending lines from lineitem.
SPENDING_LINES = [
    ("SAPCE1", "1", None, None),
    ("SAPCE1", "2", "A", None),
    ("SAPCE1", "13", "N", None),
    ("SAPCE1", "15", "N", "O"),
    ("SAPCE4", "19", "R", "F"),
    ("SAPCE4", "24", "R", "O"),
]

# Series labels per (table, line) as an API would publish them.
SERIES_LABELS = {
    ("SAPCE1", "1"): "[SAPCE1] Personal consumption expenditures",
    ("SAPCE1", "2"): "[SAPCE1] Personal consumption expenditures: Goods",
    ("SAPCE1", "13"): "[SAPCE1] Personal consumption expenditures: Services",
    ("SAPCE1", "15"): "[SAPCE1] Personal consumption expenditures: Services: Housing and utilities",
    ("SAPCE4", "19"): "[SAPCE4] Personal consumption expenditures: Services:  : Housing",
    ("SAPCE4", "24"): "[SAPCE4] Personal consumption expenditures: Services: Housing and utilities: "
                      "Household utilities",
    ("SARPP", "1"): "[SARPP] RPPs: All items",
    ("SARPP", "2"): "\tRPPs: Goods ",
    ("SARPP", "3"): "[SARPP] RPPs: Services: Housing",
    ("SARPP", "4"): "[SARPP] RPPs: Services: Utilities",
    ("SARPP", "5"): "[SARPP] RPPs: Services: Other",
    ("SAGDP1", "3"): "[SAGDP1] Current-dollar GDP",
    ("SAINC35", "2000"): '[SAINC35] Current transfer receipts: "Federal" government',
}

UNITS = {
    "SAPCE1": ("Millions of current dollars", "6"),
    "SAPCE4": ("Millions of current dollars", "6"),
    "SARPP": ("Percent", "0"),
    "SAGDP1": ("Millions of current dollars", "6"),
    "SAINC35": ("Thousands of dollars", "3"),
}

# dataset id -> load rank inside one daily run (catalog order)
DATASET_ORDER = [
    "pce_state_sapce1",
    "pce_state_sapce4",
    "state_regional_price_parities_sarpp",
    "state_gdp_sagdp1",
    "pce_state_sapce4_monthly",
    "census_state_population",
    "state_personal_transfer_receipts_sainc35",
    "census_state_gov_finance_federal_intergovernmental_revenue",
]
# ---------------------------------------------------------------------------

RAW_COLUMNS = ["source", "dataset_id", "vintage_tag", "run_id", "load_seq", "row"]


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _load_seq(dataset_id: str, vintage: str) -> int:
    return VINTAGES.index(vintage) * 100 + DATASET_ORDER.index(dataset_id) + 1


def _run_id(dataset_id: str, vintage: str) -> str:
    return f"run-{vintage}-{dataset_id}"


def _cents(c: Column) -> Column:
    """Money double with two decimals -> exact integer cents."""
    return F.round(c * 100).cast("bigint")


def _money(cents: Column) -> Column:
    """Integer cents -> exact DECIMAL with two places (tiny data only)."""
    return (cents.cast("decimal(20,0)") / 100).cast("decimal(22,2)")


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One wide row per (nationkey, year, month): every sum that any dataset needs, stored once.

    Sums run on exact integer cents (codegen-friendly longs); the preliminary
    spending estimate nets each line's discount, rounded to the cent.
    ``customers`` stands in a row of its own per (nationkey, year), without a month.
    """
    li = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        _cents(F.col("l_extendedprice")).alias("px"),
        F.round(F.col("l_discount") * 100).cast("bigint").alias("disc"),
        "l_returnflag",
        "l_linestatus",
    ).withColumn("npx", F.expr("(px * (100 - disc) + 50) div 100"))
    per_order_aggs = []
    for table, line, rf, ls in SPENDING_LINES:
        tests = [f"{c} = '{v}'" for c, v in (("l_returnflag", rf), ("l_linestatus", ls)) if v is not None]
        only = f" FILTER (WHERE {' AND '.join(tests)})" if tests else ""
        per_order_aggs += [f"sum(px){only} AS f_{table}_{line}", f"sum(npx){only} AS p_{table}_{line}"]
    per_order = li.groupBy("l_orderkey").agg(*map(F.expr, per_order_aggs))

    prio, amt = F.substring("o_orderpriority", 1, 1), _cents(F.col("o_totalprice"))
    orders = _read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey",
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"),
        amt.alias("amt_all"), F.when(F.col("o_orderstatus") == "F", amt).alias("amt_f"),
        *[F.when(prio == p, amt).alias(f"amt_{p}") for p in "12345"],
        *[F.when(prio == p, 1).otherwise(0).alias(f"cnt_{p}") for p in "12345"],
    )
    sums = [c for c in (*orders.columns[4:], *per_order.columns[1:])]
    cust = _read(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("nationkey"))
    monthly = _sums(
        orders.join(per_order, orders.o_orderkey == per_order.l_orderkey, "left")
        .join(cust, orders.o_custkey == cust.c_custkey), ["nationkey", "year", "month"], sums)
    buyers = orders.select("o_custkey", "year").distinct()
    yearly = (
        buyers.join(cust, buyers.o_custkey == cust.c_custkey)
        .groupBy("nationkey", "year").agg(F.count(F.lit(1)).alias("customers")))
    return materialise(monthly.unionByName(yearly, allowMissingColumns=True), "cells")


ORDER_CELLS = ["amt_all", "amt_f", *[f"{k}_{p}" for p in "12345" for k in ("amt", "cnt")], "customers"]
SPENDING_CELLS = [f"{k}_{t}_{ln}" for t, ln, _, _ in SPENDING_LINES for k in "fp"]


def _sums(wide: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    return wide.groupBy(*keys).agg(*[F.expr(f"sum({c}) AS {c}") for c in columns])


def order_cells(wide: DataFrame) -> DataFrame:
    """Per (nationkey, year): order sums by priority, fulfilled sum, customers."""
    return _sums(wide, ["nationkey", "year"], ORDER_CELLS)


def _whole_units(cents: str) -> str:
    """Preliminary estimate in whole units: cents rounded half up to 100s."""
    return f"{cents} + 50 - pmod({cents} + 50, 100)"


def _geo_fips(nationkey: Column) -> Column:
    return F.concat(F.lpad((nationkey + 1).cast("string"), 2, "0"), F.lit("000"))


def _label(table: Column, line: Column) -> Column:
    m = F.create_map(*[x for (t, l), v in SERIES_LABELS.items() for x in (F.lit(f"{t}-{l}"), F.lit(v))])
    return m[F.concat(table, F.lit("-"), line)]


def _per_vintage(df: DataFrame) -> DataFrame:
    """Duplicate a cell frame into (vintage_tag, value) rows."""
    return df.select(
        "*",
        F.inline(F.array(
            F.struct(F.lit(PRELIM_VINTAGE).alias("vintage_tag"), F.col("prelim").alias("value")),
            F.struct(F.lit(FINAL_VINTAGE).alias("vintage_tag"), F.col("final").alias("value")),
        )),
    ).drop("prelim", "final")


def _lineage(df: DataFrame, source: str) -> DataFrame:
    cases = " ".join(
        f"WHEN vintage_tag = '{v}' AND dataset_id = '{d}' THEN {_load_seq(d, v)}"
        for v in VINTAGES for d in DATASET_ORDER
    )
    return df.selectExpr(
        f"'{source}' AS source", "dataset_id", "vintage_tag",
        "concat('run-', vintage_tag, '-', dataset_id) AS run_id",
        f"CAST(CASE {cases} ELSE 0 END AS INT) AS load_seq", "row",
    )


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names by nation key; left to the planner's size check."""
    return _read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nationkey"), "n_name")


def _each(rows: DataFrame, series: list[tuple[str, ...]]) -> DataFrame:
    """The rows of several series from one wide row: (dataset, table, line, and as SQL name, condition, final,
    prelim) each."""
    each = ", ".join(
        f"CASE WHEN {there} THEN struct('{dataset}' AS dataset_id, {name} AS GeoName, '{table}' AS table, "
        f"'{line}' AS line, {final} AS final, {prelim} AS prelim) END"
        for dataset, table, line, name, there, final, prelim in series)
    return rows.selectExpr("GeoFips", "TimePeriod", f"inline(filter(array({each}), one -> one IS NOT NULL))")


def _spending(dataset: str | None, name: str, lines: list[tuple]) -> list[tuple[str, ...]]:
    """The spending series as ``_each`` takes them; without a dataset each goes to that of its table."""
    return [(dataset or f"pce_state_{t.lower()}", t, ln, name, f"f_{t}_{ln} IS NOT NULL", f"f_{t}_{ln}",
             f"p_{t}_{ln}") for t, ln, _, _ in lines]


def bea_raw_rows(spark: SparkSession, sf_dir: str, wide: DataFrame | None = None,
                 nation: DataFrame | None = None) -> DataFrame:
    wide = cells(spark, sf_dir) if wide is None else wide
    nation = _nations(spark, sf_dir) if nation is None else nation
    name, year = "n_name", F.col("year").cast("string").alias("TimePeriod")
    detail = [line for line in SPENDING_LINES if line[0] == "SAPCE4"]
    named = wide.filter(F.col("month").isNotNull()).join(nation, "nationkey").withColumn(
        "GeoFips", _geo_fips(F.col("nationkey")))

    by_year = _sums(wide, ["nationkey", "year"], [*SPENDING_CELLS, *ORDER_CELLS]).join(nation, "nationkey").select(
        "*", _geo_fips(F.col("nationkey")).alias("GeoFips"), year,
        *[F.expr(f"CASE WHEN cnt_{p} > 0 THEN amt_{p} div cnt_{p} END").alias(f"avg_{p}") for p in "12345"])
    annual_rows = _each(by_year, [
        *_spending(None, name, SPENDING_LINES),
        *[("state_regional_price_parities_sarpp", "SARPP", p, name, f"cnt_{p} > 0", f"avg_{p}",
           _whole_units(f"avg_{p}")) for p in "12345"],
        ("state_gdp_sagdp1", "SAGDP1", "3", "concat(n_name, ' *')", "true", "amt_all", _whole_units("amt_all")),
        ("state_personal_transfer_receipts_sainc35", "SAINC35", "2000", name, "amt_f IS NOT NULL", "amt_f",
         _whole_units("amt_f")),
    ])
    # national (00000) and region (91000) aggregates: they must drop at the geo filter
    total_rows = _each(
        _sums(wide, ["year"], SPENDING_CELLS).select(
            "*", year, F.explode(F.array(F.lit("00000"), F.lit("91000"))).alias("GeoFips")),
        _spending("pce_state_sapce1", "'United States *'", [x for x in SPENDING_LINES if x[0] == "SAPCE1"]))
    monthly_rows = _each(
        named.withColumn("TimePeriod", F.format_string("%dM%02d", F.col("year"), F.col("month"))),
        _spending("pce_state_sapce4_monthly", name, detail))
    # quarterly rows inside the monthly payload: they must drop
    off_rows = _each(
        _sums(named.withColumn("quarter", F.expr("(month + 2) div 3")),
              ["nationkey", "n_name", "GeoFips", "year", "quarter"], ["f_SAPCE4_19", "p_SAPCE4_19"])
        .withColumn("TimePeriod", F.format_string("%dQ%d", F.col("year"), F.col("quarter"))),
        _spending("pce_state_sapce4_monthly", name, [line for line in detail if line[1] == "19"]))

    each = annual_rows.unionByName(total_rows).unionByName(monthly_rows).unionByName(off_rows)
    unit_map = F.create_map(*[x for t, (u, _) in UNITS.items() for x in (F.lit(t), F.lit(u))])
    mult_map = F.create_map(*[x for t, (_, m) in UNITS.items() for x in (F.lit(t), F.lit(m))])
    each = _per_vintage(each)
    base = [
        F.lit("GeoFips"), F.col("GeoFips"), F.lit("GeoName"), F.col("GeoName"),
        F.lit("TimePeriod"), F.col("TimePeriod"),
        F.lit("Code"), F.concat(F.col("table"), F.lit("-"), F.col("line")),
        F.lit("FunctionName"), _label(F.col("table"), F.col("line")),
        F.lit("DataValue"), F.format_number(_money(F.col("value")), 2),
        F.lit("CL_UNIT"), unit_map[F.col("table")],
        F.lit("UNIT_MULT"), mult_map[F.col("table")],
    ]
    # one dataset's payload has no NoteRef field at all
    with_note = F.create_map(*base, F.lit("NoteRef"), F.when(F.col("GeoName").endswith("*"), "*").otherwise(""))
    row = F.when(F.col("dataset_id") == "state_regional_price_parities_sarpp", F.create_map(*base)).otherwise(with_note)
    return _lineage(each.select("dataset_id", "vintage_tag", row.alias("row")), "bea")


def census_raw_rows(spark: SparkSession, sf_dir: str, wide: DataFrame | None = None,
                    nation: DataFrame | None = None) -> DataFrame:
    wide = cells(spark, sf_dir) if wide is None else wide
    nation = _nations(spark, sf_dir) if nation is None else nation
    supp = _read(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("nationkey")).agg(
        _money(F.sum(_cents(F.col("s_acctbal")))).alias("amount"), F.lit(True).alias("has_amount"))
    both = _sums(wide, ["nationkey", "year"], ["customers"]).join(nation, "nationkey").join(supp, "nationkey", "left")
    geo, year = [F.lit("NAME"), F.col("n_name")], [F.lit("YEAR"), F.col("year").cast("string")]
    state = (F.col("nationkey") + 1).cast("string")
    pop = F.struct(F.lit("census_state_population").alias("dataset_id"), F.create_map(
        *geo, F.lit("B01003_001E"), F.col("customers").cast("string"),
        F.lit("state"), state, *year).alias("row"))  # un-padded on purpose
    fin = F.when(F.col("has_amount"), F.struct(
        F.lit("census_state_gov_finance_federal_intergovernmental_revenue").alias("dataset_id"), F.create_map(
            *geo, F.lit("AMOUNT"), F.col("amount").cast("string"),
            F.lit("state"), F.lpad(state, 2, "0"), *year).alias("row")))
    vint = both.select(F.inline(F.filter(F.array(pop, fin), lambda one: one.isNotNull()))).select(
        "*", F.explode(F.array(*[F.lit(v) for v in VINTAGES])).alias("vintage_tag"))
    return _lineage(vint, "census")


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw payload rows: source, dataset_id, vintage_tag, run_id, load_seq, row."""
    wide, nation = cells(spark, sf_dir), _nations(spark, sf_dir)
    return bea_raw_rows(spark, sf_dir, wide, nation).unionByName(census_raw_rows(spark, sf_dir, wide, nation))
