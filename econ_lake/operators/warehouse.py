"""Star schema maintenance (U1, W1-W17) as set-based DataFrame plans.

``build_star`` replays any number of loads at once: the conformed rows of
every run carry ``load_seq`` (load order) and the keyed-upsert rules are
expressed as aggregates over it:

* keyed upsert = the row of the greatest ``load_seq`` per key wins;
* "last distinct tuple by first appearance" = per (key, load) the tuple whose
  first appearance in frame order is latest, then the latest load wins;
* vintages: the vintage of a source's most recent load is the latest one.

Surrogate ids are ``xxhash64`` of the natural key, so foreign keys are
computable without reading ids back.  Every step is a partial aggregate or an
equi-join on keys; nothing is collected.

``load`` maintains the same tables in a store, load after load: keyed upserts of
the touched partitions, published together (W17).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from econ_lake.functions import exprs as X
from econ_lake.operators.tables import Tables
from econ_lake.session import materialise


@dataclass
class Star:
    dim_source: DataFrame
    dim_vintage: DataFrame
    dim_geo: DataFrame
    dim_period: DataFrame
    dim_series: DataFrame
    dim_series_node: DataFrame
    bridge_series_node: DataFrame
    fact: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return dict(self.__dict__)


def _hash_id(*cols) -> "F.Column":
    return F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in cols])


def _keyed(conf: DataFrame) -> DataFrame:
    """Conformed rows with the natural keys normalised the way the loader does."""
    return conf.withColumns({
        "source_name": F.upper(X.strip("source_name")),
        "dataset_id": X.strip("dataset_id"),
        "table_name": F.upper(X.strip("bea_table_name")),
        "vintage_tag": X.strip("vintage_tag"),
    }).withColumn("source_id", _hash_id("source_name", "dataset_id", "table_name"))


def _last_distinct(df: DataFrame, key: list[str], attrs: list[str], order: list[str]) -> DataFrame:
    """Per key: the attribute tuple written last by a sequence of upserts.

    Within a load the distinct tuples are upserted in order of first
    appearance (``order`` columns); across loads the later load wins.
    """
    first = df.groupBy(*key, *attrs, "load_seq").agg(F.min(F.struct(*order)).alias("_first"))
    win = F.max_by(F.struct(*attrs), F.struct("load_seq", "_first"))
    return first.groupBy(*key).agg(win.alias("_w")).select(*key, *[F.col(f"_w.{a}").alias(a) for a in attrs])


def build_star(conformed: DataFrame, loaded_at: str | None = None) -> Star:
    """The star of any number of loads; ``loaded_at`` is the load's time, one and the same for all rows."""
    c = _keyed(conformed)
    now = F.lit(loaded_at).cast("timestamp")

    dim_source = c.groupBy("source_id", "source_name", "dataset_id", "table_name").agg(
        F.min("load_seq").alias("first_load_seq"), F.max("load_seq").alias("last_load_seq"))

    loads = c.groupBy("source_id", "vintage_tag", "load_seq").agg(F.count(F.lit(1)).alias("rows_loaded"))
    last_per_source = loads.groupBy("source_id").agg(
        F.max_by("vintage_tag", "load_seq").alias("_latest_tag"))
    dim_vintage = (
        loads.groupBy("source_id", "vintage_tag").agg(F.max("load_seq").alias("last_load_seq"))
        .join(last_per_source, "source_id")
        .select(
            _hash_id("source_id", "vintage_tag").alias("vintage_id"),
            "source_id", "vintage_tag",
            F.lit(None).cast("string").alias("release_tag"),
            now.alias("as_of_timestamp"),
            (F.col("vintage_tag") == F.col("_latest_tag")).alias("is_latest"),
            "last_load_seq",
        )
    )

    geo = _last_distinct(c, ["state_fips"], ["state_abbrev", "geo_name"], ["period_code", "line_code"])
    dim_geo = geo.select(
        F.xxhash64(F.lit("state"), F.lit("US"), F.col("state_fips")).alias("geo_id"),
        F.lit("state").alias("geo_level"), F.lit("US").alias("country_code"),
        "state_fips", "state_abbrev", "geo_name",
    )

    periods = c.groupBy("frequency", "period_code").agg(
        F.max_by("year", "load_seq").alias("year"),
        F.min_by("month", F.when(F.col("month").isNotNull(), F.col("load_seq"))).alias("_month"),
    )
    dim_period = periods.select(
        F.xxhash64("frequency", "period_code").alias("period_id"),
        "frequency", "period_code", *period_bounds("frequency", "period_code", "year", "_month"),
        "year",
        F.lit(None).cast("int").alias("quarter"),
        F.when(F.col("frequency") == "M", F.coalesce(F.col("_month"), F.regexp_extract(
            F.upper(X.strip("period_code")), r"^\d{4}M(0[1-9]|1[0-2])$", 1).try_cast("int"))).alias("month"),
        F.lit(True).alias("is_period_end"),
    )

    series_attrs = ["bea_table_name", "line_code", "series_name", "function_name", "raw_description",
                    "hierarchy_path_json", "unit", "unit_mult"]
    series = _last_distinct(c, ["source_id", "series_code"], series_attrs,
                            ["period_code", "state_fips", "line_code"])
    dim_series = series.select(
        F.xxhash64("source_id", "series_code").alias("series_id"),
        "source_id", "series_code", *series_attrs,
        F.lit("colon_path").alias("parse_strategy"),
    )

    from econ_lake.operators.hierarchy import series_nodes
    dim_series_node, bridge_series_node = series_nodes(dim_series)

    fact_key = ["source_id", "series_code", "state_fips", "frequency", "period_code", "vintage_tag"]
    last = F.max_by(F.struct("pce_value", "pce_value_scaled", "note_ref", "run_id"), "load_seq")
    fact = (
        c.groupBy(*fact_key).agg(last.alias("_w"), F.max("load_seq").alias("load_seq"))
        .select(
            "source_id",
            F.xxhash64("source_id", "series_code").alias("series_id"),
            F.xxhash64(F.lit("state"), F.lit("US"), F.col("state_fips")).alias("geo_id"),
            F.xxhash64("frequency", "period_code").alias("period_id"),
            _hash_id("source_id", "vintage_tag").alias("vintage_id"),
            F.col("_w.pce_value").alias("value_numeric"),
            F.col("_w.pce_value_scaled").alias("value_scaled"),
            F.col("_w.note_ref").alias("note_ref"),
            F.col("_w.run_id").alias("run_id"),
            now.alias("loaded_at"),
        )
    )
    return Star(dim_source, dim_vintage, dim_geo, dim_period, dim_series, dim_series_node,
                bridge_series_node, fact)


def period_bounds(freq: str, code: str, year: str, month: str):
    """Calendar bounds; unsupported frequency -> error."""
    f = F.upper(X.strip(freq))
    m = F.coalesce(F.col(month), F.regexp_extract(F.upper(X.strip(code)), r"^\d{4}M(0[1-9]|1[0-2])$", 1)
                   .try_cast("int"))
    start = (
        F.when(f == "A", F.make_date(F.col(year), F.lit(1), F.lit(1)))
        .when((f == "M") & m.isNotNull(), F.make_date(F.col(year), m, F.lit(1)))
        .otherwise(F.raise_error(F.concat(F.lit("Unsupported period: "), F.col(freq), F.lit(" "), F.col(code))))
    )
    end = F.when(f == "A", F.make_date(F.col(year), F.lit(12), F.lit(31))).otherwise(F.last_day(start))
    return [start.cast("date").alias("period_start_date"), end.cast("date").alias("period_end_date")]


def foreign_key_report(conformed: DataFrame, star: Star) -> DataFrame:
    """Conformed rows whose geo, period or series key does not resolve."""
    c = _keyed(conformed)
    geo_miss = c.join(star.dim_geo.select("state_fips"), "state_fips", "left_anti").select(
        F.lit("geo").alias("fk"), "state_fips", "period_code", "series_code")
    per_miss = c.join(star.dim_period.select("frequency", "period_code"), ["frequency", "period_code"],
                      "left_anti").select(F.lit("period").alias("fk"), "state_fips", "period_code", "series_code")
    ser_miss = c.join(star.dim_series.select("source_id", "series_code"), ["source_id", "series_code"],
                      "left_anti").select(F.lit("series").alias("fk"), "state_fips", "period_code", "series_code")
    return geo_miss.unionByName(per_miss).unionByName(ser_miss)


def key_uniqueness_report(star: Star) -> DataFrame:
    """Duplicate surrogate ids or natural keys per table (bad_count 0 = ok)."""
    checks = [
        ("dim_source", star.dim_source, ["source_id"]),
        ("dim_vintage", star.dim_vintage, ["vintage_id"]),
        ("dim_geo", star.dim_geo, ["geo_id"]),
        ("dim_period", star.dim_period, ["period_id"]),
        ("dim_series", star.dim_series, ["series_id"]),
        ("dim_series_node", star.dim_series_node, ["node_id"]),
        ("bridge_series_node", star.bridge_series_node, ["series_id", "node_id"]),
        ("fact", star.fact, ["source_id", "series_id", "geo_id", "period_id", "vintage_id"]),
    ]
    parts = []
    for name, df, key in checks:
        parts.append(
            df.groupBy(*key).count().filter(F.col("count") > 1)
            .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("bad_count"))
            .select(F.lit(name).alias("table_name"), "bad_count")
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def assert_resolved(conformed: DataFrame, star: Star) -> None:
    """Raise, naming rows, when a geo, period or series key doesn't resolve."""
    bad = foreign_key_report(conformed, star).limit(5).collect()
    if bad:
        raise ValueError(f"unresolved keys: {[r.asDict() for r in bad]}")


# Columns that may not be NULL, and references, of the stored tables.
NOT_NULL = {
    "dim_source": ["source_id", "source_name", "dataset_id", "table_name"],
    "dim_vintage": ["vintage_id", "source_id", "vintage_tag", "is_latest"],
    "dim_geo": ["geo_id", "geo_level", "state_fips", "state_abbrev"],
    "dim_period": ["period_id", "frequency", "period_code", "period_start_date", "period_end_date", "year"],
    "dim_series": ["series_id", "source_id", "series_code"],
    "dim_series_node": ["node_id", "source_id", "node_key", "node_label", "node_level"],
    "bridge_series_node": ["series_id", "node_id", "path_ordinal", "is_leaf"],
    "fact": ["source_id", "series_id", "geo_id", "period_id", "vintage_id"],
}
REFERENCES = [
    ("fact", "source_id", "dim_source"), ("fact", "vintage_id", "dim_vintage"), ("fact", "geo_id", "dim_geo"),
    ("fact", "period_id", "dim_period"), ("fact", "series_id", "dim_series"),
    ("dim_series", "source_id", "dim_source"), ("bridge_series_node", "series_id", "dim_series"),
    ("bridge_series_node", "node_id", "dim_series_node"),
]


def constraint_report(star: Star) -> DataFrame:
    """Per table and constraint (unique key, not null, reference) the number of rows that break it."""
    tables = star.tables()
    parts = [key_uniqueness_report(star).select("table_name", F.lit("unique").alias("rule"), "bad_count")]
    for name, columns in NOT_NULL.items():
        lacks = F.count_if(F.array_contains(F.array(*[F.col(c).isNull() for c in columns]), True))
        parts.append(tables[name].agg(lacks.alias("bad_count")).select(
            F.lit(name).alias("table_name"), F.lit("not_null").alias("rule"), "bad_count"))
    for name, key, to in REFERENCES:
        lost = tables[name].join(tables[to].select(key), key, "left_anti")
        parts.append(lost.agg(F.count(F.lit(1)).alias("bad_count")).select(
            F.lit(name).alias("table_name"), F.lit(f"{key} in {to}").alias("rule"), "bad_count"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


FACT_KEY = ["source_id", "series_id", "geo_id", "period_id", "vintage_id"]


def load(tables: Tables, conformed: DataFrame, loaded_at: str) -> None:
    """Upserts one load's conformed rows into the stored star.

    The fact is partitioned by vintage, the bridge by source, so a daily load rewrites its own partitions only.  The
    dimensions are as large as the catalog, the calendar and the series lists.  All gates come before the first
    write.  The vintages come last: until then, readers of the latest vintages don't see the rows of new ones, and a
    load that failed on the way is run again (W17).
    """
    conformed = materialise(conformed, "load")
    if conformed.isEmpty():
        raise ValueError("nothing to load: the conformed frame is empty")  # G8
    new = build_star(conformed, loaded_at)
    assert_resolved(conformed, new)
    tables.merge("dim_source", new.dim_source, ["source_id"], keep=["first_load_seq"])
    tables.merge("dim_geo", new.dim_geo, ["geo_id"])
    tables.merge("dim_period", new.dim_period, ["period_id"], keep=["month", "quarter"])
    tables.merge("dim_series", new.dim_series, ["series_id"])
    # Nodes of earlier paths stay as they are; the bridge of a source is rebuilt from all its series
    from econ_lake.operators.hierarchy import series_nodes

    series = tables.read("dim_series").join(new.dim_source.select("source_id"), "source_id", "left_semi")
    nodes, bridge = series_nodes(series)
    tables.merge("dim_series_node", nodes, ["node_id"], keep=[c for c in nodes.columns if c != "node_id"])
    bridge = bridge.join(series.select("series_id", "source_id"), "series_id")
    tables.replace("bridge_series_node", bridge, ["series_id", "node_id"], "source_id", [r.source_id for r in new.dim_source.select("source_id").collect()])
    tables.merge("fact", new.fact, FACT_KEY, part="vintage_id")
    # The vintages of a loaded source are demoted, but for the one it has now
    vintages = new.dim_vintage
    old = tables.read("dim_vintage")
    if old is not None:
        demoted = (old.join(vintages.select("source_id").distinct(), "source_id", "left_semi")
                   .join(vintages.select("vintage_id"), "vintage_id", "left_anti")
                   .withColumn("is_latest", F.lit(False)))
        vintages = vintages.unionByName(demoted)
    tables.merge("dim_vintage", vintages, ["vintage_id"])


def read_star(tables: Tables) -> Star:
    """The stored star."""
    return Star(**{name: tables.read(name) for name in Star.__dataclass_fields__})
