"""Dataset catalog (S16, S17): configuration entries checked by a table of field rules.

The catalog has one row per configured dataset, so its size follows the
configuration and not the data; joins on ``dataset_id`` broadcast it.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any, NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from econ_lake.session import small_frame

NEEDED = object()


class Rule(NamedTuple):
    """How one field of an entry is read: its type, default and case."""

    name: str
    kind: type
    default: Any = NEEDED
    case: Callable[[str], str] = str


# ---------------------------------------------------------------------------
# Field names and defaults of the dataset configuration.
# ---------------------------------------------------------------------------
COMMON_RULES = (
    Rule("dataset_id", str),
    Rule("source", str, "bea", str.lower),
    Rule("enabled", bool, True),
)
SOURCE_RULES = {
    "bea": (
        Rule("storage_dataset", str, "pce_state"),
        Rule("bea_dataset", str, "Regional"),
        Rule("bea_table_name", str),
        Rule("bea_frequency", str, "A"),
        Rule("bea_start_year", int, 2000),
        Rule("line_code", str, "ALL", str.upper),
        Rule("geo_fips", str, "STATE"),
    ),
    "census": (
        Rule("storage_dataset", str, "population_state"),
        Rule("census_dataset_path", str, "acs/acs1"),
        Rule("census_variable", str, "B01003_001E", str.upper),
        Rule("census_geography", str, "state"),
        Rule("census_start_year", int, 2000),
        Rule("census_frequency", str, "A"),
        Rule("census_series_kind", str, "population"),
        Rule("census_measure_label", str, "Resident population"),
        Rule("census_unit", str, "persons"),
        Rule("census_predicates", dict, None),
    ),
}

# The catalog of the test-data bridge; ids and table names are the public
# dataset identifiers that the serving views select on.
DEFAULT_DATASETS: list[dict[str, Any]] = [
    {"dataset_id": "pce_state_sapce1", "bea_table_name": "SAPCE1"},
    {"dataset_id": "pce_state_sapce4", "bea_table_name": "SAPCE4"},
    {"dataset_id": "state_regional_price_parities_sarpp", "bea_table_name": "SARPP"},
    {"dataset_id": "state_gdp_sagdp1", "bea_table_name": "SAGDP1"},
    {"dataset_id": "pce_state_sapce4_monthly", "bea_table_name": "SAPCE4", "bea_frequency": "M",
     "bea_start_year": 2019},
    {"dataset_id": "census_state_population", "source": "census"},
    {"dataset_id": "state_personal_transfer_receipts_sainc35", "bea_table_name": "SAINC35", "line_code": "2000"},
    {"dataset_id": "census_state_gov_finance_federal_intergovernmental_revenue", "source": "census",
     "storage_dataset": "state_gov_finance", "census_dataset_path": "timeseries/govs",
     "census_variable": "AMOUNT", "census_start_year": 2012, "census_series_kind": "state_gov_finance",
     "census_measure_label": "Federal intergovernmental revenue", "census_unit": "dollars_thousands",
     "census_predicates": {"SVY_COMP": "02", "GOVTYPE": "002", "AGG_DESC": "SF0004"}},
]
# ---------------------------------------------------------------------------

_SPARK_TYPES = {str: T.StringType(), int: T.IntegerType(), bool: T.BooleanType(),
                dict: T.MapType(T.StringType(), T.StringType())}


def _schema() -> T.StructType:
    """Rank, every field of any source once, and the aggregate description."""
    rules = {r.name: r for group in (COMMON_RULES, *SOURCE_RULES.values()) for r in group}
    fields = [T.StructField("catalog_rank", T.IntegerType(), False)]
    fields += [T.StructField(r.name, _SPARK_TYPES[r.kind]) for r in rules.values()]
    return T.StructType([*fields, T.StructField("census_agg_desc", T.StringType())])


CATALOG_SCHEMA = _schema()


def field(entry: dict[str, Any], rule: Rule) -> Any:
    """The value that ``rule`` reads from an entry; a ValueError names the field that is wrong."""
    value = entry.get(rule.name, rule.default)
    if value is NEEDED:
        raise ValueError(f"dataset entry lacks {rule.name}")
    if rule.kind is str:
        if not isinstance(value, str) or value.strip() == "":
            raise ValueError(f"{rule.name}: text expected, got {value!r}")
        return rule.case(value.strip())
    if rule.kind is dict:
        if not isinstance(value, dict):
            return None
        texts = Rule(f"{rule.name} part", str)
        return {field({texts.name: k}, texts): field({texts.name: v}, texts) for k, v in value.items()}
    return rule.kind(value)


def spec_of(entry: dict[str, Any]) -> dict[str, Any]:
    """An entry with all fields of its source, checked and defaulted."""
    spec = {r.name: field(entry, r) for r in COMMON_RULES}
    if spec["source"] not in SOURCE_RULES:
        raise ValueError(f"source: {spec['source']!r} is none of {sorted(SOURCE_RULES)}")
    spec |= {r.name: field(entry, r) for r in SOURCE_RULES[spec["source"]]}
    if spec["source"] == "census":
        spec["census_agg_desc"] = (spec["census_predicates"] or {}).get("AGG_DESC", "")
    return spec


def catalog_frame(spark: SparkSession, entries: list[dict[str, Any]] | None = None,
                  only_enabled: bool = True) -> DataFrame:
    """The catalog as a DataFrame in configuration order; an empty one is an error."""
    entries = DEFAULT_DATASETS if entries is None else entries
    specs = [(rank, spec_of(e)) for rank, e in enumerate(entries, 1) if isinstance(e, dict)]
    rows = [tuple({"catalog_rank": rank, **s}.get(f.name) for f in CATALOG_SCHEMA.fields)
            for rank, s in specs if s["enabled"] or not only_enabled]
    if not rows:
        raise ValueError("the catalog has no dataset to process")
    return small_frame(spark, rows, CATALOG_SCHEMA)


def load_catalog_yaml(spark: SparkSession, path: str) -> DataFrame:
    """The catalog from a YAML document with a ``datasets`` list, at any path that Spark reads."""
    import yaml

    found = [r.value for r in spark.read.text(path, wholetext=True).collect()]  # one configuration document
    document = yaml.safe_load(found[0]) if found else None
    entries = document.get("datasets") if isinstance(document, dict) else None
    if not isinstance(entries, list):
        raise ValueError(f"{path}: a mapping with a datasets list is expected")
    return catalog_frame(spark, entries)


def narrow(catalog: DataFrame, dataset_id: str | None) -> DataFrame:
    """One dataset of the catalog, or all of it for None."""
    if dataset_id is None:
        return catalog
    one = catalog.filter(catalog.dataset_id == dataset_id)
    if one.isEmpty():
        raise ValueError(f"no dataset {dataset_id!r} in the catalog")
    return one
