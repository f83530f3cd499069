"""Series label hierarchy (W8, W9, W11): path decode, prefix nodes, bridge.

Set-based: every path prefix is a node, found with ``posexplode`` + ``slice``
in one pass; node ids and parent ids are hashes of the prefix keys, so no
row-by-row insert or id read-back is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from econ_lake.functions import exprs as X

NODE_SEP = "||"


def decode_path(raw_json: Column, function_name: Column, series_name: Column, line_code: Column) -> Column:
    """JSON list -> stripped non-blank items; else first non-blank of
    function name, series name, line code; else an empty list."""
    parsed = F.from_json(F.coalesce(raw_json.cast("string"), F.lit("[]")), "array<string>")
    items = F.filter(F.transform(parsed, lambda t: X.strip(F.coalesce(t, F.lit("")))), lambda t: t != "")
    fallback = F.coalesce(
        *[F.when(X.strip(F.coalesce(c.cast("string"), F.lit(""))) != "", X.strip(c.cast("string")))
          for c in (function_name, series_name, line_code)]
    )
    return (
        F.when(F.size(items) > 0, items)
        .when(fallback.isNotNull(), F.array(fallback))
        .otherwise(F.array().cast("array<string>"))
    )


def node_id(source_id: Column, table: Column, key: Column) -> Column:
    return F.xxhash64(source_id, table, key)


def series_nodes(dim_series: DataFrame) -> tuple[DataFrame, DataFrame]:
    """W9 + W11: (dim_series_node, bridge_series_node) from the series dim."""
    s = dim_series.select(
        "series_id", "source_id", "bea_table_name",
        decode_path(F.col("hierarchy_path_json"), F.col("function_name"), F.col("series_name"),
                    F.col("line_code")).alias("path"),
    )
    exploded = s.select(
        "series_id", "source_id", "bea_table_name", F.size("path").alias("depth"),
        F.posexplode("path").alias("pos", "node_label"), "path",
    ).select(
        "series_id", "source_id", "bea_table_name", "node_label",
        (F.col("pos") + 1).alias("node_level"),
        F.array_join(F.slice("path", 1, F.col("pos") + 1), NODE_SEP).alias("node_key"),
        F.when(F.col("pos") > 0, F.array_join(F.slice("path", 1, F.col("pos")), NODE_SEP)).alias("parent_key"),
        (F.col("pos") + 1 == F.col("depth")).alias("is_leaf"),
    )
    nodes = (
        exploded.groupBy("source_id", "bea_table_name", "node_key")
        .agg(F.first("node_label").alias("node_label"), F.first("node_level").alias("node_level"),
             F.first("parent_key", ignorenulls=True).alias("parent_key"))
        .select(
            node_id(F.col("source_id"), F.col("bea_table_name"), F.col("node_key")).alias("node_id"),
            "source_id", "bea_table_name", "node_key", "node_label", "node_level",
            F.when(F.col("parent_key").isNotNull(),
                   node_id(F.col("source_id"), F.col("bea_table_name"), F.col("parent_key"))).alias("parent_node_id"),
            F.col("parent_key").alias("parent_node_key"),
        )
    )
    bridge = exploded.select(
        "series_id", "node_key",
        node_id(F.col("source_id"), F.col("bea_table_name"), F.col("node_key")).alias("node_id"),
        F.col("node_level").alias("path_ordinal"),
        "is_leaf",
    )
    return nodes, bridge
